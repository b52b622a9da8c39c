"""Samples, splits, folds, top lists and reports. Every random choice is a hash of a seed and the row id, so
results repeat whatever the partitioning."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardscope.operators.prefix import PriorTotals, prior_totals
from wardscope.schema import quoted


def seeded_hash(seed: int, *columns: Column) -> Column:
    """MD5 text of the seed and the columns."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(c.cast("string") for c in columns)))


def hash_number(text: Column) -> Column:
    """Number from 0 to 2^32 − 1 made of the first eight hex digits."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("long")


def sorted_report(df: DataFrame, *order: Column | str) -> DataFrame:
    """Report table in a given order."""
    return df.orderBy(*order)


def top_n(df: DataFrame, value: str, name: str, n: int) -> DataFrame:
    """The ``n`` rows with the highest value, by name on ties."""
    return df.orderBy(F.desc(value), name).limit(n)


def best_model(results: DataFrame, model: str = "model", error: str = "MAE") -> DataFrame:
    """Name and error of the model with the least error among the rounded results, by name on ties."""
    rounded = results.filter("rounded")
    return rounded.agg(F.min_by(model, F.struct(error, model)).alias(model), F.min(error).alias(error))


def stable_sample(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42, digits: int = 4) -> DataFrame:
    """``n`` rows with the smallest seeded hash of their ids.

    Rows are counted per leading digits of the hash, which tells the digits up to which the sample reaches.
    Only rows up to there, the sample and a sliver more, are ordered.
    """
    hashed = df.withColumn("_hash", seeded_hash(seed, *map(quoted, ids)))
    prefix = F.substring("_hash", 1, digits)
    sizes = hashed.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    reach = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).filter(F.col("_before") < n)
    kept = hashed.filter(prefix <= reach.agg(F.max("_prefix").alias("_reach")).scalar())
    return kept.orderBy("_hash", *map(quoted, ids)).limit(n).drop("_hash")


def union_categories(train: DataFrame, test: DataFrame, column: str, missing: str = "_NA_") -> DataFrame:
    """Distinct values of a text column over both parts, null as ``missing``."""
    value = F.coalesce(quoted(column).cast("string"), F.lit(missing)).alias(column)
    return train.select(value).unionByName(test.select(value)).distinct()


def time_split(df: DataFrame, ts: str, split: object, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows before the split date and rows from it on; an error when one side is empty."""
    limit = F.lit(str(split)).cast(df.schema[ts].dataType)
    train, test = df.filter(F.col(ts) < limit), df.filter(F.col(ts) >= limit)
    if check and (train.isEmpty() or test.isEmpty()):
        raise ValueError(f"no rows on one side of the split date {split}")
    return train, test


DEFAULT_SPLIT = dt.date(2022, 1, 1)


def split_date_table(df: DataFrame, day: str, default: dt.date = DEFAULT_SPLIT, fraction: float = 0.8) -> DataFrame:
    """One row with the split date: the default when it occurs, else the date at that fraction of the dates.

    The dates are gathered once each; a calendar bounds their number.
    """
    dates = df.select(F.col(day).cast("date").alias("d")).distinct().agg(F.array_sort(F.collect_set("d")).alias("ds"))
    index = F.floor(F.size("ds") * fraction).cast("int") + 1
    chosen = F.when(F.array_contains("ds", F.lit(default)), F.lit(default)).otherwise(F.try_element_at("ds", index))
    return dates.select(chosen.alias("split_date"))


def choose_split_date(df: DataFrame, day: str, given: object = None, fraction: float = 0.8) -> dt.date:
    """The given date, or the one :func:`split_date_table` finds."""
    if given:
        return given if isinstance(given, dt.date) else dt.date.fromisoformat(str(given)[:10])
    found = split_date_table(df, day, fraction=fraction).first()[0]
    if found is None:
        raise ValueError("no dates to split")
    return found


def _label_positions(df: DataFrame, label: str, ids: Sequence[str], seed: int, out: str, digits: int = 4) -> DataFrame:
    """Position of a row among the rows of its label in hash order. The first digits of the hash spread a
    frequent label over many tasks."""
    hashed = seeded_hash(seed, *map(quoted, ids))
    spec = PriorTotals([label], {out: F.lit(1)})
    return prior_totals(df, [spec], F.substring(hashed, 1, digits), hashed, hashed)


def stratified_split(df: DataFrame, label: str, ids: Sequence[str], fraction: float = 0.2, seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """Mark the rounded fraction of the rows of each label as test rows."""
    placed = _label_positions(df, label, ids, seed, "_position")
    sizes = df.groupBy(label).agg(F.rint(F.count(F.lit(1)) * fraction).alias("_quota"))
    return placed.join(sizes, label).withColumn(out, F.col("_position") < F.col("_quota")).drop("_position", "_quota")


def stratified_folds(df: DataFrame, label: str, ids: Sequence[str], k: int = 3, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Deal the rows of each label out to ``k`` folds."""
    placed = _label_positions(df, label, ids, seed, "_position")
    return placed.withColumn(out, (F.col("_position") % k).cast("int")).drop("_position")


def literal_table(df: DataFrame, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Small table of driver-side values in the session of ``df``."""
    return df.sparkSession.createDataFrame(rows, schema)
