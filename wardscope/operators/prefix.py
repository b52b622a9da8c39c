"""Running totals that stay spread over the cluster when one key holds a large part of the rows.

A window partitioned by a key such as the incident type puts the whole history of a type into one task.
Here the history of a key is split by a coarse bucket (a day): a small table of bucket totals gives each
bucket the total of those before it, and a window inside the bucket adds the rows before. A bucket that is
itself too large is split again, by position and tie hash. Sums of integers are exact, so the result equals
the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardscope.operators.joins import null_safe_join
from wardscope.schema import quoted
from wardscope.session import numbered, stored

# A bucket of up to this many narrow rows is sorted by one task.
HOT_ROWS = 10_000_000


def key_text(columns: Sequence[Column]) -> Column:
    """One text for several key columns, nulls included."""
    return F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns))


def tie_hash(columns: Sequence[Column]) -> Column:
    """Repeatable order of rows that are equal in everything a window sorts by."""
    return F.md5(key_text(columns))


@dataclass
class PriorTotals:
    """Totals of ``measures`` over the rows of the same ``keys`` that come before a row."""

    keys: Sequence[str]
    measures: Mapping[str, Column]
    inclusive: bool = False
    names: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.names = list(self.measures)


def _before(partition: Sequence[str], order: Sequence[str], inclusive: bool = False) -> Window:
    last = Window.currentRow if inclusive else -1
    return Window.partitionBy(*map(quoted, partition)).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)


def prior_totals(df: DataFrame, specs: Sequence[PriorTotals], coarse: Column, fine: Column, tie: Column,
                 hot_rows: int = HOT_ROWS, tie_digits: int = 2) -> DataFrame:
    """Add the totals of every spec to each row.

    ``coarse`` and ``fine`` order the rows: ``coarse`` never falls while ``fine`` rises. ``tie`` is a hex
    text that orders rows of equal ``fine``. A bucket with more than ``hot_rows`` rows is split by ``fine``
    and the first ``tie_digits`` digits of ``tie``, so that even rows that share key and second are ranked by
    many tasks.

    Several specs share one pass: a row enters it once per spec with nothing but keys, order and measures,
    and the whole rows are shuffled once, when the totals are joined to them by a stored row number. Rows that
    are equal in every column thus keep totals of their own, as a plain window gives them.
    """
    order = {"_coarse": coarse, "_fine": fine, "_tie": tie}
    if len(specs) == 1:
        spec = specs[0]
        rows = df.withColumns({"_key": key_text([quoted(k) for k in spec.keys]), **order, **_measures(spec.measures)})
        found = _add_totals(rows, ["_key"], spec.names, spec.inclusive, hot_rows, tie_digits)
        return found.drop("_key", *order, *(f"_m_{name}" for name in spec.names))
    width = max(len(spec.names) for spec in specs)
    names = [f"v{j}" for j in range(width)]
    rows = numbered(df, "_row_key")
    entries = []
    for i, spec in enumerate(specs):
        values = [*spec.measures.values(), *[F.lit(0)] * (width - len(spec.names))]
        entries.append(F.struct(F.lit(i).alias("_spec"), key_text([quoted(k) for k in spec.keys]).alias("_key"),
                                *(m.alias(name) for name, m in _measures(dict(zip(names, values))).items())))
    stacked = rows.select("_row_key", *(c.alias(name) for name, c in order.items()), F.explode(F.array(*entries)).alias("_e"))
    found = _add_totals(stacked.select("_row_key", *order, "_e.*"), ["_spec", "_key"], names, specs[0].inclusive,
                        hot_rows, tie_digits)
    outputs = [F.max(F.when(F.col("_spec") == i, F.col(f"v{j}"))).alias(name)
               for i, spec in enumerate(specs) for j, name in enumerate(spec.names)]
    return rows.join(found.groupBy("_row_key").agg(*outputs), "_row_key").drop("_row_key")


def _measures(measures: Mapping) -> dict[str, Column]:
    return {f"_m_{name}": F.coalesce(m.cast("long"), F.lit(0).cast("long")) for name, m in measures.items()}


def _add_totals(rows: DataFrame, keys: list[str], names: Sequence[str], inclusive: bool, hot_rows: int,
                tie_digits: int) -> DataFrame:
    """Core on rows with non-null keys, ``_coarse``, ``_fine``, ``_tie`` and measures ``_m_<name>``."""
    sums, bucket, part = [f"_m_{name}" for name in names], [*keys, "_coarse"], ["_part_fine", "_part_tie"]

    def totals(frame: DataFrame, by: list[str]) -> DataFrame:
        return frame.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums), F.count(F.lit(1)).alias("_rows"))

    def starting(frame: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
        window = _before(partition, order)
        return frame.withColumns({c: F.coalesce(F.sum(c).over(window), F.lit(0)) for c in sums})

    sizes = totals(rows, bucket)
    days = starting(sizes, keys, ["_coarse"])
    # Large buckets are fewer than rows / hot_rows, which bounds what is broadcast: at most 100,000 entries
    # for a trillion rows. Mostly there are none, and the branches that depend on them vanish at run time.
    # Naming the sums, which are never null, keeps this the same aggregate as the one behind the days, so
    # that both read one shuffle.
    known = reduce(Column.__and__, (F.col(c).isNotNull() for c in sums))
    hot = F.broadcast(sizes.filter((F.col("_rows") > hot_rows) & known).select(*bucket, F.lit(True).alias("_hot")))
    cut = {"_part_fine": F.col("_fine"), "_part_tie": F.substring("_tie", 1, tie_digits)}
    marked = null_safe_join(rows, hot, bucket).withColumns({name: F.when(F.col("_hot"), c) for name, c in cut.items()})
    cells = totals(null_safe_join(rows, hot, bucket, "inner").withColumns(cut), [*bucket, *part])
    # The total before a bucket enters its cells as a first row, which makes their sum start from it; the
    # total before a cell, or before a bucket that is not split, enters the rows in the same way.
    opening = days.filter(F.col("_rows") > hot_rows).withColumn("_rank", F.lit(0))
    cells = cells.withColumn("_rank", F.lit(1)).unionByName(opening, allowMissingColumns=True)
    cells = starting(cells, bucket, ["_rank", *part]).filter("_rank = 1")
    starts = days.filter(F.col("_rows") <= hot_rows).withColumns({name: F.lit(None) for name in part})
    starts = cells.select(*bucket, *part, *sums).unionByName(starts.select(*bucket, *part, *sums))
    line = marked.withColumn("_rank", F.lit(1)).unionByName(starts.withColumn("_rank", F.lit(0)), allowMissingColumns=True)
    window = _before([*bucket, *part], ["_rank", "_fine", "_tie"], inclusive)
    found = line.withColumns({name: F.sum(f"_m_{name}").over(window) for name in names})
    return found.filter("_rank = 1").drop("_rank", "_hot", *part)


def range_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: Mapping[str, Column],
                 inclusive: bool = False) -> DataFrame:
    """``df`` with the totals of ``measures`` over the rows of the same ``keys`` that come before in ``order``.

    For keys that are few, or none: rows are dealt out by sampled ranges of keys and order and stored, totalled inside
    their range, and shifted by the totals of the ranges before. There are as many ranges as shuffle partitions, so that
    they grow in number with the cluster, not in rows; a key of any size is spread, with one key or none all the same. Only rows
    equal in all of ``order`` have to share a range, and come in any order there.
    """
    names, by = list(measures), [quoted(k) for k in keys]
    sort = {f"_o{i}": c for i, c in enumerate(order)}
    rows = df.withColumns({**sort, **_measures(measures)})
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = stored(rows.repartitionByRange(parts, *by, *sort).withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range", *by).agg(*(F.sum(f"_m_{n}").alias(f"_s_{n}") for n in names))
    earlier = _before(keys, ["_range"])  # at most one total per range and key that reaches into it
    starts = sizes.select("_range", *by, *(F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in names))
    inside = _before([*keys, "_range"], [*sort], inclusive)
    found = placed.withColumns({f"_i_{n}": F.coalesce(F.sum(f"_m_{n}").over(inside), F.lit(0)) for n in names})
    found = null_safe_join(found, starts, [*keys, "_range"], "inner").withColumns({n: F.col(f"_i_{n}") + F.col(f"_s_{n}") for n in names})
    return found.drop("_range", *sort, *(f"{p}{n}" for p in ("_m_", "_i_", "_s_") for n in names))


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """``df`` with ``value`` of the row before among the rows of the same ``keys`` in ``order``, null for the first.

    Rows are dealt out by sampled ranges as in ``range_totals``, so one key may fill many tasks. The first row of a key in a
    range takes the last value that the key has in the ranges before.
    """
    by, sort = [quoted(k) for k in keys], {f"_o{i}": c for i, c in enumerate(order)}
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = df.withColumns({**sort, "_value": F.struct(value.alias("v"))})  # a struct tells a null value from no row
    placed = stored(rows.repartitionByRange(parts, *by, *sort).withColumn("_range", F.spark_partition_id()))
    lasts = placed.groupBy("_range", *by).agg(F.max_by("_value", F.struct(*sort)).alias("_last"))
    ahead = Window.partitionBy(*by).orderBy("_range")  # at most one row per range and key that reaches into it
    carried = lasts.select("_range", *by, F.lag("_last").over(ahead).alias("_carried"))
    inside = F.lag("_value").over(Window.partitionBy(*by, "_range").orderBy(*sort))
    found = null_safe_join(placed.withColumn("_before", inside), carried, [*keys, "_range"], "inner")
    return found.withColumn(out, F.coalesce("_before", "_carried")["v"]).drop("_range", "_value", "_before", "_carried", *sort)


def sorted_codes(values: DataFrame, column: str, code: str) -> DataFrame:
    """Number the distinct non-null values of a text column from 0 in sorted order.

    Values are dealt out by sampled ranges and stored, ranked inside their range and shifted by the sizes of the ranges
    before. A large vocabulary is thus never sorted by a single task, whatever its values have in common.
    """
    distinct = values.select(quoted(column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    placed = stored(distinct.repartitionByRange(quoted(column)).withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(_before([], ["_range"])), F.lit(0)).alias("_start"))
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy(quoted(column))))
    numbered = ranked.join(starts, "_range")
    return numbered.select(quoted(column), (F.col("_start") + F.col("_rank") - 1).cast("int").alias(code))
