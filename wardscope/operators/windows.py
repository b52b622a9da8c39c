"""Past-only features and other window operators.

Operators on incidents use the split running totals of :mod:`wardscope.operators.prefix`. Operators on
aggregated series (one row per key and day, week or month) use plain windows: such a partition holds one
row per calendar step, however many incidents there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardscope.functions.calendar import epoch_seconds
from wardscope.operators.joins import null_safe_join
from wardscope.operators.prefix import HOT_ROWS, PriorTotals, previous_value, prior_totals, range_totals, sorted_codes, tie_hash
from wardscope.schema import quoted

DAY = 86_400


def _by_time(df: DataFrame, specs: Sequence[PriorTotals], ts: str, tie: Sequence[str], hot_rows: int) -> DataFrame:
    seconds = epoch_seconds(df, ts)
    return prior_totals(df, specs, F.floor(seconds / DAY), seconds, tie_hash([quoted(c) for c in tie]), hot_rows)


def prior_counts(df: DataFrame, ts: str, tie: Sequence[str], counts: dict[str, Sequence[str]],
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per output name, the number of earlier rows with the same keys. Rows of one second are ordered by a
    hash of the ``tie`` columns."""
    specs = [PriorTotals(keys, {name: F.lit(1)}) for name, keys in counts.items()]
    return _by_time(df, specs, ts, tie, hot_rows)


def prior_history(df: DataFrame, ts: str, tie: Sequence[str], counts: dict[str, Sequence[str]],
                  rates: dict[str, tuple[Sequence[str], str]], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Prior counts and prior rates in one go.

    A rate is 100 times the mean of a 0/1 flag over the earlier rows of its keys, rounded to two places,
    and null where no earlier row has a flag. Outputs that share their keys share the windows.
    """
    by_keys: dict[tuple[str, ...], dict[str, Column]] = {}
    for name, keys in counts.items():
        by_keys.setdefault(tuple(keys), {})[name] = F.lit(1)
    for name, (keys, flag) in rates.items():
        measures = by_keys.setdefault(tuple(keys), {})
        measures[f"_hits_{name}"] = F.col(flag)
        measures[f"_seen_{name}"] = F.col(flag).isNotNull().cast("int")
    specs = [PriorTotals(keys, measures) for keys, measures in by_keys.items()]
    found = _by_time(df, specs, ts, tie, hot_rows)
    percent = {name: F.round(F.try_divide(F.col(f"_hits_{name}"), F.col(f"_seen_{name}")) * 100.0, 2) for name in rates}
    helpers = [f"{prefix}{name}" for name in rates for prefix in ("_hits_", "_seen_")]
    return found.withColumns(percent).drop(*helpers) if rates else found


def prior_rates(df: DataFrame, ts: str, tie: Sequence[str], rates: dict[str, tuple[Sequence[str], str]],
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Only the rates of :func:`prior_history`."""
    return prior_history(df, ts, tie, {}, rates, hot_rows)


def prior_density(df: DataFrame, ts: str, tie: Sequence[str], category: str, part: str, out: str) -> DataFrame:
    """Share of ``part`` among the earlier rows of the category, null when there are none."""
    found = prior_counts(df, ts, tie, {"_total": [category], "_part": [category, part]})
    return found.withColumn(out, F.try_divide("_part", "_total")).drop("_total", "_part")


def rolling_range_count(df: DataFrame, keys: Sequence[str], ts: str, out: str, span: int = 7 * DAY) -> DataFrame:
    """Number of rows of the same keys in the ``span`` seconds before a row, its own second left out.

    It is the number of rows before the second less the number before the start of the span. Rows are counted
    per key and second first; each second then asks for both numbers with two marks on the time line. Running
    totals go over the days of a key and then over the marks of a day, so a busy key is spread over its days
    and the cost does not depend on how many rows a span holds, as it would with a sliding window.
    """
    timed = df.withColumn("_second", epoch_seconds(df, ts))
    seconds = timed.groupBy(*map(quoted, keys), "_second").agg(F.count(F.lit(1)).alias("_n"))
    # A start mark adds nothing and comes before the rows of its own second.
    marks = seconds.select(*map(quoted, keys), "_second", F.explode(F.array(
        F.struct(F.col("_second").alias("at"), F.lit(1).alias("sign"), F.col("_n").alias("n")),
        F.struct((F.col("_second") - span).alias("at"), F.lit(-1).alias("sign"), F.lit(0).cast("long").alias("n")),
    )).alias("_mark")).select(*map(quoted, keys), "_second", "_mark.*").withColumn("_day", F.floor(F.col("at") / DAY))
    by_day = [*map(quoted, keys), F.col("_day")]
    past = (Window.unboundedPreceding, -1)
    days = marks.groupBy(*by_day).agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*map(quoted, keys)).orderBy("_day").rowsBetween(*past))
    days = days.withColumn("n", F.coalesce(before, F.lit(0)))
    line = marks.unionByName(days, allowMissingColumns=True)
    order = Window.partitionBy(*by_day).orderBy(F.col("at").asc_nulls_first(), "sign").rowsBetween(*past)
    counted = line.withColumn("_before", F.sum("n").over(order)).filter(F.col("sign").isNotNull())
    counted = counted.groupBy(*map(quoted, keys), "_second").agg(F.sum(F.col("sign") * F.col("_before")).alias(out))
    return null_safe_join(timed, counted, [*keys, "_second"]).drop("_second")


def lag_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, steps: dict[str, int]) -> DataFrame:
    """Value some rows before, per output name. Steps count rows of the series, not calendar days."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({name: F.lag(column, step).over(window) for name, step in steps.items()})


def prev_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str) -> DataFrame:
    """Value of the row before. Keys may be few and large: a key is spread over as many tasks as its rows need."""
    return previous_value(df, keys, [F.col(c) if isinstance(c, str) else c for c in order], quoted(column), out)


def rolling_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, widths: dict[str, int],
                 shift: int = 0) -> DataFrame:
    """Mean of the last ``width`` rows, or of as many as there are. ``shift=1`` leaves the current row out."""
    window = Window.partitionBy(*keys).orderBy(*order)
    means = {
        name: F.avg(column).over(window.rowsBetween(1 - width - shift, -shift)) for name, width in widths.items()
    }
    return df.withColumns(means)


def rolling_mean_strict(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str,
                        width: int = 3) -> DataFrame:
    """Mean of the ``width`` rows before the current one, null when there are fewer."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-width, -1)
    return df.withColumn(out, F.when(F.count(column).over(window) == width, F.avg(column).over(window)))


def sigma_outlier(df: DataFrame, keys: Sequence[str], day: str, tie: Sequence[str], column: str, out: str,
                  sigmas: float = 3) -> DataFrame:
    """True when an integer count lies more than ``sigmas`` sample deviations above the mean of all earlier rows.

    Mean and deviation come from exact integer sums, in steps of a year and a day. Fewer than two earlier
    rows give false.
    """
    value = F.col(column)
    spec = PriorTotals(keys, {"_n": F.lit(1), "_sum": value, "_squares": value * value})
    found = prior_totals(df, [spec], F.year(day), F.unix_date(day), tie_hash([quoted(c) for c in tie]))
    # In decimals the numerator is exact, so a constant history has a deviation of exactly 0.
    n, total, squares = (F.col(c).cast("decimal(19,0)") for c in ("_n", "_sum", "_squares"))
    variance = F.try_divide((n * squares - total * total).cast("double"), (n * (n - 1)).cast("double"))
    limit = F.try_divide("_sum", "_n") + sigmas * F.sqrt(variance)
    return found.withColumn(out, F.coalesce(value > limit, F.lit(False))).drop("_n", "_sum", "_squares")


def top1_per_group(df: DataFrame, keys: Sequence[str], name: str, count: str, out: str) -> DataFrame:
    """Name with the highest count per group, the first in sorted order on ties. A plain aggregate, so partial
    results are merged before the shuffle."""
    return df.groupBy(*keys).agg(F.min_by(name, F.struct(-F.col(count), F.col(name))).alias(out))


def latest_per(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str]) -> DataFrame:
    """Last row of each group. Spark keeps one candidate per task and group before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(F.desc(ts), *(F.desc(c) for c in tie))
    return df.withColumn("_position", F.row_number().over(window)).filter("_position = 1").drop("_position")


def category_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Code of a text value: its position among the sorted distinct values, −1 for null."""
    codes = sorted_codes(df, column, "_code")
    return df.join(codes, column, "left").withColumn(out, F.coalesce("_code", F.lit(-1))).drop("_code")


def positional_slice(df: DataFrame, keys: Sequence[str], order: str, fraction: float, out: str) -> DataFrame:
    """True for the first ``fraction`` of all rows in the order of keys, then ``order``; at least one row.

    Positions come from sampled ranges, so that neither the rows nor the list of keys passes through one task.
    Rows equal in keys and order are taken by a hash of the whole row.
    """
    tie = F.xxhash64(*(quoted(c) for c in df.columns))
    placed = range_totals(df, [], [*(quoted(k) for k in keys), F.col(order), tie], {"_before": F.lit(1)})
    total = df.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(fraction))).alias("n")).scalar()
    return placed.withColumn(out, F.col("_before") < total).drop("_before")
