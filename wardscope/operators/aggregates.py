"""Aggregates per key and calendar step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.operators.quantiles import exact_quantiles
from wardscope.schema import quoted



def group_counts(df: DataFrame, keys: Sequence[str | Column], out: str) -> DataFrame:
    """Number of rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def daily_counts(df: DataFrame, key: str, day: str = "Date_Only", out: str = "CrimeCountPerDay") -> DataFrame:
    """Rows per key and day; days without rows are absent."""
    return group_counts(df, [key, day], out)


def cell_daily_counts(df: DataFrame, key: str, bins: Sequence[str], day: str, out: str) -> DataFrame:
    """Rows per key, grid cell and day."""
    return group_counts(df, [key, *bins, day], out)


def monthly_rate(df: DataFrame, key: str, month: str, flag: str) -> DataFrame:
    """Total, flagged total and flagged share per key and month."""
    sums = df.groupBy(key, month).agg(F.count(F.lit(1)).alias("Monthly_Crime_Total"),
                                      F.sum(flag).alias("Monthly_Arrests"))
    return sums.withColumn("Monthly_Arrest_Rate", F.try_divide("Monthly_Arrests", "Monthly_Crime_Total"))


def monthly_type_counts(df: DataFrame, key: str, month: str, category: str, out: str = "ct_count") -> DataFrame:
    """Rows per key, month and category."""
    return group_counts(df, [key, month, category], out)


def weekly_counts(df: DataFrame, key: str, week: str = "Week", out: str = "crime_count") -> DataFrame:
    """Rows per key and week."""
    return group_counts(df, [key, week], out)


def _shares(df: DataFrame, key: str, category: str, values: Sequence[object], names: Sequence[str]) -> DataFrame:
    counts = [F.count(F.when(quoted(category) == value, 1)).alias(f"_n{i}") for i, value in enumerate(values)]
    totals = df.groupBy(key).agg(F.count(quoted(category)).alias("_all"), *counts)
    return totals.select(key, *(F.coalesce(F.try_divide(F.col(f"_n{i}"), F.col("_all")), F.lit(0.0)).alias(name)
                                for i, name in enumerate(names)))


def category_values(df: DataFrame, category: str, limit: int | None = 10_000) -> list[str]:
    """Distinct values that are to become columns. A table cannot have more columns than ``limit`` anyway.

    Without a limit all values come, for the classes of a model, which has trees for each of them.
    """
    found = df.select(category).filter(F.col(category).isNotNull()).distinct()
    rows = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} distinct values in {category}; they cannot become columns")
    return sorted(row[0] for row in rows)


def category_mix(df: DataFrame, key: str, category: str, values: Sequence[str]) -> DataFrame:
    """One share column per category value; shares of all non-null rows of the key, so that they add up to 1 if
    ``values`` holds every category."""
    return _shares(df.filter(F.col(category).isNotNull()), key, category, values, values)


def hour_profile(df: DataFrame, key: str, hour: str = "Hour", ts: str | None = None) -> DataFrame:
    """Share of each hour of the day per key. The hour is derived when the column is absent."""
    if hour not in df.columns:
        df = df.withColumn(hour, F.hour(ts))
    return _shares(df, key, hour, range(24), [f"h{h}" for h in range(24)])


def centroid_mean(df: DataFrame, key: str, lat: str = "Latitude", lng: str = "Longitude") -> DataFrame:
    """Mean coordinates per key; keys without coordinates are left out."""
    means = df.groupBy(key).agg(F.avg(lat).alias(lat), F.avg(lng).alias(lng))
    return means.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())


def coordinate_names(df: DataFrame) -> tuple[str, str] | None:
    """The coordinate columns under the long or the short name."""
    pairs = (("Latitude", "Longitude"), ("Lat", "Lng"))
    return next((pair for pair in pairs if set(pair) <= set(df.columns)), None)


def centroid_median(df: DataFrame, key: str) -> DataFrame:
    """Median coordinates per key over the rows that have both."""
    lat, lng = coordinate_names(df)
    located = df.filter(F.col(key).isNotNull() & F.col(lat).isNotNull() & F.col(lng).isNotNull()).select(key, lat, lng)
    # Both measures in one pass.
    cells = F.explode(F.array(*(F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_x")) for i, c in enumerate((lat, lng)))))
    stacked = located.select(key, cells.alias("_c")).select(key, "_c.*")
    found = exact_quantiles(stacked, [key, "_m"], "_x", 0.5, "_median").groupBy(key)
    return found.agg(*(F.max(F.when(F.col("_m") == i, F.col("_median"))).alias(out) for i, out in enumerate(("Latitude", "Longitude"))))


def global_quantile_cap(df: DataFrame, column: str, flag: str, capped: str, quantile: float = 0.995) -> DataFrame:
    """Flag the counts above a quantile of all counts and cap them there.

    The quantile is taken over the distinct counts with their frequencies: a few numbers.
    """
    limit = (df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
             .agg(F.percentile(column, quantile, F.col("_n")).alias("limit")).scalar())
    return df.withColumns({flag: F.col(column) > limit, capped: F.least(F.col(column).cast("double"), limit)})


def hotspot_label(weekly: DataFrame, key: str, count: str = "crime_count", quantile: float = 0.75) -> DataFrame:
    """Threshold of each key and 1 for the weeks above it, else 0. A key has one row per week."""
    limits = weekly.groupBy(key).agg(F.percentile(count, quantile).alias("threshold"))
    return weekly.join(limits, key).withColumn("is_hotspot", (F.col(count) > F.col("threshold")).cast("int"))


def mode_by(df: DataFrame, key: str, column: str, default: object = 0) -> DataFrame:
    """Most frequent value per key, the smallest on ties, the default when all are null."""
    counts = df.groupBy(key, column).agg(F.count(column).alias("_n"))
    best = counts.groupBy(key).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(column))
    return best.withColumn(column, F.coalesce(column, F.lit(default)))


def first_by(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First non-null value of each column per key in the order of the given columns, the least one on ties."""
    return df.groupBy(key).agg(*(
        F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, c))).alias(c) for c in columns))


def last_by(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last non-null value of each column per key in the order of the given columns, the greatest one on ties."""
    return df.groupBy(key).agg(*(
        F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, c))).alias(c) for c in columns))


def hardness_weights(train: DataFrame, key: str, count: str, rolling: str, gamma: float = 1.0) -> DataFrame:
    """Weight per key: 0.7 times how badly the rolling mean predicts it, 0.3 times how rare it is.

    The first part is the mean absolute error over the median error of all keys, held between 0.5 and 3;
    the second is one over the root of the row count, over its mean. The sum is held between 0.25 and 4.
    """
    per_key = train.groupBy(key).agg(F.avg(F.abs(F.col(count) - F.col(rolling))).alias("_mae"),
                                     F.count(F.lit(1)).alias("_n"))
    rarity = 1.0 / F.sqrt(F.col("_n") + 1e-6)
    facts = per_key.agg(F.struct(F.percentile("_mae", 0.5).alias("mid"), F.avg(rarity).alias("rarity"))).scalar()
    hardness = F.pow(F.col("_mae") / F.greatest(facts["mid"], F.lit(1e-6)), F.lit(gamma))
    weight = 0.7 * _between(hardness, 0.5, 3.0) + 0.3 * rarity / facts["rarity"]
    return per_key.select(key, F.coalesce(_between(weight, 0.25, 4.0), F.lit(1.0)).alias("weight"))


def _between(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows over (classes times rows of the class), per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    facts = counts.agg(F.struct(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.select(label, (facts["rows"] / (facts["classes"] * F.col("_n"))).alias("weight"))


def top_by_support(df: DataFrame, label: str, n: int) -> DataFrame:
    """The ``n`` most frequent values with their counts, by name on ties."""
    return group_counts(df, [label], "support").orderBy(F.desc("support"), label).limit(n)


def citywide_daily(df: DataFrame, day: str, column: str, out: str) -> DataFrame:
    """Sum over all keys per day."""
    return df.groupBy(day).agg(F.sum(column).alias(out))


def target_summary(df: DataFrame, column: str) -> DataFrame:
    """Mean and median of an integer target. Both come from the frequencies of its distinct values."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg((F.sum(F.col(column) * F.col("_n")) / F.sum("_n")).alias("mean_actual"),
                      F.percentile(column, 0.5, F.col("_n")).alias("median_actual"))


def per_key_errors(df: DataFrame, key: str, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and N per key."""
    error = F.col(predicted) - F.col(actual)
    return df.groupBy(key).agg(F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE"),
                               F.count(F.lit(1)).alias("N"))


def worst_keys(errors: DataFrame, key: str, n: int = 25, min_rows: int = 50) -> DataFrame:
    """The keys with the largest MAE among those with enough rows."""
    return errors.filter(F.col("N") >= min_rows).orderBy(F.desc("MAE"), key).limit(n)
