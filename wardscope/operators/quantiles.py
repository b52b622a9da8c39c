"""Exact quantiles of raw rows without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardscope.operators.joins import null_safe_join
from wardscope.schema import quoted


# Rank error of the sketch that cuts a group, as a share of its rows: one in this many.
SKETCH_ACCURACY = 10_000
# Distances from the wanted rank at which a group is cut, in units of the sketch's error.
CUTS = (-64, -8, -2, 0, 2, 8, 64)


def exact_quantiles(df: DataFrame, keys: Sequence[str], column: str, quantile: float, out: str,
                    accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Linearly interpolated quantile per group, the same number ``percentile`` gives.

    A mergeable sketch per group gives values of about the wanted rank, which cut the group into buckets by rank, however
    its values are spread: the totals of the buckets tell which one or two hold the wanted ranks, and only their
    values, a few parts in ``accuracy`` of the group, are exchanged (equal ones counted together) and ordered. The sketch
    only decides where a group is cut; the result is exact for any cuts.
    """
    by = [quoted(k) for k in keys]
    rows = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v"))
    points = sorted({min(1.0, max(0.0, quantile + step / accuracy)) for step in CUTS})
    facts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), F.percentile_approx("_v", points, accuracy).alias("_cuts"))
    position = F.lit(quantile) * (F.col("_rows") - 1)
    facts = facts.select(*by, "_cuts", F.floor(position).alias("_first"), F.ceil(position).alias("_last"), position.alias("_at"))
    placed = null_safe_join(rows, facts.select(*by, "_cuts"), keys, "inner").withColumn(
        "_bucket", F.size(F.filter("_cuts", lambda cut: cut <= F.col("_v")))).drop("_cuts")

    # A group has at most one total more than cuts.
    sizes = null_safe_join(placed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size")), facts.drop("_cuts"), keys, "inner")
    up_to = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumn("_end", F.sum("_size").over(up_to))
    wanted = sizes.filter((F.col("_end") > F.col("_first")) & (F.col("_end") - F.col("_size") <= F.col("_last")))
    wanted = wanted.select(*by, "_bucket", "_first", "_last", "_at", (F.col("_end") - F.col("_size")).alias("_start"))

    inside = null_safe_join(placed, wanted.select(*by, "_bucket"), [*keys, "_bucket"], "inner")
    counted = null_safe_join(inside.groupBy(*by, "_bucket", "_v").agg(F.count(F.lit(1)).alias("_n")), wanted, [*keys, "_bucket"], "inner")
    run = Window.partitionBy(*by, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_until", F.col("_start") + F.sum("_n").over(run))

    def at(rank: str):
        return F.min(F.when(F.col("_until") > F.col(rank), F.col("_v")))

    ends = ranked.groupBy(*by).agg(at("_first").alias("_a"), at("_last").alias("_b"),
                                   F.first(F.col("_at") - F.col("_first")).alias("_w"))
    return ends.select(*by, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w")).alias(out))
