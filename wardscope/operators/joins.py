"""Equi-joins of incident rows with aggregates and lookup tables.

No side is forced to be broadcast: the optimizer broadcasts a side whose size it knows to be under its
limit and otherwise shuffles, splitting the partitions of a hot key at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.schema import quoted


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which null keys match null keys, as they do in grouping and windows."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    matches = reduce(Column.__and__, (quoted(key).eqNullSafe(quoted(f"_right_{key}")) for key in keys))
    return left.join(renamed, matches, how).drop(*(f"_right_{key}" for key in keys))


def join_back(df: DataFrame, aggregate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of an aggregate to the rows; columns that ``df`` has already are replaced."""
    repeated = [name for name in aggregate.columns if name in df.columns and name not in keys]
    return df.drop(*repeated).join(aggregate, list(keys), "left")


def scaled_bins(df: DataFrame, bins: Sequence[str], digits: int = 2) -> DataFrame:
    """Grid bins as integers, which join exactly where rounded doubles might not."""
    return df.withColumns({f"{name}_Key": F.round(F.col(name) * 10 ** digits).cast("long") for name in bins})


def join_required(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join that drops the rows without a partner."""
    return df.join(other, list(keys), "inner")


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default: object = None) -> DataFrame:
    """Add the value a lookup table holds for a key, or the default."""
    found = df.join(table.select(key, value), key, "left")
    return found if default is None else found.withColumn(value, F.coalesce(value, F.lit(default)))


def attach_statics(series: DataFrame, key: str, statics: Sequence[DataFrame]) -> DataFrame:
    """Left join of tables with one row per key; what is missing becomes 0."""
    for table in statics:
        added = [name for name in table.columns if name != key]
        series = series.join(table, key, "left").fillna(0, subset=added)
    return series
