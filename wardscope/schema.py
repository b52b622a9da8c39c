"""Checks and choices made on the analysed schema alone. None of these functions runs a Spark job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has(df: DataFrame, *names: str) -> bool:
    """True when every name is a column of ``df``."""
    return set(names) <= set(df.columns)


def require(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Return ``df``, or raise when one of ``names`` is no column of it."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df


def select_available(df: DataFrame, wanted: Sequence[str], prefixes: Sequence[str] = ()) -> list[str]:
    """The wanted columns that exist, in the wanted order, then those that start with a prefix."""
    by_prefix = [name for name in df.columns if any(name.startswith(prefix) for prefix in prefixes)]
    present = set(df.columns)
    return [name for name in dict.fromkeys([*wanted, *by_prefix]) if name in present]


def quoted(name: str) -> Column:
    """Column reference that also works for names holding dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def first_available(df: DataFrame, names: Sequence[str], default: object = None) -> Column:
    """The first of the alias columns that exists, else the default as a literal."""
    found = next((name for name in names if name in df.columns), None)
    return quoted(found) if found else F.lit(default)


def merge_suffixed(df: DataFrame, bases: Sequence[str], suffixes: Sequence[str] = ("_x", "_y")) -> DataFrame:
    """Fold the leftovers ``c_x`` and ``c_y`` of an earlier merge into ``c``, the first non-null winning."""
    for base in bases:
        leftovers = [base + suffix for suffix in suffixes if base + suffix in df.columns]
        if leftovers:
            sources = [name for name in (base, *leftovers) if name in df.columns]
            df = df.withColumn(base, F.coalesce(*map(quoted, sources))).drop(*leftovers)
    return df
