"""Second job: past-only window features of clean incident records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.functions.calendar import time_keys
from wardscope.functions.cleaning import dedup, fill_nulls
from wardscope.operators import aggregates, windows
from wardscope.operators.joins import join_back, scaled_bins
from wardscope.operators.prefix import tie_hash
from wardscope.schema import quoted, require
from wardscope.session import numbered

REQUIRED = ("Beat", "Date_TS", "CrimeType", "Hour", "Arrest_Flag", "Year", "Month", "Lat_Bin", "Lng_Bin")
CELL = ["Beat", "Date_Only", "Lat_Bin_Key", "Lng_Bin_Key"]


def monthly_features(df: DataFrame) -> DataFrame:
    """Per beat and month: arrest rate and most frequent type of the month observed before."""
    rates = aggregates.monthly_rate(df, "Beat", "YearMonthDate", "Arrest_Flag")
    types = aggregates.monthly_type_counts(df, "Beat", "YearMonthDate", "CrimeType")
    top = windows.top1_per_group(types, ["Beat", "YearMonthDate"], "CrimeType", "ct_count", "TopCrimeType_Month")
    months = rates.join(top, ["Beat", "YearMonthDate"])
    months = windows.lag_by(months, ["Beat"], ["YearMonthDate"], "Monthly_Arrest_Rate", {"Prev_Month_Arrest_Rate": 1})
    months = windows.lag_by(months, ["Beat"], ["YearMonthDate"], "TopCrimeType_Month", {"TopCrimeType_PrevMonth": 1})
    return months.select("Beat", "YearMonthDate", "Prev_Month_Arrest_Rate", "TopCrimeType_PrevMonth")


def daily_cell_features(df: DataFrame, per_cell: bool = False) -> DataFrame:
    """Per beat, grid cell and day: count of the row before and whether the count is an outlier.

    The row before is the previous cell of the same beat, possibly of the same day, unless ``per_cell``
    keeps every cell to itself.
    """
    daily = aggregates.cell_daily_counts(df, "Beat", CELL[2:], "Date_Only", "Daily_Crime_Count")
    keys = ["Beat", *CELL[2:]] if per_cell else ["Beat"]
    order = ["Date_Only", tie_hash([F.col(name) for name in CELL[2:]])]
    daily = windows.prev_row(daily, keys, order, "Daily_Crime_Count", "PrevDay_CrimeCount")
    daily = windows.sigma_outlier(daily, keys, "Date_Only", CELL[2:], "Daily_Crime_Count", "Is_CrimeOutlier")
    return daily.drop("Daily_Crime_Count")


def stage2(df: DataFrame, row_id: str | None = None, distinct: bool = True, per_cell: bool = False) -> DataFrame:
    """Add the history features. ``distinct=False`` spares a shuffle of whole records when the input is known to
    hold no duplicates, or when records that are equal in everything are to stay apart."""
    require(df, REQUIRED)
    base = dedup(df) if distinct else df
    rows = scaled_bins(time_keys(base, "Date_TS"), ["Lat_Bin", "Lng_Bin"])
    rows = rows if row_id else rows.withColumn("_tie", tie_hash([quoted(c) for c in df.columns]))
    tie: Sequence[str] = [row_id] if row_id else ["_tie"]
    # Stored once with a number for each row: every feature below reads just its columns from there.
    rows = numbered(rows, "_row")
    # The history features are computed on the few columns they need and joined to the records once.
    slim = rows.select(*dict.fromkeys(["_row", *tie, "Date_TS", "Beat", "CrimeType", "Hour"]))
    slim = windows.rolling_range_count(slim, ["Beat"], "Date_TS", "Crime_Count_Last7Days")
    slim = windows.prior_density(slim, "Date_TS", tie, "CrimeType", "Hour", "CrimeType_Hour_Density")
    out = rows.join(slim.select("_row", "Crime_Count_Last7Days", "CrimeType_Hour_Density"), "_row").drop("_row", "_tie")
    # The small tables are computed from the records before the window columns, which they do not need.
    out = join_back(out, monthly_features(rows), ["Beat", "YearMonthDate"])
    out = join_back(out, daily_cell_features(rows, per_cell), CELL).drop(*CELL[2:])
    return fill_nulls(out, ["Crime_Count_Last7Days", "PrevDay_CrimeCount"])
