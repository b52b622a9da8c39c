"""Calendar features of a timestamp or date column. All of them are plain column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Season by month, time slot by hour, bands of years, eras.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
LAST_SEASON = "Fall"
YEAR_BANDS = ((2001, 2005), (2006, 2010), (2011, 2015), (2016, 2020))
LAST_YEAR_BAND = "2021–2025"
COVID_YEARS = (2020, 2021)
REFORM_YEAR = 2016

# US public holidays. Fixed dates are (month, day, first year); Monday and Thursday rules
# are (month, ISO weekday from 0 = Monday, earliest day, latest day, first year).
FIXED_HOLIDAYS = ((1, 1, 1871), (6, 19, 2021), (7, 4, 1871), (11, 11, 1938), (12, 25, 1871))
FLOATING_HOLIDAYS = (
    (1, 0, 15, 21, 1986),
    (2, 0, 15, 21, 1971),
    (5, 0, 25, 31, 1971),
    (9, 0, 1, 7, 1894),
    (10, 0, 8, 14, 1971),
    (11, 3, 22, 28, 1942),
)


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """Year, Month, Hour, Weekday (1 = Sunday) and IsWeekend."""
    weekday = F.dayofweek(ts)
    return df.withColumns({
        "Year": F.year(ts),
        "Month": F.month(ts),
        "Hour": F.hour(ts),
        "Weekday": weekday,
        "IsWeekend": weekday.isin(1, 7).cast("int"),
    })


def calendar_parts_monday(df: DataFrame, day: str) -> DataFrame:
    """Weekday (0 = Monday), IsWeekend and Month."""
    weekday = F.weekday(day)
    return df.withColumns({"Weekday": weekday, "IsWeekend": (weekday >= 5).cast("int"), "Month": F.month(day)})


def season(month: Column) -> Column:
    """Season name of a month number."""
    rules = [(month.isin(*months), name) for name, months in SEASONS.items()]
    return _choose(rules, LAST_SEASON)


def time_slot(hour: Column) -> Column:
    """Night, Morning, Afternoon or Evening."""
    rules = [((hour <= 5) | (hour >= 23), "Night"), (hour <= 11, "Morning"), (hour <= 17, "Afternoon")]
    return _choose([(test & hour.isNotNull(), name) for test, name in rules], "Evening")


def year_group(year: Column) -> Column:
    """Band of five years. Years outside all bands fall into the last one."""
    rules = [(year.between(first, last), f"{first}–{last}") for first, last in YEAR_BANDS]
    return _choose(rules, LAST_YEAR_BAND)


def era_flags(df: DataFrame, year: str = "Year") -> DataFrame:
    """Is_Covid_Era and Is_Post_Reform as 0 or 1."""
    flags = {"Is_Covid_Era": F.col(year).isin(*COVID_YEARS), "Is_Post_Reform": F.col(year) >= REFORM_YEAR}
    return df.withColumns({name: F.coalesce(test, F.lit(False)).cast("int") for name, test in flags.items()})


def _choose(rules: list[tuple[Column, str]], default: str) -> Column:
    first, *rest = rules
    return reduce(lambda chain, rule: chain.when(*rule), rest, F.when(*first)).otherwise(default)


def cyclic(value: Column, period: float, offset: float = 0.0) -> tuple[Column, Column]:
    """Sine and cosine of a periodic number."""
    angle = F.lit(2 * math.pi) * (value - F.lit(offset)) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def with_cyclic(df: DataFrame, weekday: str = "Weekday", month: str = "Month") -> DataFrame:
    """DoW_sin, DoW_cos, Mon_sin and Mon_cos."""
    day_sin, day_cos = cyclic(F.col(weekday), 7)
    month_sin, month_cos = cyclic(F.col(month), 12, offset=1)
    return df.withColumns({"DoW_sin": day_sin, "DoW_cos": day_cos, "Mon_sin": month_sin, "Mon_cos": month_cos})


def _fixed_holiday(day: Column) -> Column:
    tests = [(F.month(day) == month) & (F.dayofmonth(day) == number) & (F.year(day) >= since)
             for month, number, since in FIXED_HOLIDAYS]
    return reduce(Column.__or__, tests)


def holiday_flag(day: Column) -> Column:
    """1 on a US public holiday or on the working day it is observed on, else 0.

    A fixed date on a Saturday is observed on the Friday before, on a Sunday on the Monday after. The
    rules are evaluated per row inside the generated code, so no holiday table has to be joined.
    """
    floating = [
        (F.month(day) == month) & (F.weekday(day) == weekday) & F.dayofmonth(day).between(first, last)
        & (F.year(day) >= since)
        for month, weekday, first, last, since in FLOATING_HOLIDAYS
    ]
    observed = ((F.weekday(day) == 4) & _fixed_holiday(F.date_add(day, 1))) | (
        (F.weekday(day) == 0) & _fixed_holiday(F.date_sub(day, 1)))
    return reduce(Column.__or__, floating, _fixed_holiday(day) | observed).cast("int")


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Whole seconds since 1970. A timestamp without time zone is read as UTC, whatever the session zone is."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        second_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
        return F.unix_date(F.to_date(ts)).cast("long") * 86400 + second_of_day
    return F.unix_seconds(ts)


def time_keys(df: DataFrame, ts: str) -> DataFrame:
    """Date_Only, Timestamp_Unix and YearMonthDate (first day of the month)."""
    return df.withColumns({
        "Date_Only": F.to_date(ts),
        "Timestamp_Unix": epoch_seconds(df, ts),
        "YearMonthDate": F.trunc(F.to_date(ts), "MONTH"),
    })


def week_key(ts: str | Column) -> Column:
    """Monday of the week as a date."""
    return F.to_date(F.date_trunc("week", ts))


def min_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows from the first second of ``year`` on.

    The test is on the raw column, not on ``year(ts)``, so that it reaches the Parquet scan. Tables
    partitioned by ``Year`` are pruned as well.
    """
    kind = "timestamp_ntz" if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else "timestamp"
    if isinstance(df.schema[ts].dataType, T.DateType):
        kind = "date"
    start = F.lit(f"{year:04d}-01-01").cast(kind)
    kept = df.filter(F.col(ts) >= start)
    return kept.filter(F.col("Year") >= year) if "Year" in df.columns else kept
