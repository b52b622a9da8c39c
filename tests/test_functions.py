"""Cleaning, calendar and category functions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardscope.functions import calendar, categories, cleaning, numeric


def test_timestamps_of_both_formats(spark):
    rows = [("03/05/2021 11:15:00 PM",), ("2021-03-05 23:15:00",), ("05.03.2021",), (None,)]
    df = cleaning.with_timestamp(spark.createDataFrame(rows, "d string"), "d", "ts")
    assert [r.ts for r in df.collect()] == [dt.datetime(2021, 3, 5, 23, 15)] * 2


def test_flags(spark):
    df = spark.createDataFrame([("true",), (" False ",), ("maybe",), (None,)], "a string")
    assert [r[0] for r in df.select(cleaning.bool_flag(df, "a")).collect()] == [1, 0, None, None]
    assert [r[0] for r in df.select(cleaning.bool_flag(df, "b")).collect()] == [0] * 4
    logical = spark.createDataFrame([(True,), (False,)], "a boolean")
    assert [r[0] for r in logical.select(cleaning.bool_flag(logical, "a")).collect()] == [1, 0]


def test_geo_bins(spark):
    df = spark.createDataFrame([(41.876, -87.654), (None, 1.0)], "Latitude double, Longitude double")
    assert [tuple(r)[2:] for r in cleaning.geo_bin(df).collect()] == [(41.88, -87.65)]
    absent = cleaning.geo_bin(spark.range(1)).first()
    assert (absent.Lat_Bin, absent.Lng_Bin) == (None, None)


@pytest.mark.parametrize(("day", "flag"), [
    ("2021-07-04", 1), ("2021-07-05", 1), ("2021-07-06", 0), ("2020-07-03", 1), ("2021-12-31", 1), ("2022-01-01", 1),
    ("2021-06-18", 1), ("2021-06-19", 1), ("2020-06-19", 0), ("2024-11-28", 1), ("2024-11-21", 0), ("2024-05-27", 1),
    ("2024-01-15", 1), ("1985-01-21", 0), ("2024-02-19", 1), ("2024-09-02", 1), ("2024-10-14", 1), ("2024-11-11", 1),
    ("2024-12-25", 1), ("2024-12-26", 0)])
def test_holidays(spark, day, flag):
    df = spark.range(1).select(F.lit(day).cast("date").alias("d"))
    assert df.select(calendar.holiday_flag(F.col("d"))).first()[0] == flag


def test_week_edges(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 23, 59),), (dt.datetime(2024, 1, 8),)], "ts timestamp")
    assert [r[0] for r in df.select(calendar.week_key("ts")).collect()] == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]


def test_seconds_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.9' AS ts, timestamp_ntz'1969-12-31 23:59:59' AS old")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = df.select(calendar.epoch_seconds(df, "ts"), calendar.epoch_seconds(df, "old")).first()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(row) == (1704067207, -1)


def test_min_year_reaches_the_scan(spark, small):
    plan = calendar.min_year(spark.read.parquet(f"{small}/orders.parquet"), "o_orderdate", 1998)
    assert "GreaterThanOrEqual(o_orderdate" in plan._jdf.queryExecution().executedPlan().toString()


def test_rules_take_the_first_match(spark):
    df = spark.createDataFrame([("UNDER OVER",), ("DOMESTIC",), ("x",), (None,)], "t string")
    rules = categories.contains_rules(F.col("t"), categories.DESCRIPTION_RULES)
    assert [r[0] for r in df.select(rules).collect()] == ["UNDER_500", "DOMESTIC", "OTHER", "OTHER"]
    codes = categories.prefix_rules(F.col("t"), (("UND", "u"), ("", "rest")), "none")
    assert [r[0] for r in df.select(codes).collect()] == ["u", "rest", "rest", "none"]


def test_narrow_types(spark):
    rows = [(1, 300, 2 ** 40, 0.5, 123456.7931, "a"), (2, -5, 1, 1.5, 2.0, None)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d double, e double, t string")
    narrowed, texts = numeric.narrow_types(df)
    kinds = dict(narrowed.dtypes)
    assert (kinds["a"], kinds["b"], kinds["c"], kinds["d"], kinds["e"]) == ("tinyint", "smallint", "bigint", "float", "double")
    assert texts == ["t"]
    many = spark.range(1000).select(F.col("id").cast("string").alias("t"))
    assert numeric.narrow_types(many)[1] == [] and numeric.narrow_types(many.limit(999))[1] == ["t"]


def test_bands_and_predictions(spark):
    df = spark.createDataFrame([(5.0, 2.0, 2.5), (-3.0, -1.0, 3.5), (1.0, 2.0, float("nan"))], "a double, b double, p double")
    low, high = numeric.order_bands(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(low, high).collect()] == [(2.0, 5.0), (0.0, 0.0), (1.0, 2.0)]
    found = numeric.clip_predictions(df, "p", "c", "i").select("c", "i").collect()
    assert [tuple(r) for r in found] == [(2.5, 2), (3.5, 4), (0.0, 0)]


def test_numbers_from_anything(spark):
    df = spark.createDataFrame([("7", dt.date(2024, 1, 1), float("nan"), True), ("x", None, None, None)],
                               "t string, d date, f double, b boolean")
    found = cleaning.to_number_or_zero(df, ["t", "d", "f", "b"]).collect()
    assert [tuple(r) for r in found] == [(7.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 0.0)]
