"""Series operators, aggregates and joins on hand-made frames."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardscope import schema
from wardscope.operators import aggregates as agg
from wardscope.operators import joins, sampling, scaling
from wardscope.operators import windows as win

D = dt.date


@pytest.fixture
def series(spark):
    # Day 4 is missing: lags count rows, not days.
    rows = [("a", D(2024, 1, d), n) for d, n in ((1, 2), (2, 4), (3, 6), (5, 8))] + [("b", D(2024, 1, 1), 10)]
    return spark.createDataFrame(rows, "k string, d date, n long")


def values(df, name):
    return [r[0] for r in df.orderBy("k", "d").select(name).collect()]


def test_lags_and_means(series):
    assert values(win.lag_by(series, ["k"], ["d"], "n", {"p": 1}), "p") == [None, 2, 4, 6, None]
    assert values(win.rolling_mean(series, ["k"], ["d"], "n", {"m": 3}), "m") == [2, 3, 4, 6, 10]
    assert values(win.rolling_mean(series, ["k"], ["d"], "n", {"m": 3}, shift=1), "m") == [None, 2, 3, 4, None]
    assert values(win.rolling_mean_strict(series, ["k"], ["d"], "n", "m"), "m") == [None, None, None, 4, None]


def test_positional_slice(series):
    assert values(win.positional_slice(series, ["k"], "d", 0.85, "fit"), "fit") == [True, True, True, True, False]
    assert values(win.positional_slice(series.limit(1), ["k"], "d", 0.1, "fit"), "fit") == [True]


def test_hotspot_label_is_strict(spark):
    rows = [("a", w, n) for w, n in enumerate((1, 2, 3, 4, 4))]
    found = agg.hotspot_label(spark.createDataFrame(rows, "k string, w int, crime_count long"), "k").orderBy("w").collect()
    assert [r.threshold for r in found] == [4.0] * 5 and [r.is_hotspot for r in found] == [0] * 5


def test_mode_first_last(spark):
    rows = [("a", 1, 5), ("a", 2, 3), ("a", 3, 3), ("a", 4, 5), ("b", 1, None), ("c", 1, None), ("c", 2, 7)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    assert dict(map(tuple, agg.mode_by(df, "k", "v").collect())) == {"a": 3, "b": 0, "c": 7}
    assert dict(map(tuple, agg.first_by(df, "k", ["v"], ["t"]).collect())) == {"a": 5, "b": None, "c": 7}
    assert dict(map(tuple, agg.last_by(df, "k", ["v"], ["t"]).collect())) == {"a": 5, "b": None, "c": 7}


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "k string, d date, n long")
    assert agg.global_quantile_cap(empty, "n", "o", "c").count() == 0
    assert win.positional_slice(empty, ["k"], "d", 0.5, "f").count() == 0
    assert sampling.stable_sample(empty, ["k"], 5).count() == 0
    with pytest.raises(ValueError):
        sampling.choose_split_date(empty, "d")
    with pytest.raises(ValueError):
        sampling.time_split(empty, "d", "2024-01-01")


def test_split_date(spark):
    days = spark.createDataFrame([(D(2021, 12, 25) + dt.timedelta(days=i),) for i in range(10)], "d date")
    assert sampling.choose_split_date(days, "d") == D(2022, 1, 1)
    assert sampling.choose_split_date(days.filter("d < '2022-01-01'"), "d") == D(2021, 12, 30)
    assert sampling.choose_split_date(days, "d", "2020-02-03") == D(2020, 2, 3)


def test_joins(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    rows = {r.x: r.y for r in joins.null_safe_join(left, right, ["k"]).collect()}
    assert rows == {1: 10, 2: 20, 3: None}
    assert {r.x: r.y for r in joins.join_back(left, right, ["k"]).collect()} == {1: 10, 2: None, 3: None}
    assert [r.x for r in joins.join_required(left, right, ["k"]).collect()] == [1]
    assert {r.x: r.y for r in joins.lookup(left, right, "k", "y", 0).collect()} == {1: 10, 2: 0, 3: 0}


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, None, 3)], "`a b` int, c_x int, c_y int")
    with pytest.raises(ValueError):
        schema.require(df, ["a b", "missing"])
    assert schema.select_available(df, ["c_y", "none", "c_y"], ["c_"]) == ["c_y", "c_x"]
    merged = schema.merge_suffixed(df, ["c", "other"])
    assert merged.columns == ["a b", "c"] and merged.first()[1] == 3


def test_standardizer(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    fitted = scaling.Standardizer.fit(df, ["x", "c"])
    assert [tuple(r) for r in fitted.transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([(5.0, 7.0)], "x double, c double")
    assert tuple(fitted.transform(other).first()) == (3.0, 0.0)


def test_encode_categoricals_covers_both_parts(spark):
    train = spark.createDataFrame([("b",), (None,)], "c string")
    test = spark.createDataFrame([("a",), ("_NA_",)], "c string")
    first, second, tables = scaling.encode_categoricals(train, test, ["c"])
    assert sorted(r.c for r in first.collect()) == [0, 2] and sorted(r.c for r in second.collect()) == [0, 1]
    assert tables["c"].count() == 3


def test_weights_and_quantiles(spark, series):
    weights = {r.k: r.weight for r in agg.balanced_class_weights(series, "k").collect()}
    assert weights == pytest.approx({"a": 5 / (2 * 4), "b": 5 / 2})
    capped = agg.global_quantile_cap(series, "n", "o", "c", 0.5)
    assert values(capped, "o") == [False, False, False, True, True] and values(capped, "c") == [2, 4, 6, 6, 6]
    summary = agg.target_summary(series, "n").first()
    assert tuple(summary) == (6.0, 6.0)


def test_category_mix_rows_add_up(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None), ("b", "x")], "k string, c string")
    rows = {r.k: (r.x, r.y) for r in agg.category_mix(df, "k", "c", ["x", "y"]).collect()}
    assert rows == {"a": (0.5, 0.5), "b": (1.0, 0.0)}
    assert agg.category_values(df, "c") == ["x", "y"]
    with pytest.raises(ValueError):
        agg.category_values(df, "c", 1)


def test_hour_profile_derives_the_hour(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h)) for h in (0, 0, 23, 5)], "k string, ts timestamp")
    row = agg.hour_profile(df, "k", ts="ts").first()
    assert (row.h0, row.h5, row.h23, row.h1) == (0.5, 0.25, 0.25, 0.0)
    assert sum(row[f"h{h}"] for h in range(24)) == pytest.approx(1)


def test_latest_row_takes_the_last_id_of_a_tie(spark):
    t = dt.datetime(2024, 1, 7, 23, 59)
    rows = [(1, "a", t), (2, "a", t), (3, "a", t + dt.timedelta(minutes=1))]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp").withColumn("w", F.to_date(F.date_trunc("week", "ts")))
    assert sorted(r.id for r in win.latest_per(df, ["k", "w"], "ts", ["id"]).collect()) == [2, 3]


def test_positional_slice_orders_numbers_as_numbers(spark):
    df = spark.createDataFrame([(9, 1), (10, 1), (10, 2), (100, 1)], "k int, day int")
    found = windows_of(df)
    assert found == {(9, 1): True, (10, 1): True, (10, 2): False, (100, 1): False}


def windows_of(df):
    from wardscope.operators.windows import positional_slice

    return {(r.k, r.day): r.first for r in positional_slice(df, ["k"], "day", 0.5, "first").collect()}


def test_row_before_across_ranges(spark):
    """A hot key in many ranges, null keys, null values and equal days, against plain windows."""
    r = random.Random(3)
    rows = [(i, r.choice(["hot"] * 8 + ["b", "c", None]), r.randrange(60) if i % 50 else None, r.choice([None, 1, 2, 3])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string, day int, n int")
    got = {x.id: x.prev for x in win.prev_row(df, ["k"], ["day", "id"], "n", "prev").collect()}
    wanted, last = {}, {}
    for i, k, day, n in sorted(rows, key=lambda x: (x[2] is not None, x[2] or 0, x[0])):
        wanted[i], last[k] = last.get(k), n
    assert got == wanted
    assert win.prev_row(df.limit(0), ["k"], ["day"], "n", "prev").count() == 0
