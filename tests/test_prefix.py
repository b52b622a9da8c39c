"""Split running totals, range counts, codes and quantiles against plain windows and brute force."""

from __future__ import annotations

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardscope.operators import windows as win
from wardscope.operators.prefix import range_totals, sorted_codes
from wardscope.operators.quantiles import CUTS, SKETCH_ACCURACY, exact_quantiles
from wardscope.operators.sampling import stable_sample, stratified_folds, stratified_split

DAY0 = dt.datetime(2024, 3, 1)


def incidents(spark, n=400, hot=0.4, seed=7):
    """Records of which a large part shares one key and one second; some keys and flags are null."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if r.random() < hot else r.choice(["a", "b", None, "c"])
        second = 3600 if key == "hot" and r.random() < 0.7 else r.randrange(20 * 86_400)
        rows.append((i, DAY0 + dt.timedelta(seconds=second), key, r.choice(["x", "y"]), r.choice([0, 1, None])))
    return spark.createDataFrame(rows, "id int, ts timestamp, key string, kind string, flag int")


def brute(rows, i, keys):
    """Earlier rows of the same keys, ties ordered by the hash of the id."""
    def place(row):
        return row.ts, hashlib.md5(str(row.id).encode()).hexdigest()

    return [r for r in rows if place(r) < place(i) and all(getattr(r, k) == getattr(i, k) for k in keys)]


@pytest.mark.parametrize("hot_rows", [10_000_000, 40, 0])
def test_prior_history_equals_brute_force(spark, hot_rows):
    df = incidents(spark).cache()
    found = win.prior_history(df, "ts", ["id"], {"n_key": ["key"], "n_both": ["key", "kind"]},
                              {"rate": (["key"], "flag")}, hot_rows)
    rows = df.collect()
    by_id = {r.id: r for r in found.collect()}
    assert len(by_id) == len(rows)
    for row in rows:
        past = brute(rows, row, ["key"])
        assert by_id[row.id].n_key == len(past)
        assert by_id[row.id].n_both == len(brute(rows, row, ["key", "kind"]))
        flags = [r.flag for r in past if r.flag is not None]
        if flags:
            assert by_id[row.id].rate == pytest.approx(100 * sum(flags) / len(flags), abs=0.00501)
        else:
            assert by_id[row.id].rate is None


@pytest.mark.parametrize("hot_rows", [10_000_000, 5])
def test_single_key_set_and_partitioning(spark, hot_rows):
    df = incidents(spark, seed=3)
    once = win.prior_counts(df, "ts", ["id"], {"n": ["key"]}, hot_rows)
    again = win.prior_counts(df.repartition(7, "kind"), "ts", ["id"], {"n": ["key"]}, hot_rows)
    assert sorted(once.select("id", "n").collect()) == sorted(again.select("id", "n").collect())
    window = Window.partitionBy("key").orderBy(F.unix_seconds("ts"), F.md5(F.col("id").cast("string")))
    plain = df.select("id", (F.row_number().over(window) - 1).cast("long").alias("n"))
    assert sorted(once.select("id", "n").collect()) == sorted(plain.collect())


def test_history_does_not_see_the_future(spark):
    df = incidents(spark, seed=5)
    cut = DAY0 + dt.timedelta(days=8)
    changed = df.withColumn("flag", F.when(F.col("ts") >= F.lit(cut), 1).otherwise(F.col("flag"))).withColumn(
        "kind", F.when(F.col("ts") >= F.lit(cut), "z").otherwise(F.col("kind")))

    def early(frame):
        out = win.prior_history(frame, "ts", ["id"], {"n": ["kind"]}, {"rate": (["key"], "flag")})
        out = win.rolling_range_count(out, ["key"], "ts", "last7")
        return sorted(map(str, out.filter(F.col("ts") < F.lit(cut)).select("id", "n", "rate", "last7").collect()))

    assert early(df) == early(changed)


def test_rolling_range_count(spark):
    df = incidents(spark, seed=11).cache()
    rows = df.collect()
    found = win.rolling_range_count(df, ["key"], "ts", "n", 86_400)
    for got in found.collect():
        span = [r for r in rows if r.key == got.key and dt.timedelta(0) < got.ts - r.ts <= dt.timedelta(days=1)]
        assert got.n == len(span)


def test_prior_density_without_history_is_null(spark):
    df = spark.createDataFrame([(1, DAY0, "k", 5), (2, DAY0 + dt.timedelta(hours=1), "k", 5)],
                               "id int, ts timestamp, cat string, part int")
    found = {r.id: r.d for r in win.prior_density(df, "ts", ["id"], "cat", "part", "d").collect()}
    assert found == {1: None, 2: 1.0}


def test_sigma_outlier(spark):
    start = dt.date(2024, 1, 1)
    counts = [5, 5, 5, 5, 6, 5, 40, 5]
    rows = [("a", start + dt.timedelta(days=i), n) for i, n in enumerate(counts)] + [("b", start, 9)]
    df = spark.createDataFrame(rows, "key string, day date, n long")
    found = win.sigma_outlier(df, ["key"], "day", ["key"], "n", "out").orderBy("key", "day").collect()
    # A constant history has no deviation, so 6 after four times 5 lies above it.
    assert [r.out for r in found] == [False, False, False, False, True, False, True, False, False]


def test_sorted_codes_are_positions(spark):
    words = ["beta", "alpha", "al", "alps", "zeta", "Ärger", "beta"]
    found = {r.w: r.code for r in sorted_codes(spark.createDataFrame([(w,) for w in words], "w string"), "w", "code").collect()}
    assert found == {w: i for i, w in enumerate(sorted(set(words)))}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.995, 1.0])
def test_exact_quantiles(spark, q):
    r = random.Random(1)
    rows = [(k, r.choice([r.gauss(0, 1), 1.5, 1e6]) if k != "one" else 2.0) for k in ("a", "b", None) for _ in range(101)]
    df = spark.createDataFrame([*rows, ("one", 2.0), ("none", None)], "k string, v double")
    found = {r.k: r.v for r in exact_quantiles(df, ["k"], "v", q, "v").collect()}
    wanted = {r.k: r.v for r in df.groupBy("k").agg(F.percentile("v", q).alias("v")).collect() if r.v is not None}
    assert found == pytest.approx(wanted)


def test_sample_and_splits(spark):
    df = spark.range(2000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    sample = stable_sample(df, ["id"], 100)
    assert sample.count() == 100
    assert sorted(sample.collect()) == sorted(stable_sample(df.repartition(5), ["id"], 100).collect())
    assert stable_sample(df, ["id"], 5000).count() == 2000
    split = stratified_split(df, "label", ["id"], 0.2)
    assert {tuple(r) for r in split.filter("is_test").groupBy("label").count().collect()} == {(0, 360), (1, 40)}
    folds = stratified_folds(df, "label", ["id"], 3).groupBy("label", "fold").count().collect()
    assert sorted(r[2] for r in folds) == [66, 67, 67, 600, 600, 600]


def test_equal_rows_keep_totals_of_their_own_with_several_key_sets(spark):
    rows = [(DAY0, "a", "x", 1)] * 3 + [(DAY0 + dt.timedelta(hours=1), "a", "y", 0)]
    df = spark.createDataFrame(rows, "ts timestamp, key string, kind string, flag int")
    found = win.prior_history(df, "ts", ["kind"], {"n_key": ["key"], "n_kind": ["kind"]}, {"rate": (["key"], "flag")})
    assert sorted((r.n_key, r.n_kind) for r in found.collect()) == [(0, 0), (1, 1), (2, 2), (3, 0)]


def test_codes_of_values_with_one_common_prefix_are_spread(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select(F.format_string("https://example.org/%06d", F.col("id") * 7).alias("w"))
    found = [(r.w, r.code) for r in sorted_codes(df, "w", "code").collect()]
    assert [c for _, c in sorted(found)] == list(range(5000))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_range_totals_equal_a_plain_window(spark, keys):
    r = random.Random(4)
    rows = [(i, r.choice(["hot", "hot", "hot", "a", None]), r.random(), r.choice([1, 5, None])) for i in range(4000)]
    df = spark.createDataFrame(rows, "i int, k string, v double, n int")
    found = {x.i: (x.t, x.n_before) for x in range_totals(df, keys, [-F.col("v")], {"t": F.col("n"), "n_before": F.lit(1)}).collect()}
    window = Window.partitionBy(*keys).orderBy(-F.col("v")).rowsBetween(Window.unboundedPreceding, -1)
    plain = df.select("i", F.coalesce(F.sum("n").over(window), F.lit(0)).alias("t"), F.count(F.lit(1)).over(window).alias("c")).collect()
    assert found == {x.i: (x.t, x.c) for x in plain}
    assert range_totals(df.limit(0), keys, [F.col("v")], {"t": F.col("n")}).count() == 0


def test_one_key_is_spread_over_ranges(spark, monkeypatch):
    from wardscope.operators import prefix

    kept = []
    plain = prefix.stored
    monkeypatch.setattr(prefix, "stored", lambda df: kept.append(plain(df)) or kept[-1])
    frame = spark.range(40_000).select(F.lit("one").alias("k"), (F.col("id") * 7919 % 40_009).alias("v"))
    assert range_totals(frame, ["k"], [F.col("v")], {"t": F.lit(1)}).agg(F.max("t")).first()[0] == 39_999
    sizes = [x["count"] for x in kept[0].groupBy("_range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2.5 * 40_000 / len(sizes)


def test_quantile_cuts_follow_ranks_not_values(spark):
    """One value far out leaves what has to be ordered as small as it is without it."""
    rows = spark.range(50_000).select(F.lit(1).alias("k"), F.when(F.col("id") == 0, 1e300).otherwise(F.col("id") / 50_000).alias("v"))
    assert exact_quantiles(rows, ["k"], "v", 0.5, "q").first().q == pytest.approx(rows.agg(F.percentile("v", 0.5)).first()[0], rel=1e-15)
    cuts = rows.agg(F.percentile_approx("v", [0.5 + s / SKETCH_ACCURACY for s in CUTS], SKETCH_ACCURACY)).first()[0]
    assert rows.filter((F.col("v") >= cuts[0]) & (F.col("v") < cuts[-1])).count() < 1500
    assert exact_quantiles(rows, ["k"], "v", 0.5, "q", accuracy=2).first().q == exact_quantiles(rows, ["k"], "v", 0.5, "q").first().q
