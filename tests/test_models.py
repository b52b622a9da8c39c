"""Properties the fitted models must have."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wardscope import sources
from wardscope.functions import numeric
from wardscope.models import boosting, clusters, embeddings, forecast, hotspot, linear, multiclass


@pytest.fixture(scope="module")
def counts(spark):
    r = random.Random(4)
    rows = []
    for i in range(600):
        a, b = r.random(), r.random()
        mean = 1 + 8 * (a > 0.5) + 3 * b
        y = sum(r.random() < mean / 40 for _ in range(40))
        rows.append((i, a, b, y, 0.5 + r.random(), i % 5 == 0))
    df = spark.createDataFrame(rows, "id int, a double, b double, y int, w double, v boolean")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def test_every_profile_is_nearest_to_its_own_centre(spark):
    r = random.Random(2)
    rows = [(str(i), *(r.random() + (3 if i % 3 == j else 0) for j in range(3))) for i in range(40)]
    profile = spark.createDataFrame(rows, "k string, x double, y double, z double")
    model, assembled = clusters.fit_profiles(profile, ["x", "y", "z"], 3, starts=3)
    centres = [list(c) for c in model.clusterCenters()]
    for row in model.transform(assembled).select("x", "y", "z", "Hour_Cluster").collect():
        distance = [sum((p - q) ** 2 for p, q in zip(row, c)) for c in centres]
        assert distance[row.Hour_Cluster] == min(distance)
    found = clusters.hour_clusters(profile, "k", 3, starts=3)
    assert found.select("Hour_Cluster").distinct().count() == 3 and found.count() == 40


def test_one_finite_vector_per_node(spark):
    walks = spark.createDataFrame([(0, "a", ["a", "b", "a"]), (1, "b", ["b", "c", "b"])], "walk int, start string, path array<string>")
    rows = embeddings.walk_embeddings(walks, "k", 4).collect()
    assert sorted(r.k for r in rows) == ["a", "b", "c"] and all(abs(v) < 10 for r in rows for v in r[1:]) and len(rows[0]) == 5
    assert embeddings.walk_embeddings(walks.limit(0), "k", 4).count() == 0


def test_poisson_regression_balances_residuals(counts):
    model = linear.poisson_glm(counts.drop("features"), "y", ["a", "b"], "w", alpha=0.0)
    row = model.predict(counts.drop("features"), "p").agg(
        F.sum(F.col("w") * (F.col("y") - F.col("p"))), F.sum(F.col("w") * F.col("a") * (F.col("y") - F.col("p"))), F.sum("y")).first()
    assert abs(row[0]) < 1e-3 * row[2] and abs(row[1]) < 1e-3 * row[2]


def test_poisson_boost_loss_falls(counts):
    model = boosting.poisson_boost(counts, "y", "features", 8, 2, 0.3, 5, "w")
    losses = [h["train"] for h in model.history]
    assert all(later < earlier + 1e-12 for earlier, later in zip(losses, losses[1:]))
    scored = model.predict(counts, "p")
    mean = counts.agg(F.avg("y")).first()[0]
    better, worse = scored.agg(F.avg(F.abs(F.col("y") - F.col("p"))), F.avg(F.abs(F.col("y") - F.lit(mean)))).first()
    assert better < 0.8 * worse
    assert model.training_history(counts).count() == 8


def test_poisson_boost_keeps_the_best_round(counts):
    model = boosting.poisson_boost(counts, "y", "features", 12, 6, 0.9, 1, valid="v", patience=2)
    losses = [h["valid"] for h in model.history]
    assert len(model.trees) == losses.index(min(losses)) + 1


def test_boosted_trees_survive_storage(counts, tmp_path):
    for model in (boosting.poisson_boost(counts, "y", "features", 2, 2, 0.3),
                  boosting.quantile_boost(counts, "y", "features", 0.8, 2, learning_rate=0.3)):
        path = str(tmp_path / model.link)
        model.save(counts, path)
        again = boosting.BoostedTrees.load(counts, path)
        both = again.predict(model.predict(counts, "p"), "q")
        assert both.filter(F.abs(F.col("p") - F.col("q")) > 1e-12).isEmpty()


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 1.0), (1, 3.0, 8.0), (2, 5.0, 1.0)], "k int, v double, w double")
    assert boosting.weighted_quantiles(df, "k", F.col("v"), F.col("w"), 0.2) == {1: 2.0, 2: 5.0}
    assert boosting.weighted_quantiles(df, "k", F.col("v"), F.col("w"), 0.5) == {1: 3.0, 2: 5.0}


def test_bands_cover_the_wanted_share(counts):
    low, high = boosting.quantile_bands(counts, "y", "features", rounds=12, learning_rate=0.3)
    scored = high.predict(low.predict(counts, "lo"), "hi")
    below, under = scored.agg(F.avg((F.col("y") < F.col("lo")).cast("int")), F.avg((F.col("y") < F.col("hi")).cast("int"))).first()
    assert below < 0.3 and 0.65 < under < 0.95


def test_zero_inflation_is_found(spark):
    r = random.Random(9)
    rows = []
    for i in range(1500):
        x = r.random()
        y = 0 if r.random() < 0.4 else sum(r.random() < (4 + 4 * x) / 60 for _ in range(60))
        rows.append((x, r.random(), y))
    df = spark.createDataFrame(rows, "x double, z double, y int")
    model = linear.zinb(df, "y", ["x", "z"], rounds=6)
    scored = model.zero_probability(model.predict(df, "p"))
    zeros, fitted, actual, mean = scored.agg(F.avg((F.col("y") == 0).cast("int")), F.avg("p_zero"), F.avg("y"), F.avg("p")).first()
    assert abs(zeros - fitted) < 0.05 and abs(actual - mean) < 0.1 * actual
    without = linear.zinb(df.filter("y > 0"), "y", ["x", "z"], rounds=2)
    assert without.zeros is None and without.predict(df, "p").filter("p is null").isEmpty()


def test_forecast_dates_and_counts(spark):
    rows = [(k, dt.date(2024, 2, d), d % 4) for k in ("a", "b") for d in range(1, 20 if k == "a" else 4)]
    series = spark.createDataFrame(rows, "k string, d date, n int")
    scorer = forecast.linear_scorer({"Crime_Lag_1Day_Beat": 1.0, "Crime_Lag_21Day_Beat": 100.0}, 0.6)
    low, high = forecast.linear_scorer({}, 5.0), forecast.linear_scorer({}, -1.0)
    table = forecast.forecast(series, "k", "d", "n", scorer, 3, (low, high)).collect()
    assert [(r.Beat, str(r.Date)) for r in table] == [
        ("b", "2024-02-04"), ("b", "2024-02-05"), ("b", "2024-02-06"),
        ("a", "2024-02-20"), ("a", "2024-02-21"), ("a", "2024-02-22")]
    assert all(r.CrimeCount_Pred >= 0 and (r.q_low, r.q_hi) == (0.0, 5.0) for r in table)
    by_key = {k: [r.CrimeCount_Pred for r in table if r.Beat == k] for k in "ab"}
    # The third step of "a" reaches back 21 rows, to its first count of 1.
    assert by_key == {"a": [4, 5, 106], "b": [4, 5, 6]}


def test_multiclass_beats_the_majority(spark):
    r = random.Random(6)
    rows = [(i, r.random(), r.random(), r.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, noise double").withColumn("label", F.floor(F.col("a") * 3).cast("int"))
    assembled = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).withColumn("v", F.col("id") % 5 == 0)
    model = multiclass.multiclass_boost(assembled, "label", "features", [0, 1, 2], valid="v", rounds=4, depth=3)
    scored = model.predict(assembled)
    assert scored.filter("label = prediction").count() > 280
    assert scored.filter(F.abs(F.aggregate("probability", F.lit(0.0), lambda x, y: x + y) - 1) > 1e-9).isEmpty()
    assert model.importances()[0] > 0.9
    chosen = multiclass.cv_select_features(df, "label", ["a", "b", "noise"], ["id"], 2, 1, trees=5, depth=3)
    assert chosen == ["a"]


@pytest.mark.parametrize(("kind", "focal"), [("logistic", 0), ("logistic", 2), ("perceptron", 0)])
def test_hotspot_classifier_finds_the_signal(spark, kind, focal):
    r = random.Random(8)
    rows = [(x, r.random(), int(x > 0.8)) for x in (r.random() for _ in range(300))]
    df = spark.createDataFrame(rows, "x double, z double, y int")
    model = hotspot.hotspot_classifier(df, "y", ["x", "z"], kind, focal, hidden=8)
    means = {row.y: row.p for row in model.predict(df, "p").groupBy("y").agg(F.avg("p").alias("p")).collect()}
    assert means[1] > means[0] + 0.2 and len(model.history) == (0 if kind == "perceptron" else 1 + focal)


def test_stored_model_predicts_the_same(spark, counts, tmp_path):
    model = linear.poisson_glm(counts.drop("features"), "y", ["a", "b"])
    path = str(tmp_path / "glm")
    sources.save_model(model.regression, path)
    again = linear.PoissonModel(model.scaler, sources.load_model(path).stages[0])
    rows = again.predict(model.predict(counts.drop("features"), "p"), "q")
    assert rows.filter(F.col("p") != F.col("q")).isEmpty()


def test_stored_poisson_model_scores_a_fresh_table(spark, tmp_path):
    from wardscope import sources
    from wardscope.models import linear

    rows = spark.range(200).selectExpr("id", "cast(id % 7 AS double) AS a", "cast(id % 5 AS double) AS `b c`", "1.0D AS same", "id % 7 + id % 3 AS n")
    model = linear.poisson_glm(rows, "n", ["a", "b c", "same"])
    sources.save_model(model.pipeline(), str(tmp_path / "model"))
    again = sources.load_model(str(tmp_path / "model")).transform(rows).select("id", "_mu")
    both = model.predict(rows).join(again, "id").collect()
    assert len(both) == 200 and all(abs(r.prediction - r._mu) < 1e-9 for r in both)


@pytest.mark.parametrize("alpha", [0.2, 0.5, 0.8])
def test_weighted_quantiles_are_exact(spark, alpha):
    import random

    from wardscope.models.boosting import weighted_quantiles

    draw = random.Random(2)
    rows = [(draw.randint(0, 2), draw.random() / 500, draw.choice([0.5, 1.0, 2.0])) for _ in range(300)]
    found = weighted_quantiles(spark.createDataFrame(rows, "k int, v double, w double"), "k", F.col("v"), F.col("w"), alpha)
    for k in range(3):
        own = sorted((v, w) for kk, v, w in rows if kk == k)
        total, so_far = sum(w for _, w in own), 0.0
        for v, w in own:
            so_far += w
            if so_far >= alpha * total * (1 - 1e-12):
                assert found[k] == v
                break


def test_gamma_functions(spark):
    points = [1e-3, 0.1, 0.5, 1.0, 2.5, 7.0, 40.0, 1e4]
    row = spark.createDataFrame([(x,) for x in points], "x double").select(
        "x", numeric.log_gamma(F.col("x")).alias("g"), numeric.digamma(F.col("x")).alias("d"), numeric.trigamma(F.col("x")).alias("t")).collect()
    for r in row:
        near = r.x * 1e-4
        slope = (math.lgamma(r.x + near) - math.lgamma(r.x - near)) / (2 * near)
        assert r.g == pytest.approx(math.lgamma(r.x), rel=1e-9, abs=1e-9) and r.d == pytest.approx(slope, rel=1e-6, abs=1e-6)
        assert r.t == pytest.approx(sum(1 / (r.x + k) ** 2 for k in range(4000)) + 1 / (r.x + 3999.5), rel=1e-6)


@pytest.mark.parametrize("shape", [0.3, 2.0, 30.0, None])
def test_dispersion_is_the_numerical_optimum(spark, shape):
    r = np.random.default_rng(5)
    mu = r.uniform(0.5, 8, 1500)
    y = r.poisson(mu * (r.gamma(shape, 1 / shape, 1500) if shape else 1.0)) if shape else np.rint(mu)
    w = r.uniform(0, 1, 1500)
    got = linear.best_dispersion(spark.createDataFrame(list(zip(map(float, y), map(float, mu), map(float, w))), "y double, mu double, w double"), "y", "mu", "w")
    lgamma = np.vectorize(math.lgamma)

    def likelihood(log_size):
        size = math.exp(log_size)
        return float((w * (lgamma(y + size) - math.lgamma(size) - size * np.log1p(mu / size) + y * np.log(mu / (size + mu)))).sum())

    grid = np.linspace(-math.log(1e4), -math.log(1e-4), 4001)
    best = max(likelihood(x) for x in grid)
    assert likelihood(-math.log(got)) >= best - 1e-6 and (shape is not None or got == pytest.approx(1e-4))


def test_zero_inflated_likelihood_never_falls(spark):
    r = np.random.default_rng(8)
    x, z = r.normal(size=(2, 2000))
    y = np.where(r.random(2000) < 0.3, 0, r.poisson(np.exp(0.8 + 0.5 * x) * r.gamma(2.0, 0.5, 2000)))
    df = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(x, z, y)], "x double, z double, y int")
    model = linear.zinb(df, "y", ["x", "z"], rounds=8, tolerance=0.0)
    assert len(model.history) > 3 and model.history == sorted(model.history) and 0.3 < model.dispersion < 0.8
    rows = model.parts(df).select("y", "_mu", "_pi").collect()
    size = 1 / model.dispersion
    own = sum(math.log((p if n == 0 else 0.0) + (1 - p) * math.exp(
        math.lgamma(n + size) - math.lgamma(size) - math.lgamma(n + 1) - size * math.log1p(m / size) + n * math.log(m / (size + m)))) for n, m, p in rows)
    assert model.history[-1] == pytest.approx(own, rel=1e-9)
