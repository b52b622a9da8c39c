"""Scaling, clusters, graph features and models."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.catalog.aggregations import daily
from wardscope.catalog.base import Tables, query, rounded, sql
from wardscope.evaluation.classification import feature_importance
from wardscope.functions.calendar import week_key
from wardscope.models import boosting, forecast, hotspot, linear, multiclass
from wardscope.models.clusters import hour_clusters
from wardscope.models.embeddings import walk_embeddings
from wardscope.operators import aggregates as agg
from wardscope.operators import graph, scaling, spatial, windows
from wardscope.operators.sampling import literal_table

CENTRES = "c AS (SELECT beat, avg(lat) AS lat, avg(lng) AS lng FROM inc GROUP BY beat)"
EDGES = f"""{CENTRES}, e AS (SELECT * FROM (SELECT a.beat AS src, b.beat AS dst, 2 * 6371.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))) AS dist FROM c a JOIN c b ON a.beat <> b.beat)
    WHERE dist <= 4.0)"""


def edges(t: Tables) -> DataFrame:
    centres = agg.centroid_mean(t.incidents, "beat", "lat", "lng")
    return spatial.haversine_edges(centres, "beat", "lat", "lng", 4.0)


def samples(t: Tables) -> DataFrame:
    """Daily series with past features, assembled."""
    series = daily(t, long=True)
    series = windows.lag_by(series, ["beat"], ["day"], "n", {"lag1": 1, "lag7": 7})
    series = windows.rolling_mean(series, ["beat"], ["day"], "n", {"mean7": 7, "mean28": 28}, shift=1)
    series = series.withColumn("weekday", F.weekday("day")).fillna(0.0)
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(series)


FEATURES = ["lag1", "lag7", "mean7", "mean28", "weekday"]


@query("m1_standardize", sql(
    """SELECT id, round((k - avg(k) OVER ()) / stddev_pop(k) OVER (), 6) AS k, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6)
    AS value, 0.0::double AS one FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", "k", "value", F.lit(1.0).alias("one"))
    return rounded(scaling.standardize(rows, ["k", "value", "one"]), "k", "value")


@query("m2_encode_categoricals", sql(
    """+ v AS (SELECT id, coalesce(CASE WHEN id % 9 > 0 THEN kind END, '_NA_') AS kind, beat FROM inc)
    SELECT id, cast(dense_rank() OVER (ORDER BY kind) - 1 AS int) AS kind, cast(dense_rank() OVER (ORDER BY beat) - 1 AS int) AS beat FROM v""",
    "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", F.when(F.col("id") % 9 > 0, F.col("kind")).alias("kind"), "beat")
    train, test, _ = scaling.encode_categoricals(rows.filter("id % 5 > 0"), rows.filter("id % 5 = 0"), ["kind", "beat"])
    return train.unionByName(test)


@query("m3_hour_clusters")
def _(t: Tables) -> DataFrame:
    return hour_clusters(agg.hour_profile(t.incidents, "beat", ts="ts"), "beat")


# Places are few, so plain pair joins and a recursive closure give the clusters in SQL.
@query("m4_dbscan", sql(
    """+ z AS (SELECT id, lat, lng, (lat - avg(lat) OVER ()) / stddev_pop(lat) OVER () AS x, (lng - avg(lng) OVER ()) / stddev_pop(lng) OVER () AS y
      FROM inc),
    p AS (SELECT lat, lng, any_value(x) AS x, any_value(y) AS y, count(*) AS w FROM z GROUP BY lat, lng),
    n AS (SELECT p.*, row_number() OVER (ORDER BY lat, lng) AS i FROM p),
    near AS (SELECT a.i AS i, b.i AS j, b.w AS w FROM n a JOIN n b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.25),
    core AS (SELECT i FROM near GROUP BY i HAVING sum(w) >= (SELECT count(*) FROM inc) / 40.0),
    link AS (SELECT i, j FROM near WHERE i IN (SELECT i FROM core) AND j IN (SELECT i FROM core)),
    walk(i, j) AS (SELECT i, i FROM core UNION SELECT walk.i, link.j FROM walk JOIN link ON walk.j = link.i),
    comp AS (SELECT i, min(j) AS least FROM walk GROUP BY i),
    label AS (SELECT i, cast(dense_rank() OVER (ORDER BY least) - 1 AS int) AS c FROM comp),
    edge AS (SELECT near.i, min(c) AS c FROM near JOIN label ON near.j = label.i WHERE near.i NOT IN (SELECT i FROM core) GROUP BY near.i),
    every AS (SELECT * FROM label UNION ALL SELECT * FROM edge)
    SELECT id, coalesce(c, -1) AS "Spatial_Cluster" FROM inc JOIN n USING (lat, lng) LEFT JOIN every USING (i)""", "inc", recursive=True))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", "lat", "lng")
    dense = rows.count() / 40.0
    return spatial.spatial_clusters(rows, ["id"], "lat", "lng", None, 0.25, dense).select("id", "Spatial_Cluster")


@query("m5a_random_walks", sql(
    f"""+ {EDGES}, s AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS slot, count(*) OVER (PARTITION BY src) AS degree FROM e),
    starts AS (SELECT DISTINCT src FROM s),
    w(start, walk, step, place, path) AS (SELECT src, r.walk, 1, src, src FROM starts, range(0, 50) AS r(walk)
      UNION ALL SELECT start, walk, step + 1, dst, path || '>' || dst FROM w JOIN s ON w.place = s.src
        AND s.slot = ('0x' || substr(md5('42:' || start || ':' || walk || ':' || step), 1, 8))::bigint % s.degree WHERE step < 5)
    SELECT start, cast(walk AS int) AS walk, path FROM w WHERE step = 5""", "inc", recursive=True))
def _(t: Tables) -> DataFrame:
    walks = graph.random_walks(edges(t), 5, 50)
    return walks.select("start", "walk", F.concat_ws(">", "path").alias("path"))


@query("m5b_walk_embeddings")
def _(t: Tables) -> DataFrame:
    return walk_embeddings(graph.random_walks(edges(t), 5, 50), "beat")


@query("m6_poisson_glm")
def _(t: Tables) -> DataFrame:
    rows = samples(t)
    return linear.poisson_glm(rows, "n", FEATURES).predict(rows.drop("features")).select("beat", "day", "n", "prediction")


@query("m7_poisson_boost")
def _(t: Tables) -> DataFrame:
    rows = samples(t).withColumn("valid", F.col("day") >= F.lit("2000-06-01").cast("date"))
    model = boosting.poisson_boost(rows, "n", "features", valid="valid", **boosting.HISTOGRAM_STYLE)
    return model.predict(rows).select("beat", "day", "n", "prediction")


@query("m8_zinb")
def _(t: Tables) -> DataFrame:
    series = daily(t, long=True)
    span = series.groupBy("beat").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    days = span.select("beat", F.explode(F.sequence("a", "b")).alias("day"))
    dense = days.join(series, ["beat", "day"], "left").fillna(0, subset=["n"])
    dense = windows.rolling_mean(dense, ["beat"], ["day"], "n", {"mean7": 7, "mean28": 28}, shift=1)
    dense = dense.withColumn("weekday", F.weekday("day")).fillna(0.0)
    model = linear.zinb(dense, "n", ["mean7", "mean28", "weekday"])
    return model.zero_probability(model.predict(dense)).select("beat", "day", "n", "prediction", "p_zero")


@query("m9_quantile_bands")
def _(t: Tables) -> DataFrame:
    rows = samples(t)
    low, high = boosting.quantile_bands(rows, "n", "features")
    return high.predict(low.predict(rows, "q_low"), "q_hi").select("beat", "day", "n", "q_low", "q_hi")


FIXED = {"Crime_Lag_1Day_Beat": 0.5, "Crime_Lag_7Day_Beat": 0.25, "Rolling_Avg_7Day_Beat": 0.375, "Rolling_Avg_28Day_Beat": -0.125}


def _forecast_sql(days: int = 7) -> str:
    """One step of the recursion per named query: lists hold the counts, newest last."""
    start = """+ r AS (SELECT beat, day, n, row_number() OVER (PARTITION BY beat ORDER BY day DESC) AS r FROM long_daily),
    s0 AS (SELECT beat, max(day) AS d, list(cast(n AS double) ORDER BY day) AS c, 0 AS p FROM r WHERE r <= 28 GROUP BY beat)"""
    lag = "coalesce(c[-{0}], 0.0)"
    mean = "list_sum(c[-{0}:]) / len(c[-{0}:])"
    score = (f"0.5 * {lag.format(1)} + 0.25 * {lag.format(7)} + 0.375 * ({mean.format(7)}) - 0.125 * ({mean.format(28)}) + 0.25")
    steps = [f"""s{i} AS (SELECT beat, d + 1 AS d, list_append(c, p) AS c, cast(p AS int) AS p FROM (SELECT beat, d, c,
        round_even(greatest({score}, 0.0), 0) AS p FROM s{i - 1}))""" for i in range(1, days + 1)]
    union = " UNION ALL ".join(f'SELECT d AS "Date", beat AS "Beat", p AS "CrimeCount_Pred" FROM s{i}' for i in range(1, days + 1))
    return ", ".join([start, *steps]) + " " + union


@query("m10_forecast", sql(_forecast_sql(), "lng_inc", "long_daily"))
def _(t: Tables) -> DataFrame:
    ahead = forecast.forecast(daily(t, long=True), "beat", "day", "n", forecast.linear_scorer(FIXED, 0.25))
    return ahead.select("Date", "Beat", "CrimeCount_Pred")


def typed(t: Tables) -> DataFrame:
    """Rows whose type depends on their features."""
    rows = t.incidents.select("id", "k", F.hour("ts").alias("hour"), "lat", "lng", "value", "arrest_flag")
    return rows.withColumn("label", (F.col("k") / 34).cast("int"))


@query("m11_multiclass_boost")
def _(t: Tables) -> DataFrame:
    rows = VectorAssembler(inputCols=["k", "hour", "lat", "value"], outputCol="features").transform(typed(t))
    model = multiclass.multiclass_boost(rows.withColumn("valid", F.col("id") % 10 == 0), "label", "features", [0, 1, 2], valid="valid")
    return model.predict(rows).select("id", "label", F.col("prediction").alias("predicted"),
                                      F.round(F.array_max("probability"), 6).alias("confidence"))


@query("m12_cv_select_features")
def _(t: Tables) -> DataFrame:
    found = multiclass.fold_importances(typed(t), "label", ["k", "hour", "lat", "lng", "value", "arrest_flag"], ["id"])
    return multiclass.vote_features(found, 3)


# The vote on its own, with importances taken from the data: mean of a number per fold and kind.
@query("m12_vote_features", sql(
    """+ f AS (SELECT beat AS fold, kind AS "Feature", avg(k) AS importance FROM inc GROUP BY ALL),
    p AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY importance DESC, "Feature") AS r FROM f)
    SELECT "Feature", count(*) AS votes FROM p WHERE r <= 3 GROUP BY "Feature" ORDER BY votes DESC, "Feature" LIMIT 3""", "inc"))
def _(t: Tables) -> DataFrame:
    means = t.incidents.groupBy(F.col("beat").alias("fold"), F.col("kind").alias("Feature")).agg(F.avg("k").alias("Importance"))
    return multiclass.vote_features(means, 3)


def weekly_features(t: Tables) -> DataFrame:
    rows = t.incidents.withColumn("week", week_key("ts"))
    return rows.groupBy("beat", "week").agg(F.count(F.lit(1)).alias("n"), F.sum("arrest_flag").alias("arrests"))


_HOP = """h{1} AS (SELECT e.src AS beat, w.week, sum(w.{0} / (1 + dist / 4.0)) / sum(1 / (1 + dist / 4.0)) AS v FROM e JOIN {2} w ON e.dst = w.beat
    GROUP BY e.src, w.week), w{1} AS (SELECT b.beat, b.week, coalesce(v, 0.0) AS {3} FROM w0 b LEFT JOIN h{1} USING (beat, week))"""


@query("m13a_neighbor_features", sql(
    f"""+ {EDGES}, w0 AS (SELECT beat, cast(date_trunc('week', ts) AS date) AS week, cast(count(*) AS double) AS n FROM inc GROUP BY ALL),
    {_HOP.format("n", 1, "w0", "n1")}, {_HOP.format("n1", 2, "w1", "n2")}
    SELECT w0.beat, w0.week, n, round(n1, 6) AS n_hop1, round(n2, 6) AS n_hop2 FROM w0 JOIN w1 USING (beat, week) JOIN w2 USING (beat, week)""",
    "inc"))
def _(t: Tables) -> DataFrame:
    rows = weekly_features(t).select("beat", "week", F.col("n").cast("double").alias("n"))
    return rounded(graph.neighbor_features(rows, edges(t), "beat", "week", ["n"], 4.0), "n_hop1", "n_hop2")


@query("m13b_hotspot_classifier")
def _(t: Tables) -> DataFrame:
    weeks = weekly_features(t).withColumn("n", F.col("n").cast("double"))
    rows = graph.neighbor_features(weeks, edges(t), "beat", "week", ["n", "arrests"], 4.0)
    rows = agg.hotspot_label(rows, "beat", "n")
    model = hotspot.hotspot_classifier(rows, "is_hotspot", ["arrests", "n_hop1", "n_hop2", "arrests_hop1"], focal_rounds=1)
    return model.predict(rows).select("beat", "week", "is_hotspot", "prob_hotspot")


@query("e9_feature_importance")
def _(t: Tables) -> DataFrame:
    names = ["k", "hour", "lat", "value"]
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(typed(t))
    model = multiclass.multiclass_boost(rows.withColumn("valid", F.col("id") % 10 == 0), "label", "features", [0, 1, 2], valid="valid")
    table = literal_table(rows, [(model.importances(),)], "importances array<double>")
    return feature_importance(table, names, "importances", 3)


@query("e14_training_history")
def _(t: Tables) -> DataFrame:
    rows = samples(t).withColumn("valid", F.col("day") >= F.lit("2000-06-01").cast("date"))
    return boosting.poisson_boost(rows, "n", "features", valid="valid", **boosting.HISTOGRAM_STYLE).training_history(rows)
