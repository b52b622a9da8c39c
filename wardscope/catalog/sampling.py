"""Sorted reports, samples, set operations, splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.catalog.aggregations import PREDICTED, daily, predictions
from wardscope.catalog.base import Tables, query, rounded, sql
from wardscope.evaluation.regression import model_leaderboard
from wardscope.operators import aggregates as agg
from wardscope.operators import sampling


def hashed(seed: int = 42) -> str:
    return f"md5('{seed}:' || id)"


@query("o1_sorted_report", sql(
    "SELECT beat, kind, count(*) AS n FROM inc GROUP BY ALL ORDER BY n DESC, beat, kind", "inc"))
def _(t: Tables) -> DataFrame:
    counts = agg.group_counts(t.incidents, ["beat", "kind"], "n")
    return sampling.sorted_report(counts, F.desc("n"), "beat", "kind")


@query("o2_top_n", sql("SELECT beat, count(*) AS n FROM inc GROUP BY beat ORDER BY n DESC, beat LIMIT 7", "inc"))
def _(t: Tables) -> DataFrame:
    return sampling.top_n(agg.group_counts(t.incidents, ["beat"], "n"), "n", "beat", 7)


@query("o3_stable_sample", sql(f"SELECT id, beat FROM inc ORDER BY {hashed()} LIMIT 500", "inc"))
def _(t: Tables) -> DataFrame:
    return sampling.stable_sample(t.incidents.select("id", "beat"), ["id"], 500)


@query("o4_best_model", sql(PREDICTED + """, m AS (SELECT 'shifted' AS model, avg(abs(round_even(p, 0) - y)) AS "MAE" FROM pred
    UNION ALL SELECT 'double', avg(abs(round_even(y * 2.0, 0) - y)) FROM pred)
    SELECT model, round("MAE", 6) AS "MAE" FROM m ORDER BY "MAE", model LIMIT 1""", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    board = model_leaderboard(predictions(t).select("y", F.col("p").alias("shifted"), (F.col("y") * 2.0).alias("double")),
                              "y", ["shifted", "double"])
    return rounded(sampling.best_model(board), "MAE")


@query("u1_union_categories", sql(
    """SELECT DISTINCT coalesce(CASE WHEN id % 9 > 0 THEN kind END, '_NA_') AS kind FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", F.when(F.col("id") % 9 > 0, F.col("kind")).alias("kind"))
    return sampling.union_categories(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), "kind")


@query("t1_time_split", sql(
    "SELECT id, CASE WHEN ts < TIMESTAMP '1999-06-01' THEN 'train' ELSE 'test' END AS part FROM lng_inc", "lng_inc"))
def _(t: Tables) -> DataFrame:
    train, test = sampling.time_split(t.long_incidents, "ts", "1999-06-01")
    return train.select("id", F.lit("train").alias("part")).unionByName(test.select("id", F.lit("test").alias("part")))


@query("t2_choose_split_date", sql(
    """+ d AS (SELECT DISTINCT day FROM long_daily)
    SELECT day AS split_date FROM d QUALIFY row_number() OVER (ORDER BY day) = floor((SELECT count(*) FROM d) * 0.8) + 1""",
    "lng_inc", "long_daily"))
def _(t: Tables) -> DataFrame:
    return sampling.split_date_table(daily(t, long=True), "day")


@query("t3_stratified_split", sql(
    f"""SELECT id, kind, row_number() OVER (PARTITION BY kind ORDER BY {hashed()}) - 1 < round_even(count(*) OVER (PARTITION BY kind) * 0.2, 0)
    AS is_test FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    return sampling.stratified_split(t.incidents.select("id", "kind"), "kind", ["id"])


@query("t4_stratified_folds", sql(
    f"SELECT id, kind, cast((row_number() OVER (PARTITION BY kind ORDER BY {hashed()}) - 1) % 3 AS int) AS fold FROM inc", "inc"))
def _(t: Tables) -> DataFrame:
    return sampling.stratified_folds(t.incidents.select("id", "kind"), "kind", ["id"])
