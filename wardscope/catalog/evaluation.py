"""Evaluation and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.catalog.aggregations import PREDICTED, predictions
from wardscope.catalog.base import Tables, query, rounded, sql
from wardscope.operators.aggregates import category_values
from wardscope.evaluation import classification as cls
from wardscope.evaluation import regression as reg
from wardscope.functions.numeric import order_bands
from wardscope.operators import aggregates as agg

# Scores with ties: the quantity of a line item as a score for its return flag.
SCORED = "scored AS (SELECT l_quantity / 50 AS s, cast(l_returnflag = 'R' AS int) AS y FROM lineitem)"
POINTS = SCORED + """, g AS (SELECT s, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY s),
    c AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g),
    pr AS (SELECT s AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM c),
    f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM pr)"""
# Classes and guesses of the incidents.
GUESSED = """guessed AS (SELECT id, kind AS actual, CASE WHEN id % 4 = 0 THEN 'CLICK' WHEN id % 10 = 3 THEN 'VIEW' ELSE kind END
    AS predicted FROM inc)"""
# Rows of per-class scores for the curves of several classes.
CLASS_SCORES = """scores AS (SELECT c.class, cast(kind = c.class AS int) AS y, ((k * c.m) % 100) / 100.0 + 0.2 * cast(kind = c.class AS int) AS s
    FROM inc, (VALUES ('CLICK', 3), ('ERROR', 7), ('PURCHASE', 13), ('SIGNUP', 17), ('VIEW', 11)) c(class, m))"""


def scored(t: Tables) -> DataFrame:
    return t.table("lineitem").select((F.col("l_quantity") / 50).alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"))


def guessed(t: Tables) -> DataFrame:
    guess = F.when(F.col("id") % 4 == 0, "CLICK").when(F.col("id") % 10 == 3, "VIEW").otherwise(F.col("kind"))
    return t.incidents.select("id", F.col("kind").alias("actual"), guess.alias("predicted"))


def class_scores(t: Tables) -> DataFrame:
    classes = {"CLICK": 3, "ERROR": 7, "PURCHASE": 13, "SIGNUP": 17, "VIEW": 11}
    hits = {name: (F.col("kind") == name).cast("int") for name in classes}
    scores = F.array(*(((F.col("k") * m) % 100) / 100.0 + 0.2 * hits[name] for name, m in classes.items()))
    return cls.class_scores(t.incidents.select("kind", scores.alias("scores")), "kind", "scores", list(classes))


def _metrics_sql(model: str, value: str, rounded_form: str) -> str:
    return f"""SELECT '{model}' AS model, {rounded_form} AS rounded, avg(abs({value} - y)) AS "MAE", sqrt(avg(pow({value} - y, 2))) AS "RMSE",
    avg(2.0 * abs({value} - y) / CASE WHEN abs(y) + abs({value}) = 0 THEN 1.0 ELSE abs(y) + abs({value}) END) AS "SMAPE" FROM pred"""


def _rounded_sql(body: str) -> str:
    return f'SELECT model, rounded, round("MAE", 6) AS "MAE", round("RMSE", 6) AS "RMSE", round("SMAPE", 6) AS "SMAPE" FROM ({body})'


@query("e1_regression_metrics", sql(PREDICTED + _rounded_sql(_metrics_sql("shifted", "p", "false")), "inc", "daily"))
def _(t: Tables) -> DataFrame:
    return rounded(reg.regression_metrics(predictions(t), "y", "p", "shifted"), "MAE", "RMSE", "SMAPE")


@query("e2_order_bands", sql(
    "SELECT id, greatest(least(k - 20.0, 60.0 - k), 0.0)::double AS low, greatest(k - 20.0, 60.0 - k, 0.0)::double AS high FROM inc", "inc"))
def _(t: Tables) -> DataFrame:
    low, high = order_bands((F.col("k") - 20.0).cast("double"), (60.0 - F.col("k")).cast("double"))
    return t.incidents.select("id", low.alias("low"), high.alias("high"))


@query("e3_pr_curve", sql(f"+ {POINTS} SELECT threshold, precision, recall, f1 FROM f", "inc"))
def _(t: Tables) -> DataFrame:
    return cls.pr_curve(scored(t), "s", "y")


@query("e3_best_f1_threshold", sql(
    f"+ {POINTS} SELECT threshold AS best_threshold, f1 AS best_f1 FROM f ORDER BY f1 DESC, threshold LIMIT 1", "inc"))
def _(t: Tables) -> DataFrame:
    return cls.best_f1_threshold(cls.pr_curve(scored(t), "s", "y"))


@query("e4_roc_auc", sql(f"+ {POINTS} SELECT round(sum(neg * (tp - pos / 2)) / any_value(p * n), 9) AS roc_auc FROM c", "inc"))
def _(t: Tables) -> DataFrame:
    return rounded(cls.roc_auc(scored(t), "s", "y"), "roc_auc", digits=9)


@query("e4_roc_curve_per_class", sql(
    f"""+ {CLASS_SCORES}, g AS (SELECT class, round(s, 6) AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM scores GROUP BY class, round(s, 6))
    SELECT class, cast(s AS double) AS threshold, sum(neg) OVER (PARTITION BY class ORDER BY s DESC) / sum(neg) OVER (PARTITION BY class) AS fpr,
    sum(pos) OVER (PARTITION BY class ORDER BY s DESC) / sum(pos) OVER (PARTITION BY class) AS tpr FROM g""", "inc"))
def _(t: Tables) -> DataFrame:
    scores = class_scores(t).withColumn("score", F.round("score", 6))
    return cls.roc_curve(scores, "score", "hit", ["class"])


@query("e5_average_precision", sql(
    f"+ {POINTS} SELECT round(sum(tp / (tp + fp) * pos / p), 9) AS average_precision FROM c", "inc"))
def _(t: Tables) -> DataFrame:
    return rounded(cls.average_precision(scored(t), "s", "y"), "average_precision", digits=9)


@query("e6_confusion_matrix", sql(
    f"""+ {GUESSED} SELECT actual, count(*) FILTER (predicted = 'CLICK') AS "pred_CLICK", count(*) FILTER (predicted = 'ERROR') AS "pred_ERROR",
    count(*) FILTER (predicted = 'PURCHASE') AS "pred_PURCHASE", count(*) FILTER (predicted = 'SIGNUP') AS "pred_SIGNUP",
    count(*) FILTER (predicted = 'VIEW') AS "pred_VIEW" FROM guessed GROUP BY actual""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = guessed(t)
    return cls.confusion_matrix(rows, "actual", "predicted", category_values(rows, "actual"))


@query("e7_classification_report", sql(
    f"""+ {GUESSED}, classes AS (SELECT DISTINCT actual AS c FROM guessed),
    s AS (SELECT c, count(*) FILTER (actual = c AND predicted = c) AS hits, count(*) FILTER (actual = c) AS support,
      count(*) FILTER (predicted = c) AS called FROM guessed, classes GROUP BY c),
    m AS (SELECT c AS metric, coalesce(hits / nullif(called, 0), 0) AS precision, hits / support AS recall, support, hits FROM s),
    f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1_score FROM m),
    r AS (SELECT metric, precision, recall, f1_score, cast(support AS double) AS support FROM f
    UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support) FROM f
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM f
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1_score * support) / sum(support), sum(support) FROM f)
    SELECT metric, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score,
    round(support, 9) AS support FROM r""", "inc"))
def _(t: Tables) -> DataFrame:
    report = cls.classification_report(cls.confusion_counts(guessed(t), "actual", "predicted"))
    return rounded(report, "precision", "recall", "f1_score", "support", digits=9)


@query("e8_class_accuracy", sql(
    f"""+ {GUESSED} SELECT actual, avg(cast(actual = predicted AS int)) AS "Accuracy", count(*) AS "Count" FROM guessed GROUP BY actual""", "inc"))
def _(t: Tables) -> DataFrame:
    return cls.class_accuracy(guessed(t), "actual", "predicted")


@query("e8_best_and_worst_class", sql(
    f"""+ {GUESSED}, a AS (SELECT actual, avg(cast(actual = predicted AS int)) AS acc, count(*) AS n FROM guessed GROUP BY actual)
    SELECT (SELECT actual FROM a ORDER BY acc DESC, n DESC, actual LIMIT 1) AS best_class, (SELECT max(acc) FROM a) AS best_accuracy,
    (SELECT actual FROM a WHERE n >= 100 ORDER BY acc, n, actual DESC LIMIT 1) AS worst_class,
    (SELECT min(acc) FROM a WHERE n >= 100) AS worst_accuracy""", "inc"))
def _(t: Tables) -> DataFrame:
    return cls.best_and_worst_class(cls.class_accuracy(guessed(t), "actual", "predicted"), "actual")


@query("e10_error_histogram", sql(PREDICTED + """, e AS (SELECT cast(p - y AS double) AS e FROM pred),
    r AS (SELECT min(e) AS low, max(e) AS high FROM e)
    SELECT cast(least(floor((e - low) / (high - low) * 60), 59) AS int) AS bin, count(*) AS n FROM e, r GROUP BY bin""", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    return reg.error_histogram(predictions(t), "y", "p")


@query("e11_prediction_table", sql(PREDICTED + """
    SELECT day AS "Date", beat AS "Beat", cast(y AS int) AS y_true, cast(greatest(p, 0) AS double) AS y_pred_cont,
    cast(round_even(greatest(p, 0), 0) AS int) AS y_pred_int, cast(greatest(least(p - 2, 9 - p), 0) AS double) AS q_low,
    cast(greatest(p - 2, 9 - p, 0) AS double) AS q_hi FROM pred""", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    bands = predictions(t).withColumns({"low": (F.col("p") - 2).cast("double"), "high": (9 - F.col("p")).cast("double")})
    return reg.prediction_table(bands, "day", "beat", "y", "p", "low", "high")


@query("e12_hotspot_table", sql(
    """+ m AS (SELECT beat, median(lat) AS lat, median(lng) AS lng FROM inc GROUP BY beat),
    w AS (SELECT beat, cast(date_trunc('week', ts) AS date) AS week, avg(arrest_flag) AS p FROM inc GROUP BY ALL)
    SELECT beat AS "Beat", week AS "Date_Only", round(p, 9) AS prob_hotspot, cast(p >= 0.25 AS int) AS "Prediction",
    round(lat, 6) AS "Latitude", round(lng, 6) AS "Longitude" FROM w JOIN m USING (beat)""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.withColumn("week", F.to_date(F.date_trunc("week", "ts")))
    weeks = rows.groupBy("beat", "week").agg(F.avg("arrest_flag").alias("p"))
    centres = agg.centroid_median(rows.withColumnsRenamed({"lat": "Lat", "lng": "Lng"}), "beat")
    table = cls.hotspot_table(weeks, "beat", "week", "p", 0.25, centres)
    return rounded(rounded(table, "prob_hotspot", digits=9), "Latitude", "Longitude")


@query("e12_week_range", sql(
    "SELECT min(cast(date_trunc('week', ts) AS date)) AS first_week, max(cast(date_trunc('week', ts) AS date)) AS last_week FROM inc", "inc"))
def _(t: Tables) -> DataFrame:
    weeks = t.incidents.select("beat", F.date_trunc("week", "ts").alias("week"), F.lit(0.5).alias("p"))
    return cls.week_range(cls.hotspot_table(weeks, "beat", "week", "p", 0.5))


@query("e13_focal_loss", sql(
    f"""+ {SCORED}, w AS (SELECT y, (SELECT count(*) FROM scored) / (2 * count(*)) AS w FROM scored GROUP BY y),
    c AS (SELECT -ln(greatest(CASE WHEN y = 1 THEN q ELSE 1 - q END, 1e-12)) * w AS ce FROM (SELECT s * 0.98 + 0.01 AS q, y FROM scored) JOIN w USING (y))
    SELECT round(avg(0.9 * pow(1 - exp(-ce), 2.5) * ce), 6) AS focal_loss FROM c""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("s", F.col("s") * 0.98 + 0.01)
    return rounded(cls.focal_loss(rows, "s", "y", agg.balanced_class_weights(rows, "y")), "focal_loss")


@query("e15_model_leaderboard", sql(PREDICTED + _rounded_sql(" UNION ALL ".join([
    _metrics_sql("p", "p", "false"), _metrics_sql("p", "round_even(p, 0)", "true"),
    _metrics_sql("half", "(y / 2)", "false"), _metrics_sql("half", "round_even(y / 2, 0)", "true")])), "inc", "daily"))
def _(t: Tables) -> DataFrame:
    board = reg.model_leaderboard(predictions(t).withColumn("half", F.col("y") / 2), "y", ["p", "half"])
    return rounded(board, "MAE", "RMSE", "SMAPE")


@query("e16_worst_keys", sql(PREDICTED + """, b AS (SELECT beat, avg(abs(p - y)) AS mae, sqrt(avg(pow(p - y, 2))) AS rmse, count(*) AS n
    FROM pred GROUP BY beat)
    SELECT beat, round(mae, 9) AS "MAE", round(rmse, 9) AS "RMSE", n AS "N" FROM b WHERE n >= 20 ORDER BY mae DESC, beat LIMIT 10""",
                             "inc", "daily"))
def _(t: Tables) -> DataFrame:
    worst = agg.worst_keys(agg.per_key_errors(predictions(t), "beat", "y", "p"), "beat", 10, 20)
    return rounded(worst, "MAE", "RMSE", digits=9)


@query("e16_citywide_forecast", sql(PREDICTED + """
    SELECT day, cast(sum(cast(round_even(p, 0) AS bigint)) AS bigint) AS "CrimeCount_Pred" FROM pred GROUP BY day""", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    return agg.citywide_daily(predictions(t).withColumn("whole", F.rint("p").cast("long")), "day", "whole", "CrimeCount_Pred")
