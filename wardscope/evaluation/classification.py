"""Curves, confusion counts and reports for classifiers.

Rows are counted per distinct score or per pair of classes first; everything after works on those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.operators.prefix import range_totals
from wardscope.schema import quoted


def _cumulative(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: true and false positives when everything from that score up is called positive."""
    counted = df.groupBy(*keys, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    falling = range_totals(counted, keys, [-F.col("threshold")], {"tp": F.col("_pos"), "fp": F.col("_neg")}, inclusive=True)
    totals = counted.groupBy(*keys).agg(F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"))
    if keys:
        return falling.join(totals, list(keys))
    facts = totals.select(F.struct("positives", "negatives")).scalar()
    return falling.withColumns({"positives": facts["positives"], "negatives": facts["negatives"]})


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """``threshold, precision, recall, f1`` for every distinct score."""
    points = _cumulative(df, score, label)
    precision, recall = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", "positives")
    curve = points.select("threshold", precision.alias("precision"), F.coalesce(recall, F.lit(1.0)).alias("recall"))
    return curve.withColumn("f1", 2 * F.col("precision") * F.col("recall")
                            / (F.col("precision") + F.col("recall") + 1e-9))


def best_f1_threshold(curve: DataFrame) -> DataFrame:
    """Threshold with the highest F1, the least one on ties, with its F1."""
    return curve.agg(F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("best_threshold"),
                     F.max("f1").alias("best_f1"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum of precision times the rise of recall over the distinct scores."""
    points = _cumulative(df, score, label)
    part = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")) * F.try_divide("_pos", "positives")
    return points.agg(F.sum(part).alias("average_precision"))


def roc_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """``threshold, fpr, tpr`` for every distinct score, per key when keys are given."""
    points = _cumulative(df, score, label, keys)
    return points.select(*keys, "threshold", F.try_divide("fp", "negatives").alias("fpr"),
                         F.try_divide("tp", "positives").alias("tpr"))


def roc_auc(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half, per key when keys are given."""
    points = _cumulative(df, score, label, keys)
    slab = F.col("_neg") * (F.col("tp") - F.col("_pos") / 2)
    return points.groupBy(*keys).agg(
        F.try_divide(F.sum(slab), F.first("positives") * F.first("negatives")).alias("roc_auc"))


def class_scores(df: DataFrame, label: str, probabilities: str, classes: Sequence[object]) -> DataFrame:
    """One row per row and class: ``class, score, hit``. The input of per-class curves."""
    cells = F.explode(F.array(*(
        F.struct(F.lit(value).alias("class"), F.col(probabilities)[i].alias("score"),
                 (F.col(label) == F.lit(value)).cast("int").alias("hit")) for i, value in enumerate(classes))))
    return df.select(cells.alias("c")).select("c.*")


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per pair of actual and predicted class."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[object]) -> DataFrame:
    """One row per actual class, one column per predicted class, for the given classes only."""
    known = df.filter(F.col(actual).isin(*labels))
    matrix = known.groupBy(F.col(actual).alias("actual")).pivot(predicted, list(labels)).agg(F.count(F.lit(1)))
    return matrix.select("actual", *(F.coalesce(quoted(str(v)), F.lit(0)).alias(f"pred_{v}") for v in labels))


def classification_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Takes confusion counts ``actual, predicted, n``, so its size is the square of the number of classes.
    A zero denominator gives 0.
    """
    cells = counts.select(F.col("actual").cast("string").alias("actual"),
                          F.col("predicted").cast("string").alias("predicted"), F.col("n").cast("long").alias("n"))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("actual").alias("metric"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("predicted").alias("metric"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("called"), F.lit(0).cast("long").alias("hits")))).alias("s")).select("s.*")
    sums = sides.groupBy("metric").agg(*(F.sum(c).alias(c) for c in ("support", "called", "hits")))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    precision, recall = ratio(F.col("hits"), F.col("called")), ratio(F.col("hits"), F.col("support"))
    classes = sums.select("metric", precision.alias("precision"), recall.alias("recall"),
                          ratio(2 * precision * recall, precision + recall).alias("f1_score"),
                          F.col("support").cast("double").alias("support"), "hits")
    parts = ("precision", "recall", "f1_score")
    total = F.sum("support")

    def summary(name: str, values: list[Column], support: Column) -> DataFrame:
        return classes.agg(*(v.alias(p) for v, p in zip(values, parts)), support.alias("support")).select(
            F.lit(name).alias("metric"), *parts, "support")

    accuracy = F.try_divide(F.sum("hits"), total)
    weighted = [F.try_divide(F.sum(F.col(p) * F.col("support")), total) for p in parts]
    return (classes.select("metric", *parts, "support")
            .unionByName(summary("accuracy", [accuracy] * 3, accuracy))
            .unionByName(summary("macro avg", [F.avg(p) for p in parts], total))
            .unionByName(summary("weighted avg", weighted, total)))


def class_accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy and count per class, best first."""
    hit = (F.col(label) == F.col(predicted)).cast("double")
    return df.groupBy(label).agg(F.avg(F.coalesce(hit, F.lit(0.0))).alias("Accuracy"),
                                 F.count(F.lit(1)).alias("Count")).orderBy(F.desc("Accuracy"), F.desc("Count"), label)


def best_and_worst_class(accuracy: DataFrame, label: str, min_rows: int = 100) -> DataFrame:
    """First class in the order of the accuracy table, and its last one among those with enough rows."""
    place = F.struct(-F.col("Accuracy"), -F.col("Count"), F.col(label))
    enough = F.col("Count") >= min_rows
    return accuracy.agg(
        F.min_by(label, place).alias("best_class"), F.max("Accuracy").alias("best_accuracy"),
        F.max_by(label, F.when(enough, place)).alias("worst_class"),
        F.min(F.when(enough, F.col("Accuracy"))).alias("worst_accuracy"))


def focal_loss(df: DataFrame, probability: str, label: str, weights: DataFrame | None = None, alpha: float = 0.9,
               gamma: float = 2.5) -> DataFrame:
    """Mean focal loss of a binary probability; class weights scale the cross entropy before it is focused."""
    if weights is not None:
        df = df.join(weights.withColumnRenamed("weight", "_class_weight"), label, "left")
    class_weight = F.coalesce(F.col("_class_weight"), F.lit(1.0)) if weights is not None else F.lit(1.0)
    p = F.greatest(F.when(F.col(label) == 1, F.col(probability)).otherwise(1 - F.col(probability)), F.lit(1e-12))
    entropy = -F.log(p) * class_weight
    return df.agg(F.avg(alpha * F.pow(1 - F.exp(-entropy), F.lit(gamma)) * entropy).alias("focal_loss"))


def feature_importance(df: DataFrame, names: Sequence[str], vector: str, n: int = 30) -> DataFrame:
    """The ``n`` most important features of a one-row frame that holds the importances as an array."""
    rows = df.select(F.posexplode(vector).alias("position", "Importance"))
    named = rows.withColumn("Feature", F.element_at(F.array(*map(F.lit, names)), F.col("position") + 1))
    return named.select("Feature", "Importance").orderBy(F.desc("Importance"), "Feature").limit(n)


def hotspot_table(df: DataFrame, key: str, week: str, probability: str, threshold: float | Column,
                  centroids: DataFrame | None = None) -> DataFrame:
    """Beat, Date_Only, prob_hotspot, Prediction and the median coordinates of the beat."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    table = df.select(F.col(key).alias("Beat"), F.col(week).cast("date").alias("Date_Only"),
                      F.col(probability).alias("prob_hotspot"), (F.col(probability) >= limit).cast("int").alias("Prediction"))
    return table if centroids is None else table.join(centroids.withColumnRenamed(key, "Beat"), "Beat", "left")


def week_range(table: DataFrame) -> DataFrame:
    """First and last week of a hotspot table."""
    return table.agg(F.min("Date_Only").alias("first_week"), F.max("Date_Only").alias("last_week"))
