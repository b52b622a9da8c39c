"""Curves, reports and errors against known results."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from wardscope.evaluation import classification as cls
from wardscope.evaluation import regression as reg
from wardscope.operators.sampling import best_model

# Published confusion matrix and the report that belongs to it.
MATRIX = [("0", "0", 29735), ("0", "1", 4791), ("1", "0", 2890), ("1", "1", 7274)]
REPORT = {
    "0": (0.9114176245210728, 0.861235011295835, 0.885615999761731, 34526.0),
    "1": (0.6029009531703274, 0.7156631247540338, 0.6544603895811777, 10164.0),
    "accuracy": (0.8281270977847394,) * 4,
    "macro avg": (0.7571592888457002, 0.7884490680249344, 0.7700381946714543, 44690.0),
    "weighted avg": (0.8412506196517737, 0.8281270977847394, 0.8330434864058316, 44690.0),
}


def test_report_of_the_published_matrix(spark):
    counts = spark.createDataFrame(MATRIX, "actual string, predicted string, n long")
    found = {r.metric: tuple(r)[1:] for r in cls.classification_report(counts).collect()}
    assert set(found) == set(REPORT)
    for name, values in REPORT.items():
        assert found[name] == pytest.approx(values, abs=1e-12)


def test_report_without_predictions_of_a_class(spark):
    counts = spark.createDataFrame([("a", "a", 3), ("b", "a", 1)], "actual string, predicted string, n long")
    found = {r.metric: tuple(r)[1:] for r in cls.classification_report(counts).collect()}
    assert found["b"] == (0.0, 0.0, 0.0, 1.0) and found["a"] == pytest.approx((0.75, 1.0, 6 / 7, 3.0))


def scored(spark, rows):
    return spark.createDataFrame(rows, "s double, y int")


def test_equal_scores_give_half(spark):
    df = scored(spark, [(0.5, 1), (0.5, 0), (0.5, 0)])
    assert cls.roc_auc(df, "s", "y").first()[0] == 0.5
    assert cls.average_precision(df, "s", "y").first()[0] == pytest.approx(1 / 3)


def test_auc_equals_pair_counting(spark):
    rows = [((i * 37 % 50) / 50, int(i * 13 % 7 < 3)) for i in range(300)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert cls.roc_auc(scored(spark, rows), "s", "y").first()[0] == pytest.approx(pairs)


def test_best_threshold(spark):
    df = scored(spark, [(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.2, 0), (0.1, 0)])
    best = cls.best_f1_threshold(cls.pr_curve(df, "s", "y")).first()
    assert best[0] == 0.6 and best[1] == pytest.approx(2 * 0.75 / 1.75)


def test_metrics_of_zeros_and_broken_predictions(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 1.5)], "y double, p double")
    row = reg.regression_metrics(df, "y", "p", "m").first()
    assert (row.MAE, row.SMAPE) == (0.25, pytest.approx(0.5 * 2 * 0.5 / 3.5)) and row.RMSE == pytest.approx(math.sqrt(0.125))
    assert reg.regression_metrics(df, "y", "p", "m", True).first().MAE == 0.0
    broken = df.withColumn("p", F.when(F.col("y") > 1, float("nan")).otherwise(F.col("p")))
    assert reg.regression_metrics(broken, "y", "p", "m").first().MAE == math.inf


def test_leaderboard_and_best(spark):
    df = spark.createDataFrame([(1.0, 1.4, 3.0), (2.0, 2.4, 2.0)], "y double, a double, b double")
    board = reg.model_leaderboard(df, "y", ["a", "b"])
    assert [(r.model, r.rounded) for r in board.collect()] == [("a", False), ("b", False), ("a", True), ("b", True)]
    assert tuple(best_model(board).first()) == ("a", 0.0)


def test_matrix_keeps_the_given_classes_only(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a"), ("b", "z")], "t string, p string")
    found = {r.actual: tuple(r)[1:] for r in cls.confusion_matrix(df, "t", "p", ["a", "b"]).collect()}
    assert found == {"a": (1, 1), "b": (0, 0)}


def test_best_and_worst(spark):
    df = spark.createDataFrame([("a", 0.9, 10), ("b", 0.9, 20), ("c", 0.1, 5), ("d", 0.5, 200)], "k string, Accuracy double, Count long")
    assert tuple(cls.best_and_worst_class(df, "k").first()) == ("b", 0.9, "d", 0.5)


def test_focal_loss_of_certain_rows(spark):
    df = spark.createDataFrame([(1.0, 1), (0.5, 0)], "p double, y int")
    wanted = 0.9 * 0.5 ** 2.5 * math.log(2) / 2
    assert cls.focal_loss(df, "p", "y").first()[0] == pytest.approx(wanted)
