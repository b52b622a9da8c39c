"""Regression errors, leaderboards and prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.functions.numeric import clip_prediction, order_bands, round_prediction

INFINITE = float("inf")


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < INFINITE)


def regression_metrics(df: DataFrame, actual: str, predicted: str, name: str, rounded: bool = False) -> DataFrame:
    """One row ``model, rounded, MAE, RMSE, SMAPE``; all infinite when a prediction is not finite."""
    truth, raw = F.col(actual).cast("double"), F.col(predicted).cast("double")
    guess = F.rint(raw) if rounded else raw
    error = guess - truth
    scale = F.abs(truth) + F.abs(guess)
    ratio = 2.0 * F.abs(error) / F.when(scale == 0, 1.0).otherwise(scale)
    usable = F.min(_finite(raw))

    def unless_broken(value: Column) -> Column:
        return F.when(usable, value).otherwise(INFINITE)

    return df.agg(unless_broken(F.avg(F.abs(error))).alias("MAE"),
                  unless_broken(F.sqrt(F.avg(error * error))).alias("RMSE"),
                  unless_broken(F.avg(ratio)).alias("SMAPE")).select(
        F.lit(name).alias("model"), F.lit(rounded).alias("rounded"), "MAE", "RMSE", "SMAPE")


def model_leaderboard(df: DataFrame, actual: str, predictions: Sequence[str]) -> DataFrame:
    """Metrics of several prediction columns, as they are and rounded, best first within each form.

    All models are measured in one pass: the prediction columns are stacked into rows.
    """
    stacked = df.select(F.col(actual).cast("double").alias("_truth"), F.explode(F.array(*(
        F.struct(F.lit(name).alias("model"), F.lit(form).alias("rounded"), F.col(name).cast("double").alias("raw"))
        for name in predictions for form in (False, True)))).alias("_p")).select("_truth", "_p.*")
    guess = F.when(F.col("rounded"), F.rint("raw")).otherwise(F.col("raw"))
    error = guess - F.col("_truth")
    scale = F.abs("_truth") + F.abs(guess)
    ratio = 2.0 * F.abs(error) / F.when(scale == 0, 1.0).otherwise(scale)
    usable = F.min(_finite(F.col("raw")))
    values = {"MAE": F.avg(F.abs(error)), "RMSE": F.sqrt(F.avg(error * error)), "SMAPE": F.avg(ratio)}
    table = stacked.groupBy("model", "rounded").agg(
        *(F.when(usable, value).otherwise(INFINITE).alias(name) for name, value in values.items()))
    return table.orderBy("rounded", "MAE", "model")


def prediction_table(df: DataFrame, day: str, key: str, actual: str, predicted: str, low: str, high: str) -> DataFrame:
    """Date, Beat, y_true, y_pred_cont, y_pred_int, q_low and q_hi in the order of date and key."""
    continuous = clip_prediction(F.col(predicted).cast("double"))
    bottom, top = order_bands(F.col(low), F.col(high))
    return df.select(F.col(day).alias("Date"), F.col(key).alias("Beat"), F.col(actual).cast("int").alias("y_true"),
                     continuous.alias("y_pred_cont"), round_prediction(continuous).alias("y_pred_int"),
                     bottom.alias("q_low"), top.alias("q_hi")).orderBy("Date", "Beat")


def error_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 60) -> DataFrame:
    """Counts of the prediction error in equal bins from the least to the largest error."""
    errors = df.select((F.col(predicted) - F.col(actual)).cast("double").alias("e"))
    errors = errors.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    span = errors.agg(F.struct(F.min("e").alias("low"), F.max("e").alias("high"))).scalar()
    share = F.try_divide(F.col("e") - span["low"], span["high"] - span["low"])
    index = F.least(F.coalesce(F.floor(share * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return errors.groupBy(index.alias("bin")).agg(F.sum("n").alias("n"))
