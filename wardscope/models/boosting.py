"""Boosted trees for count targets and quantiles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.models.trees import Boosting, Ensemble, Objective, Style, Tree, group_quantiles
from wardscope.session import with_library

# The two parameter sets of the count models and the one of the bands.
HISTOGRAM_STYLE = {"rounds": 800, "depth": 14, "learning_rate": 0.07, "min_leaf": 20, "patience": 10, "leaves": 31, "bins": 255, "tolerance": 1e-7}
GRADIENT_STYLE = {"rounds": 1200, "depth": 9, "learning_rate": 0.05, "min_leaf": 1, "patience": 75, "min_weight": 1.0, "l2": 1.0, "row_share": 0.9,
                  "column_share": 0.9, "max_step": 0.7, "bins": 256}
BAND_STYLE = {"rounds": 600, "depth": 3, "learning_rate": 0.05, "min_leaf": 1, "row_share": 0.9, "bins": 255}


@dataclass
class BoostedTrees:
    """Trees of one output and how their sum becomes a prediction."""

    ensemble: Ensemble
    link: str

    @property
    def trees(self) -> list[Tree]:
        return [trees[0] for trees in self.ensemble.rounds]

    @property
    def history(self) -> list[dict[str, float]]:
        return self.ensemble.history

    def margin(self, df: DataFrame, out: str) -> DataFrame:
        """Add the sum of the base and all steps."""
        return self.ensemble.margins(df, out).withColumn(out, F.col(out)[0])

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the prediction on the scale of the target."""
        scored = self.margin(df, "_margin")
        value = F.exp("_margin") if self.link == "log" else F.col("_margin")
        return scored.withColumn(out, value).drop("_margin")

    def training_history(self, df: DataFrame) -> DataFrame:
        """Loss per round as a table in the session of ``df``."""
        rows = [(i, h["train"], h.get("valid")) for i, h in enumerate(self.history)]
        return df.sparkSession.createDataFrame(rows, "round int, train double, valid double")

    def save(self, df: DataFrame, path: str) -> None:
        self.ensemble.save(df, path, link=self.link)

    @classmethod
    def load(cls, df: DataFrame, path: str) -> BoostedTrees:
        ensemble, facts = Ensemble.load(df, path)
        return cls(ensemble, facts["link"])


def poisson_objective(max_step: float = math.inf) -> Objective:
    """Poisson deviance with a log link. A bound on the steps also raises the curvature, so that steps near it stay safe."""
    raised = math.exp(max_step) if math.isfinite(max_step) else 1.0

    def gradient(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mu = np.exp(margin)
        return w * (mu - y), raised * w * mu

    def loss(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
        mu = np.exp(margin[0])
        return 2 * (np.where(y > 0, y * (np.log(np.maximum(y, 1e-300)) - margin[0]), 0.0) - (y - mu))

    return Objective(gradient, loss)


def quantile_objective(alpha: float) -> Objective:
    """Quantile loss: trees on the sign of the residual, leaf steps its weighted quantile."""
    def gradient(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.where(y - margin > 0, -alpha, 1.0 - alpha) * w, np.broadcast_to(w, margin.shape)

    def loss(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
        rest = y - margin[0]
        return np.maximum(alpha * rest, (alpha - 1) * rest)

    return Objective(gradient, loss, alpha)


def poisson_boost(df: DataFrame, label: str, features: str, rounds: int, depth: int, learning_rate: float, min_leaf: int = 1,
                  weight: str | None = None, valid: str | None = None, patience: int | None = None, bins: int = 64,
                  seed: int = 42, **style: object) -> BoostedTrees:
    """Boosted trees with Poisson deviance and log link. ``valid`` marks rows kept for the stopping rule.

    ``style`` takes the other fields of ``Style``: leaves, penalties, shares of rows and columns.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    held = F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(False)
    mean = df.filter(~held).agg(F.try_divide(F.sum(w * F.col(label)), F.sum(w))).first()[0]
    grown = Style(rounds, depth, learning_rate, min_rows=min_leaf, patience=patience, bins=bins, seed=seed, **style)
    base = [math.log(max(mean or 0.0, 1e-9))]
    return BoostedTrees(Boosting(df, label, features, poisson_objective(grown.max_step), base, grown, weight, valid).fit(), "log")


def weighted_quantiles(rows: DataFrame, key: str | None, value: Column, weight: Column, alpha: float) -> dict[int, float]:
    """Exact weighted quantile per key: the least value up to which ``alpha`` of the weight lies. Keys are few."""
    keyed = rows.select((F.col(key).cast("long") if key else F.lit(0).cast("long")).alias("key"), value.cast("double").alias("value"),
                        weight.cast("double").alias("weight")).dropna()
    with_library(rows.sparkSession)

    def values_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        yield tuple(batch.column(c).to_numpy() for c in range(3))

    return group_quantiles(keyed, values_of, alpha, keyed.rdd.getNumPartitions())


def quantile_boost(df: DataFrame, label: str, features: str, alpha: float, rounds: int, depth: int = 3,
                   learning_rate: float = 0.05, min_leaf: int = 1, weight: str | None = None, bins: int = 64,
                   seed: int = 42, **style: object) -> BoostedTrees:
    """Boosted trees with quantile loss."""
    base = weighted_quantiles(df, None, F.col(label), F.col(weight) if weight else F.lit(1.0), alpha).get(0, 0.0)
    grown = Style(rounds, depth, learning_rate, min_rows=min_leaf, bins=bins, seed=seed, **style)
    return BoostedTrees(Boosting(df, label, features, quantile_objective(alpha), [base], grown, weight, None).fit(), "identity")


def quantile_bands(df: DataFrame, label: str, features: str, low: float = 0.2, high: float = 0.8,
                   **parameters: object) -> tuple[BoostedTrees, BoostedTrees]:
    """Models of the lower and of the upper band, fitted side by side."""
    with ThreadPoolExecutor(2) as pool:
        return tuple(pool.map(lambda alpha: quantile_boost(df, label, features, alpha, **{**BAND_STYLE, **parameters}), (low, high)))
