"""Classifier of hotspot weeks on own and neighbour features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.operators.aggregates import balanced_class_weights
from wardscope.operators.joins import lookup
from wardscope.session import cut_lineage


@dataclass
class HotspotModel:
    """Fitted classifier and the loss of each focal round."""

    columns: list[str]
    classifier: Model
    kind: str
    history: list[float] = field(default_factory=list)

    def predict(self, df: DataFrame, out: str = "prob_hotspot") -> DataFrame:
        """Add the probability of a hotspot."""
        scored = self.classifier.transform(_assemble(df, self.columns))
        return scored.withColumn(out, vector_to_array("_probability")[1]).drop(
            "_features", "_raw", "_probability", "_prediction")

    def pipeline(self) -> PipelineModel:
        return PipelineModel([VectorAssembler(inputCols=list(self.columns), outputCol="_features"), self.classifier])


def _assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="_features").transform(df)


_OUTPUTS = {"featuresCol": "_features", "labelCol": "_label", "probabilityCol": "_probability", "rawPredictionCol": "_raw",
            "predictionCol": "_prediction"}


def hotspot_classifier(train: DataFrame, label: str, columns: Sequence[str], kind: str = "logistic", focal_rounds: int = 0,
                       gamma: float = 2.5, hidden: int = 128, iterations: int = 100, reg: float = 4e-4,
                       seed: int = 42) -> HotspotModel:
    """Class-weighted classifier.

    ``logistic`` takes the weights directly; ``focal_rounds`` refits it with weights that favour the rows it
    got wrong. ``perceptron`` has no weights, so rows of the rarer class are repeated.
    """
    weighted = lookup(train, balanced_class_weights(train, label), label, "weight", 1.0)
    rows = cut_lineage(_assemble(weighted, columns).select("_features", F.col(label).cast("double").alias("_label"),
                                                          F.col("weight").alias("_weight")))
    if kind == "perceptron":
        least = rows.agg(F.min("_weight").alias("least")).scalar()
        copies = F.greatest(F.rint(F.col("_weight") / least).cast("int"), F.lit(1))
        repeated = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
        layers = [len(columns), hidden, hidden // 2, 2]
        network = MultilayerPerceptronClassifier(layers=layers, maxIter=iterations, seed=seed, **_OUTPUTS)
        return HotspotModel(list(columns), network.fit(repeated), kind)
    logistic = LogisticRegression(weightCol="_focus", regParam=reg, maxIter=iterations, **_OUTPUTS)
    model = HotspotModel(list(columns), logistic.fit(rows.withColumn("_focus", F.col("_weight"))), kind)
    model.history.append(float(model.classifier.summary.objectiveHistory[-1]))
    for _ in range(focal_rounds):
        p = vector_to_array("_probability")[1]
        truth = F.when(F.col("_label") == 1, p).otherwise(1 - p)
        focused = model.classifier.transform(rows).withColumn("_focus", F.col("_weight") * F.pow(1 - truth, F.lit(gamma)))
        focused = cut_lineage(focused.select("_features", "_label", "_focus"))
        model.classifier = logistic.fit(focused)
        model.history.append(float(model.classifier.summary.objectiveHistory[-1]))
    return model
