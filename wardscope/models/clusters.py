"""Clusters of daily profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from wardscope.session import cut_lineage


def fit_profiles(profile: DataFrame, columns: Sequence[str], k: int = 5, seed: int = 42,
                 starts: int = 10) -> tuple[KMeansModel, DataFrame]:
    """Best of several k-means starts by training cost, and the assembled profiles it was fitted on."""
    assembled = cut_lineage(VectorAssembler(inputCols=list(columns), outputCol="_profile").transform(profile))
    fits = (KMeans(featuresCol="_profile", predictionCol="Hour_Cluster", k=k, seed=seed + i).fit(assembled)
            for i in range(starts))
    return min(fits, key=lambda model: model.summary.trainingCost), assembled


def hour_clusters(profile: DataFrame, key: str, k: int = 5, seed: int = 42, starts: int = 10) -> DataFrame:
    """Cluster of the hour profile of each key."""
    columns = [name for name in profile.columns if name != key]
    model, assembled = fit_profiles(profile, columns, k, seed, starts)
    return model.transform(assembled).select(key, "Hour_Cluster")
