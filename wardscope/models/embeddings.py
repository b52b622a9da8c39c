"""Node vectors learned from random walks."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.session import cut_lineage


def walk_embeddings(walks: DataFrame, key: str, dims: int = 8, window: int = 3, seed: int = 42,
                    partitions: int = 8) -> DataFrame:
    """One row per node of the walks: key and ``Embed_0 …``. No row when there are no walks.

    Training is split into ``partitions`` parts that are averaged. The vectors depend on this number, so it is the same
    for any amount of walks unless the caller changes it.
    """
    walks = cut_lineage(walks)
    if walks.isEmpty():
        names = ", ".join(f"Embed_{i} double" for i in range(dims))
        return walks.sparkSession.createDataFrame([], f"{key} string, {names}")
    model = Word2Vec(vectorSize=dims, windowSize=window, minCount=1, seed=seed, inputCol="path",
                     numPartitions=partitions).fit(walks)
    vectors = model.getVectors().select(F.col("word").alias(key), vector_to_array("vector").alias("v"))
    return vectors.select(key, *(F.col("v")[i].alias(f"Embed_{i}") for i in range(dims)))
