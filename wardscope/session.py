"""Session helpers: where intermediate results are kept and how lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_library(spark: SparkSession) -> None:
    """Lets Python workers import this library from where the driver did, if nothing else was set."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints, taken from ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a temporary folder: on a cluster the folder
    has to be shared, so that a lost executor does not lose the data.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="wardscope-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return it with an empty lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder; later reads take only the columns they need."""
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with a number that no two rows share, even where they are equal in every column."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()))
