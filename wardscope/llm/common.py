"""Helpers shared by the corpus operators: tasks, shared folders, text forms and connected components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, ShortType

from wardscope.session import checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_library(spark: SparkSession) -> None:
    """Lets Python workers import this library from where the driver did, if nothing else was set."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def shared_folder(spark: SparkSession, name: str) -> str:
    """Name of a new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: computed once, and safe from lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` is called so (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def with_struct(df: DataFrame, value: Column, fields: list[str]) -> DataFrame:
    """``df`` with the fields of the struct ``value`` as columns; columns of ``df`` with these names are replaced."""
    name = free_name(df, "made")
    kept = [c for c in df.columns if c.lower() not in {f.lower() for f in fields}]
    return df.withColumn(name, value).select(*(F.col(f"`{c}`") for c in kept), *(F.col(f"`{name}`.{f}").alias(f) for f in fields))


def with_row(docs: DataFrame, doc_id: str) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells rows apart and orders them: the ids if they can do that, else a stored number."""
    if isinstance(docs.schema[doc_id].dataType, (LongType, IntegerType, ShortType)):
        rows, ids = docs.agg(F.count(F.lit(1)), F.countDistinct(doc_id)).first()
        if rows == ids:
            return docs, doc_id
    name = free_name(docs, "row")
    return materialise(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def apply_arrow(df: DataFrame, function: Callable, schema: str, *columns: str) -> Column:
    """Column made by a function of Arrow arrays; marked as not deterministic, so that no rule runs it twice."""
    with_library(df.sparkSession)
    return F.arrow_udf(function, schema).asNondeterministic()(*(F.col(f"`{c}`") for c in columns))


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this library within reach of the workers."""
    with_library(df.sparkSession)
    return df.mapInArrow(function, schema)


def frames_by_bytes(index: DataFrame, frames: DataFrame, size: Column, task_bytes: int = 32 << 20) -> DataFrame:
    """``frames`` (``file, frame``) in as many tasks as the bytes behind the rows of ``index`` need, whatever their own size.

    Neighbouring frames of a file stay together, four such groups to a task, so that a task opens few files.
    """
    total, count = index.agg(F.coalesce(F.sum(size), F.lit(0)), F.count_distinct("file", "frame")).first()
    tasks = max(1, -(-int(total) // task_bytes))
    together = max(1, count // (4 * tasks))
    return frames.repartition(tasks, "file", F.floor(F.col("frame") / together)).sortWithinPartitions("file", "frame")


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges ``u, v`` (long, not null).

    Returns ``node, root`` for every node of an edge, the root being the smallest node reachable. Alternates between
    tying every larger neighbour to the smallest neighbour and tying every smaller one, which ends in stars after about
    the logarithm of the number of nodes. A hub is aggregated before its edges meet the one row with its smallest
    neighbour, so that an uneven join can be split. Every round is written to the shared folder.
    """
    edges = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large.where("u <> v"), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialise(small, "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
