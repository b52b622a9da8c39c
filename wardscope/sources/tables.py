"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the raw incident file.
RAW_INCIDENT_SCHEMA = (
    "`ID` bigint, `Case Number` string, `Date` string, `Block` string, `IUCR` string, `Primary Type` string, "
    "`Description` string, `Location Description` string, `Arrest` string, `Domestic` string, `Beat` string, "
    "`District` string, `Ward` int, `Community Area` int, `FBI Code` string, `X Coordinate` double, "
    "`Y Coordinate` double, `Year` int, `Updated On` string, `Latitude` double, `Longitude` double, "
    "`Location` string"
)


def read_incidents_csv(spark: SparkSession, path: str, schema: T.StructType | str = RAW_INCIDENT_SCHEMA) -> DataFrame:
    """Read a CSV file with a header. The declared schema spares the pass that inference would cost."""
    return spark.read.schema(schema).csv(path, header=True)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a Parquet file or folder, only the given columns when they are named."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Write and return the row count, which is read from the footers of the files: the plan runs once."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("Year", "Month")) -> int:
    """Write a Hive-partitioned Parquet folder and return the row count.

    The rebalance hint brings the rows of a folder together, so that not every task writes a small file
    into every folder, while a month that is too large for one task is split again at run time.
    """
    return _write(df.hint("rebalance", *partition_by), path, partition_by)


def write_parquet(df: DataFrame, path: str) -> int:
    """Write a flat Parquet folder with as many files as the plan has partitions; returns the row count."""
    return _write(df, path, ())


def write_report_csv(df: DataFrame, path: str) -> None:
    """Write a report table as CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_manifest(row: DataFrame, path: str) -> None:
    """Write a one-row frame of structs, arrays and maps as JSON."""
    row.write.mode("overwrite").json(path)


def write_summary(lines: DataFrame, path: str) -> None:
    """Write a frame with one text column as lines of text."""
    lines.coalesce(1).write.mode("overwrite").text(path)


def save_model(model: MLWritable | Transformer, path: str) -> None:
    """Store a fitted pipeline stage or pipeline."""
    pipeline = model if isinstance(model, PipelineModel) else PipelineModel([model])
    pipeline.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load what :func:`save_model` stored."""
    return PipelineModel.load(path)


def row_counts(df: DataFrame) -> DataFrame:
    """One row with the number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
