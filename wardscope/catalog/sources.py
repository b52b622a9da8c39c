"""Sources, sinks and schema choices."""

from __future__ import annotations

import os
import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardscope import schema, sources
from wardscope.catalog.base import Tables, query, sql
from wardscope.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """New folder next to the checkpoints, where all executors can write."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@query("s1_read_incidents_csv", sql('SELECT "ID", "Date", "Beat", "Arrest", round("Latitude", 6) AS "Latitude" FROM raw', "raw"))
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark, "csv")
    columns = t.raw.select("ID", "Date", "Beat", "Arrest", "Latitude")
    sources.write_report_csv(columns, path)
    read = sources.read_incidents_csv(t.spark, path, "ID bigint, Date string, Beat string, Arrest string, Latitude double")
    return read.withColumn("Latitude", F.round("Latitude", 6))


@query("s2_read_table", "SELECT event_id, event_type, value FROM events")
def _(t: Tables) -> DataFrame:
    return sources.read_table(t.spark, f"{t.folder}/events.parquet", ["event_id", "event_type", "value"])


@query("s3_write_partitioned", sql(
    """SELECT id, beat, cast(year(ts) AS int) AS "Year", cast(month(ts) AS int) AS "Month" FROM lng_inc""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark, "partitioned")
    rows = t.long_incidents.select("id", "beat", F.year("ts").alias("Year"), F.month("ts").alias("Month"))
    sources.write_partitioned(rows, path)
    return sources.read_table(t.spark, path, ["id", "beat", "Year", "Month"])


@query("s4_write_parquet", sql("SELECT id, beat, kind FROM inc", "inc"))
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark, "flat")
    sources.write_parquet(t.incidents.select("id", "beat", "kind"), path)
    return sources.read_table(t.spark, path)


@query("s5_write_report_csv", sql("SELECT beat, kind, count(*) AS n FROM inc GROUP BY ALL", "inc"))
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark, "report")
    sources.write_report_csv(t.incidents.groupBy("beat", "kind").agg(F.count(F.lit(1)).alias("n")), path)
    return sources.read_incidents_csv(t.spark, path, "beat string, kind string, n bigint")


@query("s6_write_manifest", sql(
    "SELECT count(*) AS total, min(kind) AS first_kind, count(DISTINCT kind) AS kinds FROM inc", "inc"))
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark, "manifest")
    facts = F.struct(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_set("kind")).alias("kinds"))
    sources.write_manifest(t.incidents.agg(facts.alias("data")), path)
    read = t.spark.read.schema("data struct<rows: bigint, kinds: array<string>>").json(path)
    return read.select(F.col("data.rows").alias("total"), F.col("data.kinds")[0].alias("first_kind"),
                       F.size("data.kinds").cast("long").alias("kinds"))


@query("s9_first_available", sql("SELECT id, kind AS picked, 'UNKNOWN' AS absent FROM inc", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents
    return rows.select("id", schema.first_available(rows, ["Primary Type", "kind"]).alias("picked"),
                       schema.first_available(rows, ["FBI Code", "FBI_Code"], "UNKNOWN").alias("absent"))


@query("s10_merge_suffixed", sql(
    """SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN k END, CASE WHEN id % 2 = 0 THEN k + 1 END) AS c FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", F.when(F.col("id") % 3 == 0, F.col("k")).alias("c_x"),
                              F.when(F.col("id") % 2 == 0, F.col("k") + 1).alias("c_y"))
    return schema.merge_suffixed(rows, ["c"])


@query("s11_save_model", sql(
    """+ m AS (SELECT avg(k) AS mk, avg(arrest_flag) AS ma, avg(value) AS mv, var_pop(k) AS kk, var_pop(arrest_flag) AS aa,
      covar_pop(k, arrest_flag) AS ka, covar_pop(k, value) AS kv, covar_pop(arrest_flag, value) AS av FROM inc),
    b AS (SELECT *, (kv * aa - av * ka) / (kk * aa - ka * ka) AS bk, (av * kk - kv * ka) / (kk * aa - ka * ka) AS ba FROM m)
    SELECT id, round(mv + bk * (k - mk) + ba * (arrest_flag - ma), 6) AS prediction FROM inc, b""", "inc"))
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark, "model")
    model = Pipeline(stages=[VectorAssembler(inputCols=["k", "arrest_flag"], outputCol="features"),
                             LinearRegression(labelCol="value", solver="normal")]).fit(t.incidents)
    sources.save_model(model, path)
    return sources.load_model(path).transform(t.incidents).select("id", F.round("prediction", 6).alias("prediction"))
