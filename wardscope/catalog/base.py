"""Views of the test tables that look like incident tables, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TYPES = ("Theft", "battery", "CRIMINAL DAMAGE", "Assault", "narcotics", "BURGLARY", "Motor Vehicle Theft", "ROBBERY",
         "Deceptive Practice", "ARSON", " gambling ")
DESCRIPTIONS = ("$500 and under", "OVER $500", "Domestic battery simple", "to vehicle", "  Under and over ")
LOCATIONS = ("Street", "APARTMENT", "alley", "Bank", "sidewalk", "SCHOOL - PUBLIC", "Vacant Lot")
CODES = ("06", "08b", "14", "18", "26", "01A", "11", "08A")


class Tables:
    """Tables of one folder and the incident views derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def incidents(self) -> DataFrame:
        """Short history with coordinates, from ``events``."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            F.col("event_id").alias("id"), "ts", F.lpad((F.col("user_id") % 25).cast("string"), 4, "0").alias("beat"),
            F.upper("event_type").alias("kind"), k.alias("k"), (k % 4 == 0).cast("int").alias("arrest_flag"),
            (k % 7 == 0).cast("int").alias("domestic_flag"),
            (F.lit(41.60) + ((F.col("user_id") * 37) % 100) * F.lit(0.004)).alias("lat"),
            (F.lit(-87.90) + ((F.col("user_id") * 53) % 100) * F.lit(0.004)).alias("lng"), "value")

    @cached_property
    def long_incidents(self) -> DataFrame:
        """History of several years, from ``orders``."""
        ts = F.expr("o_orderdate + make_dt_interval(0, 0, 0, (o_orderkey * 7919) % 86400)")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"), ts.alias("ts"),
            F.lpad((F.col("o_custkey") % 25).cast("string"), 4, "0").alias("beat"),
            F.upper(F.trim("o_orderpriority")).alias("kind"),
            (F.col("o_orderstatus") == "F").cast("int").alias("arrest_flag"))

    @cached_property
    def raw(self) -> DataFrame:
        """Raw records as the first job reads them, from ``events``."""
        k = F.get_json_object("props", "$.k").cast("int")

        def pick(values: tuple[str, ...], index) -> F.Column:
            return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))

        text = (F.when(F.col("event_id") % 50 == 0, "unknown")
                .when(F.col("event_id") % 2 == 0, F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
                .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
        located = F.col("event_id") % 40 != 1
        lat = F.lit(41.60) + ((F.col("user_id") * 37) % 100) * F.lit(0.004) + F.lit(0.0013)
        lng = F.lit(-87.90) + ((F.col("user_id") * 53) % 100) * F.lit(0.004) + F.lit(0.0013)
        return self.table("events").select(
            F.col("event_id").alias("ID"), F.concat(F.lit("HX"), F.col("event_id").cast("string")).alias("Case Number"),
            text.alias("Date"), pick(TYPES, F.col("user_id") + k).alias("Primary Type"),
            pick(DESCRIPTIONS, k).alias("Description"),
            F.when(F.col("event_id") % 30 != 7, pick(LOCATIONS, F.col("user_id"))).alias("Location Description"),
            F.when(k % 4 == 0, "true").otherwise("FALSE").alias("Arrest"),
            F.when(k % 7 == 0, "TRUE").otherwise("false").alias("Domestic"),
            F.lpad((F.col("user_id") % 25).cast("string"), 4, "0").alias("Beat"),
            pick(CODES, k).alias("FBI Code"), F.when(located, lat).alias("Latitude"),
            F.when(located, lng).alias("Longitude"))


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


K = "cast(json_extract_string(props, '$.k') as int)"
VIEWS = {
    "inc": f"""SELECT event_id AS id, ts, lpad(cast(user_id % 25 AS varchar), 4, '0') AS beat, upper(event_type) AS kind,
    {K} AS k, cast({K} % 4 = 0 AS int) AS arrest_flag, cast({K} % 7 = 0 AS int) AS domestic_flag,
    cast(41.60 AS double) + ((user_id * 37) % 100) * cast(0.004 AS double) AS lat,
    cast(-87.90 AS double) + ((user_id * 53) % 100) * cast(0.004 AS double) AS lng, value,
    cast(floor(epoch(ts)) AS bigint) AS sec, cast(ts AS date) AS day FROM events""",
    "lng_inc": """SELECT o_orderkey AS id, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS ts,
    lpad(cast(o_custkey % 25 AS varchar), 4, '0') AS beat, upper(trim(o_orderpriority)) AS kind,
    cast(o_orderstatus = 'F' AS int) AS arrest_flag,
    cast(floor(epoch(o_orderdate + to_seconds((o_orderkey * 7919) % 86400))) AS bigint) AS sec,
    cast(o_orderdate AS date) AS day FROM orders""",
    "raw": f"""SELECT event_id AS "ID", 'HX' || event_id AS "Case Number",
    CASE WHEN event_id % 50 = 0 THEN 'unknown' WHEN event_id % 2 = 0 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "Date",
    ({_list(TYPES)})[(user_id + {K}) % {len(TYPES)} + 1] AS "Primary Type",
    ({_list(DESCRIPTIONS)})[{K} % {len(DESCRIPTIONS)} + 1] AS "Description",
    CASE WHEN event_id % 30 <> 7 THEN ({_list(LOCATIONS)})[user_id % {len(LOCATIONS)} + 1] END AS "Location Description",
    CASE WHEN {K} % 4 = 0 THEN 'true' ELSE 'FALSE' END AS "Arrest",
    CASE WHEN {K} % 7 = 0 THEN 'TRUE' ELSE 'false' END AS "Domestic",
    lpad(cast(user_id % 25 AS varchar), 4, '0') AS "Beat", ({_list(CODES)})[{K} % {len(CODES)} + 1] AS "FBI Code",
    CASE WHEN event_id % 40 <> 1 THEN cast(41.60 AS double) + ((user_id * 37) % 100) * cast(0.004 AS double)
         + cast(0.0013 AS double) END AS "Latitude",
    CASE WHEN event_id % 40 <> 1 THEN cast(-87.90 AS double) + ((user_id * 53) % 100) * cast(0.004 AS double)
         + cast(0.0013 AS double) END AS "Longitude" FROM events""",
}
# A series per beat and day, and its twin over the long history.
VIEWS["daily"] = "SELECT beat, day, count(*) AS n FROM inc GROUP BY ALL"
VIEWS["long_daily"] = "SELECT beat, day, count(*) AS n FROM lng_inc GROUP BY ALL"


def sql(body: str, *views: str, recursive: bool = False) -> str:
    """Prefix a statement with the views it names."""
    parts = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in views)
    head = "WITH RECURSIVE " if recursive else "WITH "
    joiner = ",\n" if body.lstrip().startswith("+") else "\n"
    return head + parts + joiner + body.lstrip().removeprefix("+") if views else body


def query(name: str, oracle: str | None = None) -> Callable:
    """Register a query under its inventory name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({name: F.round(name, digits) for name in names})
