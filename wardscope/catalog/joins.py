"""Joins and proximity edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.catalog.base import Tables, query, rounded, sql
from wardscope.operators import aggregates as agg
from wardscope.operators import joins, spatial

BINS = """bins AS (SELECT beat, first(round(lat, 2) ORDER BY ts, id) AS lat, first(round(lng, 2) ORDER BY ts, id) AS lng
    FROM inc GROUP BY beat)"""


def binned(t: Tables) -> DataFrame:
    return t.incidents.select("id", "ts", "beat", F.round("lat", 2).alias("Lat_Bin"), F.round("lng", 2).alias("Lng_Bin"))


@query("j1_join_back", sql(
    """+ g AS (SELECT beat, round(lat * 100) AS a, round(lng * 100) AS b, day, count(*) AS n FROM inc GROUP BY ALL)
    SELECT id, n FROM inc LEFT JOIN g ON inc.beat = g.beat AND round(lat * 100) = a AND round(lng * 100) = b AND inc.day = g.day""",
    "inc"))
def _(t: Tables) -> DataFrame:
    rows = joins.scaled_bins(t.incidents.withColumn("day", F.to_date("ts")), ["lat", "lng"])
    counts = agg.cell_daily_counts(rows, "beat", ["lat_Key", "lng_Key"], "day", "n")
    return joins.join_back(rows, counts, ["beat", "lat_Key", "lng_Key", "day"]).select("id", "n")


@query("j2_join_required", sql(
    """+ g AS (SELECT beat, count(*) AS n FROM inc WHERE kind = 'ERROR' AND beat > '0004' GROUP BY beat)
    SELECT id, beat, n FROM inc JOIN g USING (beat)""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", "beat", "kind")
    some = agg.group_counts(rows.filter("kind = 'ERROR' AND beat > '0004'"), ["beat"], "n")
    return joins.join_required(rows, some, ["beat"]).select("id", "beat", "n")


@query("j3_haversine_edges", sql(
    """+ c AS (SELECT beat, avg(lat) AS lat, avg(lng) AS lng FROM inc GROUP BY beat)
    SELECT src, dst, round(dist, 6) AS dist FROM (SELECT a.beat AS src, b.beat AS dst, 2 * 6371.0 * asin(sqrt(pow(sin(radians(
      b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))) AS dist
      FROM c a JOIN c b ON a.beat <> b.beat) WHERE dist <= 4.0""", "inc"))
def _(t: Tables) -> DataFrame:
    centres = agg.centroid_mean(t.incidents, "beat", "lat", "lng")
    return rounded(spatial.haversine_edges(centres, "beat", "lat", "lng", 4.0), "dist")


@query("j4_bin_edges", sql(
    f"""+ {BINS} SELECT a.beat AS src, b.beat AS dst, round(sqrt(pow(a.lat - b.lat, 2) + pow(a.lng - b.lng, 2)), 6) AS dist
    FROM bins a JOIN bins b ON a.beat <> b.beat AND sqrt(pow(a.lat - b.lat, 2) + pow(a.lng - b.lng, 2)) <= 0.065""", "inc"))
def _(t: Tables) -> DataFrame:
    return rounded(spatial.bin_edges(binned(t), "beat", ["ts", "id"], 0.065), "dist")


@query("j5_chain_edges", sql(
    """SELECT src, dst, cast(0 AS double) AS dist FROM (SELECT beat AS src, lead(beat) OVER (ORDER BY beat) AS dst FROM
    (SELECT DISTINCT beat FROM inc)) WHERE dst IS NOT NULL""", "inc"))
def _(t: Tables) -> DataFrame:
    # Without bins the choice falls on the chain.
    return spatial.proximity_edges(t.incidents.select("beat"), "beat", ["ts", "id"])


@query("j6_lookup", sql(
    """+ w AS (SELECT kind, count(*) / 10.0 AS weight FROM inc WHERE kind < 'M' GROUP BY kind)
    SELECT id, cast(coalesce(weight, 1.0) AS double) AS weight FROM inc LEFT JOIN w USING (kind)""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", "kind")
    weights = rows.filter("kind < 'M'").groupBy("kind").agg((F.count(F.lit(1)) / 10.0).alias("weight"))
    return joins.lookup(rows, weights, "kind", "weight", 1.0).select("id", "weight")
