"""Aggregates per key and calendar step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.catalog.base import Tables, query, rounded, sql
from wardscope.functions.calendar import week_key
from wardscope.operators import aggregates as agg
from wardscope.operators.spatial import haversine_edges
from wardscope.operators.graph import graph_stats
from wardscope.operators.windows import rolling_mean
from wardscope.sources import row_counts


def daily(t: Tables, long: bool = False) -> DataFrame:
    """The series of counts per beat and day: ``beat, day, n``."""
    rows = t.long_incidents if long else t.incidents
    return agg.daily_counts(rows.withColumn("day", F.to_date("ts")), "beat", "day", "n")


def weekly(t: Tables) -> DataFrame:
    return agg.weekly_counts(t.long_incidents.withColumn("Week", week_key("ts")), "beat")


# Predictions with a known error, from the daily series: the target of error tables.
PREDICTED = "+ pred AS (SELECT beat, day, n AS y, n + (day(day) % 5) - 2 + 0.25 * (cast(beat AS int) % 3) AS p FROM daily)"


def predictions(t: Tables) -> DataFrame:
    shift = (F.dayofmonth("day") % 5) - 2 + F.lit(0.25) * (F.col("beat").cast("int") % 3)
    return daily(t).select("beat", "day", F.col("n").alias("y"), (F.col("n") + shift).alias("p"))


@query("a1_daily_counts", sql("SELECT beat, day, n FROM daily", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    return daily(t)


@query("a2_cell_daily_counts", sql(
    "SELECT beat, round(lat, 2) AS lat_bin, round(lng, 2) AS lng_bin, day, count(*) AS n FROM inc GROUP BY ALL", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("beat", F.round("lat", 2).alias("lat_bin"), F.round("lng", 2).alias("lng_bin"),
                              F.to_date("ts").alias("day"))
    return agg.cell_daily_counts(rows, "beat", ["lat_bin", "lng_bin"], "day", "n")


@query("a3_monthly_rate", sql(
    """SELECT beat, cast(date_trunc('month', ts) AS date) AS month, count(*) AS "Monthly_Crime_Total",
    cast(sum(arrest_flag) AS bigint) AS "Monthly_Arrests", sum(arrest_flag) / count(*) AS "Monthly_Arrest_Rate"
    FROM lng_inc GROUP BY ALL""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    rows = t.long_incidents.withColumn("month", F.trunc(F.to_date("ts"), "MONTH"))
    return agg.monthly_rate(rows, "beat", "month", "arrest_flag")


@query("a4_monthly_type_counts", sql(
    "SELECT beat, cast(date_trunc('month', ts) AS date) AS month, kind, count(*) AS ct_count FROM lng_inc GROUP BY ALL",
    "lng_inc"))
def _(t: Tables) -> DataFrame:
    rows = t.long_incidents.withColumn("month", F.trunc(F.to_date("ts"), "MONTH"))
    return agg.monthly_type_counts(rows, "beat", "month", "kind")


@query("a5_weekly_counts", sql(
    """SELECT beat, cast(date_trunc('week', ts) AS date) AS "Week", count(*) AS crime_count FROM lng_inc GROUP BY ALL""",
    "lng_inc"))
def _(t: Tables) -> DataFrame:
    return weekly(t)


@query("a6_category_mix", sql(
    """+ mix AS (SELECT beat, avg((kind = 'CLICK')::int) AS "CLICK", avg((kind = 'ERROR')::int) AS "ERROR", avg((kind = 'PURCHASE')::int) AS "PURCHASE",
    avg((kind = 'SIGNUP')::int) AS "SIGNUP", avg((kind = 'VIEW')::int) AS "VIEW" FROM inc GROUP BY beat)
    SELECT id, mix.* FROM inc JOIN mix USING (beat)""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents
    mix = agg.category_mix(rows, "beat", "kind", agg.category_values(rows, "kind"))
    return rows.select("id", "beat").join(mix, "beat", "left")


@query("a6_category_mix_unlisted", sql(
    """SELECT beat, avg((kind = 'CLICK')::int) AS "CLICK", avg((kind = 'VIEW')::int) AS "VIEW" FROM inc GROUP BY beat""", "inc"))
def _(t: Tables) -> DataFrame:
    return agg.category_mix(t.incidents, "beat", "kind", ["CLICK", "VIEW"])


@query("a7_hour_profile", sql(
    "SELECT beat, " + ", ".join(f"count(*) FILTER (hour(ts) = {h}) / count(*) AS h{h}" for h in range(24))
    + " FROM inc GROUP BY beat", "inc"))
def _(t: Tables) -> DataFrame:
    return agg.hour_profile(t.incidents, "beat", ts="ts")


@query("a8_centroid_mean", sql("SELECT beat, round(avg(lat), 6) AS lat, round(avg(lng), 6) AS lng FROM inc GROUP BY beat", "inc"))
def _(t: Tables) -> DataFrame:
    return rounded(agg.centroid_mean(t.incidents, "beat", "lat", "lng"), "lat", "lng")


@query("a9_centroid_median", sql(
    """SELECT "Beat", round(median("Latitude"), 6) AS "Latitude", round(median("Longitude"), 6) AS "Longitude" FROM raw
    WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL GROUP BY "Beat" """, "raw"))
def _(t: Tables) -> DataFrame:
    return rounded(agg.centroid_median(t.raw, "Beat"), "Latitude", "Longitude")


@query("a10_global_quantile_cap", sql(
    """+ q AS (SELECT quantile_cont(n, 0.995) AS q FROM daily)
    SELECT beat, day, n, n > q AS outlier, least(cast(n AS double), q) AS capped FROM daily, q""", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    return agg.global_quantile_cap(daily(t), "n", "outlier", "capped")


@query("a11_hotspot_label", sql(
    """+ w AS (SELECT beat, cast(date_trunc('week', ts) AS date) AS "Week", count(*) AS crime_count FROM lng_inc GROUP BY ALL),
    q AS (SELECT beat, quantile_cont(crime_count, 0.75) AS threshold FROM w GROUP BY beat)
    SELECT beat, "Week", crime_count, threshold, cast(crime_count > threshold AS int) AS is_hotspot FROM w JOIN q USING (beat)""",
    "lng_inc"))
def _(t: Tables) -> DataFrame:
    return agg.hotspot_label(weekly(t), "beat")


@query("a12_mode_by", sql(
    """SELECT beat, coalesce(k, 0) AS k FROM (SELECT beat, k, row_number() OVER (PARTITION BY beat ORDER BY n DESC, k NULLS LAST) AS r
    FROM (SELECT beat, k, count(k) AS n FROM inc GROUP BY beat, k)) WHERE r = 1""", "inc"))
def _(t: Tables) -> DataFrame:
    return agg.mode_by(t.incidents, "beat", "k")


@query("a13_first_last_by", sql(
    """SELECT beat, first(v ORDER BY ts, id) FILTER (v IS NOT NULL) AS first_value, last(v ORDER BY ts, id) FILTER (v IS NOT NULL)
    AS last_value FROM (SELECT *, CASE WHEN id % 3 > 0 THEN value END AS v FROM inc) GROUP BY beat""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("beat", "ts", "id", F.when(F.col("id") % 3 > 0, F.col("value")).alias("v"))
    firsts = agg.first_by(rows, "beat", ["v"], ["ts", "id"]).withColumnRenamed("v", "first_value")
    return firsts.join(agg.last_by(rows, "beat", ["v"], ["ts", "id"]).withColumnRenamed("v", "last_value"), "beat")


@query("a14_hardness_weights", sql(
    """+ r AS (SELECT beat, n, avg(n) OVER (PARTITION BY beat ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m FROM daily),
    b AS (SELECT beat, avg(abs(n - m)) AS mae, 1.0 / sqrt(count(*) + 1e-6) AS rarity FROM r GROUP BY beat),
    f AS (SELECT median(mae) AS mid, avg(rarity) AS mean_rarity FROM b)
    SELECT beat, round(least(greatest(0.7 * least(greatest(mae / greatest(mid, 1e-6), 0.5), 3.0) + 0.3 * rarity / mean_rarity, 0.25), 4.0), 6)
    AS weight FROM b, f""", "lng_inc", "long_daily").replace("FROM daily", "FROM long_daily"))
def _(t: Tables) -> DataFrame:
    series = rolling_mean(daily(t, long=True), ["beat"], ["day"], "n", {"mean7": 7})
    return rounded(agg.hardness_weights(series, "beat", "n", "mean7"), "weight")


@query("a15_balanced_class_weights", sql(
    """+ c AS (SELECT kind, count(*) AS n FROM inc GROUP BY kind)
    SELECT id, kind, (SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n) AS weight FROM inc JOIN c USING (kind)""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", "kind")
    return rows.join(agg.balanced_class_weights(rows, "kind"), "kind")


@query("a16_top_by_support", sql(
    "SELECT kind, count(*) AS support FROM inc GROUP BY kind ORDER BY support DESC, kind LIMIT 3", "inc"))
def _(t: Tables) -> DataFrame:
    return agg.top_by_support(t.incidents, "kind", 3)


@query("a17_citywide_daily", sql(
    """SELECT day, cast(sum(n) AS bigint) AS "Citywide_Actual" FROM long_daily GROUP BY day""", "lng_inc", "long_daily"))
def _(t: Tables) -> DataFrame:
    return agg.citywide_daily(daily(t, long=True), "day", "n", "Citywide_Actual")


@query("a18_target_summary", sql("SELECT avg(n) AS mean_actual, median(n) AS median_actual FROM daily", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    return agg.target_summary(daily(t), "n")


@query("a19_per_key_errors", sql(PREDICTED + """
    SELECT beat, round(avg(abs(p - y)), 9) AS "MAE", round(sqrt(avg((p - y) * (p - y))), 9) AS "RMSE", count(*) AS "N"
    FROM pred GROUP BY beat""", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    return rounded(agg.per_key_errors(predictions(t), "beat", "y", "p"), "MAE", "RMSE", digits=9)


@query("a20_graph_stats", sql(
    """+ c AS (SELECT beat, avg(lat) AS lat, avg(lng) AS lng FROM inc GROUP BY beat),
    e AS (SELECT a.beat AS src, b.beat AS dst FROM c a JOIN c b ON a.beat < b.beat AND 2 * 6371.0 * asin(sqrt(
      pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))) <= 2.0),
    f AS (SELECT count(*) AS n, (SELECT count(*) FROM e) AS m,
      count(*) FILTER (beat NOT IN (SELECT src FROM e UNION SELECT dst FROM e)) AS i FROM c)
    SELECT n AS n_nodes, m AS n_edges, i AS n_isolates, round(2.0 * m / (n * (n - 1)), 9)::double AS density FROM f""", "inc"))
def _(t: Tables) -> DataFrame:
    centres = agg.centroid_mean(t.incidents, "beat", "lat", "lng")
    return rounded(graph_stats(centres, haversine_edges(centres, "beat", "lat", "lng", 2.0), "beat"), "density", digits=9)


@query("a21_row_counts", "SELECT count(*) AS n_rows, 6 AS n_columns FROM events")
def _(t: Tables) -> DataFrame:
    return row_counts(t.table("events"))
