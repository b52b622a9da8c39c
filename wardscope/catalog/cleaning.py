"""Projections, filters, cleaning and scalar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.catalog.base import Tables, query, rounded, sql
from wardscope.functions import calendar, categories, cleaning, numeric
from wardscope.operators.aggregates import first_by, mode_by
from wardscope.operators.joins import attach_statics


@query("p1_drop_columns", sql("SELECT id, beat, kind, arrest_flag FROM lng_inc", "lng_inc"))
def _(t: Tables) -> DataFrame:
    return cleaning.drop_columns(t.long_incidents, ["ts", "Ward", "Community Area"])


@query("p2_dedup", sql("SELECT DISTINCT beat, kind, arrest_flag, domestic_flag FROM inc", "inc"))
def _(t: Tables) -> DataFrame:
    return cleaning.dedup(t.incidents.select("beat", "kind", "arrest_flag", "domestic_flag"))


@query("p3_normalize_text", sql('SELECT "ID", upper(trim("Primary Type")) AS kind FROM raw', "raw"))
def _(t: Tables) -> DataFrame:
    return t.raw.select("ID", cleaning.normalize_text(F.col("Primary Type")).alias("kind"))


@query("p4_parse_timestamp", sql(
    """SELECT id, sec FROM (SELECT "ID" AS id, cast(floor(epoch(coalesce(try_strptime("Date", '%m/%d/%Y %I:%M:%S %p'),
    try_strptime("Date", '%Y-%m-%d %H:%M:%S')))) AS bigint) AS sec FROM raw) WHERE sec IS NOT NULL""", "raw"))
def _(t: Tables) -> DataFrame:
    parsed = cleaning.with_timestamp(t.raw, "Date", "Date_TS").withColumn("local", F.col("Date_TS").cast("timestamp_ntz"))
    return parsed.select(F.col("ID").alias("id"), calendar.epoch_seconds(parsed, "local").alias("sec"))


@query("p5_calendar_parts", sql(
    """SELECT id, cast(year(ts) AS int) AS "Year", cast(month(ts) AS int) AS "Month", cast(hour(ts) AS int) AS "Hour",
    cast(dayofweek(ts) + 1 AS int) AS "Weekday", cast(dayofweek(ts) IN (0, 6) AS int) AS "IsWeekend" FROM lng_inc""",
    "lng_inc"))
def _(t: Tables) -> DataFrame:
    return calendar.calendar_parts(t.long_incidents.select("id", "ts"), "ts").drop("ts")


@query("p6_calendar_parts_monday", sql(
    """SELECT id, cast(isodow(ts) - 1 AS int) AS "Weekday", cast(isodow(ts) >= 6 AS int) AS "IsWeekend",
    cast(month(ts) AS int) AS "Month" FROM lng_inc""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    return calendar.calendar_parts_monday(t.long_incidents.select("id", "ts"), "ts").drop("ts")


@query("p7_season", sql(
    """SELECT id, CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) <= 5 THEN 'Spring'
    WHEN month(ts) <= 8 THEN 'Summer' ELSE 'Fall' END AS season FROM lng_inc""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    return t.long_incidents.select("id", calendar.season(F.month("ts")).alias("season"))


@query("p8_time_slot", sql(
    """SELECT id, CASE WHEN hour(ts) <= 5 OR hour(ts) = 23 THEN 'Night' WHEN hour(ts) <= 11 THEN 'Morning'
    WHEN hour(ts) <= 17 THEN 'Afternoon' ELSE 'Evening' END AS slot FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    return t.incidents.select("id", calendar.time_slot(F.hour("ts")).alias("slot"))


@query("p9_year_group", sql(
    """SELECT id, CASE WHEN y BETWEEN 2001 AND 2005 THEN '2001–2005' WHEN y BETWEEN 2006 AND 2010 THEN '2006–2010'
    WHEN y BETWEEN 2011 AND 2015 THEN '2011–2015' WHEN y BETWEEN 2016 AND 2020 THEN '2016–2020' ELSE '2021–2025' END
    AS year_group FROM (SELECT id, year(ts) + id % 30 AS y FROM lng_inc)""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    return t.long_incidents.select("id", calendar.year_group(F.year("ts") + F.col("id") % 30).alias("year_group"))


@query("p10_era_flags", sql(
    """SELECT id, cast(y IN (2020, 2021) AS int) AS "Is_Covid_Era", cast(y >= 2016 AS int) AS "Is_Post_Reform"
    FROM (SELECT id, year(ts) + id % 30 AS y FROM lng_inc)""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    years = t.long_incidents.select("id", (F.year("ts") + F.col("id") % 30).alias("Year"))
    return calendar.era_flags(years).drop("Year")


@query("p11_fold_categories",
       "SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'LARGE', 'SMALL') THEN p_type ELSE 'OTHER' END AS folded FROM part")
def _(t: Tables) -> DataFrame:
    return t.table("part").select("p_partkey", categories.fold_categories(F.col("p_type"), ["PROMO", "LARGE", "SMALL"])
                                  .alias("folded"))


@query("p12_contains_rules", sql(
    """SELECT "ID", CASE WHEN instr(upper("Description"), 'UNDER') > 0 THEN 'UNDER_500'
    WHEN instr(upper("Description"), 'OVER') > 0 THEN 'OVER_500'
    WHEN instr(upper("Description"), 'DOMESTIC') > 0 THEN 'DOMESTIC' ELSE 'OTHER' END AS grouped FROM raw""", "raw"))
def _(t: Tables) -> DataFrame:
    text = cleaning.normalize_text(F.col("Description"))
    return t.raw.select("ID", categories.contains_rules(text, categories.DESCRIPTION_RULES).alias("grouped"))


@query("p13_prefix_rules", sql(
    """SELECT "ID", CASE WHEN c LIKE '06%' THEN 'THEFT' WHEN c LIKE '08B%' THEN 'ASSAULT' WHEN c LIKE '14%' THEN 'VANDALISM'
    WHEN c LIKE '18%' THEN 'DRUG VIOLATION' WHEN c LIKE '26%' THEN 'WEAPONS' WHEN c LIKE '01A%' THEN 'HOMICIDE'
    ELSE 'OTHER' END AS category FROM (SELECT "ID", upper(trim("FBI Code")) AS c FROM raw)""", "raw"))
def _(t: Tables) -> DataFrame:
    code = cleaning.normalize_text(F.col("FBI Code"))
    return t.raw.select("ID", categories.prefix_rules(code, categories.CODE_RULES).alias("category"))


@query("p14_bool_flag", sql(
    """SELECT "ID", CASE upper("Arrest") WHEN 'TRUE' THEN 1 WHEN 'FALSE' THEN 0 END AS arrest, 0 AS absent FROM raw""", "raw"))
def _(t: Tables) -> DataFrame:
    return t.raw.select("ID", cleaning.bool_flag(t.raw, "Arrest").alias("arrest"),
                        cleaning.bool_flag(t.raw, "Unfounded").alias("absent"))


@query("p15_composite_key", sql(
    "SELECT id, concat_ws('_', CASE WHEN id % 5 > 0 THEN kind END, cast(domestic_flag AS varchar)) AS context FROM inc",
    "inc"))
def _(t: Tables) -> DataFrame:
    kind = F.when(F.col("id") % 5 > 0, F.col("kind"))
    return t.incidents.select("id", cleaning.composite_key("_", kind, F.col("domestic_flag").cast("string")).alias("context"))


@query("p16_geo_bin", sql(
    """SELECT "ID", round("Latitude", 2) AS "Lat_Bin", round("Longitude", 2) AS "Lng_Bin" FROM raw
    WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL""", "raw"))
def _(t: Tables) -> DataFrame:
    return cleaning.geo_bin(t.raw.select("ID", "Latitude", "Longitude")).select("ID", "Lat_Bin", "Lng_Bin")


@query("p17_fill_nulls", sql(
    """SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN k END, 0) AS count_col, CASE WHEN id % 3 = 0 THEN value END AS rate
    FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    thirds = F.col("id") % 3 == 0
    rows = t.incidents.select("id", F.when(thirds, F.col("k")).alias("count_col"), F.when(thirds, F.col("value")).alias("rate"))
    return cleaning.fill_nulls(rows, ["count_col", "absent"])


@query("p18_time_keys", sql(
    """SELECT id, day AS "Date_Only", sec AS "Timestamp_Unix", cast(date_trunc('month', ts) AS date) AS "YearMonthDate"
    FROM lng_inc""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    return calendar.time_keys(t.long_incidents.select("id", "ts"), "ts").drop("ts")


@query("p19_week_key", sql("SELECT id, cast(date_trunc('week', ts) AS date) AS week FROM lng_inc", "lng_inc"))
def _(t: Tables) -> DataFrame:
    return t.long_incidents.select("id", calendar.week_key("ts").alias("week"))


@query("p20_min_year", "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) >= 1998 AND o_custkey IS NOT NULL")
def _(t: Tables) -> DataFrame:
    rows = t.table("orders").filter(F.col("o_custkey").isNotNull())
    return calendar.min_year(rows, "o_orderdate", 1998).select("o_orderkey", "o_custkey")


@query("p21_cyclic", sql(
    """SELECT id, round(sin(2 * pi() * (isodow(ts) - 1) / 7.0), 9) AS "DoW_sin", round(cos(2 * pi() * (isodow(ts) - 1) / 7.0), 9)
    AS "DoW_cos", round(sin(2 * pi() * (month(ts) - 1) / 12.0), 9) AS "Mon_sin",
    round(cos(2 * pi() * (month(ts) - 1) / 12.0), 9) AS "Mon_cos" FROM lng_inc""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    parts = calendar.calendar_parts_monday(t.long_incidents.select("id", "ts"), "ts")
    waves = calendar.with_cyclic(parts).drop("ts", "Weekday", "IsWeekend", "Month")
    # Adding 0.0 turns a rounded negative zero into a plain one.
    names = [name for name in waves.columns if name != "id"]
    return waves.withColumns({name: F.round(name, 9) + F.lit(0.0) for name in names})


def _holiday_sql() -> str:
    """The holiday rules again, as a calendar of days joined to the rows."""
    fixed = "(1, 1, 1871), (6, 19, 2021), (7, 4, 1871), (11, 11, 1938), (12, 25, 1871)"
    floating = """month(d) = 1 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 AND year(d) >= 1986
      OR month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 AND year(d) >= 1971
      OR month(d) = 5 AND isodow(d) = 1 AND day(d) BETWEEN 25 AND 31 AND year(d) >= 1971
      OR month(d) = 9 AND isodow(d) = 1 AND day(d) BETWEEN 1 AND 7 AND year(d) >= 1894
      OR month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14 AND year(d) >= 1971
      OR month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28 AND year(d) >= 1942"""
    return f"""+ shifted AS (SELECT id, cast(ts + to_days(cast(id % 40 AS int) * 365) AS date) AS d FROM lng_inc),
    days AS (SELECT DISTINCT d FROM shifted), fixed(m, n, since) AS (VALUES {fixed}),
    exact AS (SELECT make_date(y, m, n) AS h FROM fixed, range(1990, 2060) AS r(y) WHERE y >= since),
    observed AS (SELECT h FROM exact UNION SELECT CASE isodow(h) WHEN 6 THEN h - 1 WHEN 7 THEN h + 1 ELSE h END FROM exact),
    holidays AS (SELECT d FROM days WHERE {floating} UNION SELECT h FROM observed)
    SELECT id, cast(d IN (SELECT d FROM holidays) AS int) AS "IsHoliday" FROM shifted"""


@query("p22_holiday_flag", sql(_holiday_sql(), "lng_inc"))
def _(t: Tables) -> DataFrame:
    day = F.date_add(F.to_date("ts"), ((F.col("id") % 40).cast("int") * 365))
    return t.long_incidents.select("id", day.alias("d")).select("id", calendar.holiday_flag(F.col("d")).alias("IsHoliday"))


@query("p23_to_number_or_zero", sql(
    "SELECT id, coalesce(try_cast(CASE WHEN id % 2 = 0 THEN kind ELSE cast(value AS varchar) END AS double), 0.0) AS number FROM inc",
    "inc"))
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("id") % 2 == 0, F.col("kind")).otherwise(F.col("value").cast("string"))
    return cleaning.to_number_or_zero(t.incidents.select("id", text.alias("number")), ["number"])


_FITS = "CASE WHEN max({0}) OVER () < 128 THEN 'tinyint' WHEN max({0}) OVER () < 32768 THEN 'smallint' ELSE 'int' END AS {0}_type"


@query("p24_narrow_types", f"""SELECT event_id, user_id, cast(value AS float) AS value, event_type, {_FITS.format('event_id')},
    {_FITS.format('user_id')}, 'float' AS value_type, 'event_type' AS categorical FROM events""")
def _(t: Tables) -> DataFrame:
    narrowed, texts = numeric.narrow_types(t.table("events").select("event_id", "user_id", "value", "event_type"))
    kinds = {f"{name}_type": F.typeof(name) for name in ("event_id", "user_id", "value")}
    wide = {name: F.col(name).cast("bigint") for name in ("event_id", "user_id")}
    return narrowed.withColumns(kinds).withColumns(wide).withColumn("categorical", F.lit(",".join(texts)))


@query("p25_drop_leakage", sql("SELECT id, ts, beat, kind FROM lng_inc", "lng_inc"))
def _(t: Tables) -> DataFrame:
    return numeric.drop_leakage(t.long_incidents, ["arrest_flag", "Arrest", "label"])


@query("p27_clip_predictions", sql(
    """+ p AS (SELECT id, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN 'NaN'::double WHEN id % 13 = 0 THEN 'Infinity'::double
    ELSE k / 2.0 - 10 END AS raw FROM inc)
    SELECT id, c AS cont, cast(round_even(c, 0) AS int) AS whole FROM (SELECT id, CASE WHEN raw IS NULL OR isnan(raw) OR isinf(raw)
    THEN 0.0::double ELSE greatest(raw, 0.0)::double END AS c FROM p)""", "inc"))
def _(t: Tables) -> DataFrame:
    number = F.col("id")
    raw = (F.when(number % 7 == 0, None).when(number % 11 == 0, float("nan")).when(number % 13 == 0, float("inf"))
           .otherwise(F.col("k") / 2.0 - 10))
    return numeric.clip_predictions(t.incidents.select("id", raw.alias("raw")), "raw", "cont", "whole").drop("raw")


@query("p28_attach_statics", sql(
    """+ modes AS (SELECT beat, hour FROM (SELECT beat, cast(hour(ts) AS int) AS hour, row_number() OVER (PARTITION BY beat
        ORDER BY count(*) DESC, hour(ts)) AS r FROM inc WHERE id % 25 > 3 GROUP BY beat, hour(ts)) WHERE r = 1),
    firsts AS (SELECT beat, first(lat ORDER BY ts, id) AS lat FROM inc WHERE beat > '0004' GROUP BY beat)
    SELECT daily.beat, daily.day, n, coalesce(hour, 0) AS hour, round(coalesce(lat, 0.0), 6) AS lat FROM daily
    LEFT JOIN modes USING (beat) LEFT JOIN firsts USING (beat)""", "inc", "daily"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents
    daily = rows.groupBy("beat", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    modes = mode_by(rows.filter("id % 25 > 3").withColumn("hour", F.hour("ts")), "beat", "hour")
    firsts = first_by(rows.filter("beat > '0004'"), "beat", ["lat"], ["ts", "id"])
    return rounded(attach_statics(daily, "beat", [modes, firsts]), "lat")
