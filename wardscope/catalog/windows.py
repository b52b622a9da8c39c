"""Window operators. The twins use plain windows; the operators must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.catalog.aggregations import daily
from wardscope.catalog.base import Tables, query, sql
from wardscope.functions.calendar import week_key
from wardscope.operators import aggregates as agg
from wardscope.operators import windows as win

PAST = "ORDER BY sec, md5(cast(id AS varchar)) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
CELLS = """cells AS (SELECT beat, cast(round(lat * 100) AS bigint) AS a, cast(round(lng * 100) AS bigint) AS b, day, count(*) AS n
    FROM inc GROUP BY ALL)"""
CELL_ORDER = "PARTITION BY beat ORDER BY day, md5(concat(a, chr(31), b))"


def cells(t: Tables) -> DataFrame:
    rows = t.incidents.select("beat", F.round(F.col("lat") * 100).cast("long").alias("a"),
                              F.round(F.col("lng") * 100).cast("long").alias("b"), F.to_date("ts").alias("day"))
    return agg.cell_daily_counts(rows, "beat", ["a", "b"], "day", "n")


@query("w1_prior_count", sql(
    f"""SELECT id, count(*) OVER (PARTITION BY kind {PAST}) AS kind_count, count(*) OVER (PARTITION BY beat, kind {PAST})
    AS beat_kind_count FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", "ts", "beat", "kind")
    counts = {"kind_count": ["kind"], "beat_kind_count": ["beat", "kind"]}
    return win.prior_counts(rows, "ts", ["id"], counts).select("id", *counts)


TIED = "ORDER BY ts, md5(beat || chr(31) || kind) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


# Many rows are equal in every column here. Which of them gets which total is open, so the totals are compared per key set.
@query("w1_prior_count_ties", sql(
    f"""+ r AS (SELECT beat, kind, date_trunc('day', ts)::timestamp AS ts FROM inc), h AS (SELECT beat, kind, ts,
      count(*) OVER (PARTITION BY beat {TIED}) AS by_beat, count(*) OVER (PARTITION BY kind {TIED}) AS by_kind FROM r)
    SELECT beat, kind, ts, 'by_beat' AS total, by_beat AS n FROM h UNION ALL SELECT beat, kind, ts, 'by_kind', by_kind FROM h""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("beat", "kind", F.date_trunc("day", "ts").alias("ts"))
    found = win.prior_counts(rows, "ts", ["beat", "kind"], {"by_beat": ["beat"], "by_kind": ["kind"]})
    return found.unpivot(["beat", "kind", "ts"], ["by_beat", "by_kind"], "total", "n")


@query("w2_prior_rate", sql(
    f"""SELECT id, round(avg(arrest_flag) OVER (PARTITION BY beat, kind {PAST}) * 100.0, 2) AS arrest_rate,
    round(avg(domestic_flag) OVER (PARTITION BY beat {PAST}) * 100.0, 2) AS domestic_rate FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    rates = {"arrest_rate": (["beat", "kind"], "arrest_flag"), "domestic_rate": (["beat"], "domestic_flag")}
    return win.prior_rates(t.incidents, "ts", ["id"], rates).select("id", *rates)


@query("w3_rolling_range_count", sql(
    """SELECT id, count(*) OVER (PARTITION BY beat ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING) AS last7days
    FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    return win.rolling_range_count(t.incidents.select("id", "ts", "beat"), ["beat"], "ts", "last7days").select("id", "last7days")


@query("w4_prior_density", sql(
    f"""SELECT id, count(*) OVER (PARTITION BY kind, hour(ts) {PAST}) / nullif(count(*) OVER (PARTITION BY kind {PAST}), 0) AS density
    FROM inc""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", "ts", "kind", F.hour("ts").alias("hour"))
    return win.prior_density(rows, "ts", ["id"], "kind", "hour", "density").select("id", "density")


@query("w5_lag_by", sql(
    "SELECT beat, day, n, " + ", ".join(f"lag(n, {k}) OVER (PARTITION BY beat ORDER BY day) AS lag{k}" for k in (1, 3, 7, 14, 21))
    + " FROM long_daily", "lng_inc", "long_daily"))
def _(t: Tables) -> DataFrame:
    return win.lag_by(daily(t, long=True), ["beat"], ["day"], "n", {f"lag{k}": k for k in (1, 3, 7, 14, 21)})


@query("w6_rolling_mean_strict", sql(
    """SELECT beat, day, CASE WHEN count(n) OVER w = 3 THEN avg(n) OVER w END AS mean3 FROM long_daily
    WINDOW w AS (PARTITION BY beat ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""", "lng_inc", "long_daily"))
def _(t: Tables) -> DataFrame:
    return win.rolling_mean_strict(daily(t, long=True), ["beat"], ["day"], "n", "mean3").drop("n")


@query("w7_rolling_mean", sql(
    "SELECT beat, day, " + ", ".join(f"avg(n) OVER (PARTITION BY beat ORDER BY day ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) "
                                     f"AS mean{k}" for k in (3, 7, 14, 28)) + " FROM long_daily", "lng_inc", "long_daily"))
def _(t: Tables) -> DataFrame:
    return win.rolling_mean(daily(t, long=True), ["beat"], ["day"], "n", {f"mean{k}": k for k in (3, 7, 14, 28)}).drop("n")


@query("w8_prev_row", sql(f"+ {CELLS} SELECT beat, a, b, day, lag(n) OVER ({CELL_ORDER}) AS prev FROM cells", "inc"))
def _(t: Tables) -> DataFrame:
    order = ["day", win.tie_hash([F.col("a"), F.col("b")])]
    return win.prev_row(cells(t), ["beat"], order, "n", "prev").drop("n")


@query("w9_sigma_outlier", sql(
    f"""+ {CELLS}, h AS (SELECT *, avg(n) OVER w AS mean, stddev_samp(n) OVER w AS deviation FROM cells
    WINDOW w AS ({CELL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT beat, a, b, day, coalesce(n > mean + 3 * deviation, false) AS outlier FROM h""", "inc"))
def _(t: Tables) -> DataFrame:
    return win.sigma_outlier(cells(t), ["beat"], "day", ["a", "b"], "n", "outlier").drop("n")


@query("w10_top1_per_group", sql(
    """SELECT beat, month, kind AS top FROM (SELECT beat, cast(date_trunc('month', ts) AS date) AS month, kind, row_number() OVER
    (PARTITION BY beat, date_trunc('month', ts) ORDER BY count(*) DESC, kind) AS r FROM lng_inc GROUP BY beat, date_trunc('month', ts), kind)
    WHERE r = 1""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    rows = t.long_incidents.withColumn("month", F.trunc(F.to_date("ts"), "MONTH"))
    counts = agg.monthly_type_counts(rows, "beat", "month", "kind")
    return win.top1_per_group(counts, ["beat", "month"], "kind", "ct_count", "top")


@query("w11_latest_per", sql(
    """SELECT id, beat, kind, cast(date_trunc('week', ts) AS date) AS week FROM lng_inc QUALIFY row_number() OVER
    (PARTITION BY beat, date_trunc('week', ts) ORDER BY ts DESC, id DESC) = 1""", "lng_inc"))
def _(t: Tables) -> DataFrame:
    rows = t.long_incidents.withColumn("week", week_key("ts"))
    return win.latest_per(rows, ["beat", "week"], "ts", ["id"]).select("id", "beat", "kind", "week")


@query("w12_category_codes", sql(
    """+ v AS (SELECT id, CASE WHEN id % 9 > 0 THEN kind END AS kind FROM inc),
    c AS (SELECT kind, cast(row_number() OVER (ORDER BY kind) - 1 AS int) AS code FROM (SELECT DISTINCT kind FROM v WHERE kind IS NOT NULL))
    SELECT id, coalesce(code, -1) AS code FROM v LEFT JOIN c USING (kind)""", "inc"))
def _(t: Tables) -> DataFrame:
    rows = t.incidents.select("id", F.when(F.col("id") % 9 > 0, F.col("kind")).alias("kind"))
    return win.category_codes(rows, "kind", "code").select("id", "code")


@query("w13_positional_slice", sql(
    """SELECT beat, day, row_number() OVER (ORDER BY beat, day) <= floor(count(*) OVER () * 0.85) AS is_train FROM long_daily""",
    "lng_inc", "long_daily"))
def _(t: Tables) -> DataFrame:
    return win.positional_slice(daily(t, long=True), ["beat"], "day", 0.85, "is_train").drop("n")
