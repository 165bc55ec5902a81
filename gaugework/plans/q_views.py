"""Catalog entries for served views and reads: V7 impacts, V8 warnings with area, V11
thresholds, V9 readings JSON, F5/F6 recent filter, X7/X9 labels, A6 parallel arrays.

Areas and warnings come from ``part`` and ``supplier``: one alert area per brand numbered
1–12 and one warning area per brand 13–25 (gid = lowest p_partkey of the brand); a current
warning per supplier with code 'Brand#' || (s_suppkey % 30 + 1), even suppliers carrying a
trailing blank (bpchar joins ignore it), so brands 26–30 match no area.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions.predicates import after_status_date, recent
from gaugework.functions.timefmt import chart_label, iso_minutes
from gaugework.operators.arrays import ordered_json, parallel_arrays
from gaugework.plans.catalog import AS_OF, query, t

AREAS_SQL = """
areas AS (SELECT p_brand AS code, min(p_partkey) AS gid, CAST(substr(p_brand, 7) AS INTEGER) AS n
          FROM part GROUP BY p_brand),
alert AS (SELECT gid, code AS fws_tacode, 'Alert area ' || code AS ta_name FROM areas WHERE n <= 12),
warn AS (SELECT gid, code AS fws_tacode, 'Warning area ' || code AS ta_name FROM areas WHERE n > 12),
fwis AS (SELECT s_suppkey AS id,
                'Brand#' || CAST(s_suppkey % 30 + 1 AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN ' ' ELSE '' END AS ta_code,
                CAST(s_nationkey % 4 + 1 AS INTEGER) AS severity_value
         FROM supplier)"""


def areas(spark, sf):
    p = t(spark, sf, "part")
    a = p.groupBy(F.col("p_brand").alias("code")).agg(F.min("p_partkey").alias("gid"))
    a = a.withColumn("n", F.substring("code", 7, 10).cast("int"))
    alert = a.filter(F.col("n") <= 12).select("gid", F.col("code").alias("fws_tacode"),
                                              F.concat(F.lit("Alert area "), "code").alias("ta_name"))
    warn = a.filter(F.col("n") > 12).select("gid", F.col("code").alias("fws_tacode"),
                                            F.concat(F.lit("Warning area "), "code").alias("ta_name"))
    return alert, warn


def fwis(spark, sf):
    s = t(spark, sf, "supplier")
    code = F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 30 + 1).cast("string"),
                    F.when(F.col("s_suppkey") % 2 == 0, " ").otherwise(""))
    return s.select(F.col("s_suppkey").alias("id"), code.alias("ta_code"),
                    (F.col("s_nationkey") % 4 + 1).cast("int").alias("severity_value"))


@query("warnings_area", f"""
WITH {AREAS_SQL}
SELECT f.id, f.ta_code, f.severity_value, a.gid, 'a' AS area_type
FROM fwis f JOIN alert a ON rtrim(f.ta_code) = rtrim(a.fws_tacode)
UNION
SELECT f.id, f.ta_code, f.severity_value, w.gid, 'w'
FROM fwis f JOIN warn w ON rtrim(f.ta_code) = rtrim(w.fws_tacode)
""")
def q_warnings_area(spark, sf):
    from gaugework.plans.views import warnings_with_area
    alert, warn = areas(spark, sf)
    out = warnings_with_area(fwis(spark, sf), alert, warn, with_centroid=False)
    return out.select("id", "ta_code", "severity_value", "gid", "area_type")


THRESH_SQL = """
fst AS (SELECT o_custkey AS rloi_id, o_orderkey AS threshold_id,
               'Brand#' || CAST(o_orderkey % 28 + 1 AS VARCHAR) AS fwis_code, o_totalprice / 1000 AS value
        FROM orders)"""


def thresholds(spark, sf):
    o = t(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("rloi_id"), F.col("o_orderkey").alias("threshold_id"),
                    F.concat(F.lit("Brand#"), (F.col("o_orderkey") % 28 + 1).cast("string")).alias("fwis_code"),
                    (F.col("o_totalprice") / 1000).alias("value"))


@query("threshold_lookup", f"""
WITH {AREAS_SQL}, {THRESH_SQL}
, named AS (
  SELECT fws_tacode AS fwis_code, ta_name AS fwa_name, 'a' AS fwa_type FROM alert
  UNION ALL SELECT fws_tacode, ta_name, 'w' FROM warn
), in_force AS (SELECT ta_code AS fwis_code, severity_value AS fwa_severity FROM fwis)
SELECT rloi_id, threshold_id, fwis_code, value, fwa_name, ifnull(fwa_type, '') AS fwa_type, ifnull(fwa_severity, -1) AS fwa_severity
FROM fst LEFT JOIN named USING (fwis_code) LEFT JOIN in_force USING (fwis_code)
""")
def q_threshold_lookup(spark, sf):
    from gaugework.plans.views import threshold_rows
    alert, warn = areas(spark, sf)
    out = threshold_rows(thresholds(spark, sf), alert, warn, fwis(spark, sf))
    return out.select("rloi_id", "threshold_id", "fwis_code", "value", "fwa_name", "fwa_type", "fwa_severity")


@query("impacts_active", """
WITH newest AS (
  SELECT user_id, max_by(value, (ts, event_id)) AS level FROM events GROUP BY user_id
), highest AS (
  SELECT user_id, max(value) AS level FROM events GROUP BY user_id
), gauges AS (
  SELECT c_custkey, c_mktsegment || ' at ' || c_name AS gauge, newest.level AS seen, highest.level AS expected,
         c_custkey IN (SELECT l_suppkey FROM lineitem) AS forecast
  FROM customer LEFT JOIN newest ON newest.user_id = c_custkey LEFT JOIN highest ON highest.user_id = newest.user_id
  WHERE c_acctbal >= 0
), marks AS (
  SELECT o_orderkey AS impactid, o_custkey AS rloiid, o_totalprice / 1000 AS value, o_orderpriority AS shortname,
         CAST(-5.5 + (o_custkey % 97) * 0.07 AS DOUBLE) AS x, CAST(50.0 + (o_custkey % 89) * 0.09 AS DOUBLE) AS y
  FROM orders
)
SELECT impactid, gauge, rloiid, value, shortname,
       '{"type":"Point","coordinates":[' || regexp_replace(regexp_replace(printf('%.9f', x), '0+$', ''), '\\.$', '') || ',' ||
           regexp_replace(regexp_replace(printf('%.9f', y), '0+$', ''), '\\.$', '') || ']}' AS coordinates,
       seen AS telemetrylatest, seen >= value AS telemetryactive,
       expected AS forecastmax, expected >= value AND forecast AS forecastactive
FROM marks JOIN gauges ON rloiid = c_custkey
""")
def q_impacts_active(spark, sf):
    """V7 over whole tables: gauges are customers, impacts their orders, readings and forecasts their events; the stations
    with a forecast are the keys that occur as suppliers."""
    from gaugework.functions.geo import point
    from gaugework.plans.q_geo import _dec
    from gaugework.plans.views import impacts
    c = t(spark, sf, "customer")
    ctx = c.select(F.col("c_custkey").alias("rloi_id"), F.col("c_name").alias("agency_name"),
                   F.col("c_mktsegment").alias("wiski_river_name"),
                   F.when(F.col("c_acctbal") >= 0, "Active").otherwise("Suspended").alias("status"))
    o = t(spark, sf, "orders")
    imp = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("rloi_id"),
                   (F.col("o_totalprice") / 1000).alias("value"), F.col("o_orderpriority").alias("short_name"),
                   point(_dec("-5.5", F.col("o_custkey"), 97, "0.07"), _dec("50.0", F.col("o_custkey"), 89, "0.09")).alias("geom"))
    e = t(spark, sf, "events")
    overview = e.select(F.col("user_id").alias("rloi_id"), F.lit("u").alias("direction"),
                        F.col("event_type").alias("qualifier"), "ts", "event_id",
                        F.col("value").alias("processed_value"), F.col("user_id").alias("telemetry_id"))
    fmax = e.groupBy(F.col("user_id").alias("telemetry_id")).agg(F.max("value").alias("value"))
    fs = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("rloi_id"))
    out = impacts(imp, ctx, overview, fmax, fs, order=("ts",), tiebreak=("event_id", "qualifier"))
    return out.select("impactid", "gauge", "rloiid", "value", "shortname", "coordinates", "telemetrylatest", "telemetryactive",
                      "forecastmax", "forecastactive")


@query("readings_json", f"""
SELECT user_id, event_type,
       CAST(to_json(list({{'ts': strftime(ts, '%Y-%m-%dT%H:%MZ'), '_': value, 'err': false}}
                    ORDER BY ts DESC, event_id DESC)) AS VARCHAR) AS json
FROM events
WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY
GROUP BY user_id, event_type
""")
def q_readings_json(spark, sf):
    e = t(spark, sf, "events").filter(recent("ts", AS_OF, 5))
    return ordered_json(e, ["user_id", "event_type"], ["ts", "event_id"],
                        [iso_minutes("ts").alias("ts"), F.col("value").alias("_"), F.lit(False).alias("err")])


@query("readings_recent", """
WITH st AS (SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL
                                   ELSE TIMESTAMP '1996-01-01' + to_days(CAST(s_suppkey * 7 AS INTEGER)) END AS status_date
            FROM supplier)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_shipdate, l.l_extendedprice
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN st ON st.s_suppkey = l.l_suppkey
WHERE o.o_orderdate > TIMESTAMP '1998-08-02' - INTERVAL 5 DAY
  AND (st.status_date IS NULL OR l.l_shipdate >= st.status_date)
""")
def q_readings_recent(spark, sf):
    o = t(spark, sf, "orders").filter(recent("o_orderdate", "1998-08-02 00:00:00", 5)).select("o_orderkey")
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")
    s = t(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_acctbal") < 0, F.lit(None))
        .otherwise(F.lit("1996-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("s_suppkey") * 7))
        .alias("status_date"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
    return j.filter(after_status_date("l_shipdate", "status_date")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")


_LBL = ("CASE WHEN hour({l}) = 0 AND minute({l}) = 0 THEN strftime({l}, '%d %B %Y %-I:%M') || lower(strftime({l}, '%p')) "
        "WHEN hour({l}) % 6 = 0 AND minute({l}) = 0 THEN strftime({l}, '%-I:%M') || lower(strftime({l}, '%p')) "
        "ELSE '' END")


@query("iso_and_label", f"""
WITH e AS (SELECT event_id, ts, date_trunc('hour', ts) AS th FROM events),
l AS (SELECT event_id, ts,
             timezone('Europe/London', th::TIMESTAMPTZ) AS loc,
             timezone('Europe/London', (th + INTERVAL 182 DAY)::TIMESTAMPTZ) AS loc7
      FROM e)
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%MZ') AS iso_ts,
       {_LBL.format(l='loc')} AS label, {_LBL.format(l='loc7')} AS label_july
FROM l
""")
def q_iso_and_label(spark, sf):
    e = t(spark, sf, "events").select("event_id", "ts", F.date_trunc("hour", "ts").alias("th"))
    july = F.col("th") + F.expr("INTERVAL 182 DAYS")
    return e.select("event_id", iso_minutes("ts").alias("iso_ts"), chart_label("th").alias("label"),
                    chart_label(july).alias("label_july"))


@query("parallel_arrays", """
SELECT conv_id, list(turn ORDER BY turn) AS turns, list(role ORDER BY turn) AS roles,
       list(CAST(length(text) AS BIGINT) ORDER BY turn) AS text_lengths
FROM conversations GROUP BY conv_id
""")
def q_parallel_arrays(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", "role",
                                             F.length("text").cast("bigint").alias("text_length"))
    return parallel_arrays(c, ["conv_id"], ["turn"], ["turn", "role", "text_length"])


@query("readings_json_epoch", f"""
SELECT user_id, event_type,
       CAST(to_json(list({{'ts': epoch_us(ts) // 1000, '_': value, 'err': false}} ORDER BY ts DESC, event_id DESC)) AS VARCHAR) AS json
FROM events
WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY
GROUP BY user_id, event_type
""")
def q_readings_json_epoch(spark, sf):
    """V9b (1.1.0 form): timestamps as epoch milliseconds."""
    from gaugework.functions.timefmt import epoch_millis
    e = t(spark, sf, "events").filter(recent("ts", AS_OF, 5))
    return ordered_json(e, ["user_id", "event_type"], ["ts", "event_id"],
                        [epoch_millis("ts").alias("ts"), F.col("value").alias("_"), F.lit(False).alias("err")])


GEO_AREAS_SQL = """
sq AS (SELECT s_suppkey AS gid, CAST(-5.5 + (s_suppkey % 31) * 0.22 AS DOUBLE) AS cx,
              CAST(50.0 + (s_suppkey % 37) * 0.22 AS DOUBLE) AS cy, CAST(0.03 + (s_suppkey % 5) * 0.01 AS DOUBLE) AS h,
              s_suppkey % 2 = 0 AS holed,
              'TA' || CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 3 = 0 THEN '  ' ELSE '' END AS fws_tacode
       FROM supplier),
cen AS (SELECT gid, fws_tacode, s_gid_kind,
               (4 * h * h * cx - CASE WHEN holed THEN 4 * (h / 3) * (h / 3) * (cx + h / 2) ELSE 0 END)
                 / (4 * h * h - CASE WHEN holed THEN 4 * (h / 3) * (h / 3) ELSE 0 END) AS lon,
               cy AS lat
        FROM (SELECT *, CASE WHEN gid % 4 = 0 THEN 'w' ELSE 'a' END AS s_gid_kind FROM sq)),
fw AS (SELECT o_orderkey AS id, 'TA' || CAST(o_custkey % 1200 AS VARCHAR) AS ta_code,
              CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS severity_value
       FROM orders)"""


@query("warnings_centroid", f"""
WITH {GEO_AREAS_SQL}
SELECT DISTINCT f.id, f.ta_code, f.severity_value, c.gid, c.s_gid_kind AS area_type,
       round(c.lon, 9) AS lon, round(c.lat, 9) AS lat
FROM fw f JOIN cen c ON rtrim(f.ta_code) = rtrim(c.fws_tacode)
""")
def q_warnings_centroid(spark, sf):
    """V8 in full: warnings ⋈ alert / warning areas (bpchar join) with each area's centroid.
    Each area has its own code (as fws_tacode does); a warning names one area or none."""
    from gaugework.plans.q_geo import squares
    from gaugework.plans.views import warnings_with_area
    sq = squares(spark, sf).withColumnRenamed("area_id", "gid").withColumn(
        "fws_tacode", F.concat(F.lit("TA"), F.col("gid").cast("string"),
                               F.when(F.col("gid") % 3 == 0, F.lit("  ")).otherwise(F.lit(""))))
    alert, warn = sq.filter(F.col("gid") % 4 != 0), sq.filter(F.col("gid") % 4 == 0)
    o = t(spark, sf, "orders")
    fw = o.select(F.col("o_orderkey").alias("id"),
                  F.concat(F.lit("TA"), (F.col("o_custkey") % 1200).cast("string")).alias("ta_code"),
                  F.substring("o_orderpriority", 1, 1).cast("int").alias("severity_value"))
    out = warnings_with_area(fw, alert, warn, rings="geom")
    return out.select("id", "ta_code", "severity_value", "gid", "area_type",
                      F.round("st_centroid.lon", 9).alias("lon"), F.round("st_centroid.lat", 9).alias("lat"))


@query("legacy_warnings", """
WITH places AS (
  SELECT p_brand AS code, min(p_partkey) AS gid, CAST(substr(p_brand, 7) AS INTEGER) AS n FROM part GROUP BY p_brand
), feed AS (
  SELECT *, 'Brand#' || CAST(o_orderkey % 30 + 1 AS VARCHAR) AS fwa_code FROM orders
)
SELECT fwa_code, o_orderkey AS warning_key, o_orderstatus AS flood_type, o_orderpriority AS severity_description,
       CAST(substr(o_orderpriority, 1, 1) AS SMALLINT) AS severity, o_orderdate AS raised, o_orderpriority || ' ' || o_orderstatus AS message,
       'dial ' || CAST(gid AS VARCHAR) AS area_floodline_quickdial_id, gid, CASE WHEN n <= 12 THEN 'a' ELSE 'w' END AS area_type
FROM feed JOIN places ON rtrim(fwa_code) = rtrim(code)
""")
def q_legacy_warnings(spark, sf):
    """The older warnings view with its served names and the area's dial number."""
    from gaugework.plans.views import legacy_warnings
    alert, warn = (x.withColumn("qdial", F.concat(F.lit("dial "), F.col("gid").cast("string"))) for x in areas(spark, sf))
    o = t(spark, sf, "orders")
    feed = o.select(F.concat(F.lit("Brand#"), (F.col("o_orderkey") % 30 + 1).cast("string")).alias("fwa_code"),
                    F.col("o_orderkey").alias("warning_key"), F.col("o_orderstatus").alias("tidal"), F.col("o_orderpriority").alias("severity"),
                    F.substring("o_orderpriority", 1, 1).cast("smallint").alias("severity_value"),
                    F.col("o_orderdate").alias("time_raised"), F.concat("o_orderpriority", F.lit(" "), "o_orderstatus").alias("rim"))
    return legacy_warnings(feed, alert, warn)
