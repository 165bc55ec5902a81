"""Catalog entries for ingest and table maintenance: L1–L5, L7, L8, L9, L11, L12, L14,
L15–L17, L20, L21, Q1, A7, A8.

Payload documents (JSON / XML) are built from the test rows with Spark's own writers, one
document per source row (bounded size), then parsed back by the gaugework readers; the
DuckDB side reads the original columns, so a match proves the parse path loses nothing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.operators.tables import (apply_changes, cascade_delete, check_unique, count_audit, retain,
                                        shift_to_now, sync_table)
from gaugework.plans.catalog import AS_OF, query, t
from gaugework.sources.forecasts import parse_forecasts, parse_warnings
from gaugework.sources.readings import clean_readings, ingest_readings, match_station, parse_reading_text, split_bad_rows
from gaugework.sources.thresholds import min_thresholds, parse_thresholds, stations_to_fetch


@query("clean_readings", """
WITH v AS (SELECT event_id, value, user_id % 2 = 0 AS post_process,
                  CASE WHEN user_id % 3 = 0 THEN NULL ELSE 100.0 END AS subtract,
                  CASE WHEN event_type = 'view' THEN 'C' ELSE 's' END AS station_type FROM events),
p AS (SELECT *, CASE WHEN post_process AND subtract IS NOT NULL THEN value - subtract ELSE value END AS proc FROM v)
SELECT event_id,
       CASE WHEN proc IS NOT NULL AND lower(station_type) <> 'c' AND proc < 0 THEN NULL ELSE proc END AS processed_value,
       CASE WHEN proc IS NOT NULL THEN lower(station_type) <> 'c' AND proc < 0 ELSE false END AS error
FROM p
""")
def q_clean_readings(spark, sf):
    e = t(spark, sf, "events").select(
        "event_id", "value", (F.col("user_id") % 2 == 0).alias("post_process"),
        F.when(F.col("user_id") % 3 == 0, F.lit(None)).otherwise(F.lit(100.0)).alias("subtract"),
        F.when(F.col("event_type") == "view", "C").otherwise("s").alias("station_type"))
    return clean_readings(e).select("event_id", "processed_value", "error")


MATCH_CTX_SQL = """
ctx AS (SELECT CAST(c.c_custkey AS VARCHAR) AS telemetry_id, r.r_name AS region, c.c_custkey AS rloi_id,
               CAST(c.c_acctbal AS DECIMAL(12, 2)) AS por_max_value,
               CAST(c.c_acctbal AS DECIMAL(12, 2)) * 0.5 AS d_por_max_value
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
lk AS (SELECT 'EA ' || r_name AS region_name, r_name AS context_region_name FROM region),
hdr AS (SELECT e.event_id, CAST(e.user_id AS VARCHAR) AS station, 'EA ' || r.r_name AS region, e.event_type AS qualifier
        FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5)"""


@query("match_station", f"""
WITH {MATCH_CTX_SQL}
SELECT h.event_id, c.rloi_id, h.region,
       CAST(round(CASE WHEN position('click' IN lower(h.qualifier)) > 0 THEN c.d_por_max_value
                       ELSE c.por_max_value END, 1) AS DOUBLE) AS por_max_value
FROM hdr h JOIN lk ON h.region = lk.region_name
JOIN ctx c ON h.station = c.telemetry_id AND lk.context_region_name = c.region
""")
def q_match_station(spark, sf):
    c, n, r = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "region")
    acct = F.col("c_acctbal").cast("decimal(12,2)")
    ctx = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
           .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
           .select(F.col("c_custkey").cast("string").alias("telemetry_id"), F.col("r_name").alias("region"),
                   F.col("c_custkey").alias("rloi_id"), F.lit(None).cast("string").alias("station_type"),
                   F.lit(None).cast("boolean").alias("post_process"), F.lit(None).cast("double").alias("subtract"),
                   acct.alias("por_max_value"), (acct * F.lit(0.5).cast("decimal(1,1)")).alias("d_por_max_value"),
                   acct.alias("percentile_5"), acct.alias("d_percentile_5")))
    lk = r.select(F.concat(F.lit("EA "), "r_name").alias("region_name"), F.col("r_name").alias("context_region_name"))
    e = t(spark, sf, "events")
    hdr = (e.join(F.broadcast(r), r.r_regionkey == e.user_id % 5)
           .select("event_id", F.col("user_id").cast("string").alias("station"),
                   F.concat(F.lit("EA "), "r_name").alias("region"), F.col("event_type").alias("qualifier")))
    m = match_station(hdr, ctx, lk, dp=1, marker="click")
    return m.select("event_id", "rloi_id", "region", F.col("por_max_value").cast("double").alias("por_max_value"))


@query("reject_split", """
WITH s AS (SELECT event_type,
                  CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_text,
                  CASE WHEN event_id % 17 = 0 THEN '2024-13-45' ELSE strftime(ts, '%Y-%m-%d') END AS d,
                  strftime(ts, '%H:%M:%S') AS t FROM events),
p AS (SELECT event_type, TRY_CAST(value_text AS DOUBLE) AS v, try_strptime(d || ' ' || t, '%Y-%m-%d %H:%M:%S') AS ts FROM s)
SELECT event_type,
       count(CASE WHEN v IS NOT NULL AND ts IS NOT NULL THEN 1 END) AS n_good,
       count(CASE WHEN v IS NULL THEN 1 END) AS n_bad_value,
       count(CASE WHEN v IS NOT NULL AND ts IS NULL THEN 1 END) AS n_bad_timestamp,
       round(sum(CASE WHEN v IS NOT NULL AND ts IS NOT NULL THEN v END), 2) AS good_total
FROM p GROUP BY event_type
""")
def q_reject_split(spark, sf):
    e = t(spark, sf, "events")
    s = e.select("event_type",
                 F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value_text"),
                 F.when(F.col("event_id") % 17 == 0, F.lit("2024-13-45")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("d"),
                 F.date_format("ts", "HH:mm:ss").alias("t"))
    p = s.select("event_type", F.col("value_text").try_cast("double").alias("v"),
                 F.try_to_timestamp(F.concat("d", F.lit(" "), "t"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"))
    good, bad = split_bad_rows(p, {"bad_value": F.col("v").isNotNull(), "bad_timestamp": F.col("ts").isNotNull()})
    g = good.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_good"), F.round(F.sum("v"), 2).alias("good_total"))
    b = bad.groupBy("event_type").agg(
        F.count(F.when(F.col("reject_reason") == "bad_value", 1)).alias("n_bad_value"),
        F.count(F.when(F.col("reject_reason") == "bad_timestamp", 1)).alias("n_bad_timestamp"))
    out = g.join(b, "event_type", "full_outer")
    return out.select("event_type", F.coalesce("n_good", F.lit(0)).alias("n_good"),
                      F.coalesce("n_bad_value", F.lit(0)).alias("n_bad_value"),
                      F.coalesce("n_bad_timestamp", F.lit(0)).alias("n_bad_timestamp"), "good_total")


def _reading_docs(spark, sf):
    """One reading file per event, built with ``to_json`` (attributes under ``$``, text under ``_``)."""
    e = t(spark, sf, "events", balance=True)
    d, tm = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    value = F.struct(F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')).alias("_"),
                     F.struct(d.alias("date"), tm.alias("time")).alias("$"))
    sov = F.struct(F.struct(d.alias("startDate"), tm.alias("startTime"), d.alias("endDate"), tm.alias("endTime"),
                            F.lit("Water Level").alias("parameter"), F.col("event_type").alias("qualifier"),
                            F.lit("m").alias("units")).alias("$"),
                   F.array(value).alias("Value"))
    station = F.struct(F.struct(F.col("user_id").cast("string").alias("stationReference"),
                                F.lit("EA Test").alias("region")).alias("$"), F.array(sov).alias("SetofValues"))
    doc = F.to_json(F.struct(F.struct(F.array(station).alias("Station")).alias("EATimeSeriesDataExchangeFormat")))
    return e.select(F.concat(F.lit("readings-"), F.col("event_id").cast("string"), F.lit(".json")).alias("filename"),
                    doc.alias("json"))


@query("json_flatten", """
SELECT user_id, event_type, date_trunc('second', ts) AS ts, value FROM events
""")
def q_json_flatten(spark, sf):
    headers, values = ingest_readings(parse_reading_text(_reading_docs(spark, sf)))
    j = values.join(headers, "telemetry_value_parent_id")
    return j.select(F.col("station").cast("bigint").alias("user_id"), F.col("qualifier").alias("event_type"),
                    F.col("value_timestamp").cast("timestamp_ntz").alias("ts"),
                    F.col("value_text").try_cast("double").alias("value"))


def _xml_attr(name, col):
    return F.concat(F.lit(f' {name}="'), col, F.lit('"'))


def q_xml_forecasts(spark, sf):
    """Forecast XML documents built from the events (one per event; 'error' events are
    'Flow' series), parsed and kept to 'Water Level'."""
    e = t(spark, sf, "events", balance=True)
    d, tm = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    param = F.when(F.col("event_type") == "error", "Flow").otherwise("Water Level")
    xml = F.concat(
        F.lit('<EATimeSeriesDataExchangeFormat xmlns="urn:ts" xmlns:md="urn:md"><md:Date>'), d,
        F.lit("</md:Date><md:Time>"), tm, F.lit("</md:Time><Station"),
        _xml_attr("stationReference", F.col("user_id").cast("string")), _xml_attr("stationName", F.lit("s")),
        F.lit("><SetofValues"), _xml_attr("parameter", param), _xml_attr("qualifier", F.col("event_type")),
        _xml_attr("units", F.lit("m")), _xml_attr("startDate", d), _xml_attr("startTime", tm),
        F.lit("><Value"), _xml_attr("date", d), _xml_attr("time", tm), F.lit(">"), F.col("value").cast("string"),
        F.lit("</Value></SetofValues><SetofValues parameter=\"Flow\"/></Station></EATimeSeriesDataExchangeFormat>"))
    files = e.select(F.concat(F.lit("ffoi-"), F.col("event_id").cast("string"), F.lit(".xml")).alias("filename"),
                     xml.alias("xml"))
    return parse_forecasts(files).filter(F.col("parameter") == "Water Level")


@query("xml_flatten", """
SELECT CAST(user_id AS VARCHAR) AS station_reference, event_type AS qualifier,
       date_trunc('second', ts) AS forecast_date, value
FROM events WHERE event_type <> 'error'
""")
def q_xml_flatten(spark, sf):
    f = q_xml_forecasts(spark, sf)
    return f.select("station_reference", "qualifier", F.col("forecast_date").cast("timestamp_ntz").alias("forecast_date"),
                    F.col("values")[0]["value"].alias("value"))


@query("warnings_xml", """
SELECT CAST(o_orderkey AS VARCHAR) AS fwa_code, CAST(substr(o_orderpriority, 1, 1) AS SMALLINT) AS severity_value,
       o_orderdate AS time_raised, o_orderstatus AS rim
FROM orders
""")
def q_warnings_xml(spark, sf):
    o = t(spark, sf, "orders", balance=True)
    xml = F.concat(F.lit('<warningreport xmlns="urn:fwis"><warning'),
                   _xml_attr("fwacode", F.col("o_orderkey").cast("string")),
                   _xml_attr("severityvalue", F.substring("o_orderpriority", 1, 1)),
                   _xml_attr("timeraised", F.date_format("o_orderdate", "dd MM yyyy HH mm")),
                   F.lit("><rim_english>"), F.col("o_orderstatus"), F.lit("</rim_english></warning></warningreport>"))
    files = o.select(F.lit("fwis-1.xml").alias("filename"), xml.alias("xml"))
    w = parse_warnings(files)
    return w.select("fwa_code", "severity_value", F.col("time_raised").cast("timestamp_ntz").alias("time_raised"), "rim")


THRESHOLD_ROWS_SQL = """
th AS (SELECT l_orderkey AS station_id, l_linenumber, l_partkey,
              CASE WHEN l_linenumber % 3 = 0 THEN 'Flow' WHEN l_linenumber % 3 = 1 THEN 'Level' ELSE NULL END AS parameter,
              CASE WHEN l_returnflag = 'R' THEN 'Downstream Stage' ELSE 'Stage' END AS qualifier,
              CASE l_partkey % 8 WHEN 0 THEN 'FW ACT FW' WHEN 1 THEN 'FW ACTCON FW' WHEN 2 THEN 'FW RES FW'
                   WHEN 3 THEN 'FW ACT FAL' WHEN 4 THEN 'FW ACTCON FAL' WHEN 5 THEN 'FW RES FAL'
                   WHEN 6 THEN 'FW RES FWS' ELSE 'Other' END AS ttype,
              l_quantity / 10 AS level,
              '0' || CAST(l_suppkey % 90 + 10 AS VARCHAR) || CASE WHEN l_partkey % 2 = 0 THEN 'WAF' ELSE 'FWF' END
                  || CAST(l_partkey AS VARCHAR) AS code
       FROM lineitem)"""


def _threshold_payloads(spark, sf):
    """Payload documents: an array with one station object (the order) holding one series
    (a line item) that carries one threshold."""
    li = t(spark, sf, "lineitem", balance=True)
    k8 = F.col("l_partkey") % 8
    ttype = (F.when(k8 == 0, "FW ACT FW").when(k8 == 1, "FW ACTCON FW").when(k8 == 2, "FW RES FW")
             .when(k8 == 3, "FW ACT FAL").when(k8 == 4, "FW ACTCON FAL").when(k8 == 5, "FW RES FAL")
             .when(k8 == 6, "FW RES FWS").otherwise("Other"))
    code = F.concat(F.lit("0"), (F.col("l_suppkey") % 90 + 10).cast("string"),
                    F.when(F.col("l_partkey") % 2 == 0, "WAF").otherwise("FWF"), F.col("l_partkey").cast("string"))
    ln3 = F.col("l_linenumber") % 3
    series = F.struct(F.when(ln3 == 0, "Flow").when(ln3 == 1, "Level").alias("Parameter"),
                      F.when(F.col("l_returnflag") == "R", "Downstream Stage").otherwise("Stage").alias("qualifier"),
                      F.lit("m").alias("Unit"), (F.col("l_linenumber") % 2 == 1).alias("DisplayTimeSeries"),
                      F.array(F.struct(ttype.alias("ThresholdType"), (F.col("l_quantity") / 10).alias("Level"),
                                       code.alias("FloodWarningArea"))).alias("Thresholds"))
    # one payload document per series (a station object holding that series): no shuffle
    doc = F.to_json(F.array(F.struct(F.col("l_orderkey").cast("string").alias("RLOIid"),
                                     F.lit(None).cast("string").alias("wiskiID"),
                                     F.lit(None).cast("string").alias("telemetryID"),
                                     F.lit("n").alias("Name"),
                                     F.array(series).alias("TimeSeriesMetaData"))))
    return li.select(doc.alias("json"))


@query("thresholds_parse", f"""
WITH {THRESHOLD_ROWS_SQL}
SELECT station_id, code AS fwis_code, substr(code, 5, 1) AS fwis_type,
       CASE WHEN qualifier = 'Downstream Stage' THEN 'd' ELSE 'u' END AS direction, level AS value
FROM th
WHERE parameter IS DISTINCT FROM 'Flow'
  AND ttype IN ('FW ACT FW', 'FW ACTCON FW', 'FW RES FW', 'FW ACT FAL', 'FW ACTCON FAL', 'FW RES FAL')
""")
def q_thresholds_parse(spark, sf):
    return parse_thresholds(_threshold_payloads(spark, sf)).select("station_id", "fwis_code", "fwis_type",
                                                                   "direction", "value")


@query("thresholds_min", f"""
WITH {THRESHOLD_ROWS_SQL},
p AS (SELECT station_id, lower(substr(code, 5, 1)) AS k,
             CASE WHEN qualifier = 'Downstream Stage' THEN 'd' ELSE 'u' END AS direction, level
      FROM th
      WHERE parameter IS DISTINCT FROM 'Flow'
        AND ttype IN ('FW ACT FW', 'FW ACTCON FW', 'FW RES FW', 'FW ACT FAL', 'FW ACTCON FAL', 'FW RES FAL'))
SELECT station_id,
       min(CASE WHEN direction = 'd' AND k = 'a' THEN level END) AS downstream_alert,
       min(CASE WHEN direction = 'd' AND k = 'w' THEN level END) AS downstream_warning,
       min(CASE WHEN direction = 'u' AND k = 'a' THEN level END) AS upstream_alert,
       min(CASE WHEN direction = 'u' AND k = 'w' THEN level END) AS upstream_warning
FROM p GROUP BY station_id
""")
def q_thresholds_min(spark, sf):
    return min_thresholds(parse_thresholds(_threshold_payloads(spark, sf)))


@query("sync_table", """
WITH cur AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0),
inc AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
        FROM customer WHERE c_custkey % 3 <> 0)
SELECT coalesce(i.c_custkey, c.c_custkey) AS c_custkey,
       CASE WHEN i.c_custkey IS NULL THEN c.c_name ELSE i.c_name END AS c_name,
       CASE WHEN i.c_custkey IS NULL THEN c.c_acctbal ELSE i.c_acctbal END AS c_acctbal,
       CASE WHEN c.c_custkey IS NULL THEN 'insert' WHEN i.c_custkey IS NULL THEN 'delete'
            WHEN c.c_name IS NOT DISTINCT FROM i.c_name AND c.c_acctbal IS NOT DISTINCT FROM i.c_acctbal THEN 'same'
            ELSE 'update' END AS change
FROM cur c FULL OUTER JOIN inc i ON c.c_custkey = i.c_custkey
""")
def q_sync_table(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    cur = c.filter(F.col("c_custkey") % 2 == 0)
    inc = c.filter(F.col("c_custkey") % 3 != 0).withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return sync_table(cur, inc, ["c_custkey"], with_change=True)


@query("apply_changes", """
WITH del AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'),
ups AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM del) AND o_orderkey NOT IN (SELECT o_orderkey FROM ups)
UNION ALL SELECT * FROM ups
""")
def q_apply_changes(spark, sf):
    o = t(spark, sf, "orders")
    base = o.select("o_orderkey", "o_custkey", "o_totalprice")
    dels = o.filter(F.col("o_orderpriority") == "5-LOW").select("o_orderkey")
    ups = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey",
                                                          (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return apply_changes(base, ups, dels, ["o_orderkey"])


@query("cascade_delete", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW')
""")
def q_cascade_delete(spark, sf):
    o = t(spark, sf, "orders")
    parent = apply_changes(o.select("o_orderkey", "o_orderpriority"),
                           deletes=o.filter(F.col("o_orderpriority") == "5-LOW").select("o_orderkey"),
                           key=["o_orderkey"])
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return cascade_delete(parent, li, ["l_orderkey"], ["o_orderkey"])


@query("retain", """
WITH kept AS (SELECT o_orderkey, o_orderdate FROM orders
              WHERE o_orderdate >= TIMESTAMP '2001-01-01' - INTERVAL 63072000 SECOND)
SELECT l.l_orderkey, l.l_linenumber, k.o_orderdate FROM lineitem l JOIN kept k ON l.l_orderkey = k.o_orderkey
""")
def q_retain(spark, sf):
    kept = retain(t(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 63072000,
                  "2001-01-01 00:00:00")
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return cascade_delete(kept, li, ["l_orderkey"], ["o_orderkey"]).join(
        kept.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")


@query("time_shift", f"""
SELECT event_id, ts + (TIMESTAMP '{AS_OF}' - (SELECT max(ts) FROM events)) AS ts FROM events
""")
def q_time_shift(spark, sf):
    e = t(spark, sf, "events")
    return shift_to_now(e.select("event_id", "ts"), ["ts"], e, "ts", AS_OF)


@query("clean_text", r"""
SELECT doc_id, regexp_replace(text, '[\r\n]+', ' ', 'g') AS text FROM documents
""")
def q_clean_text(spark, sf):
    from gaugework.sources.delimited import clean_impacts
    d = t(spark, sf, "documents", balance=True).select("doc_id", "text")
    return clean_impacts(d, drop=())


@query("key_check", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_key_check(spark, sf):
    return check_unique(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("count_audit", """
SELECT 'part' AS "table", 'before' AS stage, count(*) AS n FROM part
UNION ALL SELECT 'part', 'after', count(*) FROM part WHERE p_size > 10
UNION ALL SELECT 'lineitem', 'rows', count(*) FROM lineitem
""")
def q_count_audit(spark, sf):
    from gaugework.sources.delimited import replace_areas
    p = t(spark, sf, "part")
    _, audit = replace_areas(p, p.filter(F.col("p_size") > 10), "part")
    li = count_audit(lineitem=t(spark, sf, "lineitem")).select("table", F.lit("rows").alias("stage"), "n")
    return audit.unionByName(li)


@query("fetch_list", """
SELECT DISTINCT l_suppkey AS rloi_id FROM lineitem WHERE l_suppkey IS NOT NULL
""")
def q_fetch_list(spark, sf):
    li = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("rloi_id"))
    return stations_to_fetch(li)


@query("display_flags", f"""
WITH {THRESHOLD_ROWS_SQL}
SELECT station_id, CASE WHEN qualifier = 'Downstream Stage' THEN 'd' ELSE 'u' END AS direction,
       bool_or(l_linenumber % 2 = 1) AS display_time_series
FROM th GROUP BY ALL
""")
def q_display_flags(spark, sf):
    """V13 (inferred): one display flag per (station, direction) from DisplayTimeSeries."""
    from gaugework.plans.views import display_flags
    return display_flags(_threshold_payloads(spark, sf))


@query("forecast_max", """
WITH f AS (SELECT CAST(user_id AS VARCHAR) AS station_reference, ts, value FROM events WHERE event_type <> 'error')
SELECT station_reference AS rloi_id, max(value) AS value,
       arg_max(date_trunc('second', ts), (value, -epoch_us(date_trunc('second', ts)))) AS value_date
FROM f GROUP BY station_reference
""")
def q_forecast_max(spark, sf):
    """A10 (inferred): per station the highest forecast value and its earliest time, from
    forecast XML documents (one per source row)."""
    from gaugework.sources.forecasts import forecast_max
    fc = q_xml_forecasts(spark, sf).withColumnRenamed("station_reference", "rloi_id")
    return forecast_max(fc, "rloi_id").select("rloi_id", "value",
                                              F.col("value_date").cast("timestamp_ntz").alias("value_date"))


@query("membership", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def q_membership(spark, sf):
    """literal IN list, IN (subquery) as a semi join, NOT IN (subquery) as an anti join
    (the subquery has no NULL keys, so both NULL policies agree)."""
    from gaugework.functions.predicates import anti, in_list, semi
    c = t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    o = t(spark, sf, "orders")
    done = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    out = semi(c.filter(in_list("c_mktsegment", ["BUILDING", "MACHINERY"])), done, ["c_custkey"])
    return anti(out, urgent, ["c_custkey"], null_keys="sql_not_in")


@query("not_in_with_null", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 1000 = 7 THEN NULL ELSE o_custkey END FROM orders
                        WHERE o_orderpriority = '1-URGENT')
""")
def q_not_in_with_null(spark, sf):
    """§2.11 item 9: SQL NOT IN against a subquery holding a NULL returns no rows."""
    from gaugework.functions.predicates import anti
    c = t(spark, sf, "customer").select("c_custkey")
    o = t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    sub = o.select(F.when(F.col("o_orderkey") % 1000 == 7, F.lit(None)).otherwise(F.col("o_custkey")).alias("c_custkey"))
    return anti(c, sub, ["c_custkey"], null_keys="sql_not_in")
