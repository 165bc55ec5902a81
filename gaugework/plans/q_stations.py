"""Catalog entries for station-level views: V2 split, F2/J2 direction join, J3/A4 breach,
F9/F10 risk and level, and the V3 overview composed from them.

Station master = ``customer`` (rloi_id = c_custkey; readings are ``events`` with user_id as
station and event_type as qualifier). Derived station attributes:
type C/G/M/S from c_mktsegment; upstream limits c_acctbal/20 (por max, percentile 5) and
c_acctbal/40 (percentile 95); the downstream copy of an 'M' station uses /30, /25, /50.
The downstream marker inside a qualifier is 'click' (the feed's is 'downstream').
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions.levels import age_seconds, at_risk, level, trend
from gaugework.functions.predicates import direction
from gaugework.operators.ranking import latest_per_key, trailing_mean
from gaugework.operators.sets import split_directions
from gaugework.operators.windows import breaches, flag_exists
from gaugework.plans.catalog import AS_OF, query, t

MARKER = "click"

CTX_SQL = """
ctx AS (
  SELECT c_custkey AS rloi_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'C' WHEN 'MACHINERY' THEN 'G'
                           WHEN 'AUTOMOBILE' THEN 'M' ELSE 'S' END AS station_type,
         c_acctbal / 20 AS por_max_value, c_acctbal / 30 AS d_por_max_value,
         c_acctbal / 20 AS percentile_5, c_acctbal / 25 AS d_percentile_5,
         c_acctbal / 40 AS percentile_95, c_acctbal / 50 AS d_percentile_95
  FROM customer),
split AS (
  SELECT rloi_id, station_type, por_max_value, percentile_5, percentile_95, 'u' AS qualifier FROM ctx
  UNION ALL
  SELECT rloi_id, station_type, d_por_max_value, d_percentile_5, d_percentile_95, 'd' FROM ctx
  WHERE station_type = 'M')"""

DIR_JOIN_SQL = ("(s.qualifier = 'u' AND lower({q}) NOT LIKE '%click%' "
                "OR s.qualifier = 'd' AND lower({q}) LIKE '%click%')")


def station_context(spark, sf):
    c = t(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("rloi_id"),
        F.when(seg == "BUILDING", "C").when(seg == "MACHINERY", "G")
         .when(seg == "AUTOMOBILE", "M").otherwise("S").alias("station_type"),
        (F.col("c_acctbal") / 20).alias("por_max_value"), (F.col("c_acctbal") / 30).alias("d_por_max_value"),
        (F.col("c_acctbal") / 20).alias("percentile_5"), (F.col("c_acctbal") / 25).alias("d_percentile_5"),
        (F.col("c_acctbal") / 40).alias("percentile_95"), (F.col("c_acctbal") / 50).alias("d_percentile_95"),
    )


def station_split(spark, sf):
    return split_directions(station_context(spark, sf))


def station_readings(spark, sf):
    e = t(spark, sf, "events")
    return e.select(F.col("user_id").alias("rloi_id"), F.col("event_type").alias("qualifier"),
                    F.col("event_id").alias("telemetry_value_id"), F.col("ts").alias("value_timestamp"),
                    F.col("value").alias("processed_value"), F.lit(False).alias("error"))


@query("direction_split", f"""
WITH {CTX_SQL}
SELECT rloi_id, qualifier, station_type, por_max_value, percentile_5, percentile_95 FROM split
""")
def q_direction_split(spark, sf):
    return station_split(spark, sf).select("rloi_id", "qualifier", "station_type", "por_max_value",
                                           "percentile_5", "percentile_95")


@query("direction_join", f"""
WITH {CTX_SQL},
latest AS (
  SELECT user_id, event_type, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT s.rloi_id, s.qualifier AS direction, l.event_type AS qualifier, l.ts AS value_timestamp,
       l.value AS processed_value
FROM split s LEFT JOIN latest l ON s.rloi_id = l.user_id AND {DIR_JOIN_SQL.format(q='l.event_type')}
""")
def q_direction_join(spark, sf):
    lat = latest_per_key(station_readings(spark, sf), ["rloi_id", "qualifier"], "value_timestamp",
                         "telemetry_value_id")
    lat = lat.withColumn("direction", direction("qualifier", MARKER))
    s = station_split(spark, sf).select("rloi_id", F.col("qualifier").alias("direction"))
    return (s.join(lat, ["rloi_id", "direction"], "left")
            .select("rloi_id", "direction", "qualifier", "value_timestamp", "processed_value"))


@query("record_breach", f"""
WITH {CTX_SQL}
SELECT s.rloi_id, s.qualifier AS direction
FROM split s JOIN events e ON s.rloi_id = e.user_id AND {DIR_JOIN_SQL.format(q='e.event_type')}
WHERE NOT isnan(e.value) AND coalesce(e.value, 0) > s.por_max_value
GROUP BY s.rloi_id, s.qualifier
""")
def q_record_breach(spark, sf):
    r = station_readings(spark, sf).withColumn("direction", direction("qualifier", MARKER))
    lim = station_split(spark, sf).withColumnRenamed("qualifier", "direction")
    return breaches(lim, r, ["rloi_id", "direction"], "por_max_value", "processed_value", error="error")


@query("risk_and_level", f"""
WITH {CTX_SQL},
latest AS (
  SELECT user_id, event_type, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT s.rloi_id, s.qualifier AS direction, l.event_type AS qualifier,
       CASE WHEN NOT isnan(l.value) AND coalesce(l.value, 0) >= s.percentile_5 THEN true ELSE false END AS at_risk,
       CASE WHEN s.station_type = 'C' THEN '' WHEN l.value < s.percentile_95 THEN 'low'
            WHEN l.value >= s.percentile_5 THEN 'high' ELSE 'normal' END AS level
FROM split s LEFT JOIN latest l ON s.rloi_id = l.user_id AND {DIR_JOIN_SQL.format(q='l.event_type')}
""")
def q_risk_and_level(spark, sf):
    lat = latest_per_key(station_readings(spark, sf), ["rloi_id", "qualifier"], "value_timestamp",
                         "telemetry_value_id")
    lat = lat.withColumn("direction", direction("qualifier", MARKER))
    s = station_split(spark, sf).withColumnRenamed("qualifier", "direction")
    j = s.join(lat, ["rloi_id", "direction"], "left")
    return j.select("rloi_id", "direction", "qualifier",
                    at_risk("processed_value", "error", "percentile_5").alias("at_risk"),
                    level("processed_value", "percentile_5", "percentile_95", "station_type").alias("level"))


def stations_overview(split, values, forecast_stations, as_of, marker="downstream"):
    """V3 over (station split, readings, forecast station ids): latest reading per
    (station, qualifier) with the mean-of-four trend, age, record breach, risk, forecast flag and
    level, one row per station direction and matching qualifier (directions may fan out). The latest
    reading's parameter, units and raw value are carried where ``values`` has them."""
    carried = [c for c in ("parameter", "units", "value") if c in values.columns]
    latest = trailing_mean(values, ["rloi_id", "qualifier"], "value_timestamp", "telemetry_value_id",
                           "processed_value", n=4)
    latest = latest.select(
        "rloi_id", "qualifier", "processed_value", "value_timestamp", "error", *carried,
        trend("processed_value", "previous_value", previous_is_nan="previous_is_nan").alias("trend"),
        direction("qualifier", marker).alias("direction"))
    lim = split.withColumnRenamed("qualifier", "direction")
    rb = breaches(lim, values.withColumn("direction", direction("qualifier", marker)),
                  ["rloi_id", "direction"], "por_max_value", "processed_value", error="error")
    rb = rb.withColumn("por_max_breached", F.lit(True))
    out = (lim.join(latest, ["rloi_id", "direction"], "left")
           .join(rb, ["rloi_id", "direction"], "left")
           .withColumn("por_max_breached", F.coalesce("por_max_breached", F.lit(False))))
    out = flag_exists(out, forecast_stations, ["rloi_id"], "forecast")
    return out.select(
        "rloi_id", "direction", "station_type", "qualifier", "processed_value", "value_timestamp",
        "trend", age_seconds("value_timestamp", as_of).alias("age_seconds"), "por_max_breached",
        at_risk("processed_value", "error", "percentile_5").alias("at_risk"), "forecast",
        level("processed_value", "percentile_5", "percentile_95", "station_type").alias("level"),
        "error", "percentile_5", "percentile_95", *carried)


@query("stations_overview", f"""
WITH {CTX_SQL},
r AS (SELECT user_id, event_type, event_id, ts, value,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rk
      FROM events),
p AS (SELECT user_id, event_type,
             sum(CASE WHEN rk > 1 THEN CAST(round(value * 100) AS BIGINT) END) AS s,
             count(CASE WHEN rk > 1 THEN 1 END) AS n
      FROM r WHERE rk <= 5 GROUP BY user_id, event_type),
latest AS (
  SELECT r.user_id, r.event_type, r.ts, r.value,
         CASE WHEN p.n = 0 THEN 'steady'
              WHEN CAST(round(r.value * 100) AS BIGINT) > (2 * p.s + p.n) // (2 * p.n) THEN 'rising'
              WHEN CAST(round(r.value * 100) AS BIGINT) < (2 * p.s + p.n) // (2 * p.n) THEN 'falling'
              ELSE 'steady' END AS trend
  FROM r JOIN p USING (user_id, event_type) WHERE r.rk = 1),
rb AS (
  SELECT s.rloi_id, s.qualifier
  FROM split s JOIN events e ON s.rloi_id = e.user_id AND {DIR_JOIN_SQL.format(q='e.event_type')}
  WHERE NOT isnan(e.value) AND coalesce(e.value, 0) > s.por_max_value
  GROUP BY s.rloi_id, s.qualifier),
fs AS (SELECT DISTINCT o_custkey AS rloi_id FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT s.rloi_id, s.qualifier AS direction, s.station_type, l.event_type AS qualifier,
       l.value AS processed_value, l.ts AS value_timestamp, l.trend,
       CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(l.ts) AS DOUBLE) / 1000000 AS age_seconds,
       rb.rloi_id IS NOT NULL AS por_max_breached,
       CASE WHEN NOT isnan(l.value) AND coalesce(l.value, 0) >= s.percentile_5 THEN true ELSE false END AS at_risk,
       fs.rloi_id IS NOT NULL AS forecast,
       CASE WHEN s.station_type = 'C' THEN '' WHEN l.value < s.percentile_95 THEN 'low'
            WHEN l.value >= s.percentile_5 THEN 'high' ELSE 'normal' END AS level
FROM split s
LEFT JOIN latest l ON s.rloi_id = l.user_id AND {DIR_JOIN_SQL.format(q='l.event_type')}
LEFT JOIN rb ON rb.rloi_id = s.rloi_id AND rb.qualifier = s.qualifier
LEFT JOIN fs ON fs.rloi_id = s.rloi_id
""")
def q_stations_overview(spark, sf):
    fs = (t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
          .select(F.col("o_custkey").alias("rloi_id")))
    out = stations_overview(station_split(spark, sf), station_readings(spark, sf), fs, AS_OF, MARKER)
    return out.select("rloi_id", "direction", "station_type", "qualifier", "processed_value", "value_timestamp",
                      "trend", "age_seconds", "por_max_breached", "at_risk", "forecast", "level")


V10_SQL = f"""
WITH ctx AS (
  SELECT c_custkey AS rloi_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'C' WHEN 'MACHINERY' THEN 'G'
                           WHEN 'AUTOMOBILE' THEN 'M' ELSE 'S' END AS station_type,
         CASE WHEN c_custkey % 7 = 0 THEN TIMESTAMP '2024-01-29 12:00:00' END AS status_date,
         c_acctbal / 20 AS por_max_value, c_acctbal / 30 AS d_por_max_value,
         c_acctbal / 40 AS percentile_5, c_acctbal / 50 AS d_percentile_5
  FROM customer),
v AS (
  SELECT e.user_id AS rloi_id, CASE WHEN e.event_type = 'click' THEN 'Downstream click' ELSE e.event_type END AS qualifier,
         e.event_id, e.ts, e.value FROM events e),
j AS (
  SELECT v.*, c.station_type,
         position('downstream' IN lower(v.qualifier)) > 0 AS down,
         round(CASE WHEN position('downstream' IN lower(v.qualifier)) > 0 THEN c.d_por_max_value ELSE c.por_max_value END, 2) AS pm,
         round(CASE WHEN position('downstream' IN lower(v.qualifier)) > 0 THEN c.d_percentile_5 ELSE c.percentile_5 END, 2) AS p5
  FROM v JOIN ctx c USING (rloi_id)
  WHERE v.ts > TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY
    AND (c.status_date IS NULL OR v.ts >= c.status_date)
    AND ((position('downstream' IN lower(v.qualifier)) = 0) OR (position('downstream' IN lower(v.qualifier)) > 0 AND lower(c.station_type) = 'm'))),
l AS (
  SELECT j.*, timezone('Europe/London', ts::TIMESTAMPTZ) AS loc,
         ts = min(ts) OVER (PARTITION BY rloi_id, qualifier) OR ts = max(ts) OVER (PARTITION BY rloi_id, qualifier) AS edge
  FROM j),
lb AS (
  SELECT l.*,
         CASE WHEN edge OR (hour(loc) = 0 AND minute(loc) = 0) THEN strftime(loc, '%d %B %Y %-I:%M') || lower(strftime(loc, '%p'))
              WHEN hour(loc) % 6 = 0 AND minute(loc) = 0 THEN strftime(loc, '%-I:%M') || lower(strftime(loc, '%p'))
              ELSE '' END AS label
  FROM l),
arr AS (
  SELECT rloi_id, qualifier, CASE WHEN bool_or(down) AND lower(any_value(station_type)) = 'm' THEN 'd' ELSE 'u' END AS direction,
         list(value ORDER BY ts, event_id) AS processed_values, list(label ORDER BY ts, event_id) AS labels,
         list(pm ORDER BY ts, event_id) AS por_max_values, list(p5 ORDER BY ts, event_id) AS percentile_5s
  FROM lb GROUP BY rloi_id, qualifier),
pick AS (
  SELECT * FROM arr
  QUALIFY row_number() OVER (PARTITION BY rloi_id ORDER BY CASE WHEN direction = 'u' THEN 0 ELSE 1 END, qualifier) = 1)
SELECT c.rloi_id, c.station_type, p.direction, p.qualifier, p.processed_values, p.labels, p.por_max_values, p.percentile_5s
FROM ctx c LEFT JOIN pick p USING (rloi_id)
"""


@query("readings_with_context", V10_SQL)
def q_readings_with_context(spark, sf):
    """V10 over all stations: preferred direction 'u', arrays bounded to five days."""
    from gaugework.plans.views import station_readings_with_context
    c = t(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    ctx = c.select(
        F.col("c_custkey").alias("rloi_id"),
        F.when(seg == "BUILDING", "C").when(seg == "MACHINERY", "G").when(seg == "AUTOMOBILE", "M")
         .otherwise("S").alias("station_type"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit("2024-01-29 12:00:00").cast("timestamp_ntz")).alias("status_date"),
        (F.col("c_acctbal") / 20).alias("por_max_value"), (F.col("c_acctbal") / 30).alias("d_por_max_value"),
        (F.col("c_acctbal") / 40).alias("percentile_5"), (F.col("c_acctbal") / 50).alias("d_percentile_5"))
    e = t(spark, sf, "events")
    q = F.when(F.col("event_type") == "click", "Downstream click").otherwise(F.col("event_type"))
    parents = e.select("user_id", q.alias("qualifier")).distinct().select(
        F.xxhash64("user_id", "qualifier").alias("telemetry_value_parent_id"), F.col("user_id").alias("rloi_id"),
        "qualifier", F.lit("Water Level").alias("parameter"))
    values = e.select(F.xxhash64("user_id", q).alias("telemetry_value_parent_id"),
                      F.col("event_id").alias("telemetry_value_id"), F.col("value").alias("processed_value"),
                      F.col("ts").alias("value_timestamp"), F.lit(False).alias("error"))
    out = station_readings_with_context(ctx, parents, values, prefer="u", as_of=AS_OF, days=5)
    return out.select("rloi_id", "station_type", "direction", "qualifier", "processed_values", "labels",
                      "por_max_values", F.col("percentile_5s"))
