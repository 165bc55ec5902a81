"""Catalog entries for reading-centric operators (W1–W6, A1–A3, J3, F9–F11, V3 core)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions.levels import trend
from gaugework.operators.ranking import latest_per_key, top_k_per_key, trailing_mean
from gaugework.plans.catalog import AS_OF, query, t

KEYS = ["user_id", "event_type"]


def readings(spark, sf):
    return t(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")


@query("latest_per_key", """
SELECT user_id, event_type, event_id, ts, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1
""")
def q_latest_per_key(spark, sf):
    return latest_per_key(readings(spark, sf), KEYS, "ts", "event_id")


@query("top5_per_key", """
SELECT user_id, event_type, event_id, ts, value,
       CAST(rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS BIGINT) AS rank
FROM events
QUALIFY rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) <= 5
""")
def q_top5(spark, sf):
    out = top_k_per_key(readings(spark, sf), KEYS, "ts", "event_id", k=5)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("trend_mean4", """
WITH r AS (
  SELECT user_id, event_type, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rk
  FROM events),
p AS (
  SELECT user_id, event_type,
         sum(CASE WHEN rk > 1 THEN CAST(round(value * 100) AS BIGINT) END) AS s,
         count(CASE WHEN rk > 1 THEN 1 END) AS n
  FROM r WHERE rk <= 5 GROUP BY user_id, event_type)
SELECT r.user_id, r.event_type, r.event_id AS latest_event_id, r.ts AS latest_ts,
       r.value AS latest_value,
       CASE WHEN p.n > 0 THEN CAST((2 * p.s + p.n) // (2 * p.n) AS DOUBLE) / 100 END AS prev_mean,
       CASE WHEN p.n = 0 THEN 'steady'
            WHEN CAST(round(r.value * 100) AS BIGINT) > (2 * p.s + p.n) // (2 * p.n) THEN 'rising'
            WHEN CAST(round(r.value * 100) AS BIGINT) < (2 * p.s + p.n) // (2 * p.n) THEN 'falling'
            ELSE 'steady' END AS trend,
       p.n AS n_prev
FROM r JOIN p USING (user_id, event_type)
WHERE r.rk = 1
""")
def q_trend_mean4(spark, sf):
    r = trailing_mean(readings(spark, sf), KEYS, "ts", "event_id", "value", n=4)
    return r.select(
        "user_id", "event_type",
        F.col("event_id").alias("latest_event_id"), F.col("ts").alias("latest_ts"),
        F.col("value").alias("latest_value"),
        F.round("previous_value", 2).cast("double").alias("prev_mean"),
        trend("value", "previous_value", previous_is_nan="previous_is_nan").alias("trend"),
        F.col("previous_count").cast("bigint").alias("n_prev"),
    )


@query("trend_lag", """
WITH r AS (
  SELECT user_id, event_type, ts, value,
         lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rk
  FROM events)
SELECT user_id, event_type, ts AS latest_ts, value AS latest_value, prev AS previous_value,
       CASE WHEN prev IS NULL THEN 'steady'
            WHEN round(value * 100) > round(prev * 100) THEN 'rising'
            WHEN round(value * 100) < round(prev * 100) THEN 'falling'
            ELSE 'steady' END AS trend
FROM r WHERE rk = 1
""")
def q_trend_lag(spark, sf):
    from gaugework.operators.ranking import lag_value
    r = lag_value(readings(spark, sf), KEYS, "ts", "event_id", "value")
    return r.select("user_id", "event_type", F.col("ts").alias("latest_ts"),
                    F.col("value").alias("latest_value"), "previous_value",
                    trend("value", "previous_value").alias("trend"))


@query("latest_value_ties", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice
FROM lineitem
QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) = 1
""")
def q_latest_value_ties(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
                                          "l_extendedprice")
    return top_k_per_key(li, "l_orderkey", "l_shipdate", None, k=1).drop("rank")


def _nan_free(col):
    return f"CASE WHEN isnan({col}) THEN NULL ELSE {col} END"


@query("trailing_totals", f"""
WITH e AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'),
l AS (SELECT user_id, max(ts) AS latest_ts FROM e GROUP BY user_id)
SELECT e.user_id, l.latest_ts,
  round(sum(CASE WHEN e.ts > l.latest_ts - INTERVAL 24 HOUR THEN {_nan_free('e.value')} END), 2) AS day_total,
  round(sum(CASE WHEN e.ts > l.latest_ts - INTERVAL 6 HOUR THEN {_nan_free('e.value')} END), 2) AS six_hr_total,
  round(sum(CASE WHEN e.ts > l.latest_ts - INTERVAL 1 HOUR THEN {_nan_free('e.value')} END), 2) AS one_hr_total
FROM e JOIN l USING (user_id)
GROUP BY e.user_id, l.latest_ts
""")
def q_trailing_totals(spark, sf):
    from gaugework.operators.windows import trailing_totals
    rain = readings(spark, sf).filter(F.col("event_type") == "purchase")  # case-sensitive, like 'Rainfall'
    out = trailing_totals(rain, "user_id", "ts", "value")
    return out.select("user_id", "latest_ts",
                      *[F.round(c, 2).alias(c) for c in ("day_total", "six_hr_total", "one_hr_total")])


@query("trailing_total_as_of", f"""
SELECT user_id, round(sum({_nan_free('value')}), 2) AS day_total
FROM events
WHERE event_type = 'purchase' AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
GROUP BY user_id
""")
def q_trailing_total_as_of(spark, sf):
    from gaugework.operators.windows import trailing_totals
    rain = readings(spark, sf).filter(F.col("event_type") == "purchase")
    out = trailing_totals(rain, "user_id", "ts", "value", hours=(24,), anchor="as_of", as_of=AS_OF)
    return out.select("user_id", F.round("day_total", 2).alias("day_total"))


@query("age_seconds", f"""
SELECT user_id, event_type, ts,
       CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts) AS DOUBLE) / 1000000 AS age_seconds
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def q_age_seconds(spark, sf):
    from gaugework.functions.levels import age_seconds
    lat = latest_per_key(readings(spark, sf), KEYS, "ts", "event_id")
    return lat.select("user_id", "event_type", "ts", age_seconds("ts", AS_OF).alias("age_seconds"))


@query("nan_rules", """
WITH e AS (SELECT user_id,
                  CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS v
           FROM events)
SELECT user_id,
       round(sum(CASE WHEN isnan(v) THEN NULL ELSE v END), 2) AS total,
       count(CASE WHEN isnan(v) THEN NULL ELSE v END) AS n_valid,
       max(v) AS max_raw,
       bool_or(isnan(v)) AS has_nan
FROM e GROUP BY user_id
""")
def q_nan_rules(spark, sf):
    from gaugework.functions.numeric import nullif_nan
    e = t(spark, sf, "events").select(
        "user_id", F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("v"))
    return e.groupBy("user_id").agg(
        F.round(F.sum(nullif_nan("v")), 2).alias("total"),
        F.count(nullif_nan("v")).alias("n_valid"),
        F.max("v").alias("max_raw"),
        F.bool_or(F.isnan("v")).alias("has_nan"))


@query("stream_top5_state", """
SELECT user_id, event_type, event_id, ts, value
FROM events
QUALIFY rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) <= 5
""")
def q_stream_top5_state(spark, sf):
    """T3 end to end: the events table read as a file stream, newest five per key kept as
    versioned state in the shared checkpoint folder; returns the final state."""
    import uuid

    from gaugework.session import checkpoint_dir
    from gaugework.streaming.jobs import latest_state, stream_latest
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-top5-{uuid.uuid4().hex}"
    schema = t(spark, sf, "events").schema
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .parquet(f"{sf.rstrip('/')}/event[s].parquet")
           .select("user_id", "event_type", "event_id", "ts", "value"))
    q = stream_latest(spark, src, f"{root}/checkpoint", root, KEYS, "ts", "event_id", k=5)
    q.awaitTermination()
    return latest_state(spark, root, f"{root}/checkpoint")


RAIN_SQL = """
rg AS (SELECT c_custkey AS telemetry_station_id, CAST(c_custkey AS VARCHAR) AS station_reference,
             'R' || CAST(c_custkey % 5 AS VARCHAR) AS region, c_name AS station_name FROM customer),
rpar AS (SELECT o_orderkey AS telemetry_value_parent_id, CAST(o_custkey AS VARCHAR) AS station,
             'R' || CAST(o_custkey % 5 AS VARCHAR) AS region,
             CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Rainfall' ELSE 'Level' END AS parameter,
             o_orderstatus AS data_type, o_orderpriority AS period, 'mm' AS units, o_orderdate AS end_timestamp
      FROM orders),
rval AS (SELECT l_orderkey AS telemetry_value_parent_id, l_orderkey * 8 + l_linenumber AS telemetry_value_id,
             l_partkey, l_suppkey,
             CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'NaN'::DOUBLE ELSE l_quantity END AS value,
             l_shipdate AS value_timestamp FROM lineitem)"""


def _rain_tables(spark, sf):
    c, o, li = t(spark, sf, "customer"), t(spark, sf, "orders"), t(spark, sf, "lineitem")
    g = c.select(F.col("c_custkey").alias("telemetry_station_id"),
                 F.col("c_custkey").cast("string").alias("station_reference"),
                 F.concat(F.lit("R"), (F.col("c_custkey") % 5).cast("string")).alias("region"),
                 F.col("c_name").alias("station_name"))
    p = o.select(F.col("o_orderkey").alias("telemetry_value_parent_id"),
                 F.col("o_custkey").cast("string").alias("station"),
                 F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")).alias("region"),
                 F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Rainfall").otherwise("Level")
                 .alias("parameter"),
                 F.col("o_orderstatus").alias("data_type"), F.col("o_orderpriority").alias("period"),
                 F.lit("mm").alias("units"), F.col("o_orderdate").alias("end_timestamp"))
    v = li.select(F.col("l_orderkey").alias("telemetry_value_parent_id"),
                  (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("telemetry_value_id"),
                  "l_partkey", "l_suppkey",
                  F.when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1), F.lit(float("nan")))
                  .otherwise(F.col("l_quantity")).alias("value"),
                  F.col("l_shipdate").alias("value_timestamp"))
    return g, p, v


@query("rainfall_stations", f"""
WITH {RAIN_SQL},
rrp AS (SELECT * FROM rpar WHERE parameter = 'Rainfall'),
rhdr AS (SELECT * FROM rrp QUALIFY row_number() OVER (PARTITION BY station, region
                                                  ORDER BY end_timestamp DESC, telemetry_value_parent_id DESC) = 1),
rlv AS (SELECT telemetry_value_parent_id, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, value_timestamp
       FROM rval QUALIFY row_number() OVER (PARTITION BY telemetry_value_parent_id
                                         ORDER BY value_timestamp DESC, telemetry_value_id DESC, l_partkey DESC,
                                                  l_suppkey DESC, value DESC) = 1),
rrv AS (SELECT rrp.station, rrp.region, rval.value_timestamp, rval.value FROM rval JOIN rrp USING (telemetry_value_parent_id)),
rlt AS (SELECT station, region, max(value_timestamp) AS latest FROM rrv GROUP BY station, region),
rtot AS (SELECT rrv.station, rrv.region,
  round(sum(CASE WHEN rrv.value_timestamp > rlt.latest - INTERVAL 24 HOUR AND NOT isnan(rrv.value) THEN rrv.value END), 2) AS day_total,
  round(sum(CASE WHEN rrv.value_timestamp > rlt.latest - INTERVAL 6 HOUR AND NOT isnan(rrv.value) THEN rrv.value END), 2) AS six_hr_total,
  round(sum(CASE WHEN rrv.value_timestamp > rlt.latest - INTERVAL 1 HOUR AND NOT isnan(rrv.value) THEN rrv.value END), 2) AS one_hr_total
  FROM rrv JOIN rlt USING (station, region) GROUP BY rrv.station, rrv.region)
SELECT rg.telemetry_station_id, rg.station_reference, rg.region, rg.station_name, rhdr.telemetry_value_parent_id,
       rhdr.data_type, rhdr.period, rhdr.units, rlv.value, rlv.value_timestamp, rtot.day_total, rtot.six_hr_total,
       rtot.one_hr_total, 'R' AS type
FROM rg JOIN rhdr ON rg.station_reference = rhdr.station AND rg.region = rhdr.region
JOIN rlv ON rlv.telemetry_value_parent_id = rhdr.telemetry_value_parent_id
LEFT JOIN rtot ON rtot.station = rg.station_reference AND rtot.region = rg.region
""")
def q_rainfall_stations(spark, sf):
    from gaugework.plans.views import rainfall_stations
    g, p, v = _rain_tables(spark, sf)
    out = rainfall_stations(g, p, v, value_tiebreak=["telemetry_value_id", "l_partkey", "l_suppkey", "value"],
                            with_lonlat=False)
    return out.select("telemetry_station_id", "station_reference", "region", "station_name",
                      "telemetry_value_parent_id", "data_type", "period", "units", "value", "value_timestamp",
                      *[F.round(c, 2).alias(c) for c in ("day_total", "six_hr_total", "one_hr_total")], "type")


WL_SQL = """
w AS (SELECT event_id, user_id,
             CASE WHEN event_type = 'error' THEN 'Flow' WHEN event_type = 'view' THEN 'WATER LEVEL' ELSE 'Water Level' END AS parameter,
             CASE WHEN event_type = 'signup' THEN 'deg C' ELSE 'mAOD' END AS units,
             CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'Crest Tapping'
                  WHEN event_id % 17 = 0 THEN 'Stage Height' ELSE event_type END AS qualifier
      FROM events)"""


@query("water_level_filter", f"""
WITH {WL_SQL}
SELECT event_id, user_id, qualifier FROM w
WHERE lower(parameter) = 'water level' AND lower(units) NOT LIKE '%deg%'
  AND lower(qualifier) NOT LIKE '%height%' AND lower(qualifier) <> 'crest tapping'
""")
def q_water_level_filter(spark, sf):
    """water-level series only (case-insensitive parameter; no 'deg' units, no 'height' or
    'crest tapping' qualifier; a NULL qualifier drops the row)."""
    from gaugework.functions.predicates import water_level
    e = t(spark, sf, "events")
    et = F.col("event_type")
    w = e.select("event_id", "user_id",
                 F.when(et == "error", "Flow").when(et == "view", "WATER LEVEL").otherwise("Water Level").alias("parameter"),
                 F.when(et == "signup", "deg C").otherwise("mAOD").alias("units"),
                 F.when(F.col("event_id") % 11 == 0, F.lit(None)).when(F.col("event_id") % 13 == 0, "Crest Tapping")
                  .when(F.col("event_id") % 17 == 0, "Stage Height").otherwise(et).alias("qualifier"))
    return w.filter(water_level()).select("event_id", "user_id", "qualifier")
