"""Catalog entry for the whole rivers view (V5): split ⋈ overview ⟕ ranked river stations with
neighbours, labels, scope, Wales flag, and ids in sort order.

Stations are customers (as in ``q_stations``) with region (EUROPE standing in for 'Wales'),
catchment Dee/Wye/Other from c_custkey % 3, status 'Closed' for a negative balance, raw river
name = market segment. River stations: customers with c_custkey % 4 <> 0 sit on river
'river-<nationkey>' at rank floor(c_acctbal / 1000) (ties are common); customers with
c_custkey % 50 = 0 also list a deleted station (key + 1000000, not in the context). The river
table holds the nations outside region 4, so some river ids have no river row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.plans import q_readings  # noqa: F401  (registers the rainfall SQL reused below)
from gaugework.plans.catalog import AS_OF, query, t
from gaugework.plans.q_stations import CTX_SQL, DIR_JOIN_SQL, MARKER, station_readings, station_split
from gaugework.plans.q_stations import stations_overview as overview_core

OVERVIEW_SQL = f"""
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
so AS (
  SELECT s.rloi_id, s.qualifier AS direction, l.value AS processed_value, l.trend, l.ts AS value_timestamp,
         CASE WHEN l.user_id IS NULL THEN NULL ELSE false END AS error, s.percentile_5, s.percentile_95
  FROM split s LEFT JOIN latest l ON s.rloi_id = l.user_id AND {DIR_JOIN_SQL.format(q='l.event_type')})"""

#: The statement follows the rules of SURVEY §2 (J5, J6, F3, F4, F8, O1): one table of positions, neighbours taken from it
#: by position, labels from a small table of station kinds.
RIVERS_SQL = f"""
WITH {CTX_SQL},
{OVERVIEW_SQL},
kinds(kind, label, place_in_list) AS (VALUES ('C', 'Sea Levels', 2), ('G', 'Groundwater Levels', 3)),
listed AS (
  SELECT 'river-' || CAST(c_nationkey AS VARCHAR) AS river, unnest(CASE WHEN c_custkey % 50 = 0 AND c_custkey % 4 <> 0 THEN [c_custkey, c_custkey + 1000000]
         WHEN c_custkey % 50 = 0 THEN [c_custkey + 1000000] WHEN c_custkey % 4 <> 0 THEN [c_custkey] ELSE [] END) AS station,
         CAST(floor(c_acctbal / 1000) AS INTEGER) AS raw_rank
  FROM customer
),
positions AS (
  SELECT river, station, rank() OVER (PARTITION BY river ORDER BY raw_rank ASC NULLS LAST) AS position
  FROM listed SEMI JOIN ctx ON listed.station = ctx.rloi_id
),
along AS (
  SELECT here.river, here.station, here.position, upper.station AS up, lower.station AS down,
         'River ' || n_name AS title, n_name || ' (' || CAST(n_regionkey AS VARCHAR) || ')' AS full_title
  FROM positions here
  JOIN nation ON here.river = 'river-' || CAST(n_nationkey AS VARCHAR) AND n_regionkey <> 4
  LEFT JOIN positions upper ON upper.river = here.river AND upper.position + 1 = here.position
  LEFT JOIN positions lower ON lower.river = here.river AND lower.position - 1 = here.position
),
stations AS (
  SELECT c_custkey AS rloi_id, CAST(c_custkey AS VARCHAR) AS telemetry_id, replace(r_name, 'EUROPE', 'Wales') AS region,
         ['Dee', 'Wye', 'Other'][c_custkey % 3 + 1] AS catchment, c_mktsegment AS wiski_river_name, c_name AS agency_name,
         c_name AS external_name, if(c_acctbal < 0, 'Closed', 'Active') AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
in_scope AS (
  SELECT * FROM stations WHERE lower(status) <> 'closed' AND (lower(region) <> 'wales' OR catchment IN ('Dee', 'Severn Uplands', 'Wye'))
),
shown AS (
  SELECT g.rloi_id, o.direction AS qualifier, v.station_type, telemetry_id, region, catchment, wiski_river_name, agency_name, external_name, status,
         o.processed_value AS value, o.trend, o.value_timestamp, o.error AS value_erred, o.percentile_5, o.percentile_95,
         a.full_title AS river_qualified_name, a.position AS rank, a.up, a.down,
         coalesce(a.river, k.label, wiski_river_name) AS river_id, coalesce(a.title, k.label, wiski_river_name) AS river_name,
         a.title IS NOT NULL AS navigable, CASE WHEN a.river IS NULL THEN coalesce(k.place_in_list, 4) ELSE 1 END AS view_rank,
         lower(region) = 'wales' OR g.rloi_id IN (4162, 4170, 4173, 4174, 4176) AS iswales
  FROM in_scope g
  JOIN split v ON v.rloi_id = g.rloi_id
  JOIN so o ON o.rloi_id = v.rloi_id AND o.direction = v.qualifier
  LEFT JOIN along a ON a.station = g.rloi_id
  LEFT JOIN kinds k ON k.kind = v.station_type
)
SELECT rloi_id, qualifier, station_type, telemetry_id, region, catchment, wiski_river_name, agency_name,
       external_name, status, value, trend, value_timestamp, value_erred, percentile_5, percentile_95,
       river_qualified_name, CAST(rank AS BIGINT) AS rank, up, down, river_id, river_name, navigable, view_rank, iswales,
       row_number() OVER (ORDER BY view_rank ASC NULLS LAST, river_id ASC NULLS LAST, rank ASC NULLS LAST,
                                   external_name ASC NULLS LAST, qualifier DESC NULLS FIRST,
                                   {{rest}}) AS id
FROM shown"""

REST = sorted({"rloi_id", "station_type", "telemetry_id", "region", "catchment", "wiski_river_name", "agency_name",
               "status", "value", "trend", "value_timestamp", "value_erred", "percentile_5", "percentile_95",
               "river_qualified_name", "up", "down", "river_name", "navigable", "iswales", "lon", "lat"} - {"lon", "lat"})


def _rivers(spark, sf, with_ids=True):
    from gaugework.plans.views import rivers
    c, n, r = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "region")
    sc = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
          .select(F.col("c_custkey").alias("rloi_id"), F.col("c_custkey").cast("string").alias("telemetry_id"),
                  F.when(F.col("r_name") == "EUROPE", "Wales").otherwise(F.col("r_name")).alias("region"),
                  F.when(F.col("c_custkey") % 3 == 0, "Dee").when(F.col("c_custkey") % 3 == 1, "Wye")
                  .otherwise("Other").alias("catchment"),
                  F.col("c_mktsegment").alias("wiski_river_name"), F.col("c_name").alias("agency_name"),
                  F.col("c_name").alias("external_name"),
                  F.when(F.col("c_acctbal") < 0, "Closed").otherwise("Active").alias("status"),
                  F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat")))
    split = station_split(spark, sf).join(sc, "rloi_id")
    fs = (t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
          .select(F.col("o_custkey").alias("rloi_id")))
    ov = overview_core(station_split(spark, sf), station_readings(spark, sf), fs, AS_OF, MARKER)
    ov = ov.withColumn("error", F.when(F.col("qualifier").isNotNull(), F.col("error")))
    on_river = c.filter(F.col("c_custkey") % 4 != 0).select(
        F.concat(F.lit("river-"), F.col("c_nationkey").cast("string")).alias("river_id"),
        F.col("c_custkey").alias("rloi_id"), F.floor(F.col("c_acctbal") / 1000).cast("int").alias("rank"))
    deleted = c.filter(F.col("c_custkey") % 50 == 0).select(
        F.concat(F.lit("river-"), F.col("c_nationkey").cast("string")).alias("river_id"),
        (F.col("c_custkey") + 1000000).alias("rloi_id"), F.floor(F.col("c_acctbal") / 1000).cast("int").alias("rank"))
    river = n.filter(F.col("n_regionkey") != 4).select(
        F.concat(F.lit("river-"), F.col("n_nationkey").cast("string")).alias("id"),
        F.concat(F.lit("River "), F.col("n_name")).alias("name"),
        F.concat(F.col("n_name"), F.lit(" ("), F.col("n_regionkey").cast("string"), F.lit(")")).alias("qualified_name"))
    ctx = station_split(spark, sf).select("rloi_id").distinct()
    return rivers(split, ov, on_river.unionByName(deleted), river, ctx, with_ids=with_ids)


@query("rivers_view", RIVERS_SQL.replace("{rest}", ", ".join(f"{c} ASC NULLS LAST" for c in REST)))
def q_rivers_view(spark, sf):
    out = _rivers(spark, sf)
    return out.select("rloi_id", "qualifier", "station_type", "telemetry_id", "region", "catchment", "wiski_river_name",
                      "agency_name", "external_name", "status", "value", "trend", "value_timestamp", "value_erred",
                      "percentile_5", "percentile_95", "river_qualified_name", F.col("rank").cast("bigint").alias("rank"),
                      "up", "down", "river_id", "river_name", "navigable", "view_rank", "iswales", "id")


def _ctes(sql: str, final_marker: str) -> tuple[str, str]:
    """Split a 'WITH ctes SELECT …' statement of this catalog into (ctes, final select)."""
    body = sql.strip()
    assert body.startswith("WITH ")
    i = body.index(final_marker)
    return body[len("WITH "):i].rstrip().rstrip(","), body[i:].strip()


def _list_sql() -> str:
    from gaugework.plans.catalog import ORACLE
    from gaugework.plans.views import LIST_COLUMNS
    riv_ctes, _ = _ctes(ORACLE["rivers_view"], "\nSELECT rloi_id, qualifier,")
    rain_ctes, rain_select = _ctes(ORACLE["rainfall_stations"], "\nSELECT rg.")
    keys = ["navigable", "river_id", "view_rank", "wiski_river_name"]
    rest = sorted(set(LIST_COLUMNS) - set(keys))
    order = ", ".join(f"{c} ASC NULLS LAST" for c in keys + rest)
    return f"""WITH {riv_ctes},
{rain_ctes},
rain AS ({rain_select}),
u AS (
  SELECT river_id, river_name, river_qualified_name, navigable, view_rank, CAST(rank AS BIGINT) AS rank, rloi_id,
         up, down, telemetry_id, region, catchment, wiski_river_name, agency_name, external_name, station_type,
         status, qualifier, iswales, value, value_timestamp, value_erred, trend, percentile_5, percentile_95,
         CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS day_total,
         CAST(NULL AS DOUBLE) AS six_hr_total, CAST(NULL AS DOUBLE) AS one_hr_total
  FROM shown
  UNION
  SELECT 'rainfall-' || region, 'Rainfall ' || region, NULL, false, 5, NULL, NULL, NULL, NULL, station_reference,
         region, NULL, NULL, station_name, station_name, 'R', 'Active', NULL, false, value, value_timestamp, false,
         'n/a', NULL, NULL, NULL, NULL, day_total, six_hr_total, one_hr_total
  FROM rain WHERE region <> 'Wales')
SELECT *, row_number() OVER (ORDER BY {order}) AS id FROM u"""


def q_stations_list_view(spark, sf):
    from gaugework.plans.q_readings import _rain_tables
    from gaugework.plans.views import LIST_COLUMNS, rainfall_stations, stations_list
    g, p, v = _rain_tables(spark, sf)
    rain = rainfall_stations(g, p, v, value_tiebreak=["telemetry_value_id", "l_partkey", "l_suppkey", "value"],
                             with_lonlat=False)
    riv = _rivers(spark, sf, with_ids=False).withColumn("rank", F.col("rank").cast("bigint"))
    out = stations_list(riv, rain, order_mode="positional")
    return out.select(*LIST_COLUMNS, "id")


query("stations_list_view", _list_sql())(q_stations_list_view)
