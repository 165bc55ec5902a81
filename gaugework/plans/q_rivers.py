"""Catalog entries for river ordering and lists: W5/J5 neighbours, F3/F4/F8 labels, W7/O1 ids,
S2/V6 padded union.

River = an order (river_id = l_orderkey, raw rank = l_linenumber, station = l_suppkey).
Station master for labels = supplier: type C/G/M/S from s_nationkey % 4; region = region name
with EUROPE standing in for 'Wales'; catchment Dee/Wye/Other from s_suppkey % 3; status
'Closed' when s_acctbal < 0; the river table = nations of regions 0 and 1 (river name
'River ' || n_name), so other suppliers fall to the coastal/groundwater/raw-name branches.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions.predicates import in_scope, is_wales, river_labels
from gaugework.operators.ranking import latest_per_key, rank_neighbours, with_ordered_id
from gaugework.operators.sets import union_shapes
from gaugework.plans.catalog import query, t


@query("rank_neighbours", """
WITH rs AS (SELECT l_orderkey, l_suppkey, l_linenumber,
                   rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS calc_rank
            FROM lineitem)
SELECT rs.l_orderkey, rs.l_suppkey, rs.l_linenumber, CAST(rs.calc_rank AS BIGINT) AS calc_rank,
       up.l_suppkey AS up_l_suppkey, down.l_suppkey AS down_l_suppkey
FROM rs
LEFT JOIN rs up ON up.l_orderkey = rs.l_orderkey AND up.calc_rank = rs.calc_rank - 1
LEFT JOIN rs down ON down.l_orderkey = rs.l_orderkey AND down.calc_rank = rs.calc_rank + 1
""")
def q_rank_neighbours(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    out = rank_neighbours(li, "l_orderkey", "l_linenumber", "l_suppkey")
    return out.withColumn("calc_rank", F.col("calc_rank").cast("bigint"))


SUPPLIER_CTX_SQL = """
sctx AS (
  SELECT s.s_suppkey AS rloi_id, s.s_name AS wiski_river_name,
         CASE s.s_nationkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'G' WHEN 2 THEN 'M' ELSE 'S' END AS station_type,
         CASE r.r_name WHEN 'EUROPE' THEN 'Wales' ELSE r.r_name END AS region,
         CASE s.s_suppkey % 3 WHEN 0 THEN 'Dee' WHEN 1 THEN 'Wye' ELSE 'Other' END AS catchment,
         CASE WHEN s.s_acctbal < 0 THEN 'Closed' ELSE 'Active' END AS status,
         s.s_nationkey
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
river AS (SELECT n_nationkey, 'R' || CAST(n_nationkey AS VARCHAR) AS id, 'River ' || n_name AS name
          FROM nation WHERE n_regionkey IN (0, 1))"""


def supplier_context(spark, sf):
    s, n, r = t(spark, sf, "supplier"), t(spark, sf, "nation"), t(spark, sf, "region")
    # nation and region are fixed-size lookups (25 and 5 rows): safe to broadcast
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
    k = F.col("s_nationkey") % 4
    return j.select(
        F.col("s_suppkey").alias("rloi_id"), F.col("s_name").alias("wiski_river_name"),
        F.when(k == 0, "C").when(k == 1, "G").when(k == 2, "M").otherwise("S").alias("station_type"),
        F.when(F.col("r_name") == "EUROPE", "Wales").otherwise(F.col("r_name")).alias("region"),
        F.when(F.col("s_suppkey") % 3 == 0, "Dee").when(F.col("s_suppkey") % 3 == 1, "Wye")
         .otherwise("Other").alias("catchment"),
        F.when(F.col("s_acctbal") < 0, "Closed").otherwise("Active").alias("status"),
        "s_nationkey")


def river_table(spark, sf):
    n = t(spark, sf, "nation")
    return n.filter(F.col("n_regionkey").isin(0, 1)).select(
        "n_nationkey", F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("river_id"),
        F.concat(F.lit("River "), F.col("n_name")).alias("river_name"))


def labelled_stations(spark, sf):
    ctx = supplier_context(spark, sf)
    j = ctx.join(F.broadcast(river_table(spark, sf)), ctx.s_nationkey == F.col("n_nationkey"), "left")
    j = river_labels(j.drop("n_nationkey"))
    return j.filter(in_scope()).withColumn("iswales", is_wales())


@query("river_labels", f"""
WITH {SUPPLIER_CTX_SQL}
SELECT c.rloi_id,
       CASE WHEN rv.id IS NOT NULL THEN rv.id WHEN c.station_type = 'C' THEN 'Sea Levels'
            WHEN c.station_type = 'G' THEN 'Groundwater Levels' ELSE c.wiski_river_name END AS river_id,
       CASE WHEN rv.name IS NOT NULL THEN rv.name WHEN c.station_type = 'C' THEN 'Sea Levels'
            WHEN c.station_type = 'G' THEN 'Groundwater Levels' ELSE c.wiski_river_name END AS river_name,
       rv.name IS NOT NULL AS navigable,
       CASE WHEN rv.id IS NOT NULL THEN 1 WHEN c.station_type = 'C' THEN 2
            WHEN c.station_type = 'G' THEN 3 ELSE 4 END AS view_rank,
       lower(c.region) = 'wales' OR c.rloi_id IN (4162, 4170, 4173, 4174, 4176) AS iswales
FROM sctx c LEFT JOIN river rv ON c.s_nationkey = rv.n_nationkey
WHERE lower(c.status) <> 'closed' AND (lower(c.region) <> 'wales' OR c.catchment IN ('Dee', 'Severn Uplands', 'Wye'))
""")
def q_river_labels(spark, sf):
    return labelled_stations(spark, sf).select("rloi_id", "river_id", "river_name", "navigable",
                                               F.col("view_rank").cast("int").alias("view_rank"), "iswales")


@query("ordered_ids", """
SELECT o_orderkey, o_orderpriority, o_orderdate,
       row_number() OVER (ORDER BY o_orderpriority ASC NULLS LAST, o_orderdate DESC NULLS FIRST,
                                   o_orderkey ASC) AS id
FROM orders
""")
def q_ordered_ids(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return with_ordered_id(o, [F.col("o_orderpriority").asc_nulls_last(), F.col("o_orderdate").desc_nulls_first(),
                               F.col("o_orderkey").asc()])


@query("union_list", f"""
WITH {SUPPLIER_CTX_SQL},
rivers AS (
  SELECT c.rloi_id,
         CASE WHEN rv.id IS NOT NULL THEN rv.id WHEN c.station_type = 'C' THEN 'Sea Levels'
              WHEN c.station_type = 'G' THEN 'Groundwater Levels' ELSE c.wiski_river_name END AS river_id,
         CASE WHEN rv.id IS NOT NULL THEN 1 WHEN c.station_type = 'C' THEN 2
              WHEN c.station_type = 'G' THEN 3 ELSE 4 END AS view_rank,
         c.station_type, c.status, CAST(NULL AS VARCHAR) AS trend, CAST(NULL AS DOUBLE) AS value
  FROM sctx c LEFT JOIN river rv ON c.s_nationkey = rv.n_nationkey
  WHERE lower(c.status) <> 'closed' AND (lower(c.region) <> 'wales' OR c.catchment IN ('Dee', 'Severn Uplands', 'Wye'))),
rain AS (
  SELECT e.user_id, e.value, CASE r.r_name WHEN 'EUROPE' THEN 'Wales' ELSE r.r_name END AS region
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE e.event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts DESC, e.event_id DESC) = 1)
SELECT rloi_id, river_id, view_rank, station_type, status, trend, value FROM rivers
UNION
SELECT user_id, 'rainfall-' || region, 5, 'R', 'Active', 'n/a', value FROM rain WHERE region <> 'Wales'
""")
def q_union_list(spark, sf):
    rivers = labelled_stations(spark, sf).select("rloi_id", "river_id", F.col("view_rank").cast("int").alias("view_rank"),
                                                 "station_type", "status")
    e = t(spark, sf, "events").filter(F.col("event_type") == "purchase")
    latest = latest_per_key(e.select("user_id", "ts", "event_id", "value"), "user_id", "ts", "event_id")
    c, n, r = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "region")
    reg = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
           .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
           .select(F.col("c_custkey").alias("user_id"),
                   F.when(F.col("r_name") == "EUROPE", "Wales").otherwise(F.col("r_name")).alias("region")))
    rain = (latest.join(reg, "user_id").filter(F.col("region") != "Wales")
            .select(F.col("user_id").alias("rloi_id"), F.concat(F.lit("rainfall-"), "region").alias("river_id"),
                    F.lit(5).alias("view_rank"), F.lit("R").alias("station_type"), F.lit("Active").alias("status"),
                    F.lit("n/a").alias("trend"), "value"))
    return union_shapes(rivers, rain, distinct=True).select(
        "rloi_id", "river_id", "view_rank", "station_type", "status", "trend", "value")
