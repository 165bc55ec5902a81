"""Catalog entries for coordinate and polygon operators.

Points come from ``customer`` and areas from ``supplier`` by fixed arithmetic on the keys,
repeated verbatim in the DuckDB statements:
  grid metres   E = 100000 + (c_custkey * 7919) % 550000, N = 50000 + (c_custkey * 104729) % 1000000
  point lon/lat lon = -5.5 + (c_custkey % 97) * 0.07, lat = 50.0 + (c_custkey % 89) * 0.09
  square area   centre (-5.5 + (s_suppkey % 31) * 0.22, 50.0 + (s_suppkey % 37) * 0.22),
                half side 0.03 + (s_suppkey % 5) * 0.01; even suppliers get a square hole of a
                third of the half side, centred half a half-side east of the centre.
The DuckDB side evaluates the same published formulas (grid) and a brute-force points × edges
scan (distance), so it checks the candidate-cell join loses no pair.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gaugework.functions import geo
from gaugework.functions.predicates import in_bbox
from gaugework.operators.proximity import within_distance, within_distance_missing
from gaugework.operators.spatial import E2, centroid
from gaugework.plans.catalog import query, t

# ---------------------------------------------------------------- grid → lon/lat


def _m_sql(phi: str) -> str:
    a, b = geo.AIRY_A, geo.AIRY_B
    n = (a - b) / (a + b)
    n2, n3 = n * n, n ** 3
    d, s = f"({phi} - {geo.LAT0!r})", f"({phi} + {geo.LAT0!r})"
    return (f"({b * geo.F0!r} * ({1 + n + 1.25 * n2 + 1.25 * n3!r} * {d}"
            f" - {3 * n + 3 * n2 + 21.0 / 8 * n3!r} * sin({d}) * cos({s})"
            f" + {15.0 / 8 * n2 + 15.0 / 8 * n3!r} * sin(2 * {d}) * cos(2 * {s})"
            f" - {35.0 / 24 * n3!r} * sin(3 * {d}) * cos(3 * {s})))")


def _grid_sql() -> str:
    a, f0 = geo.AIRY_A, geo.F0
    e2 = 1 - geo.AIRY_B ** 2 / a ** 2
    steps = [f"p0 AS (SELECT id, e, n, (n - {geo.N0!r}) / {a * f0!r} + {geo.LAT0!r} AS phi FROM g)"]
    for i in range(1, 5):
        steps.append(f"p{i} AS (SELECT id, e, n, phi + (n - {geo.N0!r} - {_m_sql('phi')}) / {a * f0!r} AS phi FROM p{i - 1})")
    steps.append(f"""q AS (SELECT id, e, n, phi, e - {geo.E0!r} AS de,
        {a * f0!r} / sqrt(1 - {e2!r} * sin(phi) * sin(phi)) AS nu,
        {a * f0 * (1 - e2)!r} / pow(1 - {e2!r} * sin(phi) * sin(phi), 1.5) AS rho FROM p4)""")
    steps.append("""r AS (SELECT id, e, n, de, phi, nu, rho, tan(phi) AS tn, 1 / cos(phi) AS sc, nu / rho - 1 AS eta2 FROM q)""")
    steps.append(f"""o AS (SELECT id, e, n,
        phi - tn / (2 * rho * nu) * pow(de, 2)
            + tn / (24 * rho * pow(nu, 3)) * (5 + 3 * tn * tn + eta2 - 9 * tn * tn * eta2) * pow(de, 4)
            - tn / (720 * rho * pow(nu, 5)) * (61 + 90 * tn * tn + 45 * pow(tn, 4)) * pow(de, 6) AS lat,
        {geo.LON0!r} + sc / nu * de - sc / (6 * pow(nu, 3)) * (nu / rho + 2 * tn * tn) * pow(de, 3)
            + sc / (120 * pow(nu, 5)) * (5 + 28 * tn * tn + 24 * pow(tn, 4)) * pow(de, 5)
            - sc / (5040 * pow(nu, 7)) * (61 + 662 * tn * tn + 1320 * pow(tn, 4) + 720 * pow(tn, 6)) * pow(de, 7) AS lon
        FROM r)""")
    tx, ty, tz = geo.HELMERT_T
    sc = 1 + geo.HELMERT_S_PPM * 1e-6
    rx, ry, rz = (math.radians(v / 3600.0) for v in geo.HELMERT_R_ARCSEC)
    steps.append(f"""c AS (SELECT id, e, n, {a!r} / sqrt(1 - {e2!r} * sin(lat) * sin(lat)) AS nu, lat, lon FROM o)""")
    steps.append(f"""x AS (SELECT id, e, n, nu * cos(lat) * cos(lon) AS x, nu * cos(lat) * sin(lon) AS y,
        nu * {1 - e2!r} * sin(lat) AS z FROM c)""")
    steps.append(f"""h AS (SELECT id, e, n,
        {tx!r} + x * {sc!r} - y * {rz!r} + z * {ry!r} AS x,
        {ty!r} + x * {rz!r} + y * {sc!r} - z * {rx!r} AS y,
        {tz!r} - x * {ry!r} + y * {rx!r} + z * {sc!r} AS z FROM x)""")
    wa = geo.WGS84_A
    we2 = 1 - geo.WGS84_B ** 2 / wa ** 2
    steps.append(f"w0 AS (SELECT id, e, n, x, y, z, sqrt(x * x + y * y) AS p, atan2(z, sqrt(x * x + y * y) * {1 - we2!r}) AS phi FROM h)")
    for i in range(1, 5):
        steps.append(f"w{i} AS (SELECT id, e, n, x, y, z, p, atan2(z + {we2 * wa!r} / sqrt(1 - {we2!r} * sin(phi) * sin(phi)) * sin(phi), p) AS phi FROM w{i - 1})")
    return ",\n".join(steps)


GRID_POINTS_SQL = """g AS (SELECT c_custkey AS id, CAST(100000 + (c_custkey * 7919) % 550000 AS DOUBLE) AS e,
                 CAST(50000 + (c_custkey * 104729) % 1000000 AS DOUBLE) AS n FROM customer)"""


def grid_points(spark, sf):
    c = t(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    (F.lit(100000) + (F.col("c_custkey") * 7919) % 550000).cast("double").alias("e"),
                    (F.lit(50000) + (F.col("c_custkey") * 104729) % 1000000).cast("double").alias("n"))


@query("grid_to_lonlat", f"""
WITH {GRID_POINTS_SQL},
{_grid_sql()}
SELECT id, e, n, round(degrees(atan2(y, x)), 6) AS lon, round(degrees(phi), 6) AS lat FROM w4
""")
def q_grid_to_lonlat(spark, sf):
    p = geo.with_lonlat(grid_points(spark, sf), "e", "n")
    return p.select("id", "e", "n", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


# ---------------------------------------------------------------- points and squares

# Exact decimal arithmetic cast once to DOUBLE on both engines, so the doubles are identical.
POINTS_SQL = """pts AS (SELECT c_custkey AS id, CAST(-5.5 + (c_custkey % 97) * 0.07 AS DOUBLE) AS lon,
                   CAST(50.0 + (c_custkey % 89) * 0.09 AS DOUBLE) AS lat FROM customer)"""
SQUARES_SQL = """sq AS (SELECT s_suppkey AS area_id, CAST(-5.5 + (s_suppkey % 31) * 0.22 AS DOUBLE) AS cx,
                  CAST(50.0 + (s_suppkey % 37) * 0.22 AS DOUBLE) AS cy,
                  CAST(0.03 + (s_suppkey % 5) * 0.01 AS DOUBLE) AS h,
                  s_suppkey % 2 = 0 AS holed FROM supplier)"""


def _dec(base: str, key, mod: int, step: str):
    """CAST(base + (key % mod) * step AS DOUBLE) evaluated exactly in DECIMAL."""
    return (F.lit(base).cast("decimal(10,2)") + (key % mod).cast("decimal(20,0)") * F.lit(step).cast("decimal(10,2)")) \
        .cast("double")


def points(spark, sf):
    c = t(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"), _dec("-5.5", F.col("c_custkey"), 97, "0.07").alias("lon"),
                    _dec("50.0", F.col("c_custkey"), 89, "0.09").alias("lat"))


def squares(spark, sf):
    """Areas as multipolygon rings: one polygon, a closed square shell and maybe a hole."""
    s = t(spark, sf, "supplier")
    k = F.col("s_suppkey")
    cx = _dec("-5.5", k, 31, "0.22")
    cy = _dec("50.0", k, 37, "0.22")
    h = _dec("0.03", k, 5, "0.01")

    def ring(x0, y0, hh):
        pts = [(x0 - hh, y0 - hh), (x0 + hh, y0 - hh), (x0 + hh, y0 + hh), (x0 - hh, y0 + hh), (x0 - hh, y0 - hh)]
        return F.array(*[geo.point(x, y) for x, y in pts])
    shell = ring(cx, cy, h)
    hole = ring(cx + h / 2, cy, h / 3)
    geom = F.when(k % 2 == 0, F.array(F.array(shell, hole))).otherwise(F.array(F.array(shell)))
    return s.select(k.alias("area_id"), geom.alias("geom"))


@query("geojson_point", f"""
WITH {POINTS_SQL}
SELECT id, '{{"type":"Point","coordinates":[' ||
           regexp_replace(regexp_replace(printf('%.9f', lon), '0+$', ''), '\\.$', '') || ',' ||
           regexp_replace(regexp_replace(printf('%.9f', lat), '0+$', ''), '\\.$', '') || ']}}' AS coordinates
FROM pts
""")
def q_geojson_point(spark, sf):
    p = points(spark, sf)
    return p.select("id", geo.geojson_point("lon", "lat").alias("coordinates"))


@query("ring_centroid", f"""
WITH {SQUARES_SQL},
parts AS (SELECT area_id, 4 * h * h AS ao, cx AS xo, cy AS yo,
                 CASE WHEN holed THEN 4 * (h / 3) * (h / 3) ELSE 0 END AS ah, cx + h / 2 AS xh, cy AS yh
          FROM sq)
SELECT area_id, round((ao * xo - ah * xh) / (ao - ah), 9) AS lon, round((ao * yo - ah * yh) / (ao - ah), 9) AS lat
FROM parts
""")
def q_ring_centroid(spark, sf):
    c = centroid(squares(spark, sf), "geom", "c")
    return c.select("area_id", F.round("c.lon", 9).alias("lon"), F.round("c.lat", 9).alias("lat"))


def _within_sql(metres: float, extra_where: str = "") -> str:
    a = 6378137.0
    # local metres of (vx, vy) about the point, radii at the mid latitude (same formula as Spark)
    def xy(vx, vy):
        mid = f"((p.lat + {vy}) / 2)"
        w = f"(1 - {E2!r} * sin(radians({mid})) * sin(radians({mid})))"
        nr = f"({a!r} / sqrt({w}))"
        mr = f"({a * (1 - E2)!r} / pow({w}, 1.5))"
        return (f"radians({vx} - p.lon) * {nr} * cos(radians({mid}))", f"radians({vy} - p.lat) * {mr}")
    x1, y1 = xy("e.x1", "e.y1")
    x2, y2 = xy("e.x2", "e.y2")
    return f"""
edges AS (
  SELECT area_id, x1, y1, x2, y2 FROM (
    SELECT area_id, cx, cy, h, holed FROM sq) s,
  LATERAL (SELECT * FROM (VALUES
      (0, cx - h, cy - h, cx + h, cy - h), (1, cx + h, cy - h, cx + h, cy + h),
      (2, cx + h, cy + h, cx - h, cy + h), (3, cx - h, cy + h, cx - h, cy - h),
      (4, cx + h / 2 - h / 3, cy - h / 3, cx + h / 2 + h / 3, cy - h / 3),
      (5, cx + h / 2 + h / 3, cy - h / 3, cx + h / 2 + h / 3, cy + h / 3),
      (6, cx + h / 2 + h / 3, cy + h / 3, cx + h / 2 - h / 3, cy + h / 3),
      (7, cx + h / 2 - h / 3, cy + h / 3, cx + h / 2 - h / 3, cy - h / 3)) v(k, x1, y1, x2, y2)) vv
  WHERE holed OR k < 4),
pe AS (SELECT p.id, e.area_id, {x1} AS ax, {y1} AS ay, {x2} AS bx, {y2} AS byy
       FROM pts p CROSS JOIN edges e {extra_where}),
seg AS (SELECT id, area_id, ax, ay, bx - ax AS dx, byy - ay AS dy, byy FROM pe),
dd AS (SELECT id, area_id,
         CASE WHEN dx * dx + dy * dy > 0
              THEN greatest(0.0, least(1.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) ELSE 0.0 END AS tt,
         ax, ay, dx, dy, byy FROM seg),
agg AS (SELECT id, area_id,
          min((ax + tt * dx) * (ax + tt * dx) + (ay + tt * dy) * (ay + tt * dy)) AS d2,
          sum(CASE WHEN (ay > 0) <> (byy > 0)
                        AND ax + (0 - ay) * dx / (CASE WHEN dy <> 0 THEN dy ELSE 1.0 END) > 0
                   THEN 1 ELSE 0 END) AS cr
        FROM dd GROUP BY id, area_id)
SELECT id, area_id FROM agg WHERE cr % 2 = 1 OR sqrt(d2) <= {metres!r}"""


@query("within_8km", f"WITH {POINTS_SQL}, {SQUARES_SQL}, {_within_sql(8000.0)}")
def q_within_8km(spark, sf):
    return within_distance(points(spark, sf), squares(spark, sf), 8000.0, point_id="id", area_id="area_id")


@query("within_8km_incremental", f"""WITH {POINTS_SQL.replace('FROM customer', 'FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = $$1-URGENT$$ AND o_custkey IS NOT NULL) AND c_mktsegment <> $$BUILDING$$')}, {SQUARES_SQL}, {_within_sql(8000.0)}""")
def q_within_8km_incremental(spark, sf):
    done = (t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
            .select(F.col("o_custkey").alias("id")))
    seg = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    pts = points(spark, sf).join(seg, "id")
    return within_distance_missing(pts, squares(spark, sf), done, 8000.0, point_id="id", area_id="area_id",
                                   exclude=F.col("c_mktsegment") == "BUILDING")


@query("bbox", f"""
WITH {POINTS_SQL}
SELECT id, lon, lat FROM pts WHERE lon > -4.0 AND lon < -1.0 AND lat > 51.0 AND lat < 53.0
""")
def q_bbox(spark, sf):
    return points(spark, sf).filter(in_bbox("lon", "lat", -4.0, 51.0, -1.0, 53.0))


@query("station_context_view", f"""
WITH {GRID_POINTS_SQL},
{_grid_sql()},
ll AS (SELECT id, degrees(atan2(y, x)) AS lon, degrees(phi) AS lat FROM w4),
lk AS (SELECT 'EA ' || r_name AS region_name, r_name AS context_region_name FROM region WHERE r_regionkey < 4),
ctx AS (SELECT c.c_custkey AS rloi_id, c.c_name AS agency_name, r.r_name AS region
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT ctx.rloi_id, ctx.agency_name, ctx.region, lk.region_name AS time_series_region,
       round(ll.lon, 6) AS lon, round(ll.lat, 6) AS lat
FROM ctx JOIN lk ON ctx.region = lk.context_region_name JOIN ll ON ll.id = ctx.rloi_id
""")
def q_station_context_view(spark, sf):
    """V1: station context ⋈ the region lookup (inner, as the comma join), with lon/lat from
    the national-grid coordinates (the lookup here omits one region, so its stations drop)."""
    from gaugework.plans.views import station_context
    c, n, r = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "region")
    g = grid_points(spark, sf)
    ctx = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
           .select(F.col("c_custkey").alias("rloi_id"), F.col("c_name").alias("agency_name"),
                   F.col("r_name").alias("region"))
           .join(g.select(F.col("id").alias("rloi_id"), F.col("e").alias("x_coord_actual"),
                          F.col("n").alias("y_coord_actual")), "rloi_id"))
    lk = r.filter(F.col("r_regionkey") < 4).select(F.concat(F.lit("EA "), "r_name").alias("region_name"),
                                                   F.col("r_name").alias("context_region_name"))
    out = station_context(ctx, lk)
    return out.select("rloi_id", "agency_name", "region", "time_series_region",
                      F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


def _station_areas_sql() -> str:
    within = _within_sql(8000.0).replace("SELECT id, area_id FROM agg WHERE",
                                         "SELECT id AS rloi_id, CAST(area_id AS VARCHAR) AS fws_tacode FROM agg WHERE")
    return f"""WITH {GRID_POINTS_SQL},
{_grid_sql()},
pts AS (SELECT id, degrees(atan2(y, x)) AS lon, degrees(phi) AS lat FROM w4),
{SQUARES_SQL},
{within}"""


@query("station_areas_view", _station_areas_sql())
def q_station_areas_view(spark, sf):
    """V12 in full: station grid coordinates → lon/lat → stations within 8 km of an alert area
    (even supplier keys) or a warning area (odd keys), union all of the two branches."""
    from gaugework.plans.views import station_areas
    ctx = grid_points(spark, sf).select(F.col("id").alias("rloi_id"), F.col("e").alias("x_coord_actual"),
                                        F.col("n").alias("y_coord_actual"))
    sq = squares(spark, sf).select(F.col("area_id").cast("string").alias("fws_tacode"), "geom",
                                   (F.col("area_id") % 2 == 0).alias("_alert"))
    alert, warn = sq.filter("_alert").drop("_alert"), sq.filter(~F.col("_alert")).drop("_alert")
    return station_areas(ctx, alert, warn).select("rloi_id", "fws_tacode")
