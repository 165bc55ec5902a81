"""Polygon operators: centroid (X19), vertex count (X23), simplify (X22). The distance join is in
``proximity``.

Geometry is a column ``rings``: array<array<array<struct<lon,lat>>>> — polygons, rings
(first = shell, rest = holes), closed point lists — in degrees (EPSG:4326).
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.geo import WGS84_A, WGS84_B, _let

E2 = 1 - (WGS84_B ** 2) / (WGS84_A ** 2)


def steps(last: Column) -> Column:
    """0, 1, … last; empty when ``last`` is negative (a ring of one point has no edge)."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _ring_terms(ring: Column) -> Column:
    """struct(area2, cx6, cy6): twice the signed area and the first moments (×6A)."""
    idx = steps(F.size(ring) - 2)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def step(acc, i):
        p, q = ring[i], ring[i + 1]
        cr = p["lon"] * q["lat"] - q["lon"] * p["lat"]
        return F.struct((acc["a"] + cr).alias("a"), (acc["x"] + (p["lon"] + q["lon"]) * cr).alias("x"),
                        (acc["y"] + (p["lat"] + q["lat"]) * cr).alias("y"))
    return F.aggregate(idx, zero, step)


def centroid(df: DataFrame, rings: str = "geom", out: str = "centroid") -> DataFrame:
    """Area-weighted planar centroid of a multipolygon (holes subtract), per row."""
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def per_poly(acc, poly):
        def per_ring(acc2, ri):
            def add(t):
                area = F.abs(t["a"]) / 2
                w = F.when(ri == 0, F.lit(1.0)).otherwise(F.lit(-1.0)) * area
                cx = F.when(t["a"] != 0, t["x"] / (3 * t["a"])).otherwise(F.lit(0.0))
                cy = F.when(t["a"] != 0, t["y"] / (3 * t["a"])).otherwise(F.lit(0.0))
                return F.struct((acc2["w"] + w).alias("w"), (acc2["x"] + w * cx).alias("x"),
                                (acc2["y"] + w * cy).alias("y"))
            return _let(_ring_terms(poly[ri]), add)  # ring sums computed once per ring
        return F.aggregate(steps(F.size(poly) - 1), acc, per_ring)

    tot = F.aggregate(F.col(rings), zero, per_poly)
    return df.withColumn("_c", tot).withColumn(
        out, F.when(F.col("_c.w") != 0, F.struct((F.col("_c.x") / F.col("_c.w")).alias("lon"),
                                                 (F.col("_c.y") / F.col("_c.w")).alias("lat")))).drop("_c")


def count_vertices(df: DataFrame, rings: str = "geom", out: str = "npoints") -> DataFrame:
    """Total number of points over all rings."""
    return df.withColumn(out, F.aggregate(F.flatten(F.col(rings)), F.lit(0), lambda a, r: a + F.size(r)))


def _radii(lat_deg: Column) -> tuple[Column, Column]:
    """Prime-vertical N(φ) and meridional M(φ) radii on WGS84."""
    s = F.sin(F.radians(lat_deg))
    w = 1 - F.lit(E2) * s * s
    return F.lit(WGS84_A) / F.sqrt(w), F.lit(WGS84_A * (1 - E2)) / F.pow(w, 1.5)


def local_xy(plon: Column, plat: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres of the vertex (lon, lat) east and north of the point, radii at the mid-latitude."""
    mid = (plat + lat) / 2
    n_r, m_r = _radii(mid)
    x = F.radians(lon - plon) * n_r * F.cos(F.radians(mid))
    y = F.radians(lat - plat) * m_r
    return x, y


def simplify(df: DataFrame, rings: str = "geom", tolerance: float = 0.00025, out: str | None = None) -> DataFrame:
    """Douglas–Peucker per ring with at least 4 points kept, one row per area, run as an
    Arrow-batched pandas function (the recursion has no Column form). Topology between rings
    is not checked (the reference's 'preserve topology' is approximated)."""
    out = out or rings

    def dp(points: list, tol: float) -> list:
        if len(points) <= 4:
            return points
        keep = [False] * len(points)
        keep[0] = keep[-1] = True
        stack = [(0, len(points) - 1)]
        while stack:
            i, j = stack.pop()
            (x1, y1), (x2, y2) = points[i], points[j]
            dx, dy = x2 - x1, y2 - y1
            ll = dx * dx + dy * dy
            best, idx = -1.0, -1
            for k in range(i + 1, j):
                px, py = points[k]
                if ll == 0:
                    d = math.hypot(px - x1, py - y1)
                else:
                    t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / ll))
                    d = math.hypot(px - (x1 + t * dx), py - (y1 + t * dy))
                if d > best:
                    best, idx = d, k
            if best > tol and idx > 0:
                keep[idx] = True
                stack += [(i, idx), (idx, j)]
        kept = [p for p, k in zip(points, keep) if k]
        if len(kept) < 4:  # a ring needs four points: keep the farthest ones back
            kept = points[:: max(1, (len(points) - 1) // 3)][:3] + [points[-1]]
        return kept

    schema = df.schema[rings].dataType

    @F.pandas_udf(schema)
    def simplify_udf(col: pd.Series) -> pd.Series:
        res = []
        for polys in col:
            if polys is None:
                res.append(None)
                continue
            new = []
            for poly in polys:
                rr = []
                for ring in poly:
                    pts = [(p["lon"], p["lat"]) for p in ring]
                    rr.append([{"lon": x, "lat": y} for x, y in dp(pts, tolerance)])
                new.append(rr)
            res.append(new)
        return pd.Series(res)

    return df.withColumn(out, simplify_udf(F.col(rings)))
