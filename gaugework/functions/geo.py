"""Coordinate maths as Column expressions (X15–X18, F13), no UDF.

National grid (EPSG:27700) metres → WGS84 lon/lat: inverse Transverse Mercator on the Airy
1830 ellipsoid (published Ordnance Survey formulae, fixed four-step latitude iteration
written as an ``aggregate`` so the expression tree stays small), then a 7-parameter Helmert
shift OSGB36 → WGS84 (about 5 m accuracy against a grid-shift transform).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.numeric import col_

# Fixed values of the published OSGB36 / National Grid definition and Helmert shift.
AIRY_A = 6377563.396
AIRY_B = 6356256.909
F0 = 0.9996012717
LAT0 = math.radians(49.0)
LON0 = math.radians(-2.0)
N0 = -100000.0
E0 = 400000.0
WGS84_A = 6378137.0
WGS84_B = 6356752.3142
HELMERT_T = (446.448, -125.157, 542.060)        # metres
HELMERT_S_PPM = -20.4894
HELMERT_R_ARCSEC = (0.1502, 0.2470, 0.8421)


def _meridional_arc(phi: Column) -> Column:
    a, b = AIRY_A, AIRY_B
    n = (a - b) / (a + b)
    n2, n3 = n * n, n ** 3
    d, s = phi - F.lit(LAT0), phi + F.lit(LAT0)
    return F.lit(b * F0) * (
        F.lit(1 + n + 1.25 * n2 + 1.25 * n3) * d
        - F.lit(3 * n + 3 * n2 + 21.0 / 8 * n3) * F.sin(d) * F.cos(s)
        + F.lit(15.0 / 8 * n2 + 15.0 / 8 * n3) * F.sin(d * 2) * F.cos(s * 2)
        - F.lit(35.0 / 24 * n3) * F.sin(d * 3) * F.cos(s * 3))


def _footpoint_latitude(n: Column) -> Column:
    """φ′ by the fixed four-step iteration on the meridional arc (lambda keeps it compact)."""
    a = AIRY_A
    return F.aggregate(F.sequence(F.lit(1), F.lit(4)),
                       (n - F.lit(N0)) / F.lit(a * F0) + F.lit(LAT0),
                       lambda acc, _: acc + (n - F.lit(N0) - _meridional_arc(acc)) / F.lit(a * F0))


def _wgs84_latitude(x: Column, y: Column, z: Column) -> Column:
    a = WGS84_A
    e2 = 1 - (WGS84_B ** 2) / (a ** 2)
    p = F.sqrt(x * x + y * y)
    return F.aggregate(F.sequence(F.lit(1), F.lit(4)), F.atan2(z, p * (1 - e2)),
                       lambda acc, _: F.atan2(z + F.lit(e2 * a) / F.sqrt(1 - F.lit(e2) * F.sin(acc) * F.sin(acc))
                                              * F.sin(acc), p))


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body`` (a lambda variable), so the
    expression tree never copies ``value``: ``transform(array(value), v -> body(v))[1]``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def grid_lonlat(e: str | Column, n: str | Column, datum: str = "wgs84") -> Column:
    """struct<lon, lat> in degrees from national-grid easting/northing, as one compact
    expression (every intermediate is let-bound), safe to inline anywhere."""
    a = AIRY_A
    e2 = 1 - (AIRY_B ** 2) / (a ** 2)
    E, N = col_(e).cast("double"), col_(n).cast("double")

    def radii(phi):
        sin2 = F.sin(phi) * F.sin(phi)
        return F.struct(phi.alias("phi"), (F.lit(a * F0) / F.sqrt(1 - F.lit(e2) * sin2)).alias("nu"),
                        (F.lit(a * F0 * (1 - e2)) / F.pow(1 - F.lit(e2) * sin2, 1.5)).alias("rho"),
                        F.tan(phi).alias("tan"), (1 / F.cos(phi)).alias("sec"), (E - F.lit(E0)).alias("de"))

    def osgb36(r):
        phi, nu, rho, tan, sec, de = r["phi"], r["nu"], r["rho"], r["tan"], r["sec"], r["de"]
        t2 = tan * tan
        eta2 = nu / rho - 1
        vii = tan / (2 * rho * nu)
        viii = tan / (24 * rho * F.pow(nu, 3)) * (5 + 3 * t2 + eta2 - 9 * t2 * eta2)
        ix = tan / (720 * rho * F.pow(nu, 5)) * (61 + 90 * t2 + 45 * t2 * t2)
        x = sec / nu
        xi = sec / (6 * F.pow(nu, 3)) * (nu / rho + 2 * t2)
        xii = sec / (120 * F.pow(nu, 5)) * (5 + 28 * t2 + 24 * t2 * t2)
        xiia = sec / (5040 * F.pow(nu, 7)) * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2)
        return F.struct((phi - vii * F.pow(de, 2) + viii * F.pow(de, 4) - ix * F.pow(de, 6)).alias("lat"),
                        (F.lit(LON0) + x * de - xi * F.pow(de, 3) + xii * F.pow(de, 5) - xiia * F.pow(de, 7)).alias("lon"))

    def cartesian(g):
        la, lo = g["lat"], g["lon"]
        nua = F.lit(a) / F.sqrt(1 - F.lit(e2) * F.sin(la) * F.sin(la))
        return _let(nua, lambda nu: F.struct((nu * F.cos(la) * F.cos(lo)).alias("x"),
                                             (nu * F.cos(la) * F.sin(lo)).alias("y"),
                                             (nu * (1 - e2) * F.sin(la)).alias("z")))

    def helmert(c):
        tx, ty, tz = HELMERT_T
        sc = 1 + HELMERT_S_PPM * 1e-6
        rx, ry, rz = (math.radians(r / 3600.0) for r in HELMERT_R_ARCSEC)
        x0, y0, z0 = c["x"], c["y"], c["z"]
        return F.struct((F.lit(tx) + x0 * sc - y0 * rz + z0 * ry).alias("x"),
                        (F.lit(ty) + x0 * rz + y0 * sc - z0 * rx).alias("y"),
                        (F.lit(tz) - x0 * ry + y0 * rx + z0 * sc).alias("z"))

    def wgs84(h):
        return F.struct(F.degrees(F.atan2(h["y"], h["x"])).alias("lon"),
                        F.degrees(_wgs84_latitude(h["x"], h["y"], h["z"])).alias("lat"))

    def degrees36(g):
        return F.struct(F.degrees(g["lon"]).alias("lon"), F.degrees(g["lat"]).alias("lat"))

    geo36 = _let(_let(_footpoint_latitude(N), radii), osgb36)
    if datum == "osgb36":
        out = _let(geo36, degrees36)
    else:
        out = _let(_let(_let(geo36, cartesian), helmert), wgs84)
    return F.when(E.isNotNull() & N.isNotNull(), out)


def with_lonlat(df: DataFrame, e: str, n: str, lon: str = "lon", lat: str = "lat",
                datum: str = "wgs84") -> DataFrame:
    """Add lon/lat (degrees) from national-grid easting/northing."""
    out = df.withColumn("_ll", grid_lonlat(e, n, datum))
    return out.withColumn(lon, F.col("_ll.lon")).withColumn(lat, F.col("_ll.lat")).drop("_ll")


def _num9(c: Column) -> Column:
    """Number text like PostGIS' GeoJSON writer: up to 9 decimals, trailing zeros dropped."""
    s = F.format_string("%.9f", c)
    s = F.regexp_replace(s, r"0+$", "")
    return F.regexp_replace(s, r"\.$", "")


def geojson_point(lon: str | Column, lat: str | Column) -> Column:
    """``{"type":"Point","coordinates":[lon,lat]}`` with 9-decimal numbers."""
    return F.concat(F.lit('{"type":"Point","coordinates":['), _num9(col_(lon)), F.lit(","),
                    _num9(col_(lat)), F.lit("]}"))


def point(lon: str | Column, lat: str | Column) -> Column:
    """A point as struct<lon, lat>."""
    return F.struct(col_(lon).cast("double").alias("lon"), col_(lat).cast("double").alias("lat"))


# The blueprint's name for the DataFrame form of X15.
grid_to_lonlat = with_lonlat
