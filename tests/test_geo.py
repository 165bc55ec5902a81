"""X15 grid conversion, X17 GeoJSON, X19 centroid, J10 distance join, X22 simplify."""

import math

import pytest

from gaugework.functions import geo
from gaugework.operators import proximity
from gaugework.operators.proximity import within_distance
from gaugework.operators.spatial import centroid, count_vertices, simplify


def test_grid_inverse_worked_example(spark):
    # the published worked example of the inverse projection (Airy, before the datum shift)
    df = spark.createDataFrame([(651409.903, 313177.270)], "e double, n double")
    r = geo.with_lonlat(df, "e", "n", datum="osgb36").first()
    assert abs(r.lat - 52.65757030) < 1e-7 and abs(r.lon - 1.71792160) < 1e-7


def test_grid_to_wgs84_shift(spark):
    df = spark.createDataFrame([(651409.903, 313177.270), (None, 1.0)], "e double, n double")
    rows = geo.with_lonlat(df, "e", "n").collect()
    # Helmert shift moves this point ~ +0.0005° lat, −0.0018° lon (about 100 m)
    assert abs(rows[0].lat - 52.6580) < 1e-3 and abs(rows[0].lon - 1.7161) < 1e-3
    assert rows[1].lat is None


def test_geojson_point(spark):
    df = spark.createDataFrame([(-1.5, 52.123456789012), (0.0, -0.1)], "lon double, lat double")
    got = [r.g for r in df.select(geo.geojson_point("lon", "lat").alias("g")).collect()]
    assert got == ['{"type":"Point","coordinates":[-1.5,52.123456789]}', '{"type":"Point","coordinates":[0,-0.1]}']


def square(x0, y0, h):
    x0, y0, h = float(x0), float(y0), float(h)
    return [{"lon": x0 - h, "lat": y0 - h}, {"lon": x0 + h, "lat": y0 - h}, {"lon": x0 + h, "lat": y0 + h},
            {"lon": x0 - h, "lat": y0 + h}, {"lon": x0 - h, "lat": y0 - h}]


GEOM = "geom array<array<array<struct<lon:double,lat:double>>>>"


def test_centroid_with_hole_and_multipart(spark):
    df = spark.createDataFrame([(1, [[square(0, 0, 1), square(0.5, 0, 0.25)]]),
                                (2, [[square(0, 0, 1)], [square(10, 0, 1)]])], f"id int, {GEOM}")
    out = {r.id: r.c for r in centroid(df, "geom", "c").collect()}
    # shell area 4 at x=0, hole area 0.25 at x=0.5 → x = (0 - 0.125) / 3.75
    assert abs(out[1].lon - (-0.125 / 3.75)) < 1e-12 and abs(out[1].lat) < 1e-12
    assert abs(out[2].lon - 5.0) < 1e-12
    assert count_vertices(df).orderBy("id").first().npoints == 10


def metres_between(lon, lat, ring_points):
    """Smallest planar distance to the edges and the crossings to the east; every place on its own."""
    a, e2 = geo.WGS84_A, 1 - geo.WGS84_B ** 2 / geo.WGS84_A ** 2

    def xy(x, y):
        if abs(lat) > 88:
            def polar(u, v):
                reach = math.radians(90 - abs(v)) * a * a / geo.WGS84_B
                return reach * math.sin(math.radians(u)), reach * math.cos(math.radians(u))
            return tuple(p - q for p, q in zip(polar(x, y), polar(lon, lat)))
        mid = math.radians((lat + y) / 2)
        w = 1 - e2 * math.sin(mid) ** 2
        return math.radians(x - lon) * a / math.sqrt(w) * math.cos(mid), math.radians(y - lat) * a * (1 - e2) / w ** 1.5

    best, crossings = math.inf, 0
    for (x1, y1), (x2, y2) in zip(ring_points, ring_points[1:]):
        turn = -360 if x1 - lon > 180 else 360 if x1 - lon < -180 else 0
        (ax, ay), (bx, by) = xy(x1 + turn, y1), xy(x2 + turn, y2)
        dx, dy = bx - ax, by - ay
        t = max(0.0, min(1.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        best = min(best, math.hypot(ax + t * dx, ay + t * dy))
        crossings += (y1 > lat) != (y2 > lat) and x1 + (lat - y1) * (x2 - x1) / (y2 - y1) > lon
    return best, crossings


def brute(points, areas, metres):
    """{(point id, area id): metres} by trying every point with every polygon."""
    out = {}
    for pid, lon, lat in points:
        for aid, polygons in areas:
            if None in (lon, lat) or polygons is None or any(abs(p["lat"] - lat) > 150 for polygon in polygons for r in polygon for p in r):
                continue
            rings = []
            for ring in (r for polygon in polygons for r in polygon):
                ps = [(p["lon"], p["lat"]) for p in ring]
                if any(abs(p[0] - q[0]) > 180 for p, q in zip(ps, ps[1:])):
                    ps = [(x + 360 if x < 0 else x, y) for x, y in ps]
                rings.append(ps)
            near = min((metres_between(lon, lat, ps)[0] for ps in rings), default=math.inf)
            inside = any(sum(metres_between(at, lat, ps)[1] for ps in rings) % 2 for at in (lon - 360, lon, lon + 360))
            far = 0.0 if inside else near
            if far <= metres:
                out[pid, aid] = min(far, out.get((pid, aid), math.inf))
    return out


def _offset(lat0, metres_north):
    return lat0 + metres_north / 111_250.0  # rough: only used to place points either side of 8 km


def test_within_distance_edges(spark):
    # area: square of ±0.01° around (-1.0, 52.0); points north of its top edge
    area = spark.createDataFrame([("A1", [[square(-1.0, 52.0, 0.01)]])], f"area_id string, {GEOM}")
    top = 52.01
    pts = spark.createDataFrame([(1, -1.0, 52.0), (2, -1.0, _offset(top, 7_900)), (3, -1.0, _offset(top, 8_100)),
                                 (4, -1.0, _offset(top, 30_000))], "id int, lon double, lat double")
    out = within_distance(pts, area, 8000.0, point_id="id", area_id="area_id", with_distance=True)
    got = {r.id: r.distance_m for r in out.collect()}
    assert set(got) == {1, 2}
    assert got[1] == 0.0 and abs(got[2] - 7900) < 30


def test_within_distance_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    areas = [(f"a{i}", [[square(rnd.uniform(-3, 1), rnd.uniform(50, 54), rnd.uniform(0.01, 0.2))]]) for i in range(30)]
    pts = [(i, rnd.uniform(-3.5, 1.5), rnd.uniform(49.5, 54.5)) for i in range(400)]
    adf = spark.createDataFrame(areas, f"area_id string, {GEOM}")
    pdf = spark.createDataFrame(pts, "id int, lon double, lat double")
    fast = {(r.id, r.area_id) for r in within_distance(pdf, adf, 8000.0, point_id="id", area_id="area_id").collect()}
    assert fast == {(i, a) for (i, a) in brute(pts, areas, 8000.0)} and len(fast) > 0


def test_simplify_keeps_four_points(spark):
    ring = [{"lon": math.cos(t / 50 * 2 * math.pi), "lat": math.sin(t / 50 * 2 * math.pi)} for t in range(50)]
    ring.append(ring[0])
    df = spark.createDataFrame([(1, [[ring]])], f"id int, {GEOM}")
    out = count_vertices(simplify(df, tolerance=0.05)).first()
    assert 4 <= out.npoints < 51
    tiny = count_vertices(simplify(df, tolerance=10.0)).first()
    assert tiny.npoints == 4


def wavy(rnd, x0, y0, size, n):
    """A closed ring of n points around a centre, its radius varying."""
    ring = [{"lon": x0 + size * rnd.uniform(0.5, 1) * math.cos(2 * math.pi * k / n), "lat": y0 + size * rnd.uniform(0.5, 1) * math.sin(2 * math.pi * k / n)} for k in range(n)]
    return ring + ring[:1]


def wrapped(ring):
    return [{"lon": p["lon"] - 360 if p["lon"] >= 180 else p["lon"], "lat": p["lat"]} for p in ring]


def places(rnd):
    areas = [("line", [[wrapped(square(180, 10, 0.3))]]), ("line long", [[wrapped(square(179.9, -30, 5))]]), ("beyond", [[square(181, 20, 0.5)]]),
             ("north", [[square(20, 89.95, 0.03)]]), ("far north", [[square(-100, 88.4, 0.2)]]), ("south", [[square(0, -89.99, 0.005)]]),
             ("holes", [[square(5, 5, 1), square(5, 5, 0.5), square(5.7, 5.7, 0.1)]]),
             ("parts", [[square(30, 30, 0.2), square(30, 30, 0.15)], [square(30, 30, 0.05)], [square(31, 30, 0.01)]]),
             ("flat", [[square(40, 40, 0.0)]]), ("one point", [[square(41, 40, 0.0)[:1]]]), ("none", None), ("empty", []), (None, [[square(42, 40, 0.1)]]),
             ("twice", [[square(43, 40, 0.3)]]), ("twice", [[square(43, 40, 0.3)]]), ("twice", [[square(44, 40, 0.1)]]), ("same", [[square(43, 40, 0.3)]])]
    areas += [(f"coast {k}", [[wavy(rnd, 10 + k % 3 / 50, 60, 0.4, 300)]]) for k in range(6)]
    areas += [("tall", [[square(-20, 0, 0.1)[:1] + [{"lon": -20.0, "lat": 60.0}, {"lon": -19.0, "lat": 60.0}] + square(-20, 0, 0.1)[:1]]])]
    points = []
    for lon, lat, spread in ((180, 10, 0.5), (180, -30, 6), (-179, 20, 0.7), (20, 89.95, 0.06), (-160, 89.95, 0.1), (-100, 88.4, 0.4), (100, -89.99, 0.02), (5, 5, 1.2),
                             (30.2, 30, 0.5), (40, 40, 0.1), (41, 40, 0.1), (42, 40, 0.2), (43, 40, 0.4), (10, 60, 0.5), (-20, 30, 1.0)):
        for _ in range(25):
            x = lon + rnd.uniform(-spread, spread)
            points.append((len(points), (x + 180) % 360 - 180, max(-90.0, min(90.0, lat + rnd.uniform(-spread, spread)))))
    points += [(1000, None, 5.0), (1001, 5.0, None), (None, 5.0, 5.9), (3, 5.0, 5.9), (3, 5.0, 5.9), (1002, float(90), 90.0), (1003, -10.0, -90.0), (1004, 10.0, 60.0)]
    return points, areas


@pytest.mark.parametrize("split, bands", [(4096, 32), (20, 3)])
def test_everywhere_and_split_cells(spark, monkeypatch, split, bands):
    import random
    monkeypatch.setattr(proximity, "SPLIT_EDGES", split)
    monkeypatch.setattr(proximity, "BAND_EDGES", bands)
    monkeypatch.setattr(proximity, "HEAVY", 1000)
    points, areas = places(random.Random(1))
    adf = spark.createDataFrame([(*a, 1) for a in areas], f"area_id string, {GEOM}, level int").repartition(3)
    pdf = spark.createDataFrame([(*p, 1) for p in points], "id int, lon double, lat double, cell int").repartition(3)
    got = {(r.id, r.area_id): r.distance_m for r in within_distance(pdf, adf, 8000.0, with_distance=True).collect()}
    want = brute(points, areas, 8000.0)
    assert set(got) == set(want) and len(got) > 150
    assert all(abs(got[k] - want[k]) < 1e-3 for k in want)
    assert {a for _, a in got} >= {"line", "line long", "beyond", "north", "far north", "south", "holes", "parts", "flat", None, "tall"}


def test_no_points_or_areas(spark):
    areas = spark.createDataFrame([("A", [[square(0, 0, 1)]])], f"area_id string, {GEOM}")
    pts = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    assert within_distance(pts.limit(0), areas).count() == 0
    assert within_distance(pts, areas.limit(0)).count() == 0
    assert within_distance(pts, areas).count() == 1


def test_no_polygon_travels(spark):
    areas = spark.createDataFrame([("A", [[square(0, 0, 1)]])], f"area_id string, {GEOM}")
    pts = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    plan = within_distance(pts, areas)._jdf.queryExecution().optimizedPlan()
    found = []

    def walk(node):
        if node.nodeName() in ("Join", "Aggregate", "Repartition"):
            kids = node.children()
            for k in range(kids.size()):
                found.append(kids.apply(k).schema().simpleString() if node.nodeName() != "Aggregate" else node.schema().simpleString())
        for k in range(node.children().size()):
            walk(node.children().apply(k))
    walk(plan)
    assert found and not any("array" in s for s in found)


def test_exploded_cells_are_not_broadcast(spark):
    # 40 edges are small, their cells need not be: Spark does not count what an explode makes
    areas = spark.range(10).selectExpr("id as area_id", f"array(array(transform(array({', '.join(f'named_struct(\'lon\', {p['lon']}D, \'lat\', {p['lat']}D)' for p in square(0, 0, 1))}),"
                                       " p -> named_struct('lon', p.lon + id, 'lat', p.lat)))) as geom")
    pts = spark.range(100).selectExpr("id", "id % 10 + 0.5D as lon", "0D as lat")
    df = within_distance(pts, areas)
    found = []

    def walk(node):
        if node.nodeName() == "BroadcastExchange":
            found.append(node.treeString() if hasattr(node, "treeString") else node.toString())
        for k in range(node.children().size()):
            walk(node.children().apply(k))
    walk(df._jdf.queryExecution().sparkPlan())
    walk(df._jdf.queryExecution().executedPlan().initialPlan())
    assert not any("Generate" in f for f in found)
    assert df.count() > 100
