"""Points within a distance of polygons (J10, J11, X20, X21, V12) without moving a polygon.

Rings are exploded to edges in the task that reads them; after that only edges (four numbers and the
polygon's hash) and boxes travel. Two joins, both on equal keys, both sorted and spilled, never broadcast:

* **Near the boundary.** A quadtree cell is (level, row, column); level ``l`` cuts the world into
  ``2^l`` rows and columns. An edge's box, widened by the distance, takes a level at
  which it covers a few rows (``FINER``), and goes to the cells that it touches. A point goes to its cell
  on every level that edges use (at most ``LEVELS``). A cell with too many edges splits: its edges
  and points go to its children, as deep as its load asks, so a dense place is many keys.
* **Inside.** A point's candidates are the polygons whose box holds it (by box cells, in the same join). Each polygon
  is cut into row bands of about ``BAND_EDGES`` edges; a candidate meets only the edges of its band
  and the parity of those to its east decides. Bands spread a polygon with very many vertices.

Longitudes wrap at 180 degrees: columns are taken modulo the row, differences modulo 360. A ring whose
successive points lie more than 180 degrees apart crosses the date line and is read as continuous.
Near a pole the widened box covers all columns, and above ``POLAR`` degrees distances are measured in the plane
centred on the pole. An area that holds a pole itself is given as GeoJSON asks, with edges along
the date line to the pole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.geo import WGS84_A, WGS84_B
from gaugework.operators.spatial import local_xy, steps

LEVELS = 20
#: Levels by which an edge's cells are finer than its box: more cells an edge, fewer points a cell that are too far.
FINER = 2
POLAR = 88.0
#: Edges of a polygon that share a row band, about.
BAND_EDGES = 32
#: A cell splits when it holds this many edges and more than 1/HEAVY of all: at most HEAVY cells do.
SPLIT_EDGES, HEAVY = 4096, 1000
#: Cells of boxes have numbers of their own, above those of edges.
BOXES = 1 << 60
FLATTENING = (WGS84_A - WGS84_B) / WGS84_A


def _cell(level: Column, row: Column, column: Column) -> Column:
    """One number for (level, row, column); rows and columns wrap into the level's range."""
    n = _cells(level)
    return (level.cast("long") * (1 << 44) + F.greatest(F.lit(0), F.least(row, n - 1)) * (1 << 22) + F.pmod(column, n)).cast("long")


def _cells(level: Column) -> Column:
    return F.pow(F.lit(2.0), level).cast("long")


def _row(lat: Column, level: Column) -> Column:
    return F.floor((lat + 90) * _cells(level) / 180).cast("long")


def _column(lon: Column, level: Column) -> Column:
    return F.floor((lon + 180) * _cells(level) / 360).cast("long")


def _cover(level: Column, w: str, s: str, e: str, n: str) -> Column:
    """array<cell> of a box at a level: its rows times its columns, at most all of them."""
    first, last = _column(F.col(w), level), _column(F.col(e), level)
    last = F.least(last, first + _cells(level) - 1)
    return F.flatten(F.transform(F.sequence(_row(F.col(s), level), _row(F.col(n), level)), lambda r: F.transform(
        F.sequence(first, last), lambda c: _cell(level, r, c))))


def _deepest(size: Column, world: float) -> Column:
    """The deepest level whose cells are not smaller than ``size``."""
    return F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.floor(F.log2(F.lit(world) / F.greatest(size, F.lit(1e-9)))))).cast("int")


def continuous(ring: Column) -> Column:
    """A ring that crosses the date line, with its western longitudes moved up by 360."""
    crosses = F.exists(steps(F.size(ring) - 2), lambda i: F.abs(ring[i]["lon"] - ring[i + 1]["lon"]) > 180)
    moved = F.transform(ring, lambda p: F.struct(F.when(p["lon"] < 0, p["lon"] + 360).otherwise(p["lon"]).alias("lon"), p["lat"].alias("lat")))
    return F.when(crosses, moved).otherwise(ring)


def edges(areas: DataFrame, rings: str) -> DataFrame:
    """(shape, x1, y1, x2, y2, w, s, e, n, edges): one row an edge; the box and number of edges are the polygon's."""
    whole = areas.select(F.xxhash64(rings).alias("shape"), F.transform(F.flatten(rings), continuous).alias("r"))
    made = F.flatten(F.transform("r", lambda r: F.transform(steps(F.size(r) - 2), lambda i: F.struct(
        r[i]["lon"].alias("x1"), r[i]["lat"].alias("y1"), r[i + 1]["lon"].alias("x2"), r[i + 1]["lat"].alias("y2")))))
    whole = whole.select("shape", made.alias("es")).withColumn("edges", F.size("es"))
    box = [f(F.flatten(F.transform("es", lambda e: F.array(e[a], e[b])))).alias(name)
           for name, f, a, b in (("w", F.array_min, "x1", "x2"), ("s", F.array_min, "y1", "y2"),
                                 ("e", F.array_max, "x1", "x2"), ("n", F.array_max, "y1", "y2"))]
    return whole.select("shape", "edges", *box, F.explode("es").alias("edge")).select("shape", "edge.*", "w", "s", "e", "n", "edges")


def _degrees_around(edge_rows: DataFrame, metres: float) -> DataFrame:
    """Edges with their widened box (bw, bs, be, bn) and level."""
    margin = metres / (WGS84_A * (1 - FLATTENING) ** 2) * 180 / math.pi * 1.01  # smallest meridional radius
    low, high = F.least("y1", "y2") - margin, F.greatest("y1", "y2") + margin
    out = edge_rows.withColumn("bs", low).withColumn("bn", high)
    top = F.greatest(F.abs("bs"), F.abs("bn"))
    side = F.when(top < 90, F.lit(metres / WGS84_A * 180 / math.pi * 1.01) / F.cos(F.radians(top))).otherwise(F.lit(180.0))
    side = F.least(side, F.lit(180.0))
    out = out.withColumn("bw", F.least("x1", "x2") - side).withColumn("be", F.greatest("x1", "x2") + side)
    return out.withColumn("level", F.least(_deepest(F.col("bn") - F.col("bs"), 180.0) + FINER, F.lit(LEVELS)).cast("int"))


def _polar_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres in the plane centred on the nearer pole."""
    reach = F.radians(90 - F.abs(lat)) * (WGS84_A * WGS84_A / WGS84_B)
    return reach * F.sin(F.radians(lon)), reach * F.cos(F.radians(lon))


def _around(px: Column, py: Column) -> list[Column]:
    """The ends of the edge (x1, y1, x2, y2) in metres from the point: ax, ay, bx, by."""
    d = F.col("x1") - px
    turn = F.when(d > 180, F.lit(-360.0)).when(d < -180, F.lit(360.0)).otherwise(F.lit(0.0))
    polar, at, ends = F.abs(py) > POLAR, _polar_xy(px, py), []
    for lon, lat in ((F.col("x1"), F.col("y1")), (F.col("x2"), F.col("y2"))):
        flat, capped = local_xy(px, py, lon + turn, lat), _polar_xy(lon, lat)
        ends += [F.when(polar, c - a).otherwise(f) for c, a, f in zip(capped, at, flat)]
    return [e.alias(name) for e, name in zip(ends, ("ax", "ay", "bx", "by"))]


def _to_segment() -> Column:
    """Squared distance of the origin from the segment (ax, ay)-(bx, by)."""
    ax, ay, dx, dy = F.col("ax"), F.col("ay"), F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / length))).otherwise(F.lit(0.0))
    x, y = ax + t * dx, ay + t * dy
    return x * x + y * y


def _on_levels(points: DataFrame, edge_levels: list[int], box_levels: list[int]) -> DataFrame:
    """``points`` once for each level of edges and of boxes, with its cell; a point without a place lies in no cell
    (below 0, spread by its id), so that no filter on it is inferred and pushed below the maths that made the place."""
    at = F.array(*[F.struct(F.lit(n).alias("level"), F.lit(first).alias("first"))
                   for levels, first in ((edge_levels, 0), (box_levels, BOXES)) for n in levels])
    level = F.col("level")
    cell = _cell(level, _row(F.col("py"), level), _column(F.col("px"), level)) + F.col("first")
    nowhere = -1 - F.pmod(F.xxhash64("pid"), F.lit(1 << 20))
    return points.select("*", F.inline(at)).withColumn("cell", F.coalesce(F.when(F.abs("py") <= 90, cell), nowhere).cast("long"))


def _split(df: DataFrame, heavy: DataFrame, child: Column) -> DataFrame:
    """Cells of ``heavy`` (cell, depth) give way to their children; ``child`` is array<cell> at level + depth."""
    j = df.join(F.broadcast(heavy), "cell", "left")  # at most HEAVY rows, see within_distance
    return j.withColumn("child", F.explode(F.when(F.col("depth") > 0, child).otherwise(F.array("cell")))).drop("depth")


def candidates(points: DataFrame, edge_rows: DataFrame, boxes: DataFrame, edge_levels: list[int], box_levels: list[int],
               heavy: DataFrame | None, metres: float) -> DataFrame:
    """(pid, px, py, shape, d2, x, band, copies), one row a point and shape: the smallest squared distance to the shape's edges,
    up to ``metres`` or null; and if the shape's box holds the point its longitude there, row band and the shape's copies, else null.

    Edges and boxes meet the points in one join, so that the points are made and dealt once. Spark takes exploded cells
    for no larger than the table they come from, so the join is told not to broadcast them."""
    e = edge_rows.withColumn("cell", F.explode(_cover(F.col("level"), "bw", "bs", "be", "bn")))
    p = _on_levels(points, edge_levels, box_levels)
    if heavy is not None:
        deep = (F.col("level") + F.col("depth")).cast("int")
        inside = F.filter(_cover(deep, "bw", "bs", "be", "bn"), lambda c: _parent(c, F.col("depth")) == F.col("cell"))
        e = _split(e, heavy, inside)
        p = _split(p, heavy, F.array(_cell(deep, _row(F.col("py"), deep), _column(F.col("px"), deep))))
    key = F.col("cell" if heavy is None else "child").alias("k")
    e = e.select(key, "shape", "x1", "y1", "x2", "y2", "bw", "bs", "be", "bn",
                 F.lit(None).cast("long").alias("bands"), F.lit(None).cast("long").alias("copies"))
    # a box's corners stand as x1, y1, x2, y2; its longitudes are widened against rounding, the crossings decide
    b = boxes.withColumn("cell", F.explode(_cover(F.col("level"), "w", "s", "e", "n")))
    b = b.select((F.col("cell") + BOXES).alias("k"), "shape", F.col("w").alias("x1"), F.col("s").alias("y1"),
                     F.col("e").alias("x2"), F.col("n").alias("y2"), (F.col("w") - 1e-9).alias("bw"), F.col("s").alias("bs"),
                     (F.col("e") + 1e-9).alias("be"), F.col("n").alias("bn"), "bands", "copies")
    hit = p.select(key, "pid", "px", "py").join(e.unionByName(b).hint("merge"), "k")
    # the widened box once more, point by point, before any trigonometry (coalesced: else tests of px and py for null are
    # inferred, and pushed with a copy of the maths that made them below it)
    within = (F.col("py") >= F.col("bs")) & (F.col("py") <= F.col("bn")) & (F.pmod(F.col("px") - F.col("bw"), F.lit(360.0)) <= F.col("be") - F.col("bw"))
    hit = hit.filter(F.coalesce(within, F.lit(False)))
    turned = F.when(F.col("px") < F.col("x1"), F.col("px") + 360).when(F.col("px") > F.col("x2"), F.col("px") - 360).otherwise(F.col("px"))
    boxed = F.col("bands").isNotNull()
    hit = hit.select("pid", "px", "py", "shape", "copies", boxed.alias("boxed"), F.when(boxed, turned).alias("x"),
                     F.when(boxed, _band(F.col("py"), "y1", "y2")).alias("band"), *_around(F.col("px"), F.col("py")))
    # the limit comes after the minimum: a filter before it would be pushed below both projections and copy them
    least = hit.groupBy("pid", "px", "py", "shape").agg(
        F.min(F.when(~F.col("boxed"), _to_segment())).alias("d2"), *[F.max(c).alias(c) for c in ("x", "band", "copies")])
    return least.withColumn("d2", F.when(F.col("d2") <= metres * metres, F.col("d2"))).filter(F.col("d2").isNotNull() | F.col("band").isNotNull())


def _parent(cell: Column, depth: Column) -> Column:
    """The cell ``depth`` levels up."""
    level, row, column = F.shiftright(cell, 44), F.shiftright(cell, 22).bitwiseAND((1 << 22) - 1), cell.bitwiseAND((1 << 22) - 1)
    half = _cells(depth)
    up = (level - depth).cast("long")
    return (up * (1 << 44) + F.floor(row / half) * (1 << 22) + F.floor(column / half)).cast("long")


def _band(y: Column, low: str, high: str) -> Column:
    height = (F.col(high) - F.col(low)) / F.col("bands")
    return F.when(height > 0, F.least(F.floor((y - F.col(low)) / height).cast("long"), F.col("bands") - 1)).otherwise(F.lit(0).cast("long"))


def settled(cand: DataFrame, edge_rows: DataFrame) -> DataFrame:
    """(shape, pid, d2): the candidates near an edge, and those in the shape's interior with d2 = 0, by the parity of
    its edges to their east. Those outside the box have no band and meet no edge."""
    rows = edge_rows.withColumn("bands", _bands()).filter("y1 <> y2").select(
        "shape", "x1", "y1", "x2", "y2", F.explode(F.sequence(_band(F.least("y1", "y2"), "s", "n"), _band(F.greatest("y1", "y2"), "s", "n"))).alias("band"))
    j = cand.join(rows.hint("merge"), ["shape", "band"], "left")
    cross = F.col("x1") + (F.col("py") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    east = ((F.col("y1") > F.col("py")) != (F.col("y2") > F.col("py"))) & (cross > F.col("x"))
    c = j.groupBy("pid", "px", "py", "shape").agg(F.max("d2").alias("d2"), F.max("copies").alias("copies"), F.count(F.when(east, 1)).alias("c"))
    # a polygon that stands in several rows crosses as often as it stands there
    d2 = F.when(F.expr("(c div copies) % 2 = 1"), F.lit(0.0)).otherwise(F.col("d2"))
    return c.select("shape", "pid", d2.alias("d2")).filter(F.col("d2").isNotNull())


def _bands() -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col("edges") / BAND_EDGES)).cast("long")


def within_distance(points: DataFrame, areas: DataFrame, metres: float = 8000.0, point_id: str = "id", area_id: str = "area_id",
                    rings: str = "geom", lon: str = "lon", lat: str = "lat", with_distance: bool = False) -> DataFrame:
    """(point_id, area_id) pairs at most ``metres`` apart, 0 inside; ``distance_m`` on request, the
    smallest over the places and polygons of the two ids. NULL places and geometries have no pairs; a
    NULL id pairs like any other. Repeated rows count once.

    One small job first counts edges by cell; the driver gets one row a level. If a cell is heavy,
    at most ``HEAVY`` cells are broadcast with the depth of their split."""
    x = F.col(lon).cast("double")
    x = F.when((x >= -180) & (x < 180), x).otherwise(F.pmod(x + 180, F.lit(360.0)) - 180)
    p = points.select(F.col(point_id).alias("pid"), x.alias("px"), F.col(lat).cast("double").alias("py")).distinct()
    edge_rows = edges(areas.select(rings), rings).repartition("shape", "x1", "y1")  # areas may come in one file: its cells are made by all
    wide = _degrees_around(edge_rows, metres)
    boxes = areas.select(rings).select(F.xxhash64(rings).alias("shape"), F.transform(F.flatten(rings), continuous).alias("r"))
    boxes = boxes.select("shape", F.flatten("r").alias("ps"), F.size(F.filter("r", lambda r: F.size(r) > 0)).alias("rs"))
    boxes = boxes.withColumn("edges", F.size("ps") - F.col("rs"))
    boxes = boxes.filter("edges > 0").groupBy("shape").agg(
        F.count("*").alias("copies"), F.max("edges").alias("edges"),
        *[f(g(F.transform("ps", lambda q: q[k]))).alias(name) for name, f, g, k in (
            ("w", F.min, F.array_min, "lon"), ("s", F.min, F.array_min, "lat"), ("e", F.max, F.array_max, "lon"), ("n", F.max, F.array_max, "lat"))])
    boxes = boxes.withColumn("bands", _bands()).drop("edges").withColumn(
        "level", F.least(_deepest(F.col("n") - F.col("s"), 180.0), _deepest(F.col("e") - F.col("w"), 360.0)))

    loads = wide.select("level", F.explode(_cover(F.col("level"), "bw", "bs", "be", "bn")).alias("cell")).groupBy("level", "cell").agg(F.count("*").alias("c"))
    counts = loads.groupBy("level").agg(F.sum("c").alias("all"), F.max("c").alias("most"), F.lit(0).alias("boxes"))
    counts = counts.unionByName(boxes.groupBy("level").agg(F.lit(0).cast("long").alias("all"), F.lit(0).cast("long").alias("most"), F.lit(1).alias("boxes")))
    found = counts.collect()  # at most 2 * (LEVELS + 1) rows
    of_edges, of_boxes = (sorted({r["level"] for r in found if r["boxes"] == k}) for k in (0, 1))
    limit = max(SPLIT_EDGES, sum(r["all"] for r in found) // HEAVY)
    heavy = None
    if any(r["most"] > limit for r in found):
        depth = F.least(F.ceil(F.log(F.col("c") / limit) / math.log(2)), F.lit(LEVELS) - F.col("level")).cast("int")
        heavy = loads.filter(F.col("c") > limit).select("cell", F.greatest(depth, F.lit(0)).alias("depth"))

    hits = settled(candidates(p, wide, boxes, of_edges or [0], of_boxes or [0], heavy, metres), edge_rows)
    ids = areas.select(F.xxhash64(rings).alias("shape"), F.col(area_id).alias("aid")).distinct()
    out = hits.join(ids, "shape").groupBy("pid", "aid").agg(F.sqrt(F.min("d2")).alias("distance_m"))
    columns = [F.col("pid").alias(point_id), F.col("aid").alias(area_id)] + (["distance_m"] if with_distance else [])
    return out.select(*columns)


def within_distance_missing(points: DataFrame, areas: DataFrame, done: DataFrame, metres: float = 8000.0, point_id: str = "id",
                            area_id: str = "area_id", exclude: Column | None = None, **kw) -> DataFrame:
    """Only points absent from ``done`` (anti join first), optionally excluding some."""
    todo = points.join(done.select(point_id).distinct(), point_id, "left_anti")
    if exclude is not None:
        todo = todo.filter(~exclude)
    return within_distance(todo, areas, metres, point_id, area_id, **kw)
