"""Polygons of several parts with holes: one row an edge, points and cells against them, and how two of them relate.

A shape is every ring of every part together: a point is inside if a ray from it crosses an odd number of all their
edges, so holes and islands need no case of their own. Nothing here holds a shape whole: edges are dealt to rows or cells and
what they say of a point, a cell or a pair is summed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrelith.operators.overlay import coverage
from pyrelith.runtime import Scratch

POINTS = "array<array<double>>"
#: What GeoJSON calls the two kinds of polygons, and the type of their coordinates: fixed by the format.
POLYGON, MULTIPOLYGON = "Polygon", "MultiPolygon"


def parse_shapes(text: DataFrame, col: str = "value") -> DataFrame:
    """One row a feature, ``(properties, kind, parts)``: its properties as text, its geometry's type and all its parts' rings of points.

    A polygon is one part. Features of other kinds, without geometry or with text that is no JSON stay, with no parts.
    """
    geometry = F.get_json_object(col, "$.geometry")
    f = text.select(F.get_json_object(col, "$.properties").alias("properties"), F.get_json_object(geometry, "$.type").alias("kind"), F.get_json_object(geometry, "$.coordinates").alias("c"))
    one, several = F.from_json("c", f"array<{POINTS}>"), F.from_json("c", f"array<array<{POINTS}>>")
    parts = F.when(F.col("kind") == POLYGON, F.array(one)).when(F.col("kind") == MULTIPOLYGON, several)
    return f.select("properties", "kind", F.coalesce(parts, F.array().cast(f"array<array<{POINTS}>>")).alias("parts"))


def ring_rows(shapes: DataFrame, key: str, parts: str = "parts") -> DataFrame:
    """``(key, part, ring, hole, points)``: the rings of all parts, the first of a part being its outline."""
    p = shapes.select(key, F.posexplode(parts).alias("part", "rings")).select(key, "part", F.posexplode("rings").alias("ring", "points"))
    return p.select(key, "part", "ring", (F.col("ring") > 0).alias("hole"), "points")


def edge_rows(shapes: DataFrame, key: str, parts: str = "parts") -> DataFrame:
    """``(key, part, ring, x1, y1, x2, y2)``: neighbouring points of each ring, the last with the first; edges without length are left out."""
    after = F.concat(F.slice("points", 2, F.size("points")), F.slice("points", 1, 1))
    e = ring_rows(shapes, key, parts).where(F.size("points") > 0).select(key, "part", "ring", F.explode(F.arrays_zip(F.col("points").alias("a"), after.alias("b"))).alias("e"))
    e = e.select(key, "part", "ring", *[F.col(f"e.{p}")[i].alias(n) for p, i, n in (("a", 0, "x1"), ("a", 1, "y1"), ("b", 0, "x2"), ("b", 1, "y2"))])
    return e.where("x1 <> x2 or y1 <> y2")


def boxes(edges: DataFrame, key: str) -> DataFrame:
    """``(key, w, s, e, n, edges)`` of each shape."""
    return edges.groupBy(key).agg(F.min(F.least("x1", "x2")).alias("w"), F.min(F.least("y1", "y2")).alias("s"), F.max(F.greatest("x1", "x2")).alias("e"), F.max(F.greatest("y1", "y2")).alias("n"), F.count(F.lit(1)).alias("edges"))


def cells_of(lo: Column, hi: Column, size: float | Column) -> Column:
    return F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size)))


def crossed(x: Column, y: Column) -> Column:
    """1 if a ray to the right of (x, y) crosses the edge; a vertex counts for one of its two edges."""
    rise = F.coalesce(F.try_divide(y - F.col("y1"), F.col("y2") - F.col("y1")), F.lit(0.0))
    return (((F.col("y1") > y) != (F.col("y2") > y)) & (x < (F.col("x2") - F.col("x1")) * rise + F.col("x1"))).cast("int")


def on_edge(x: Column, y: Column) -> Column:
    flat = (F.col("x2") - F.col("x1")) * (y - F.col("y1")) == (F.col("y2") - F.col("y1")) * (x - F.col("x1"))
    return flat & x.between(F.least("x1", "x2"), F.greatest("x1", "x2")) & y.between(F.least("y1", "y2"), F.greatest("y1", "y2"))


def points_in_shapes(points: DataFrame, edges: DataFrame, point_key: str, key: str, cell: float, boundary: bool = True) -> DataFrame:
    """``(point_key, key)`` for every shape that a point lies in, its boundary included or not.

    Points ``(point_key, x, y)`` meet the shapes whose box has a part in their cell. A shape has as many rows as the root of its number of edges;
    a point is compared with the edges that reach into its row, never with the whole shape.
    """
    b = boxes(edges, key).withColumn("height", F.greatest((F.col("n") - F.col("s")) / F.ceil(F.sqrt("edges")), F.lit(1e-300)))
    dealt = b.withColumn("cx", cells_of(F.col("w"), F.col("e"), cell)).withColumn("cy", cells_of(F.col("s"), F.col("n"), cell))
    p = points.select(point_key, F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    near = p.join(dealt, ["cx", "cy"]).where(F.col("px").between(F.col("w"), F.col("e")) & F.col("py").between(F.col("s"), F.col("n")))
    near = near.select(point_key, "px", "py", F.col(key).alias("shape"), F.floor((F.col("py") - F.col("s")) / F.col("height")).alias("row"))
    rows = edges.join(b.select(F.col(key).alias("shape"), "s", "height"), F.col(key) == F.col("shape"))
    rows = rows.select("shape", "x1", "y1", "x2", "y2", cells_of(F.least("y1", "y2") - F.col("s"), F.greatest("y1", "y2") - F.col("s"), F.col("height")).alias("row"))
    px, py = F.col("px"), F.col("py")
    found = near.join(rows, ["shape", "row"]).groupBy(point_key, F.col("shape").alias(key)).agg(F.sum(crossed(px, py)).alias("n"), F.max(on_edge(px, py)).alias("on"))
    odd = F.col("n") % 2 == 1
    return found.where(F.col("on") | odd if boundary else ~F.col("on") & odd).select(point_key, key)


def assign_shapes(points: DataFrame, edges: DataFrame, names: DataFrame, point_key: str, key: str, cell: float, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """Left outer: every point with the first shape by ``key`` that covers it and that shape's names; none is null and ``on_land`` false."""
    hit = points_in_shapes(points.select(point_key, F.col(x).alias("x"), F.col(y).alias("y")), edges, point_key, key, cell).groupBy(point_key).agg(F.min(key).alias(key))
    return points.join(hit.join(names, key, "left"), point_key, "left").withColumn("on_land", F.col(key).isNotNull())


def through_open_box(w: Column, s: Column, size: float) -> Column:
    """Whether an edge passes through the inside of a square: some of it lies strictly between both pairs of sides."""

    def span(a: Column, b: Column, lo: Column) -> tuple[Column, Column, Column]:
        t1, t2 = F.try_divide(lo - a, b - a), F.try_divide(lo + size - a, b - a)
        held = (a != b) | ((a > lo) & (a < lo + size))
        return F.coalesce(F.least(t1, t2), F.lit(0.0)), F.coalesce(F.greatest(t1, t2), F.lit(1.0)), held

    x0, x1, x_held = span(F.col("x1"), F.col("x2"), w)
    y0, y1, y_held = span(F.col("y1"), F.col("y2"), s)
    return x_held & y_held & (F.greatest(x0, y0, F.lit(0.0)) < F.least(x1, y1, F.lit(1.0)))


def edge_cells(edges: DataFrame, size: float) -> DataFrame:
    """The edges with each cell of side ``size`` whose inside they pass through; by column first, so that a long slanted edge meets few cells."""
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    c = edges.withColumn("cx", cells_of(lo, hi, size))
    slope = F.coalesce(F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")), F.lit(0.0))
    at = lambda x: F.col("y1") + (F.least(F.greatest(x, lo), hi) - F.col("x1")) * slope
    ya = F.when(F.col("x1") == F.col("x2"), F.col("y1")).otherwise(at(F.col("cx") * size))
    yb = F.when(F.col("x1") == F.col("x2"), F.col("y2")).otherwise(at((F.col("cx") + 1) * size))
    margin = 1e-9 * size
    c = c.withColumn("cy", cells_of(F.least(ya, yb) - margin, F.greatest(ya, yb) + margin, size))
    return c.where(through_open_box(F.col("cx") * size, F.col("cy") * size, size))


def overlapped_cells(edges: DataFrame, key: str, size: float) -> DataFrame:
    """``(cx, cy)``: the cells that share area with any shape; one that only touches a boundary isn't among them.

    An edge through a cell's inside settles it. Any other cell lies wholly in or out of a shape, as its centre does.
    """
    b = boxes(edges, key)
    crossed_cells = edge_cells(edges, size).select("cx", "cy").distinct()
    inner = b.select(cells_of(F.col("w"), F.col("e"), size).alias("cx"), "s", "n").select("cx", cells_of(F.col("s"), F.col("n"), size).alias("cy")).distinct()
    left = inner.join(crossed_cells, ["cx", "cy"], "left_anti").select("cx", "cy", F.struct("cx", "cy").alias("cell"), ((F.col("cx") + 0.5) * size).alias("x"), ((F.col("cy") + 0.5) * size).alias("y"))
    whole = points_in_shapes(left, edges, "cell", key, 4 * size).select("cell.cx", "cell.cy").distinct()
    return crossed_cells.unionByName(whole)


def side(ax, ay, bx, by, px, py) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def meet(e: str, f: str) -> Column:
    """Whether two edges, their ends included, have a common point."""
    a, b = [[F.col(f"{p}.{c}") for c in ("x1", "y1", "x2", "y2")] for p in (e, f)]
    s1, s2 = side(*a, b[0], b[1]), side(*a, b[2], b[3])
    s3, s4 = side(*b, a[0], a[1]), side(*b, a[2], a[3])

    def overlap(i: int) -> Column:
        return (F.least(a[i], a[i + 2]) <= F.greatest(b[i], b[i + 2])) & (F.least(b[i], b[i + 2]) <= F.greatest(a[i], a[i + 2]))

    return (s1 * s2 <= 0) & (s3 * s4 <= 0) & overlap(0) & overlap(1)


def relations(edges: DataFrame, key: str, cell: float) -> DataFrame:
    """``(a, b, relation, shared)`` for the pairs ``a < b`` with a common point: equals, contains, within, overlaps or touches, and the area they share.

    Shapes whose boxes meet in a cell are candidates. Areas of both, of either only, come from the sweep over the pair's edges
    (``overlay.coverage``); without any in common they touch if two edges that reach into one cell have a common point.
    """
    scratch = Scratch(edges.sparkSession, "relations")
    edges = scratch.table(edges, "edges")
    b = boxes(edges, key)
    dealt = b.withColumn("cx", cells_of(F.col("w"), F.col("e"), cell)).withColumn("cy", cells_of(F.col("s"), F.col("n"), cell))
    one, two = (dealt.select(F.col(key).alias(k), *[F.col(c).alias(f"{c}_{k}") for c in "wsen"], "cx", "cy") for k in "ab")
    box = (F.col("a") < F.col("b")) & (F.col("w_a") <= F.col("e_b")) & (F.col("w_b") <= F.col("e_a")) & (F.col("s_a") <= F.col("n_b")) & (F.col("s_b") <= F.col("n_a"))
    pairs = one.join(two, ["cx", "cy"]).where(box).select("a", "b").distinct()
    pairs = scratch.table(pairs, "pairs")
    e = ["x1", "y1", "x2", "y2"]
    both = pairs.join(edges.select(F.col(key).alias("a"), *e), "a").select("a", "b", F.lit(1).alias("layer"), F.col("a").alias("shape"), *e).unionByName(
        pairs.join(edges.select(F.col(key).alias("b"), *e), "b").select("a", "b", F.lit(2).alias("layer"), F.col("b").alias("shape"), *e))
    areas = coverage(both, ["a", "b"]).groupBy("a", "b").agg(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col("area"))), F.lit(0.0)).alias(n) for m, n in ((1, "only_a"), (2, "only_b"), (3, "shared"))])
    long = edges.select(F.col(key).alias("shape"), F.struct(*e).alias("e"), *e)
    long = long.withColumn("cx", cells_of(F.least("x1", "x2"), F.greatest("x1", "x2"), cell)).withColumn("cy", cells_of(F.least("y1", "y2"), F.greatest("y1", "y2"), cell)).drop(*e)
    left = long.select(F.col("shape").alias("a"), F.col("e").alias("p"), "cx", "cy")
    right = long.select(F.col("shape").alias("b"), F.col("e").alias("q"), "cx", "cy")
    touching = left.join(right, ["cx", "cy"]).where(F.col("a") < F.col("b")).where(meet("p", "q")).select("a", "b").distinct().withColumn("meet", F.lit(True))
    tiny = 1e-12 * (F.col("only_a") + F.col("only_b") + F.col("shared"))
    none = {n: F.col(n) <= tiny for n in ("only_a", "only_b", "shared")}
    relation = F.when(~none["shared"] & none["only_a"] & none["only_b"], "equals").when(~none["shared"] & none["only_b"], "contains").when(~none["shared"] & none["only_a"], "within")
    relation = relation.when(~none["shared"], "overlaps").when(F.col("meet"), "touches")
    return areas.join(touching, ["a", "b"], "left").select("a", "b", relation.alias("relation"), F.when(none["shared"], 0.0).otherwise(F.col("shared")).alias("shared")).where("relation is not null")


def ring_area(points: Column) -> Column:
    """Shoelace area of a ring of points."""
    after = F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1))
    return F.abs(F.aggregate(F.zip_with(points, after, lambda a, b: a[0] * b[1] - b[0] * a[1]), F.lit(0.0), lambda s, x: s + x)) / 2


def shape_areas(shapes: DataFrame, key: str, parts: str = "parts") -> DataFrame:
    """``(key, parts, holes, area)``: outlines less their holes."""
    r = ring_rows(shapes, key, parts).withColumn("own", ring_area(F.col("points")))
    return r.groupBy(key).agg(F.countDistinct("part").alias("parts"), F.count_if("hole").alias("holes"), F.sum(F.when(F.col("hole"), -F.col("own")).otherwise(F.col("own"))).alias("area"))


def regular_ring(x: Column, y: Column, radius: Column, corners: int) -> Column:
    """A ring of so many corners around a point, the first to its right."""
    turn = [2 * math.pi * k / corners for k in range(corners)]
    return F.array(*[F.array(x + radius * math.cos(t), y + radius * math.sin(t)) for t in turn])
