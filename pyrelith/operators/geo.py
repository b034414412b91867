"""Spatial joins by bucketed equality, point-in-polygon, nearest segment, polygon measures.

No join here is a range join: points and shapes are dealt to grid cells, joined by cell, and tested exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions.scalar import M_PER_DEG


def rectangle_ring(w: Column, s: Column, e: Column, n: Column, notched: Column) -> Column:
    """A closed-by-order ring of a box, or of one without its north-east quarter."""
    mx, my = (w + e) / 2, (s + n) / 2

    def ring(*points):
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])

    return F.when(notched, ring((w, s), (e, s), (e, my), (mx, my), (mx, n), (w, n))).otherwise(ring((w, s), (e, s), (e, n), (w, n)))


def edges(ring: Column) -> Column:
    """Pairs of neighbouring vertices, the last with the first."""
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def covers(ring: Column, x: Column, y: Column) -> Column:
    """Inside a ring or on its boundary, by ray casting with an exact test of the edges."""

    def crossed(e: Column) -> Column:
        ax, ay, bx, by = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        return ((ay > y) != (by > y)) & (x < (bx - ax) * F.coalesce(F.try_divide(y - ay, by - ay), F.lit(0.0)) + ax)

    def on(e: Column) -> Column:
        ax, ay, bx, by = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        flat = (bx - ax) * (y - ay) == (by - ay) * (x - ax)
        return flat & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))

    sides = edges(ring)
    return F.exists(sides, on) | (F.size(F.filter(sides, crossed)) % 2 == 1)


def ring_area(ring: Column) -> Column:
    """Shoelace area in the units of the coordinates."""
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda acc, e: acc + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """Centroid of the area, computed relative to the first vertex; null for a ring without area."""
    x0, y0 = ring[0]["x"], ring[0]["y"]

    def total(f):
        def step(acc, e):
            ax, ay, bx, by = e["a"]["x"] - x0, e["a"]["y"] - y0, e["b"]["x"] - x0, e["b"]["y"] - y0
            return acc + f(ax, ay, bx, by) * (ax * by - bx * ay)

        return F.aggregate(edges(ring), F.lit(0.0), step)

    double = total(lambda *_: F.lit(1.0))
    return x0 + F.try_divide(total(lambda ax, ay, bx, by: ax + bx), 3 * double), y0 + F.try_divide(total(lambda ax, ay, bx, by: ay + by), 3 * double)


def assign_polygon(points: DataFrame, polygons: DataFrame, key: str, x: str = "longitude", y: str = "latitude", cell: float = 0.25) -> DataFrame:
    """Left outer point-in-polygon with the first match by ``adm_id``; boundary included, no match is a null and ``on_land`` false.

    Polygons are dealt to the grid cells of their box. The join is an equality of cells, so its plan is a
    hash or sort-merge join; each point keeps one match by a minimum, not a window.
    """
    boxes = polygons.withColumn("cx", F.explode(F.sequence(F.floor(F.col("w") / cell), F.floor(F.col("e") / cell)))).withColumn("cy", F.explode(F.sequence(F.floor(F.col("s") / cell), F.floor(F.col("n") / cell))))
    cells = points.select(key, F.col(x).alias("px"), F.col(y).alias("py"), F.floor(F.col(x) / cell).alias("cx"), F.floor(F.col(y) / cell).alias("cy"))
    hit = cells.join(boxes, ["cx", "cy"]).where(covers(F.col("ring"), F.col("px"), F.col("py")))
    hit = hit.groupBy(key).agg(F.min(F.struct("adm_id", "distrik", "kabupaten")).alias("adm"))
    return points.join(hit, key, "left").select(*points.columns, F.col("adm.adm_id").alias("adm_id"), F.col("adm.distrik").alias("distrik"), F.col("adm.kabupaten").alias("kabupaten"), F.col("adm").isNotNull().alias("on_land"))


def overlapping_boxes(boxes: DataFrame, pad_x: float, pad_y: float, cell: float = 0.25) -> DataFrame:
    """Pairs ``adm_id < other`` whose boxes, widened on every side, have a common interior; joined by the cells they cover."""
    b = boxes.select("adm_id", (F.col("w") - pad_x).alias("w"), (F.col("s") - pad_y).alias("s"), (F.col("e") + pad_x).alias("e"), (F.col("n") + pad_y).alias("n"))
    dealt = b.withColumn("cx", F.explode(F.sequence(F.floor(F.col("w") / cell), F.floor(F.col("e") / cell)))).withColumn("cy", F.explode(F.sequence(F.floor(F.col("s") / cell), F.floor(F.col("n") / cell))))
    o = dealt.select(F.col("adm_id").alias("other"), F.col("w").alias("w2"), F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("n").alias("n2"), "cx", "cy")
    hit = (F.col("adm_id") < F.col("other")) & (F.col("w") < F.col("e2")) & (F.col("w2") < F.col("e")) & (F.col("s") < F.col("n2")) & (F.col("s2") < F.col("n"))
    return dealt.join(o, ["cx", "cy"]).where(hit).select("adm_id", "other").distinct()


def space_time_pairs(points: DataFrame, eps_m: float, eps_s: int, key: str = "detection_id", ts: str = "datetime_utc", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Pairs ``a < b`` within ``eps_m`` metres and ``eps_s`` seconds, both included, with their distance.

    Each point goes to one bucket four reaches wide and eight long in time, and looks into those that its reach to the east meets: 2.3 of
    them on average. A pair is found by its western point; the plane is that of the set's mean latitude (a one-row aggregate).
    """
    p = timed_plane(points, key, ts, lat, lon)
    return spans_in_reach(p.withColumn("u", F.col("t")), eps_m, eps_s, 0).select("a", "b", "metres", "seconds")


def spans_in_reach(p: DataFrame, eps_m: float, eps_s: int, longest: int) -> DataFrame:
    """``(a, b, metres, seconds, x, y, t)`` of pairs ``a < b`` of ``p(id, x, y, t, u)``: what stands at a place from ``t`` to ``u``, at most
    ``longest`` seconds, and the shortest time between. ``x, y, t`` are of one of the two.
    """
    wide, long, reach = 4 * eps_m, 8 * eps_s, eps_m * (1 + 1e-9)
    bucket = lambda c, size: F.floor(c / size)
    cells = lambda lo, hi, size: F.explode(F.sequence(bucket(lo, size), bucket(hi, size)))
    x, y, t, u = (F.col(c) for c in "xytu")
    probe = p.withColumn("bx", cells(x, x + reach, wide)).withColumn("by", cells(y - reach, y + reach, wide)).withColumn("bt", cells(t - (eps_s + longest), u + eps_s, long))
    # one number stands for a bucket, as a join sorts it fastest; buckets that share one are told apart
    number = lambda *c: F.xxhash64(*c).alias("bucket")
    probe = probe.select(F.col("id").alias("p"), "x", "y", "t", "u", "bx", "by", "bt", number("bx", "by", "bt"))
    q = p.select(F.col("id").alias("q"), x.alias("xb"), y.alias("yb"), t.alias("tb"), u.alias("ub"), number(bucket(x, wide), bucket(y, wide), bucket(t, long)))
    d2 = F.pow(x - F.col("xb"), 2) + F.pow(y - F.col("yb"), 2)
    apart = F.greatest(t - F.col("ub"), F.col("tb") - u, F.lit(0))
    east = (x < F.col("xb")) | (x == F.col("xb")) & (F.col("p") < F.col("q"))
    near = east & (F.col("p") != F.col("q")) & (apart <= eps_s) & (d2 <= eps_m * eps_m)
    same = (bucket(F.col("xb"), wide) - F.col("bx") == 0) & (bucket(F.col("yb"), wide) - F.col("by") == 0) & (bucket(F.col("tb"), long) - F.col("bt") == 0)
    return probe.join(q, "bucket").where(near & same).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), F.sqrt(d2).alias("metres"), apart.alias("seconds"), "x", "y", "t")


def timed_plane(points: DataFrame, key: str, ts: str, lat: str, lon: str) -> DataFrame:
    """``(id, x, y, t)``: metres on the plane of the points' mean latitude (a one-row aggregate) and whole seconds."""
    mean = points.agg(F.avg(lat).alias("mean_lat"))
    x = F.col(lon) * (F.cos(F.radians("mean_lat")) * M_PER_DEG)
    return points.join(F.broadcast(mean)).select(F.col(key).alias("id"), x.alias("x"), (F.col(lat) * M_PER_DEG).alias("y"), F.unix_seconds(F.col(ts).cast("timestamp")).alias("t"))


def within_circles(everything: DataFrame, points: DataFrame, centres: DataFrame, radius_m: float, key: str = "detection_id") -> DataFrame:
    """The rows of ``points`` inside any circle around ``centres``, the edge included, on the plane of ``everything``.

    Centres are dealt to the 9 cells around their own, points to one; what is left is a semi join by cell with an exact test.
    """
    mean = everything.agg(F.avg("latitude").alias("mean_lat"))

    def on_plane(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(mean)).select(key, (F.col("longitude") * (F.cos(F.radians("mean_lat")) * M_PER_DEG)).alias("x"), (F.col("latitude") * M_PER_DEG).alias("y"))

    around = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    c = on_plane(centres).select(F.col("x").alias("xc"), F.col("y").alias("yc")).distinct().withColumn("i", F.explode(around)).withColumn("j", F.explode(around))
    c = c.select("xc", "yc", (F.floor(F.col("xc") / radius_m) + F.col("i")).alias("cx"), (F.floor(F.col("yc") / radius_m) + F.col("j")).alias("cy"))
    p = on_plane(points).withColumns({"cx": F.floor(F.col("x") / radius_m), "cy": F.floor(F.col("y") / radius_m)})
    near = (p["cx"] == c["cx"]) & (p["cy"] == c["cy"]) & (F.pow(F.col("x") - F.col("xc"), 2) + F.pow(F.col("y") - F.col("yc"), 2) <= radius_m * radius_m)
    return p.join(c, near, "left_semi").select(key)


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point from a segment, which may be a point."""
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.hypot(px - x1 - t * dx, py - y1 - t * dy)


def first_class(digits: int | None) -> tuple[Column, Column]:
    """The least ``m``, and the first class of those at it, or of those that are equal to it when rounded to ``digits``."""
    m = F.col("m") if digits is None else F.round("m", digits)
    return F.min("m").alias("metres"), F.min(F.struct(m.alias("m"), "cls")).alias("best")


def nearest_segment(points: DataFrame, segments: DataFrame, reach: float, key: str = "id", digits: int | None = None) -> DataFrame:
    """Nearest segment ``(x1, y1, x2, y2, cls)`` within ``reach`` of each point ``(id, x, y)``, its class, and its distance; null beyond.

    Segments are dealt to every cell of side ``reach`` that their box, widened by ``reach``, touches; a point looks in its own cell.
    """
    lo = lambda a, b: F.floor((F.least(a, b) - reach) / reach)
    hi = lambda a, b: F.floor((F.greatest(a, b) + reach) / reach)
    dealt = segments.withColumn("cx", F.explode(F.sequence(lo(F.col("x1"), F.col("x2")), hi(F.col("x1"), F.col("x2"))))).withColumn("cy", F.explode(F.sequence(lo(F.col("y1"), F.col("y2")), hi(F.col("y1"), F.col("y2")))))
    p = points.select(key, F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("x") / reach).alias("cx"), F.floor(F.col("y") / reach).alias("cy"))
    d = segment_distance(*[F.col(c) for c in ("px", "py", "x1", "y1", "x2", "y2")])
    best = p.join(dealt, ["cx", "cy"]).withColumn("m", d).where(F.col("m") <= reach).groupBy(key).agg(*first_class(digits))
    return points.select(key).join(best, key, "left").select(key, "metres", F.col("best.cls").alias("cls"))


def road_segments(lines: DataFrame, key: str, order: str, x: str = "x", y: str = "y") -> DataFrame:
    """Consecutive vertices of each polyline."""
    w = Window.partitionBy(key).orderBy(order)
    nxt = lines.withColumn("x2", F.lead(x).over(w)).withColumn("y2", F.lead(y).over(w)).where("x2 is not null")
    return nxt.select(key, F.col(x).alias("x1"), F.col(y).alias("y1"), "x2", "y2")


def shared_edges(polygons: DataFrame, ring: str = "ring") -> DataFrame:
    """Undirected edges with how many polygons have them: 1 is an outer boundary, 2 a shared one."""
    e = polygons.select("adm_id", "kabupaten", F.explode(edges(F.col(ring))).alias("e"))
    a, b = F.struct(F.col("e.a.x"), F.col("e.a.y")), F.struct(F.col("e.b.x"), F.col("e.b.y"))
    return e.select("adm_id", "kabupaten", F.least(a, b).alias("p"), F.greatest(a, b).alias("q")).groupBy("p", "q").agg(F.count(F.lit(1)).alias("uses"), F.countDistinct("kabupaten").alias("regencies"))


def nearest_pixels(points: DataFrame, by: list[str], segments: tuple[tuple[int, float, float, int, int], ...], step: float) -> DataFrame:
    """``(*by, segment, pixels, cells)``: the pixels nearest to a group's points over all segments, each once, as ``line:column`` in order.

    A segment is ``(number, lon0, lat0, columns, lines)`` of a regular grid; its nearest pixel is found by rounding, and the nearest of
    them by squared degrees, the first segment of several. The work is points x segments, never points x pixels.
    """

    def best(v: str, origin: float, n: int) -> Column:
        return F.least(F.greatest(F.ceil((F.col(v) - origin) / step - 0.5), F.lit(0)), F.lit(n - 1)).cast("int")

    def candidate(number: int, lon0: float, lat0: float, nx: int, ny: int) -> Column:
        px, py = best("longitude", lon0, nx), best("latitude", lat0, ny)
        d2 = F.pow(F.lit(lon0) + px * step - F.col("longitude"), 2) + F.pow(F.lit(lat0) + py * step - F.col("latitude"), 2)
        return F.struct(d2.alias("d2"), F.lit(number).alias("segment"), py.alias("py"), px.alias("px"))

    p = points.select(*by, "longitude", "latitude").distinct().withColumn("c", F.array_min(F.array(*[candidate(*s) for s in segments])))
    cells = p.select(*by, "c.segment", "c.py", "c.px").distinct()
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("py", "px"))), lambda x: F.concat_ws(":", x["py"].cast("string"), x["px"].cast("string"))), " ")
    return cells.groupBy(*by, "segment").agg(F.count(F.lit(1)).alias("pixels"), listed.alias("cells"))


def painted_overlap(shapes: DataFrame, key: str, step: tuple[float, float], size: tuple[int, int], tolerance: float) -> DataFrame:
    """Rings ``one`` and ``two`` painted on the grid from ``(x0, y0)`` by cell centres: cells of each and of both, their IoU, the plain
    ratio of their areas, and whether the IoU lies above or below it by more than ``tolerance``. A shape without cells gives nulls."""
    i, j = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in size)
    g = shapes.withColumn("i", i).withColumn("j", j).withColumn("x", F.col("x0") + (F.col("i") + 0.5) * step[0]).withColumn("y", F.col("y0") + (F.col("j") + 0.5) * step[1])
    m = g.select(key, covers(F.col("one"), F.col("x"), F.col("y")).alias("p"), covers(F.col("two"), F.col("x"), F.col("y")).alias("q"))
    c = m.groupBy(key).agg(F.count_if("p").alias("a"), F.count_if("q").alias("b"), F.count_if(F.col("p") & F.col("q")).alias("shared"))
    iou, plain = F.try_divide("shared", F.col("a") + F.col("b") - F.col("shared")), F.try_divide("a", "b")
    verdict = F.when(iou - plain > tolerance, "above").when(iou - plain < -tolerance, "below").when(iou.isNotNull() & plain.isNotNull(), "ties")
    return c.select(key, "a", "b", "shared", F.round(iou, 8).alias("iou"), F.round(plain, 8).alias("plain"), verdict.alias("verdict"))


def edge_rows(polygons: DataFrame, ring: str = "ring") -> DataFrame:
    """Undirected edges of all rings with the polygons' columns."""
    e = polygons.withColumn("__e", F.explode(edges(F.col(ring)))).drop(ring)
    a, b = F.struct(F.col("__e.a.x").alias("x"), F.col("__e.a.y").alias("y")), F.struct(F.col("__e.b.x").alias("x"), F.col("__e.b.y").alias("y"))
    return e.withColumn("p", F.least(a, b)).withColumn("q", F.greatest(a, b)).drop("__e")


def boundary_levels(polygons: DataFrame, levels: list[str], ring: str = "ring") -> DataFrame:
    """``(p, q, uses, level)``: each edge once, at the highest of ``levels`` (highest first) that it bounds.

    An edge of one polygon bounds the highest level; one of several bounds the first level whose names differ there, so a lower level's
    lines are what is left of them once those above are subtracted. Edges that equal ones of the same name everywhere are the lowest level's.
    """
    g = edge_rows(polygons, ring).groupBy("p", "q").agg(F.count(F.lit(1)).alias("uses"), *[(F.min(c) != F.max(c)).alias(f"__{c}") for c in levels])
    level = F.when((F.col("uses") == 1) | F.col(f"__{levels[0]}"), levels[0])
    for c in levels[1:-1]:
        level = level.when(F.col(f"__{c}"), c)
    return g.select("p", "q", "uses", level.otherwise(levels[-1]).alias("level"))


def dissolved(polygons: DataFrame, key: str, ring: str = "ring") -> DataFrame:
    """``(key, area, outline)``: polygons of one name as one: the sum of their areas, as they don't overlap, and the length of the edges that only one of them has."""
    area = polygons.groupBy(key).agg(F.sum(ring_area(F.col(ring))).alias("area"))
    e = edge_rows(polygons, ring).groupBy(key, "p", "q").agg(F.count(F.lit(1)).alias("uses")).where("uses = 1")
    outline = e.groupBy(key).agg(F.sum(F.hypot(F.col("q.x") - F.col("p.x"), F.col("q.y") - F.col("p.y"))).alias("outline"))
    return area.join(outline, key, "left")
