"""Polygons with parts and holes, their relations and overlay areas, against fine grids and brute force."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pyrelith.operators import overlay, polygons


def feature(i, parts):
    kind, c = ("Polygon", parts[0]) if len(parts) == 1 else ("MultiPolygon", parts)
    return json.dumps({"type": "Feature", "properties": {"id": i}, "geometry": {"type": kind, "coordinates": c}})


def box(w, s, e, n):
    return [[w, s], [e, s], [e, n], [w, n], [w, s]]


#: An island inside the hole of a frame, a notched ring, a triangle, and what has no polygon.
SHAPES = {1: [[box(0, 0, 10, 10), box(2, 2, 8, 8)], [box(4, 4, 6, 6)]], 2: [[[[10, 0], [14, 0], [14, 4], [12, 4], [12, 8], [10, 8]]]], 3: [[[[3, 3], [7, 3], [5, 9]]]], 4: [[box(4, 4, 6, 6)]], 5: [[box(2, 2, 8, 8)]], 6: [[box(10, 10, 12, 12)]], 7: [[box(30, 30, 31, 31)]]}


def frame(spark, shapes=SHAPES):
    rows = [(feature(i, p),) for i, p in shapes.items()]
    s = polygons.parse_shapes(spark.createDataFrame(rows, "value string"))
    return s.withColumn("id", F.get_json_object("properties", "$.id").cast("int"))


def inside(parts, x, y):
    odd = False
    for ring in (r for p in parts for r in p):
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def test_features_of_every_kind_stay(spark):
    odd = ['{"geometry": null, "properties": {"id": 8}}', "no json", None, '{"properties": {"id": 9}, "geometry": {"type": "Point", "coordinates": [1, 2]}}', '{"properties": {"id": 10}, "geometry": {"type": "MultiPolygon", "coordinates": []}}']
    s = polygons.parse_shapes(spark.createDataFrame([(x,) for x in odd], "value string")).collect()
    assert [r.kind for r in s] == [None, None, None, "Point", "MultiPolygon"] and all(r.parts == [] for r in s)
    assert {r.id: (r.parts, r.holes, r.area) for r in polygons.shape_areas(frame(spark), "id").collect()} == {1: (2, 1, 68.0), 2: (1, 0, 24.0), 3: (1, 0, 12.0), 4: (1, 0, 4.0), 5: (1, 0, 36.0), 6: (1, 0, 4.0), 7: (1, 0, 1.0)}
    assert polygons.edge_rows(frame(spark).where("id > 99"), "id").count() == 0


def test_points_in_holes_on_islands_and_on_boundaries(spark):
    rng = random.Random(1)
    pts = [(rng.uniform(-1, 15), rng.uniform(-1, 13)) for _ in range(400)] + [(5.0, 5.0), (3.0, 3.0), (2.0, 5.0), (10.0, 10.0), (4.0, 4.0), (0.0, 0.0), (11.0, 8.0), (12.0, 6.0)]
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "pid int, x double, y double")
    edges = polygons.edge_rows(frame(spark), "id")
    got = {(r.pid, r.id) for r in polygons.points_in_shapes(p, edges, "pid", "id", 3.0).collect()}
    sure = {(i, k) for i, (x, y) in enumerate(pts[:400]) for k, parts in SHAPES.items() if inside(parts, x, y)}
    assert {g for g in got if g[0] < 400} == sure
    assert {k for i, k in got if i == 401} == {3, 5} and {k for i, k in got if i == 402} == {1, 5}  # in the hole but for the triangle; on the hole's ring
    assert {k for i, k in got if i == 403} == {1, 6} and {k for i, k in got if i == 400} == {1, 3, 4, 5}
    strict = {(r.pid, r.id) for r in polygons.points_in_shapes(p, edges, "pid", "id", 3.0, boundary=False).collect()}
    assert {g for g in strict if g[0] < 400} == sure and not {k for i, k in strict if i in (403, 405)}


def test_relations(spark):
    got = {(r.a, r.b): (r.relation, round(r.shared, 9)) for r in polygons.relations(polygons.edge_rows(frame(spark), "id"), "id", 2.5).collect()}
    assert got[1, 4] == ("contains", 4.0) and got[4, 5] == ("within", 4.0) and got[1, 5] == ("overlaps", 4.0)
    assert got[1, 2] == ("touches", 0.0) and got[1, 6] == ("touches", 0.0) and (2, 6) not in got and not any(7 in k for k in got)
    assert got[3, 5][0] == "overlaps" and got[3, 4] == ("contains", 4.0)  # the box's upper corners lie on the triangle
    same = frame(spark).where("id = 1").select(F.explode(F.array(F.lit(1), F.lit(2))).alias("id"), "parts")
    assert [r.relation for r in polygons.relations(polygons.edge_rows(same, "id"), "id", 2.5).collect()] == ["equals"]
    hole = frame(spark, {1: [[box(0, 0, 10, 10), box(2, 2, 8, 8)]], 2: [[box(2, 2, 8, 8)]], 3: [[box(3, 3, 4, 4)]]})
    assert [(r.a, r.b, r.relation) for r in polygons.relations(polygons.edge_rows(hole, "id"), "id", 2.5).orderBy("a", "b").collect()] == [(1, 2, "touches"), (2, 3, "contains")]


def test_cells_that_share_area(spark):
    edges = polygons.edge_rows(frame(spark).where("id in (1, 3, 6)"), "id")
    got = {(r.cx, r.cy) for r in polygons.overlapped_cells(edges, "id", 1.0).collect()}
    want = set()
    for cx in range(-1, 16):
        for cy in range(-1, 14):
            if any(inside(SHAPES[k], cx + (i + 0.5) / 40, cy + (j + 0.5) / 40) for k in (1, 3, 6) for i in range(40) for j in range(40)):
                want.add((cx, cy))
    assert got == want


def star(rng, cx, cy, r):
    turns = sorted(rng.uniform(0, 2 * np.pi) for _ in range(rng.randrange(5, 14)))
    return [[cx + rng.uniform(0.2, 1) * r * float(np.cos(t)), cy + rng.uniform(0.2, 1) * r * float(np.sin(t))] for t in turns]


@pytest.mark.parametrize("seed", range(3))
def test_coverage_against_a_fine_grid(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(overlay, "STRIP_ENDS", 16)
    monkeypatch.setattr(overlay, "FEW", 6)
    shapes = [(k, 1 << k % 3, [star(rng, rng.uniform(0, 4), rng.uniform(0, 4), 1.5)]) for k in range(24)]
    rows = [(g, k, layer, x) for g in ("p", "q") for k, layer, x in shapes if g == "p" or k % 2]
    d = spark.createDataFrame([(g, k, layer, [x]) for g, k, layer, x in rows], "g string, shape int, layer int, parts array<array<array<array<double>>>>")
    e = polygons.edge_rows(d.select(F.struct("g", "layer", "shape").alias("k"), "parts"), "k").select("k.g", "k.layer", "k.shape", "x1", "y1", "x2", "y2")
    got = {(r.g, r.mask): r.area for r in overlay.coverage(e, ["g"]).collect()}
    n = 700
    xs = (np.arange(n) + 0.5) * 7 / n - 1.5
    gx, gy = np.meshgrid(xs, xs)
    for g in ("p", "q"):
        mask = np.zeros((n, n), dtype=int)
        for gg, _, layer, parts in rows:
            if gg != g:
                continue
            odd = np.zeros((n, n), dtype=bool)
            for ring in parts:
                for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
                    odd ^= ((ay > gy) != (by > gy)) & (gx < (bx - ax) * (gy - ay) / (by - ay if by != ay else 1) + ax)
            mask |= layer * odd
        for m in range(1, 8):
            assert got.get((g, m), 0.0) == pytest.approx((mask == m).sum() * (7 / n) ** 2, abs=0.03)


def test_coverage_is_exact_for_rectangles_and_shared_edges(spark):
    rng = random.Random(5)
    rects = [(k, w, s, w + rng.randrange(1, 6), s + rng.randrange(1, 6)) for k in range(60) for w, s in [(rng.randrange(20), rng.randrange(20))]]
    d = spark.createDataFrame([(k, [[[[float(w), float(s)], [float(e), float(s)], [float(e), float(n)], [float(w), float(n)]]]]) for k, w, s, e, n in rects], "shape int, parts array<array<array<array<double>>>>")
    e = polygons.edge_rows(d, "shape").select(F.lit(0).alias("g"), F.lit(1).alias("layer"), "shape", "x1", "y1", "x2", "y2")
    cells = {(x, y) for _, w, s, e_, n in rects for x in range(w, e_) for y in range(s, n)}
    assert [r.area for r in overlay.union_areas(e, ["g"]).collect()] == [pytest.approx(len(cells), abs=1e-9)]
    assert overlay.union_areas(e.limit(0), ["g"]).count() == 0
