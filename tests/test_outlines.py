"""Outlines by list ranking: rings in order, holes, corners that meet in a point."""

import random

import pytest

from pyrelith.operators import outlines


def frame(spark, cells):
    return spark.createDataFrame([(g, x, y) for g, x, y in cells], "g int, x long, y long")


def check(rows, cells):
    by = {}
    for r in rows:
        by.setdefault(r.ring, []).append(r)
    area = 0
    for ring in by.values():
        ring.sort(key=lambda r: r.seq)
        assert [r.seq for r in ring] == list(range(len(ring)))
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            assert (a.x2, a.y2) == (b.x1, b.y1)
            assert b.corner == ((a.x2 - a.x1, a.y2 - a.y1) != (b.x2 - b.x1, b.y2 - b.y1))
        area += sum(r.x1 * r.y2 - r.x2 * r.y1 for r in ring) / 2
    assert area == len(cells)
    return len(by)


@pytest.mark.parametrize("seed", range(3))
def test_rings_of_random_pixels(spark, seed):
    rng = random.Random(seed)
    cells = {(rng.randrange(12), rng.randrange(12)) for _ in range(90)}
    rows = outlines.rings(outlines.pixel_edges(frame(spark, [(1, x, y) for x, y in cells]), ["g"]), ["g"]).collect()
    check(rows, cells)


def test_holes_corners_and_long_rings(spark):
    block = {(x, y) for x in range(5) for y in range(5)} - {(1, 1), (2, 2), (3, 3), (3, 1)}
    rows = outlines.rings(outlines.pixel_edges(frame(spark, [(1, x, y) for x, y in block]), ["g"]), ["g"])
    assert check(rows.collect(), block) == 5  # holes that meet in a point are holes each
    m = sorted((r.area, r.corners) for r in outlines.ring_measures(rows, ["g"]).collect())
    assert m == [(-1.0, 4)] * 4 + [(25.0, 4)]
    o = {(r.hole, len(r.points)) for r in outlines.outlines(rows, ["g"]).collect()}
    assert o == {(True, 4), (False, 4)}
    across = {(0, 0), (1, 1), (2, 0)}
    rows = outlines.rings(outlines.pixel_edges(frame(spark, [(1, x, y) for x, y in across]), ["g"]), ["g"]).collect()
    assert check(rows, across) == 1  # parts that meet in a point are one ring
    comb = {(x, 0) for x in range(61)} | {(x, y) for x in range(0, 61, 2) for y in range(1, 6)}
    two = frame(spark, [(1, x, y) for x, y in comb] + [(2, x, y) for x, y in across])
    rows = outlines.rings(outlines.pixel_edges(two, ["g"]), ["g"]).collect()
    assert check([r for r in rows if r.g == 1], comb) == 1 and check([r for r in rows if r.g == 2], across) == 1
    assert outlines.rings(outlines.pixel_edges(two.limit(0), ["g"]), ["g"]).count() == 0
