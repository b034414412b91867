"""Nearest segment or box without a reach: a pyramid of cells, descended by all points at once."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrelith.operators.geo import first_class, nearest_segment, segment_distance
from pyrelith.runtime import Scratch

#: Cells of one level that make a cell of the next, along each axis.
FACTOR = 4
#: By how much a bound is relaxed for the rounding of cell sides.
SLACK = 1 + 1e-9


def touched_cells(segments: DataFrame, size: float) -> DataFrame:
    """The segments with each cell of side ``size`` that they touch, column by column, so that a long one meets as many as its length."""
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    c = segments.withColumn("cx", F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size))))
    slope = F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    at = lambda x: F.coalesce(F.col("y1") + (F.least(F.greatest(x, lo), hi) - F.col("x1")) * slope, F.col("y1"))
    ya, yb = at(F.col("cx") * size), F.when(slope.isNull(), F.col("y2")).otherwise(at((F.col("cx") + 1) * size))
    return c.withColumn("cy", F.explode(F.sequence(F.floor(F.least(ya, yb) / size), F.floor(F.greatest(ya, yb) / size))))


def to_box(side: Column) -> tuple[Column, Column]:
    """Least and greatest distance of (px, py) from a square at (cx, cy): within the two lies the distance of anything that touches it."""
    x0, y0 = F.col("cx") * side, F.col("cy") * side
    out = lambda p, a: F.greatest(a - p, p - a - side, F.lit(0.0))
    far = lambda p, a: F.greatest(F.abs(p - a), F.abs(p - a - side))
    px, py = F.col("px"), F.col("py")
    return F.hypot(out(px, x0), out(py, y0)), F.hypot(far(px, x0), far(py, y0))


def nearest_anywhere(points: DataFrame, segments: DataFrame, size: float, key: str = "id", digits: int | None = None) -> DataFrame:
    """``(key, metres, cls)``: each point's nearest segment ``(x1, y1, x2, y2, cls)`` at any distance; null only if there is none.

    What lies within ``size`` is found in one join by cell (``geo.nearest_segment``). The points left are grouped by cells of that side and the groups
    descend a pyramid: its lowest level has the cells that segments touch, and each level joins ``FACTOR`` by ``FACTOR`` cells to one, up to
    a single one. From the top, every group keeps the children of its cells that may hold the nearest segment of any of its points: those no farther
    than the nearest child is at its farthest. Then it keeps the segments that may be nearest, by their distance from its middle, and only these are held against
    its points. Each level is written, so that none is computed again, and joined by equality of the parent cell. Segments on one another count once, with the
    smallest class. A degenerate segment is a point. Rows with a null or non-finite coordinate have a null result; equal distances go to the smaller class, and with ``digits``
    distances that are equal when rounded so, too.
    """
    scratch = Scratch(points.sparkSession, "nearest")
    fine = lambda *cs: reduce(Column.__and__, [F.col(c).isNotNull() & (F.abs(c) < float("inf")) for c in cs])
    segments = scratch.table(segments.where(fine("x1", "y1", "x2", "y2")).groupBy("x1", "y1", "x2", "y2").agg(F.min("cls").alias("cls")), "segments")
    near = scratch.table(nearest_segment(points.where(fine("x", "y")), segments, size, key, digits), "near")
    # at the very edge of the reach a segment beyond it may tie
    settled = F.col("metres").isNotNull() & (F.col("metres") * SLACK < size)
    left = points.join(near.where(~settled).select(key), key, "left_semi").select(key, F.col("x").alias("px"), F.col("y").alias("py"))
    base = scratch.table(touched_cells(segments, size), "base")
    extent = base.agg(*[f(c).alias(f"{n}_{c}") for c in ("cx", "cy") for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if left.isEmpty() or extent.lo_cx is None:
        return points.select(key).join(near, key, "left")
    left = scratch.table(left.withColumns({"gx": F.floor(F.col("px") / size), "gy": F.floor(F.col("py") / size)}), "left")
    # counted from the lowest cell, all of them lie in one cell of the level that spans the larger side
    width = max(extent.hi_cx - extent.lo_cx, extent.hi_cy - extent.lo_cy) + 1
    levels = max(1, math.ceil(math.log(width, FACTOR) - 1e-12))
    cells = base.select((F.col("cx") - extent.lo_cx).alias("cx"), (F.col("cy") - extent.lo_cy).alias("cy")).distinct()
    pyramid = [scratch.table(cells, "cells0")]
    for k in range(1, levels):
        pyramid.append(scratch.table(pyramid[-1].select(F.floor(F.col("cx") / FACTOR).alias("cx"), F.floor(F.col("cy") / FACTOR).alias("cy")).distinct(), f"cells{k}"))
    x, y = F.lit(extent.lo_cx * size), F.lit(extent.lo_cy * size)
    box = left.groupBy("gx", "gy").agg(*[f(c).alias(f"{n}_{c}") for c in ("px", "py") for n, f in (("lo", F.min), ("hi", F.max))])
    mid = lambda c: (F.col(f"lo_{c}") + F.col(f"hi_{c}")) / 2
    # no point of a group is farther than this from its middle
    half = (F.hypot(F.col("hi_px") - F.col("lo_px"), F.col("hi_py") - F.col("lo_py")) / 2 + 1e-12 * F.greatest(F.abs(mid("px")), F.abs(mid("py")))) * SLACK
    group = ["gx", "gy"]
    kept = box.select(*group, (mid("px") - x).alias("px"), (mid("py") - y).alias("py"), half.alias("half"), F.lit(0).cast("long").alias("ux"), F.lit(0).cast("long").alias("uy"), F.lit(float("inf")).alias("bound"))
    for k in range(levels - 1, -1, -1):
        parent = F.floor(F.col("cx") / FACTOR).alias("ux"), F.floor(F.col("cy") / FACTOR).alias("uy")
        least, most = to_box(F.lit(size * FACTOR**k))
        level = pyramid[k].select("cx", "cy", *parent)
        found = scratch.table(kept.join(level, ["ux", "uy"]).select(*group, "px", "py", "half", "cx", "cy", "bound", (least - F.col("half")).alias("least"), (most + F.col("half")).alias("most")), f"found{k}")
        bounds = found.groupBy(*group).agg((F.least(F.min("most"), F.min("bound")) * SLACK).alias("bound"))
        kept = found.drop("bound", "most").join(bounds, group).where("least <= bound").select(*group, "px", "py", "half", F.col("cx").alias("ux"), F.col("cy").alias("uy"), "bound")
    ends = ["x1", "y1", "x2", "y2"]
    s = base.select((F.col("cx") - extent.lo_cx).alias("ux"), (F.col("cy") - extent.lo_cy).alias("uy"), *ends, "cls")
    m = segment_distance(F.col("px") + x, F.col("py") + y, *[F.col(c) for c in ends])
    # a segment comes from every cell that it touches
    held = scratch.table(kept, "kept").join(s, ["ux", "uy"]).select(*group, "half", *ends, "cls", m.alias("m"))
    nearest = held.groupBy(*group).agg((F.min(F.col("m") + F.col("half")) * SLACK).alias("bound"))
    held = scratch.table(held.join(nearest, group).where(F.col("m") - F.col("half") <= F.col("bound")).select(*group, *ends, "cls").distinct(), "held")
    d = segment_distance(*[F.col(c) for c in ("px", "py", *ends)])
    far = left.join(held, group).withColumn("m", d).groupBy(key).agg(*first_class(digits)).select(key, F.col("metres"), F.col("best.cls").alias("cls"))
    return points.select(key).join(near.where(settled).unionByName(far), key, "left")
