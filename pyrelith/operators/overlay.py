"""Areas of overlays: which layers cover which area, by a sweep over vertical strips that are folded in parallel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrelith.runtime import Scratch

#: Columns of a group's width that its edges' ends are counted in, and how many ends a strip is to have.
COLUMNS, STRIP_ENDS = 1024, 256
#: Up to so many edges that change places, all pairs are compared; above, their slab is halved first.
FEW = 512


def leftmost_first(edges: DataFrame, by: list[str]) -> DataFrame:
    """The edges that aren't upright as ``(*by, layer, shape, xa, ya, xb, yb)`` from left to right."""
    return edges.where("x1 <> x2").select(*by, "layer", "shape", *[F.when(F.col("x1") < F.col("x2"), F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("x1", "x2", "xa"), ("y1", "y2", "ya"), ("x2", "x1", "xb"), ("y2", "y1", "yb"))])


def strips(e: DataFrame, by: list[str]) -> DataFrame:
    """The edges, from left to right, cut at the borders of their group's strips, with ``strip``; narrow strips where many edges end.

    A group's width is divided into ``COLUMNS`` equal columns; the ends of edges are counted by column, and a strip
    gathers columns until it has ``STRIP_ENDS`` of them. So the strips' table has at most that many rows a group.
    """
    scratch = Scratch(e.sparkSession, "strips")
    extent = e.groupBy(*by).agg(F.min("xa").alias("lo"), F.max("xb").alias("hi"))
    column = lambda x: F.least(F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * COLUMNS), F.lit(COLUMNS - 1)).cast("int")
    ends = e.join(extent, by).select(*by, "lo", "hi", F.explode(F.array(column(F.col("xa")), column(F.col("xb")))).alias("column"))
    ends = ends.groupBy(*by, "lo", "hi", "column").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*by).orderBy("column").rowsBetween(Window.unboundedPreceding, -1)
    cut = ends.withColumn("strip", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / STRIP_ENDS))
    cut = scratch.table(cut.withColumn("strip", F.dense_rank().over(Window.partitionBy(*by).orderBy("strip"))), "columns")
    border = F.when(F.col("from") == 0, F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("from") / COLUMNS)
    borders = cut.groupBy(*by, "lo", "hi", "strip").agg(F.min("column").alias("from")).select(*by, "strip", "hi", border.alias("west"))
    borders = borders.select(*by, "strip", "west", F.coalesce(F.lead("west").over(Window.partitionBy(*by).orderBy("strip")), "hi").alias("east"))
    # an end's column names its strip; what rounding may shift is looked up in the strips beside it too
    sides = [cut.select(*by, F.col("column").alias(f"at_{c}"), F.col("strip").alias(f"of_{c}")) for c in ("xa", "xb")]
    c = e.join(extent, by).select(*e.columns, *[column(F.col(c)).alias(f"at_{c}") for c in ("xa", "xb")]).join(sides[0], [*by, "at_xa"]).join(sides[1], [*by, "at_xb"])
    c = c.withColumn("strip", F.explode(F.sequence(F.col("of_xa") - 1, F.col("of_xb") + 1))).join(scratch.table(borders, "borders"), [*by, "strip"]).where("east > xa and west < xb")
    c = c.withColumn("l", F.greatest("xa", "west")).withColumn("r", F.least("xb", "east"))
    y = lambda x: F.when(x == F.col("xa"), F.col("ya")).when(x == F.col("xb"), F.col("yb")).otherwise(F.col("ya") + (F.col("yb") - F.col("ya")) * ((x - F.col("xa")) / (F.col("xb") - F.col("xa"))))
    return c.select(*by, "strip", "layer", "shape", F.col("l").alias("xa"), y(F.col("l")).alias("ya"), F.col("r").alias("xb"), y(F.col("r")).alias("yb"))


def heights(edges: np.ndarray, x: np.ndarray | float) -> np.ndarray:
    xa, ya, xb, yb = edges.T
    return ya + (yb - ya) * ((x - xa) / (xb - xa))


def runs(*keys: np.ndarray) -> np.ndarray:
    """Of rows sorted by ``keys``, whether each begins a new run of equal ones; nulls are equal."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for k in keys:
        a, b = k[1:], k[:-1]
        new[1:] |= (a != b) & ~(pd.isna(a) & pd.isna(b))
    return new


def slabs(edges: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(edge, slab, lo, hi)``: every edge once for each slab between neighbouring ends of its group that it spans; slabs of all groups have numbers of their own."""
    n = len(edges)
    x, g = np.concatenate([edges[:, 0], edges[:, 2]]), np.concatenate([group, group])
    order = np.lexsort((x, g))
    new = runs(g[order], x[order])
    place = np.empty(2 * n, dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    at = x[order][new]
    count = place[n:] - place[:n]
    edge = np.repeat(np.arange(n), count)
    slab = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - place[:n], count)
    return edge, slab, at[slab], at[slab + 1]


def steps(slab: np.ndarray, layers: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Of edges sorted from below in their slabs: 1 if crossing it enters its shape (the shape's first, third, ... edge there), -1 if it leaves."""
    own = np.lexsort((np.arange(len(slab)), shapes, layers, slab))
    new = runs(slab[own], layers[own], shapes[own])
    begin = np.flatnonzero(new)
    nth = np.empty(len(slab), dtype=np.int64)
    nth[own] = np.arange(len(slab)) - np.repeat(begin, np.diff(np.append(begin, len(slab))))
    return np.where(nth % 2 == 0, 1, -1)


def cut_at_crossings(edges: np.ndarray, layers: np.ndarray, shapes: np.ndarray, edge: np.ndarray, slab: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The slabs cut so that no two edges cross in one: first apart where nothing is covered from side to side, then at the crossings.

    Sorted from below at the left side, edges fall into blocks that stay above one another up to the right side; only edges of one block cross, so
    a slab of many small shapes costs about its edges, not their square. Crossings closer than rounding are one cut.
    """
    if not len(edge):
        return edge, slab, lo, hi
    l, r = heights(edges[edge], lo), heights(edges[edge], hi)
    order = np.lexsort((r, l, slab))
    edge, slab, lo, hi, l, r = edge[order], slab[order], lo[order], hi[order], l[order], r[order]
    n = len(edge)
    rank = np.empty(n, dtype=np.int64)
    rank[np.lexsort((r, slab))] = np.arange(n)
    closed = np.maximum.accumulate(rank) == np.arange(n)
    free = closed & (np.cumsum(steps(slab, layers[edge], shapes[edge])) == 0) | np.append(slab[1:] != slab[:-1], True)
    slab = np.cumsum(free) - free
    block = np.cumsum(closed) - closed
    crowded = (np.bincount(block)[block] > FEW) & (hi - lo > 1e-9 * np.maximum(np.maximum(np.abs(lo), np.abs(hi)), 1e-300))
    if crowded.any():
        halved = np.isin(slab, slab[crowded])
        e, k, a, b = edge[halved], slab[halved], lo[halved], hi[halved]
        done = [cut_at_crossings(edges, layers, shapes, np.concatenate([e, e]), np.concatenate([2 * k, 2 * k + 1]), np.concatenate([a, (a + b) / 2]), np.concatenate([(a + b) / 2, b]))]
        if not halved.all():
            e, k, a, b = cut_at_crossings(edges, layers, shapes, edge[~halved], slab[~halved], lo[~halved], hi[~halved])
            done.append((e, k + done[0][1].max() + 1, a, b))
        return tuple(np.concatenate(c) for c in zip(*done, strict=True))
    x, of = [], []
    p = np.flatnonzero(block[1:] == block[:-1])
    d = 1
    while p.size:
        i, j = p, p + d
        cross = (l[i] < l[j]) & (r[i] > r[j])
        i, j = i[cross], j[cross]
        x.append(lo[i] + (l[j] - l[i]) / ((l[j] - l[i]) + (r[i] - r[j])) * (hi[i] - lo[i]))
        of.append(slab[i])
        d += 1
        p = p[p + d < n]
        p = p[block[p + d] == block[p]]
    if not x or not sum(map(len, x)):
        return edge, slab, lo, hi
    x, of = np.concatenate(x), np.concatenate(of)
    sort = np.lexsort((x, of))
    x, of = x[sort], of[sort]
    first, m = np.searchsorted(slab, np.arange(slab[-1] + 1)), np.bincount(slab)
    new = runs(of)
    new[1:] |= np.diff(x) > 1e-13 * np.maximum(np.abs(x[1:]), np.abs(x[:-1]))
    x, of = x[new], of[new]
    inside = (x > lo[first[of]]) & (x < hi[first[of]])
    x, of = x[inside], of[inside]
    # every edge once for each part of its slab, from cut to cut
    parts = np.bincount(of, minlength=len(m)) + 1
    west, east = np.insert(x, np.cumsum(parts - 1) - (parts - 1), lo[first]), np.insert(x, np.cumsum(parts - 1), hi[first])
    begin = np.cumsum(parts) - parts
    count = parts[slab]
    again = np.repeat(np.arange(n), count)
    part = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[slab[again]]
    return edge[again], part, west[part], east[part]


def sweep_groups(edges: np.ndarray, layers: np.ndarray, shapes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(group, mask, area)`` of edges ``(xa, ya, xb, yb)`` of several groups at once: slabs between all ends and crossings, in each of them the edges from below.

    Crossing an edge leaves or enters its shape (``shapes`` are whole numbers); a layer covers what lies in any of its shapes. Within a slab no two
    edges cross, so the height between neighbours at its middle times its width is the area.
    """
    edge, slab, lo, hi = cut_at_crossings(edges, layers, shapes, *slabs(edges, group))
    y = heights(edges[edge], (lo + hi) / 2)
    order = np.lexsort((y, slab))
    edge, slab, width, y = edge[order], slab[order], (hi - lo)[order], y[order]
    step = steps(slab, layers[edge], shapes[edge])
    mask = np.zeros(len(edge), dtype=np.int64)
    for layer in np.unique(layers).tolist():
        # every shape is left again at the top of a slab, so a layer's sum begins at zero in each
        mask |= np.where(np.cumsum(np.where(layers[edge] == layer, step, 0)) > 0, layer, 0)
    held = np.flatnonzero((mask[:-1] != 0) & (slab[1:] == slab[:-1]))
    area, g, m = (y[held + 1] - y[held]) * width[held], group[edge[held]], mask[held]
    order = np.lexsort((m, g))
    g, m = g[order], m[order]
    begin = np.flatnonzero(runs(g, m)) if len(g) else np.zeros(0, dtype=np.int64)
    return g[begin], m[begin], np.add.reduceat(area[order], begin) if len(begin) else np.zeros(0)


def sweep(edges: np.ndarray, layers: np.ndarray, shapes: np.ndarray) -> dict[int, float]:
    """``{mask: area}`` of one group's edges."""
    _, masks, areas = sweep_groups(edges, layers, shapes, np.zeros(len(edges), dtype=np.int64))
    return dict(zip(masks.tolist(), areas.tolist(), strict=True))


#: A group of so many edges is one strip, whatever its width.
ONE_STRIP = STRIP_ENDS // 2


def coverage(edges: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, mask, area)``: of each group the area that just the layers in ``mask`` cover.

    ``edges`` has ``(*by, layer, shape, x1, y1, x2, y2)``; a layer is a power of two and the union of its shapes, which may
    overlap; a shape is what an odd number of its edges lie below. Union, intersection and differences of layers are sums over masks:
    the union all of them, both of 1 and 2 the mask 3 and those that hold it. Groups of few edges are swept whole, many of them at once; the strips
    of the others in parallel, a strip in one task.
    """
    scratch = Scratch(edges.sparkSession, "coverage")
    fields = {f.name: f.dataType for f in edges.schema.fields}
    schema = T.StructType([T.StructField(c, fields[c]) for c in by] + [T.StructField("mask", T.LongType()), T.StructField("area", T.DoubleType())])

    def folded(keys: list[str]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for d in whole_groups(batches, keys):
                new = runs(*[d[c].to_numpy() for c in keys])
                group = np.cumsum(new) - 1
                g, masks, areas = sweep_groups(d[["xa", "ya", "xb", "yb"]].to_numpy(dtype=float), d["layer"].to_numpy(), pd.factorize(d["shape"])[0], group)
                out = d[by].iloc[np.flatnonzero(new)[g]].reset_index(drop=True)
                yield out.assign(mask=masks, area=areas)

        return run

    e = scratch.table(leftmost_first(edges, by), "edges")
    sizes = scratch.table(e.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")), "sizes")
    same = lambda t: [e[c].eqNullSafe(t[c]) for c in by]
    few, many = sizes.where(F.col("__n") <= ONE_STRIP), sizes.where(F.col("__n") > ONE_STRIP)
    whole = e.join(few, same(few), "left_semi").repartition(*by).sortWithinPartitions(*by).mapInPandas(folded(by), schema)
    if many.isEmpty():
        return whole
    parts = strips(e.join(many, same(many), "left_semi"), by).repartition(*by, "strip").sortWithinPartitions(*by, "strip").mapInPandas(folded([*by, "strip"]), schema)
    return whole.unionByName(parts.groupBy(*by, "mask").agg(F.sum("area").alias("area")))


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches, cut again so that no group of equal keys is in two of them."""
    held: list[pd.DataFrame] = []
    for b in batches:
        while len(b):
            edge = pd.concat([held[-1].iloc[-1:], b]) if held else b
            starts = np.flatnonzero(runs(*[edge[c].to_numpy() for c in keys])[1:]) + (0 if held else 1)
            if not starts.size:
                held.append(b)
                break
            # all but the batch's last group is whole
            cut = int(starts[-1])
            yield pd.concat([*held, b.iloc[:cut]], ignore_index=True)
            held, b = [], b.iloc[cut:]
    if held:
        yield pd.concat(held, ignore_index=True)


def union_areas(edges: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, area)`` of what any of a group's shapes covers, overlaps counted once."""
    return coverage(edges.withColumn("layer", F.lit(1)), by).groupBy(*by).agg(F.sum("area").alias("area"))
