"""Outlines from boundary edges: rings in order by list ranking, without a fold along the ring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.operators.components import connected_components
from pyrelith.runtime import Scratch


def patch_pixels(pixels: DataFrame, width: int) -> DataFrame:
    """Pixels ``(scene, x, y)`` with ``patch``, the smallest number (scene * width^2 + x * width + y) among those that touch by side or corner."""
    scratch = Scratch(pixels.sparkSession, "patch-pixels")
    p = scratch.table(pixels.select((F.col("scene") * width * width + F.col("x") * width + F.col("y")).cast("long").alias("id"), "scene", "x", "y").distinct(), "pixels")
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))])
    q = p.withColumn("s", F.explode(steps)).select(F.col("id").alias("a"), "scene", (F.col("x") + F.col("s.i")).alias("x"), (F.col("y") + F.col("s.j")).alias("y"))
    comp = connected_components(q.join(p, ["scene", "x", "y"]).select("a", F.col("id").alias("b")), scratch)
    return p.join(comp, p["id"] == comp["node"], "left").select(F.coalesce("component", "id").alias("patch"), "x", "y")


def pixel_edges(pixels: DataFrame, by: list[str]) -> DataFrame:
    """The sides ``(*by, x1, y1, x2, y2)`` of unit squares that no other square of the group shares, with the inside on their left."""
    corner = [(0, 0), (1, 0), (1, 1), (0, 1)]
    side = F.array(*[F.struct(*[(F.col(c) + k).alias(n) for c, k, n in (("x", a[0], "x1"), ("y", a[1], "y1"), ("x", b[0], "x2"), ("y", b[1], "y2"))]) for a, b in zip(corner, corner[1:] + corner[:1], strict=True)])
    return once_only(pixels.select(*by, F.explode(side).alias("e")).select(*by, "e.*"), by)


def once_only(edges: DataFrame, by: list[str]) -> DataFrame:
    """Directed edges of which the group has no other one between the same points: the boundary of what they enclose together."""
    a, b = (F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x1", "y1"), ("x2", "y2")))
    g = edges.groupBy(*by, F.least(a, b).alias("p"), F.greatest(a, b).alias("q")).agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("x1", "y1", "x2", "y2")).alias("e"))
    return g.where("n = 1").select(*by, "e.*")


def rings(edges: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, ring, seq, x1, y1, x2, y2, corner)``: directed edges in the order of their ring; ``corner`` says that the ring turns where the edge begins.

    Every edge goes on with the one that turns most to the right, so parts that meet in a point are one ring around both and holes
    that meet there stay two. Each edge then knows the smallest edge among the next 1, 2, 4, ... and how far ahead it is;
    doubling the reach is one join by edge, and when a round changes nothing every reach has been once around. That smallest
    edge names the ring, the way to it gives the place. A round is written, and as many are needed as the longest ring's
    length has binary digits. Where as many edges end as begin in every point, as on any boundary, all edges are in a ring.
    """
    scratch = Scratch(edges.sparkSession, "rings")
    e = scratch.table(edges.withColumn("id", F.monotonically_increasing_id()), "edges")
    came = e.select(*by, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("id").alias("from"), (F.col("x2") - F.col("x1")).alias("dx"), (F.col("y2") - F.col("y1")).alias("dy"))
    ux, uy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    turn = F.atan2(F.col("dx") * uy - F.col("dy") * ux, F.col("dx") * ux + F.col("dy") * uy)
    follows = came.join(e, [*by, "x1", "y1"]).groupBy("from").agg(F.min(F.struct(turn.alias("turn"), "id")).alias("n"))
    follows = scratch.table(follows.select("from", F.col("n.id").alias("id"), (F.col("n.turn") != 0).alias("corner")), "follows")
    reach = scratch.table(follows.select(F.col("from").alias("id"), F.col("id").alias("jump"), F.col("from").alias("low"), F.lit(0).cast("long").alias("at"), F.lit(True).alias("new")), "reach0")
    k = 0
    while not reach.where("new").isEmpty():
        ahead = reach.select(F.col("id").alias("jump"), F.col("jump").alias("jump2"), F.col("low").alias("low2"), F.col("at").alias("at2"))
        less = F.col("low2") < F.col("low")
        step = reach.join(ahead, "jump").select("id", F.col("jump2").alias("jump"), F.least("low", "low2").alias("low"), F.when(less, F.col("at2") + (1 << k)).otherwise(F.col("at")).alias("at"), less.alias("new"))
        k += 1
        reach = scratch.table(step, f"reach{k}")
        scratch.drop(f"reach{k - 1}")
    size = reach.groupBy("low").agg(F.count(F.lit(1)).alias("n"))
    placed = reach.join(size, "low").select("id", F.col("low").alias("ring"), F.when(F.col("at") == 0, 0).otherwise(F.col("n") - F.col("at")).alias("seq"))
    return e.join(placed, "id").join(follows.select("id", "corner"), "id").select(*by, "ring", "seq", "x1", "y1", "x2", "y2", "corner")


def ring_measures(ringed: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, ring, edges, corners, area, perimeter)``; the area is signed: outlines are positive, holes negative."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    return ringed.groupBy(*by, "ring").agg(F.count(F.lit(1)).alias("edges"), F.count_if("corner").alias("corners"), (F.sum(cross) / 2).alias("area"), F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("perimeter"))


def outlines(ringed: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, ring, hole, points)``: one row a ring with its corners in order, the first one not repeated."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    points = F.transform(F.sort_array(F.collect_list(F.when(F.col("corner"), F.struct("seq", "x1", "y1")))), lambda p: F.array(p["x1"], p["y1"]))
    return ringed.groupBy(*by, "ring").agg((F.sum(cross) < 0).alias("hole"), points.alias("points"))
