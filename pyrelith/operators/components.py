"""Connected components of an edge table by repeated contraction, all on executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.runtime import Scratch


#: Up to so many different edges (16 bytes each) one task joins them in memory.
FEW_EDGES = 200_000


def smallest_reached(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest that each reaches: roots of both ends are joined and pointers followed until no edge joins two."""
    nodes, at = np.unique(np.concatenate([hi, lo]), return_inverse=True)
    a, b = at[: hi.size], at[hi.size :]
    root = np.arange(nodes.size)
    while a.size:
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return nodes, nodes[root]


def joined_in_memory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The components of all edges of a task."""
    held = [(t["hi"].to_numpy(), t["lo"].to_numpy()) for t in batches]
    if held:
        nodes, found = smallest_reached(*(np.concatenate(c) for c in zip(*held, strict=True)))
        yield pd.DataFrame({"node": nodes, "component": found})


#: A task that joins the edges of a region gives out what it has found at so many edges.
MOST_EDGES = 200_000


def components_by_region(edges: DataFrame, region: list, scratch: Scratch, rounds: Callable[[DataFrame, Scratch], DataFrame]) -> DataFrame:
    """``(node, component)`` as ``connected_components`` has it, for edges ``(a, b, ...)`` whose components mostly lie in one ``region`` (columns).

    The edges of a region are joined where they are. A node that was found in one region only is settled there; one that was found
    in several links their smallest nodes, and only these links, few if regions are wide, are joined by ``rounds`` (``connected_components``).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for t in batches:
            held.append(t)
            rows += len(t)
            if rows >= MOST_EDGES:
                yield from joined_in_memory(iter(held))
                held, rows = [], 0
        yield from joined_in_memory(iter(held))

    e = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"), F.xxhash64(*region).alias("region")).repartition("region").sortWithinPartitions("region")
    parts = scratch.table(e.select("hi", "lo").mapInPandas(run, "node long, component long"), "parts")
    nodes = parts.groupBy("node").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    nodes = scratch.table(nodes, "nodes")
    several = nodes.where("least <> most").select("node", "least")
    tops = rounds(parts.join(several, "node").where("component <> least").select(F.col("component").alias("a"), F.col("least").alias("b")), scratch)
    tops = tops.where("node <> component").select(F.col("node").alias("least"), F.col("component").alias("top"))
    return nodes.join(tops, "least", "left").select("node", F.coalesce("top", "least").alias("component"))


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b", few: int = FEW_EDGES) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; component is the smallest node reachable.

    Each round points every node at its smallest neighbour, follows the pointers to their roots, and
    replaces both ends of each edge by the roots. A pointer never goes up, so there are no cycles, and
    each round at least halves the nodes that still have an edge. Minima are combined before the
    shuffle, so a node with very many edges costs one row for each task. Loops, repeated and reversed
    edges and edges with a null end are allowed; the latter are ignored. No edges give no rows. Up to ``few``
    edges, counted, one task does the same in memory, which spares the rounds' jobs.
    """
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    e = scratch.table(e, "edges0")
    if e.count() <= few:
        return e.coalesce(1).mapInPandas(joined_in_memory, "node long, component long")
    loops = e.where("hi = lo").select(F.col("hi").alias("node"), F.col("hi").alias("component"))
    live = e.where("hi <> lo")
    assigned, k = None, 0
    while not live.isEmpty():
        ends = live.select(F.col("hi").alias("node"), F.col("lo").alias("to")).unionByName(live.select(F.col("lo").alias("node"), F.col("hi").alias("to")))
        parent = scratch.table(ends.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("node", "m").alias("root")), f"parent{k}.0")
        jump = 0
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            step = parent.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"), (F.col("higher") < F.col("root")).alias("moved"))
            jump += 1
            step = scratch.table(step, f"parent{k}.{jump}")
            scratch.drop(f"parent{k}.{jump - 1}")
            parent = step.select("node", "root")
            if step.where("moved").isEmpty():
                break
        if assigned is None:
            new = parent.select("node", F.col("root").alias("component"))
        else:
            new = assigned.join(parent.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        assigned = scratch.table(new, f"assigned{k}")
        hi, lo = (parent.select(F.col("node").alias(c), F.col("root").alias(f"{c}2")) for c in ("hi", "lo"))
        live = live.join(hi, "hi").join(lo, "lo").select(F.greatest("hi2", "lo2").alias("hi"), F.least("hi2", "lo2").alias("lo")).where("hi <> lo").distinct()
        live = scratch.table(live, f"live{k}")
        k += 1
    if assigned is None:
        return loops
    return assigned.unionByName(loops.join(assigned, "node", "left_anti"))
