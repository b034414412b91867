"""Exact top-k search by inner product: M-trees of paged metric nodes, searched best first for many queries at once.

An inner product is no metric, so a vector x gets one more component, sqrt(M^2 - |x|^2) with M the largest
norm of all, and a query a zero: then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the nearest vectors are those with
the largest product. Distances only steer and prune, with a margin far above their rounding; the scores that
decide are exact integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.llm.ids import as_numbers, named
from pyrelith.runtime import Scratch

PAGE_SCHEMA = "shard int, page int, leaf boolean, keys binary, radii binary, to_parent binary, vectors binary"
#: Relative to the largest distance: what a bound must be exceeded by before a node is dropped.
MARGIN = 1e-7
EXACT = 2.0**53
#: Stands for no score and no id; scores are cut to what lies above and below.
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(vec_id, v)`` with integer components; vectors null or holding null or non-finite ones are left out, as are null ids."""
    fine = F.coalesce(F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    v = F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.where(fine & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def pivots(x: np.ndarray, k: int) -> np.ndarray:
    """Farthest-first: each next pivot is the point farthest from those chosen."""
    chosen = [0]
    near = distances(x, x[:1])[:, 0]
    while len(chosen) < k and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def build(ids: np.ndarray, v: np.ndarray, centre: np.ndarray, m2: float, fanout: int, leaf: int) -> list[tuple]:
    """Bulk load one shard: pages (number, is leaf, keys, radii, distances to the page's pivot, vectors).

    ``centre`` is the pivot of the root page. Keys are vector ids in a leaf and page numbers in an inner page; for
    each child an inner page has a pivot, the covering radius around it and the pivot's distance to the page's
    own pivot. Where pivots leave more than seven eighths of the points together, or can't tell points apart,
    points are dealt in turn by their distance to the first pivot, so that no tree gets deep.
    """
    x = v.astype(np.float64)
    full = np.hstack([x, np.sqrt(np.maximum(m2 - (x * x).sum(1), 0))[:, None]])
    pages: list[tuple | None] = []

    def node(at: np.ndarray, pivot: np.ndarray) -> int:
        number = len(pages)
        pages.append(None)
        if len(at) <= leaf:
            pages[number] = (number, True, ids[at], np.zeros(len(at)), distances(full[at], pivot[None])[:, 0], v[at])
            return number
        p = pivots(full[at], fanout)
        near = distances(full[at], full[at][p]).argmin(1)
        parts = [at[near == c] for c in range(len(p))]
        if 8 * max(map(len, parts)) > 7 * len(at):
            out = at[distances(full[at], full[at][:1])[:, 0].argsort(kind="stable")]
            parts = np.array_split(out, min(fanout, -(-len(at) // leaf)))
            heads = [part[0] for part in parts]
        else:
            heads = [at[c] for c, part in zip(p, parts, strict=True) if len(part)]
            parts = [part for part in parts if len(part)]
        radii = np.array([distances(full[part], full[h][None]).max() for h, part in zip(heads, parts, strict=True)])
        children = np.array([node(part, full[h]) for h, part in zip(heads, parts, strict=True)], dtype=np.int64)
        pages[number] = (number, False, children, radii, distances(full[heads], pivot[None])[:, 0], v[heads])
        return number

    node(np.arange(len(ids)), centre)
    return pages  # type: ignore[return-value]


class Tree:
    """The pages of one shard; ``opened`` counts the (page, query) pairs whose entries were compared."""

    def __init__(self, pages: list[tuple], centre: np.ndarray, m2: float):
        self.pages, self.centre, self.m2, self.opened = {p[0]: p for p in pages}, centre, m2, 0

    def search(self, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(scores, ids)``, a row a query: the k best by score, then id, of those whose score is ``floor`` at least; LOW where there are fewer.

        Pages wait in one queue, ordered by the least bound of the queries that may need them. An opened page is
        compared with all of these queries by one matrix product. A query leaves a page out by the page's bound, and
        a whole column of the product is left out if stored distances to the page's pivot rule it out for all queries.
        ``own`` holds each query's id, which is no candidate.
        """
        qf = q.astype(np.float64)
        q2 = (qf * qf).sum(1)
        reach = q2 + self.m2
        margin = MARGIN * (np.sqrt(q2) + np.sqrt(self.m2) + 1)
        exact = np.sqrt(q2.max(initial=0) * self.m2) * 2 < EXACT
        best, names = np.full((len(q), k), LOW), np.full((len(q), k), HIGH)
        worst = np.full(len(q), np.inf)
        if floor is not None:
            worst = np.where(floor > LOW, np.sqrt(np.maximum(reach - 2.0 * floor, 0)), np.inf)
        rows = np.arange(len(q))
        first = distances(np.hstack([qf, np.zeros((len(q), 1))]), self.centre[None])[:, 0]
        queue: list[tuple] = [(0.0, 0, rows, np.zeros(len(q)), first)]
        while queue:
            _, number, rows, bound, to_pivot = heapq.heappop(queue)
            near = bound <= worst[rows] + margin[rows]
            rows, to_pivot = rows[near], to_pivot[near]
            _, leaf, keys, radii, up, vec = self.pages[number]
            # what stored distances already rule out for every query isn't computed
            live = np.flatnonzero((np.abs(to_pivot[:, None] - up) - radii <= (worst + margin)[rows, None]).any(axis=0))
            if not live.size:
                continue
            self.opened += rows.size
            s = qf[rows] @ vec[live].astype(np.float64).T
            if not leaf:
                d = np.sqrt(np.maximum(reach[rows, None] - 2 * s, 0))
                low = np.maximum(d - radii[live], 0)
                may = low <= (worst + margin)[rows, None]
                for c in np.flatnonzero(may.any(axis=0)).tolist():
                    some = np.flatnonzero(may[:, c])
                    heapq.heappush(queue, (float(low[some, c].min()), int(keys[live[c]]), rows[some], low[some, c], d[some, c]))
                continue
            if exact:
                s = s.astype(np.int64)
            else:
                s = np.clip(q[rows].astype(object) @ vec[live].astype(object).T, LOW + 1, HIGH).astype(np.int64)
            s[keys[live][None, :] == own[rows, None]] = LOW
            better = np.flatnonzero((s.max(axis=1) >= best[rows, -1]) & (s.max(axis=1) > LOW))
            if better.size:
                to = rows[better]
                scores = np.hstack([best[to], s[better]])
                ids = np.hstack([names[to], np.where(s[better] > LOW, keys[live], HIGH)])
                order = np.lexsort((ids, ~scores), axis=1)[:, :k]
                best[to], names[to] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
                last = best[to, -1]
                worst[to] = np.where(last > LOW, np.minimum(worst[to], np.sqrt(np.maximum(reach[to] - 2.0 * last, 0))), worst[to])
        return best, names


ASKED = "vec_id long, v array<long>, home int, floor long, ids array<long>, scores array<long>"


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024, shard_rows: int = 8192, most_pivots: int = 1024, block: int = 4096, fanout: int = 16, leaf: int = 64) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` its k best rows of ``vectors``, itself not counted.

    Vectors are dealt by their nearest pivot; pivots are vectors with small hashes of their id, one for ``shard_rows``
    vectors and at most ``most_pivots``. What one pivot gets beyond ``shard_rows``, as a vector with very many copies does, is
    dealt on by a hash. So each shard is a metric ball whose pivot and radius are known, and its M-tree is
    written once in pages. A query first searches the shard of its nearest pivot; its k-th score there is its
    floor. It then goes only to the shards whose ball can hold something as good. Queries of a ``block`` that go to one shard meet its
    pages in one task; pages go to the blocks that ask for them. So a task holds one shard and one
    block, and where balls rule nothing out, as for vectors in random directions, the table moves once for each
    ``block`` queries: that is the least an exact answer needs then.

    Ties go to the smaller id. Rows that repeat are candidates each; queries that repeat a row are one, and those
    that repeat an id with other vectors share its k places. A query's own id is never a candidate. Shorter
    vectors count as filled up with zeros. Ids that aren't whole numbers are numbered in their order; null ids take no part. Components beyond 64 bits
    and scores beyond them are cut to what 64 bits hold. Too few vectors give fewer rows; empty tables
    give none; other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "m-tree")
    (vectors, queries), names = as_numbers(id_col, vectors.select(id_col, vec_col), queries.select(id_col, vec_col))
    base = scratch.table(quantised(vectors, id_col, vec_col, scale), "vectors")
    norm2 = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    size = base.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm2), F.max(F.greatest(F.abs(F.array_max("v").cast("double")), F.abs(F.array_min("v").cast("double"))))).first()
    n, width, m2 = size[0], max(1, size[1] or 0), float(size[2] or 0.0)
    kind = np.dtype("<i4") if (size[3] or 0) < 2**31 else np.dtype("<i8")
    asked = scratch.table(quantised(queries, id_col, vec_col, scale).distinct(), "queries")
    blocks = max(1, -(-asked.count() // block))

    def stack(col: pd.Series) -> np.ndarray:
        """Vectors as rows; what a query has beyond the table's width meets zeros only."""
        out = np.zeros((len(col), width), dtype=np.int64)
        for i, x in enumerate(col):
            out[i, : len(x)] = x[:width]
        return out

    def lifted(v: np.ndarray) -> np.ndarray:
        x = v.astype(np.float64)
        return np.hstack([x, np.sqrt(np.maximum(m2 - (x * x).sum(1), 0))[:, None]])

    wanted = min(most_pivots, max(1, -(-n // shard_rows)))
    chosen = base.select("v").distinct().orderBy(F.xxhash64("v")).limit(wanted).toPandas()["v"]
    centres = lifted(stack(chosen)) if len(chosen) else np.zeros((1, width + 1))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = distances(lifted(stack(b["v"])), centres)
            yield b.assign(part=d.argmin(1).astype(np.int32), dist=d.min(1))

    dealt = scratch.table(base.mapInPandas(deal, "vec_id long, v array<long>, part int, dist double"), "dealt")
    # one row a pivot
    balls = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).orderBy("part").collect()
    salts = np.array([max(1, -(-r.n // shard_rows)) for r in balls], dtype=np.int64)
    firsts = np.cumsum(salts) - salts
    parts = np.array([r.part for r in balls], dtype=np.int64)
    radii = np.array([r.radius for r in balls])
    part_of = np.repeat(parts, salts)  # by shard
    places = spark.createDataFrame(pd.DataFrame({"part": parts.astype(np.int32), "first": firsts, "salts": salts}), "part int, first long, salts long")
    sharded = dealt.join(F.broadcast(places), "part").select("vec_id", "v", (F.col("first") + F.pmod(F.xxhash64("vec_id", F.rand(7)), F.col("salts"))).cast("int").alias("shard"))

    def load(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        shard = int(part["shard"].iloc[0])
        pages = build(part["vec_id"].to_numpy(np.int64), stack(part["v"]), centres[part_of[shard]], m2, fanout, leaf)
        return pd.DataFrame([(shard, p, is_leaf, keys.astype("<i8").tobytes(), r.astype("<f8").tobytes(), up.astype("<f8").tobytes(), v.astype(kind).tobytes()) for p, is_leaf, keys, r, up, v in pages], columns=[c.split()[0] for c in PAGE_SCHEMA.split(", ")])

    pages = scratch.table(sharded.groupBy("shard").applyInPandas(load, PAGE_SCHEMA), "pages")
    scratch.drop("dealt")

    def tree_of(rows: pd.DataFrame) -> Tree:
        found = [(r.page, r.leaf, np.frombuffer(r.keys, "<i8"), np.frombuffer(r.radii, "<f8"), np.frombuffer(r.to_parent, "<f8"), np.frombuffer(r.vectors, kind).reshape(-1, width).astype(np.int64)) for r in rows.itertuples()]
        return Tree(found, centres[part_of[int(rows["shard"].iloc[0])]], m2)

    def search(key: tuple, asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asks):
            return pd.DataFrame(columns=[c.split()[0] for c in ASKED.split(", ")])
        scores, ids = tree_of(rows).search(stack(asks["v"]), asks["vec_id"].to_numpy(np.int64), k, asks["floor"].to_numpy(np.int64))
        full = scores > LOW
        out = asks[["vec_id", "v"]].assign(home=np.int32(key[0]), floor=scores[:, -1])
        return out.assign(ids=[i[f] for i, f in zip(ids, full, strict=True)], scores=[s[f] for s, f in zip(scores, full, strict=True)])

    def met(asks: DataFrame, name: str) -> DataFrame:
        """``asks(vec_id, v, floor, shard)`` with what their shards hold for them."""
        asks = scratch.table(asks.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int")), f"{name}-asks")
        cells = asks.select("shard", "block").distinct()
        sent = pages.join(cells, "shard").select(F.col("shard").alias("shard"), F.col("block").alias("block"), *[c for c in pages.columns if c != "shard"])
        return scratch.table(asks.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInPandas(search, ASKED), name)

    def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            q = np.hstack([stack(b["v"]).astype(np.float64), np.zeros((len(b), 1))])
            near = distances(q, centres[parts]).argmin(1) if len(parts) else np.zeros(len(b), dtype=np.int64)
            spread = b["vec_id"].to_numpy(np.int64) % salts[near] if len(parts) else 0
            yield b.assign(floor=LOW, shard=(firsts[near] + spread if len(parts) else near).astype(np.int32))

    def elsewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each other shard whose ball reaches what the query has."""
        for b in batches:
            for lo in range(0, len(b), 256):
                some = b.iloc[lo : lo + 256]
                v = stack(some["v"]).astype(np.float64)
                q2 = (v * v).sum(1)
                floor = some["floor"].to_numpy(np.int64)
                worst = np.where(floor > LOW, np.sqrt(np.maximum(q2 + m2 - 2.0 * floor, 0)), np.inf)
                d = distances(np.hstack([v, np.zeros((len(some), 1))]), centres[parts])
                may = np.repeat(d - radii <= (worst + MARGIN * (np.sqrt(q2) + np.sqrt(m2) + 1))[:, None], salts, axis=1)
                may[np.arange(len(some)), some["home"].to_numpy(np.int64)] = False
                at, shard = np.nonzero(may)
                yield some[["vec_id", "v", "floor"]].iloc[at].assign(shard=shard.astype(np.int32))

    schema = "vec_id long, v array<long>, floor long, shard int"
    home = met(asked.mapInPandas(at_home, schema), "home")
    away = met(home.select("vec_id", "v", "floor", "home").mapInPandas(elsewhere, schema), "away")
    found = home.select("vec_id", "ids", "scores").unionByName(away.select("vec_id", "ids", "scores"))
    found = found.select(F.col("vec_id").alias("query_id"), F.explode(F.arrays_zip("ids", "scores")).alias("c")).select("query_id", F.col("c.ids").alias("vec_id"), F.col("c.scores").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    return named(found, names, "query_id", "vec_id")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
