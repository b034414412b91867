"""Mixing sources to target weights: hash-random order, distributed prefix sums, a cut at each exact budget."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.runtime import Scratch, column, fresh

WORD = r"[^\x20\x09-\x0D]+"
#: Up to this many sources, their table (under 100 bytes a row) is broadcast; beyond it a shuffled join is left to Spark.
BROADCAST_SOURCES = 20_000


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code-point order, null last, take the weights in turn. Sharing by weight and resharing what
    is above a cap ends where each source has the smaller of its cap and weight * level, with one level
    for all; sorted by cap / weight, that level is the first one below its own row's ratio. One row a
    source, so the two windows without a key see sources, never documents. All sizes 0 give targets 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    everything = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long")
    return (
        sizes.withColumn("place", F.row_number().over(order))
        .withColumn("weight", w)
        .withColumn("ratio", F.lit(float(cap)) * F.col("source_size") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("filled", F.coalesce(F.sum(F.col("source_size") * cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.lit(share) * F.col("total") - F.col("filled")) / F.col("rest"))
        .withColumn("first_open", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything))
        .withColumn("capped", F.col("first_open").isNull() | (F.struct("ratio", "place") < F.struct("first_open.ratio", "first_open.place")))
        .select("source", "source_size", F.when(F.col("capped"), (F.col("source_size") * cap).cast("double")).otherwise(F.col("weight") * F.col("first_open.level")).alias("target"))
    )


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2, rows_per_bucket: int = 20_000, row_col: str | None = None) -> DataFrame:
    """One row a document: ``(doc_id, source, size, source_size, target, taken)``; taken counts repeats. ``row_col``, a row's own number, comes along as ``row``.

    Each document gets the MD5 of its id as its random key. A bucket is a prefix of that key, long enough
    that a bucket of the largest source holds about ``rows_per_bucket`` rows: the buckets are ranges of the
    key, so sorting inside them sorts the source, and the prefix sum of a document is that of its bucket
    (bucket totals of a source, a small table) and that within its bucket. The result doesn't depend on
    the bucket size. A source with the target t and the size s has floor(t / s) whole epochs, and one that
    is cut after floor(t - epochs * s) words; the document at that place gives only the words before it.

    Null text is 0 words; empty tables give empty results; null sources are one source, the last one;
    rows that repeat an id are separate documents whose order among themselves follows their size.
    Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    own = [F.col(row_col).alias("row")] if row_col else []
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *own)
    sized = scratch.table(sized.withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "sized")
    per_source = scratch.table(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources")
    n_sources, largest = per_source.agg(F.count(F.lit(1)), F.max("n")).first()
    digits = max(1, math.ceil(math.log(max(largest or 1, 1) / rows_per_bucket, 16))) if largest and largest > rows_per_bucket else 1
    targets = source_targets(per_source.select("source", "source_size"), weights, share, cap)
    if n_sources <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0))).select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "ahead")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", *(["row"] if row_col else [])).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    t = targets.withColumnRenamed("source", "t_source")
    placed = placed.join(t, F.col("source").eqNullSafe(F.col("t_source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = F.floor(F.col("target") - epochs * F.col("source_size")).cast("long")
    cut = F.least(F.greatest(left - F.col("ahead") - F.col("inside"), F.lit(0).cast("long")), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + cut).alias("taken"), *(["row"] if row_col else []))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as the plan takes them, with all their columns.

    The document at a source's cut appears once with its first words only, joined by single spaces; a
    document that the mix doesn't reach is left out. Rows are numbered in a written copy, so that each has its own
    share of the plan, rows of one id and those without one too. Columns may have any names.
    """
    row, taken, size, copy = (fresh(docs, c) for c in ("row", "taken", "size", "copy"))
    rows = Scratch(docs.sparkSession, "mix-rows").table(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    plan = mix_plan(rows, id_col, text_col, source_col, row_col=row, **options).where("taken > 0")
    plan = plan.select(F.col("row").alias(row), F.col("taken").alias(taken), F.col("size").alias(size))
    whole, cut = F.floor(F.col(taken) / F.col(size)).cast("int"), (F.col(taken) % F.col(size)).cast("int")
    out = rows.join(plan, row).withColumn(copy, F.explode(F.sequence(F.lit(1), whole + (cut > 0).cast("int"))))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.greatest(cut, F.lit(1))), " ")
    text = F.when((cut > 0) & (F.col(copy) > whole), part).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).select(*[column(c) for c in docs.columns])


ORACLE = r"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s0),
s2 AS (SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT] AS weight FROM s1),
s3 AS (SELECT *, 2.0e0 * source_size / weight AS ratio, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s2),
s4 AS (SELECT *, (1.5e0 * total - CAST(coalesce(sum(source_size * 2) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)) / CAST(sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level FROM s3),
open AS (SELECT ratio AS o_ratio, place AS o_place, level AS o_level FROM s4 WHERE level < ratio ORDER BY ratio, place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN o_place IS NULL OR ratio < o_ratio OR (ratio = o_ratio AND place < o_place) THEN CAST(source_size * 2 AS DOUBLE) ELSE weight * o_level END AS target FROM s4 LEFT JOIN open ON true),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before, CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + least(greatest(CAST(floor(target - epochs * source_size) AS BIGINT) - before, 0), size) AS BIGINT) AS taken FROM p
"""
