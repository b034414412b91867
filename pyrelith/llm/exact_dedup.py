"""Exact dedup by content-defined chunk recipes, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.runtime import Scratch, fresh

#: Finds the white space runs that one space must replace; a single space already is one.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


#: Of every 32 code points beyond Latin-1 the first two, by rule: a chunk may end after one of them, in any script.
BEYOND = "".join(rf"\x{{{b:x}}}-\x{{{b + 1:x}}}" for b in range(0x100, 0x10000, 32) if not 0xD800 <= b < 0xE000)


def chunk_pattern(least: int, most: int) -> str:
    """Chunks end at least ``least`` characters on, after a word that ends in two consonants, after a number or capitals that end in one of a few,
    or after a character beyond Latin-1 that is one in 16 by its code; without any, after ``most`` characters.

    Where a chunk ends depends only on what it holds, so after an inserted passage the same cuts come again.
    """
    return rf"(?s).{{{least},{most}}}?(?:[b-df-hj-np-tv-z]{{2}}[ ]|[0-9A-Z][05AEO][ ]|(?=[^\x00-\xFF])[{BEYOND}])|.{{1,{most}}}"


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 600, most: int = 6000, key_bits: int = 64) -> DataFrame:
    """``(doc_id, text_sha256, keys, digests)``: for each chunk in order its 64-bit key and its SHA-256."""
    def key(c):
        return F.xxhash64(c) if key_bits >= 64 else F.xxhash64(c).bitwiseAND(F.lit((1 << key_bits) - 1))

    return (
        docs.select(F.col(id_col).alias("doc_id"), F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), RUNS, " ").alias("norm"))
        .select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.regexp_extract_all("norm", F.lit(chunk_pattern(least, most)), F.lit(0)).alias("chunks"))
        .select("doc_id", "text_sha256", F.transform("chunks", key).alias("keys"), F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("digests"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 600, most: int = 6000, key_bits: int = 64) -> DataFrame:
    """One row a row of ``docs``: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    A text is cut once, on the executor that reads it, into content-defined chunks; from then on only its
    recipe moves. Chunks are deduplicated by (key, SHA-256) before the shuffle; a key that stands for one
    digest only is verified and is the chunk's identifier, and one that stands for several gets the rank
    of the digest beside it. Texts are equal when their ordered identifier lists are. Lists are grouped
    with partial aggregates, and the group's row (one) is joined back to its documents, so that a group
    with a third of all rows is a skewed join that Spark splits, never one task's list.

    Null text counts as empty, and all empty texts are one group. Rows that repeat both id and text are
    members of the group each; the first of them is the one that stays. A null id is larger than any id.
    An empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    recs = scratch.table(recipes(docs, id_col, text_col, least, most, key_bits), "recipes")
    chunks = recs.select(F.explode(F.arrays_zip("keys", "digests")).alias("c")).select("c.keys", "c.digests").groupBy("keys", "digests").agg(F.count(F.lit(1)).alias("uses"))
    unsure = chunks.groupBy("keys").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("digests")).alias("all")).where("n > 1")
    unsure = scratch.table(unsure.select("keys", "all"), "unsure")
    if unsure.isEmpty():
        listed = recs.withColumn("ranks", F.array().cast("array<int>"))
    else:
        rows = recs.select("doc_id", "text_sha256", F.posexplode(F.arrays_zip("keys", "digests")).alias("at", "c")).join(unsure.select(F.col("keys").alias("k"), "all"), F.col("c.keys") == F.col("k"), "left")
        rows = rows.select("doc_id", "text_sha256", F.struct("at", F.coalesce(F.array_position("all", F.col("c.digests")), F.lit(0)).cast("int").alias("rank")).alias("r"))
        ranks = rows.groupBy("doc_id", "text_sha256").agg(F.sort_array(F.collect_set("r")).alias("rs")).select(F.col("doc_id").alias("i"), F.col("text_sha256").alias("s"), F.col("rs.rank").alias("ranks"))
        listed = recs.join(ranks, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_sha256") == F.col("s")), "left").withColumn("ranks", F.coalesce("ranks", F.array().cast("array<int>")))
    lists = ["list_hash", "keys", "ranks"]
    listed = listed.withColumn("list_hash", F.xxhash64("keys", "ranks")).groupBy(*lists, "doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    groups = listed.groupBy(*lists).agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    out = listed.join(groups, lists).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts one row; an id's different texts stay each."""
    scratch = Scratch(docs.sparkSession, "exact-drop")
    one, two, sha = (fresh(docs, c) for c in ("other_id", "first_id", "sha"))
    of = fresh(docs, "first_sha")
    dedup = exact_dedup(docs, id_col, text_col)
    gone = scratch.table(dedup.groupBy("doc_id").agg(F.max("kept").alias("k"), F.count(F.lit(1)).alias("n")).where("not k or n > 1"), "gone")
    left = docs.join(gone.select(F.col("doc_id").alias(one)), docs[id_col].eqNullSafe(F.col(one)), "left_anti")
    several = gone.where("n > 1").select(F.col("doc_id").alias(one))
    if several.isEmpty():
        return left
    # ids of several rows: each row is decided by its text
    first = dedup.where("kept").join(several, F.col("doc_id").eqNullSafe(F.col(one)), "left_semi").select(F.col("doc_id").alias(two), F.col("text_sha256").alias(of))
    rows = docs.join(several, docs[id_col].eqNullSafe(F.col(one)), "left_semi").withColumn(sha, F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), RUNS, " "), 256))
    rows = rows.join(first, F.col(id_col).eqNullSafe(F.col(two)) & (F.col(sha) == F.col(of)), "left_semi")
    return left.unionByName(rows.dropDuplicates([id_col, sha]).drop(sha))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
h AS (SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM h
"""
