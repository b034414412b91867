"""Importance resampling towards a target: hashed word runs, gains by bucket, and the k best by radix selection."""

from __future__ import annotations

import json
import math
import os.path
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrelith.operators.ordering import numbered
from pyrelith.runtime import Scratch, text_batches

#: Longer runs than this are hashed one by one.
LONG_RUN = 64
#: Hexadecimal digits of a key that one round of the selection looks at: 16^3 bins at most go to the driver.
DIGITS = 3


def byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: whether it belongs to a word, what it becomes in lower case, and its CRC-32 step."""
    b = np.arange(256)
    upper = (b >= 0x41) & (b <= 0x5A)
    word = (b >= 0x80) | ((b >= 0x30) & (b <= 0x39)) | upper | ((b >= 0x61) & (b <= 0x7A))
    step = b.astype(np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (step >> np.uint32(1))
    return word, np.where(upper, b + 32, b).astype(np.uint8), step


def crc32_of(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """CRC-32 of many pieces of one buffer, byte by byte for all pieces at once."""
    out = np.empty(len(starts), dtype=np.uint32)
    for i in np.flatnonzero(lengths > LONG_RUN):
        out[i] = zlib.crc32(buf[starts[i] : starts[i] + lengths[i]])
    short = np.flatnonzero(lengths <= LONG_RUN)
    short = short[np.argsort(-lengths[short].astype(np.int8), kind="stable")]
    at, crc = starts[short], np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
    longer = np.searchsorted(-lengths[short], -np.arange(LONG_RUN), side="left")  # how many have more than j bytes
    for j in range(LONG_RUN):
        n = longer[j]
        if not n:
            break
        crc[:n] = step[(crc[:n] ^ buf[at[:n] + j]) & np.uint32(0xFF)] ^ (crc[:n] >> np.uint32(8))
    out[short] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def histograms(texts, runs: tuple[int, int], buckets: int) -> tuple[np.ndarray, ...]:
    """Of an Arrow column of texts: words, runs, and how often each text has which bucket, as offsets, buckets and counts."""
    import pyarrow as pa

    word, lower, step = byte_tables()
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    base = int(ends[0])
    raw = np.frombuffer(data, dtype=np.uint8)[base : ends[-1]] if data is not None and ends[-1] > base else np.empty(0, np.uint8)
    ends = ends[1:] - base
    inside = word[raw]
    first = inside.copy()  # where a word starts; a text's end also ends its last word
    first[1:] &= ~inside[:-1]
    borders = ends[:-1][(ends[:-1] < len(raw)) & (ends[:-1] > 0)]
    first[borders] = inside[borders]
    starts = np.flatnonzero(first)
    # one buffer with the words in lower case, a space after each, so that a run of words is one piece of it
    letters = np.cumsum(inside)
    n_letters, word_no = int(letters[-1]) if len(letters) else 0, np.arange(len(starts))
    before = letters[starts] - 1
    length, at = np.diff(np.append(before, n_letters)), before + word_no
    packed = np.full(n_letters + len(starts), 0x20, dtype=np.uint8)
    packed[np.arange(n_letters) + np.repeat(word_no, length)] = lower[raw[inside]]
    doc = np.searchsorted(ends, starts, side="right")
    words = np.bincount(doc, minlength=n)
    keys = []
    for k in range(runs[0], runs[1] + 1):
        if len(starts) < k:
            break
        whole = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :])
        last = whole + k - 1
        keys.append(doc[whole] * buckets + crc32_of(packed, at[whole], at[last] + length[last] - at[whole], step) % buckets)
    key, count = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
    of = key // buckets
    runs_of = np.bincount(of, weights=count, minlength=n).astype(np.int64)
    return words, runs_of, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]), key % buckets, count


def hashed_runs(docs: DataFrame, id_col: str, text_col: str, runs: tuple[int, int], buckets: int) -> DataFrame:
    """``(doc_id, n_words, n_features, buckets, counts)`` of every row; null text has no words."""
    kind = docs.schema[id_col].dataType
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField(n, k) for n, k in (("doc_id", kind), ("n_words", T.LongType()), ("n_features", T.LongType()), ("buckets", ints), ("counts", ints))])

    def fold(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            words, features, offsets, which, count = histograms(b.column(1), runs, buckets)
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in (which, count)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(features, pa.int64()), *lists], names=schema.names)

    text_batches(docs.sparkSession, 1000, 4 << 20)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(fold, schema)


def bucket_totals(hist: DataFrame, name: str) -> DataFrame:
    """``(bucket, name)``: how often all texts have each bucket; summed within tasks before it moves."""
    pairs = hist.select(F.explode(F.arrays_zip("buckets", "counts")).alias("p"))
    return pairs.groupBy(F.col("p.buckets").alias("bucket")).agg(F.sum("p.counts").alias(name))


def gains(of_docs: DataFrame, of_target: DataFrame, buckets: int) -> list[int]:
    """One whole number a bucket: a thousand times the log of its share in the target over its share in the documents."""
    spark = of_docs.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(of_docs, "bucket", "left").join(of_target, "bucket", "left").fillna(0, ["s", "t"])
    rows = both.select("bucket", "s", "t").collect()  # one row a bucket, whatever the input
    s_all, t_all = sum(r.s for r in rows), sum(r.t for r in rows)
    out = [0] * buckets
    for r in rows:
        out[r.bucket] = math.floor(1000 * math.log(float(r.t + 1) * float(s_all + buckets) / (float(r.s + 1) * float(t_all + buckets))))
    return out


def ordered_hex(c: Column) -> Column:
    """A 64-bit number as 16 digits whose order as text is the numbers' order."""
    return F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def id_digits(docs_type: T.DataType, c: Column) -> Column:
    """Digits in the order of the ids, null last: whole numbers by value, anything else by the bytes of its text."""
    digits = ordered_hex(c) if isinstance(docs_type, T.IntegralType) else F.hex(F.encode(c.cast("string"), "UTF-8"))
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), digits))


def kth_key(keys: DataFrame, k: int) -> str | None:
    """The k-th smallest of the distinct texts in ``key``, by radix selection; None for k = 0.

    A round counts the rows by their next digits, beyond those that all rows left have in common, and goes
    on in the bin that holds the k-th; it sends at most 16^DIGITS bins with their smallest and largest key.
    """
    r = keys.agg(F.count("key").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).first()
    if k <= 0 or not r.n:
        return None
    if k >= r.n:
        return r.high
    low, high = r.low, r.high
    while low != high:
        shared = len(os.path.commonprefix([low, high]))
        bins = keys.where(F.col("key").between(low, high)).groupBy(F.substring("key", shared + 1, DIGITS).alias("d"))
        for b in sorted(bins.agg(F.count("key").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect(), key=lambda b: b.low):
            if k <= b.n:
                low, high = b.low, b.high
                break
            k -= b.n
        if k == b.n:
            return high
    return low


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", buckets: int = 10_000, runs: tuple[int, int] = (1, 1), least_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """Every row's ``(doc_id, n_features, weight, score, rank)``; drawn are the rows with a rank.

    Texts are cut and hashed once, in numpy over Arrow batches; what is kept of a row is the list of its
    buckets and their counts. The gains are one number a bucket, at most ``buckets`` of them, so they go
    to all tasks as one array. Drawing by the largest Gumbel-perturbed weight is sampling without
    replacement; the key (score down, id up, row) has digits, and radix selection over them finds the
    k-th. Only rows up to it are range-sorted and numbered; the rest keep no rank and never move.

    Null or empty texts have no features: weight 0, never drawn. Rows that repeat an id have one score and
    are drawn each, those with equal texts in any order. A null id is hashed as an empty one and sorts last.
    Equal scores go to the smaller id. Empty documents give an empty result; an empty target counts 0
    everywhere. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resampling")
    hist = scratch.table(hashed_runs(docs, id_col, text_col, runs, buckets).withColumn("row", F.monotonically_increasing_id()), "histograms")
    goal = hashed_runs(target.select(F.lit(0).alias("doc_id"), F.col(target_col).alias("text")), "doc_id", "text", runs, buckets)
    table = F.from_json(F.lit(json.dumps(gains(bucket_totals(hist, "s"), bucket_totals(goal, "t"), buckets))), "array<bigint>")
    weight = F.aggregate(F.zip_with("buckets", "counts", lambda b, c: F.get(table, b) * c), F.lit(0).cast("long"), lambda a, x: a + x)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = hist.select("doc_id", "n_words", "n_features", "row", weight.alias("weight")).withColumn("score", (F.col("weight") + noise).cast("long"))
    key = F.concat(ordered_hex(-F.col("score")), id_digits(docs.schema[id_col].dataType, F.col("doc_id")), F.lit("|"), ordered_hex(F.col("row")))
    scored = scratch.table(scored.withColumn("key", F.when(F.col("n_words") >= least_words, key)).drop("row", "n_words"), "scored")
    scratch.drop("histograms")
    kept = scored.where("key is not null").select("key")
    last = kth_key(kept, kept.count() * percent // 100)
    drawn = F.lit(False) if last is None else F.coalesce(F.col("key") <= last, F.lit(False))
    cols = ["doc_id", "n_features", "weight", "score"]
    ranked = numbered(scored.where(drawn), ["key"], "rank").select(*cols, F.col("rank").cast("long"))
    return scored.where(~drawn).select(*cols, F.lit(None).cast("long").alias("rank")).unionByName(ranked)


ORACLE = r"""
WITH step AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS step FROM range(256) r(i)),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
words AS (SELECT w, hex(w) AS h FROM (SELECT w FROM d UNION SELECT w FROM b)),
bytes AS (SELECT w, list_transform(range(1, length(h), 2), lambda k: CAST('0x' || substr(h, k, 2) AS BIGINT)) AS bs FROM words),
crc AS (SELECT w, CAST(xor(list_reduce(list_prepend(4294967295, bs), lambda a, x: xor(step[xor(a, x) % 256 + 1], a // 256)), 4294967295) % 10000 AS BIGINT) AS bucket FROM bytes, step),
dw AS (SELECT doc_id, bucket, count(*) AS n FROM d JOIN crc USING (w) GROUP BY ALL),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM dw GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM b JOIN crc USING (w) GROUP BY 1),
st AS (SELECT (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) FROM s) AS s_all, (SELECT CAST(coalesce(sum(t), 0) AS DOUBLE) FROM t) AS t_all),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (s_all + 10000) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), st),
w AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM dw JOIN g USING (bucket) GROUP BY 1),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM documents LEFT JOIN w USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM ranked) THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""
