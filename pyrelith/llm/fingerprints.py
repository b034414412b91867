"""I-Match fingerprints: terms of a document-frequency band, sorted and hashed under randomised lexicon subsets; functions of Spark only."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands between words of letters, digits and all that lies beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Random draws of nested subsets, and how many subsets each has: they hold 1/4, 1/16, 1/64 and 1/256 of the lexicon.
DRAWS, LEVELS = 16, 4
#: Hexadecimal digits of a subset's signature, and what stands for a subset without a term of the text.
SIGNATURE, NOTHING = 4, "----"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def terms(text: Column) -> Column:
    """The distinct terms of a text: its words with A-Z in lower case."""
    words = F.array_remove(F.array_distinct(F.split(text, BETWEEN)), "")
    return F.array_distinct(F.transform(words, lambda w: F.when(F.lower(w) == w, w).otherwise(F.translate(w, UPPER, UPPER.lower()))))


def depths(term: Column) -> Column:
    """For each draw four bits of a number: in how many of its nested subsets a term is; a byte of the term's MD5 decides."""
    words = F.array(*[F.conv(F.substring(F.md5(term), 8 * k + 1, 8), 16, 10).cast("long") for k in range(DRAWS // 4)])

    def depth(byte: Column) -> Column:
        return F.when(byte % 4 > 0, 0).when(byte % 16 > 0, 1).when(byte % 64 > 0, 2).when(byte > 0, 3).otherwise(4).cast("long")

    def packed(ws: Column) -> Column:
        each = [F.shiftleft(depth(F.shiftright(F.get(ws, d // 4), 24 - 8 * (d % 4)).bitwiseAND(255)), 4 * d) for d in range(DRAWS)]
        return reduce(Column.bitwiseOR, each)

    return let(words, packed)


def signatures(entries: Column) -> Column:
    """One signature a subset from sorted entries ``(t, d)``: the hash of the terms that the subset holds, in order."""

    def inside(es: Column, draw: Column, level: int) -> Column:
        return F.filter(es, lambda e: F.call_function("shiftright", e["d"], draw).bitwiseAND(7) >= level)

    def nested(es: Column, draw: Column, level: int) -> Column:
        own = F.array(F.when(F.size(es) == 0, NOTHING).otherwise(F.substring(F.md5(F.array_join(es["t"], " ")), 1, SIGNATURE)))
        return own if level == LEVELS else F.concat(own, let(inside(es, draw, level + 1), lambda x: nested(x, draw, level + 1)))

    draws = F.sequence(F.lit(0), F.lit(4 * DRAWS - 4), F.lit(4))
    return let(entries, lambda es: F.flatten(F.transform(draws, lambda draw: let(inside(es, draw, 1), lambda x: nested(x, draw, 1)))))


def lexicon_table(lexicon: list) -> tuple[Column, int]:
    """The lexicon as an array of slots, each with the terms whose CRC-32 falls there, as one constant."""
    size = 1 << max(1, 2 * len(lexicon)).bit_length()
    slots: list[list] = [[] for _ in range(size)]
    for r in lexicon:
        slots[r.crc % size].append({"t": r.t, "d": r.d})
    return F.from_json(F.lit(json.dumps(slots)), "array<array<struct<t:string,d:bigint>>>"), size


def fingerprint_parts(text: Column, table: Column, size: int) -> Column:
    """``(s, a)``: the signatures of a text by its terms of the lexicon, or by all its terms if it has none there; and a hash of all its terms if no subset holds any of them."""

    def known(ts: Column) -> Column:
        return F.flatten(F.transform(ts, lambda t: F.filter(F.get(table, (F.crc32(t) % size).cast("int")), lambda e: e["t"] == t)))

    def parts(ts: Column) -> Column:
        entries = let(known(ts), lambda es: F.when(F.size(es) > 0, es).otherwise(F.transform(ts, lambda t: F.struct(t.alias("t"), depths(t).alias("d")))))
        s = let(F.sort_array(entries), signatures)
        return let(s, lambda x: F.struct(x.alias("s"), F.when(F.forall(x, lambda y: y == NOTHING), F.md5(F.array_join(F.sort_array(ts), " "))).alias("a")))

    return let(terms(text), parts)


def fingerprint(parts: Column) -> Column:
    return F.coalesce(parts["a"], F.array_join(parts["s"], ""))


def likeness(one: Column, two: Column) -> Column:
    """The share of equal signatures among the subsets that hold a term of either text; 1 for equal fingerprints."""
    pairs = F.filter(F.arrays_zip(one["s"].alias("x"), two["s"].alias("y")), lambda p: (p["x"] != NOTHING) | (p["y"] != NOTHING))
    share = let(pairs, lambda ps: F.size(F.filter(ps, lambda p: p["x"] == p["y"])) / F.size(ps))
    return F.when(fingerprint(one) == fingerprint(two), 1.0).when(one["a"].isNotNull() | two["a"].isNotNull(), 0.0).otherwise(share)


def lexicon_of(docs: DataFrame, text_col: str, low: int, high: int, least_docs: int) -> list:
    """``(t, d, crc)`` of the terms that ``low`` to ``high`` of a thousand documents hold, and ``least_docs`` at least.

    All texts are counted. A document has so many distinct terms on average, each of these terms lies in ``low`` of a thousand
    documents: so there are at most 1000 / low times that average of them, however many documents there are.
    """
    n = docs.count()
    held = docs.select(F.explode(terms(F.coalesce(F.col(text_col), F.lit("")))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    held = held.where((F.col("df") >= least_docs) & (F.col("df") * 1000 >= low * n) & (F.col("df") * 1000 <= high * n))
    return held.select("t", depths(F.col("t")).alias("d"), F.crc32("t").alias("crc")).collect()


def place_among(firsts: list, kind: T.DataType, c: Column) -> tuple[Column, Column]:
    """Which of the sorted ranges that begin with ``firsts`` a value lies in, found in two steps; and whether it is the range's first."""
    step = max(1, math.isqrt(len(firsts)))
    every = F.from_json(F.lit(json.dumps(firsts, default=str)), T.ArrayType(kind))
    coarse = F.from_json(F.lit(json.dumps(firsts[::step][1:], default=str)), T.ArrayType(kind))
    skipped = F.size(F.filter(coarse, lambda x: x <= c)) * step
    near = F.size(F.filter(F.slice(every, skipped + 1, F.lit(step)), lambda x: x.isNull() | (x <= c)))
    at = F.when(c.isNull(), 0).otherwise(F.greatest(skipped + near - 1, F.lit(0)))
    return at, F.get(every, at).eqNullSafe(c)


def with_next(docs: DataFrame, id_col: str, text_col: str, rows_per_block: int, most_blocks: int) -> DataFrame:
    """``(block, guest, doc_id, order, text, next_text)``: every text with the next one's by id, the last one with the first's.

    Texts move once. Ids alone are dealt to ranges first; the first id of each range is known then, at most
    ``most_blocks`` of them. A row goes to its range's block, and a block's first row to the block before
    as well, as a guest that comes last there.
    """
    kind = docs.schema[id_col].dataType
    n = max(1, min(most_blocks, -(-docs.count() // rows_per_block)))
    ids = docs.select(F.col(id_col).alias("doc_id")).repartitionByRange(n, "doc_id")
    heads = ids.groupBy(F.spark_partition_id().alias("at")).agg(F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).orderBy("at").collect()
    firsts = [None if r.nulls else r.first for r in heads]
    at, is_first = place_among(firsts, kind, F.col("doc_id"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("order", F.xxhash64("text"))
    own = F.struct(at.alias("block"), F.lit(False).alias("guest"))
    before = F.struct(((at + len(firsts) - 1) % len(firsts)).alias("block"), F.lit(True).alias("guest"))
    rows = rows.select("*", F.explode(F.when(is_first, F.array(own, before)).otherwise(F.array(own))).alias("b")).select("b.block", "b.guest", "doc_id", "order", "text")
    return rows.withColumn("next_text", F.lead("text").over(by_id()))


def by_id():
    return Window.partitionBy("block").orderBy("guest", "doc_id", "order")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: int = 2, high: int = 100, least_docs: int = 2, rows_per_block: int = 1000, most_blocks: int = 1 << 16) -> DataFrame:
    """One row a document: ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    A fingerprint has one signature for each of 64 random subsets of the lexicon: the hash of the text's terms in
    that subset, sorted. The lexicon holds the terms that ``low`` to ``high`` of a thousand documents have. The subsets are of four
    sizes, so that for short and long texts some of them hold about one term: their signatures are equal about as
    often as the two texts share their terms. The edited text is the text with its second half replaced by
    as much of the next one's start.

    A null text counts as empty. A text without any term of the lexicon is fingerprinted by all its terms, one
    without any term in a subset by one hash of them all (empty texts too). Rows that repeat an id stand next to each other, in the order of
    their texts' hashes, and lie in one block; a null id comes first. A single row is its own next one. An empty
    table gives no rows; other columns are not read.
    """
    table, size = lexicon_table(lexicon_of(docs, text_col, low, high, least_docs))
    rows = with_next(docs, id_col, text_col, rows_per_block, most_blocks)
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.select("block", "guest", "doc_id", "order", n_chars.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), fingerprint_parts(F.col("text"), table, size).alias("own"), fingerprint_parts(edited, table, size).alias("edited"))
    rows = rows.withColumn("next", F.lead("own").over(by_id())).where("not guest")
    own = F.col("own")
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(own).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"), likeness(own, F.col("edited")).alias("near_edited"), likeness(own, F.col("next")).alias("near_next"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
e AS (SELECT doc_id, text, n, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text, coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id FROM d),
x AS (SELECT doc_id, next_id, n, text, left(text, n - n // 2) || left(next_text, n // 2) AS edited FROM e),
texts AS (SELECT doc_id, 0 AS which, text AS body FROM x UNION ALL SELECT doc_id, 1, edited FROM x),
t AS (SELECT DISTINCT doc_id, which, unnest(regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM texts),
df AS (SELECT t, count(*) AS df FROM t WHERE which = 0 GROUP BY 1),
lex AS (SELECT t FROM df WHERE df >= 2 AND df * 1000 >= 2 * (SELECT count(*) FROM d) AND df * 1000 <= 100 * (SELECT count(*) FROM d)),
marked AS (SELECT doc_id, which, t.t, lex.t IS NOT NULL AS known, bool_or(lex.t IS NOT NULL) OVER (PARTITION BY doc_id, which) AS any_known FROM t LEFT JOIN lex ON t.t = lex.t),
used AS (SELECT doc_id, which, t, md5(t) AS h FROM marked WHERE known = any_known),
cells AS (SELECT draw, level FROM range(16) a(draw), range(1, 5) b(level)),
sig AS (SELECT doc_id, which, draw, level, substr(md5(string_agg(t, ' ' ORDER BY t)), 1, 4) AS s FROM used JOIN cells ON CAST('0x' || substr(h, CAST(2 * draw + 1 AS INT), 2) AS INT) % CAST(pow(4, level) AS INT) = 0 GROUP BY ALL),
grid AS (SELECT b.doc_id, b.which, cells.draw, cells.level, coalesce(s, '----') AS s FROM texts b CROSS JOIN cells LEFT JOIN sig ON sig.doc_id = b.doc_id AND sig.which = b.which AND sig.draw = cells.draw AND sig.level = cells.level),
alls AS (SELECT doc_id, which, md5(string_agg(t, ' ' ORDER BY t)) AS a FROM t GROUP BY 1, 2),
fp AS (SELECT doc_id, which, list(s ORDER BY draw, level) AS s, bool_and(s = '----') AS bare FROM grid GROUP BY 1, 2),
f AS (SELECT fp.doc_id, fp.which, s, bare, CASE WHEN bare THEN coalesce(a, md5('')) ELSE array_to_string(s, '') END AS f FROM fp LEFT JOIN alls USING (doc_id, which)),
p AS (SELECT x.doc_id, 'edited' AS k, o.f AS f1, q.f AS f2, o.bare OR q.bare AS bare, list_zip(o.s, q.s) AS z FROM x JOIN f o ON o.doc_id = x.doc_id AND o.which = 0 JOIN f q ON q.doc_id = x.doc_id AND q.which = 1
 UNION ALL SELECT x.doc_id, 'next', o.f, q.f, o.bare OR q.bare, list_zip(o.s, q.s) FROM x JOIN f o ON o.doc_id = x.doc_id AND o.which = 0 JOIN f q ON q.doc_id = x.next_id AND q.which = 0),
near AS (SELECT doc_id, k, f1, f2, CASE WHEN f1 = f2 THEN 1.0::DOUBLE WHEN bare THEN 0.0::DOUBLE ELSE CAST(len(list_filter(z, lambda y: y[1] = y[2] AND y[1] <> '----')) AS DOUBLE) / len(list_filter(z, lambda y: y[1] <> '----' OR y[2] <> '----')) END AS near FROM p)
SELECT x.doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, a.f1 AS fingerprint, a.f2 AS edited_fingerprint, a.near AS near_edited, b.near AS near_next
FROM x JOIN near a ON a.doc_id = x.doc_id AND a.k = 'edited' JOIN near b ON b.doc_id = x.doc_id AND b.k = 'next'
"""
