"""MinHash near-dedup by a signature-coordinate inverted join, with every link confirmed on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.operators.components import connected_components
from pyrelith.llm.ids import as_numbers, named
from pyrelith.runtime import Scratch, fresh, release_memory, text_batches

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
#: Words remembered by one worker before its memory is emptied.
REMEMBERED = 200_000
#: Texts whose sets are held at once.
PIECE = 256
#: Coordinates of the finer signature that pairs across components must agree in as well.
FINE = 512
#: Its values are cut to a byte for short lists, and to two where it is posted itself.
WIDE_BITS = 16
SIGS = "doc_id long, n_shingles long, digest binary, sig array<int>"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit (64-bit murmur steps)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, hashes: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``width``-word shingles of a whole text.

    Words are runs other than space and U+0009 to U+000D, with A-Z lower-cased; fewer words than
    ``width`` are one shingle; null or wordless texts have none.
    """
    if not text:
        return np.zeros(0, dtype=np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(width, h.size)
    out = np.full(h.size - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + h[k : h.size - n + 1 + k]
    return np.unique(mixed(out))


def coefficients(coords: int) -> np.ndarray:
    """Odd multipliers, one a coordinate, from a fixed rule."""
    return mixed(np.arange(1, coords + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def sign(sets: list[np.ndarray], coords: int) -> np.ndarray:
    """Signatures (rows) of sets that aren't empty: for each coordinate the least product's upper half."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [s.size for s in sets[:-1]])
    out = np.empty((len(sets), coords), dtype=np.int32)
    for k, a in enumerate(coefficients(coords)):
        out[:, k] = (np.minimum.reduceat(flat * a, starts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def matches_needed(coords: int, least: float) -> int:
    """Coordinates that a pair at the similarity ``least`` shares but for about two in 100,000 such pairs (4.3 deviations)."""
    return max(1, math.floor(coords * least - 4.3 * math.sqrt(coords * least * (1 - least))))


def fine_matches_needed(least: float) -> int:
    """The same for the finer signature, whose bytes also agree by chance."""
    return matches_needed(FINE, least + (1 - least) / 256)


def fine_values(s: np.ndarray) -> np.ndarray:
    """The finer signature of one set that isn't empty: the least product of each of ``FINE`` coordinates."""
    out = np.empty(FINE, dtype=np.uint64)
    c = coefficients(FINE)
    for k in range(0, FINE, 64):
        out[k : k + 64] = (s[None, :] * c[k : k + 64, None]).min(axis=1)
    return out


def fine_sign(s: np.ndarray) -> bytes:
    """A byte of each value."""
    return (fine_values(s) >> np.uint64(24)).astype(np.uint8).tobytes()


def wide_sign(s: np.ndarray) -> bytes:
    """Two bytes of each value."""
    return (fine_values(s) >> np.uint64(32)).astype("<u2").tobytes()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(a.size, b.size) < percent * max(a.size, b.size):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (both.size - shared)


def confirm(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets ``set_a`` and ``set_b`` are similar enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            ok = [linked(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent) for x, y in zip(t["set_a"], t["set_b"], strict=True)]
            yield t.loc[np.array(ok, dtype=bool), ["a", "b"]]
        release_memory()

    return pairs.select("a", "b", "set_a", "set_b").mapInPandas(run, "a long, b long")


def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for k in range(0, len(b), PIECE):
            yield b.iloc[k : k + PIECE]


def signatures(docs: DataFrame, coords: int, width: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, sig)``; the digest (128 bits over the whole set) names texts with equal sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in pieces(batches):
            sets = [shingle_set(t, hashes, width) for t in b["text"]]
            full = [i for i, s in enumerate(sets) if s.size]
            sigs: list = [None] * len(sets)
            if full:
                for i, row in zip(full, sign([sets[i] for i in full], coords), strict=True):
                    sigs[i] = row
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_shingles": [s.size for s in sets], "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "sig": sigs})
        hashes = None
        release_memory()

    return docs.mapInPandas(run, SIGS)


def small(table: DataFrame, most_bytes: int) -> DataFrame:
    """A written table of numbers, to be broadcast if its counted rows take up to ``most_bytes`` unpacked (16 bytes a value)."""
    return F.broadcast(table) if table.count() * 16 * len(table.columns) <= most_bytes else table


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 5, coords: int = 32, broadcast_bytes: int = 16 << 20, block_rows: int = 1500, compared=None) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row a row of ``docs``.

    Texts with equal sets are one class, named by its smallest id. A class is posted under each
    (coordinate, value) of its signature. Two classes that share ``t`` of ``c`` coordinates share one of
    their first c - t + 1 in any common order; rarest first keeps the lists short, and values that only
    one class has fill those places without being posted, so most texts are never posted at all.

    Links are then looked for in two passes. Each posted class is held against the leader of its lists,
    the one whose values are the most common: of a group of copies, the text they come from. Confirmed links are contracted to
    components. Of each list that still has several components, pairs across components whose signatures
    agree in t coordinates, counted whole, are confirmed too. A list of more than ``block_rows`` classes isn't
    paired: its classes are posted again under a finer signature, whose long lists are skipped as a merge of lists
    skips them (``skipped_pairs``). A pair inside a component isn't made: it can't change the result. Sets move only for
    classes that are posted. Every link between different texts that the signatures find is thus kept; t is so low that they miss
    about two pairs in 100,000 at the very threshold, fewer above it. ``compared``, an accumulator, counts compared pairs of signatures.

    Null and wordless texts have no shingles and are alone. Rows that share an id are one document with
    several texts; a null id is linked with nothing and has a null component; ids that aren't whole numbers are numbered in their order first. Repeated rows are one
    class; empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    text_batches(spark)
    least = matches_needed(coords, percent / 100)
    (texts,), names = as_numbers("doc_id", docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("long"))
    sigs = scratch.table(signatures(texts, coords, width), "signatures")
    usable = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("digest", "n_shingles").agg(F.min(F.struct("doc_id", "sig")).alias("first"))
    classes = scratch.table(classes.select(F.col("first.doc_id").alias("rep"), F.col("first.sig").alias("sig"), "digest", "n_shingles"), "classes")

    tokens = classes.select("rep", F.posexplode("sig").alias("pos", "val"))
    tokens = tokens.select("rep", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("val").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token"))
    lists = scratch.table(in_parts(tokens, F.collect_list("rep").alias("reps"), F.count(F.lit(1)).alias("n")), "lists")
    shared = lists.withColumn("uses", F.sum("n").over(of_list())).where("uses > 1").select(F.explode("reps").alias("rep"), "uses", "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("uses", "token"))).alias("ts"), F.sum("uses").alias("weight")).where(F.size("ts") >= least)
    posted = scratch.table(shared.select("rep", "weight", F.slice("ts", F.lit(1), F.size("ts") - least + 1)["token"].alias("tokens")), "posted")
    scratch.drop("lists")
    posts = posted.select("rep", "weight", F.explode("tokens").alias("token"))
    weighed = F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("lead")
    heads = scratch.table(in_parts(posts, F.collect_list("rep").alias("reps"), F.count(F.lit(1)).alias("n"), weighed), "heads")
    led = heads.select("token", "reps", F.max("lead").over(of_list()).alias("lead"), F.sum("n").over(of_list()).alias("n")).where("n > 1")
    # every class of a list; one that leads all its lists has no leader of its own
    star = led.select(F.explode("reps").alias("rep"), "lead").groupBy("rep").agg(F.max(F.when(F.col("rep") != -F.col("lead.minus"), F.col("lead"))).alias("lead")).select(F.col("rep").alias("a"), (-F.col("lead.minus")).alias("b"))
    star = scratch.table(star, "star")
    if star.isEmpty():
        label = spark.createDataFrame([], "node long, component long")
    else:
        label = linked_components(spark, scratch, texts, classes, posted, posts, star, percent, width, least, broadcast_bytes, block_rows, compared)
    members = classes.join(label, classes["rep"] == label["node"], "left").select("digest", "n_shingles", F.coalesce("component", "rep").alias("component"))
    out = sigs.join(members, ["digest", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
    return named(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), names, "doc_id", "component_id")


#: Parts of a list; a task and a row hold about one of so many of it.
PARTS = 64


def in_parts(posts: DataFrame, *aggregates) -> DataFrame:
    """Lists of ``posts(token, rep, ...)`` in up to ``PARTS`` rows each; what is known of a list is known from these, by a window."""
    return posts.groupBy("token", F.pmod(F.xxhash64("rep"), F.lit(PARTS)).alias("part")).agg(*aggregates)


def of_list():
    """All parts of a list, ``PARTS`` rows at most."""
    return Window.partitionBy("token")


def linked_components(spark, scratch: Scratch, texts: DataFrame, classes: DataFrame, posted: DataFrame, posts: DataFrame, star: DataFrame, percent: int, width: int, least: int, broadcast_bytes: int, block_rows: int, compared=None) -> DataFrame:
    """``(node, component)`` of the classes that have a confirmed link: to leaders first, then across components."""
    # sets of the classes that may have a link, those that nobody chose as leader too: one pass over the texts they stand for
    wanted = star.select(F.col("a").alias("rep"), F.col("b").alias("lead"), F.lit(False).alias("leads")).unionByName(star.where("b is not null").select(F.col("b").alias("rep"), F.lit(None).cast("long").alias("lead"), F.lit(True).alias("leads")).distinct())
    wanted = wanted.groupBy("rep").agg(F.max("lead").alias("lead"), F.max("leads").alias("leads"))
    wanted = small(scratch.table(wanted, "wanted"), broadcast_bytes)

    def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for t in pieces(batches):
            sets = [shingle_set(x, hashes, width) for x in t["text"]]
            yield pd.DataFrame({"id": t["doc_id"], "lead": t["lead"].astype("Int64"), "leads": t["leads"], "set": [s.tobytes() for s in sets], "fine": [fine_sign(s) if s.size else b"" for s in sets]})
        hashes = None
        release_memory()

    near = texts.join(wanted, texts["doc_id"] == wanted["rep"]).select("doc_id", "lead", "leads", "text")
    sets = scratch.table(near.mapInPandas(shingled, "id long, lead long, leads boolean, set binary, fine binary"), "sets")
    sides = sets.where("lead is not null").select(F.col("id").alias("a"), F.col("lead").alias("b"), F.col("set").alias("set_a"))
    edges = confirm(sides.join(sets.where("leads").select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b"), percent)
    edges = scratch.table(edges, "links1")
    label = scratch.table(connected_components(edges, scratch), "components1")

    # lists that still hold several components
    named = posts.join(label, posts["rep"] == label["node"], "left").select("token", "rep", F.coalesce("component", "rep").alias("comp"))
    ends = [F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n")]
    parts = scratch.table(in_parts(named, F.collect_list(F.struct("rep", "comp")).alias("held"), *ends), "parts")
    known = {c: f(c).over(of_list()) for c, f in (("lo", F.min), ("hi", F.max), ("n", F.sum))}
    open_posts = parts.select("token", "held", *[v.alias(c) for c, v in known.items()]).where("lo <> hi").select("token", F.inline("held"), "n").select("token", "rep", "comp", "n")
    open_posts = scratch.table(open_posts, "open")
    marks = classes.join(posted, "rep").join(sets.select(F.col("id").alias("rep"), "fine"), "rep").select("rep", "sig", "fine", "tokens")
    short = open_posts.where(F.col("n") <= block_rows).withColumn("blocks", F.lit(1)).withColumn("block", F.lit(0))
    cross = cross_pairs(short.join(marks, "rep"), {"sig": least, "fine": fine_matches_needed(percent / 100)}, compared)
    busy = scratch.table(open_posts.where(F.col("n") > block_rows).select("rep", "comp").distinct(), "busy")
    if not busy.isEmpty():
        cross = cross.unionByName(skipped_pairs(scratch, busy.join(sets.select(F.col("id").alias("rep"), "set"), "rep"), matches_needed(FINE, percent / 100), block_rows, compared)).distinct()
    cross = scratch.table(cross, "cross")
    if not cross.isEmpty():
        ids = scratch.table(cross.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
        # a set is asked for by its id; sets of rows that share an id are held against the others each
        few = sets.select("id", "set").join(small(ids, broadcast_bytes), "id")
        both = cross.join(few.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a").join(few.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
        more = scratch.table(confirm(both, percent).distinct(), "links2")
        labelled = [label.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
        more = more.join(labelled[0], "a", "left").join(labelled[1], "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        over = scratch.table(connected_components(more, Scratch(spark, "near-dedup-2")).withColumnRenamed("component", "top"), "components2")
        old = label.join(over.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        label = scratch.table(old.unionByName(over.join(label, over["node"] == label["node"], "left_anti").select("node", F.col("top").alias("component"))), "components")
    scratch.drop("heads", "parts", "star", "wanted", "sets", "links1", "links2", "open", "busy", "wide", "merged", "cross", "ids", "posted", "edges0")
    return label


def skipped_pairs(scratch: Scratch, classes: DataFrame, least: int, block_rows: int, compared=None) -> DataFrame:
    """Pairs ``a < b`` of ``classes(rep, comp, set)`` in different components whose finer signatures agree in ``least`` coordinates.

    The classes are posted under the coordinates of the finer signature. Lists of more than ``block_rows`` are long and are skipped:
    of a class that is in l long lists, at least ``least - l`` of what it shares with a partner are elsewhere, so
    its rarest other values find every partner, as a prefix does. What remains are classes that are in
    ``least`` long lists or more, so alike to very many others without a link; only these are compared with one another,
    list by list in blocks of ``block_rows``.
    """

    def wide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"rep": b["rep"], "comp": b["comp"], "wide": [wide_sign(np.frombuffer(x, dtype=np.uint64)) for x in b["set"]]})
        release_memory()

    signed = scratch.table(classes.select("rep", "comp", "set").mapInPandas(wide, "rep long, comp long, wide binary"), "wide")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = np.arange(FINE, dtype=np.int64) << WIDE_BITS
        for b in batches:
            for lo in range(0, len(b), 200):
                some = b.iloc[lo : lo + 200]
                values = np.stack([np.frombuffer(x, dtype="<u2") for x in some["wide"]]).astype(np.int64)
                yield pd.DataFrame({"rep": np.repeat(some["rep"].to_numpy(), FINE), "token": (values + base).ravel()})
        release_memory()

    tokens = signed.select("rep", "wide").mapInPandas(spread, "rep long, token long")
    lists = in_parts(tokens, F.collect_list("rep").alias("reps"), F.count(F.lit(1)).alias("n")).withColumn("uses", F.sum("n").over(of_list())).where("uses > 1")
    tokens = lists.select(F.explode("reps").alias("rep"), "token", "uses")
    long = F.count_if(F.col("uses") > block_rows)
    short = F.sort_array(F.collect_list(F.when(F.col("uses") <= block_rows, F.struct("uses", "token"))))
    hot = F.sort_array(F.collect_list(F.when(F.col("uses") > block_rows, F.struct("uses", "token"))))
    merged = tokens.groupBy("rep").agg(long.alias("l"), short.alias("short"), hot.alias("hot"))
    merged = scratch.table(merged.join(signed, "rep"), "merged")
    # a value that only one class has fills a place of the prefix without being posted
    alone = F.lit(FINE) - F.col("l") - F.size("short")
    prefix = F.when(F.col("l") < least, F.greatest(F.lit(FINE - least + 1) - alone, F.lit(0))).otherwise(F.size("short"))
    listed = merged.select("rep", "comp", "wide", F.slice("short", F.lit(1), prefix.cast("int"))["token"].alias("tokens"))
    posts = listed.select("*", F.explode("tokens").alias("token"), F.lit(1).alias("blocks"), F.lit(0).alias("block"))
    out = cross_pairs(several(posts), {"wide": least}, compared)
    first = F.greatest(F.lit(FINE - least + 1) - alone - F.size("short"), F.lit(0)).cast("int")
    listed = merged.where(F.col("l") >= least).select("rep", "comp", "wide", F.slice("hot", F.lit(1), first)["token"].alias("tokens"))
    crowd = listed.select("*", F.explode("tokens").alias("token"))
    sizes = crowd.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    crowd = several(crowd).join(sizes, "token").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    return out.unionByName(cross_pairs(crowd, {"wide": least}, compared))


def several(posts: DataFrame) -> DataFrame:
    """The posts of lists that hold several components."""
    mixed_lists = posts.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    return posts.join(mixed_lists, "token", "left_semi")


#: How the values of each signature are kept.
KINDS = {"sig": np.dtype("<i4"), "fine": np.dtype("u1"), "wide": np.dtype("<u2")}


def cross_pairs(posts: DataFrame, checks: dict[str, int], compared=None) -> DataFrame:
    """Pairs ``a < b`` of one list and different components whose signatures collide in enough coordinates.

    A row of ``posts`` is a class in a list (``token``) with its component, its signatures, and ``tokens``, all lists that it is posted in. A pair
    is made only in the list of the smallest token that both have; if that list isn't among ``posts``, it is left to whoever handles it. ``checks`` has the signatures in the order in which they are compared, and the collisions that each needs. A list of one block
    is one group; one of n blocks becomes n (n + 1) / 2 groups of two blocks at most, so a task holds two blocks and the pairs that pass.
    """
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    dealt = posts.withColumn("cell", F.explode(pairs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(batches, ["token", "i", "j"]):
            signs = [(np.stack([np.frombuffer(x, dtype=KINDS[c]) if isinstance(x, bytes) else x for x in g[c]]), least) for c, least in checks.items()]
            rep, comp, block, token, i, j = (g[c].to_numpy() for c in ("rep", "comp", "block", "token", "i", "j"))
            tokens = [frozenset(t.tolist()) for t in g["tokens"]]
            cuts = np.flatnonzero((np.diff(token) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            out: list[tuple] = []
            n = 0
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(g)], strict=True):
                rows = np.arange(lo, hi)
                one, two = rows[block[lo:hi] == i[lo]], rows[block[lo:hi] == j[lo]]
                for k in one.tolist():
                    rest = two[two > k] if i[lo] == j[lo] else two
                    rest = rest[comp[rest] != comp[k]]
                    n += rest.size
                    for sign, least in signs:
                        if rest.size:
                            rest = rest[(sign[rest] == sign[k]).sum(axis=1) >= least]
                    out += [(min(rep[x], rep[k]), max(rep[x], rep[k])) for x in rest.tolist() if min(tokens[x] & tokens[k]) == token[lo]]
            if compared is not None:
                compared.add(int(n))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
        release_memory()

    together = dealt.select("token", "cell.i", "cell.j", "block", "rep", "comp", "tokens", *checks).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "rep")
    return together.mapInPandas(run, "a long, b long").where("a <> b").distinct()


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches, cut again so that no group of equal keys is in two of them."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        changed = np.flatnonzero((b[keys].to_numpy()[1:] != b[keys].to_numpy()[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].iloc[-1].to_numpy() != b[keys].iloc[0].to_numpy()).any():
            yield pd.concat(held)
            held = []
        if changed.size:
            yield pd.concat([*held, b.iloc[: changed[-1]]])
            held = []
            b = b.iloc[changed[-1] :]
        held.append(b)
    if held:
        yield pd.concat(held)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, one document of each component: the one with the smallest id."""
    scratch, name = Scratch(docs.sparkSession, "near-drop"), fresh(docs, "gone")
    gone = scratch.table(near_components(docs, id_col, text_col, percent, **options).where("not kept").select(F.col("doc_id").alias(name)).distinct(), "gone")
    return docs.join(small(gone, 16 << 20), docs[id_col] == F.col(name), "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.node AND e.b > c.root),
t AS (SELECT node, min(root) AS root FROM c GROUP BY node)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, root AS component_id, doc_id = root AS kept FROM documents LEFT JOIN n USING (doc_id) JOIN t ON node = doc_id
"""
