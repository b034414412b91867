"""BPE encoding and decoding with a distinct-word table and an id-to-piece table.

Texts are split into words once. Only distinct words meet the tokenizer, each of them once; their ids are
joined back to where each word stood. A byte-level BPE never merges across words, so this equals encoding
whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.llm.ids import as_numbers, named
from pyrelith.runtime import release_memory, text_batches

#: Fixed value: the split of byte-level BPE as published with GPT-2.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@lru_cache(4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(4)
def added_tokens(path: str) -> tuple[dict[str, int], regex.Pattern | None]:
    """Tokens that are found in a text before it is split, and a pattern for them (the longest first)."""
    with open(path, encoding="utf-8") as f:
        added = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
    return added, regex.compile("(" + "|".join(regex.escape(x) for x in sorted(added, key=lambda x: (-len(x), x))) + ")") if added else None


def split_words(text: str | None, added: regex.Pattern | None) -> list[str]:
    """The words of a text in order; an added token is a word of its own. Null texts have none."""
    if not text:
        return []
    if added is None or not added.search(text):
        return SPLIT.findall(text)
    out: list[str] = []
    for k, piece in enumerate(added.split(text)):
        out += [piece] if k % 2 else SPLIT.findall(piece)
    return out


def encode_words(words: list[str], path: str) -> list[list[int]]:
    return [e.ids for e in tokenizer(path).encode_batch(words, add_special_tokens=False)]


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable Latin-1 stands for itself, the rest follows from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def piece_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Id to piece: all pieces' bytes in one buffer and each id's place in it. Its size is the vocabulary's."""
    t = tokenizer(path)
    letters = byte_alphabet()
    pieces = []
    for i in range(t.get_vocab_size(with_added_tokens=True)):
        s = t.id_to_token(i) or ""
        pieces.append(bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode())
    return np.frombuffer(b"".join(pieces), dtype=np.uint8), np.cumsum([0] + [len(p) for p in pieces])


def pieces_of(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> bytes:
    """The join of ids with their pieces, in order."""
    data, starts = table
    first = starts[ids]
    length = starts[ids + 1] - first
    ends = np.cumsum(length)
    if not ends.size:
        return b""
    at = np.arange(ends[-1]) + np.repeat(first - ends + length, length)
    return data[at].tobytes()


def ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... of each i, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if ends.size else 0) + np.repeat(first - ends + length, length)


def varints(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2^28 as 7-bit groups, the last group's high bit clear; and how many bytes each takes."""
    size = 1 + (x >= 1 << 7).astype(np.int64) + (x >= 1 << 14) + (x >= 1 << 21)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if ends.size else 0, dtype=np.uint8)
    at = ends - size
    for k in range(4):
        has = size > k
        out[at[has] + k] = ((x[has] >> (7 * k)) & 127) | np.where(size[has] > k + 1, 128, 0)
    return out, size


def from_varints(data: np.ndarray, kind=np.int64, piece: int = 1 << 18) -> np.ndarray:
    """The numbers of a run of varints, decoded piece by piece so that little more than the result is held."""
    out, lo = [np.zeros(0, dtype=kind)], 0
    while lo < data.size:
        hi = min(lo + piece, data.size)
        while hi < data.size and data[hi - 1] & 128:
            hi += 1
        part = data[lo:hi]
        ends = np.flatnonzero((part & 128) == 0)
        starts = np.concatenate([[0], ends[:-1] + 1])
        x = np.zeros(ends.size, dtype=kind)
        for k in range(4):
            has = starts + k <= ends
            x[has] |= (part[starts[has] + k].astype(kind) & 127) << (7 * k)
        out.append(x)
        lo = hi
    return np.concatenate(out)


#: A block is whole documents of about so many characters.
BLOCK_CHARS = 32 << 20
LISTS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()), ("places", pa.binary())])


def pack(raw: bytes) -> bytes:
    """What rows carry is packed by Zstandard before it is written or shuffled."""
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpack(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def numbers_of(packed: bytes, kind=np.int64) -> np.ndarray:
    return from_varints(np.frombuffer(unpack(packed), dtype=np.uint8), kind)


def block_rows(block: int, docs: list[tuple], numbers: dict[str, int], places: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """A block's rows: one for each bucket of its distinct words, and one (bucket -1) with what puts them back.

    The latter has the documents and their word counts, the bucket of each word in order of appearance,
    and for each place the number of its word, small for words that came early.
    """
    words = list(numbers)
    of = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets for w in words), dtype=np.uint16, count=len(words))
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    rows: list[tuple] = []
    for part in np.split(order, cuts) if len(words) else []:
        mine = [words[k] for k in part.tolist()]
        lengths, _ = varints(np.fromiter(map(len, mine), dtype=np.int64, count=len(mine)))
        rows.append((block, int(of[part[0]]), pack("".join(mine).encode("utf-8", "surrogatepass")), pack(lengths.tobytes()), None))
    steps = b"".join(varints(p.astype(np.int64))[0].tobytes() for p in places)
    rows.append((block, -1, pack(json.dumps(docs).encode()), pack(of.tobytes()), pack(steps)))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), LISTS, strict=True)], schema=LISTS)


def to_blocks(path: str, buckets: int):
    """Cut a partition into blocks of whole documents and list the words of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, added = added_tokens(path)
        part = TaskContext.get().partitionId()
        n, chars, docs, places, numbers = 0, 0, [], [], {}
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = split_words(text, added)
                places.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.uint32, count=len(words)))
                docs.append((doc, len(words)))
                chars += len(text or "") + 64
                if chars >= BLOCK_CHARS:
                    yield block_rows((part << 24) + n, docs, numbers, places, buckets)
                    n, chars, docs, places, numbers = n + 1, 0, [], [], {}
        if docs:
            yield block_rows((part << 24) + n, docs, numbers, places, buckets)
        docs, places, numbers = [], [], {}
        release_memory()

    return run


IDS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary())])


def encoder(path: str):
    """Encode the words of a bucket, which come from all blocks one list after another, each distinct word once; other rows pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: int | None = None
        known: dict[str, bytes] = {}
        for b in batches:
            bucket, text, lengths, places = (b.column(k).to_pylist() for k in range(1, 5))
            docs, counts, ids = [], [], []
            for k, joined, raw, rest in zip(bucket, text, lengths, places, strict=True):
                if k < 0:  # not for this stage
                    docs.append(joined)
                    counts.append(raw)
                    ids.append(rest)
                    continue
                if k != current:
                    current, known = k, {}
                joined = unpack(joined).decode("utf-8", "surrogatepass")
                ends = np.cumsum(numbers_of(raw)).tolist()
                words = [joined[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]
                new = [w for w in words if w not in known]
                for w, found in zip(new, encode_words(new, path), strict=True):
                    known[w] = np.array(found, dtype="<u4").tobytes()
                got = [known[w] for w in words]
                docs.append(None)
                counts.append(pack(varints(np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4)[0].tobytes()))
                ids.append(pack(varints(np.frombuffer(b"".join(got), dtype="<u4").astype(np.int64))[0].tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(docs, pa.binary()), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())], schema=IDS)
        known = {}
        release_memory()

    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def assembler(table):
    """Put the ids of each block's words where the words stood; a block's rows come together, and only one block is held."""

    def finish(head: tuple, lists: list[tuple]) -> pa.RecordBatch:
        docs, of, words = json.loads(unpack(head[0])), np.frombuffer(unpack(head[1]), dtype=np.uint16), numbers_of(head[2], np.uint32)
        lists.sort(key=lambda x: x[0])
        place = np.empty(of.size, dtype=np.int64)  # of each word in the order of buckets, as it was sent
        place[np.argsort(of, kind="stable")] = np.arange(of.size)
        uses = np.concatenate([np.zeros(0, dtype=np.int64), *(numbers_of(x[1]) for x in lists)])
        pool = np.concatenate([np.zeros(0, dtype="<u4"), *(numbers_of(x[2], np.uint32) for x in lists)])
        starts = (np.cumsum(uses) - uses)[place]
        uses = uses[place]
        out: list[tuple] = []
        lo = 0
        for doc, n in docs:
            mine = words[lo : lo + n]
            lo += n
            ids = pool[ranges(starts[mine], uses[mine])]
            text = pieces_of(ids.astype(np.int64), table.value).decode("utf-8", "replace").encode("utf-8")
            out.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), RESULT, strict=True)], schema=RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, head, lists = None, None, []
        for b in batches:
            for block, bucket, docs, counts, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != current:
                    if current is not None:
                        yield finish(head, lists)
                    current, head, lists = block, None, []
                if bucket < 0:
                    head = (docs, counts, ids)
                else:
                    lists.append((bucket, counts, ids))
        if current is not None:
            yield finish(head, lists)
        head, lists = None, []
        release_memory()

    return run


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for each row of ``docs``.

    A partition is cut into blocks of whole documents. A block deals its distinct words by their hash into
    buckets; a bucket meets the lists of all blocks, so it encodes each distinct word once, and answers
    each list with the ids of its words in the same order. The block joins them back by position and
    decodes through the vocabulary's pieces (a table of the vocabulary's size). A word that stands everywhere is one
    entry a block, so no bucket gets more than its share; what moves is distinct words, ids and
    the numbers of words, never texts. There are four buckets for each shuffle partition of the session, 64 to 16,384.

    Null and empty texts have no ids. Rows that repeat are encoded each; a null id is kept; ids that aren't whole numbers are numbered on the way; a text longer
    than a block is a block; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    text_batches(spark)
    table = spark.sparkContext.broadcast(piece_table(path))
    (rows,), names = as_numbers("doc_id", docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = buckets or min(16_384, max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    if buckets > 1 << 16:
        raise ValueError("at most 65,536 buckets")
    lists = rows.mapInArrow(to_blocks(path, buckets), "block long, bucket int, words binary, lengths binary, places binary")
    # what isn't for a bucket is dealt by its block
    asked = lists.repartition("bucket", F.when(F.col("bucket") < 0, F.col("block"))).sortWithinPartitions("bucket")
    answers = asked.mapInArrow(encoder(path), "block long, bucket int, docs binary, counts binary, ids binary")
    together = answers.repartition("block").sortWithinPartitions("block")
    return named(together.mapInArrow(assembler(table), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"), names, "doc_id")
