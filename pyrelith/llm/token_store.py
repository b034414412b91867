"""Token ids in files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

File format (a directory of Parquet files, rows in document order within a file):

    part long, docs string, ids long, payload binary

Parts follow one another in document order. A row is a stripe of blocks that were coded side by side.
``docs`` is a JSON list with, for each document that has ids in the stripe: its id, its place in the part,
the part's ids before it, how many of its ids are here, which piece of it they are, and 1 if they are its last.
``payload`` is, in little-endian numbers:

    magic "PTS2", blocks u32, bytes of the prior u32, CRC-32 of it u32; for each block: ids u32, CRC-32 of
    them u32, code units u32; then the prior, then the blocks' code units (u16) one after another.

The prior (Zstandard) is what every block of the stripe starts from: how often each id stands in the stripe, and
which ids often follow it, as rounded logarithms. So any block can be read with the prior alone. In a
block each id is predicted by three orders. Order 2 remembers what followed the last two ids in this block; the
chance that it comes again mixes its own record at that sureness with the order-1 and order-0 chance of
that id, by a weight that learns. Otherwise the id is coded by the order-1 distribution of the last id, or, where that doesn't have it,
by order 0: classes of ids that adapt to the block, and the prior within a class. Records, weights, classes and order 2
learn from each id. All arithmetic is on integers, so every machine decodes the same ids.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.llm.bpe import added_tokens, encode_words, split_words
from pyrelith.llm.ids import as_numbers, named
from pyrelith.runtime import Scratch, release_memory, text_batches

MAGIC = b"PTS2"
#: Ids of one block, and blocks coded side by side; a task holds lanes * block ids.
BLOCK_IDS, LANES = 2048, 2048
TABLE_BITS = 11
#: Order 0: classes of about equal share, and what a class is divided into.
CLASSES, CLASS_BITS, PART_BITS = 128, 7, 16
#: Order 1: what a context is divided into, how often a pair must stand in a stripe, and the most ids a context has.
NEXT_BITS, LEAST_PAIRS, MOST_NEXT = 14, 6, 4096
#: Counts in the prior are rounded to sixths of a power of two.
LEVELS = np.array([round(2 ** (k / 6)) for k in range(256)], dtype=np.int64)
NONE = (1 << 16) - 1
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
ONE = 1 << 16
U = np.uint64


class Coder:
    """A range coder for many blocks at once: 64-bit state, 16-bit code units, no carries.

    Calls name lanes by a slice (the first so many) or by their numbers.
    """

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, dtype=np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)

    def narrowed(self, lanes, start: np.ndarray, size: np.ndarray, bits: int) -> np.ndarray:
        """Take the interval [start, start + size) of 2^bits in ``lanes``; the lanes that can give a unit now."""
        r = self.range[lanes] >> U(bits)
        self.low[lanes] += start.view(np.uint64) * r
        self.range[lanes] = size.view(np.uint64) * r
        live = self.ready(lanes)
        if live.size and not isinstance(lanes, slice):
            live = lanes[live]
        return live

    def ready(self, lanes) -> np.ndarray:
        """Places of ``lanes`` whose leading unit is settled, or whose range is so small that it is cut to settle it."""
        low, rng = self.low[lanes], self.range[lanes]
        settled = (low ^ (low + rng)) < TOP
        small = rng < BOTTOM
        cut = small > settled
        if cut.any():
            self.range[lanes] = np.where(cut, (U(0) - low) & (BOTTOM - U(1)), rng)
        return (settled | small).nonzero()[0]


class Encoder(Coder):
    def __init__(self, lanes: int, room: int):
        super().__init__(lanes)
        self.out = np.zeros(lanes * room, dtype=np.uint16)
        self.first = np.arange(lanes, dtype=np.int64) * room
        self.n = self.first.copy()

    def put(self, lanes, start: np.ndarray, size: np.ndarray, bits: int = 16) -> None:
        live = self.narrowed(lanes, start, size, bits)
        while live.size:
            low, at = self.low[live], self.n[live]
            self.out[at] = low >> U(48)
            self.n[live] = at + 1
            self.low[live] = low << U(16)
            self.range[live] <<= U(16)
            live = live[self.ready(live)]

    def finish(self) -> None:
        for _ in range(4):
            self.out[self.n] = self.low >> U(48)
            self.n += 1
            self.low <<= U(16)


class Decoder(Coder):
    def __init__(self, units: np.ndarray, starts: np.ndarray):
        super().__init__(starts.size)
        self.units, self.at = units, starts.copy()
        self.code = np.zeros(starts.size, dtype=np.uint64)
        for _ in range(4):
            self.code = (self.code << U(16)) | self.units[self.at]
            self.at += 1

    def slot(self, lanes, bits: int = 16) -> np.ndarray:
        return np.minimum((self.code[lanes] - self.low[lanes]) // (self.range[lanes] >> U(bits)), U((1 << bits) - 1)).view(np.int64)

    def take(self, lanes, start: np.ndarray, size: np.ndarray, bits: int = 16) -> None:
        live = self.narrowed(lanes, start, size, bits)
        while live.size:
            at = self.at[live]
            self.code[live] = (self.code[live] << U(16)) | self.units[at]
            self.at[live] = at + 1
            self.low[live] <<= U(16)
            self.range[live] <<= U(16)
            live = live[self.ready(live)]


def level(counts: np.ndarray) -> np.ndarray:
    return np.clip(np.searchsorted(LEVELS[:200], counts, side="left"), 0, 199).astype(np.uint8)


def prior_of(blocks: list[np.ndarray]) -> bytes:
    """The prior of the blocks of a stripe (ids below 2^16 - 1): ids, their counts, and each id's frequent successors."""
    flat = np.concatenate([np.zeros(0, dtype=np.int64), *blocks])
    counts = np.bincount(flat, minlength=1)
    ids = np.flatnonzero(counts)
    starts = np.cumsum([b.size for b in blocks])[:-1]
    inner = np.ones(max(0, flat.size - 1), dtype=bool)
    inner[starts[(starts > 0) & (starts < flat.size)] - 1] = False
    pairs = np.sort(((flat[:-1] << 16) | flat[1:])[inner].astype(np.uint32))
    at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if pairs.size else np.zeros(0, dtype=np.int64)
    uses = np.diff(np.append(at, pairs.size))
    often = uses >= LEAST_PAIRS
    pairs, uses = pairs[at[often]].astype(np.int64), uses[often]
    order = np.lexsort((pairs & 0xFFFF, -uses, pairs >> 16))
    first = pairs[order] >> 16
    heads = np.concatenate([[True], first[1:] != first[:-1]]) if first.size else np.zeros(0, dtype=bool)
    place = np.arange(first.size) - np.maximum.accumulate(np.where(heads, np.arange(first.size), 0))
    keep = np.sort(order[place < MOST_NEXT])
    pairs, uses = pairs[keep], uses[keep]
    dense = np.zeros(1 << 16, dtype=np.int64)
    dense[ids] = np.arange(ids.size)
    fan = np.bincount(dense[pairs >> 16], minlength=ids.size)
    after = dense[pairs & 0xFFFF]
    step = np.diff(after, prepend=0)
    step[np.cumsum(fan)[fan > 0] - fan[fan > 0]] = after[np.cumsum(fan)[fan > 0] - fan[fan > 0]]
    parts = [np.diff(ids, prepend=0).astype("<u2"), level(counts[ids]), fan.astype("<u2"), step.astype("<u2"), level(uses)]
    raw = np.array([ids.size, pairs.size], dtype="<u4").tobytes() + b"".join(planes(p) for p in parts)
    return zstandard.ZstdCompressor(level=9).compress(raw)


def planes(x: np.ndarray) -> bytes:
    """All first bytes of the numbers, then all second ones."""
    return x.view(np.uint8).reshape(x.size, x.itemsize).T.tobytes()


class Prior:
    """Order-0 and order-1 distributions of a stripe, as intervals."""

    def __init__(self, packed: bytes):
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n, m = (int(x) for x in np.frombuffer(raw, dtype="<u4", count=2))
        at = 8

        def take(size: int, width: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(raw, dtype=np.uint8, count=size * width, offset=at).reshape(width, size)
            at += size * width
            return sum((x[k].astype(np.int64) << (8 * k) for k in range(width)), np.zeros(size, dtype=np.int64))

        ids = np.cumsum(take(n, 2))
        weight = LEVELS[take(n, 1)]
        fan, step, uses = take(n, 2), take(m, 2), LEVELS[take(m, 1)]
        # order 0: ids by falling count, cut to classes
        order = np.lexsort((ids, -weight))
        cum = np.cumsum(weight[order])
        total = int(cum[-1]) if n else 1
        cls = (cum - weight[order]) * CLASSES // total
        share = np.bincount(cls, weights=weight[order], minlength=CLASSES).astype(np.int64)
        held = np.bincount(cls, minlength=CLASSES)
        freq = 1 + weight[order] * ((1 << PART_BITS) - held[cls]) // np.maximum(share[cls], 1)
        ends = np.cumsum(freq)
        begin = np.cumsum(held) - held
        base = np.where(held > 0, np.concatenate([[0], ends])[begin], 0)
        self.id0 = ids[order]
        self.ladder0 = (cls << PART_BITS) + ends - base[cls]
        # what rounding left of a class is its last id's
        last = (begin + held - 1)[held > 0]
        grown = (np.flatnonzero(held) + 1 << PART_BITS) - self.ladder0[last]
        self.ladder0[last] += grown
        freq[last] += grown
        self.class_of, self.start0, self.size0, self.chance0 = (np.zeros(1 << 16, dtype=np.int64) for _ in range(4))
        self.class_of[self.id0] = cls
        self.size0[self.id0] = freq
        self.start0[self.id0] = self.ladder0 - freq - (cls << PART_BITS)
        self.chance0[ids] = np.maximum(1, weight * (ONE - 1) // total)
        self.classes = (1 + share * 24 * 100 // total).astype(np.int32)
        # order 1: the successors of each context, and an interval for all others
        contexts = np.flatnonzero(fan)
        size = fan[contexts]
        self.context_of = np.full(1 << 16, -1, dtype=np.int64)
        self.context_of[ids[contexts]] = np.arange(contexts.size)
        of = np.repeat(np.arange(contexts.size), size)
        total_steps = np.cumsum(step)
        first = np.cumsum(size) - size
        after = total_steps - (total_steps - step)[first][of] if m else step
        self.id1 = ids[after]
        self.key1 = ((ids[contexts][of] << 16) | self.id1).astype(np.uint32)
        known = np.bincount(of, weights=uses, minlength=contexts.size).astype(np.int64)
        room = (1 << NEXT_BITS) - size - 1
        whole = known + np.maximum(1, weight[contexts] - known)
        self.size1 = 1 + uses * room[of] // whole[of] if m else uses
        ends = np.cumsum(self.size1)
        self.start1 = ends - self.size1 - (ends - self.size1)[first][of] if m else uses
        self.ladder1 = (of << NEXT_BITS) + self.start1 + self.size1
        self.other = np.bincount(of, weights=self.size1, minlength=contexts.size).astype(np.int64)  # where the others' interval starts

    def pairs(self, last: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The places of pairs among the successors; -1 for others."""
        keys = ((last << 16) | ids).astype(np.uint32)
        if not self.key1.size:
            return np.full(keys.shape, -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.key1, keys), self.key1.size - 1)
        return np.where(self.key1[at] == keys, at, -1)


class Model:
    """The state of every lane: order 2, its records, weights and order-0 classes; the same in coding and decoding.

    An order-2 entry is an id and, in the lowest 3 bits, how sure it is; beside it stands its place among the
    successors. The first ``n`` lanes are still running.
    """

    RATE, WEIGHT_RATE = 4, 6
    #: First chances by sureness.
    FIRST = (2000, 16000, 30000, 42000, 50000, 56000, 60000, 62000)

    def __init__(self, lanes: int, prior: Prior):
        n = 1 << TABLE_BITS
        rows = np.arange(lanes, dtype=np.int64)
        self.prior, self.base, self.row8 = prior, rows * n, rows * 8
        self.table = np.full(lanes * n, NONE << 3, dtype=np.int32)
        self.place = np.full(lanes * n, -1, dtype=np.int32)
        self.hit = np.tile(np.array(self.FIRST, dtype=np.int64), lanes)  # by sureness: chance that it holds
        self.weight = np.full(lanes * 8, ONE // 4, dtype=np.int64)  # by sureness: weight of the lower orders
        self.classes = np.tile(prior.classes, (lanes, 1))
        self.last = np.full(lanes, NONE, dtype=np.int64)
        self.before = np.zeros(lanes, dtype=np.int64)  # the hash of the id before the last
        self.step = 0
        self.refresh()

    def refresh(self) -> None:
        """Order-0 class intervals from the counts so far; done every few ids, at fixed places."""
        total = self.classes.sum(axis=1, keepdims=True, dtype=np.int64)
        width = 1 + (self.classes.astype(np.int64) * (ONE - CLASSES)) // total
        ends = np.cumsum(width, axis=1)
        width[:, -1] += ONE - ends[:, -1]
        ends[:, -1] = ONE
        self.width, self.ends = width, ends
        self.ladder = (ends + (np.arange(len(ends), dtype=np.int64) << 16)[:, None]).ravel()  # sorted: all lanes' intervals on one line

    def contexts(self, n: int) -> None:
        """What order 2 expects, and the chance of it."""
        self.slot = self.base[:n] + (((self.last[:n] * 0x9E3779B1 + self.before[:n]) >> 13) & ((1 << TABLE_BITS) - 1))
        entry = self.table[self.slot]
        self.guess, self.sure = entry >> 3, entry & 7
        self.at = self.row8[:n] + self.sure
        self.own = self.hit[self.at]
        place = self.place[self.slot]
        self.lower = np.where(place >= 0, self.prior.size1[place] << (16 - NEXT_BITS), self.prior.chance0[self.guess]) if self.prior.size1.size else self.prior.chance0[self.guess]
        self.w = self.weight[self.at]
        mixed = self.own + ((self.w * (self.lower - self.own)) >> 16)
        self.chance = np.where(self.guess == NONE, 16, np.minimum(np.maximum(mixed, 64), ONE - 64))

    def learn(self, n: int, ids: np.ndarray, right: np.ndarray, place: np.ndarray) -> None:
        goal = right * ONE
        self.hit[self.at] = self.own + ((goal - self.own) >> self.RATE)
        better = np.abs(goal - self.lower) < np.abs(goal - self.own)
        self.weight[self.at] = np.minimum(np.maximum(self.w + ((better * ONE - self.w) >> self.WEIGHT_RATE), 1024), ONE - 1024)
        stays = right | (self.sure >= 2)
        self.table[self.slot] = np.where(stays, (self.guess << 3) | np.where(right, np.minimum(self.sure + 1, 7), self.sure >> 1), ids << 3)
        new = np.flatnonzero(~stays)
        self.place[self.slot[new]] = place[new]
        self.before[:n] = self.last[:n] * 0x85EBCA6B
        self.last[:n] = ids
        self.step += 1
        if self.step % 64 == 0 or self.step in (4, 12, 32):
            self.refresh()


def running(sizes: np.ndarray, t: int) -> int:
    """How many of the blocks, longest first, have more than ``t`` ids."""
    return int(np.searchsorted(-sizes, -t, side="left"))


def encode_blocks(blocks: list[np.ndarray]) -> bytes:
    """One stripe: blocks of ids (below 2^16 - 1), longest first, coded side by side."""
    counts = np.array([b.size for b in blocks], dtype=np.int64)
    order = np.argsort(-counts, kind="stable")
    grid = np.zeros((int(counts.max(initial=0)), len(blocks)), dtype=np.int64)
    for row, k in enumerate(order):
        grid[: counts[k], row] = blocks[k]
    sizes = counts[order]
    packed = prior_of(blocks)
    prior = Prior(packed)
    enc, model = Encoder(len(blocks), 3 * grid.shape[0] + 8), Model(len(blocks), prior)
    for t in range(grid.shape[0]):
        n = running(sizes, t)
        ids = grid[t, :n]
        model.contexts(n)
        right = model.guess == ids
        enc.put(slice(0, n), np.where(right, 0, model.chance), np.where(right, model.chance, ONE - model.chance))
        place = prior.pairs(model.last[:n], ids)
        context = prior.context_of[model.last[:n]]
        by_one = (~right & (context >= 0)).nonzero()[0]
        if by_one.size:
            p, c = place[by_one], context[by_one]
            other = prior.other[c]
            enc.put(by_one, np.where(p >= 0, prior.start1[p], other), np.where(p >= 0, prior.size1[p], (1 << NEXT_BITS) - other), NEXT_BITS)
        rest = (~right & (place < 0)).nonzero()[0]
        if rest.size:
            lost = ids[rest]
            cls = prior.class_of[lost]
            w = model.width[rest, cls]
            enc.put(rest, ((model.ends[rest, cls] - w) << PART_BITS) + prior.start0[lost] * w, prior.size0[lost] * w, 16 + PART_BITS)
            model.classes[rest, cls] += 24
        model.learn(n, ids, right, place)
    enc.finish()
    at = np.empty_like(order)
    at[order] = np.arange(order.size)
    used = enc.n - enc.first
    head = [MAGIC, np.array([len(blocks), len(packed), zlib.crc32(packed)], dtype="<u4").tobytes()]
    for k, b in enumerate(blocks):
        head.append(np.array([b.size, zlib.crc32(b.astype("<u4").tobytes()), used[at[k]]], dtype="<u4").tobytes())
    body = [enc.out[enc.first[p] : enc.n[p]].astype("<u2").tobytes() for p in at]
    return b"".join([*head, packed, *body])


def decode_blocks(payload: bytes) -> list[np.ndarray]:
    """The blocks of a stripe; a block or prior that doesn't have its checksum raises an error."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token stripe")
    lanes, size, crc = (int(x) for x in np.frombuffer(payload, dtype="<u4", count=3, offset=4))
    head = np.frombuffer(payload, dtype="<u4", count=3 * lanes, offset=16).reshape(lanes, 3).astype(np.int64)
    body = 16 + 12 * lanes + size
    packed = payload[body - size : body]
    if zlib.crc32(packed) != crc:
        raise ValueError("the prior is damaged")
    prior = Prior(packed)
    units = np.frombuffer(payload, dtype="<u2", offset=body).astype(np.uint64)
    starts = np.cumsum(head[:, 2]) - head[:, 2]
    order = np.argsort(-head[:, 0], kind="stable")
    sizes = head[order, 0]
    grid = np.zeros((int(sizes.max(initial=0)), lanes), dtype=np.int64)
    dec, model = Decoder(np.concatenate([units, np.zeros(8, dtype=np.uint64)]), starts[order]), Model(lanes, prior)
    for t in range(grid.shape[0]):
        n = running(sizes, t)
        model.contexts(n)
        right = dec.slot(slice(0, n)) < model.chance
        dec.take(slice(0, n), np.where(right, 0, model.chance), np.where(right, model.chance, ONE - model.chance))
        ids = model.guess.astype(np.int64)
        place = np.full(n, -1, dtype=np.int64)
        context = prior.context_of[model.last[:n]]
        by_one = (~right & (context >= 0)).nonzero()[0]
        if by_one.size:
            s, c = dec.slot(by_one, NEXT_BITS), context[by_one]
            other = prior.other[c]
            known = s < other
            p = np.where(known, np.searchsorted(prior.ladder1, (c << NEXT_BITS) + np.minimum(s, other - 1), side="right"), 0)
            dec.take(by_one, np.where(known, prior.start1[p], other), np.where(known, prior.size1[p], (1 << NEXT_BITS) - other), NEXT_BITS)
            place[by_one] = np.where(known, p, -1)
            ids[by_one] = prior.id1[p]
        rest = (~right & (place < 0)).nonzero()[0]
        if rest.size:
            s = dec.slot(rest, 16 + PART_BITS)
            cls = np.minimum(np.searchsorted(model.ladder, (s >> PART_BITS) + (rest << 16), side="right") - (rest << CLASS_BITS), CLASSES - 1)
            w = model.width[rest, cls]
            floor = (model.ends[rest, cls] - w) << PART_BITS
            part = np.minimum((s - floor) // w, (1 << PART_BITS) - 1)
            lost = prior.id0[np.minimum(np.searchsorted(prior.ladder0, (cls << PART_BITS) + part, side="right"), prior.id0.size - 1)]
            dec.take(rest, floor + prior.start0[lost] * w, prior.size0[lost] * w, 16 + PART_BITS)
            ids[rest] = lost
            model.classes[rest, cls] += 24
        grid[t, :n] = ids
        model.learn(n, ids, right, place)
    out = [np.zeros(0, dtype=np.int64)] * lanes
    for row, k in enumerate(order):
        out[k] = grid[: head[k, 0], row]
        if zlib.crc32(out[k].astype("<u4").tobytes()) != head[k, 1]:
            raise ValueError(f"block {k} is damaged")
    return out


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian 16-bit numbers."""
    a = array("H", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class WordIds(dict):
    """Ids of the words that one task has met, two bytes an id; emptied when full."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__()
        self.path, self.most = path, most
        _, self.added = added_tokens(path)

    def texts(self, texts: list[str | None]) -> list[bytes]:
        split = [split_words(t, self.added) for t in texts]
        new = list(set().union(*split).difference(self))
        if len(self) + len(new) > self.most:
            self.clear()
            new = list(set().union(*split))
        for w, ids in zip(new, encode_words(new, self.path), strict=True):
            self[w] = pack_ids(ids)
        return [b"".join(map(self.__getitem__, w)) for w in split]


def tokenise(path: str, end_id: int):
    """Ids of each whole text, two bytes an id, with the end id; only words not met before meet the tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = WordIds(path), pack_ids([end_id])
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo in range(0, len(texts), 500):
                ids = [x + end for x in known.texts(texts[lo : lo + 500])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, 500), pa.array([len(i) // 2 for i in ids], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return run


STRIPES = pa.schema([("part", pa.int64()), ("docs", pa.string()), ("ids", pa.int64()), ("payload", pa.binary())])


def stripe_row(part: int, docs: list[list], ids: np.ndarray) -> pa.RecordBatch:
    payload = encode_blocks([ids[k : k + BLOCK_IDS] for k in range(0, ids.size, BLOCK_IDS)])
    row = (part, json.dumps(docs), ids.size, payload)
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, STRIPES, strict=True)], schema=STRIPES)


def to_stripes(path: str, end_id: int):
    """Tokenise a sorted partition and cut its ids, in order, into stripes; the last may be shorter."""
    tokens = tokenise(path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, most = TaskContext.get().partitionId(), BLOCK_IDS * LANES
        docs: list[list] = []
        held: list[np.ndarray] = []
        size = before = place = 0
        for b in tokens(batches):
            for doc, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                ids, piece = np.frombuffer(raw, dtype="<u2").astype(np.int64), 0
                n = ids.size
                while ids.size:
                    now, ids = ids[: most - size], ids[most - size :]
                    docs.append([doc, place, before, now.size, piece, int(not ids.size)])
                    held.append(now)
                    size += now.size
                    piece += 1
                    if size == most:
                        yield stripe_row(part, docs, np.concatenate(held))
                        docs, held, size = [], [], 0
                place += 1
                before += n
        if size:
            yield stripe_row(part, docs, np.concatenate(held))
        docs, held = [], []
        release_memory()

    return run


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, the end id after each, in ascending order of the document ids.

    Texts are dealt to ranges of ids and sorted there, so one shuffle moves them and no task needs more
    than a stripe of ids. Null texts have the end id only; null ids come first; rows that repeat an id are
    written each, in order of their texts; ids are whole numbers (``round_trip`` numbers others); an empty table gives a folder without rows.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(to_stripes(path, end_id), "part long, docs string, ids long, payload binary").write.mode("overwrite").parquet(folder)


PIECES = pa.schema([("part", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("piece", pa.int64()), ("ids", pa.binary())])
PIECES_SQL = "part long, place long, doc_id long, before long, n_tokens long, ids_crc32 long, piece long, ids binary"


def read_pieces(with_ids: bool):
    """Decode stripes; a document that is whole in its stripe is done, of others the ids go on (32-bit little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, listed, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                ids = np.concatenate(decode_blocks(payload)).astype("<u4")
                rows, at = [], 0
                for doc, place, before, n, piece, last in json.loads(listed):
                    raw = ids[at : at + n].tobytes()
                    at += n
                    whole = last and not piece
                    rows.append((part, place, doc, before, n, zlib.crc32(raw), piece, None if whole and not with_ids else raw))
                for lo in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows[lo : lo + 2000], strict=True), PIECES, strict=True)], schema=PIECES)

    return run


def joined_pieces(g: pd.DataFrame) -> pd.DataFrame:
    """One document of several stripes."""
    g = g.sort_values("piece", kind="stable")
    crc = 0
    for raw in g["ids"]:
        crc = zlib.crc32(raw, crc)
    first = g.iloc[0]
    return pd.DataFrame({"part": [first["part"]], "doc_id": pd.array([first["doc_id"]], dtype="Int64"), "before": [first["before"]], "n_tokens": [int(g["n_tokens"].sum())], "ids_crc32": [crc]})


def read_digests(spark, folder: str, few_parts: int = 100_000) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files, decoded; a damaged block raises an error.

    The ids before a part are sums over a table with one row a stripe; up to ``few_parts`` parts (16 bytes
    each) that table is broadcast. Only documents that were cut are grouped, one row each in the end.
    """
    stripes = spark.read.schema("part long, docs string, ids long, payload binary").parquet(folder)
    parts = stripes.groupBy("part").agg(F.sum("ids").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    if stripes.select("part").distinct().count() <= few_parts:
        parts = F.broadcast(parts)
    pieces = Scratch(spark, "token-pieces").table(stripes.mapInArrow(read_pieces(False), PIECES_SQL), "pieces")
    whole = pieces.where("ids is null").select("part", "doc_id", "before", "n_tokens", "ids_crc32")
    cut = pieces.where("ids is not null").groupBy("part", "place").applyInPandas(joined_pieces, "part long, doc_id long, before long, n_tokens long, ids_crc32 long")
    return whole.unionByName(cut).join(parts, "part").select("doc_id", (F.col("before") + F.col("ahead")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of ``docs`` and read their digests back from the files; document ids of another type are numbered in their order on the way."""
    folder = Scratch(docs.sparkSession, "tokens").path("ids")
    (rows,), names = as_numbers("doc_id", docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    write_tokens(rows, folder, path, end_id)
    return named(read_digests(docs.sparkSession, folder), names, "doc_id")
