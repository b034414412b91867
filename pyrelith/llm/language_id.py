"""Language ID with a string kernel: n-gram presence, Nystroem landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of character n-grams (1 to 3, a blended spectrum) that both have,
over the geometric mean of how many each has. Landmarks are training texts; a text's features are its
kernels with them, times the inverse root of the landmarks' own kernel matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.runtime import release_memory, text_batches

SYMBOLS = 128
DIMS = SYMBOLS + SYMBOLS**2 + SYMBOLS**3
UNKNOWN = "und"
#: Texts scored by one matrix product.
BATCH = 128
#: Sampled texts whose kernels are taken at once.
PIECE = 512


def symbol_table(size: int = 0x11000) -> np.ndarray:
    """Code point to symbol: 0 is no letter, 1 to 26 are a to z in either case, other letters are hashed to the rest by their lower-case code."""
    table = np.zeros(size, dtype=np.int32)
    for cp in range(size):
        low = chr(cp).lower()
        if chr(cp).isalpha():
            c = ord(low[0])
            table[cp] = c - 96 if 97 <= c <= 122 else 27 + (c * 2654435761 >> 16) % (SYMBOLS - 27)
    return table


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """The symbols of a whole text; letters beyond the table are hashed as well."""
    if not _TABLE:
        _TABLE.append(symbol_table())
    table = _TABLE[0]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if codes.size and codes.max() >= table.size:
        far = codes >= table.size
        out = table[np.where(far, 0, codes)]
        out[far] = [27 + (ord(chr(c).lower()[0]) * 2654435761 >> 16) % (SYMBOLS - 27) if chr(c).isalpha() else 0 for c in codes[far].tolist()]
        return out
    return table[codes]


def mark(s: np.ndarray, bitmap: np.ndarray) -> None:
    """Set the places of the n-grams of ``s``."""
    bitmap[s] = True
    if s.size > 1:
        two = s[:-1] * SYMBOLS + s[1:]
        bitmap[two + SYMBOLS] = True
        if s.size > 2:
            bitmap[two[:-1] * SYMBOLS + s[2:] + (SYMBOLS + SYMBOLS**2)] = True


@dataclass
class Model:
    """Everything that scoring needs; its size is set by the number of landmarks and ``vocabulary``."""

    langs: list[str]
    vocabulary: np.ndarray  # places of n-grams that some landmark has
    landmarks: np.ndarray  # vocabulary x landmarks, presence over the root of each landmark's n-gram count
    weights: np.ndarray  # landmarks + 1 x langs

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        return [(lang, score) for lang, score, _, _ in self.measure(texts)]

    def measure(self, texts: list[str | None]) -> list[tuple[str, float, float, float]]:
        """Of each text the language, its score, how far its regression lies above the second language's, and the share of the text's n-grams that landmarks have."""
        out: list[tuple[str, float, float, float]] = [(UNKNOWN, 0.0, 0.0, 0.0)] * len(texts)
        rows = [(i, s) for i, t in enumerate(texts) if t and (s := symbols(t)).any()]
        if not rows or not self.langs:
            return out
        bitmap = np.zeros(DIMS, dtype=bool)
        x = np.zeros((len(rows), self.vocabulary.size), dtype=np.float32)
        share = np.zeros(len(rows))
        for k, (_, s) in enumerate(rows):
            bitmap[:] = False
            mark(s, bitmap)
            grams = np.count_nonzero(bitmap)
            x[k] = bitmap[self.vocabulary]
            share[k] = np.count_nonzero(x[k]) / grams
            x[k] /= np.sqrt(grams)
        k = x @ self.landmarks
        f = np.hstack([k, np.ones((len(rows), 1), dtype=np.float32)]) @ self.weights
        best = f.argmax(axis=1)
        score = np.clip((f[np.arange(len(rows)), best] + 1) / 2, 0, 1)
        top = np.sort(f, axis=1)
        margin = top[:, -1] - top[:, -2] if len(self.langs) > 1 else np.zeros(len(rows))
        for (i, _), b, v, m, c in zip(rows, best, score, margin, share, strict=True):
            out[i] = (self.langs[b], float(v), float(m), float(c))
        return out


def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The n-grams of training texts, as sorted places."""
    bitmap = np.zeros(DIMS, dtype=bool)
    for b in batches:
        rows = []
        for lang, text in zip(b["lang"], b["text"], strict=True):
            bitmap[:] = False
            mark(symbols(text), bitmap)
            rows.append((lang, np.flatnonzero(bitmap).astype(np.int32).tobytes()))
        yield pd.DataFrame(rows, columns=["lang", "grams"])
    release_memory()


def fit(train: DataFrame, per_lang: int = 250, landmarks: int = 96, least_uses: int = 4, ridge: float = 1e-2) -> Model:
    """Fit on a bounded sample of ``train(doc_id, text, lang)``: ``per_lang`` texts of each language.

    The sample is the rows with the smallest hash of their id (of an id's rows in one language the first text in order), so it
    depends neither on the order of the rows nor on their partitions; every language that has such a row is learned. The driver
    holds the n-grams of the sample (some kilobytes a text) and kernels in pieces of ``PIECE`` texts. An n-gram
    is part of a landmark's spectrum if ``least_uses`` sampled texts have it. Without usable rows the
    model answers ``und`` to everything.
    """
    from pyspark.sql import Window

    rows = train.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64(F.col("doc_id").cast("string")))
    picked = rows.select("lang", "h").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= per_lang).select("lang", "h").distinct()
    sample = rows.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text").mapInPandas(presence, "lang string, grams binary").collect()
    sample = sorted((r.lang, bytes(r.grams)) for r in sample)
    if not sample:
        return Model([], np.zeros(0, dtype=np.int64), np.zeros((0, 0), dtype=np.float32), np.zeros((1, 0), dtype=np.float32))
    langs = sorted({x for x, _ in sample})
    grams = [np.frombuffer(g, dtype=np.int32) for _, g in sample]
    y = np.array([langs.index(x) for x, _ in sample])
    uses = np.bincount(np.concatenate(grams), minlength=DIMS)
    # landmarks: of each language in turn, those with the most n-grams
    order = [sorted(np.flatnonzero(y == c), key=lambda i: (-grams[i].size, i)) for c in range(len(langs))]
    chosen: list[int] = []
    for k in range(max(map(len, order))):
        chosen += [o[k] for o in order if k < len(o)]
    chosen = chosen[: max(landmarks, 2 * len(langs))]
    spectrum = np.zeros(DIMS, dtype=bool)
    for i in chosen:
        spectrum[grams[i]] = True
    spectrum &= uses >= min(least_uses, len(sample))
    vocabulary = np.flatnonzero(spectrum)
    place = np.full(DIMS, -1)
    place[vocabulary] = np.arange(vocabulary.size)

    def rows_of(ix) -> np.ndarray:
        x = np.zeros((len(ix), vocabulary.size), dtype=np.float32)
        for k, i in enumerate(ix):
            p = place[grams[i]]
            x[k, p[p >= 0]] = 1 / np.sqrt(max(1, grams[i].size))
        return x

    z = rows_of(chosen).T
    kmm = (z.T @ z).astype(np.float64)
    val, vec = np.linalg.eigh(kmm)
    keep = val > 1e-6 * val.max()
    root = vec[:, keep] / np.sqrt(val[keep])
    kernels = [rows_of(range(k, min(k + PIECE, len(sample)))) @ z for k in range(0, len(sample), PIECE)]
    phi = np.hstack([np.concatenate(kernels) @ root, np.ones((len(sample), 1))])
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    share = np.bincount(y, minlength=len(langs))
    v = (len(sample) / (len(langs) * share))[y]  # every language weighs the same
    w = np.linalg.solve(phi.T @ (phi * v[:, None]) + ridge * np.eye(phi.shape[1]), phi.T @ (target * v[:, None]))
    weights = np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32)
    return Model(langs, vocabulary, z.astype(np.float32), weights)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row; null texts and texts without a letter get ``und`` and 0.

    The score is (f + 1) / 2 of the winning language's regression, cut to 0 and 1. Ties go to the
    language that sorts first. Rows that repeat are scored each; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = held.value
        for b in batches:
            texts = list(b["text"])
            got: list[tuple[str, float]] = []
            for k in range(0, len(texts), BATCH):
                got += m.predict(texts[k : k + BATCH])
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": [x for x, _ in got], "score": [v for _, v in got]})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(score, f"doc_id {kind}, lang_pred string, score double")


#: Steps of a unit in which margins and shares are counted.
STEPS = 1000


def cuts(docs: DataFrame, model: Model, below_margin: float = 0.05, below_share: float = 0.005) -> tuple[float, float]:
    """``(margin, share)`` that all but these parts of the rows of ``docs(text, lang)`` reach whose language is told rightly.

    Every row is measured and counted by its rounded values, so little moves. Without such rows both are -1.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[int, int], int] = {}
        for b in batches:
            texts, langs = list(b["text"]), list(b["lang"])
            for k in range(0, len(texts), BATCH):
                for want, (lang, _, margin, share) in zip(langs[k : k + BATCH], held.value.measure(texts[k : k + BATCH]), strict=True):
                    if lang == want and lang != UNKNOWN:
                        for key in ((0, int(np.floor(margin * STEPS))), (1, int(np.floor(share * STEPS)))):
                            found[key] = found.get(key, 0) + 1
        yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["what", "at", "n"]).astype("int64")
        release_memory()

    counts = docs.select("text", "lang").mapInPandas(run, "what long, at long, n long").groupBy("what", "at").agg(F.sum("n").alias("n")).collect()
    out = []
    for what, part in ((0, below_margin), (1, below_share)):
        rows = sorted((r["at"], r["n"]) for r in counts if r["what"] == what)
        below, total = 0, sum(n for _, n in rows)
        at = -STEPS
        for at, n in rows:
            below += n
            if below > part * total:
                break
        out.append(at / STEPS)
    return out[0], out[1]


def keep_identified(docs: DataFrame, below_margin: float = 0.05, below_share: float = 0.005, **options) -> DataFrame:
    """The rows of ``docs`` whose language is known, all columns as they were.

    Rejected are rows that get ``und`` (null or letterless texts) and those of no learned language. The winning
    regression alone can't tell these: K regressions add up to 2 - K for every text, so one always is at
    least (2 - K) / K. What tells them is that no language stands out and that many n-grams are new: rows go
    whose margin to the second language and whose share of known n-grams are both below what rightly told
    held-out rows have, but for ``below_margin`` and ``below_share`` of them; all of these rows are measured.
    So at most about ``below_share`` of texts in a learned language can go. Without a held-out row nothing else is
    rejected. Rows pass as Arrow batches, so no value changes.
    """
    import pyarrow as pa

    text_batches(docs.sparkSession)
    known = docs.where(~F.coalesce(held_out(), F.lit(True))).select("doc_id", "text", "lang")
    model = fit(known, **options)
    least_margin, least_known = cuts(docs.where(held_out() & F.col("lang").isNotNull()), model, below_margin, below_share)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            keep = []
            for k in range(0, len(texts), BATCH):
                # a margin of 0 is that of a model with one language, where the share decides
                keep += [lang != UNKNOWN and (share >= least_known or margin > 0 and margin >= least_margin) for lang, _, margin, share in held.value.measure(texts[k : k + BATCH])]
            yield b.filter(pa.array(keep, pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def identify(docs: DataFrame, **options) -> DataFrame:
    """Learn from the rows of ``docs(doc_id, text, lang)`` that aren't held out and predict all of them.

    ``(doc_id, held_out, lang_pred, score)``. A null id is held out.
    """
    text_batches(docs.sparkSession)
    out = F.coalesce(held_out(), F.lit(True))
    model = fit(docs.where(~out).select("doc_id", "text", "lang"), **options)
    return predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
