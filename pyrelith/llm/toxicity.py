"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

The label model says how a text's votes come about: a class, and for each voter the chance that it votes given the
class and given whether its parent, the voter that it goes with most, has voted. Chances are accuracies; how far
they differ by the parent is the correlation. EM estimates them from the votes on all training texts, most of
which have no label; a label, where there is one, is one more voter of a fixed high accuracy, and starts the model. The classifier
learns the posteriors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.runtime import Scratch, text_batches

WORD = re.compile(r"[^\W\d_]+")
#: Common English insults, the voters that need no labels.
SEED_LEXICON = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
STEMS = (4, 5, 6, 7)
#: Words remembered by one worker before its memory is emptied.
REMEMBERED = 400_000
PATTERNS = ("two different insults", "an insult in a hundred words", "no insult", "a third of the words in capitals")


@dataclass
class Lexicon:
    """Whole words and stems (first letters of a word); each is a voter."""

    words: dict[str, int]
    stems: dict[str, int]
    names: list[str]
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict)

    @classmethod
    def of(cls, names: list[str]) -> Lexicon:
        """Names that end in ``*`` are stems."""
        return cls({n: i for i, n in enumerate(names) if n[-1] != "*"}, {n[:-1]: i for i, n in enumerate(names) if n[-1] == "*"}, names)

    def entries(self, word: str) -> tuple[int, ...]:
        got = self.seen.get(word)
        if got is None:
            found = [self.words[word]] if word in self.words else []
            found += [self.stems[s] for k in STEMS if (s := word[:k]) in self.stems and len(word) >= k]
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
            got = self.seen[word] = tuple(found)
        return got

    def features(self, text: str | None) -> tuple[list[int], int, float, bool]:
        """Entries found, number of different insulting words, their share of all different words, shouting; of the whole text."""
        words = WORD.findall(text or "")
        different = {w.lower() for w in set(words)}
        hits: set[int] = set()
        insults = 0
        for w in different:
            if e := self.entries(w):
                hits.update(e)
                insults += 1
        loud = sum(1 for w in set(words) if len(w) > 3 and w.isupper())
        return sorted(hits), insults, insults / max(1, len(different)), bool(different) and loud * 3 > len(different)


def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and other texts of a partition have each word and each stem."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for b in batches:
        for text, toxic in zip(b["text"], b["toxic"], strict=True):
            words = {w.lower() for w in WORD.findall(text or "")}
            found = words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}
            counts[int(toxic)].update(found)
        if sum(map(len, counts)) > 500_000:
            yield emit(counts)
            counts = (Counter(), Counter())
    yield emit(counts)


def emit(counts: tuple[Counter, Counter]) -> pd.DataFrame:
    keys = list(counts[0].keys() | counts[1].keys())
    return pd.DataFrame({"term": pd.Series(keys, dtype=object), "clean": np.array([counts[0][k] for k in keys], dtype=np.int64), "toxic": np.array([counts[1][k] for k in keys], dtype=np.int64)})


def induce(counts: list[tuple[str, int, int]], n_clean: int, n_toxic: int, least: int, lift: float, most: int) -> list[str]:
    """Terms that mark toxic texts: a whole word or stem in at least ``least`` of them, ``lift`` times as often as elsewhere.

    Stems and the words under them overlap; the label model discounts voters that go together.
    """
    scored = []
    for term, clean, toxic in counts:
        ratio = (toxic + 0.5) / (n_toxic + 1) / ((clean + 0.5) / (n_clean + 1))
        if toxic >= least and ratio >= lift:
            scored.append((-toxic * math.log(ratio), term))
    return [t for _, t in sorted(scored)[:most]]


def votes(found: list[tuple[list[int], int, float, bool]], n_lexicon: int) -> np.ndarray:
    """Texts x voters: 1 toxic, -1 not, 0 no vote. The pattern voters follow the lexicon's."""
    v = np.zeros((len(found), n_lexicon + len(PATTERNS)), dtype=np.int8)
    for i, (hits, insults, share, loud) in enumerate(found):
        v[i, hits] = 1
        v[i, n_lexicon] = 1 if insults >= 2 else 0
        v[i, n_lexicon + 1] = 1 if share >= 0.01 else 0
        v[i, n_lexicon + 2] = -1 if not insults else 0
        v[i, n_lexicon + 3] = 1 if loud else 0
    return v


#: Accuracy of a given label as a voter.
LABEL_ACCURACY = 0.98


@dataclass
class LabelModel:
    """Chances to vote by class (rows: not toxic, toxic) and by the parent's vote; ``parent`` is -1 for voters without one."""

    prior: float
    parent: np.ndarray
    alone: np.ndarray  # 2 x voters: chance to vote where the parent hasn't, or there is none
    along: np.ndarray  # 2 x voters: where the parent has

    def with_parents(self, fired: np.ndarray) -> np.ndarray:
        """For each voter 1 where its parent has voted."""
        return np.where(self.parent >= 0, fired[:, np.maximum(self.parent, 0)], 0.0)

    def log_odds(self, fired: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Of each row of votes (0 or 1) that the text is toxic; labels are 0, 1 or -1 for none."""
        up = self.with_parents(fired)
        yes, no = np.log(self.alone), np.log1p(-self.alone)
        yes_up, no_up = np.log(self.along), np.log1p(-self.along)
        d = [x[1] - x[0] for x in (no, yes - no, no_up - no, yes_up - yes - no_up + no)]
        z = d[0].sum() + fired @ d[1] + up @ d[2] + (fired * up) @ d[3]
        known = np.where(label >= 0, (2 * label - 1) * math.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY)), 0.0)
        return z + math.log(self.prior / (1 - self.prior)) + known

    def posterior(self, fired: np.ndarray, label: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(fired, label), -30, 30)))

    def sums(self, fired: np.ndarray, post: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the next estimate needs: for each voter (and a last column for the texts) the weight of its votes, of those
        along with its parent's, and the toxic part of both."""
        both = fired * self.with_parents(fired)
        w = np.stack([weight, weight, weight * post, weight * post])
        out = np.empty((4, fired.shape[1] + 1))
        out[0, :-1], out[1, :-1], out[2, :-1], out[3, :-1] = w[0] @ fired, w[1] @ both, w[2] @ fired, w[3] @ both
        out[:, -1] = w.sum(axis=1)
        return out

    def estimated(self, sums: np.ndarray, smooth: float = 0.5) -> LabelModel:
        """The chances that these sums say."""
        n, n1 = sums[0, -1], sums[2, -1]
        alone, along = np.empty_like(self.alone), np.empty_like(self.along)
        for y, (votes, both, texts) in enumerate(((sums[0] - sums[2], sums[1] - sums[3], n - n1), (sums[2], sums[3], n1))):
            up = np.where(self.parent >= 0, votes[np.maximum(self.parent, 0)], 0.0)
            along[y] = (both[:-1] + smooth) / (up + 2 * smooth)
            alone[y] = (votes[:-1] - both[:-1] + smooth) / (texts - up + 2 * smooth)
        limits = (1e-6, 1 - 1e-6)
        return LabelModel(float(np.clip((n1 + 1) / (n + 2), 1e-3, 0.9)), self.parent, np.clip(alone, *limits), np.clip(along, *limits))


def parents_of(fired: np.ndarray, toxic: np.ndarray, least_evidence: float = 20.0) -> np.ndarray:
    """A forest over the voters: the strongest ties, by mutual information given the class, that make no cycle.

    Ties whose evidence (twice the texts times the information, as in a likelihood-ratio test) is below the bound are none.
    """
    m = fired.shape[1]
    info = np.zeros((m, m))
    for y in (0, 1):
        v = fired[toxic == y]
        if not len(v):
            continue
        n = len(v)
        both, one = v.T @ v, v.sum(axis=0)
        for i in (0, 1):
            for j in (0, 1):
                c = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both, (0, 0): n - one[:, None] - one[None, :] + both}[i, j]
                a = one if i else n - one
                b = one if j else n - one
                with np.errstate(divide="ignore", invalid="ignore"):
                    info += np.where(c > 0, c * np.log(c * n / np.maximum(np.outer(a, b), 1e-300)), 0.0)
    info = 2 * info
    np.fill_diagonal(info, 0)
    parent = np.full(m, -1)
    left = np.ones(m, dtype=bool)
    while left.any():  # one tree after another, grown by its strongest tie
        root = int(np.flatnonzero(left)[info[left].sum(axis=1).argmax()])
        left[root] = False
        best, of = info[root].copy(), np.full(m, root)
        while left.any():
            k = int(np.where(left, best, -1).argmax())
            if best[k] < least_evidence:
                break
            parent[k], left[k] = of[k], False
            closer = info[k] > best
            best, of = np.where(closer, info[k], best), np.where(closer, k, of)
    return parent


def start_model(n_lexicon: int, seeds: list[int]) -> LabelModel:
    """Without labels: seeds and patterns mark toxic texts, no insult marks the others."""
    m = n_lexicon + len(PATTERNS)
    alone = np.full((2, m), 0.01)
    alone[1] = 0.05
    alone[1, seeds] = 0.2
    alone[:, n_lexicon:] = [[0.01, 0.02, 0.9, 0.02], [0.4, 0.6, 0.05, 0.05]]
    return LabelModel(0.1, np.full(m, -1), alone, alone.copy())


def label_model(fired: np.ndarray, label: np.ndarray, start: LabelModel, weight: np.ndarray | None = None, rounds: int = 30) -> LabelModel:
    """EM in memory; ``fit`` does the same with the sums of each round taken by Spark."""
    weight = np.ones(len(fired)) if weight is None else weight
    model = start
    for _ in range(rounds):
        new = model.estimated(model.sums(fired, model.posterior(fired, label), weight))
        if settled(model, new):
            return new
        model = new
    return model


def settled(old: LabelModel, new: LabelModel, change: float = 1e-4) -> bool:
    return max(abs(old.prior - new.prior), np.abs(old.alone - new.alone).max(initial=0), np.abs(old.along - new.along).max(initial=0)) < change


def design(found: list[tuple[list[int], int, float, bool]], n_lexicon: int) -> np.ndarray:
    """Classifier inputs: one column a lexicon entry, then log of insults, their share, none at all, shouting, 1."""
    x = np.zeros((len(found), n_lexicon + 5), dtype=np.float64)
    for i, (hits, insults, share, loud) in enumerate(found):
        x[i, hits] = 1
        x[i, n_lexicon:] = (math.log1p(insults), min(1.0, 50 * share), not insults, loud, 1)
    return x


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 50) -> np.ndarray:
    """Newton steps for ridge logistic regression on soft labels."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


FEATURES = "hits array<int>, insults int, share double, loud boolean"


def with_features(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with what the voters and the classifier read, in place of ``text``; every whole text is read once."""
    keep = [c for c in rows.columns if c != "text"]
    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon.of(names)
        for b in batches:
            f = [lex.features(t) for t in b.column("text").to_pylist()]
            cols = zip(*f, strict=True) if f else ((), (), (), ())
            types = (pa.list_(pa.int32()), pa.int32(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], names=[*keep, "hits", "insults", "share", "loud"])

    return rows.mapInArrow(run, kinds + FEATURES)


def fired_votes(b: pd.DataFrame, n_lexicon: int) -> np.ndarray:
    """Texts x voters of a table of features: 1 where a voter votes, the one against toxicity too."""
    found = list(zip(b["hits"], b["insults"], b["share"], b["loud"], strict=True))
    return (votes(found, n_lexicon) != 0).astype(np.float64)


def estimate(patterns: DataFrame, start: LabelModel, n_lexicon: int, rounds: int) -> LabelModel:
    """EM over ``patterns`` (features, ``label`` or -1, ``n``): a round is one pass that returns four sums a voter."""
    model, spark = start, patterns.sparkSession
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            total = None
            for b in batches:
                for lo in range(0, len(b), 2000):
                    part = b.iloc[lo : lo + 2000]
                    fired, label = fired_votes(part, n_lexicon), part["label"].to_numpy()
                    s = held.value.sums(fired, held.value.posterior(fired, label), part["n"].to_numpy(np.float64))
                    total = s if total is None else total + s
            if total is not None:
                yield pd.DataFrame(total.T, columns=["s0", "s1", "s2", "s3"]).assign(voter=np.arange(total.shape[1]))

        got = patterns.mapInPandas(run, "s0 double, s1 double, s2 double, s3 double, voter int").groupBy("voter").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(4)]).orderBy("voter").collect()
        held.unpersist()
        if not got:
            return model
        new = model.estimated(np.array([[r[f"s{k}"] for r in got] for k in range(4)]))
        if settled(model, new):
            return new
        model = new
    return model


def induced_names(sample: DataFrame, n0: int, n1: int, least: int, lift: float, most_terms: int) -> list[str]:
    """The seed lexicon and the terms that mark toxic texts of the labelled sample."""
    counts = sample.mapInPandas(candidates, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counts.where((F.col("toxic") >= least) & (F.col("toxic") * (n0 + 1) >= lift / 2 * (F.col("clean") + 0.5) * (n1 + 1)))
    ranked = counts.orderBy(F.desc(F.col("toxic") / (F.col("clean") + 0.5)), F.desc("toxic"), "term").limit(20 * most_terms)
    terms = induce([(r.term, r.clean, r.toxic) for r in ranked.collect()], n0, n1, least, lift, most_terms)
    return sorted({*SEED_LEXICON, *terms})


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def detect(docs: DataFrame, labels: DataFrame, most_texts: int = 20_000, least: int = 5, lift: float = 8.0, most_terms: int = 400, ridge: float = 1.0, rounds: int = 12, threshold: float = 0.3) -> DataFrame:
    """Learn from rows that aren't held out and score all of ``docs``: ``(doc_id, held_out, score, predicted)``.

    The lexicon, the voters' ties and the classifier come from a bounded sample of labelled rows: the ``most_texts`` ids with the smallest
    hash, one text each (the first in order of several). The label model is estimated on the votes on all rows that
    aren't held out, labelled or not; equal votes are counted once with their number. Texts are read once for the lexicon (the sample) and
    once for the features (all).

    Null and empty texts get the score of a text without insults. A null id is held out. Rows that repeat are scored each; a label of an
    id that has several is the largest; labels other than 0 and 1 are none, as are those of ids that are none of ``docs``' kind. Without labels the seed lexicon and the patterns remain, at a
    first prior of one in ten. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    text_batches(spark)
    scratch = Scratch(spark, "toxicity")
    kind = docs.schema["doc_id"].dataType
    known = labels.select(F.col("doc_id").try_cast(kind).alias("doc_id"), "toxic").where(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    few = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(most_texts)
    sample = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = scratch.table(sample.select("text", "toxic"), "sample")
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    names = induced_names(sample, n0, n1, least, lift, most_terms)
    n_lexicon = len(names)
    rows = sorted((list(r.hits), r.insults, r.share, r.loud, r.toxic) for r in with_features(sample, names).collect())
    found, toxic = [tuple(r[:4]) for r in rows], np.array([r[4] for r in rows], dtype=np.int64)

    features = scratch.table(with_features(docs.select("doc_id", held_out().alias("held_out"), "text"), names), "features")
    start = start_model(n_lexicon, [k for k, n in enumerate(names) if n in SEED_LEXICON])
    if n0 and n1:
        fired = (votes(found, n_lexicon) != 0).astype(np.float64)
        start.parent = parents_of(fired, toxic)
        start = start.estimated(start.sums(fired, toxic.astype(np.float64), np.ones(len(fired))))
    train = features.where(~F.col("held_out")).join(known, "doc_id", "left")
    near = F.round(F.least("share", F.lit(0.02)), 6).alias("share")
    patterns = train.groupBy("hits", F.least("insults", F.lit(2)).alias("insults"), near, "loud", F.coalesce("toxic", F.lit(-1)).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    model = estimate(scratch.table(patterns, "patterns"), start, n_lexicon, rounds)
    if not found:  # the classifier learns what the label model says of single votes
        found = [([k], 1, 0.02, False) for k in range(n_lexicon)] + [([], 0, 0.0, False)] * 9 * n_lexicon
        toxic = np.full(len(found), -1)
    post = model.posterior((votes(found, n_lexicon) != 0).astype(np.float64), toxic)
    held = spark.sparkContext.broadcast(logistic(design(found, n_lexicon), post, ridge))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = design(list(zip(b["hits"], b["insults"], b["share"], b["loud"], strict=True)), n_lexicon)
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": 1 / (1 + np.exp(-np.clip(x @ held.value, -30, 30)))})

    out = features.mapInPandas(score, f"doc_id {kind.simpleString()}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
