"""Mixing, exact dedup, chat formatting, top-k search: DuckDB twins, brute force and odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pyrelith.llm import chat_format, exact_dedup, mixing, topk_search
from pyrelith.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import check

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
QUIET = {"deadline": None, "suppress_health_check": list(HealthCheck)}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, sf, name):
    check(spark, sf, QUERIES[name], ORACLE_SQL[name])


def odd_documents(spark):
    rows = [(1, "a  b", "en", "s", 4), (1, "a  b", "en", "s", 4), (2, "a\tb", None, None, None), (None, "q", "en", "s", 1), (4, None, "en", "t", None), (5, "", "en", "t", 0), (6, "a b", "en", "s", 3), (None, "q", None, "s", 1)]
    return spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("mine")).withColumn("size", F.lit(1)).withColumn("keys", F.lit(2)).withColumn("target", F.lit(3))


def test_chunks_come_again_after_an_inserted_passage(spark):
    rng = random.Random(5)
    scripts = ["".join(rng.choice(a) for _ in range(30_000)) for a in ([chr(c) for c in range(0x4E00, 0x9000)], [chr(c) for c in range(0x410, 0x450)] + [" "] * 8, list("0123456789") + [" "] * 3, list("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + [" "] * 6)]
    rows = [(i, t) for i, text in enumerate(scripts) for t in (text, text[:9000] + " an inserted passage " + text[9000:])]
    got = {}
    for r in exact_dedup.recipes(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append(r.keys)
    for one, two in got.values():
        assert len(one) > 10 and len(set(one) & set(two)) >= 0.6 * len(one)  # cuts that are known again, not every one at once


def test_exact_dedup_odd_rows(spark):
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(odd_documents(spark).where("doc_id is not null")).collect())
    assert got == [(1, 1, 4, False), (1, 1, 4, True), (2, 1, 4, False), (4, 4, 2, True), (5, 4, 2, False), (6, 1, 4, False)]
    both = [r for r in exact_dedup.exact_dedup(odd_documents(spark)).collect() if r.doc_id is None]
    assert sorted(r.kept for r in both) == [False, True] and both[0].group_size == 2
    assert exact_dedup.exact_dedup(odd_documents(spark).limit(0)).count() == 0
    left = exact_dedup.drop_exact_copies(odd_documents(spark))
    assert left.columns == odd_documents(spark).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == [(False, 1), (False, 4), (True, 0)]


def test_different_texts_of_one_id_stay(spark):
    rows = [(1, "a b"), (1, "a  b"), (1, "c"), (2, "c"), (2, "d"), (None, "e"), (None, "f"), (None, "f"), (None, "a b"), (3, None), (3, "g"), (4, "h"), (5, "h")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted((r.doc_id or 0, " ".join((r.text or "").split())) for r in exact_dedup.drop_exact_copies(d.repartition(3)).collect())
    assert left == [(0, "e"), (0, "f"), (1, "a b"), (1, "c"), (2, "d"), (3, ""), (3, "g"), (4, "h")]


@settings(max_examples=6, **QUIET)
@given(st.lists(st.text(alphabet="ab \t\nxy", max_size=60), max_size=12), st.sampled_from([2, 6, 64]))
def test_exact_dedup_against_text(spark, texts, bits):
    """Short chunks and keys of few bits, so that keys collide and ranks decide."""
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.text_sha256) for r in exact_dedup.exact_dedup(d, least=2, most=5, key_bits=bits).collect()}
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in texts]
    assert got == {i: (norm.index(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(norm)}


def test_chunks_cover_the_text(spark):
    rng = random.Random(1)
    text = " ".join(rng.choice(["thorns", "a", "and", "längst", "\n"]) for _ in range(4000)) + "x" * 20_000
    r = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all("t", F.lit(exact_dedup.chunk_pattern(600, 6000)), F.lit(0))).first()[0]
    assert "".join(r) == text and max(map(len, r)) <= 6003 and len(r) > 10


def test_mixing_odd_rows_and_bucket_size(spark):
    d = odd_documents(spark)
    rows = [tuple(r) for r in mixing.mix_plan(d).collect()]
    assert len(rows) == 8
    sizes = {r[1]: r[3] for r in rows}
    assert sizes == {None: 2, "s": 8, "t": 0}
    for s, total in sizes.items():
        mine = [r for r in rows if r[1] == s]
        assert sum(r[5] for r in mine) == int(mine[0][4]) and all(r[5] <= 2 * r[2] for r in mine)
    assert mixing.mix_plan(d.limit(0)).count() == 0
    rng = random.Random(4)
    many = spark.createDataFrame([(i, " ".join("w" * rng.randrange(1, 40)), f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    a = sorted(map(tuple, mixing.mix_plan(many).collect()))
    assert a == sorted(map(tuple, mixing.mix_plan(many.repartition(7), rows_per_bucket=3).collect()))
    mixed = mixing.mix_documents(many)
    words = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(mixing.word_count("text")).alias("n")).collect()}
    assert words == {s: sum(r[5] for r in a if r[1] == s) for s in words} and mixed.columns == many.columns


@settings(max_examples=25, **QUIET)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets_are_filled_by_weight(spark, sizes):
    d = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(d).collect()}
    weight = {f"s{i}": (5, 2, 1)[i % 3] for i in range(len(sizes))}
    cap = {f"s{i}": 2.0 * s for i, s in enumerate(sizes)}
    left, live, want = 1.5 * sum(sizes), set(cap), {}
    while live:
        share = {s: left * weight[s] / sum(weight[x] for x in live) for s in live}
        over = {s for s in live if share[s] > cap[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = cap[s]
            left -= cap[s]
        live -= over
    assert got == {s: pytest.approx(v) for s, v in want.items()}


def test_chat_formatting_cases(spark):
    turns = [(0, 0, "system", "s"), (0, 1, "user", "u"), (0, 2, "assistant", "yes"), (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "no"), (1, 3, "user", None), (2, 0, "user", "alone"), (5, 0, "user", "only rejected"), (6, 0, "user", "same"), (7, 0, "user", "same"), (None, 0, "user", "x")]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("at", F.lit(1)).withColumn("piece", F.lit(2))
    got = {r.pair_id: r for r in chat_format.neighbouring_pairs(d).collect()}
    assert set(got) == {0, 1, 2, 3}
    r = got[0]
    assert r.prompt == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n" and r.prompt_turns == 2
    a, b = (int(x) for x in r.chosen_spans.split("-"))
    assert r.chosen[a:b] == "yes<|im_end|>"
    a, b = (int(x) for x in r.rejected_spans.split("-"))
    assert r.rejected[a:b] == "no<|im_end|>" and r.rejected.endswith("<|im_start|>user\n<|im_end|>\n")
    assert (got[1].chosen_id, got[1].rejected_id, got[1].prompt_turns, got[1].rejected) == (2, None, 0, "")
    assert (got[2].chosen_id, got[2].rejected_id) == (None, 5) and "only rejected" in got[2].rejected
    assert (got[3].prompt_turns, got[3].chosen, got[3].rejected) == (1, "", "")
    assert chat_format.neighbouring_pairs(d.limit(0)).count() == 0


def brute(rows, queries, k):
    ints = [(i, np.floor(1024 * np.array(v, dtype=np.float64)).astype(object)) for i, v in rows]
    own = dict(reversed(ints))
    out = {}
    for q in queries:
        best = sorted(((-int(own[q] @ v), i) for i, v in ints if i != q))[:k]
        out[q] = [(i, -s) for s, i in best]
    return out


def test_topk_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(400, 6)).round(1)
    v[100:140] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(900, None), (901, [None] * 6), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6)]
    d = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = topk_search.exact_topk(d, d.where("vec_id % 7 = 0"), 10, shard_rows=60, block=9, fanout=4, leaf=8).collect()
    f32 = [(i, np.array(x, dtype=np.float32)) for i, x in rows + rows[:3]]  # rows that repeat are candidates each
    want = brute(f32, range(0, 400, 7), 10)
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == want
    assert topk_search.exact_topk(d.limit(0), d).count() == 0
    few = topk_search.exact_topk(d.where("vec_id < 3"), d.where("vec_id = 1")).collect()
    assert sorted(r["rank"] for r in few) == [1, 2, 3, 4]


def test_tree_visits_few_pages_of_clustered_vectors():
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(40, 8))[rng.integers(0, 40, 4000)] * 500 + rng.normal(size=(4000, 8)) * 5).astype(np.int64)
    x = v.astype(float)
    m2 = float((x * x).sum(1).max())
    centre = np.append(x[0], np.sqrt(m2 - (x[0] ** 2).sum()))
    tree = topk_search.Tree(topk_search.build(np.arange(4000), v, centre, m2, 16, 48), centre, m2)
    leaves = [p for p in tree.pages.values() if p[1]]
    assert sum(len(p[2]) for p in leaves) == 4000
    asked = np.arange(0, 4000, 40)
    scores, ids = tree.search(v[asked], asked, 10)
    want = brute([(i, x / 1024) for i, x in enumerate(v)], asked.tolist(), 10)
    assert {q: list(zip(i.tolist(), s.tolist(), strict=True)) for q, i, s in zip(asked.tolist(), ids, scores, strict=True)} == {q: [(i, s) for i, s in w] for q, w in want.items()}
    assert tree.opened < 0.3 * len(asked) * len(tree.pages)  # a third of what opening every page takes, at most


def test_topk_visits_few_shards_of_clustered_vectors(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 6)) * 3
    v = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 6)) * 0.02
    v[1000:2000] = v[0]  # a third are copies of one vector
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.exact_topk(d, d.where("vec_id % 97 = 0"), 5, shard_rows=100, leaf=16).collect()
    want = brute([(i, np.array(x)) for i, x in rows], range(0, 3000, 97), 5)
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == want


def test_topk_beyond_64_bits_and_texts_as_ids(spark):
    d = spark.createDataFrame([(str(i), [x, 1.0]) for i, x in enumerate([1e30, 3e13, -1e30, 2.0])], "vec_id string, embedding array<double>")
    got = {(int(r.query_id), r["rank"]): (int(r.vec_id), r.score) for r in topk_search.exact_topk(d, d).collect()}
    assert got[0, 1] == (1, 2**63 - 1) and got[0, 3] == (2, -(2**63) + 1) and got[1, 1] == (0, 2**63 - 1) and got[3, 1] == (0, 2**63 - 1)
