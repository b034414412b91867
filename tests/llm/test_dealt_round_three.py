"""Fingerprints, sessions and resampling against brute force, with ties, repeats, odd rows and hot clients."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyrelith.llm import fingerprints, resampling, sessions

QUIET = {"deadline": None, "suppress_health_check": list(HealthCheck)}
CLICKS = "click_id long, t long, arrived long, client_id long, kind string, value double"
MINUTE = 60_000_000


def clicks_frame(spark, rows):
    d = spark.createDataFrame(rows, CLICKS)
    return d.selectExpr("click_id", "cast(timestamp_micros(t) as timestamp_ntz) ts", "cast(timestamp_micros(arrived) as timestamp_ntz) arrived_at", "client_id", "kind", "value", "1 as late", "2 as final", "3 as `a.b`", "'x' as range")


def brute_sessions(rows, gap=30 * MINUTE, length=120 * MINUTE, late_us=60 * MINUTE):
    once = {}
    for r in sorted((r for r in rows if r[1] is not None and r[3] is not None), key=lambda r: (r[2] is not None, r[2] or 0, r[1], r[3])):
        once.setdefault(r[0], r)
    per = defaultdict(list)
    for c, t, a, who, kind, value in once.values():
        per[who].append((t, c, a is not None and a - t > late_us, kind == "purchase" and value is not None and value >= 60, 0 if value is None else math.floor(100 * value + 0.5)))
    out = []
    for who, cs in per.items():
        found = []
        for t, c, late, final, cents in sorted((x for x in cs if not x[2]), key=lambda x: (x[0], x[1])):
            why = None
            if found:
                s = found[-1]
                why = "end" if s["final"] else "gap" if t - s["end"] >= gap else "length" if t - s["start"] > length else None
                if why:
                    s["why"] = why
            if not found or why:
                found.append({"start": t, "ids": [], "cents": 0, "late": 0})
            s = found[-1]
            s["ids"].append(c)
            s["end"], s["final"], s["cents"] = t, final, s["cents"] + cents
        for t, *_ in (x for x in cs if x[2]):
            held = [s for s in found if s["start"] <= t]
            if held:
                held[-1]["late"] += 1
        for s in found:
            out.append((who, s["ids"][0], s["start"], s["end"], len(s["ids"]), s["late"], s["cents"], s.get("why", "end" if s["final"] else "none"), hashlib.sha256(",".join(map(str, s["ids"])).encode()).hexdigest()))
    return sorted(out)


def random_clicks(rng, n, clients, most_gap):
    rows, t = [], 10**15
    for i in range(n):
        t += rng.choice([0, 0, rng.randrange(most_gap), rng.randrange(2 * MINUTE), 30 * MINUTE, 30 * MINUTE - 1])
        who = 7 if rng.random() < 0.4 else rng.choice([None, *range(clients)])
        rows.append((i, rng.choice([t] * 30 + [None]), rng.choice([t] * 8 + [t + 60 * MINUTE, t + 60 * MINUTE + 1, None]), who, rng.choice(["view", "click", "purchase", None]), rng.choice([59.99, 60.0, 1.005, -3.5, None, 10.0])))
    rng.shuffle(rows)
    return rows + rows[: n // 10]


@pytest.mark.parametrize("seed", range(4))
def test_sessions_against_brute_force_over_many_ranges(spark, seed):
    rng = random.Random(seed)
    rows = random_clicks(rng, 900, 5, (40 if seed % 2 else 4) * MINUTE)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", [1, 4, 40, 150][seed])
    try:
        got = sorted(tuple(r) for r in sessions.sessions(clicks_frame(spark, rows)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute_sessions(rows)


def test_a_client_without_gaps_lies_over_many_ranges(spark):
    rows = [(i, 10**15 + i * 7 * MINUTE, 10**15 + i * 7 * MINUTE + (i % 9 == 4) * 61 * MINUTE, 1, "view", 1.0) for i in range(600)]  # only the length ends sessions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        got = sorted(tuple(r) for r in sessions.sessions(clicks_frame(spark, rows)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute_sessions(rows) and {r[7] for r in got} == {"length", "none"}


@pytest.mark.parametrize("seed", range(3))
def test_long_runs_are_dealt_by_session(spark, seed, monkeypatch):
    rng = random.Random(seed + 50)
    rows, t = [], 10**15
    for i in range(700):  # one client with few gaps and few final clicks, over far more ranges than those part
        t += rng.choice([0, 0, rng.randrange(29 * MINUTE), rng.randrange(5 * MINUTE), 30 * MINUTE if rng.random() < 0.03 else MINUTE])
        rows.append((i, t, t + rng.choice([0] * 8 + [61 * MINUTE]), 5, "purchase" if rng.random() < 0.02 else "view", 70.0))
        if rng.random() < 0.05:
            rows.append((10_000 + i, t + rng.randrange(MINUTE), None, rng.randrange(4), "view", 1.0))
    dealt, whole = [], sessions.by_session

    def seen(scratch, beside, joined, *times):
        out = whole(scratch, beside, joined, *times)
        dealt.append((joined.count(), max(r["count"] for r in out.groupBy("border").count().collect())))
        return out

    monkeypatch.setattr(sessions, "by_session", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "120")
    try:
        got = sorted(tuple(r) for r in sessions.sessions(clicks_frame(spark, rows)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute_sessions(rows)
    assert dealt[0][0] > 3 and dealt[0][1] < 120  # many joined borders, none with more than a session has


def test_sessions_of_odd_rows(spark):
    assert sessions.sessions(clicks_frame(spark, []).limit(0)).count() == 0
    t = 10**15
    rows = [(None, t, t, 1, None, float("nan")), (None, t, t, 1, None, float("nan")), (2, t, None, 1, "purchase", float("inf")), (2, t, t, 1, "view", 1.0), (3, t, t, 1, "view", 0.125), (4, None, t, 1, "x", 1.0), (5, t, t, None, "x", 1.0), (6, t, t + 61 * MINUTE, 9, "x", 1.0)]
    got = [tuple(r) for r in sessions.sessions(clicks_frame(spark, rows)).collect()]
    first = hashlib.sha256(b",2").hexdigest()
    assert sorted((r[0], r[4], r[6], r[7], r[8]) for r in got) == sorted([(1, 2, 0, "end", first), (1, 1, 13, "none", hashlib.sha256(b"3").hexdigest())])
    texts = clicks_frame(spark, [(i, t, t, 1, "x", None) for i in range(3)]).selectExpr("concat('c', click_id) click_id", "ts", "arrived_at", "'me' client_id", "kind", "value")
    (r,) = sessions.sessions(texts).collect()
    assert (r.client_id, r.session_id, r.path_sha256) == ("me", "c0", hashlib.sha256(b"c0,c1,c2").hexdigest())


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_resampling(docs, target, buckets, runs=(1, 1), least=20, percent=10):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        return w, Counter(zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(runs[0], runs[1] + 1) for i in range(len(w) - k + 1))

    each = [(d, *features(t)) for d, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in each:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)}
    rows = []
    for d, w, f in each:
        weight = sum(gain[b] * n for b, n in f.items())
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)))
    order = sorted((i for i, r in enumerate(rows) if r[4] >= least), key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0))
    drawn = {i: n + 1 for n, i in enumerate(order[: len(order) * percent // 100])}
    return sorted(((*r[:4], drawn.get(i)) for i, r in enumerate(rows)), key=repr)


def docs_of(rng, n):
    words = ["der", "The", "l'été", "Straße", "x" * 100, "a1", "日本語", " ", "B2b", "tail"]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("runs", [(1, 1), (1, 3)])
def test_resampling_against_brute_force(spark, runs):
    rng = random.Random(3)
    rows = [*docs_of(rng, 300), (900, None), (901, ""), (902, "one " * 5000), (903, "\x00..\n"), (None, "null id " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as rank", "3 as `a.b`", "4 as key", "5 as n_words")
    target = spark.createDataFrame([("The tail of",), (None,), ("日本語 the",)], "text string")
    got = resampling.resample(docs, target, buckets=50, runs=runs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resampling(rows, [r.text for r in target.collect()], 50, runs)


def test_resampling_with_a_third_of_rows_alike_and_few_rows(spark):
    rng = random.Random(4)
    rows = docs_of(rng, 60) + [(1000, "same words again and again " * 9)] * 30
    goal = spark.createDataFrame([("same words",)], "text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in resampling.resample(docs, goal, percent=40).collect()), key=repr)
    assert got == brute_resampling(rows, ["same words"], 10_000, percent=40)
    assert resampling.resample(docs.limit(0), goal).count() == 0
    assert {r["rank"] for r in resampling.resample(docs, goal.limit(0), percent=0).collect()} == {None}
    assert sorted(r["rank"] for r in resampling.resample(docs.selectExpr("concat('d', doc_id) doc_id", "text"), goal, percent=100, least_words=0).collect()) == list(range(1, 91))


@settings(max_examples=10, **QUIET)
@given(st.lists(st.text(alphabet="0123456789ABCDEF", min_size=1, max_size=6), min_size=1, max_size=60), st.integers(0, 61))
def test_radix_selection(spark, keys, k):
    distinct = sorted(set(keys))
    d = spark.createDataFrame([(x,) for x in distinct], "key string")
    want = None if k == 0 else distinct[min(k, len(distinct)) - 1]
    assert resampling.kth_key(d, k) == want


def brute_fingerprints(rows, low, high, least, draws=16, levels=4):
    rows = [(d, t or "") for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]

    def terms(text):
        return sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))), key=lambda t: t.encode())

    df, n = Counter(t for _, text in rows for t in terms(text)), len(rows)
    lexicon = {t for t, c in df.items() if c >= least and low * n <= 1000 * c <= high * n}

    def parts(text):
        ts = terms(text)
        used = [t for t in ts if t in lexicon] or ts
        s = []
        for d in range(draws):
            for level in range(1, levels + 1):
                held = [t for t in used if hashlib.md5(t.encode()).digest()[d] % 4**level == 0]
                s.append(hashlib.md5(" ".join(held).encode()).hexdigest()[:4] if held else "----")
        return s, (hashlib.md5(" ".join(ts).encode()).hexdigest() if set(s) == {"----"} else None)

    def whole(p):
        return p[1] or "".join(p[0])

    def near(p, q):
        if whole(p) == whole(q):
            return 1.0
        if p[1] or q[1]:
            return 0.0
        pairs = [(x, y) for x, y in zip(p[0], q[0], strict=True) if {x, y} != {"----"}]
        return sum(x == y for x, y in pairs) / len(pairs)

    out = []
    for i, (d, text) in enumerate(rows):
        follows, half = rows[(i + 1) % n][1], len(text) // 2
        edited = text[: len(text) - half] + follows[:half]
        p, q, r = parts(text), parts(edited), parts(follows)
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), whole(p), whole(q), near(p, q), near(p, r)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows_per_block", [1, 7, 1000])
def test_fingerprints_against_brute_force(spark, rows_per_block):
    rng = random.Random(9)
    words = [f"W{rng.randrange(10**6)}é" for _ in range(120)]
    rows = [(i * 3, " ".join(rng.choices(words, k=rng.randrange(1, 200)))) for i in range(60)]
    rows += [(1001, None), (1002, ""), (1003, "?!"), (1004, "only once 😀"), (1005, "x" * 100_000), (-5, rows[0][1]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as guest", "3 as `a.b`", "4 as order", "5 as next_text")
    got = fingerprints.fingerprints(docs.repartition(3), low=50, high=600, rows_per_block=rows_per_block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_fingerprints(rows, 50, 600, 2)


def test_fingerprints_of_few_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints.fingerprints(empty).count() == 0
    (r,) = fingerprints.fingerprints(spark.createDataFrame([("a", "alone here")], "doc_id string, text string")).collect()
    assert (r.doc_id, r.near_next, r.n_chars) == ("a", 1.0, 10) and r.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()
    rows = [("b", "one two three")] * 5 + [("a", "four five six"), ("c", None)]
    got = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id string, text string"), rows_per_block=2).collect()
    assert len(got) == 7 and len({r.fingerprint for r in got if r.doc_id == "b"}) == 1 and sorted(r.near_next for r in got if r.doc_id == "b") == [0.0, 1.0, 1.0, 1.0, 1.0]


def test_fingerprints_tell_edits_from_neighbours(spark, sf):
    got = fingerprints.fingerprints(spark.read.parquet(f"{sf}/documents.parquet")).where("n_chars >= 200").collect()
    assert sum(r.near_edited > r.near_next for r in got) > 0.85 * len(got)


def test_plans_of_fingerprints_have_no_python(spark, sf):
    plan = fingerprints.fingerprints(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning(block") == 1
