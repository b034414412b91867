"""HTML extraction, toxicity, language ID, near dedup, BPE, token files and the pipeline."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pyrelith.llm import bpe, exact_dedup, html_extraction, language_id, mixing, near_dedup, token_store, toxicity
from pyrelith.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

PAGE = "<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>menu</a></nav>%s<div class='ad'>buy %d</div><footer>&copy; host</footer></body></html>"


def test_html_cases():
    x = html_extraction.extract
    assert x(None, None) == "" and x("", None) == ""
    assert x("<p>a &amp; b<p>c\n d<br>e", None) == "a & b c d e"
    assert x(PAGE % ("<article><h1>T</h1><p>x<b>y</b> z<p>w<form>f</form><aside>s</aside><section class=comments>c</section></article>", 1), None) == "T xy z w"
    assert x("<article>1 &lt; 2<script>var a = '</p><article>';</script><!-- no --> &eacute;</article>tail", None) == "1 < 2 é"
    assert x("<div class=site-header>no</div><article><div class=post-header><h1>T</h1></div>a<header>b</header></article><header>no</header>", None) == "T a b"
    assert x("plain text", None) == "plain text" and x("<article><p>open", None) == "open"
    assert x("<div>" * 300 + "deep" + "</div>" * 300, None) == "deep"


def test_names_of_layouts_lose_no_text():
    x = html_extraction.extract
    for name in ("has-sidebar", "no-sidebar header-fixed"):
        assert x(f"<html><body class='{name}'><nav>n</nav><article>text</article></body></html>", None) == "text"
        assert x(f"<body class='{name}'><p>text</p><div class=ad>buy</div></body>", None) == "text"
    assert x("<div id=page class=right-sidebar><div class=sidebar>s</div><article>text</article></div>", None) == "text"
    assert x("<div class=right-sidebar><main>text</main></div><div class=related><article>tease</article></div>", None) == "text"
    for name in ("post legal", "notice", "search", "related", "side", "share", "promo"):
        assert x(f"<div>d</div><article class='{name}'>text<div class='{name}'>no</div></article>", None) == "text"
    assert x("<article>text</article><div class=comments><article>reply</article></div>", None) == "text"
    assert x("<nav>n</nav><div class=with-sidebar><p>text</p></div>", None) == "text"


def test_words_in_names_are_whole():
    x = html_extraction.extract
    assert x("<main><div class='post-legal-analysis'>legal news body</div></main>", None) == "legal news body"
    assert x("<article><div class='article-side-by-side'>a</div><p class='promo-code-guide'>b</p><p class='comment-list'>c</p></article>", None) == "a b"
    assert x("<div id=content><p>the real story goes on and on here</p></div><article class=teaser>tease</article>", None).startswith("the real story")


def test_deep_and_open_markup_takes_linear_time():
    import time

    x = html_extraction.extract
    n = 50_000
    start = time.time()
    assert x("<div>" * n + "deep" + "</div>" * n + "<p>after", None) == "deep after"
    assert x("<article>" + "<span>" * n + "text</article><nav>no</nav>", None) == "text"
    assert x("<b><div>" * n + "x</b>" * 5 + "y", None) == "xxxxxy"
    assert x("<div>" * 400 + "a<nav>no<b>no</b></nav><p>b<div class=ad>no</div>" + "</div>" * 400 + "<footer>no</footer>c", None) == "a b c"
    assert x("".join(f"<p>{k}<span>" for k in range(n)), None) == " ".join(map(str, range(n)))
    deep = html_extraction.as_wrapper(html_extraction.slots([html_extraction.parse("<div>" * n + "deep")], ""))
    assert html_extraction.merge(deep, deep)[1] == 2
    assert time.time() - start < 60


def test_wrappers_stay_small_whatever_pages_hold():
    def page(k):
        return "".join(f"<div id=x{k}{i} class='a{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}'><p>text {k} {i}</p></div>" for i in range(100))

    held = None
    for k in range(60):
        w = html_extraction.as_wrapper(html_extraction.slots([html_extraction.parse(page(k) + "<section>the same on every page</section>")], ""))
        held = html_extraction.bounded(html_extraction.merge(held, w) if held else w)
        nodes = [held]
        for node in nodes:
            nodes += node[3]
        assert len(nodes) <= html_extraction.MOST_NODES and all(len(x[3]) <= html_extraction.MOST_CHILDREN for x in nodes)
    assert html_extraction.extract(page(7) + "<section>the same on every page</section>", held) == " ".join(f"text 7 {i}" for i in range(100))


def test_without_wrappers_the_template_stays(spark, monkeypatch):
    body = "<div><h2>The daily host of all news</h2></div><div id=n%d><p>Read more about us on this host</p><p>story number %d</p><p>it ends with %d</p></div>"
    rows = [(i, f"http://t.example/{i}", body % (i, i, i)) for i in range(20)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = [f"story number {i} it ends with {i}" for i in range(20)]
    for limit in (16 << 20, 0):
        assert [r.text for r in html_extraction.extract_main_text(d.repartition(3), broadcast_bytes=limit).orderBy("page_id").collect()] == want
    monkeypatch.setattr(html_extraction, "wrappers", lambda pages, *a: spark.createDataFrame([], "host string, wrapper string"))
    assert all(r.text.startswith("The daily host") for r in html_extraction.extract_main_text(d).collect())


def test_wrapper_finds_the_template(spark):
    body = "<div class=top>Welcome to the site</div><div class=body><p>%s</p><p>more %s</p></div><div class=low>Call us</div>"
    rows = [(i, f"http://h.example/{i}", PAGE % (body % (f"text {i}", i), i)) for i in range(12)] + [(50, "http://other.example/", PAGE % (body % ("single", 1), 1)), (51, None, "<p>no host</p>"), (52, "x", None), (0, "http://h.example/0", PAGE % (body % ("text 0", 0), 0))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old")).withColumn("host", F.lit(1))
    for limit in (32 << 20, 0):
        got = {r.page_id: r.text for r in html_extraction.extract_main_text(d.repartition(5), broadcast_bytes=limit).collect()}
        assert got[3] == "text 3 more 3" and got[50] == "Welcome to the site single more 1 Call us" and got[51] == "no host" and got[52] == ""
    assert html_extraction.extract_main_text(d.limit(0)).count() == 0
    assert "host" in html_extraction.extract_main_text(d).columns


def test_wrapper_decides_inside_articles(spark):
    article = "<article><h1>Title %d</h1><div class=hint>Share this page with all</div><p>story %d of the day</p><div class=box>Readers say hello</div></article>"
    rows = [(i, f"http://a.example/{i}", PAGE % (article % (i, i), i)) for i in range(9)]
    rows += [(10 + i, f"http://copies.example/{i}", PAGE % (article % (7, 7), i)) for i in range(3)]
    story = "<main><div class=story>a long story %d that stands beside it</div>%s</main>"
    rows += [(20 + i, f"http://tease.example/{i}", PAGE % (story % (i, ["<article></article>", "<article>more %d</article>" % i][i % 2]), i)) for i in range(6)]
    rows += [(30, "http://one.example/", PAGE % (story % (1, "<article> </article>"), 1))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract_main_text(d.repartition(4)).collect()}
    assert [got[i] for i in range(9)] == [f"Title {i} story {i} of the day" for i in range(9)]
    assert {got[10 + i] for i in range(3)} == {"Title 7 Share this page with all story 7 of the day Readers say hello"}
    assert all(got[20 + i] == f"a long story {i} that stands beside it" + f" more {i}" * (i % 2) for i in range(6))
    assert got[30] == "a long story 1 that stands beside it"


def test_copies_of_a_page_lose_no_text(spark):
    story = "<article><h1>%s</h1><p>%s</p><p>%s</p><p>Fin.</p></article>"
    one = story % ("Big storm hits the coast", "The storm came with the night tide", "Nobody in the harbour was hurt today")
    for copies, others, exact in ((5, 4, True), (20, 4, True), (5, 4, False), (3, 4, False)):
        rows = [(i, f"http://c.example/{i}", PAGE % (one, 0 if exact else i)) for i in range(copies)]
        rows += [(100 + i, f"http://c.example/o{i}", PAGE % (story % (f"News {i}", f"what happened in town {i} this week", f"and what {i} people said about it"), i)) for i in range(others)]
        got = {r.page_id: r.text for r in html_extraction.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
        assert {got[i] for i in range(copies)} == {"Big storm hits the coast The storm came with the night tide Nobody in the harbour was hurt today Fin."}
        assert all(got[100 + i] == f"News {i} what happened in town {i} this week and what {i} people said about it Fin." for i in range(others))


def test_headings_that_come_again_stay(spark):
    page = "<article><h1>Dish %d</h1><h2>Ingredients</h2><ul><li>rice %d and salt</li></ul><h3>Method</h3><p>Boil it for %d minutes and stir.</p><p>Serve it while it is hot</p><div class=more><b>More dishes from this kitchen</b></div></article>"
    rows = [(i, f"http://r.example/{i}", PAGE % (page % (i, i, i), i)) for i in range(6)]
    got = html_extraction.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Dish {i} Ingredients rice {i} and salt Method Boil it for {i} minutes and stir. Serve it while it is hot" for i in range(6)}


def test_hidden_text_goes():
    x = html_extraction.extract
    assert x("<article>a<p style='color:red; Display : none'>no</p><p aria-hidden=true>no</p><p hidden>no</p><span style=\"visibility:hidden\">no</span><p style='display:block'>b</p><p aria-hidden='false'>c</p></article>", None) == "a b c"


def test_pages_with_odd_column_names(spark):
    rows = [(i, f"http://n.example/{i}", PAGE % (f"<article>text {i}</article>", i)) for i in range(4)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as `a.b`", "2 as host", "3 as c0", "4 as salt", "5 as wrapper", "6 as digest", "7 as `q``r`")
    for limit in (1 << 20, 0):
        got = html_extraction.extract_main_text(d, broadcast_bytes=limit)
        assert got.columns == ["page_id", "url", "a.b", "host", "c0", "salt", "wrapper", "digest", "q`r", "text", "n_chars"]
        assert sorted((r[0], r[2], r[6], r.text) for r in got.collect()) == [(i, 1, 5, f"text {i}") for i in range(4)]


def test_simple_tree_matching_is_optimal():
    rng = random.Random(3)

    def tree(depth):
        return [rng.choice("ab"), 1, "", [tree(depth - 1) for _ in range(rng.randrange(3))] if depth else [], {}]

    def best(a, b):
        if a[0] != b[0]:
            return 0
        top = 0
        for n in range(min(len(a[3]), len(b[3])) + 1):
            for x in itertools.combinations(a[3], n):
                for y in itertools.combinations(b[3], n):
                    top = max(top, sum(best(p, q) for p, q in zip(x, y)))
        return 1 + top

    for _ in range(60):
        a, b = tree(3), tree(3)
        a[0] = b[0] = "r"
        assert html_extraction.match(a, b, {}) == best(a, b)
        assert html_extraction.merge(a, b)[1] == 2


def test_html_query_against_the_article(spark, sf):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op1_html_extraction"](spark, sf).collect():
        article = (pages[r.page_id] or "").split("<article>")[-1].split("</article>")[0]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split()) and r.n_chars == len(r.text)


def test_toxicity_learns_hidden_words(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        w = rng.choices(words, k=30) + ([f"zorkel{rng.choice(words)[:2]}", rng.choice(["idiot", "grumpf"])] if toxic else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(toxic)))
    rows += [(9000, None, "en", "s", 0), (9001, "", "en", "s", 0), (None, "idiot", "en", "s", 1)]
    d = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)).withColumn("h", F.lit(1))
    lab = spark.createDataFrame(labels + [(3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.detect(d, lab).collect()}
    assert len(got) == 903 and got[None].held_out and got[9000].score == got[9001].score < 0.3
    held = [i for i, _ in labels if got[i].held_out]
    assert held and all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in labels)
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in held]) > 0.97
    none = toxicity.detect(d.where("doc_id < 20"), lab.limit(0)).collect()
    assert len(none) == 20 and all((r.predicted == 1) <= (r.score >= 0.3) for r in none)
    assert toxicity.detect(d.limit(0), lab).count() == 0


def test_label_model_against_brute_force():
    """EM by sums equals EM that writes each text's likelihood out, voter by voter."""
    rng = np.random.default_rng(3)
    y = rng.random(500) < 0.3
    fired = (rng.random((500, 4)) < np.where(y[:, None], [0.7, 0.5, 0.4, 0.1], [0.05, 0.1, 0.02, 0.8])).astype(float)
    fired[:, 2] = np.where(rng.random(500) < 0.8, fired[:, 1], fired[:, 2])
    label = np.where(rng.random(500) < 0.2, y.astype(int), -1)
    start = toxicity.LabelModel(0.2, np.array([-1, -1, 1, -1]), np.array([[0.1, 0.1, 0.1, 0.6], [0.5, 0.4, 0.3, 0.2]]), np.array([[0.5, 0.5, 0.5, 0.5], [0.6, 0.6, 0.6, 0.6]]))
    got = toxicity.label_model(fired, label, start, rounds=5)
    prior, alone, along = start.prior, start.alone.copy(), start.along.copy()
    for _ in range(5):
        post = np.empty(500)
        for i in range(500):
            like = [1 - prior, prior]
            for c in (0, 1):
                for j in range(4):
                    up = start.parent[j] >= 0 and fired[i, start.parent[j]] == 1
                    p = along[c, j] if up else alone[c, j]
                    like[c] *= p if fired[i, j] else 1 - p
                if label[i] >= 0:
                    like[c] *= toxicity.LABEL_ACCURACY if label[i] == c else 1 - toxicity.LABEL_ACCURACY
            post[i] = like[1] / sum(like)
        for c in (0, 1):
            w = post if c else 1 - post
            for j in range(4):
                up = fired[:, start.parent[j]] == 1 if start.parent[j] >= 0 else np.zeros(500, dtype=bool)
                along[c, j] = (w[up] @ fired[up, j] + 0.5) / (w[up].sum() + 1)
                alone[c, j] = (w[~up] @ fired[~up, j] + 0.5) / (w[~up].sum() + 1)
        prior = (post.sum() + 1) / 502
    assert np.allclose(got.alone, alone, atol=2e-3) and np.allclose(got.along[:, 2], along[:, 2], atol=2e-3) and abs(got.prior - prior) < 2e-3


def test_label_model_counts_copies_once():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    good = rng.random(4000) < np.where(y, 0.8, 0.02)
    weak = rng.random(4000) < np.where(y, 0.5, 0.2)
    other = rng.random(4000) < np.where(y, 0.6, 0.05)
    label = np.where(rng.random(4000) < 0.2, y.astype(int), -1)

    def odds(columns):
        fired = np.stack(columns, axis=1).astype(float)
        seen = label >= 0
        start = toxicity.LabelModel(0.3, toxicity.parents_of(fired[seen], label[seen]), np.full((2, fired.shape[1]), 0.1), np.full((2, fired.shape[1]), 0.1))
        start = start.estimated(start.sums(fired[seen], label[seen].astype(float), np.ones(seen.sum())))
        m = toxicity.label_model(fired, label, start)
        return m, m.log_odds(fired, np.full(4000, -1))

    once, a = odds([good, weak, other])
    copies, b = odds([good, weak, weak, weak, weak, other])
    assert (once.parent == -1).all() and sorted(copies.parent[1:5] >= 0) == [False, True, True, True]
    assert np.abs(a - b).max() < 0.3 and ((b > 0) == y).mean() > 0.9
    assert abs(once.alone[1, 0] - 0.8) < 0.05 and abs(once.alone[0, 1] - 0.2) < 0.05


def test_toxicity_ignores_hidden_labels_and_columns(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    one = {r.doc_id: r.score for r in toxicity.detect(docs, labels).collect()}
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = labels.withColumn("toxic", F.when(hidden, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    two = {r.doc_id: r.score for r in toxicity.detect(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")).repartition(5), other).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_language_id_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 !!", "en", "s", 0), (-3, "", None, None, None), (-4, "x" * 200_000, "en", "s", 0), (None, "the of and", "en", "s", 0)], DOCS)
    rows = language_id.identify(docs.unionByName(extra).withColumn("score", F.lit(9))).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() + 5
    assert [by[i].lang_pred for i in (-1, -2, -3)] == ["und"] * 3 and by[-1].score == 0 and by[None].held_out
    held = [r for r in rows if r.held_out and r.lang]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.9
    assert language_id.identify(docs.limit(0)).count() == 0
    kept = language_id.keep_identified(docs.unionByName(extra))
    assert kept.schema == docs.schema and kept.count() >= docs.count() * 0.99 and kept.where("doc_id in (-1, -2, -3)").count() == 0


def test_language_id_ignores_hidden_labels_and_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = docs.withColumn("lang", F.when(hidden, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q")).withColumn("n_chars", F.lit(None).cast("long"))
    one = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(other.repartition(5)).collect()}
    assert one.keys() == two.keys() and all(one[k][0] == two[k][0] and abs(one[k][1] - two[k][1]) < 1e-4 for k in one)


def test_kernel_against_brute_force():
    """Scores equal those of a kernel ridge regression on the landmarks' features, written out with sets of n-grams."""
    import pandas as pd

    texts = ["the cat sat on the mat", "a dog and the cat", "le chat est sur la table", "un chien et le chat", "αβγ δε", "日本語の本"]

    def grams(t):
        s = language_id.symbols(t).tolist()
        return {tuple(s[i : i + n]) for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    (got,) = language_id.presence(iter([pd.DataFrame({"lang": ["x"] * 6, "text": texts})]))
    sizes = [len(np.frombuffer(g, dtype=np.int32)) for g in got["grams"]]
    assert sizes == [len(grams(t)) for t in texts]
    sets = [set(np.frombuffer(g, dtype=np.int32).tolist()) for g in got["grams"]]
    for a, b in itertools.combinations(range(6), 2):
        assert len(sets[a] & sets[b]) == len(grams(texts[a]) & grams(texts[b]))


def test_every_labelled_language_is_learned(spark):
    rng = random.Random(2)
    words = {f"l{k:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)] for k in range(104)}
    rows = [(100 * k + i, " ".join(rng.choices(w, k=40)), lang) for k, (lang, w) in enumerate(words.items()) for i in range(9 if k < 103 else 6)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(d)
    assert model.langs == sorted(words)
    told = [lang for lang, _ in model.predict([" ".join(rng.choices(w, k=40)) for w in words.values()])]
    assert told[-1] == "l103" and np.mean([a == b for a, b in zip(told, words)]) > 0.95


def test_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(5)

    def gibberish(alphabet):
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 9))) for _ in range(120))

    planted = [(-1 - i, gibberish(a), None, "src0", 1) for i, a in enumerate(["абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω", "日本語中文字符漢書", "abcdefghijklmnopqrstuvwxyz"] * 5)]
    kept = language_id.keep_identified(docs.unionByName(spark.createDataFrame(planted, DOCS)))
    assert kept.where("doc_id < 0").count() == 0
    assert kept.count() >= docs.count() * 0.995
    # a language that no labelled row has
    rest = docs.withColumn("lang", F.when(F.col("lang") != "es", F.col("lang")))
    left = language_id.keep_identified(rest)
    es, others = docs.where("lang = 'es'").count(), docs.where("lang <> 'es'").count()
    assert left.where("lang is null").count() <= 0.1 * es and left.where("lang is not null").count() >= 0.995 * others


def shingles(text):
    w = bytes(text or "", "utf-8").lower().split()
    return set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts, percent):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def test_near_dedup_against_all_pairs(spark):
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    texts, n = {}, 0
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randrange(8, 200))]
        for c in range(rng.choice([1, 2, 3, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts[n] = (" " if c % 2 else "  ").join(w).upper() if c % 3 == 0 else " ".join(w)
            n += 1
    shared = " ".join(rng.choice(vocab) for _ in range(60))
    for _ in range(30):  # a passage that many texts share
        texts[n] = shared + " " + " ".join(rng.choice(vocab) for _ in range(40))
        n += 1
    texts |= {n: "", n + 1: "  \t ", n + 2: None, n + 3: "one two", n + 4: "ONE  two", n + 5: "ÄB c", n + 6: "äb c"}
    d = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").withColumn("sig", F.lit(1)).withColumn("rep", F.lit(1))
    for percent in (85, 80):
        want = components(texts, percent)
        got = {r.doc_id: r for r in near_dedup.near_components(d.repartition(3), percent=percent, block_rows=7, broadcast_bytes=0 if percent == 80 else 1 << 24).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert all(got[i].kept == (i == want[i]) and got[i].n_shingles == len(shingles(texts[i])) for i in texts)
    left = near_dedup.drop_near_copies(d, percent=85)
    assert left.columns == d.columns and left.count() == len(set(components(texts, 85).values()))


def test_near_dedup_odd_rows(spark):
    d = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_components(d).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert near_dedup.near_components(d.limit(0)).count() == 0


def test_near_dedup_compares_linearly_around_a_common_passage(spark):
    """A passage of 140 words in every text of 190: no two are linked by it, but near copies among them are found."""
    counts = []
    for n in (400, 800):
        rng = random.Random(n)

        def words(k):
            return ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(k)]

        passage = words(140)
        texts = {i: words(25) + passage + words(25) for i in range(n)}
        for i in range(0, n, 10):
            w = list(texts[i])
            w[3] = "changed"
            texts[n + i] = w
        texts = {i: " ".join(w) for i, w in texts.items()}
        compared = spark.sparkContext.accumulator(0)
        d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in near_dedup.near_components(d, block_rows=40, compared=compared).collect()}
        assert got == {i: i - n if i >= n else i for i in texts}
        counts.append(compared.value)
    assert counts[1] <= 2.5 * counts[0] + 200 and counts[1] < len(texts) * 40


def test_near_dedup_class_that_leads_but_is_nobodys_leader(spark):
    """x leads the lists it shares with its near copy y, and y chose z, heavier and no copy, with which it shares a rare passage."""
    rng = random.Random(11)
    texts, n = {}, 0
    for _ in range(12):

        def words(k):
            return ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(k)]

        base, rare, common, z = words(220), words(14), words(14), words(230)
        group = [base + common, base + rare, rare + z, *[z + words(4) for _ in range(7)], *[common + words(40) for _ in range(15)]]
        for w in group:
            texts[n] = " ".join(w)
            n += 1
    want = components(texts, 85)
    assert all(want[i + 1] == i for i in range(0, n, 25))
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_components(d).collect()} == want


def token_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, " <|endoftext|> x<|endoftext|>"), (-4, "  \n\t a  b   c'S 'll"), (-5, "x" * 50_000), (-6, "héllo 世界 🙂 ١٢٣"), (-7, "a" * 3 + " " * 9000)]
    return docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))


def test_bpe_equals_the_library(spark, sf):
    d = token_documents(spark, sf)
    t = bpe.tokenizer(PATH)
    got = {r.doc_id: tuple(r)[1:] for r in bpe.encode_decode(d.withColumn("word", F.lit(1)).repartition(3), PATH, buckets=5).collect()}
    rows = d.collect()
    assert len(got) == len(rows)
    for r, e in zip(rows, t.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        ids = np.array(e.ids, dtype="<u4")
        text = t.decode(e.ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.encode_decode(d.limit(0), PATH).count() == 0
    twice = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    assert sorted(r.doc_id or 0 for r in bpe.encode_decode(twice, PATH).collect()) == [0, 1, 1]


def test_bpe_splits_every_character_as_the_library():
    _, added = bpe.added_tokens(PATH)
    chars = [chr(c) for c in [*range(0x3100), *range(0x1F300, 0x1F400), *range(0xFE00, 0x10000)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c} {c}{c}1'{c}s\n" for c in chars]
    whole = bpe.tokenizer(PATH).encode_batch(texts, add_special_tokens=False)
    split = [bpe.split_words(t, added) for t in texts]
    flat = iter(bpe.encode_words([w for s in split for w in s], PATH))
    assert all([i for _ in s for i in next(flat)] == e.ids for s, e in zip(split, whole))


def test_ids_that_are_texts(spark):
    rows = [("7", "some words to encode"), ("x", "more words"), (None, "none")]
    d = spark.createDataFrame(rows, "doc_id string, text string")
    plain = spark.createDataFrame([(7, rows[0][1]), (8, rows[1][1]), (None, "none")], "doc_id long, text string")
    number = {"7": 7, "x": 8, None: None}
    want = {r.doc_id: tuple(r)[1:] for r in bpe.encode_decode(plain, PATH).collect()}
    assert {number[r.doc_id]: tuple(r)[1:] for r in bpe.encode_decode(d, PATH).collect()} == want
    want = {r.doc_id: tuple(r)[1:] for r in token_store.round_trip(plain, PATH).collect()}
    assert {number[r.doc_id]: tuple(r)[1:] for r in token_store.round_trip(d, PATH).collect()} == want
    same = d.unionByName(spark.createDataFrame([("b2e0-41", "more words"), ("x", "other words")], d.schema))
    got = sorted((r.doc_id or "", r.component_id or "", r.kept) for r in near_dedup.near_components(same).collect())
    assert got == [("", "", True), ("7", "7", True), ("b2e0-41", "b2e0-41", True), ("x", "b2e0-41", False), ("x", "x", True)]


def test_stages_with_odd_column_names(spark):
    rows = [(i, f"words of document {i // 2} and so on it goes", "en", f"s{i % 2}") for i in range(12)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as `a.b`", "2 as gone", "3 as row", "4 as taken", "5 as size", "6 as copy", "7 as other_id", "8 as first_sha", "9 as __gone", "10 as __id")
    for stage in (exact_dedup.drop_exact_copies, near_dedup.drop_near_copies, mixing.mix_documents):
        out = stage(d)
        assert out.columns == d.columns and {(r["a.b"], r["gone"], r["row"], r["size"], r["__gone"]) for r in out.collect()} == {(1, 2, 3, 5, 9)}


def test_mix_of_rows_that_share_an_id(spark):
    rows = [(1, " ".join(f"w{k}" for k in range(30)), "a")] * 2 + [(None, "q " * 7, "a")] * 3 + [(2, "one two", "b")] * 2
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r.source: r.t for r in mixing.mix_plan(d).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    got = {r.source: r.t for r in mixing.mix_documents(d).groupBy("source").agg(F.sum(mixing.word_count("text")).alias("t")).collect()}
    assert got == plan


def test_varints():
    x = np.array([0, 1, 127, 128, 16_383, 16_384, 2**21 - 1, 2**21, 2**28 - 1] * 40)
    data, size = bpe.varints(x)
    assert data.size == size.sum() and (bpe.from_varints(data, piece=7) == x).all() and bpe.from_varints(data[:0]).size == 0


def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(1)
    blocks = [rng.zipf(1.3, n).clip(0, 50_256) for n in (2048, 700, 1, 0, 2048)] + [np.zeros(2048, dtype=np.int64), np.tile([5, 9, 50_256, 3], 512)]
    raw = token_store.encode_blocks([b.astype(np.int64) for b in blocks])
    assert all((a == b).all() for a, b in zip(blocks, token_store.decode_blocks(raw)))
    alone = [len(token_store.encode_blocks([b.astype(np.int64)])) for b in blocks]
    assert alone[-1] < 300 and alone[-2] < 300  # what repeats is learned
    for at in (len(raw) // 2, len(raw) - 40):
        with pytest.raises(ValueError):
            token_store.decode_blocks(raw[:at] + bytes([raw[at] ^ 85]) + raw[at + 1 :])


def test_coder_needs_fewer_bits_than_zlib(spark, sf):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    ids = np.concatenate([np.array([*e.ids, 2]) for e in bpe.tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]).astype(np.int64)
    blocks = [ids[k : k + token_store.BLOCK_IDS] for k in range(0, ids.size, token_store.BLOCK_IDS)]
    raw = token_store.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, token_store.decode_blocks(raw), strict=True))
    reset = sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks)
    stream = len(zlib.compress(ids.astype("<u2").tobytes(), 9))
    share = np.bincount(ids)[ids] / ids.size
    assert len(raw) < stream < reset and 8 * len(raw) < -np.log2(share).sum()


def test_coder_with_odd_blocks():
    rng = np.random.default_rng(4)
    wide = rng.permutation(65_535)[:60_000].astype(np.int64)  # nearly every id once
    for ids in (wide, np.repeat(wide[:3000], 7), np.tile(wide[:5000], 8), np.zeros(0, dtype=np.int64), np.array([65_534]), np.tile([1, 2], 3000)):
        blocks = [ids[k : k + 999] for k in range(0, ids.size, 999)] + [np.zeros(0, dtype=np.int64)]
        assert all((a == b).all() for a, b in zip(blocks, token_store.decode_blocks(token_store.encode_blocks(blocks)), strict=True))


def test_remembered_words_equal_the_library():
    rng = random.Random(9)
    known = token_store.WordIds(PATH, most=50)
    marks = ["a", "bc", "1", "!", "'s", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "é", "世", "<|endoftext|>", "\u200b", "-"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 14))) for _ in range(3000)] + ["a b", " a b", "a b ", "", None]
    whole = bpe.tokenizer(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    for lo in range(0, len(texts), 100):
        for raw, e in zip(known.texts(texts[lo : lo + 100]), whole[lo : lo + 100]):
            assert np.frombuffer(raw, dtype="<u2").tolist() == e.ids


def test_token_files_equal_the_library(spark, sf, monkeypatch):
    monkeypatch.setattr(token_store, "LANES", 3)  # documents cut over stripes
    d = token_documents(spark, sf)
    t = bpe.tokenizer(PATH)
    got = {r.doc_id: tuple(r)[1:] for r in token_store.round_trip(d.withColumn("part", F.lit(1)).repartition(3), PATH).collect()}
    start = 0
    rows = sorted(d.collect())
    assert len(got) == len(rows)
    for r, e in zip(rows, t.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 2], dtype="<u4")
        assert got[r.doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_store.round_trip(d.limit(0), PATH).count() == 0


def test_pipeline_against_brute_force(spark, sf):
    import re

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10_001, "123 !!!", "en", "src0", 7), (10_002, None, "en", "src0", 0)], DOCS)
    docs = docs.unionByName(extra)
    stages = [f for _, f in corpus_pipeline.STAGES]
    a = stages[0](spark, docs, sf)
    assert {10_001, 10_002} == {r.doc_id for r in docs.select("doc_id").subtract(a.select("doc_id")).collect()} and a.columns == docs.columns
    b = stages[1](spark, a, sf)
    first = {}
    for r in sorted(a.collect()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert sorted(r.doc_id for r in b.collect()) == sorted(first.values())
    c = stages[2](spark, b, sf)
    near = components({r.doc_id: r.text for r in b.collect()}, 80)
    assert {r.doc_id for r in c.collect()} == {i for i, k in near.items() if i == k}
    d = stages[3](spark, c, sf)
    assert d.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in c.collect())
    assert abs(sum(len(r.text.split()) for r in d.collect()) - 1.5 * words) <= 0.01 * words + 20
    e = stages[4](spark, d, sf)
    assert e.count() == d.count() and e.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_pipeline_with_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, "a text of some words", "en", "s", 1), (None, None, None, None, None), (70_007, "", "en", None, 0)], DOCS)
    twice = docs.unionByName(docs.where("doc_id < 40")).unionByName(odd).withColumn("kept", F.lit(1)).withColumn("component", F.lit("x")).withColumn("size", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, twice, sf)
        assert out.columns == twice.columns, name
        twice = spark.createDataFrame(out.collect(), out.schema)  # each stage works on its predecessor's rows
        assert twice.count() > 0
    kept = {r.doc_id for r in twice.collect()}
    assert 70_007 not in kept
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0, name


def test_long_lists_join_by_parts(spark):
    # op7, pipeline: what is known of a list is joined to its parts, whose number doesn't grow with the list
    from pyrelith.llm import near_dedup as N

    posts = spark.range(5000).selectExpr("id AS rep", "7L AS token").unionByName(spark.sql("SELECT 1L AS rep, 8L AS token"))
    rows = N.in_parts(posts, F.collect_list("rep").alias("reps"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.token == 7 for r in rows) <= N.PARTS and sum(r.n for r in rows) == 5001
    assert sorted(x for r in rows if r.token == 7 for x in r.reps) == list(range(5000))
