"""What the findings of round four had wrong."""

from __future__ import annotations


def test_crowded_windows_take_little_disk(spark, tmp_path, monkeypatch):
    # the result is a product; it is spread over all tasks and written in a small part of a byte a row
    from pyrelith.operators import stations

    e = spark.range(1500).selectExpr("id AS event", "1704067200 + xxhash64(id) % 20000 AS t0").selectExpr("*", "t0 + 30000 AS t1")
    o = spark.range(3000).selectExpr("id AS obs_id", "1704067200 + xxhash64(id, 1) % 90000 AS at")
    out = str(tmp_path / "out")
    stations.reports_in_window(e, o, 7200).select("event", "obs_id").write.parquet(out)
    files = list((tmp_path / "out").glob("*.parquet"))
    rows = spark.read.parquet(out)
    n = rows.count()
    assert n == e.crossJoin(o).where("at BETWEEN t0 AND t1 + 7200").count()
    assert rows.distinct().count() == n
    assert len(files) >= 10 and sum(f.stat().st_size for f in files) < 0.5 * n
    # cells of few windows, borders at full hours, windows of no length or turned round, reports without a time, equal rows
    monkeypatch.setattr(stations, "CELL_WINDOWS", 3)
    w = [(k % 40, t, t + d) for k, (t, d) in enumerate((t, d) for t in range(0, 14_401, 1800) for d in (-700, -601, 0, 1, 3599, 3600, 7199))]
    at = [*range(0, 30_000, 599), *range(0, 30_000, 1800), 3600, None]
    got = stations.reports_in_window(spark.createDataFrame(w, "event long, t0 long, t1 long"), spark.createDataFrame(list(enumerate(at)), "obs_id long, at long"), 600)
    assert got.columns == ["event", "t0", "t1", "until", "obs_id", "at"]
    want = sorted((*x, x[2] + 600, k, a) for x in w for k, a in enumerate(at) if a is not None and x[1] <= a <= x[2] + 600)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_importance_of_equal_rows_is_counted(spark, monkeypatch):
    # many rows of few values: pairs of a distinct row and a value are drawn and predicted, not each row
    from pyrelith.operators import labels as L

    d = spark.range(60_000).selectExpr("id AS row", "id % 3 AS event", "CAST(xxhash64(id) % 5 AS DOUBLE) AS a", "CAST(xxhash64(id, 1) % 4 AS DOUBLE) AS b").selectExpr("*", "CAST(a > 0 AS INT) AS label")
    models = {"tree": L.classifiers()["tree of depth 3"]}
    monkeypatch.setattr(L, "dealt_anew", lambda *_: 1 / 0)
    got = {(r.event, r.feature): r.importance for r in L.permutation_importance(d, "event", "label", ("a", "b"), "row", models, repeats=3).collect()}
    monkeypatch.undo()
    # the same by dealing rows
    monkeypatch.setattr(L, "MOST_PAIRS", 0)
    rows = {(r.event, r.feature): r.importance for r in L.permutation_importance(d, "event", "label", ("a", "b"), "row", models, repeats=3).collect()}
    assert got.keys() == rows.keys() and len(got) == 6
    assert all(abs(got[k] - rows[k]) < 0.01 for k in got) and all(got[e, "a"] > 0.4 and got[e, "b"] == 0 for e in range(3))


def test_counted_deals_keep_margins_and_spread(spark):
    # each repeat has every distinct row and every value as often as the data, whatever the strata, and is as random as dealing rows
    from pyrelith.operators import labels as L

    rows = [(y, float(a), float(b), float(1 + (a * 7 + b * 3 + y) % 5 * (300 if a == 2 else 1))) for y in (0, 1) for a in range(5) for b in range(6)]
    counted = spark.createDataFrame(rows, "label int, a double, b double, weight double")
    weight = lambda i: {k: sum(r[3] for r in rows if r[i] == k) for k in {r[i] for r in rows}}
    for strata in (1, 4):
        got = [tuple(r) for r in L.dealt_counts(counted, ("a", "b"), 42, 20, strata).collect()]
        assert sorted((y, a, b, *n) for y, f, a, b, *n in got if f is None) == sorted((y, a, b, *[int(w)] * 20) for y, a, b, w in rows)
        for k in range(20):
            assert {b: sum(r[4 + k] for r in got if r[1] == "b" and r[3] == b) for b in range(6)} == weight(2)
            assert {y: sum(r[4 + k] for r in got if r[1] == "b" and r[0] == y) for y in (0, 1)} == weight(0)
            assert {a: sum(r[4 + k] for r in got if r[1] == "b" and r[2] == a) for a in range(5)} == weight(1)
        # rows of label 1 and a = 2 that get b = 3: mean and spread of draws without putting back
        n, m, c = sum(r[3] for r in rows), weight(2)[3.0], sum(r[3] for r in rows if r[0] == 1 and r[1] == 2)
        drawn = [sum(r[4 + k] for r in got if r[:4] == (1, "b", 2.0, 3.0)) for k in range(20)]
        sd = (c * m / n * (1 - m / n) * (n - c) / (n - 1)) ** 0.5
        assert abs(sum(drawn) / 20 - c * m / n) < 4 * sd / 20**0.5 and len(set(drawn)) > 5
        assert 0.4 * sd < (sum((x - sum(drawn) / 20) ** 2 for x in drawn) / 19) ** 0.5 < 1.8 * sd


def test_forests_on_many_equal_rows_draw_their_numbers(spark, monkeypatch):
    # a forest was fitted on every row, copies too
    from pyspark.ml.base import Estimator
    from pyspark.ml.feature import VectorAssembler

    from pyrelith.operators import labels as L

    d = spark.range(6000).selectExpr("id AS row", "CAST(id % 3 AS INT) AS event", "CAST(xxhash64(id) % 5 AS DOUBLE) AS a", "CAST(xxhash64(id, 1) % 4 AS DOUBLE) AS b", "CAST((xxhash64(id) % 5 > 0) <> (xxhash64(id, 2) % 10 = 0) AS INT) AS label")
    forest = L.classifiers(trees=4)["forest"]
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(d).withColumn("label", d.label.cast("double"))
    # trees one by one predict as the forest that they make up
    whole = forest.fit(v)
    one = {r.row: r.prediction for r in L.Forest(whole.trees).transform(v).select("row", "prediction").collect()}
    assert one == {r.row: r.prediction for r in whole.transform(v).select("row", "prediction").collect()}
    # numbers of draws: mean and variance of equal rows drawn one by one, other numbers for each tree, the same in each run
    kinds = spark.createDataFrame([(float(k), 0.0, 1.0, w) for k in range(300) for w in (1.0, 900.0)], "a double, b double, label double, weight double").selectExpr("a + weight AS a", "b", "label", "weight")
    draws = {(r.a, r.weight): r.draws for r in L.bootstrap(kinds, 42, 4, 1.0).collect()}
    assert len(draws) == 600 and draws == {(r.a, r.weight): r.draws for r in L.bootstrap(kinds.repartition(3), 42, 4, 1.0).collect()}
    for w in (1.0, 900.0):
        n = [x for (_, u), y in draws.items() if u == w for x in y]
        mean = sum(n) / len(n)
        assert abs(mean - w) < 5 * (w / len(n)) ** 0.5 and 0.8 * w < sum((x - mean) ** 2 for x in n) / len(n) < 1.2 * w
    # no fit sees more than the distinct rows, every row is predicted
    seen, fit = [], Estimator.fit
    monkeypatch.setattr(L, "MANY_ROWS", 1000, raising=False)
    monkeypatch.setattr(Estimator, "fit", lambda self, rows, params=None: seen.append(rows.count()) or fit(self, rows, params))
    p = L.leave_one_out(d, "event", "label", ("a", "b"), {"forest": forest})
    monkeypatch.undo()
    assert len(seen) == 12 and max(seen) <= 9 * 7 * 2 * 2
    assert p.columns == [*d.columns, "model", "predicted"]
    got = p.collect()
    assert len(got) == 6000 and len({r.row for r in got}) == 6000 and all(r.predicted == (r.a > 0) for r in got)
