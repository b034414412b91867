"""Findings of round three, each by its number."""

import duckdb
import pytest
from pyspark.sql import functions as F

from pyrelith.plans import ORACLES, QUERIES


def test_tiles_beyond_the_map(spark, tmp_path):
    # latitudes above the map's edge, as users of large tables have
    duckdb.sql("SELECT range AS event_id, TIMESTAMP '2024-01-01' AS ts, range * 1000 AS user_id, 'view' AS event_type, 1.0 AS value FROM range(90)").write_parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in QUERIES["h30_tiles"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    rows = c.execute(ORACLES["h30_tiles"]).fetchall()
    assert got == set(rows) and min(r[2] for r in rows) < 0


def test_station_records_without_pairs(spark):
    # sums of blocks of seconds instead of one row for each event and report
    import random

    from pyrelith.operators import stations

    rng = random.Random(1)
    windows = [(k, t := rng.randrange(-50, 4000), t + rng.choice([-400, 0, 1, 63, 700, 9000]), 1.0, rng.choice([0.0, 10.5, 200.0, 359.0])) for k in range(60)]
    reports = [(k, rng.choice([rng.randrange(5000), 77]), rng.choice([None, 0.25, 2.0, 6.21]), rng.random() < 0.3, rng.choice([None, 0.0, 55.0, 180.0, 350.0]), rng.choice([0.0, 3.0, 4.0]), rng.random() < 0.1, rng.random() < 0.2) for k in range(400)]
    e = spark.createDataFrame(windows, "event long, t0 long, t1 long, km double, bearing double")
    o = spark.createDataFrame(reports, "obs_id long, at long, vsby double, ceiling boolean, dir double, sknt double, fu boolean, hz boolean")
    df = stations.station_records(e, o, 120, 45.0)
    got = {r.event: r for r in df.collect()}
    held = {w[0]: [r for r in reports if w[1] <= r[1] <= w[2] + 120] for w in windows}
    for k, _, _, _, bearing in windows:
        h = held[k]
        smoke = {r[0] for r in h if r[6]}
        off = lambda d: min((d - bearing) % 360, (bearing - d) % 360)
        blown = sum(1 for r in h if r[6] and r[4] is not None and r[5] > 0 and off(r[4]) <= 45)
        seen = [r[2] for r in h if r[2] is not None]
        others = sum(1 for j in held if j != k and smoke & {r[0] for r in held[j] if r[6]})
        r = got[k]
        assert (r.n_obs, r.n_fu, r.n_hz, r.n_fu_from, r.n_concurrent, r.vsby_min) == (len(h), len(smoke), sum(x[7] for x in h), blown, others, min(seen, default=None))
        assert r.ceiling_share == (sum(x[3] for x in h) / len(seen) if seen else None)
    assert "day#" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_reports_of_a_window_meet_it_by_the_hour(spark):
    # a window is held against the reports of its hours, not of its days
    from pyrelith.operators import stations

    e = spark.createDataFrame([(1, 3599, 3600), (2, 7200, 90_000), (3, 5, 1)], "event long, t0 long, t1 long")
    o = spark.createDataFrame([(k, k * 600) for k in range(200)], "obs_id long, at long")
    df = stations.reports_in_window(e, o, 600)
    assert sorted((r.event, r.obs_id) for r in df.collect()) == [(w, k) for w, lo, hi in ((1, 3599, 4200), (2, 7200, 90_600), (3, 5, 601)) for k in range(200) if lo <= k * 600 <= hi]
    assert "3600" in df._jdf.queryExecution().optimizedPlan().toString()


def test_many_groups_in_one_sweep():
    # pairs of shapes are swept many at once, and batches may cut a group
    import random

    import numpy as np
    import pandas as pd

    from pyrelith.operators import overlay

    rng = random.Random(5)
    rows, want = [], {}
    for g in range(200):
        key = None if g == 199 else g
        cells: dict = {}
        for shape in range(rng.randrange(1, 5)):
            x, y, w, h, layer = *(rng.randrange(6) for _ in "xy"), *(rng.randrange(1, 4) for _ in "wh"), rng.choice([1, 2, 4])
            rows += [(key, layer, shape, float(x), float(v), float(x + w), float(v)) for v in (y, y + h)]
            for c in ((x + i, y + j) for i in range(w) for j in range(h)):
                cells[c] = cells.get(c, 0) | layer
        for m in cells.values():
            want[key, m] = want.get((key, m), 0.0) + 1
    d = pd.DataFrame(rows, columns=["g", "layer", "shape", "xa", "ya", "xb", "yb"])
    got = {}
    for size in (1, 7, 100_000):
        got[size] = {}
        for b in overlay.whole_groups((d.iloc[k : k + size] for k in range(0, len(d), size)), ["g"]):
            new = overlay.runs(b["g"].to_numpy())
            g, m, a = overlay.sweep_groups(b[["xa", "ya", "xb", "yb"]].to_numpy(), b["layer"].to_numpy(), b["shape"].to_numpy(), np.cumsum(new) - 1)
            names = b["g"].to_numpy()[np.flatnonzero(new)[g]]
            for k, mask, area in zip(names, m.tolist(), a.tolist(), strict=True):
                k = None if pd.isna(k) else int(k)
                assert (k, mask) not in got[size]
                got[size][k, mask] = area
    assert got[1] == got[7] == got[100_000] and {k: a for k, a in got[1].items() if a} == want


def test_quantiles_from_counts(spark):
    # exact quantiles of groups that no task holds
    from pyrelith.operators import statistics

    rows = [("a", float(k % 7), 1 + k % 3) for k in range(20)] + [("b", 2.5, 1), ("c", 1.0, 1), ("c", 2.0, 4)]
    d = spark.createDataFrame(rows, "g string, v double, k long").groupBy("g", "v").agg(F.sum("k").alias("k"))
    got = {r.g: (r.low, r.mid) for r in statistics.counted_quantiles(d, ["g"], "v", "k", {"low": 0.1, "mid": 0.5}).collect()}
    want = d.withColumn("v", F.explode(F.array_repeat("v", F.col("k").cast("int")))).groupBy("g").agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5))).alias("q")).collect()
    assert got == {r.g: tuple(r.q) for r in want}


def test_a_crowd_at_one_place_makes_no_pairs(spark, monkeypatch):
    # detections of one place within the reach in time are one stack, not all pairs
    from pyrelith.operators import events as E

    seen = []
    whole = E.connected_components
    monkeypatch.setattr(E, "connected_components", lambda edges, *rest: seen.append(edges.count()) or whole(edges, *rest))
    # 400 at one place within two days, four of the six-hour stretches empty, and one beside them that only the last reaches
    d = spark.range(400).selectExpr("id AS detection_id", "timestamp_seconds(1704067200 + id * 108 + CASE WHEN id >= 200 THEN 86400 ELSE 0 END) AS datetime_utc", "-1.0D AS latitude", "135.0D AS longitude")
    d = d.unionByName(spark.sql("SELECT 400L AS detection_id, timestamp_seconds(1704067200 + 399 * 108 + 86400 + 21600) AS datetime_utc, -1.0D AS latitude, 135.003D AS longitude"))
    got = {r.detection_id: r.event for r in E.st_dbscan(d, 375.0, 21_600).collect()}
    assert got == {k: 0 if k < 200 else 200 for k in range(401)}
    assert seen and max(seen) <= 10


def test_importance_writes_no_dealt_rows(spark, monkeypatch):
    # rows that are dealt anew are predicted and counted, not written for each repeat and feature
    from pyrelith.operators import labels as L

    written = []

    class Counted(L.Scratch):
        def table(self, df, name):
            out = super().table(df, name)
            written.append(out.count())
            return out

    for module in (L, __import__("pyrelith.operators.ordering", fromlist=["Scratch"])):
        monkeypatch.setattr(module, "Scratch", Counted)
    monkeypatch.setattr(L, "BLOCK_ROWS", 40, raising=False)
    d = spark.range(600).selectExpr("id AS row", "id % 3 AS event", "CAST(xxhash64(id) % 100 AS DOUBLE) AS a", "CAST(xxhash64(id, 1) % 100 AS DOUBLE) AS b").selectExpr("*", "CAST(a > 0 AS INT) AS label")
    models = {"tree": L.classifiers()["tree of depth 3"]}
    got = {(r.event, r.feature): r.importance for r in L.permutation_importance(d, "event", "label", ("a", "b"), "row", models, repeats=3).collect()}
    assert len(got) == 6 and all(got[e, "a"] > 0.4 and abs(got[e, "b"]) < 0.02 for e in range(3))
    assert max(written) <= 600
    dealt = L.dealt_anew(d, "event", ("a", "b"), "row", 42, 3)
    moved = dealt.where("feature = 'b' and repeat = 2").join(d.select("row", F.col("b").alias("own")), "row")
    assert moved.where("b <> own").count() > 500


def test_regions_settle_most_components(spark, monkeypatch):
    # Only what several regions share is joined by rounds
    import random

    from pyrelith.operators import components
    from pyrelith.runtime import Scratch

    rng = random.Random(3)
    chains = [(1000 * c + k, 1000 * c + k + 1, c if k < 30 else -1) for c in range(50) for k in range(rng.randrange(1, 30))] + [(5, 3009, 7), (3009, 7004, 8), (None, 4, 1), (70_000, 70_000, 2)]
    rng.shuffle(chains)
    edges = spark.createDataFrame(chains, "a long, b long, r int")
    seen = []
    whole = components.connected_components
    rounds = lambda links, *rest: seen.append(links.count()) or whole(links, *rest)
    for most in (200_000, 7):
        monkeypatch.setattr(components, "MOST_EDGES", most)
        got = {tuple(r) for r in components.components_by_region(edges, [F.col("r")], Scratch(spark, "regions"), rounds).collect()}
        assert got == {tuple(r) for r in whole(edges, Scratch(spark, "rounds")).collect()}
    assert seen[0] <= 4


def test_union_of_circles_moves_circles(spark):
    # F16: circles move, not their lines of pixels; blocks and batches may cut an event
    from pyrelith.operators import footprints

    rows = [(k, k % 3 if k < 60 else 100 + k, -1.39 + (k * 7919 % 97) * 0.0011, 134.3 + (k * 104_729 % 89) * 0.0013) for k in range(90)]
    d = spark.createDataFrame([(k, y, x) for k, _, y, x in rows], "detection_id long, latitude double, longitude double")
    members = spark.createDataFrame([(k, e) for k, e, _, _ in rows], "detection_id long, event long")
    on_plane = {r.detection_id: (r.px, r.py) for r in footprints.on_plane(d).collect()}
    want: dict = {}
    for k, e, _, _ in rows:
        px, py = on_plane[k]
        cells = want.setdefault(e, set())
        for i in range(int((px - 375) // 25), int((px + 375) // 25) + 2):
            cells.update((i, j) for j in range(int((py - 375) // 25), int((py + 375) // 25) + 2) if ((i + 0.5) * 25 - px) ** 2 + ((j + 0.5) * 25 - py) ** 2 <= 375**2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = footprints.union_areas(d, members, 375.0, 25.0)
        got = {r.event: r.union_ha for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {e: len(c) * 0.0625 for e, c in want.items()}
    assert "line" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_prior_day_needs_no_members(spark):
    # places and days are met, not each detection; copies of a place are one row
    import datetime

    from pyrelith.operators import footprints

    day = lambda k: datetime.date(2024, 1, k)
    rows = [(1, 0.0, 5, 1.0), (2, 0.001, 6, 2.0), (3, 0.0, 3, None), (4, 0.0, 3, 7.0), (5, 0.002, 3, 9.0), (6, 0.001, 2, 50.0), (7, 0.02, 4, 8.0), (8, 0.0, 5, 3.0), (9, 0.02, 9, None)]
    d = spark.createDataFrame([(k, 0.0, x, f, day(n)) for k, x, n, f in rows], "detection_id long, latitude double, longitude double, frp double, date_wit date")
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6), (7, 7), (8, 1), (9, 7)], "detection_id long, event long")
    df = footprints.latest_prior(d, members, 375.0)
    assert {r.event: (r.prior_day, r.prior_frp, r.prior_n) for r in df.collect()} == {1: (day(3), 9.0, 3), 3: (day(2), 50.0, 1), 7: (None, None, 0)}
    assert "own" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_events_of_one_circle_meet_nobody(spark):
    # an event of one place has the circle's area without a look around
    import math

    from pyrelith.operators import footprints

    d = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 1.0), (4, 0.0, 1.002), (5, 0.0, 1.006)], "detection_id long, latitude double, longitude double")
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)], "detection_id long, event long")
    got = {r.event: r.union_ha for r in footprints.circle_unions(d, members, 375.0).collect()}
    gap = lambda m: 2 * 375**2 * math.acos(m / 750) - m / 2 * math.sqrt(4 * 375**2 - m * m)
    assert math.isclose(got[1], math.pi * 375**2 / 1e4)
    assert math.isclose(got[3], (3 * math.pi * 375**2 - gap(0.002 * 111320) - gap(0.004 * 111320)) / 1e4, rel_tol=1e-9)


def test_lists_are_known_without_a_join(spark, monkeypatch):
    # pipeline, near dedup: what is known of a list comes from a window over its parts, not from a join with every post
    import re

    from pyrelith.llm import near_dedup

    plans = {}

    class Seen(near_dedup.Scratch):
        def table(self, df, name):
            plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
            return super().table(df, name)

    monkeypatch.setattr(near_dedup, "Scratch", Seen)
    common = " ".join(f"w{k}" for k in range(40))
    texts = [(k, f"{common} " + " ".join(f"t{k}x{j}" for j in range(6))) for k in range(12)] + [(100 + k, f"{common} end{k}") for k in range(3)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_components(d, percent=85, block_rows=3).collect()}
    assert {k: got[k] for k in (100, 101, 102)} == {100: 100, 101: 100, 102: 100}
    for name in ("posted", "star", "open", "merged"):
        assert not re.search(r"Join Inner, \(token#\d+L = token#\d+L\)", plans[name]), name


def test_a_high_stack_is_cut_shape_by_shape():
    # in one slab, pairs of shapes that cross each at another place; every cut went through all edges of the slab
    import random
    import tracemalloc

    import numpy as np

    from pyrelith.operators import overlay

    rng = random.Random(3)
    pairs = []
    for k in range(400):
        y, end = 10.0 * k, rng.uniform(-1, 1)
        pairs.append([(0, y, 1, y + 2, 1, 2 * k), (0, y + 1, 1, y + 3, 1, 2 * k), (0, y + 2, 1, y + end, 2, 2 * k + 1), (0, y + 3, 1, y + end + 1, 2, 2 * k + 1)])
    split = lambda rows: (np.array([r[:4] for r in rows], dtype=float), np.array([r[4] for r in rows]), np.array([r[5] for r in rows]))
    want: dict[int, float] = {}
    for p in pairs:
        for m, a in overlay.sweep(*split(p)).items():
            want[m] = want.get(m, 0.0) + a
    tracemalloc.start()
    got = overlay.sweep(*split([r for p in pairs for r in p]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == pytest.approx(want, abs=1e-9) and sorted(got) == [1, 2, 3] and sum(got.values()) < 800
    assert peak < 8 << 20


@pytest.mark.parametrize("few", [4, 512])
def test_crowded_crossings_in_one_slab(few, monkeypatch):
    # one block of 60 bands that all cross one another, halved or compared at once, against a fine grid
    import random

    import numpy as np

    from pyrelith.operators import overlay

    monkeypatch.setattr(overlay, "FEW", few)
    rng = random.Random(few)
    bands = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(60)]
    rows = [(0, a + d, 1, b + d, 1 << k % 3, k) for k, (a, b) in enumerate(bands) for d in (0.0, 0.05)]
    got = overlay.sweep(np.array([r[:4] for r in rows], dtype=float), np.array([r[4] for r in rows]), np.array([r[5] for r in rows]))
    x, y = np.meshgrid((np.arange(400) + 0.5) / 400, (np.arange(4000) + 0.5) / 4000 * 9.1)
    mask = np.zeros(x.shape, dtype=int)
    for k, (a, b) in enumerate(bands):
        low = a + (b - a) * x
        mask |= (1 << k % 3) * ((low <= y) & (y < low + 0.05))
    for m in range(1, 8):
        assert got.get(m, 0.0) == pytest.approx((mask == m).mean() * 9.1, abs=0.004)


def test_shapes_of_a_small_file_are_dealt_to_all_cores(spark, sf):
    # a file of one task made all text, rings and edges in that task
    from pyrelith.plans import shapes

    customer = spark.read.parquet(f"{sf}/customer.parquet")
    assert customer.rdd.getNumPartitions() == 1
    assert shapes.features(customer).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_models_that_draw_nothing_get_equal_rows_once(spark, monkeypatch):
    # boosting went over every row again in each round, copies too
    from pyspark.ml.base import Estimator
    from pyspark.ml.feature import VectorAssembler

    from pyrelith.operators import labels as L

    d = spark.range(1200).selectExpr("id AS row", "CAST(id % 3 AS INT) AS event", "CAST(id % 5 AS DOUBLE) AS a", "CAST(id % 4 AS DOUBLE) AS b", "CAST(id % 20 < 9 AS INT) AS label")
    models = L.classifiers(trees=3, rounds=3)
    seen, fit = set(), Estimator.fit

    def record(self, rows, params=None):
        weighted = self.isDefined(self.weightCol) and bool(self.getWeightCol())
        seen.add((type(self).__name__, rows.count(), rows.selectExpr("sum(weight)").first()[0] if weighted else None))
        return fit(self, rows, params)

    monkeypatch.setattr(Estimator, "fit", record)
    p = L.leave_one_out(d, "event", "label", ("a", "b"), models)
    monkeypatch.undo()
    assert seen == {("GBTClassifier", 40, 800.0), ("RandomForestClassifier", 800, None), ("DecisionTreeClassifier", 40, 800.0)}
    got = {(r.row, r.model): r.predicted for r in p.collect()}
    assert len(got) == 3600 and p.columns == [*d.columns, "model", "predicted"]
    # as models that are fitted on all rows predict
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(d)
    for name in ("boosted trees", "tree of depth 3"):
        whole = models[name].fit(v.where("event <> 1").selectExpr("features", "CAST(label AS DOUBLE) AS label")).transform(v.where("event = 1"))
        assert all(got[r.row, name] == r.prediction for r in whole.select("row", "prediction").collect())
