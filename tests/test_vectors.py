"""Published and hand-computed values, and brute-force twins of the bucketed joins and folds."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pyrelith.functions import fire_weather as W
from pyrelith.functions import scalar as S
from pyrelith.operators import climatology, events, geo, recurrence, statistics
from pyrelith.operators.components import connected_components
from pyrelith.operators.rasters import patches, window_median
from pyrelith.runtime import Scratch
from pyrelith.sources.surrogate import load


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_fwi_reference_day(spark):
    t, h, w, r = F.lit(17.0), F.lit(42.0), F.lit(25.0), F.lit(0.0)
    f, m, c = W.ffmc_step(F.lit(85.0), t, h, w, r), W.dmc_step(F.lit(6.0), t, h, r, 12.8), W.dc_step(F.lit(15.0), t, r, 0.9)
    i, b = W.isi(f, w), W.bui(m, c)
    got = one(spark, f, m, c, i, b, W.fwi(i, b))
    assert [round(x, 2) for x in got] == pytest.approx([87.69, 8.55, 19.01, 10.85, 8.49, 10.10], abs=0.011)


@pytest.mark.parametrize("rain,code", [(0.5, "ffmc"), (1.5, "dmc"), (2.8, "dc")])
def test_rain_edges(spark, rain, code):
    step = {"ffmc": lambda r: W.ffmc_step(F.lit(85.0), F.lit(20.0), F.lit(50.0), F.lit(10.0), r), "dmc": lambda r: W.dmc_step(F.lit(30.0), F.lit(20.0), F.lit(50.0), r, 9.0), "dc": lambda r: W.dc_step(F.lit(100.0), F.lit(20.0), r, 1.39)}[code]
    dry, edge, wet = one(spark, step(F.lit(0.0)), step(F.lit(rain)), step(F.lit(rain + 5)))
    assert dry == pytest.approx(edge) and wet < edge


def test_average_precision_vectors(spark):
    def ap(scores, labels):
        d = spark.createDataFrame([("g", float(s), bool(x)) for s, x in zip(scores, labels)], "g string, score double, positive boolean")
        return climatology.average_precision(d, ["g"]).first()["ap"]

    assert ap([0.9, 0.8, 0.7], [1, 0, 1]) == pytest.approx(5 / 6)
    assert ap([0.5, 0.5], [1, 0]) == pytest.approx(0.5)
    assert ap([0.9, 0.5, 0.5], [0, 1, 1]) == pytest.approx(2 / 3)
    assert ap([0.9, 0.1], [0, 0]) is None


def test_wilson_and_stratified_area(spark):
    lo, hi = statistics.wilson(F.lit(0.0), F.lit(10.0))
    a, b = one(spark, lo, hi)
    assert a == 0 and 0.27 < b < 0.29
    assert tuple(one(spark, *statistics.wilson(F.lit(0.0), F.lit(0.0)))) == (0, 0)
    s = spark.createDataFrame([(819.1, 15, 20), (812.8, 0, 10)], "area double, k long, n long")
    r = statistics.stratified_area(s).first()
    assert round(r.p, 4) == 0.3764 and round(r.se, 4) == 0.0499 and round(r.low) == 455 and round(r.high) == 774


def test_kappa_edges(spark):
    d = spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")
    assert statistics.cohen_kappa(d, "a", "b", []).first()["kappa"] == 1
    assert statistics.cohen_kappa(d.where("a > 5").withColumn("g", F.lit(1)), "a", "b", ["g"]).count() == 0


def test_pearson_edges(spark):
    d = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 3.0), (1, 1.0, 4.0), (2, 1.0, 2.0)], "g int, x double, y double")
    assert [r["r"] for r in statistics.pearson(d, ["g"], "x", "y").collect()] == [None, None]


def test_circle_days(spark):
    d = [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2023, 3, 1), dt.date(2024, 12, 31)]
    rows = spark.createDataFrame([(x,) for x in d], "d date").select(S.circle_day("d")).collect()
    assert [r[0] for r in rows] == [59, 59, 60, 60, 365]
    assert one(spark, S.circle_distance(F.lit(364), F.lit(3)))[0] == 4


def test_angles_and_time(spark):
    assert one(spark, S.angle_between(F.lit(355.0), F.lit(5.0)))[0] == 10
    assert one(spark, S.compass(F.lit(337.5)), S.compass(F.lit(337.4)))[:] == ("N", "NW")
    got = spark.createDataFrame([("2026-08-22", "627"), ("2026-08-22", "x")], "d string, t string").select(S.acquisition_time("d", "t")).collect()
    assert got[0][0] == dt.datetime(2026, 8, 22, 6, 27) and got[1][0] is None


def test_covers_concave_and_boundary(spark):
    ring = geo.rectangle_ring(F.lit(0.0), F.lit(0.0), F.lit(4.0), F.lit(4.0), F.lit(True))
    pts = [(1, 1, True), (3, 3, False), (2, 3, True), (3, 2, True), (0, 0, True), (4, 4, False), (2, 4, True), (-1, 1, False), (3, 1, True)]
    d = spark.createDataFrame([(float(x), float(y), w) for x, y, w in pts], "x double, y double, w boolean")
    assert d.where(geo.covers(ring, F.col("x"), F.col("y")) != F.col("w")).count() == 0


def test_space_time_pairs_against_all_pairs(spark, sf):
    det = load(spark, sf, "v_det")[0].limit(400).cache()
    rows = det.collect()
    k = math.cos(math.radians(sum(r.latitude for r in rows) / len(rows))) * S.M_PER_DEG
    want = set()
    for a in rows:
        for b in rows:
            if a.detection_id < b.detection_id and abs(int(a.datetime_utc.timestamp()) - int(b.datetime_utc.timestamp())) <= 108_000:
                if ((a.longitude - b.longitude) * k) ** 2 + ((a.latitude - b.latitude) * S.M_PER_DEG) ** 2 <= 750**2:
                    want.add((a.detection_id, b.detection_id))
    for n in (1, 7):
        got = geo.space_time_pairs(det.repartition(n), 750.0, 108_000).select("a", "b").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    d = spark.createDataFrame(edges or [], "a long, b long")
    for few in (0, 1000):
        got = {r.node: r.component for r in connected_components(d, Scratch(spark, "t"), few=few).collect()}
        assert got == {x: find(x) for x in parent}


def test_leader_clusters_equal_one_fold(spark):
    rng = random.Random(5)
    rows = [(i, dt.date(2020, 1, 1 + rng.randrange(5)), rng.random() * 0.05, rng.random() * 0.05, rng.choice([None, rng.random()])) for i in range(150)]
    d = spark.createDataFrame(rows, "detection_id long, date_wit date, longitude double, latitude double, frp double")
    got = {r.detection_id: r.cluster for r in recurrence.leader_clusters(d, 750.0).collect()}
    o = sorted(rows, key=lambda r: (r[1], r[3], r[2], r[0]))
    c = recurrence.fold_leaders(np.array([r[2] for r in o]), np.array([r[3] for r in o]), 750 / S.M_PER_DEG, True)
    first = {}
    for r, k in zip(o, c):
        first.setdefault(k, r[0])
    assert got == {r[0]: first[k] for r, k in zip(o, c)}


def test_nearest_segment_against_all(spark):
    rng = random.Random(2)
    pts = [(i, rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(60)]
    seg = [(*[rng.uniform(0, 10) for _ in range(4)], f"c{i}") for i in range(12)]

    def dist(p, s):
        (x1, y1, x2, y2), dx, dy = s[:4], s[2] - s[0], s[3] - s[1]
        t = max(0, min(1, ((p[1] - x1) * dx + (p[2] - y1) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[1] - x1 - t * dx, p[2] - y1 - t * dy)

    got = {r.id: (r.metres, r.cls) for r in geo.nearest_segment(spark.createDataFrame(pts, "id int, x double, y double"), spark.createDataFrame(seg, "x1 double, y1 double, x2 double, y2 double, cls string"), 0.8).collect()}
    for p in pts:
        d, c = min((dist(p, s), s[4]) for s in seg)
        assert got[p[0]] == ((pytest.approx(d), c) if d <= 0.8 else (None, None))
    assert len(got) == 60


def test_stable_ids_merge_and_new(spark):
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (9, 9), (10, 9)], "detection_id long, event long")
    prior = spark.createDataFrame([(1, "E0001"), (2, "E0001"), (3, "E0002")], "detection_id long, event_id string")
    got = {r.event: (r.event_id, r.merged) for r in events.stable_ids(members, prior, 7).collect()}
    assert got == {1: ("E0001", "E0002"), 9: ("E0007", "")}


def test_dbscan_border_and_noise(spark):
    at = dt.datetime(2024, 1, 1)
    x = [0.0, 0.001, 0.002, 0.003, 0.5]
    d = spark.createDataFrame([(i, at + dt.timedelta(minutes=i), v, 0.0) for i, v in enumerate(x)], "detection_id long, datetime_utc timestamp, longitude double, latitude double")
    got = {r.detection_id: r.event for r in events.st_dbscan(d, 130.0, 3600, 3).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}
    assert events.st_dbscan(d.limit(0), 130.0, 3600).count() == 0


def test_window_median_and_patches(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1000, (20, 20))
    d = spark.createDataFrame([(1, i, j, int(a[i, j])) for i in range(20) for j in range(20) if (i * j) % 7 != 3], "scene int, x long, y long, dn int")
    got = {(r.x, r.y): r.background for r in window_median(d, "dn", 2, 20, 6).collect()}
    have = {(r.x, r.y): r.dn for r in d.collect()}
    for (x, y), v in got.items():
        around = [have[i, j] for i in range(x - 2, x + 3) for j in range(y - 2, y + 3) if (i, j) in have and (i, j) != (x, y)]
        assert v == np.median(around)
    assert set(got) == {(x, y) for x, y in have if 2 <= x < 18 and 2 <= y < 18}
    p = spark.createDataFrame([(0, 0, 0), (0, 1, 1), (0, 5, 5), (1, 0, 0)], "scene int, x long, y long")
    assert sorted(tuple(r) for r in patches(p, 100).collect()) == [(0, 2), (505, 1), (10000, 1)]
