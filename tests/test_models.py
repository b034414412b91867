"""Classifiers across events and permutation importance on rows where the right answer is known; seeded controls by brute force."""

import math

import pytest
from pyspark.sql import functions as F

from pyrelith.operators import footprints, sites
from pyrelith.operators import labels as L
from pyrelith.plans.ingest import with_ring
from pyrelith.sources.surrogate import load


def rows_of(spark, flipped=()):
    """Two features; the first, which is 1 or -1, decides, but in flipped events the other way."""
    a = F.xxhash64("id") % 1000 / 1000.0
    d = spark.range(600).select(F.col("id").alias("row"), (F.col("id") % 3).alias("event"), F.when(a > 0, 1.0).otherwise(-1.0).alias("a"), (F.xxhash64("id", F.lit(1)) % 1000 / 1000.0).alias("b"))
    says = (F.col("a") > 0).cast("int")
    return d.withColumn("label", F.when(F.col("event").isin(*flipped), 1 - says).otherwise(says) if flipped else says)


def test_left_out_events_are_not_seen(spark):
    models = L.classifiers(trees=5, rounds=2)
    p = L.leave_one_out(rows_of(spark), "event", "label", ("a", "b"), models)
    assert p.count() == 600 * 3 and p.where("label <> predicted").count() <= 9
    wrong = L.leave_one_out(rows_of(spark, flipped=(2,)).where("event <> 1"), "event", "label", ("a", "b"), models)
    assert wrong.where("label = predicted").count() <= 9  # each event is predicted by the other, which says the opposite


def test_importance_is_that_of_the_deciding_feature(spark):
    d = rows_of(spark)
    dealt = L.dealt_anew(d, "event", ("a", "b"), "row", 42, 3)
    assert dealt.count() == 600 * 3 * 3
    for f in ("a", "b"):  # values are dealt inside an event, none is lost
        one = dealt.where((F.col("feature") == f) & (F.col("repeat") == 1)).groupBy("event").agg(F.sort_array(F.collect_list(f)).alias("v"))
        want = d.groupBy("event").agg(F.sort_array(F.collect_list(f)).alias("w"))
        assert one.join(want, "event").where("v = w").count() == 3
    got = {(r.event, r.feature): r.importance for r in L.permutation_importance(d, "event", "label", ("a", "b"), "row", {"tree": L.classifiers()["tree of depth 3"]}, repeats=3).collect()}
    assert all(got[e, "a"] > 0.4 and abs(got[e, "b"]) < 0.02 for e in range(3))


def test_controls_by_brute_force(spark, sf):
    det, adm = load(spark, sf, "v_det", "v_adm")
    avoid = det.select("longitude", "latitude").distinct()
    got = {(r.adm_id, r.i): (r.x, r.y) for r in sites.controls(with_ring(adm), avoid, seed=7, each=40, away=0.004, apart=0.01).collect()}
    every = {(r.adm_id, r.i): (r.x, r.y) for r in sites.controls(with_ring(adm), avoid.limit(0), seed=7, each=40, away=0.004, apart=0.0).collect()}
    boxes = {r.adm_id: r for r in adm.collect()}
    spots = [tuple(r) for r in avoid.collect()]
    want, taken = {}, {}
    for (a, i), (x, y) in sorted(every.items()):
        b = boxes[a]
        assert b.w <= x <= b.e and b.s <= y <= b.n and not (b.notched and x > (b.w + b.e) / 2 and y > (b.s + b.n) / 2)
        if all(math.hypot(x - p, y - q) > 0.004 for p, q in spots) and all(math.hypot(x - p, y - q) > 0.01 for p, q in taken.get(a, [])):
            taken.setdefault(a, []).append((x, y))
            want[a, i] = (x, y)
    assert got == want and want


def test_union_of_two_circles(spark):
    rows = [(1, 0.0, 0.0), (2, 0.0, 300.0 / 111_320), (3, 0.0, 5.0)]
    d = spark.createDataFrame(rows, "detection_id long, latitude double, longitude double").withColumn("frp", F.lit(1.0))
    m = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "detection_id long, event long")
    got = {r.event: r.union_ha for r in footprints.union_areas(d, m, 375.0, 1.0).collect()}
    r, gap = 375.0, 300.0
    lens = 2 * r * r * math.acos(gap / (2 * r)) - gap / 2 * math.sqrt(4 * r * r - gap * gap)
    assert got[3] == pytest.approx(math.pi * r * r / 1e4, rel=1e-3) and got[1] == pytest.approx((2 * math.pi * r * r - lens) / 1e4, rel=1e-3)


def test_registry_versions_and_splits(spark, tmp_path):
    folder = str(tmp_path / "registry")
    known, version = sites.load_registry(spark, folder)
    assert known.count() == 0 and version == 0 and sites.next_site_number(known) == 1
    first = sites.match_registry(spark.createDataFrame([(9, 0.0, 0.0), (5, 1.0, 1.0)], "n long, lat double, lon double"), known, 750.0, 1)
    sites.save_registry(first, folder, 1)
    (tmp_path / "registry" / "version=2").mkdir()  # a version whose writing was cut off
    known, version = sites.load_registry(spark, folder)
    assert version == 1 and {r.site_id for r in known.collect()} == {"R001", "R002"} and sites.next_site_number(known) == 3
    now = spark.createDataFrame([(7, 0.001, 0.0), (3, -0.002, 0.0), (1, 9.0, 9.0)], "n long, lat double, lon double")
    got = sites.match_registry(now, known, 750.0, sites.next_site_number(known))
    assert {(r.n, r.site_id, r.new) for r in got.collect()} == {(7, "R001", False), (3, "R003", True), (1, "R004", True)}
    assert [tuple(r) for r in sites.split_notes(got, now, known, 750.0).collect()] == [("R003", "split from R001")]


def test_running_sums_over_buckets(spark, monkeypatch):
    from pyrelith.operators import ordering

    monkeypatch.setattr(ordering, "BUCKET", 7)
    d = spark.range(1, 101).select(F.col("id").alias("r"), (F.col("id") % 5).alias("a"), F.lit(2).cast("long").alias("b"))
    got = {r.r: (r.a, r.b) for r in ordering.running_sums(d, "r", ["a", "b"]).collect()}
    total = 0
    for k in range(1, 101):
        total += k % 5
        assert got[k] == (total, 2 * k)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from pyrelith import runtime

    assert runtime.is_one_machine("local[4]") and runtime.is_one_machine("local") and not runtime.is_one_machine("local-cluster[3,2,1000]") and not runtime.is_one_machine("yarn")
    monkeypatch.setattr(runtime, "CHECKPOINT_KEY", "spark.no.such.folder")
    assert runtime.shared_folder(spark) == runtime.LOCAL_CHECKPOINTS
    monkeypatch.setattr(runtime, "is_one_machine", lambda master: False)
    with pytest.raises(RuntimeError):
        runtime.shared_folder(spark)
    s = runtime.Scratch
    monkeypatch.undo()
    t = s(spark, "drop")
    t.table(spark.range(3), "a")
    assert t.bytes("a") > 0
    t.drop("a")
    with pytest.raises(Exception):
        t.bytes("a")


def test_late_rows_of_a_cell_are_counted(spark, sf, tmp_path):
    from pyrelith.streaming import operators as S

    wx = load(spark, sf, "v_wx")[0].where("cell = 2 and date < DATE'1994-01-01'").orderBy("date").limit(40)
    p = str(tmp_path / "wx")
    days = wx.collect()
    spark.createDataFrame(days[10:], wx.schema).coalesce(1).write.parquet(p)
    q = S.moisture_codes(spark.readStream.schema(wx.schema).parquet(p)).writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
    q.start().awaitTermination()
    spark.createDataFrame(days[:10], wx.schema).coalesce(1).write.mode("append").parquet(p)
    q.start().awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == len(days) and {r.date for r in S.late_days(out).collect()} == {d.date for d in days[:10]}


def test_density_clusters_by_brute_force(spark):
    """Core points, border points of the earliest event, copies of a place and second, and points alone, for several numbers of samples."""
    import random

    from pyrelith.operators import events as E

    rng = random.Random(4)
    rows = []
    for i in range(160):
        x, y, t = rng.randrange(9), rng.randrange(9), rng.randrange(6)
        rows.append((i, -1.0 + y * 0.002, 136.0 + x * 0.002, 1_700_000_000 + t * 3600))
    rows += [(200 + k, *rows[k][1:]) for k in range(12)]
    d = spark.createDataFrame(rows, "detection_id long, latitude double, longitude double, at long").withColumn("datetime_utc", F.timestamp_seconds("at"))
    k = 111_320.0
    mean = sum(r[1] for r in rows) / len(rows)

    def near(a, b):
        return abs(a[3] - b[3]) <= 3600 and math.hypot((a[2] - b[2]) * k * math.cos(math.radians(mean)), (a[1] - b[1]) * k) <= 300

    for samples in (1, 2, 3, 4, 6):
        core = [r for r in rows if sum(near(r, q) for q in rows) >= samples]
        label = {r[0]: r[0] for r in core}
        changed = True
        while changed:
            changed = False
            for a in core:
                for b in core:
                    if near(a, b) and label[a[0]] != label[b[0]]:
                        label[a[0]] = label[b[0]] = min(label[a[0]], label[b[0]])
                        changed = True
        groups = {}
        for r in core:
            groups.setdefault(label[r[0]], []).append(r)
        seed = {g: min((r[3], r[0]) for r in rs) for g, rs in groups.items()}
        for r in rows:
            if r[0] not in label:
                reach = [label[c[0]] for c in core if near(r, c)]
                if reach:
                    groups[min(reach, key=seed.get)].append(r)
        want = {r[0]: r[0] for r in rows}
        for rs in groups.values():
            for r in rs:
                want[r[0]] = min((q[3], q[0]) for q in rs)[1]
        got = {r.detection_id: r.event for r in E.st_dbscan(d, 300.0, 3600, samples).collect()}
        assert got == want, samples
