"""Streams over files, run until what is there has been read, against the batch answers."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pyrelith.operators import fire_danger
from pyrelith.sources.surrogate import load
from pyrelith.streaming import operators as S


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("stream") / "events")
    spark.read.parquet(f"{sf}/events.parquet").orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 400).parquet(p)
    return p


def drained(df, mode, tmp_path):
    q = df.writeStream.format("memory").queryName("out").outputMode(mode).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table("out").collect()


def source(spark, folder):
    return S.detections(spark, folder, spark.read.parquet(folder).schema)


def test_closed_days_and_weeks(spark, folder, tmp_path):
    rows = drained(S.closed_days(source(spark, folder)), "append", tmp_path)
    batch = spark.read.parquet(folder).groupBy(F.to_date(F.col("ts") + F.expr("INTERVAL '9' HOUR")).alias("d")).count().collect()
    want = {r.d: r["count"] for r in batch}
    assert rows and all(want[r.day] == r.n for r in rows)


def test_once(spark, folder, tmp_path):
    twice = source(spark, folder).select("event_id", "at", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    rows = drained(S.once(twice), "append", tmp_path)
    assert len(rows) == spark.read.parquet(folder).count()


def test_moisture_codes_equal_the_batch_series(spark, sf, tmp_path):
    wx = load(spark, sf, "v_wx")[0].where("cell = 1 and date < DATE'1996-06-01'")
    p = str(tmp_path / "wx")
    wx.orderBy("date").coalesce(1).write.option("maxRecordsPerFile", 40).parquet(p)
    rows = drained(S.moisture_codes(spark.readStream.schema(wx.schema).option("maxFilesPerTrigger", 1).parquet(p).withColumn("date", F.col("date"))), "append", tmp_path)
    want = {r.date: r for r in fire_danger.series(wx, fire_danger.Settings(spin_up=0)).collect()}
    assert len(rows) == len(want)
    for r in rows:
        assert r.dc == pytest.approx(want[r.date].dc) and r.kbdi == pytest.approx(want[r.date].kbdi)


def test_upsert(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    w = S.upsert(store, "event_id")
    d = spark.read.parquet(folder)
    w(d.limit(0), 0)
    w(d.where("event_id < 50"), 1)
    w(d.where("event_id < 80").withColumn("value", F.lit(-1.0)), 2)
    got = spark.read.parquet(store)
    assert got.count() == 80 and got.where("value = -1").count() == 30


def test_upsert_survives_a_crash_at_any_step(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    w = S.upsert(store, "event_id")
    d = spark.read.parquet(folder)
    w(d.where("event_id < 40"), 0)
    # a batch that was cut off: rows, but no mark of success
    d.where("event_id between 40 and 59").withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{store}/batch=1")
    (tmp_path / "store" / "batch=1" / "_SUCCESS").unlink(missing_ok=True)
    assert S.read_store(spark, store).count() == 40
    w(d.where("event_id < 80"), 1)  # the batch comes again
    w(d.where("event_id < 80"), 1)  # and once more, after it was written
    w(d.where("event_id < 90"), 2)
    got = S.read_store(spark, store)
    assert got.count() == 90 and got.select("event_id").distinct().count() == 90


def stream_into(spark, folder, store, checkpoint, only, value=None):
    rows = source(spark, folder).where(only)
    rows = rows if value is None else rows.withColumn("value", F.lit(value))
    q = rows.select("event_id", "value").writeStream.foreachBatch(S.upsert(store, "event_id")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None


def test_upsert_over_new_checkpoints_and_two_streams(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    stream_into(spark, folder, store, str(tmp_path / "one"), "event_id < 30")
    stream_into(spark, folder, store, str(tmp_path / "one"), "event_id < 30")  # nothing new
    stream_into(spark, folder, store, str(tmp_path / "two"), "event_id < 50", -1.0)  # another checkpoint starts at batch 0 again
    stream_into(spark, folder, store, str(tmp_path / "three"), "event_id between 40 and 69", -2.0)
    got = S.read_store(spark, store)
    assert got.count() == got.select("event_id").distinct().count() == 70
    assert (got.where("value = -1").count(), got.where("value = -2").count()) == (20, 20)


def test_upsert_that_loses_its_line_looks_again(spark, folder, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    d = spark.read.parquet(folder).select("event_id", "value")
    commit, other = S.Store.commit, []

    def slow(self, place, run, number, name):
        if run == "late" and not other:  # another stream commits between this one's look and its commit
            other.append(S.upsert(store, "event_id", run="early")(d.where("event_id < 40").withColumn("value", F.lit(-1.0)), 0))
        return commit(self, place, run, number, name)

    monkeypatch.setattr(S.Store, "commit", slow)
    S.upsert(store, "event_id", run="late")(d.where("event_id between 20 and 59"), 0)
    got = S.read_store(spark, store)
    assert got.count() == got.select("event_id").distinct().count() == 60 and got.where("value = -1").count() == 40
    assert [x["run"] for x in S.Store(spark, store).log()] == ["early", "late"]


def test_upsert_reads_only_the_buckets_of_its_batch(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    d = spark.read.parquet(folder).select("event_id", "value")
    S.upsert(store, "event_id", run="a")(d.where("event_id < 200"), 0)
    one = S.read_store(spark, store, with_bucket=True).where("event_id = 3").first().bucket
    for part in (tmp_path / "store").glob("batch=*/bucket=*"):
        if part.name != f"bucket={one}":
            for f in part.iterdir():
                f.write_bytes(b"broken")  # whoever reads it fails
    S.upsert(store, "event_id", run="a")(d.where("event_id = 3"), 1)
    assert len(S.Store(spark, store).log()) == 2


def test_days_close_only_after_a_fetch(spark, folder, tmp_path):
    days = sorted({r.d for r in spark.read.parquet(folder).select(F.to_date(F.col("ts") + F.expr("INTERVAL '9' HOUR")).alias("d")).distinct().collect()})
    close = {d: dt.datetime(d.year, d.month, d.day, 15, tzinfo=dt.timezone.utc) for d in days}
    hour = dt.timedelta(hours=1)
    end = close[days[2]] + 59 * 24 * hour
    runs = [
        (close[days[1]], days[1], 1, "fetched"),  # at the close
        (close[days[2]] - dt.timedelta(microseconds=1), days[2], 1, "fetched"),  # too early
        (close[days[3]] + hour, days[3], 1, "failed"),
        (close[days[4]] + hour, days[4] - dt.timedelta(days=1), 1, "cached"),  # covers the evening before
        (close[days[4]] + 2 * hour, days[4], 1, "fetched"),
        (close[days[6]] + hour, days[5], 2, "fetched"),  # two days at once
        (end, days[0] - dt.timedelta(days=40), 1, "failed"),
    ]
    p = str(tmp_path / "runs")
    fetched = spark.createDataFrame(runs, "ran_at timestamp, chunk_start date, days int, outcome string")
    fetched.orderBy("ran_at").coalesce(1).write.option("maxRecordsPerFile", 3).parquet(p)
    counts = {r.d: r["count"] for r in spark.read.parquet(folder).groupBy(F.to_date(F.col("ts") + F.expr("INTERVAL '9' HOUR")).alias("d")).count().collect()}
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        det = S.detections(spark, folder, spark.read.parquet(folder).schema)
        stream = S.observed_days(det, spark.readStream.schema(fetched.schema).option("maxFilesPerTrigger", 1).parquet(p))
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination(240)
        assert q.exception() is None

    run()
    # a restart with one more record: a day that had no fetch comes out, those that came out don't come again
    spark.createDataFrame([(end, days[2], 1, "cached")], fetched.schema).write.mode("append").parquet(p)
    run()
    got = [(r.day, r.n) for r in spark.read.parquet(out).collect()]
    last = max(spark.read.parquet(folder).agg(F.max(F.col("ts").cast("timestamp"))).first()[0].replace(tzinfo=dt.timezone.utc) - dt.timedelta(days=1), close[days[0]])
    want = {days[1], days[2], days[3], days[4], days[5], days[6]}
    assert sorted(got) == sorted((d, counts[d]) for d in want if close[d] <= last)


def test_a_failing_task_leaves_the_ledger_as_it_was(spark, tmp_path):
    store = str(tmp_path / "ledger")
    runs = spark.range(40).selectExpr("id", "'fetched' as outcome")
    assert S.append_records(store, runs, "first") and not S.append_records(store, runs, "first")

    def fail(frames):
        for f in frames:
            if (f["id"] == 33).any():
                raise ValueError("this task fails")
            yield f

    with pytest.raises(Exception, match="this task fails"):
        S.append_records(store, runs.repartition(8).mapInPandas(fail, runs.schema), "second")
    assert S.read_store(spark, store).count() == 40
    assert S.append_records(store, runs.where("id < 3"), "second") and S.read_store(spark, store).count() == 43
