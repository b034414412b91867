"""Queries that run a stream over what is there and read its sink (survey section L)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrelith.plans.climate import FWI_SERIES
from pyrelith.plans.registry import ORACLES, QUERIES
from pyrelith.runtime import Scratch
from pyrelith.sources.surrogate import load, oracle
from pyrelith.streaming import operators as S


def drained(stream: DataFrame, label: str) -> DataFrame:
    """The rows that an appending stream has written once all files that are there were read."""
    spark = stream.sparkSession
    scratch = Scratch(spark, label)
    q = stream.writeStream.format("parquet").outputMode("append").option("path", scratch.path("sink")).option("checkpointLocation", scratch.path("state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(scratch.path("sink"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a landing folder of files that a stream watches."""
    scratch = Scratch(spark, "landing")
    rows = scratch.table(spark.read.parquet(f"{sf_dir}/events.parquet").repartitionByRange(4, "ts"), "events")
    return S.detections(spark, scratch.path("events"), rows.schema)


def l1_stream_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: local days that the watermark (a day behind the newest row) has closed."""
    return drained(S.closed_days(events(spark, sf_dir)), "stream-days")


def l1_stream_observed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local days that are over and that a successful fetch covered after their close: two streams joined."""
    scratch = Scratch(spark, "fetches-landing")
    rows = scratch.table(load(spark, sf_dir, "v_man")[0].withColumn("ran_at", F.col("utc").cast("timestamp")).drop("utc").repartitionByRange(4, "ran_at"), "fetches")
    fetches = spark.readStream.schema(rows.schema).parquet(scratch.path("fetches"))
    return drained(S.observed_days(events(spark, sf_dir), fetches), "stream-observed-days")


def b2_b14_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of each source's fetches added as one entry, twice; the absent chunks read back from the ledger."""
    man = load(spark, sf_dir, "v_man")[0]
    store = Scratch(spark, "ledger").path("runs")
    for name in ("VIIRS_SNPP", "VIIRS_NOAA20", "VIIRS_NOAA21", "MODIS", "MODIS"):
        S.append_records(store, man.where(F.col("source") == name), name)
    return S.read_store(spark, store).where("outcome = 'unavailable'").groupBy("source", "chunk_start").agg(F.max("days").alias("days"))


def l2_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: every row comes twice; the first of each key is kept."""
    twice = events(spark, sf_dir).select("event_id", "at", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    return drained(S.once(twice), "stream-once").select("event_id")


def l5_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions of each user."""
    s = drained(S.sessions(events(spark, sf_dir), gap="3 hours"), "stream-sessions")
    return s.select("user_id", F.unix_seconds("started").alias("started"), "n")


def l6_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches added to a store; the store holds each key once."""
    scratch = Scratch(spark, "stream-upsert")
    q = events(spark, sf_dir).select("event_id", "event_type").writeStream.foreachBatch(S.upsert(scratch.path("store"), "event_id")).option("checkpointLocation", scratch.path("state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return S.read_store(spark, scratch.path("store")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def l7_stream_moisture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moisture codes of every cell from a stream of its days, in order of time."""
    scratch = Scratch(spark, "weather-landing")
    rows = scratch.table(load(spark, sf_dir, "v_wx")[0].repartitionByRange(4, "date").sortWithinPartitions("date"), "days")
    stream = spark.readStream.schema(rows.schema).parquet(scratch.path("days"))
    codes = drained(S.moisture_codes(stream), "stream-moisture")
    return codes.select("cell", "date", *[F.round(c, 4).alias(c) for c in ("ffmc", "dmc", "dc", "kbdi")])


ORACLES["l7_stream_moisture"] = oracle(FWI_SERIES[: FWI_SERIES.index("  i AS (")].rstrip().rstrip(",") + """ SELECT cell, date, round(f0,
    4) AS ffmc, round(d0, 4) AS dmc, round(c0, 4) AS dc, round(q0, 4) AS kbdi FROM c""", "v_wx")

for f in (l1_stream_closed_days, l1_stream_observed_days, b2_b14_ledger, l2_stream_once, l5_stream_sessions, l6_stream_upsert, l7_stream_moisture):
    QUERIES[f.__name__] = f

ORACLES["l1_stream_closed_days"] = oracle("""SELECT date_wit AS day, count(*) AS n FROM v_det GROUP BY date_wit
    HAVING CAST(date_wit AS TIMESTAMP) + INTERVAL 15 HOUR <= (SELECT max(datetime_utc) FROM v_det) - INTERVAL 1 DAY""", "v_det")
ORACLES["l1_stream_observed_days"] = oracle("""WITH w AS (SELECT least((SELECT max(datetime_utc) FROM v_det), (SELECT max(utc) FROM v_man)) - INTERVAL 1 DAY AS mark),
  d AS (SELECT date_wit AS day, CAST(date_wit AS TIMESTAMP) + INTERVAL 15 HOUR AS closed, count(*) AS n FROM v_det GROUP BY date_wit)
  SELECT day, n FROM d, w WHERE closed <= mark AND EXISTS (SELECT 1 FROM v_man m WHERE m.outcome IN ('fetched', 'cached') AND m.utc >= closed AND m.utc < closed + INTERVAL 60 DAY
    AND day BETWEEN m.chunk_start AND m.chunk_start + m.days)""", "v_det", "v_man")
ORACLES["b2_b14_ledger"] = oracle("SELECT source, chunk_start, max(days) AS days FROM v_man WHERE outcome = 'unavailable' GROUP BY ALL", "v_man")
ORACLES["l2_stream_once"] = "SELECT event_id FROM events"
ORACLES["l5_stream_sessions"] = """WITH c AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id
    ORDER BY ts) >= INTERVAL 3 HOUR THEN 1 ELSE 0 END AS new FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id
    ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM c)
  SELECT user_id, CAST(epoch(date_trunc('second', min(ts))) AS BIGINT) AS started, count(*) AS n FROM g GROUP BY user_id, g
    HAVING max(ts) + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""
ORACLES["l6_stream_upsert"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
