"""Structured Streaming twins: final days, late and repeated rows, sessions, and codes kept for each cell."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrelith.operators.fire_danger import Settings, one_day


def detections(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A stream of detection files, event time as a timestamp (watermarks don't take local ones)."""
    return spark.readStream.schema(schema).parquet(folder).withColumn("at", F.col("ts").cast("timestamp"))


def closed_days(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """L1: counts of local days (they start at 15:00 UTC); in append mode a day comes out once the watermark has passed its close."""
    w = F.window("at", "1 day", startTime="15 hours")
    return stream.withWatermark("at", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("w.end").alias("day"), "n")


def observed_days(detections: DataFrame, fetches: DataFrame, late: str = "1 day", within: str = "60 days", good: tuple[str, ...] = ("fetched", "cached")) -> DataFrame:
    """``(day, n)`` of the local days that are over and that a successful fetch covered after their close (15:00 UTC); each once.

    A stream-stream join: counts of days, which come out once the watermark has passed the close, with the records of fetches
    ``(ran_at, chunk_start, days, outcome)``, spread over the days that a fetch covers (a local day draws on its own UTC date and the one
    before). A fetch closes a day if it ran at the close or later, by ``within`` at most: that bound lets both sides forget. A day without
    such a fetch never comes out, nor does one that has no detection; failed fetches, and those that ran before the close, close nothing.
    """
    w = F.window("at", "1 day", startTime="15 hours")
    counted = detections.withWatermark("at", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.select(F.window_time("w").alias("closed"), F.to_date("w.end").alias("day"), "n")
    # not a filter: that would be moved ahead of the watermark, which failed fetches carry on too
    covered = F.when(F.col("outcome").isin(*good) & (F.col("days") > 0), F.sequence(F.col("chunk_start"), F.expr("date_add(chunk_start, days)")))
    ran = fetches.withWatermark("ran_at", late).select("ran_at", F.explode_outer(covered).alias("covered"))
    # the window's time is its last microsecond
    after = F.expr(f"covered = day AND ran_at > closed AND ran_at <= closed + INTERVAL {within}")
    return counted.join(ran, after).dropDuplicates(["day", "closed"]).select("day", "n")


def once(stream: DataFrame, key: str = "event_id", late: str = "1 day") -> DataFrame:
    """L2: the first row of each key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark("at", late).dropDuplicatesWithinWatermark([key])


def sliding_weeks(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """L4: seven-day windows, one a day."""
    return stream.withWatermark("at", late).groupBy(F.window("at", "7 days", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("w.end").alias("until"), "n")


def sessions(stream: DataFrame, key: str = "user_id", gap: str = "30 hours", late: str = "1 day") -> DataFrame:
    """Runs of a place's detections that no gap parts."""
    return stream.withWatermark("at", late).groupBy(key, F.session_window("at", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("started"), "n")


STATE = "day date, ffmc double, dmc double, dc double, q double, wet double"
CODES = "cell long, date date, ffmc double, dmc double, dc double, kbdi double"


def moisture_codes(stream: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Moisture codes of each cell, carried from batch to batch; a missing day starts the cell again. The state is six numbers a cell.

    Days must come in order; a day that isn't after the last one seen can't be put before it: it comes out with
    null codes, so that it can be counted (``late_days``).
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        day, ffmc, dmc, dc, q, wet = state.get if state.exists else (None, s.ffmc, s.dmc, s.dc, 0.0, 0.0)
        out = []
        for d in pd.concat(list(frames)).sort_values("date").itertuples():
            if day is not None and d.date <= day:
                out.append((key[0], d.date, None, None, None, None))
                continue
            if day is not None and (d.date - day).days > 1:
                ffmc, dmc, dc, q, wet = s.ffmc, s.dmc, s.dc, 0.0, 0.0
            wet = wet + d.rain if d.rain > 0 else 0.0
            ffmc, dmc, dc, q = one_day(d._replace(wet_run=wet), ffmc, dmc, dc, q, s)
            day = d.date
            out.append((key[0], day, ffmc, dmc, dc, q))
        state.update((day, ffmc, dmc, dc, q, wet))
        yield pd.DataFrame(out, columns=["cell", "date", "ffmc", "dmc", "dc", "kbdi"])

    rows = stream.withColumn("wet_run", F.lit(0.0))
    return rows.groupBy("cell").applyInPandasWithState(step, CODES, STATE, "append", "NoTimeout")


def late_days(codes: DataFrame) -> DataFrame:
    """The days of ``moisture_codes`` that came too late for their cell."""
    return codes.where(F.col("ffmc").isNull()).select("cell", "date")


BUCKETS = 64


class Store:
    """A Parquet store that only grows: folders of rows, and a log that says which of them count, in which order.

    A line of the log is a file of its own, named by its number and put there by a rename that fails if the number is
    taken. So of several writers one gets each number, and a folder whose writer failed before is never read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.jvm = spark, root.rstrip("/"), spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def log(self, after: int = 0) -> list[dict]:
        """The committed batches beyond the first ``after``: ``run``, ``number``, ``folder``."""
        at = self._path(f"{self.root}/_log")
        names = sorted(n for f in (self.fs.listStatus(at) if self.fs.exists(at) else []) if (n := f.getPath().getName()).isdigit())
        if not names[after:]:
            return []
        rows = self.spark.read.text([f"{self.root}/_log/{n}" for n in names[after:]]).select(F.from_json("value", "place int, run string, number long, folder string").alias("v")).select("v.*")
        return [r.asDict() for r in rows.orderBy("place").collect()]

    def commit(self, place: int, run: str, number: int, folder: str) -> bool:
        """Make a folder count as the log's line ``place``; False if another writer has that line."""
        staged, final = self._path(f"{self.root}/_log/_{uuid.uuid4().hex}"), self._path(f"{self.root}/_log/{place:010d}")
        out = self.fs.create(staged, True)
        out.write(json.dumps({"place": place, "run": run, "number": number, "folder": folder}).encode())
        out.close()
        option = self.jvm.org.apache.hadoop.fs.Options.Rename
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(staged, final, self.spark.sparkContext._gateway.new_array(option, 0))
        except Exception as e:
            self.fs.delete(staged, False)
            if "FileAlreadyExists" not in str(e):
                raise
            return False
        return True

    def rows(self, lines: list[dict], schema=None) -> DataFrame | None:
        """The rows of some lines: all columns that any of them has, or those of ``schema``, for which no file is opened but to read it."""
        if not lines:
            return None
        read = self.spark.read.option("basePath", self.root)
        read = read.schema(schema) if schema else read.option("mergeSchema", "true")
        return read.parquet(*[f"{self.root}/{x['folder']}" for x in lines]).drop("batch")


def append_records(store: str, records: DataFrame, name: str) -> bool:
    """Add records to a ledger as one entry ``name``, all of them or none; whether they were added.

    The rows are written to a folder of their own and count once the log names it, so a failing task or a driver that ends
    leaves the ledger as it was. An entry that is there isn't added again.
    """
    held = Store(records.sparkSession, store)
    folder = f"batch={name}-{uuid.uuid4().hex[:8]}"
    seen = held.log()
    if any(x["run"] == name for x in seen):
        return False
    try:
        records.write.parquet(f"{store}/{folder}")
        while not held.commit(len(seen) + 1, name, 0, folder):
            seen += held.log(len(seen))
            if any(x["run"] == name for x in seen):
                held.fs.delete(held._path(f"{store}/{folder}"), True)
                return False
    except Exception:
        held.fs.delete(held._path(f"{store}/{folder}"), True)
        raise
    return True


def upsert(store: str, key: str, buckets: int = BUCKETS, run: str | None = None):
    """A foreachBatch sink that adds new keys to a ``Store``; an empty batch leaves it untouched.

    Rows that are there are never moved, and of one key the first that was committed stays. A batch is known by its stream and
    number: the stream is ``run``, or else the query's own id, which its checkpoint keeps; so a restart repeats a batch under its
    old name and adds nothing, while a new checkpoint or another stream on the same store has names of its own and sees all that is
    there. Keys are dealt to buckets, and only the buckets that a batch has are read. Where two streams commit at once, one
    loses the line and looks again at what the other has added. Within a batch, rows that repeat a key are one.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = run or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        held, seen = Store(spark, store), []
        seen += held.log()
        if batch.isEmpty() or any((x["run"], x["number"]) == (name, number) for x in seen):
            return
        new = batch.dropDuplicates([key]).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r.bucket for r in new.select("bucket").distinct().collect()]
            while True:
                old = held.rows(seen, new.select("bucket", key).schema)
                fresh = new if old is None else new.join(old.where(F.col("bucket").isin(touched)), ["bucket", key], "left_anti")
                folder = f"batch={name}-{number}-{uuid.uuid4().hex[:8]}"
                fresh.write.partitionBy("bucket").parquet(f"{store}/{folder}")
                if held.commit(len(seen) + 1, name, number, folder):
                    return
                held.fs.delete(held._path(f"{store}/{folder}"), True)
                seen += held.log(len(seen))
        finally:
            new.unpersist()

    return write


def read_store(spark: SparkSession, store: str, with_bucket: bool = False) -> DataFrame | None:
    """The rows of all committed batches; None if there are none."""
    held = Store(spark, store)
    out = held.rows(held.log())
    return out if out is None or with_bucket else out.drop("bucket")
