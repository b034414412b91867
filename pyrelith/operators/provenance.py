"""What was observed: fetch records, closed days, refusals, and plans of what to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions.scalar import day_close

OK = ("fetched", "cached")


def covered_days(man: DataFrame) -> DataFrame:
    """A row for each fetch and local day that it covers: a local day draws on its own UTC date and the one before.

    Chunks are a few days long, so their days are listed and joins are by day, not by range.
    """
    return man.withColumn("day", F.explode(F.sequence(F.col("chunk_start"), F.date_add("chunk_start", F.col("days")))))


def refusals(man: DataFrame, days: DataFrame) -> DataFrame:
    """``(day, refusal, failed)``; null means that the day may be published."""
    c = days.join(covered_days(man), "day", "left")
    ok = F.coalesce(F.col("outcome").isin(*OK), F.lit(False))
    g = c.groupBy("day").agg(F.count("source").alias("n"), F.count_if(ok).alias("ok"), F.count_if(ok & (F.col("utc") >= day_close("day"))).alias("late"), F.count_if(F.col("outcome") == "failed").alias("failed"))
    return g.select("day", F.when(F.col("n") == 0, "no fetch").when(F.col("ok") == 0, "no success").when(F.col("late") == 0, "too early").alias("refusal"), "failed")


def source_status(man: DataFrame, wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """For each wanted (source, day): detections, or one of three kinds of none."""
    c = covered_days(man).groupBy("source", "day").agg(F.count(F.lit(1)).alias("covering"), F.count_if(F.col("outcome") == "failed").alias("failed"))
    j = wanted.join(c, ["source", "day"], "left").join(counts, ["source", "day"], "left")
    status = F.when(F.col("n") > 0, "observed").when(F.col("covering").isNull(), "norecord").when(F.col("failed") > 0, "failed").otherwise("empty")
    return j.select("source", "day", F.coalesce("n", F.lit(0)).alias("detections"), status.alias("status"))


def observed_days(man: DataFrame, days: DataFrame) -> DataFrame:
    """By group of instruments and for all, whether a successful fetch covered the day after its close."""
    seen = covered_days(man).where(F.col("outcome").isin(*OK) & (F.col("utc") >= day_close("day")))
    seen = seen.groupBy("day").agg(F.bool_or(F.col("source") != "MODIS").alias("viirs"), F.bool_or(F.col("source") == "MODIS").alias("modis"))
    j = days.join(seen, "day", "left").select("day", F.coalesce("viirs", F.lit(False)).alias("viirs"), F.coalesce("modis", F.lit(False)).alias("modis"))
    return j.withColumn("all_groups", F.col("viirs") & F.col("modis"))


def backfill_plan(man: DataFrame, days: DataFrame, chunk: int) -> DataFrame:
    """``(source, served, chunk_start, days)``: runs of served days in chunks, runs of others as one gap each."""
    got = man.where(F.col("outcome").isin(*OK)).withColumn("day", F.explode(F.sequence(F.col("chunk_start"), F.date_add("chunk_start", F.col("days") - 1)))).select("source", "day").distinct().withColumn("served", F.lit(True))
    grid = man.select("source").distinct().crossJoin(days).join(got, ["source", "day"], "left").withColumn("served", F.coalesce("served", F.lit(False)))
    island = F.date_sub("day", F.row_number().over(Window.partitionBy("source", "served").orderBy("day")))
    runs = grid.withColumn("island", island).groupBy("source", "served", "island").agg(F.min("day").alias("first"), F.count(F.lit(1)).cast("int").alias("n"))
    step = F.when(F.col("served"), F.lit(chunk)).otherwise(F.col("n"))
    cut = runs.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1, step)))
    return cut.select("source", "served", F.date_add("first", F.col("o")).alias("chunk_start"), F.least(step, F.col("n") - F.col("o")).alias("days"))
