"""Events against the reports of a station: interval join, direction, classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrelith.functions import scalar as S
from pyrelith.operators.ordering import numbered, running_sums
from pyrelith.runtime import Scratch

HALF_HOUR, HOUR = 1800, 3600


def parsed(obs: DataFrame) -> DataFrame:
    """Reports with typed columns and flags."""
    v, d, k = S.measured("vsby"), S.measured("drct"), S.measured("sknt")
    return obs.select("obs_id", F.unix_seconds(F.col("valid_utc").cast("timestamp")).alias("at"), "valid_utc", v.alias("vsby"), S.at_ceiling(v).alias("ceiling"), S.known_direction(d, k).alias("dir"), k.alias("sknt"), S.has_token("wxcodes", "FU").alias("fu"), S.has_token("wxcodes", "HZ").alias("hz"))


#: Windows that one cell of ``reports_in_window`` holds, about.
CELL_WINDOWS = 256


def reports_in_window(events: DataFrame, obs: DataFrame, lag_s: int) -> DataFrame:
    """D3: reports from an event's first to its last sighting and ``lag_s`` after, ends included.

    Events (``event, t0, t1``) are listed under each hour that they touch. The windows that hold a whole hour, and those that hold a part of
    it, are dealt to cells of about ``CELL_WINDOWS``; a report meets each cell of its hour, then the windows in it exactly. The result has a row
    for each event and report, so it grows with their product; ``station_records`` sums without it. Cells are small and many, so a
    crowded hour is spread over all tasks. A cell's reports come one after another, each with the same events in the same order, so
    Parquet keeps little of a row.
    """
    spark = events.sparkSession
    parts = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    e = events.withColumn("until", F.col("t1") + lag_s).where("t0 <= until").withColumn("hour", F.explode(F.sequence(F.floor(F.col("t0") / HOUR), F.floor(F.col("until") / HOUR))))
    e = e.withColumn("whole", (F.col("t0") <= F.col("hour") * HOUR) & (F.col("until") >= F.col("hour") * HOUR + HOUR - 1))
    # two rows an hour of the archive at most
    hours = F.broadcast(e.groupBy("hour", "whole").agg(F.ceil(F.count(F.lit(1)) / CELL_WINDOWS).alias("cells")))
    e = e.join(hours, ["hour", "whole"]).withColumn("cell", F.pmod(F.xxhash64(*events.columns), "cells"))
    o = obs.withColumn("hour", F.floor(F.col("at") / HOUR)).join(hours, "hour").withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    keys = ["hour", "whole", "cell"]
    o, e = (d.drop("cells").repartition(parts, *keys) for d in (o, e))
    # sorted and merged: reports on the left are gone through once, each with all windows of its cell
    return o.join(e.hint("merge"), keys).where(F.col("at").between(F.col("t0"), F.col("until"))).select(*events.columns, "until", *obs.columns)


def window_blocks(events: DataFrame, lag_s: int, levels: int, *cols: str) -> DataFrame:
    """``(*cols, level, block)``: the few blocks of 2^level whole seconds that make up each event's window, at most two of each level."""
    lo, end = F.col("t0"), F.col("t1") + lag_s + 1
    found = []
    for k in range(levels):
        a, b = F.shiftright(lo + (1 << k) - 1, k), F.shiftright(end, k)
        found += [F.when((a < b) & (at % 2 != 0), F.struct(F.lit(k).alias("level"), block.alias("block"))) for at, block in ((a, a), (b, b - 1))]
    return events.select(*cols, F.explode(F.array_compact(F.array(*found))).alias("b")).select(*cols, "b.*")


def summed_blocks(seconds: DataFrame, levels: int, by: list[str], sums: list[Column]) -> DataFrame:
    """``(level, block, *by, sums)``: rows of seconds (``at``) summed in the blocks of every level that they lie in."""
    block = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("at", k).alias("block")) for k in range(levels)])
    return seconds.select("*", F.explode(block).alias("b")).groupBy("b.level", "b.block", *by).agg(*sums)


def shared_smoke(span: DataFrame) -> DataFrame:
    """``(event, n_concurrent)``: how many other events have at least one of an event's smoke reports in their window.

    A window holds the station's smoke reports from one number to another (``lo``, ``hi``), numbered by time. Two events share one
    exactly if those ranges overlap, so the count is that of the ranges that begin no later than an event's ends, less those
    that end before it begins: two running sums over the ranges' ends, and no pairs of events.
    """
    ends = [span.select(F.col(c).alias("r"), F.lit(int(c == "lo")).alias("begun"), F.lit(int(c == "hi")).alias("ended")) for c in ("lo", "hi")]
    counts = ends[0].unionByName(ends[1]).groupBy("r").agg(F.sum("begun").alias("begun"), F.sum("ended").alias("ended")).withColumn("here", F.col("ended"))
    sums = running_sums(counts, "r", ["begun", "ended"])
    j = span.join(sums.select(F.col("r").alias("hi"), "begun"), "hi").join(sums.select(F.col("r").alias("lo"), (F.col("ended") - F.col("here")).alias("ended")), "lo")
    return j.select("event", (F.col("begun") - F.col("ended") - 1).alias("n_concurrent"))


def smoke_ranges(events: DataFrame, smoke: DataFrame, lag_s: int) -> DataFrame:
    """``(event, lo, hi)``: the numbers in time of the first and the last smoke report in each event's window, for events that have one.

    Windows' borders and the seconds with smoke (``at, n``) are sorted together; how many reports lie before a border is a running sum.
    """
    at = smoke.select("at", F.lit(1).alias("kind"), F.lit(None).cast(events.schema["event"].dataType).alias("event"), F.col("n").alias("upto"))
    borders = [events.select(t.alias("at"), F.lit(kind).alias("kind"), "event", F.lit(0).cast("long").alias("upto")) for t, kind in ((F.col("t0"), 0), (F.col("t1") + lag_s, 2))]
    line = running_sums(numbered(at.unionByName(borders[0]).unionByName(borders[1]), ["at", "kind", "event"], "r"), "r", ["upto"])
    g = line.where("kind <> 1").groupBy("event").agg((F.max(F.when(F.col("kind") == 0, F.col("upto"))) + 1).alias("lo"), F.max(F.when(F.col("kind") == 2, F.col("upto"))).alias("hi"))
    return g.where("lo <= hi")


def station_records(events: DataFrame, obs: DataFrame, lag_s: int, half_width: float) -> DataFrame:
    """For every event what the station reported in its window, with the number of other events of the same smoke reports.

    ``events`` has ``event, t0, t1, km, bearing``, one row an event. Coverage may exceed 1, as stations send extra reports.
    Reports aren't listed by event: they are summed by second, the seconds in blocks of 1, 2, 4, ... of them, and a window is the sum of
    its blocks, two of each size at most. Reports of smoke are also summed by the wind's direction, which
    is held against each bearing that asks for a block. So the work grows with the events and the reports, not with their product.
    """
    scratch = Scratch(events.sparkSession, "stations")
    events = scratch.table(events.select("event", "t0", "t1", "km", "bearing"), "windows")
    known = obs.where("at is not null")
    seconds = known.groupBy("at").agg(F.count(F.lit(1)).alias("n_obs"), F.count_if("fu").alias("n_fu"), F.count_if("hz").alias("n_hz"), F.min("vsby").alias("vsby_min"), F.count_if("ceiling").alias("at_ceiling"), F.count("vsby").alias("seen"))
    seconds = scratch.table(seconds, "seconds")
    longest = events.agg(F.max(F.col("t1") - F.col("t0")).alias("s")).first().s
    levels = max(1, int((longest or 0) + lag_s + 1).bit_length())
    sums = ["n_obs", "n_fu", "n_hz", "at_ceiling", "seen"]
    total = [*[F.sum(c).alias(c) for c in sums], F.min("vsby_min").alias("vsby_min")]
    blocks = window_blocks(events, lag_s, levels, "event").join(summed_blocks(seconds, levels, [], total), ["level", "block"])
    agg = blocks.groupBy("event").agg(*total).withColumn("ceiling_share", F.try_divide("at_ceiling", "seen"))
    winds = known.where(F.col("fu") & F.col("dir").isNotNull()).groupBy("at", "dir", "sknt").agg(F.count(F.lit(1)).alias("n"))
    winds = summed_blocks(winds, levels, ["dir", "sknt"], [F.sum("n").alias("n")])
    asked = scratch.table(window_blocks(events.where("bearing is not null"), lag_s, levels, "event", "bearing"), "asked")
    blown = asked.select("level", "block", "bearing").distinct().join(winds, ["level", "block"]).where(S.wind_from(F.col("dir"), F.col("sknt"), F.col("bearing"), half_width))
    blown = blown.groupBy("level", "block", "bearing").agg(F.sum("n").alias("n"))
    from_there = asked.join(blown, ["level", "block", "bearing"]).groupBy("event").agg(F.sum("n").alias("n_fu_from"))
    other = shared_smoke(scratch.table(smoke_ranges(events, seconds.where("n_fu > 0").select("at", F.col("n_fu").alias("n")), lag_s), "spans"))
    expected = F.floor((F.col("t1") + lag_s - F.col("t0")) / HALF_HOUR) + 1
    out = events.join(agg, "event", "left").join(from_there, "event", "left").join(other, "event", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_obs", "n_fu", "n_hz", "n_fu_from", "n_concurrent")]
    return out.select("event", "km", *zero, "vsby_min", "ceiling_share", F.try_divide(F.coalesce("n_obs", F.lit(0)), expected).alias("coverage"))


def station_class(min_coverage: float, max_km):
    """One class, in this order: unobserved, beyond range, corroborated, smoke from elsewhere, no smoke."""
    return F.when(F.col("coverage") < min_coverage, "unobserved").when(F.col("km") > max_km, "beyond range").when(F.col("n_fu_from") >= 1, "corroborated").when(F.col("n_fu") >= 1, "smoke from elsewhere").otherwise("no smoke")


def baseline(obs: DataFrame, offset_hours: int) -> DataFrame:
    """``(level, period, n, fu_days, hz_days, fu)`` by local year, by local month, and by each of the 24 local hours, those without reports too."""
    at = F.timestamp_seconds(F.col("at") + offset_hours * 3600)
    o = obs.select(at.alias("ts"), "fu", "hz").withColumn("day", F.to_date("ts"))
    o = o.withColumn("year", F.date_format("ts", "yyyy")).withColumn("month", F.date_format("ts", "yyyy-MM")).withColumn("hour", F.date_format("ts", "HH"))
    sets = [[F.col(c)] for c in ("year", "month", "hour")]
    g = o.groupingSets(sets, *[F.col(c) for c in ("year", "month", "hour")]).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(F.col("fu"), F.col("day"))).alias("fu_days"), F.countDistinct(F.when(F.col("hz"), F.col("day"))).alias("hz_days"), F.count_if("fu").alias("fu"))
    level = F.when(F.col("year").isNotNull(), "year").when(F.col("month").isNotNull(), "month").otherwise("hour")
    found = g.select(level.alias("level"), F.coalesce("year", "month", "hour").alias("period"), "n", "fu_days", "hz_days", "fu")
    hours = obs.sparkSession.range(24).select(F.lit("hour").alias("level"), F.lpad(F.col("id").cast("string"), 2, "0").alias("period"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "fu_days", "hz_days", "fu")]
    return found.where("level <> 'hour'").unionByName(hours.join(found, ["level", "period"], "left").select("level", "period", *zero))
