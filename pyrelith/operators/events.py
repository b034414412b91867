"""Space-time events: density clusters of detections, their records, and identifiers that stay."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions.scalar import M_PER_DEG
from pyrelith.operators.components import components_by_region, connected_components
from pyrelith.operators.geo import space_time_pairs, spans_in_reach, timed_plane
from pyrelith.operators.ordering import numbered
from pyrelith.runtime import Scratch


def st_dbscan(points: DataFrame, eps_m: float, eps_s: int, min_samples: int = 2, key: str = "detection_id", ts: str = "datetime_utc") -> DataFrame:
    """``(detection_id, event)``; an event is named by its first member in order of (time, id).

    A point with ``min_samples`` points in reach (itself counted) is core; cores in reach of one another are one event;
    another point in reach of a core joins the event whose first core is the earliest; the rest are events of their own.
    """
    scratch = Scratch(points.sparkSession, "dbscan")
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    # adding nothing makes -0.0 the zero that it equals
    ranked = points.select(F.col(key).alias("id"), at.alias("at"), *[(F.col(c) + F.lit(0)).alias(c) for c in ("latitude", "longitude")], F.floor(at / 1_000_000).alias("second"))
    if min_samples <= 2:  # whoever has a neighbour is core, so events are the components of the pairs
        # what stands at one place within a stretch of eps_s is one stack, all linked; of two stacks the nearest ends decide
        still = F.isnull("latitude") | F.isnan("latitude") | F.isnull("longitude") | F.isnan("longitude")
        ranked = ranked.withColumn("stretch", F.when(still, F.col("second")).otherwise(F.floor(F.col("second") / max(eps_s, 1))))
        spot = ["latitude", "longitude", "stretch"]
        spots = ranked.groupBy(*spot).agg(F.min("id").alias("spot"), F.min("at").alias("at"), F.min("second").alias("t"), F.max("second").alias("u"), F.count(F.lit(1)).alias("n"))
        spots = scratch.table(spots, "spots")
        mean = ranked.agg(F.avg("latitude").alias("mean_lat"))
        x = F.col("longitude") * (F.cos(F.radians("mean_lat")) * M_PER_DEG)
        on_plane = spots.join(F.broadcast(mean)).select(F.col("spot").alias("id"), x.alias("x"), (F.col("latitude") * M_PER_DEG).alias("y"), "t", "u")
        comp = components_by_region(spans_in_reach(on_plane, eps_m, eps_s, eps_s), region_of(eps_m, eps_s), scratch, connected_components)
        named = scratch.table(spots.join(comp, spots["spot"] == comp["node"], "left").select(*spot, "spot", "at", "n", "component"), "named")
        alone = named.where("n = 1 and component is null").select(F.col("spot").alias(key), F.col("spot").alias("event"))
        # only what is linked or stands with others needs a name; only the latter has rows beyond its spot
        crowd = named.where("n > 1").select(*[F.col(c).alias(f"s_{c}") for c in spot], F.coalesce("component", "spot").alias("c"), F.xxhash64(*spot).alias("number"))
        same = [(F.when(F.col(c).eqNullSafe(F.col(f"s_{c}")), 0).otherwise(1) == 0) for c in spot]
        rows = ranked.withColumn("number", F.xxhash64(*spot)).join(crowd, "number").where(same[0] & same[1] & same[2]).select("id", "at", "c")
        rows = rows.unionByName(named.where("n = 1 and component is not null").select(F.col("spot").alias("id"), "at", F.col("component").alias("c")))
        first = rows.groupBy("c").agg(F.min(F.struct("at", "id")).alias("name"))
        return alone.unionByName(rows.join(first, "c").select(F.col("id").alias(key), F.col("name.id").alias("event")))
    # what stands at one place and second is one spot: copies cost no pairs
    spot = ["latitude", "longitude", "second"]
    spots = ranked.groupBy(*spot).agg(F.min(F.struct("at", "id")).alias("first"), F.count(F.lit(1)).alias("n"), F.min("id").alias("spot"))
    spots = scratch.table(spots.withColumn("time", F.timestamp_seconds("second")), "spots")
    pairs = scratch.table(space_time_pairs(spots, eps_m, eps_s, "spot", "time").select("a", "b"), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(spots.select(F.col("spot").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("near"))
    core = spots.join(others, spots["spot"] == others["a"], "left").where(F.col("n") + F.coalesce("near", F.lit(0)) >= min_samples).select(F.col("spot").alias("id"), "first")
    core = scratch.table(core, "core")
    ids = core.select("id")
    within = pairs.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi")
    groups = core.join(connected_components(within, scratch).withColumnRenamed("node", "id"), "id", "left").select("id", "first", F.coalesce("component", "id").alias("component"))
    seeds = groups.groupBy("component").agg(F.min("first").alias("seed"))
    cored = scratch.table(groups.join(seeds, "component").select("id", "seed"), "cored")
    border = both.join(ids, both["a"] == ids["id"], "left_anti").join(cored, both["b"] == cored["id"]).groupBy("a").agg(F.min("seed").alias("seed")).select(F.col("a").alias("id"), "seed")
    found = cored.unionByName(border)
    # an event is named by its first member, which may be a border point; what is alone is an event of its own
    named = spots.join(found, spots["spot"] == found["id"], "left").select(*spot, "spot", "first", "n", "seed")
    held = named.where("seed is not null")
    first = held.groupBy("seed").agg(F.min("first").alias("name"))
    events = held.join(first, "seed").select(*spot, F.col("name.id").alias("event"))
    alone = named.where("seed is null").select(*spot, F.lit(None).cast(points.schema[key].dataType).alias("event"))
    return labelled(ranked, events.unionByName(alone), spot, key, F.col("event"))


def region_of(eps_m: float, eps_s: int) -> list[Column]:
    """Regions of pairs ``(x, y, t)`` that most events lie in whole."""
    return [F.floor(F.col("x") / (16 * eps_m)), F.floor(F.col("y") / (16 * eps_m)), F.floor(F.col("t") / (64 * eps_s))]


def labelled(ranked: DataFrame, spots: DataFrame, spot: list[str], key: str, event: Column) -> DataFrame:
    """Each point with the event of its spot; points of spots without one are events of their own."""
    labels = spots.select(*[F.col(c).alias(f"s_{c}") for c in spot], event.alias("event"))
    j = ranked.join(labels, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in spot])
    return j.select(F.col("id").alias(key), F.coalesce("event", "id").alias("event"))


def event_records(members: DataFrame) -> DataFrame:
    """E3 with F10: one record an event from its members' rows (``event`` and the columns of detections).

    Overpasses are summed first, so that the first one's position is a minimum and no window is needed.
    """
    passes = members.groupBy("event", "datetime_utc").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("satellite").alias("s"), F.sum("frp").alias("f"), F.max("frp").alias("fm"),
        F.count_if(F.col("frp").isNull()).alias("gone"), F.sum("latitude").alias("y"), F.sum("longitude").alias("x"),
    )
    first = F.min(F.struct("datetime_utc", (F.col("y") / F.col("n")).alias("y"), (F.col("x") / F.col("n")).alias("x")))
    r = passes.groupBy("event").agg(
        F.sum("n").alias("n_detections"),
        F.count(F.lit(1)).alias("n_overpasses"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))), "+").alias("satellites"),
        F.min("datetime_utc").alias("first_seen"),
        F.max("datetime_utc").alias("last_seen"),
        F.coalesce(F.sum("f"), F.lit(0.0)).alias("frp_sum"),
        F.max("fm").alias("frp_max"),
        F.sum("gone").alias("n_frp_missing"),
        (F.sum("y") / F.sum("n")).alias("centroid_lat"),
        (F.sum("x") / F.sum("n")).alias("centroid_lon"),
        first.alias("first"),
    )
    return r.withColumn("first_lat", F.col("first.y")).withColumn("first_lon", F.col("first.x")).drop("first")


def number_events(records: DataFrame, prefix: str = "E", digits: int = 4) -> DataFrame:
    """Events in order of (first time, name) get running numbers."""
    return numbered(records, ["first_seen", "event"]).withColumn("event_id", F.format_string(f"{prefix}%0{digits}d", "number")).drop("number")


def stable_ids(members: DataFrame, prior: DataFrame, next_number: int, prefix: str = "E") -> DataFrame:
    """``(event, event_id, merged)`` that carries identifiers from an earlier run (``prior(detection_id, event_id)``).

    Overlaps are counted by a join and a sum; claims go by the largest overlap, then the larger event, then
    the smaller identifier, and are folded in that order, since each depends on those before. Events and identifiers that
    overlap, straight or through others, are one fold, as no claim reaches beyond them; a fold sees
    one row a pair, never detections. New numbers follow ``next_number`` in order of the events' first ids; none is used again.
    """
    scratch = Scratch(members.sparkSession, "stable-ids")
    members = scratch.table(members.select("detection_id", "event"), "members")
    overlap = members.join(prior, "detection_id").groupBy("event", "event_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = members.groupBy("event").agg(F.count(F.lit(1)).alias("size"), F.min("detection_id").alias("seed"))
    pairs = sizes.join(overlap, "event").withColumn("a", F.xxhash64("event")).withColumn("b", F.xxhash64("event_id", F.lit("id")))
    by = {c: F.count(F.lit(1)).over(Window.partitionBy(c)) for c in ("event", "event_id")}
    pairs = scratch.table(pairs.withColumns({"ids": by["event"], "events": by["event_id"]}), "pairs")
    # most events and identifiers have nobody else: only the others are folded
    sure = pairs.where("ids = 1 and events = 1").select("event", F.col("event_id").alias("kept"), F.lit("").alias("merged"))
    pairs = pairs.where("ids > 1 or events > 1")
    comp = connected_components(pairs, scratch)

    def claim(g: pd.DataFrame) -> pd.DataFrame:
        taken: dict[str, int] = {}
        has: dict[int, str] = {}
        wanted = g.sort_values(["n", "size", "event_id", "event"], ascending=[False, False, True, True])
        for r in wanted.itertuples():
            if r.event_id not in taken and r.event not in has:
                taken[r.event_id] = r.event
                has[r.event] = r.event_id
        lost: dict[int, list[str]] = {}
        for r in wanted.itertuples():
            if r.event_id not in taken:
                lost.setdefault(r.event, []).append(r.event_id)
                taken[r.event_id] = r.event
        rows = [(e, has.get(e), "+".join(sorted(lost.get(e, [])))) for e in g["event"].drop_duplicates()]
        return pd.DataFrame(rows, columns=["event", "kept", "merged"])

    claims = pairs.join(comp, pairs["a"] == comp["node"]).groupBy("component").applyInPandas(claim, "event long, kept string, merged string").unionByName(sure)
    out = scratch.table(sizes.select("event", "seed").join(claims, "event", "left"), "claims")
    fresh = numbered(out.where("kept is null"), ["seed", "event"]).withColumn("kept", F.format_string(f"{prefix}%04d", F.col("number") + next_number - 1))
    return out.where("kept is not null").unionByName(fresh.drop("number")).select("event", F.col("kept").alias("event_id"), F.coalesce("merged", F.lit("")).alias("merged"))


def tune(points: DataFrame, grid: tuple[tuple[float, int], ...], known: list[tuple[str, DataFrame]]) -> DataFrame:
    """What each setting ``(metres, seconds)`` of st_dbscan with two samples gives: one row ``all`` and one for each known event.

    Pairs are joined once at the widest setting and filtered for each. ``all`` counts events and singletons and
    describes the largest event (the first of several); a known event (``name`` and its detections' ids) counts the events that it
    meets and describes the largest of them. Extents are the longer side on the plane of all points.
    """
    scratch = Scratch(points.sparkSession, "tuning")
    widest = max(m for m, _ in grid), max(s for _, s in grid)
    timed = timed_plane(points, "detection_id", "datetime_utc", "latitude", "longitude")
    pairs = scratch.table(spans_in_reach(timed.withColumn("u", F.col("t")), *widest, 0), "pairs")
    mean = points.agg(F.avg("latitude").alias("mean_lat"))
    p = points.join(F.broadcast(mean)).select("detection_id", "datetime_utc", "date_wit", (F.col("longitude") * (F.cos(F.radians("mean_lat")) * M_PER_DEG)).alias("x"), (F.col("latitude") * M_PER_DEG).alias("y"))
    p = scratch.table(p, "points")
    picked = None
    for name, ids in known:
        part = ids.select(F.lit(name).alias("name"), "detection_id")
        picked = part if picked is None else picked.unionByName(part)
    hours = (F.unix_micros(F.max("datetime_utc").cast("timestamp")) - F.unix_micros(F.min("datetime_utc").cast("timestamp"))) / 3.6e9
    extent = F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")) / 1000
    about = ["hours", "extent_km", "first_day", "last_day"]
    out = None
    for k, (metres, seconds) in enumerate(grid):
        within = pairs.where((F.col("metres") <= metres) & (F.col("seconds") <= seconds))
        comp = components_by_region(within, region_of(metres, seconds), Scratch(points.sparkSession, f"tuning-{k}"), connected_components)
        label = p.join(comp, p["detection_id"] == comp["node"], "left").withColumn("event", F.coalesce("component", "detection_id")).drop("node", "component")
        g = label.groupBy("event").agg(F.count(F.lit(1)).alias("n"), hours.alias("hours"), extent.alias("extent_km"), F.min("date_wit").alias("first_day"), F.max("date_wit").alias("last_day"), F.min(F.struct("datetime_utc", "detection_id")).alias("start"))
        g = scratch.table(g.withColumn("place", F.struct(F.col("n"), (-F.col("start.detection_id")).alias("id"))), f"events{k}")
        label = label.select("detection_id", "event")
        whole = g.agg(F.sum("n").alias("detections"), F.count(F.lit(1)).alias("events"), F.count_if(F.col("n") == 1).alias("singletons"), F.max(F.struct("place", "n", *about)).alias("t")).withColumn("name", F.lit("all"))
        parts = [whole]
        if picked is not None:
            met = picked.join(label, "detection_id").groupBy("name", "event").agg(F.count(F.lit(1)).alias("c")).join(g, "event")
            parts.append(met.groupBy("name").agg(F.sum("c").alias("detections"), F.count(F.lit(1)).alias("events"), F.max(F.struct("place", "n", *about)).alias("t")).withColumn("singletons", F.lit(None).cast("long")))
        for part in parts:
            row = part.select(F.lit(float(metres)).alias("eps_m"), F.lit(seconds).cast("long").alias("eps_s"), "name", "detections", "events", "singletons", F.col("t.n").alias("largest"), *[F.col(f"t.{c}").alias(c) for c in about])
            out = row if out is None else out.unionByName(row)
    return out
