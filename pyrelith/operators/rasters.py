"""Operators over pixel tables: composites, windows, patches, coverage, slot states."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.operators.components import connected_components
from pyrelith.runtime import Scratch


def nearest_looks(looks: DataFrame, day: str, value: str) -> DataFrame:
    """Of each pixel the newest look before ``day`` and the oldest after, by maxima and minima of structs, without a sort."""
    d = F.lit(day).cast("date")
    key = F.struct("look_date", "pixel_row", F.col(value).alias("v"))
    g = looks.groupBy("x", "y").agg(F.max(F.when(F.col("look_date") < d, key)).alias("a"), F.min(F.when(F.col("look_date") > d, key)).alias("b"))
    return g.select("x", "y", F.col("a.look_date").alias("pre_date"), F.col("a.v").alias("pre"), F.datediff(d, F.col("a.look_date")).alias("lag"), F.col("b.look_date").alias("post_date"), F.col("b.v").alias("post"))


def window_median(grid: DataFrame, value: str, half: int, size: int, tile: int = 50) -> DataFrame:
    """median of the window around each pixel without the pixel, over what is there; pixels nearer the border than ``half`` are left out.

    Pixels go to tiles of ``tile`` with a margin of ``half``; a task holds one tile as an array.
    """
    n = -(-size // tile)
    near = lambda c: F.sequence(F.greatest(F.floor((F.col(c) - half) / tile), F.lit(0)), F.least(F.floor((F.col(c) + half) / tile), F.lit(n - 1)))
    dealt = grid.withColumn("tx", F.explode(near("x"))).withColumn("ty", F.explode(near("y")))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        tx, ty = int(g["tx"].iloc[0]) * tile, int(g["ty"].iloc[0]) * tile
        a = np.full((tile + 2 * half, tile + 2 * half), np.nan)
        a[g["x"].to_numpy() - tx + half, g["y"].to_numpy() - ty + half] = g[value].to_numpy()
        w = 2 * half + 1
        views = np.lib.stride_tricks.sliding_window_view(a, (w, w)).reshape(tile, tile, w * w).copy()
        views[:, :, w * w // 2] = np.nan
        own = a[half : half + tile, half : half + tile]
        i, j = np.nonzero(~np.isnan(own))
        around = views[i, j]
        seen = ~np.isnan(around)
        some = seen.any(1)
        i, j, around, seen = i[some], j[some], around[some], seen[some]
        x, y = i + tx, j + ty
        inner = (x >= half) & (x < size - half) & (y >= half) & (y < size - half)
        mid = np.nanmedian(around[inner], axis=1) if inner.any() else np.zeros(0)
        return pd.DataFrame({"scene": int(g["scene"].iloc[0]), "x": x[inner], "y": y[inner], value: own[i[inner], j[inner]].astype(int), "background": mid, "n": seen[inner].sum(1)})

    return dealt.groupBy("scene", "tx", "ty").applyInPandas(run, f"scene int, x long, y long, {value} int, background double, n long")


def patches(pixels: DataFrame, width: int) -> DataFrame:
    """Patches of pixels ``(scene, x, y)`` that touch by a side or a corner: the smallest number (scene * width^2 + x * width + y) and the size."""
    scratch = Scratch(pixels.sparkSession, "patches")
    p = scratch.table(pixels.select((F.col("scene") * width * width + F.col("x") * width + F.col("y")).cast("long").alias("id"), "scene", "x", "y"), "pixels")
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))])
    q = p.withColumn("s", F.explode(steps)).select(F.col("id").alias("a"), "scene", (F.col("x") + F.col("s.i")).alias("x"), (F.col("y") + F.col("s.j")).alias("y"))
    comp = connected_components(q.join(p, ["scene", "x", "y"]).select("a", F.col("id").alias("b")), scratch)
    return p.join(comp, p["id"] == comp["node"], "left").groupBy(F.coalesce("component", "id").alias("patch")).agg(F.count(F.lit(1)).alias("pixels"))


def coverage(looks: DataFrame) -> DataFrame:
    """For each scene, of all pixels ever seen, the share it covers, the share clear in it, and the running union of clear ones.

    A pixel counts in the first scene that is clear there, so the union is a sum and no set is held.
    """
    p = looks.groupBy("x", "y", "scene").agg(F.max("clear").alias("clear"))
    per = p.groupBy("scene").agg(F.count(F.lit(1)).alias("covers"), F.count_if("clear").alias("clear"))
    first = p.where("clear").groupBy("x", "y").agg(F.min("scene").alias("scene")).groupBy("scene").agg(F.count(F.lit(1)).alias("added"))
    n = p.select("x", "y").distinct().agg(F.count(F.lit(1)).alias("n"))
    j = per.join(first, "scene", "left").join(F.broadcast(n))
    run = F.sum(F.coalesce("added", F.lit(0))).over(Window.orderBy("scene"))
    return j.select("scene", (F.col("covers") / F.col("n")).alias("covers"), (F.col("clear") / F.col("n")).alias("clear"), (run / F.col("n")).alias("running"))


def onset_brackets(slots: DataFrame, least_present: float = 0.5) -> DataFrame:
    """From ``(event, slot, state)`` the first flagged slot, the last quiet one before it, their gap, and one reading.

    The array of a slot's states is not needed: quiet slots before the first flag are found by a window minimum.
    """
    flag = F.min(F.when(F.col("state") == "flagged", F.col("slot"))).over(Window.partitionBy("event"))
    s = slots.withColumn("flag", flag)
    g = s.groupBy("event", "flag").agg(F.max(F.when((F.col("state") == "quiet") & (F.col("slot") < F.col("flag")), F.col("slot"))).alias("quiet"), F.min_by("state", "slot").alias("opening"), F.avg((F.col("state") != "missing").cast("int")).alias("present"))
    reading = F.when(F.col("present") < least_present, "too few slots").when(F.col("flag").isNull(), "not resolved").when(F.col("opening") == "flagged", "flagged from the start").when(F.col("quiet").isNotNull(), "bracketed").otherwise("no quiet slot")
    return g.select("event", F.col("flag").alias("first_flag"), F.col("quiet").alias("last_quiet"), (F.col("flag") - F.col("quiet")).alias("gap"), reading.alias("reading"))


def onset_summary(brackets: DataFrame, readings: tuple[str, ...], hours: int) -> DataFrame:
    """``(what, item, value)``: events by reading, none left out; first flags by hour, of events that are resolved; events that
    share their first flagged slot; median, least and most of the bracketed events' gaps and leads (slots from the first to the flagged one)."""
    spark = brackets.sparkSession
    every = spark.createDataFrame([(r,) for r in readings], "item string")
    counts = brackets.groupBy(F.col("reading").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    named = every.join(counts, "item", "left").select(F.lit("reading").alias("what"), "item", F.coalesce("n", F.lit(0)).cast("double").alias("value"))
    flagged = brackets.where("first_flag is not null")
    hour = flagged.where(~F.col("reading").isin("too few slots", "not resolved")).groupBy((F.col("first_flag") % hours).alias("h")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    hour = hour.select(F.lit("hour").alias("what"), F.lpad(F.col("h").cast("string"), 2, "0").alias("item"), "value")
    shared = flagged.groupBy("first_flag").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("double").alias("value"))
    b = brackets.where("reading = 'bracketed'").agg(*[f(F.col(c)).cast("double").alias(f"{w}{n}") for w, c in (("gap", "gap"), ("lead", "first_flag")) for n, f in (("median", F.median), ("min", F.min), ("max", F.max))])
    spread = b.select(F.explode(F.array(*[F.struct(F.lit(w).alias("what"), F.lit(n).alias("item"), F.col(f"{w}{n}").alias("value")) for w in ("gap", "lead") for n in ("median", "min", "max")])).alias("r")).select("r.*")
    return named.unionByName(hour).unionByName(shared.select(F.lit("shared").alias("what"), F.lit("first flag").alias("item"), "value")).unionByName(spread)


def compare_scenes(pix: DataFrame, bands: tuple[str, ...], margin: float) -> DataFrame:
    """For each pair of scenes ``ref < cand`` and each band, over the pixels that both have: medians, median difference, root mean square
    error (also as percent of the reference's span from the 2nd to the 98th percentile), percent of identical pixels, correlation with the
    same band, the best correlation with any band, whether that beats the same band by more than ``margin``, and the common box.

    Pixels are averaged by scene first; one aggregation over the joined pixels gives all of it, so the pixels move once.
    """
    g = pix.groupBy("scene", "x", "y").agg(*[F.avg(b).alias(b) for b in bands])
    one = g.select(F.col("scene").alias("ref"), "x", "y", *[F.col(b).alias(f"r_{b}") for b in bands])
    two = g.select(F.col("scene").alias("cand"), "x", "y", *[F.col(b).alias(f"c_{b}") for b in bands])
    j = one.join(two, ["x", "y"]).where("ref < cand")
    aggs = [F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}{k}") for c in ("x", "y") for k, f in ((0, F.min), (1, F.max))]]
    for b in bands:
        r, c = F.col(f"r_{b}"), F.col(f"c_{b}")
        d = c - r
        aggs += [F.percentile(r, F.array(F.lit(0.02), F.lit(0.5), F.lit(0.98))).alias(f"q_{b}"), F.median(c).alias(f"m_{b}"), F.median(d).alias(f"d_{b}"), F.sqrt(F.avg(d * d)).alias(f"e_{b}"), F.avg((F.abs(d) < 1e-9).cast("int")).alias(f"s_{b}")]
        aggs += [F.corr(c, F.col(f"r_{o}")).alias(f"k_{b}_{o}") for o in bands]
    t = j.groupBy("ref", "cand").agg(*aggs)
    rows = []
    for b in bands:
        q, e = F.col(f"q_{b}"), F.col(f"e_{b}")
        best, same = F.greatest(*[F.col(f"k_{b}_{o}") for o in bands]), F.col(f"k_{b}_{b}")
        rows.append(F.struct(F.lit(b).alias("band"), q[1].alias("ref_median"), F.col(f"m_{b}").alias("cand_median"), F.col(f"d_{b}").alias("middle"), e.alias("rmse"), (100 * e / F.greatest(q[2] - q[0], F.lit(1e-9))).alias("rmse_pct"), (100 * F.col(f"s_{b}")).alias("identical_pct"), same.alias("same_r"), best.alias("best_r"), (best - same > margin).alias("decisive")))
    return t.select("ref", "cand", "n", "x0", "x1", "y0", "y1", F.explode(F.array(*rows)).alias("r")).select("ref", "cand", "n", "x0", "x1", "y0", "y1", "r.*")


def burned_area(pix: DataFrame, day: str, member_dn: int, reach: int, quantile: float, least_ring: int, tile: int = 25, width: int = 100, pixel_ha: float = 0.04) -> DataFrame:
    """One row a tile of ``tile`` pixels: its strong pixels are the members of an event, and what lies within ``reach`` of one is its footprint.

    The change of a pixel is between its nearest clear looks before and after ``day`` (D14, I7). The threshold is a quantile of the change
    on the land outside the footprint; with fewer than ``least_ring`` such pixels there is none (I12). Inside, land, clear and
    changed areas, the upper bound if all that wasn't seen changed (H28), lags of the looks, clear and changed pixels by class (I13), and
    the number of patches of changed pixels (I17).
    """
    looks = nearest_looks(pix.where("valid"), day, "dn").select("x", "y", (F.col("post") - F.col("pre")).alias("d"), F.col("lag").cast("long").alias("lag"))
    number = F.floor(F.col("x") / tile) * (width // tile) + F.floor(F.col("y") / tile)
    k = pix.groupBy("x", "y").agg((F.max("dn") > member_dn).alias("member"), F.bool_and(F.col("worldcover") != 80).alias("land"), F.min("worldcover").alias("cls")).withColumn("tile", number)
    k = k.join(looks, ["x", "y"], "left")
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if i * i + j * j <= reach * reach])
    near = k.where("member").withColumn("o", F.explode(steps)).select((F.col("x") + F.col("o.i")).alias("x"), (F.col("y") + F.col("o.j")).alias("y"), "tile").distinct().withColumn("inside", F.lit(True))
    t = k.join(near, ["x", "y", "tile"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    ring = t.where(~F.col("inside") & F.col("land") & F.col("d").isNotNull()).groupBy("tile").agg(F.count(F.lit(1)).alias("ring"), F.percentile("d", F.lit(quantile)).alias("q"))
    ring = ring.select("tile", "ring", F.when(F.col("ring") >= least_ring, F.col("q")).alias("t"))
    f = t.where("inside").join(ring, "tile").withColumn("clear", F.col("land") & F.col("d").isNotNull()).withColumn("changed", F.coalesce(F.col("land") & (F.col("d") > F.col("t")), F.lit(False)))
    f = Scratch(pix.sparkSession, "burned-area").table(f, "footprint")
    found = patches(f.where("changed").select(F.col("tile").alias("scene"), "x", "y"), width).groupBy(F.floor(F.col("patch") / (width * width)).alias("tile")).agg(F.count(F.lit(1)).alias("patches"))
    by = f.where("land").groupBy("tile", "cls").agg(F.count_if("clear").alias("a"), F.count_if("changed").alias("b"))
    item = F.concat_ws(":", F.col("cls").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"))
    by = by.groupBy("tile").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cls", item.alias("v")))), lambda x: x["v"]), " ").alias("by_class"))
    g = f.groupBy("tile", "ring", "t").agg(F.count_if("land").alias("land"), F.count_if("clear").alias("clear"), F.count_if("changed").alias("changed"), F.percentile(F.when(F.col("clear"), F.col("lag")), F.array(F.lit(0.5), F.lit(0.9))).alias("lags"))
    out = g.join(by, "tile", "left").join(found, "tile", "left")
    ha = {"footprint_ha": F.col("land"), "clear_ha": F.col("clear"), "changed_ha": F.col("changed"), "upper_ha": F.col("changed") + F.col("land") - F.col("clear")}
    return out.select("tile", "ring", F.round("t", 6).alias("threshold"), F.when(F.col("t").isNull(), "no local reference").otherwise("assessed").alias("status"), *[F.round(v * pixel_ha, 4).alias(c) for c, v in ha.items()], F.round(F.col("lags")[0], 4).alias("lag_p50"), F.round(F.col("lags")[1], 4).alias("lag_p90"), "by_class", F.coalesce("patches", F.lit(0)).alias("patches"))
