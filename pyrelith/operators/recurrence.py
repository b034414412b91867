"""Places that burn again and again: site statistics, flags, and the clusterings that depend on order."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.functions.scalar import M_PER_DEG
from pyrelith.operators.components import connected_components
from pyrelith.runtime import Scratch


def site_stats(df: DataFrame, *site: str) -> DataFrame:
    """E5: count, distinct days, span and extent of each site."""
    return df.groupBy(*site).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("date_wit").alias("days"), F.datediff(F.max("date_wit"), F.min("date_wit")).cast("long").alias("span"), F.min("date_wit").alias("first_day"), F.max("date_wit").alias("last_day"))


def flags(df: DataFrame, site: list[str], min_days: int = 10, min_span: int = 90, min_history: int = 365) -> DataFrame:
    """Every row with ``recurrent``; a store that spans less than ``min_history`` days has no flags."""
    stats = site_stats(df, *site).select(*site, ((F.col("days") >= min_days) & (F.col("span") >= min_span)).alias("rec"))
    history = df.agg((F.datediff(F.max("date_wit"), F.min("date_wit")) >= min_history).alias("long"))
    return df.join(stats, site, "left").join(F.broadcast(history)).withColumn("recurrent", F.col("long") & F.coalesce("rec", F.lit(False))).drop("rec", "long")


def near_pairs(p: DataFrame, reach: float) -> DataFrame:
    """Pairs of points ``(id, x, y)`` within ``reach``, by buckets of that side."""
    p = p.withColumns({"bx": F.floor(F.col("x") / reach), "by": F.floor(F.col("y") / reach)})
    around = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    q = p.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around)).select(F.col("id").alias("a"), F.col("x").alias("xa"), F.col("y").alias("ya"), (F.col("bx") + F.col("dx")).alias("bx"), (F.col("by") + F.col("dy")).alias("by"))
    j = q.join(p, ["bx", "by"]).where(F.col("a") < F.col("id"))
    return j.where(F.pow(F.col("xa") - F.col("x"), 2) + F.pow(F.col("ya") - F.col("y"), 2) <= reach * reach).select("a", F.col("id").alias("b"))


def fold_leaders(x: np.ndarray, y: np.ndarray, radius: float, moving: bool) -> np.ndarray:
    """In the order given, each point joins the nearest (moving) or first (fixed) centre in reach, or becomes one."""
    cx, cy, n, out = [], [], [], np.zeros(len(x), dtype=np.int64)
    for i, (px, py) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        best, at = radius * radius, -1
        for c in range(len(cx)):
            d = (cx[c] - px) ** 2 + (cy[c] - py) ** 2
            if d < best if moving else d <= radius * radius:
                best, at = d, c
                if not moving:
                    break
        if at < 0:
            cx.append(px)
            cy.append(py)
            n.append(1)
            at = len(cx) - 1
        elif moving:
            n[at] += 1
            cx[at] += (px - cx[at]) / n[at]
            cy[at] += (py - cy[at]) / n[at]
        out[i] = at
    return out


def ordered_clusters(df: DataFrame, radius: float, reach: float, order: list[str], moving: bool, scale: float) -> DataFrame:
    """Fold each component of the places within ``reach`` on its own: a point can't meet a centre of another one.

    Places, not rows, are paired, so copies of a place cost nothing; a component is the unit that order makes indivisible.
    """
    scratch = Scratch(df.sparkSession, "clusters")
    keyed = df.withColumn("place", F.xxhash64("longitude", "latitude"))
    places = keyed.groupBy("place").agg((F.min("longitude") * scale).alias("x"), (F.min("latitude") * scale).alias("y"))
    pairs = near_pairs(places.withColumnRenamed("place", "id"), reach)
    comp = connected_components(pairs, scratch)
    rows = keyed.join(comp, keyed["place"] == comp["node"], "left").withColumn("component", F.coalesce("component", "place"))

    def fold(g: pd.DataFrame) -> pd.DataFrame:
        g = g.assign(frp=-g["frp"].fillna(-1e300)).sort_values(order, kind="stable")
        c = fold_leaders(g["longitude"].to_numpy() * scale, g["latitude"].to_numpy() * scale, radius, moving)
        first = g["detection_id"].to_numpy()[np.searchsorted(np.maximum.accumulate(c), np.arange(c.max() + 1))]
        return pd.DataFrame({"detection_id": g["detection_id"].to_numpy(), "cluster": first[c]})

    return rows.select("component", "detection_id", "date_wit", "longitude", "latitude", "frp").groupBy("component").applyInPandas(fold, "detection_id long, cluster long")


def leader_clusters(df: DataFrame, radius_m: float) -> DataFrame:
    """``(detection_id, cluster)``; a cluster is named by its first row in order of (day, latitude, longitude, id).

    Degrees without a cosine are the plane here. A centre stays within the radius of each member when it joins, so
    clusters can't reach beyond points within twice the radius.
    """
    r = radius_m / M_PER_DEG
    return ordered_clusters(df, r, 2 * r, ["date_wit", "latitude", "longitude", "detection_id"], True, 1.0)


def seed_clusters(df: DataFrame, radius_m: float) -> DataFrame:
    """Clusters around fixed seeds, the strongest rows first, rows without power last."""
    return ordered_clusters(df, radius_m, radius_m, ["frp", "detection_id"], False, M_PER_DEG)


def hull_areas(df: DataFrame, by: list[str]) -> DataFrame:
    """Area of the convex hull of each group's distinct places, on the group's plane; null for fewer than three or a line."""

    def area(g: pd.DataFrame) -> pd.DataFrame:
        k = np.cos(np.radians(g["latitude"].mean())) * M_PER_DEG
        pts = sorted(set(zip((g["longitude"] * k).tolist(), (g["latitude"] * M_PER_DEG).tolist(), strict=True)))

        def half(seq):
            h: list[tuple[float, float]] = []
            for p in seq:
                while len(h) > 1 and (h[-1][0] - h[-2][0]) * (p[1] - h[-2][1]) - (h[-1][1] - h[-2][1]) * (p[0] - h[-2][0]) <= 0:
                    h.pop()
                h.append(p)
            return h[:-1]

        ring = np.array(half(pts) + half(pts[::-1])) if len(pts) > 2 else np.zeros((0, 2))
        ha = None
        if len(ring) > 2:
            nxt = np.roll(ring, -1, axis=0)
            ha = float(abs((ring[:, 0] * nxt[:, 1] - nxt[:, 0] * ring[:, 1]).sum()) / 2e4)
        return g[by].iloc[:1].assign(points=len(pts), hull_ha=ha)

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in by)
    return df.select(*by, "longitude", "latitude").distinct().groupBy(*by).applyInPandas(area, f"{kinds}, points long, hull_ha double")
