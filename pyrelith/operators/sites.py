"""Registries, simplification, seeded sampling, and stores."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrelith.functions.scalar import M_PER_DEG
from pyrelith.operators.components import connected_components
from pyrelith.operators.geo import covers
from pyrelith.operators.ordering import numbered
from pyrelith.runtime import Scratch

REGISTRY = "site_id string, lat double, lon double"


def match_registry(found: DataFrame, known: DataFrame, radius_m: float, next_number: int, prefix: str = "R") -> DataFrame:
    """``(site_id, lat, lon, n, new)`` for clusters ``(n, lat, lon)`` against ``(site_id, lat, lon)``.

    The largest cluster chooses first and takes the nearest site in reach that is free; who finds none gets a new number, the
    largest cluster first. Claims depend on one another only through sites in reach, so clusters and sites that are linked by reach are one
    fold. ``next_number`` must lie above all numbers that were ever given (``next_site_number``).
    """
    scratch = Scratch(found.sparkSession, "registry")
    r = radius_m / M_PER_DEG
    order = [F.desc("n"), F.col("lat"), F.col("lon")]
    c = scratch.table(numbered(found.select(F.col("n").cast("long").alias("n"), "lat", "lon"), order, "place"), "clusters")
    k = known.select("site_id", "lat", "lon").withColumns({"kx": F.floor(F.col("lon") / r), "ky": F.floor(F.col("lat") / r)})
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    k = k.withColumn("i", F.explode(around)).withColumn("j", F.explode(around)).select("site_id", F.col("lat").alias("klat"), F.col("lon").alias("klon"), (F.col("kx") + F.col("i")).alias("cx"), (F.col("ky") + F.col("j")).alias("cy"))
    d2 = F.pow(F.col("klat") - F.col("lat"), 2) + F.pow(F.col("klon") - F.col("lon"), 2)
    near = c.withColumns({"cx": F.floor(F.col("lon") / r), "cy": F.floor(F.col("lat") / r)}).join(k, ["cx", "cy"]).withColumn("d2", d2).where(F.col("d2") <= r * r)
    near = scratch.table(near.select("place", "site_id", "d2", F.xxhash64("place").alias("a"), F.xxhash64("site_id", F.lit("site")).alias("b")), "near")
    comp = connected_components(near, scratch)

    def claim(g: pd.DataFrame) -> pd.DataFrame:
        taken: set[str] = set()
        rows = []
        for place, wishes in g.sort_values(["place", "d2", "site_id"]).groupby("place", sort=True):
            free = [s for s in wishes["site_id"] if s not in taken]
            if free:
                taken.add(free[0])
                rows.append((place, free[0]))
        return pd.DataFrame(rows, columns=["place", "site_id"])

    claims = near.join(comp, near["a"] == comp["node"]).groupBy("component").applyInPandas(claim, "place long, site_id string")
    out = scratch.table(c.join(claims, "place", "left"), "claims")
    fresh = numbered(out.where("site_id is null").drop("site_id"), ["place"]).withColumn("site_id", F.format_string(f"{prefix}%03d", F.col("number") + next_number - 1))
    cols = ["site_id", "lat", "lon", "n"]
    return out.where("site_id is not null").select(*cols, F.lit(False).alias("new")).unionByName(fresh.select(*cols, F.lit(True).alias("new")))


def next_site_number(registry: DataFrame) -> int:
    """One above the largest number of a registry, those of sites that are gone too; 1 for an empty one."""
    return 1 + (registry.agg(F.max(F.regexp_extract("site_id", r"(\d+)$", 1).cast("int"))).first()[0] or 0)


def split_notes(matched: DataFrame, clusters: DataFrame, known: DataFrame, radius_m: float) -> DataFrame:
    """``(site_id, note)`` for each new site that lies within reach of a known one that another cluster took: it was split off."""
    r = radius_m / M_PER_DEG
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    k = known.withColumns({"kx": F.floor(F.col("lon") / r), "ky": F.floor(F.col("lat") / r)}).withColumn("i", F.explode(around)).withColumn("j", F.explode(around))
    k = k.select(F.col("site_id").alias("parent"), F.col("lat").alias("klat"), F.col("lon").alias("klon"), (F.col("kx") + F.col("i")).alias("cx"), (F.col("ky") + F.col("j")).alias("cy"))
    new = matched.where("new").withColumns({"cx": F.floor(F.col("lon") / r), "cy": F.floor(F.col("lat") / r)})
    d2 = F.pow(F.col("klat") - F.col("lat"), 2) + F.pow(F.col("klon") - F.col("lon"), 2)
    taken = matched.where("not new").select(F.col("site_id").alias("parent"))
    near = new.join(k, ["cx", "cy"]).withColumn("d2", d2).where(F.col("d2") <= r * r).join(taken, "parent", "left_semi")
    return near.groupBy("site_id").agg(F.concat(F.lit("split from "), F.min(F.struct("d2", "parent"))["parent"]).alias("note"))


def load_registry(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """The newest readable version of a registry (``version=N`` folders) and its number; an empty registry and 0 without one.

    A version that can't be read, as after a crash while it was written, falls back to the one before.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    for version in sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True):
        at = f"{folder}/version={version}"
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")):
            return spark.read.schema(REGISTRY).parquet(at), version
    return spark.createDataFrame([], REGISTRY), 0


def save_registry(registry: DataFrame, folder: str, version: int) -> None:
    """A new version beside the older ones, which stay as they are."""
    registry.select("site_id", "lat", "lon").write.mode("overwrite").parquet(f"{folder}/version={version}")


def douglas_peucker(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Points that a line within ``tolerance`` of all of them needs; the first and the last stay."""
    keep, stack = {0, len(points) - 1}, [(0, len(points) - 1)]
    while stack:
        a, b = stack.pop()
        (x1, y1), (x2, y2) = points[a], points[b]
        span = math.hypot(x2 - x1, y2 - y1)
        best, at = tolerance, -1
        for k in range(a + 1, b):
            x, y = points[k]
            d = abs((x2 - x1) * (y1 - y) - (x1 - x) * (y2 - y1)) / span if span else math.hypot(x - x1, y - y1)
            if d > best:
                best, at = d, k
        if at > 0:
            keep.add(at)
            stack += [(a, at), (at, b)]
    return [points[k] for k in sorted(keep)]


def simplify(rings: DataFrame, tolerance: float, col: str = "ring") -> DataFrame:
    """``simple``, the ring without points that it doesn't need; a ring of fewer than three points left stays as it was."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def run(col: pd.Series) -> pd.Series:
        out = []
        for ring in col:
            pts = [(p["x"], p["y"]) for p in ring]
            s = douglas_peucker([*pts, pts[0]], tolerance)[:-1]
            out.append([{"x": x, "y": y} for x, y in (s if len(s) > 2 else pts)])
        return pd.Series(out)

    return rings.withColumn("simple", run(col))


def controls(polygons: DataFrame, avoid: DataFrame, seed: int, each: int, away: float, apart: float) -> DataFrame:
    """``(adm_id, i, x, y)``: of ``each`` seeded candidates of a polygon's box those inside it, farther than ``away`` from
    every point to avoid, and farther than ``apart`` from those taken before (in order of their number).

    Hashes of (seed, polygon, number) are the random numbers, so reruns agree. The distance test is an anti join by cell;
    the ordered part sees one polygon's candidates.
    """
    unit = lambda salt: F.pmod(F.xxhash64(F.lit(seed), "adm_id", "i", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    c = polygons.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(each - 1))))
    c = c.withColumn("x", F.col("w") + unit(1) * (F.col("e") - F.col("w"))).withColumn("y", F.col("s") + unit(2) * (F.col("n") - F.col("s")))
    c = c.where(covers(F.col("ring"), F.col("x"), F.col("y"))).select("adm_id", "i", "x", "y", F.floor(F.col("x") / away).alias("cx"), F.floor(F.col("y") / away).alias("cy"))
    around = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    a = avoid.withColumn("p", F.explode(around)).withColumn("q", F.explode(around)).select(F.col("longitude").alias("ax"), F.col("latitude").alias("ay"), (F.floor(F.col("longitude") / away) + F.col("p")).alias("cx"), (F.floor(F.col("latitude") / away) + F.col("q")).alias("cy"))
    near = (c["cx"] == a["cx"]) & (c["cy"] == a["cy"]) & (F.hypot(F.col("x") - F.col("ax"), F.col("y") - F.col("ay")) <= away)
    free = c.join(a, near, "left_anti").select("adm_id", "i", "x", "y")

    def accept(g: pd.DataFrame) -> pd.DataFrame:
        taken: list[tuple[float, float]] = []
        keep = []
        for r in g.sort_values("i").itertuples():
            if all(math.hypot(r.x - x, r.y - y) > apart for x, y in taken):
                taken.append((r.x, r.y))
                keep.append(r.i)
        return g[g["i"].isin(keep)]

    return free.groupBy("adm_id").applyInPandas(accept, "adm_id int, i int, x double, y double")


def store_round_trip(df: DataFrame) -> DataFrame:
    """B1, B2: written partitioned by year into the shared folder, with one more row appended to a ledger, and read again."""
    scratch = Scratch(df.sparkSession, "store")
    path, ledger = scratch.path("detections"), scratch.path("ledger")
    df.withColumn("year", F.year("date_wit")).write.mode("overwrite").partitionBy("year").parquet(path)
    df.agg(F.count(F.lit(1)).alias("rows"), F.max("date_wit").alias("last_day")).write.mode("append").parquet(ledger)
    return df.sparkSession.read.parquet(path)
