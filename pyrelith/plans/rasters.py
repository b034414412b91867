"""Queries over pixels: indices, masks, composites, zonal and neighbourhood statistics (survey sections C15-C16, D14, D17, E19-E30, F4-F9, I)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions import raster as R
from pyrelith.functions import scalar as S
from pyrelith.operators import outlines, statistics
from pyrelith.operators import rasters as X
from pyrelith.plans.registry import query
from pyrelith.runtime import Scratch

BANDS = ("b2", "b3", "b4", "b6", "b7", "b8a", "b11", "b12")
INDEX = {
    "nbr": "(b12 - b8a) / (b12 + b8a)",
    "nbrswir": "(b12 - b11 - 0.02e0) / (b12 + b11 + 0.1e0)",
    "ndswir": "(b11 - b8a) / (b11 + b8a)",
    "mirbi": "10 * b12 - 9.8e0 * b11 + 2",
    "bais2": "(1 - sqrt(b6 * b7 * b8a / b4)) * ((b12 - b8a) / sqrt(b12 + b8a) + 1)",
    "nbr_plus": "(b12 - b8a - b3 - b2) / (b12 + b8a + b3 + b2)",
    "atbi": "CASE WHEN b8a > 0 THEN (b12 - b8a) / (b12 + b8a) * b12 / b8a END",
}


def indices(pix: DataFrame) -> dict:
    return R.burn_indices({b: F.col(b) for b in BANDS})


@query("v_pix", sql="SELECT pixel_row, " + ", ".join(f"round({v}, 8) + 0.0e0 AS {k}" for k, v in INDEX.items()) + " FROM v_pix")
def i6_i8_burn_indices(pix):
    """Seven indices of each pixel."""
    return pix.select("pixel_row", *[F.round(v, 8).alias(k) for k, v in indices(pix).items()])


@query("v_pix", sql="""WITH r AS (SELECT pixel_row, CASE WHEN dn NOT IN (7, 8) AND -0.0037e0 * dn + 15.2e0 > 0 THEN -0.0037e0 * dn + 15.2e0 END AS rad
    FROM v_pix), t AS (SELECT pixel_row, (6.62606957e-34 * 2.99792458e8 / (1.3806488e-23 * 1.04e-5)) / ln(2 * 6.62606957e-34 * pow(2.99792458e8,
    2) / (rad * 1e6 * pow(1.04e-5, 5)) + 1) AS te FROM r) SELECT pixel_row, round(-0.1e0 + te, 4) AS bt FROM t""")
def i1_brightness_temperature(pix):
    """Counts to temperature; invalid counts and radiances are null."""
    k = R.Calibration(error=7, outside=8)
    return pix.select("pixel_row", F.round(R.brightness_temperature(F.col("dn"), k), 4).alias("bt"))


NAV = """WITH a AS (SELECT DISTINCT x, y, radians((x * 55 - 2750.5e0) * 65536 / 20466275.0e0) AS tx, radians((y * 55 - 2750.5e0) * 65536 / 20466275.0e0) AS ty
    FROM v_pix), v AS (SELECT *, -cos(tx) * cos(ty) AS vx, sin(tx) AS vy, -sin(ty) AS vz FROM a),
  k AS (SELECT *, (vx * vx + vy * vy) / pow(6378.137e0, 2) + vz * vz / pow(6356.7523e0, 2) AS qa, 2 * 42164 * vx / pow(6378.137e0,
    2) AS qb, pow(42164.0e0 / 6378.137e0, 2) - 1 AS qc FROM v), t AS (SELECT *, CASE WHEN qb * qb - 4 * qa * qc >= 0 THEN (-qb - sqrt(qb * qb - 4 * qa * qc)) / (2 * qa) END AS t
    FROM k)
  SELECT x, y, round(degrees(atan2(t * vy, 42164 + t * vx)) + 140.7e0, 5) AS lon, round(degrees(atan2(t * vz * pow(6378.137e0,
    2), sqrt(pow(42164 + t * vx, 2) + pow(t * vy, 2)) * pow(6356.7523e0, 2))), 5) AS lat FROM t"""


@query("v_pix", sql=NAV)
def i2_navigation(pix):
    """Pixels of a full disk to longitude and latitude; null off the Earth."""
    lon, lat = R.pixel_lonlat(F.col("y") * 55, F.col("x") * 55)
    return pix.select("x", "y").distinct().select("x", "y", F.round(lon, 5).alias("lon"), F.round(lat, 5).alias("lat"))


@query("v_pix", sql="""SELECT scene, min(y) - 8 AS line0, max(y) + 8 AS line1, min(x) - 8 AS col0, max(x) + 8 AS col1, (min(y) * 55 - 1) // 550 + 1 AS seg0,
    (max(y) * 55 - 1) // 550 + 1 AS seg1 FROM v_pix WHERE x BETWEEN 20 AND 60 AND y BETWEEN 30 AND 70 GROUP BY scene""")
def i3_window(pix):
    """Padded window of an area and the segments that it needs."""
    w = pix.where("x between 20 and 60 and y between 30 and 70").groupBy("scene").agg(F.min("y").alias("a"), F.max("y").alias("b"), F.min("x").alias("c"), F.max("x").alias("d"))
    seg = lambda c: F.floor((F.col(c) * 55 - 1) / 550) + 1
    return w.select("scene", (F.col("a") - 8).alias("line0"), (F.col("b") + 8).alias("line1"), (F.col("c") - 8).alias("col0"), (F.col("d") + 8).alias("col1"), seg("a").alias("seg0"), seg("b").alias("seg1"))


GRID = "g AS (SELECT scene, x, y, max(dn) AS dn FROM v_pix GROUP BY ALL)"


def grid(pix):
    return pix.groupBy("scene", "x", "y").agg(F.max("dn").alias("dn"))


@query("v_pix", sql=f"""WITH {GRID} SELECT a.scene, a.x, a.y, median(b.dn) AS background, count(*) AS n, a.dn - median(b.dn) > 400 AND a.dn > 900 AS flagged
    FROM g a JOIN g b ON b.scene = a.scene AND abs(b.x - a.x) <= 3 AND abs(b.y - a.y) <= 3 AND (a.x <> b.x OR a.y <> b.y)
    WHERE a.x BETWEEN 3 AND 96 AND a.y BETWEEN 3 AND 96 GROUP BY a.scene, a.x, a.y, a.dn""")
def f9_i4_anomaly_flags(pix):
    """Median of a window without its centre; flags above it. Tiles overlap by the window, so no pixel looks beyond its task."""
    return X.window_median(grid(pix), "dn", half=3, size=100).select("scene", "x", "y", "background", "n", ((F.col("dn") - F.col("background") > 400) & (F.col("dn") > 900)).alias("flagged"))


@query("v_pix", sql="""SELECT scene, count(*) FILTER (WHERE scl IN (4, 5, 6, 7)) AS clear, count(*) FILTER (WHERE scl IN (2, 4, 5,
    6, 7)) AS with_dark, count(*) FILTER (WHERE (qa & 3) = 0) AS state_clear, count(*) FILTER (WHERE worldcover <> 80) AS land
    FROM v_pix GROUP BY scene""")
def c15_c16_masks(pix):
    """Cloud and water masks."""
    return pix.groupBy("scene").agg(F.count_if(R.clear_sky(F.col("scl"))).alias("clear"), F.count_if(R.clear_sky(F.col("scl"), True)).alias("with_dark"), F.count_if(R.state_clear(F.col("qa"))).alias("state_clear"), F.count_if(F.col("worldcover") != 80).alias("land"))


@query("v_pix", sql="SELECT x, y, max_by(dn, (look_date, pixel_row)) AS last_on_top, max(dn) AS highest, round(avg(dn), 6) AS mean FROM v_pix WHERE valid GROUP BY x, y")
def i9_composites(pix):
    """Last on top, highest and mean of the valid looks of a pixel."""
    return pix.where("valid").groupBy("x", "y").agg(F.max_by("dn", F.struct("look_date", "pixel_row")).alias("last_on_top"), F.max("dn").alias("highest"), F.round(F.avg("dn"), 6).alias("mean"))


@query("v_pix", sql="""WITH n AS (SELECT x, y, worldcover, count(*) AS n FROM v_pix WHERE valid GROUP BY ALL)
    SELECT x, y, min_by(worldcover, (-n, worldcover)) AS mode FROM n GROUP BY x, y""")
def i9_mode_composite(pix):
    """The most frequent class, the smallest of several."""
    n = pix.where("valid").groupBy("x", "y", "worldcover").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("x", "y").agg(F.min(F.struct(-F.col("n"), "worldcover"))["worldcover"].alias("mode"))


LOOK = "DATE '1998-06-01'"


@query("v_pix", sql=f"""SELECT x, y, max(look_date) FILTER (WHERE look_date < {LOOK}) AS pre_date, max_by(dn, (look_date, pixel_row)) FILTER (WHERE look_date < {LOOK}) AS pre,
    {LOOK} - max(look_date) FILTER (WHERE look_date < {LOOK}) AS lag, min(look_date) FILTER (WHERE look_date > {LOOK}) AS post_date,
    min_by(dn, (look_date, pixel_row)) FILTER (WHERE look_date > {LOOK}) AS post FROM v_pix WHERE valid GROUP BY x, y""")
def d14_nearest_look(pix):
    """Of each pixel the newest clear look before a day and the oldest after, with the lag."""
    return X.nearest_looks(pix.where("valid"), "1998-06-01", "dn").withColumn("lag", F.col("lag").cast("long"))


@query("v_pix", sql="""WITH d AS (SELECT x, y, max_by((b12 - b8a) / (b12 + b8a), (look_date, pixel_row)) FILTER (WHERE look_date < DATE '1998-06-01') AS pre,
    min_by((b12 - b8a) / (b12 + b8a), (look_date, pixel_row)) FILTER (WHERE look_date > DATE '1998-06-01') AS post
    FROM v_pix WHERE valid GROUP BY x, y) SELECT x, y, round(post - pre, 8) + 0.0e0 AS dnbr FROM d WHERE pre IS NOT NULL AND post IS NOT NULL""")
def i7_difference(pix):
    """Index after minus index before."""
    p = X.nearest_looks(pix.where("valid").withColumn("nbr", indices(pix)["nbr"]), "1998-06-01", "nbr")
    return p.where("pre is not null and post is not null").select("x", "y", F.round(F.col("post") - F.col("pre"), 8).alias("dnbr"))


STRATUM = "CASE WHEN worldcover = 80 THEN 'water' WHEN scl IN (8, 9, 10) THEN 'cloud' WHEN dn < 600 THEN 'adjacent' WHEN dn > 1400 THEN 'far' END"


def stratum():
    """Four strata that exclude one another; other pixels are null."""
    return F.when(F.col("worldcover") == 80, "water").when(F.col("scl").isin(8, 9, 10), "cloud").when(F.col("dn") < 600, "adjacent").when(F.col("dn") > 1400, "far")


@query("v_pix", sql=f"""WITH s AS (SELECT {STRATUM} AS stratum, nb FROM (SELECT *, {INDEX['nbr']} AS nb FROM v_pix))
    SELECT stratum, count(*) AS n, round(min(nb), 7) AS lo, round(quantile_cont(nb, 0.05), 7) AS p5, round(quantile_cont(nb, 0.5),
    7) AS p50, round(quantile_cont(nb, 0.95), 7) AS p95, round(max(nb), 7) AS hi FROM s WHERE stratum IS NOT NULL
    GROUP BY stratum""")
def e23_i11_distributions(pix):
    """Distribution of an index by stratum."""
    s = pix.select(stratum().alias("stratum"), indices(pix)["nbr"].alias("nb")).where("stratum is not null")
    q = F.percentile("nb", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return s.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("nb"), 7).alias("lo"), q.alias("q"), F.round(F.max("nb"), 7).alias("hi")).select("stratum", "n", "lo", *[F.round(F.col("q")[i], 7).alias(c) for i, c in enumerate(("p5", "p50", "p95"))], "hi")


@query("v_pix", sql=f"""WITH s AS (SELECT {STRATUM} AS stratum, nb FROM (SELECT *, {INDEX['nbr']} AS nb FROM v_pix)), t AS (SELECT quantile_cont(nb,
    0.95) AS p95 FROM s WHERE stratum = 'adjacent') SELECT stratum, round(avg((nb > p95)::INT), 7) AS share
    FROM s, t WHERE stratum IS NOT NULL GROUP BY stratum""")
def e24_exceedance(pix):
    """Share of each stratum above the 95th percentile of one."""
    s = pix.select(stratum().alias("stratum"), indices(pix)["nbr"].alias("nb")).where("stratum is not null")
    t = s.where("stratum = 'adjacent'").agg(F.percentile("nb", F.lit(0.95)).alias("p95"))
    return s.join(F.broadcast(t)).groupBy("stratum").agg(F.round(F.avg((F.col("nb") > F.col("p95")).cast("int")), 7).alias("share"))


@query("v_pix", sql="""SELECT CAST(sum((worldcover = 80)::INT * (scl IN (8, 9, 10) AND worldcover <> 80)::INT) AS BIGINT) AS water_cloud,
    CAST(sum((worldcover = 80)::INT * (dn < 600)::INT) AS BIGINT) AS water_near FROM v_pix""")
def e25_overlap(pix):
    """Pixels that two masks share."""
    i = lambda c: c.cast("int")
    water = i(F.col("worldcover") == 80)
    return pix.agg(F.sum(water * i(F.col("scl").isin(8, 9, 10) & (F.col("worldcover") != 80))).alias("water_cloud"), F.sum(water * i(F.col("dn") < 600)).alias("water_near"))


FUEL = """CASE WHEN worldcover = 10 AND tmf IN (3, 4) THEN 2 WHEN worldcover = 10 THEN 1 WHEN worldcover = 20 THEN 3
    WHEN worldcover = 30 THEN 4 WHEN worldcover = 40 THEN 5 ELSE 6 END"""
DYN = "CASE WHEN dynamic = 1 AND tmf IN (3, 4) THEN 2 WHEN dynamic = 1 THEN 1 WHEN dynamic = 5 THEN 3 WHEN dynamic = 2 THEN 4 WHEN dynamic = 4 THEN 5 ELSE 6 END"


def fuels():
    return R.worldcover_fuel(F.col("worldcover"), F.col("tmf")), R.dynamic_fuel(F.col("dynamic"), F.col("tmf"))


@query("v_pix", sql=f"""WITH f AS (SELECT {FUEL} AS fuel, valid FROM v_pix) SELECT k.fuel::INTEGER AS fuel, count(f.fuel) AS pixels,
    round(count(f.fuel) * 0.04e0, 4) AS ha, count(*) FILTER (WHERE valid) AS valid FROM range(1, 7) AS k(fuel)
    LEFT JOIN f ON f.fuel = k.fuel GROUP BY 1""")
def e19_e20_i14_class_areas(pix):
    """Area of every class, those without pixels too."""
    f = pix.groupBy(fuels()[0].alias("fuel")).agg(F.count(F.lit(1)).alias("pixels"), F.count_if("valid").alias("valid"))
    every = pix.sparkSession.range(1, 7).select(F.col("id").cast("int").alias("fuel"))
    return every.join(f, "fuel", "left").select("fuel", F.coalesce("pixels", F.lit(0)).alias("pixels"), F.round(F.coalesce("pixels", F.lit(0)) * 0.04, 4).alias("ha"), F.coalesce("valid", F.lit(0)).alias("valid"))


@query("v_pix", sql=f"""WITH f AS (SELECT {FUEL} AS a, {DYN} AS b FROM v_pix), c AS (SELECT a, b, count(*) AS n
    FROM f GROUP BY ALL) SELECT x.k::INTEGER AS a, y.k::INTEGER AS b, CAST(10 * x.k + y.k AS INTEGER) AS code, coalesce(n, 0) AS n
    FROM range(1, 7) AS x(k) CROSS JOIN range(1, 7) AS y(k) LEFT JOIN c ON a = x.k AND b = y.k""")
def e21_confusion(pix):
    """All 36 pairs of classes."""
    a, b = fuels()
    c = pix.groupBy(a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    six = F.sequence(F.lit(1), F.lit(6))
    every = pix.sparkSession.range(1).select(F.explode(six).alias("a")).withColumn("b", F.explode(six))
    return every.join(c, ["a", "b"], "left").select("a", "b", (F.col("a") * 10 + F.col("b")).alias("code"), F.coalesce("n", F.lit(0)).alias("n"))


@query("v_pix", sql=f"""SELECT ({FUEL})::INTEGER AS fuel, count(*) AS n, round(count(*) / (SELECT count(*) FROM v_pix), 8) AS share,
    round(sum(b12), 4) AS total, round(median(b12), 8) AS middle FROM v_pix GROUP BY 1""")
def e22_class_table(pix):
    """Counts, shares, sums and medians by class."""
    t = pix.groupBy(fuels()[0].alias("fuel")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("b12"), 4).alias("total"), F.round(F.median("b12"), 8).alias("middle"))
    return t.join(F.broadcast(pix.agg(F.count(F.lit(1)).alias("all")))).select("fuel", "n", F.round(F.col("n") / F.col("all"), 8).alias("share"), "total", "middle")


@query("v_pix", sql="""SELECT scene, count(*) FILTER (WHERE worldcover = 10 AND tmf = 2) AS degraded, count(*) FILTER (WHERE worldcover = 10 AND tmf IN (0,
    5, 6)) AS unresolved, count(*) FILTER (WHERE worldcover = 90) AS wetland FROM v_pix GROUP BY scene""")
def i15_judgement_calls(pix):
    """I15."""
    return pix.groupBy("scene").agg(*[F.count_if(v).alias(k) for k, v in R.judgement_flags(F.col("worldcover"), F.col("tmf")).items()])


@query("v_pix", sql="""WITH p AS (SELECT x, y, scene, max((scl IN (4, 5, 6, 7))::INT) AS clear FROM v_pix GROUP BY ALL), t AS (SELECT count(*) AS n
    FROM (SELECT DISTINCT x, y FROM v_pix)), f AS (SELECT x, y, min(scene) AS first FROM p WHERE clear = 1
    GROUP BY x, y), s AS (SELECT scene, count(*) AS covers, sum(clear) AS clear FROM p GROUP BY scene), u AS (SELECT first AS scene,
    count(*) AS added FROM f GROUP BY 1) SELECT s.scene, round(covers / n, 8) AS covers, round(clear / n, 8) AS clear, round(sum(coalesce(added,
    0)) OVER (ORDER BY s.scene) / n, 8) AS running FROM s LEFT JOIN u USING (scene), t""")
def e26_f4_coverage(pix):
    """Shares of one denominator by scene, and the running union of clear pixels."""
    return X.coverage(pix.withColumn("clear", R.clear_sky(F.col("scl")))).withColumns({c: F.round(c, 8) for c in ("covers", "clear", "running")})


@query("v_pix", sql="""WITH s AS (SELECT scene, x // 10 AS tile, avg(valid::INT) AS clear FROM v_pix GROUP BY ALL)
    SELECT a.tile, a.scene AS pre, b.scene AS post, round(least(a.clear, b.clear), 8) AS worse FROM s a JOIN s b ON a.tile = b.tile AND a.scene < b.scene
    ORDER BY least(a.clear, b.clear) DESC, a.tile, a.scene, b.scene LIMIT 12""")
def d17_scene_pairs(pix):
    """The best pairs of scenes of one tile."""
    s = pix.groupBy("scene", F.floor(F.col("x") / 10).alias("tile")).agg(F.avg(F.col("valid").cast("int")).alias("clear"))
    b = s.select("tile", F.col("scene").alias("post"), F.col("clear").alias("cb"))
    j = s.withColumnRenamed("scene", "pre").join(b, "tile").where("pre < post").withColumn("w", F.least("clear", "cb"))
    return j.orderBy(F.desc("w"), "tile", "pre", "post").limit(12).select("tile", "pre", "post", F.round("w", 8).alias("worse"))


@query("v_pix", sql="""WITH t AS (SELECT scene, CASE WHEN count(*) FILTER (WHERE scl < 4) >= 2000 THEN quantile_cont(dn, 0.99) FILTER (WHERE scl < 4) END AS limit_,
    count(*) FILTER (WHERE scl < 4) AS ring FROM v_pix GROUP BY scene) SELECT scene, ring, round(limit_, 8) AS threshold, CASE
    WHEN limit_ IS NULL THEN 'no local reference' END AS reason, count(*) FILTER (WHERE scl >= 4 AND dn > limit_) AS changed, round(count(*) FILTER (WHERE scl >= 4) * 0.04e0,
    4) AS clear_ha FROM v_pix JOIN t USING (scene) GROUP BY ALL""")
def i12_i13_local_threshold(pix):
    """A threshold from each scene's own ring, none if the ring is too small; what is above it."""
    ring = F.col("scl") < 4
    t = pix.groupBy("scene").agg(F.count_if(ring).alias("ring"), F.percentile(F.when(ring, F.col("dn")), F.lit(0.99)).alias("p"))
    t = t.select("scene", "ring", F.when(F.col("ring") >= 2000, F.col("p")).alias("t"))
    g = pix.join(t, "scene").groupBy("scene", "ring", "t").agg(F.count_if((F.col("scl") >= 4) & (F.col("dn") > F.col("t"))).alias("changed"), F.count_if(F.col("scl") >= 4).alias("n"))
    return g.select("scene", "ring", F.round("t", 8).alias("threshold"), F.when(F.col("t").isNull(), "no local reference").alias("reason"), "changed", F.round(F.col("n") * 0.04, 4).alias("clear_ha"))


@query("v_pix", sql="""WITH p AS (SELECT x, y, CAST(date_trunc('month', look_date) AS DATE) AS month, avg(b8a) AS v, bool_and(worldcover <> 80) AS land
    FROM v_pix WHERE (qa & 3) = 0 GROUP BY ALL) SELECT month, round(avg(v), 8) AS mean, round(avg(v) FILTER (WHERE land), 8) AS land_mean,
    count(*) AS pixels FROM p GROUP BY month""")
def i21_e35_monthly_reduction(pix):
    """First each pixel's month, then the mean over pixels and over land."""
    p = pix.where(R.state_clear(F.col("qa"))).groupBy("x", "y", S.month_start("look_date").alias("month")).agg(F.avg("b8a").alias("v"), F.bool_and(F.col("worldcover") != 80).alias("land"))
    return p.groupBy("month").agg(F.round(F.avg("v"), 8).alias("mean"), F.round(F.avg(F.when(F.col("land"), F.col("v"))), 8).alias("land_mean"), F.count(F.lit(1)).alias("pixels"))


@query("v_pix", "v_lab", sql="""WITH g AS (SELECT x, y, max(dn) AS dn FROM v_pix WHERE scene = 1 GROUP BY ALL)
    SELECT sample_id, dn, dn IS NULL AS outside FROM v_lab l LEFT JOIN g ON g.x = sample_id % 100 AND g.y = (sample_id * 7) % 100""")
def i16_d19_point_sample(pix, lab):
    """The pixel under each sample; absent stays null and is told apart from 0."""
    g = pix.where("scene = 1").groupBy("x", "y").agg(F.max("dn").alias("dn"))
    s = lab.select("sample_id", (F.col("sample_id") % 100).alias("x"), ((F.col("sample_id") * 7) % 100).alias("y"))
    return s.join(g, ["x", "y"], "left").select("sample_id", "dn", F.col("dn").isNull().alias("outside"))


@query("v_pix", sql="""WITH a AS (SELECT x, y, avg(b12) AS a2, avg(b11) AS a1 FROM v_pix WHERE scene = 1 GROUP BY ALL), b AS (SELECT x,
    y, avg(b12) AS b2, avg(b11) AS b1 FROM v_pix WHERE scene = 2 GROUP BY ALL) SELECT count(*) AS n, round(corr(a2, b2), 6) AS r22,
    round(corr(a1, b1), 6) AS r11, round(sqrt(avg(pow(a2 - b2, 2))), 8) AS rmse, round(median(a2 - b2), 8) AS middle, round(avg((a2 = b2)::INT),
    8) AS identical FROM a JOIN b USING (x, y)""")
def i19_raster_compare(pix):
    """Two scenes over the pixels that both have."""
    one = pix.where("scene = 1").groupBy("x", "y").agg(F.avg("b12").alias("a2"), F.avg("b11").alias("a1"))
    two = pix.where("scene = 2").groupBy("x", "y").agg(F.avg("b12").alias("b2"), F.avg("b11").alias("b1"))
    d = F.col("a2") - F.col("b2")
    return one.join(two, ["x", "y"]).agg(F.count(F.lit(1)).alias("n"), F.round(F.corr("a2", "b2"), 6).alias("r22"), F.round(F.corr("a1", "b1"), 6).alias("r11"), F.round(F.sqrt(F.avg(d * d)), 8).alias("rmse"), F.round(F.median(d), 8).alias("middle"), F.round(F.avg((d == 0).cast("int")), 8).alias("identical"))


PATCHES = """WITH RECURSIVE g AS (SELECT DISTINCT scene, x, y, scene * 10000 + x * 100 + y AS id FROM v_pix WHERE dn > 1500), e AS (SELECT a.id AS a,
    b.id AS b FROM g a JOIN g b ON a.scene = b.scene AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1), w AS (SELECT id AS node,
    id AS root FROM g UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.node AND e.b > w.root), l AS (SELECT node, min(root) AS patch
    FROM w GROUP BY node) SELECT patch, count(*) AS pixels FROM l GROUP BY patch"""


@query("v_pix", sql=PATCHES)
def i17_patches(pix):
    """Patches of changed pixels of each scene that touch by side or corner."""
    return X.patches(pix.where("dn > 1500").select("scene", "x", "y").distinct(), 100)


#: Corners of the pixel grid by how many of the patch's pixels meet there; two that meet in a corner only have numbers that add up to 3.
OUTLINES = PATCHES[: PATCHES.index(" SELECT patch, count(*)")] + """, p AS (SELECT patch, x, y FROM l JOIN g ON g.id = l.node),
  k AS (SELECT patch, x + unnest([0, 1, 0, 1]) AS vx, y + unnest([0, 0, 1, 1]) AS vy, unnest([0, 1, 2, 3]) AS pos FROM p),
  v AS (SELECT patch, vx, vy, count(*) AS n, count(*) = 2 AND sum(pos) = 3 AS across FROM k GROUP BY ALL),
  c AS (SELECT patch, CAST(count(*) FILTER (WHERE n = 1) AS BIGINT) AS one, CAST(count(*) FILTER (WHERE n = 3) AS BIGINT) AS three, CAST(count(*) FILTER (WHERE across) AS BIGINT) AS two FROM v GROUP BY patch),
  s AS (SELECT a.patch, count(*) AS shared FROM p a JOIN p b ON a.patch = b.patch AND (a.x = b.x AND b.y = a.y + 1 OR a.y = b.y AND b.x = a.x + 1) GROUP BY a.patch),
  m AS (SELECT patch, count(*) AS pixels FROM p GROUP BY patch)
  SELECT patch, CAST(1 - (one - three - 2 * two) // 4 AS BIGINT) AS holes, CAST(pixels AS DOUBLE) AS area, one + three + 2 * two AS corners, CAST(4 * pixels - 2 * coalesce(shared, 0) AS BIGINT) AS joined
    FROM m JOIN c USING (patch) LEFT JOIN s USING (patch)"""


@query("v_pix", sql=OUTLINES)
def i17_outlines(pix):
    """Outlines of the patches with their holes, rings in order: their area is the pixels', and each edge ends where the next one of its ring begins."""
    p = outlines.patch_pixels(pix.where("dn > 1500").select("scene", "x", "y"), 100)
    scratch = Scratch(pix.sparkSession, "outlines")
    r = scratch.table(outlines.rings(outlines.pixel_edges(p, ["patch"]), ["patch"]), "rings")
    m = outlines.ring_measures(r, ["patch"])
    whole = m.groupBy("patch").agg(F.count_if(F.col("area") < 0).alias("holes"), F.sum("area").alias("area"), F.sum("corners").alias("corners"))
    after = r.join(m.select("ring", "edges"), "ring").select("ring", F.pmod(F.col("seq") - 1, F.col("edges")).alias("seq"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    joined = r.join(after, ["ring", "seq", "x2", "y2"]).groupBy("patch").agg(F.count(F.lit(1)).alias("joined"))
    return whole.join(joined, "patch").select("patch", "holes", "area", "corners", "joined")


SLOT = """s AS (SELECT scene AS event, CAST(row_number() OVER (PARTITION BY scene ORDER BY look_date) - 1 AS INTEGER) AS slot, CASE
    WHEN n < 2 THEN 'missing' WHEN top < 800 THEN 'obscured' WHEN top > 1900 THEN 'flagged' ELSE 'quiet' END AS state
    FROM (SELECT scene, look_date, count(*) AS n, max(dn) AS top FROM v_pix GROUP BY ALL))"""


def slots(pix):
    d = pix.groupBy("scene", "look_date").agg(F.count(F.lit(1)).alias("n"), F.max("dn").alias("top"))
    state = F.when(F.col("n") < 2, "missing").when(F.col("top") < 800, "obscured").when(F.col("top") > 1900, "flagged").otherwise("quiet")
    return d.select(F.col("scene").alias("event"), (F.row_number().over(Window.partitionBy("scene").orderBy("look_date")) - 1).alias("slot"), state.alias("state"))


@query("v_pix", sql=f"""WITH {SLOT}, f AS (SELECT event, min(slot) FILTER (WHERE state = 'flagged') AS first_flag, min_by(state, slot) AS opening,
    avg((state <> 'missing')::INT) AS present FROM s GROUP BY event),
  q AS (SELECT f.*, (SELECT max(slot) FROM s WHERE s.event = f.event AND slot < first_flag AND state = 'quiet') AS last_quiet
    FROM f)
  SELECT event, first_flag, last_quiet, first_flag - last_quiet AS gap, CASE WHEN present < 0.5 THEN 'too few slots'
    WHEN first_flag IS NULL THEN 'not resolved' WHEN opening = 'flagged' THEN 'flagged from the start' WHEN last_quiet IS NOT NULL THEN 'bracketed' ELSE 'no quiet slot' END AS reading
    FROM q""")
def f5_h27_onset_brackets(pix):
    """First flagged slot, the last quiet one before it, and the reading."""
    return X.onset_brackets(slots(pix))


@query("v_pix", sql=f"""WITH {SLOT} SELECT slot % 24 AS hour, count(*) FILTER (WHERE state = 'flagged') AS flagged, round(avg((state = 'obscured')::INT),
    8) AS obscured FROM s GROUP BY 1""")
def e29_e30_diurnal(pix):
    """By hour, flagged slots and the share of obscured ones."""
    return slots(pix).groupBy((F.col("slot") % 24).alias("hour")).agg(F.count_if(F.col("state") == "flagged").alias("flagged"), F.round(F.avg((F.col("state") == "obscured").cast("int")), 8).alias("obscured"))


@query("v_pix", sql="""SELECT scene, max_by(pixel_row, (least(dn - 500, CAST(b12 * 1000 AS INTEGER)), -pixel_row)) AS closest
    FROM v_pix WHERE worldcover <> 80 GROUP BY scene""")
def g8_closest_to_flag(pix):
    """The pixel whose weaker of two margins is the largest, the first of several."""
    w = F.least(F.col("dn") - 500, F.round(F.col("b12") * 1000).cast("int"))
    return pix.where("worldcover <> 80").groupBy("scene").agg(F.max_by("pixel_row", F.struct(w, -F.col("pixel_row"))).alias("closest"))


@query("v_pix", sql="""SELECT scene, count(*) FILTER (WHERE minute >= 1095 OR minute <= 300) AS night FROM (SELECT scene, (pixel_row * 37) % 1440 AS minute
    FROM v_pix) GROUP BY scene""")
def c17_night(pix):
    """C17: night by minutes of the day."""
    m = (F.col("pixel_row") * 37) % 1440
    return pix.groupBy("scene").agg(F.count_if((m >= 1095) | (m <= 300)).alias("night"))


@query("v_pix", sql="SELECT scene, pixel_row FROM v_pix WHERE (worldcover <> 80 AND dn > 1800 OR worldcover = 80 AND pixel_row % 97 = 0)")
def i5_slot_rows(pix):
    """What a slot keeps: flagged land, and a fixed sample of the sea (the sample is the product)."""
    return pix.where("((worldcover <> 80 and dn > 1800) or (worldcover = 80 and pixel_row % 97 = 0))").select("scene", "pixel_row")


LONG = " UNION ALL ".join(f"SELECT {STRATUM} AS stratum, '{k}' AS index_name, {v} AS v FROM v_pix" for k, v in INDEX.items())


@query("v_pix", sql=f"""WITH l AS (SELECT * FROM ({LONG}) WHERE stratum IS NOT NULL AND v IS NOT NULL), t AS (SELECT index_name, quantile_cont(v,
    0.95) AS limit_ FROM l WHERE stratum = 'adjacent' GROUP BY 1) SELECT stratum, index_name, count(*) AS n, round(quantile_cont(v,
    0.5), 7) + 0.0e0 AS p50, round(quantile_cont(v, 0.95), 7) + 0.0e0 AS p95, round(avg((v > limit_ + 1e-9)::INT), 7) AS above
    FROM l JOIN t USING (index_name) GROUP BY ALL""")
def n8_index_comparison(pix):
    """All indices at once: distribution by stratum, and the share above the 95th percentile of one stratum."""
    long = pix.select(stratum().alias("stratum"), F.explode(F.array(*[F.struct(F.lit(k).alias("index_name"), v.alias("v")) for k, v in indices(pix).items()])).alias("s")).select("stratum", "s.*")
    long = long.where("stratum is not null and v is not null")
    counts = Scratch(pix.sparkSession, "indices").table(long.groupBy("stratum", "index_name", "v").agg(F.count(F.lit(1)).alias("k")), "counts")
    q = Scratch(pix.sparkSession, "indices").table(statistics.counted_quantiles(counts, ["stratum", "index_name"], "v", "k", {"p50": 0.5, "p95": 0.95}), "quantiles")
    t = q.where("stratum = 'adjacent'").select("index_name", F.col("p95").alias("limit"))
    over = F.sum(F.when(F.col("v") > F.col("limit") + 1e-9, F.col("k")).otherwise(F.lit(0)))
    g = counts.join(t, "index_name").groupBy("stratum", "index_name").agg(F.sum("k").alias("n"), F.round(over / F.sum("k"), 7).alias("above")).join(q, ["stratum", "index_name"])
    return g.select("stratum", "index_name", "n", F.round("p50", 7).alias("p50"), F.round("p95", 7).alias("p95"), "above")


@query("v_pix", sql=f"""WITH {GRID}, m AS (SELECT a.scene, a.x, a.y, a.dn - median(b.dn) > 400 AND a.dn > 900 AS flagged
    FROM g a JOIN g b ON b.scene = a.scene AND abs(b.x - a.x) <= 3 AND abs(b.y - a.y) <= 3 AND (a.x <> b.x OR a.y <> b.y)
    WHERE a.x BETWEEN 3 AND 96 AND a.y BETWEEN 3 AND 96 GROUP BY a.scene, a.x, a.y, a.dn), l AS (SELECT scene, x, y, bool_and(worldcover <> 80) AS land
    FROM v_pix GROUP BY ALL) SELECT scene, count(*) AS pixels, count(*) FILTER (WHERE flagged) AS flagged, count(*) FILTER (WHERE flagged AND land) AS flagged_land
    FROM m JOIN l USING (scene, x, y) GROUP BY scene""")
def n9_evening_product(pix):
    """Flags of every scene and those on land."""
    f = X.window_median(grid(pix), "dn", half=3, size=100).withColumn("flagged", (F.col("dn") - F.col("background") > 400) & (F.col("dn") > 900))
    land = pix.groupBy("scene", "x", "y").agg(F.bool_and(F.col("worldcover") != 80).alias("land"))
    return f.join(land, ["scene", "x", "y"]).groupBy("scene").agg(F.count(F.lit(1)).alias("pixels"), F.count_if("flagged").alias("flagged"), F.count_if(F.col("flagged") & F.col("land")).alias("flagged_land"))
