"""Queries that put several operators together: tuning, footprints, late detections, burned area, onset summaries, exchange files."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pyrelith.functions import scalar as S
from pyrelith.operators import events as E
from pyrelith.operators import footprints, geo, ingest
from pyrelith.operators import rasters as X
from pyrelith.operators import stations
from pyrelith.plans.events import EPS_M, EPS_S, LABELS, OB, PLANE, RECORD
from pyrelith.plans.rasters import SLOT, slots
from pyrelith.plans.registry import query
from pyrelith.runtime import Scratch
from pyrelith.sources import files

# Summaries of onsets and events

READINGS = ("too few slots", "not resolved", "flagged from the start", "bracketed", "no quiet slot")
ONSETS = f"""{SLOT}, f AS (SELECT event, min(slot) FILTER (WHERE state = 'flagged') AS first_flag, min_by(state, slot) AS opening,
    avg((state <> 'missing')::INT) AS present FROM s GROUP BY event),
  q AS (SELECT f.*, (SELECT max(slot) FROM s WHERE s.event = f.event AND slot < first_flag AND state = 'quiet') AS last_quiet
    FROM f),
  o AS (SELECT event, first_flag, first_flag - last_quiet AS gap, CASE WHEN present < 0.5 THEN 'too few slots'
    WHEN first_flag IS NULL THEN 'not resolved' WHEN opening = 'flagged' THEN 'flagged from the start' WHEN last_quiet IS NOT NULL THEN 'bracketed' ELSE 'no quiet slot' END AS reading
    FROM q)"""


@query("v_pix", sql=f"""WITH {ONSETS}, h AS (SELECT first_flag % 24 AS hour FROM o WHERE first_flag IS NOT NULL AND reading NOT IN ('too few slots',
    'not resolved')), b AS (SELECT first_flag AS lead, gap FROM o WHERE reading = 'bracketed')
  SELECT 'reading' AS what, r AS item, CAST((SELECT count(*) FROM o WHERE reading = r) AS DOUBLE) AS value
    FROM (SELECT unnest({list(READINGS)!r}) AS r)
  UNION ALL SELECT 'hour', lpad(CAST(hour AS STRING), 2, '0'), CAST(count(*) AS DOUBLE) FROM h GROUP BY hour
  UNION ALL SELECT 'shared', 'first flag', CAST(coalesce(sum(n), 0) AS DOUBLE) FROM (SELECT count(*) AS n
    FROM o WHERE first_flag IS NOT NULL GROUP BY first_flag HAVING count(*) > 1)
  UNION ALL SELECT what, item, value FROM (SELECT median(gap) AS g1, min(gap) AS g2, max(gap) AS g3, median(lead) AS l1, min(lead) AS l2,
    max(lead) AS l3 FROM b),
    LATERAL (SELECT unnest(['gap', 'gap', 'gap', 'lead', 'lead', 'lead']) AS what, unnest(['median', 'min', 'max', 'median', 'min',
    'max']) AS item, CAST(unnest([g1, g2, g3, l1, l2, l3]) AS DOUBLE) AS value)""")
def e30_onset_summary(pix):
    """How often each reading comes, first flags by hour, events that share a first flagged slot, and the bracketed events' gaps and leads."""
    return X.onset_summary(X.onset_brackets(slots(pix)), READINGS, 24)


HIST_LABELS = LABELS.replace("v_det", "v_hist")


@query("v_hist", sql=f"""{HIST_LABELS}, ev AS (SELECT event, min(date_wit) AS first_seen, count(*) AS n FROM m JOIN v_hist USING (detection_id) GROUP BY event)
  SELECT CAST(year(first_seen) AS INTEGER) AS year, count(*) AS events, count(*) FILTER (WHERE n > 1) AS multi FROM ev GROUP BY 1""")
def e34_events_by_year(hist):
    """Events by the year in which they were first seen, and those of several detections."""
    e = hist.join(E.st_dbscan(hist, EPS_M, EPS_S), "detection_id").groupBy("event").agg(F.min("date_wit").alias("first_seen"), F.count(F.lit(1)).alias("n"))
    return e.groupBy(F.year("first_seen").alias("year")).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("n") > 1).alias("multi"))


@query("v_obs", sql=f"""WITH {OB}, d AS (SELECT *, to_timestamp(at_s + 32400) AT TIME ZONE 'UTC' AS ts FROM o)
  SELECT 'year' AS level, strftime(ts, '%Y') AS period, count(*) AS n, count(DISTINCT CASE WHEN fu THEN CAST(ts AS DATE) END) AS fu_days,
    count(DISTINCT CASE WHEN hz THEN CAST(ts AS DATE) END) AS hz_days, count(*) FILTER (WHERE fu) AS fu FROM d
    GROUP BY 2
  UNION ALL SELECT 'month', strftime(ts, '%Y-%m'), count(*), count(DISTINCT CASE WHEN fu THEN CAST(ts AS DATE) END), count(DISTINCT CASE
    WHEN hz THEN CAST(ts AS DATE) END), count(*) FILTER (WHERE fu) FROM d GROUP BY 2
  UNION ALL SELECT 'hour', lpad(CAST(h AS STRING), 2, '0'), count(d.obs_id), count(DISTINCT CASE WHEN fu THEN CAST(ts AS DATE) END),
    count(DISTINCT CASE WHEN hz THEN CAST(ts AS DATE) END), count(*) FILTER (WHERE fu) FROM range(0, 24) AS k(h)
    LEFT JOIN d ON hour(ts) = h GROUP BY 2""")
def e10_station_periods(obs):
    """Reports, days with smoke and days with haze by local year and month, and by every hour of the local day."""
    return stations.baseline(stations.parsed(obs), 9)


# Selections and footprints

KNOWN = (("week", "2024-01-05", "2024-01-11", None), ("around", None, None, (-1.19, 135.1, 9000.0)), ("both", "2024-01-05", None, (-1.3, 134.6, 20000.0)))
METRES = f"sqrt(pow((longitude - lon) * cos(radians(lat)), 2) + pow(latitude - lat, 2)) * {S.math.pi / 180 * S.EARTH_M!r}"


@query("v_det", sql=f"""WITH k AS (SELECT * FROM (VALUES ('week', DATE '2024-01-05', DATE '2024-01-11', NULL::DOUBLE, NULL::DOUBLE,
    NULL::DOUBLE), ('around', NULL, NULL, -1.19e0, 135.1e0, 9000e0), ('both', DATE '2024-01-05', NULL, -1.3e0, 134.6e0, 20000e0)) AS t(name,
    since, until, lat, lon, radius))
  SELECT name, detection_id FROM k JOIN v_det ON (since IS NULL OR date_wit >= since) AND (until IS NULL OR date_wit <= until) AND (radius IS NULL OR {METRES} <= radius)""")
def c6_known_events(det):
    """Detections of known events, by dates, by distance, or both."""
    out = None
    for name, since, until, circle in KNOWN:
        part = ingest.known_event(det, since, until, circle).select(F.lit(name).alias("name"), "detection_id")
        out = part if out is None else out.unionByName(part)
    return out


@query("v_det", sql=f"""{LABELS}, a AS (SELECT m.event, p.id, p.x, p.y, CAST(p.datetime_utc + INTERVAL 9 HOUR AS DATE) AS day
    FROM p JOIN m ON m.detection_id = p.id), fs AS (SELECT event, min(day) AS first_day, count(*) AS n FROM a
    GROUP BY event HAVING count(*) >= 2),
  h AS (SELECT DISTINCT fs.event, d.id, d.day FROM fs JOIN a USING (event) JOIN a d ON d.event <> fs.event AND d.day < first_day AND abs(d.x - a.x) <= {EPS_M} AND abs(d.y - a.y) <= {EPS_M} AND pow(d.x - a.x,
    2) + pow(d.y - a.y, 2) <= {EPS_M**2}),
  r AS (SELECT h.event, h.day, count(*) AS n, max(coalesce(frp, -1)) AS top FROM h JOIN p ON p.id = h.id GROUP BY ALL)
  SELECT fs.event, max(r.day) AS prior_day, CASE WHEN max_by(top, r.day) >= 0 THEN max_by(top, r.day) END AS prior_frp, coalesce(max_by(r.n,
    r.day), 0) AS prior_n FROM fs LEFT JOIN r ON r.event = fs.event GROUP BY fs.event""")
def d15_prior_in_footprint(det):
    """Of each event of several detections the latest day before it with a detection inside its circles that is no member, the strongest power then, and how many."""
    return footprints.latest_prior(det, E.st_dbscan(det, EPS_M, EPS_S), EPS_M)


@query("v_det", sql=f"""{LABELS}, c AS (SELECT m.event, p.x, p.y FROM p JOIN m ON m.detection_id = p.id), g AS (SELECT unnest(range(-16,
    17)) AS i), h AS (SELECT unnest(range(-16, 17)) AS j),
  u AS (SELECT DISTINCT event, floor(x / 25) + i AS px, floor(y / 25) + j AS py FROM c CROSS JOIN g CROSS
    JOIN h WHERE pow((floor(x / 25) + i + 0.5e0) * 25 - x, 2) + pow((floor(y / 25) + j + 0.5e0) * 25 - y, 2) <= {EPS_M**2})
  SELECT event, round(count(*) * 0.0625e0, 4) AS union_ha FROM u GROUP BY event""")
def j9_union_area(det):
    """Area of the union of the circles around an event's detections, by pixels of 25 m."""
    return footprints.union_areas(det, E.st_dbscan(det, EPS_M, EPS_S), EPS_M, 25.0).withColumn("union_ha", F.round("union_ha", 4))


@query("v_det", sql=f"""{LABELS}, c AS (SELECT DISTINCT m.event, p.x - min(p.x) OVER (PARTITION BY m.event) AS x, p.y - min(p.y) OVER (PARTITION BY m.event) AS y
    FROM p JOIN m ON m.detection_id = p.id),
  n AS (SELECT a.event, a.x, a.y, atan2(b.y - a.y, b.x - a.x) AS d, acos(sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) / {2 * EPS_M}e0) AS h
    FROM c a JOIN c b ON a.event = b.event AND (a.x <> b.x OR a.y <> b.y) AND pow(b.x - a.x, 2) + pow(b.y - a.y, 2) < {4 * EPS_M**2}e0),
  i AS (SELECT event, x, y, greatest(d - h, -pi()) AS a, least(d + h, pi()) AS b FROM n UNION ALL SELECT event, x, y, d - h + 2 * pi(), pi() FROM n WHERE d - h < -pi()
    UNION ALL SELECT event, x, y, -pi(), d + h - 2 * pi() FROM n WHERE d + h > pi() UNION ALL SELECT event, x, y, pi(), pi() FROM c),
  o AS (SELECT event, x, y, a, coalesce(max(b) OVER (PARTITION BY event, x, y ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -pi()) AS f FROM i)
  SELECT event, round(sum({EPS_M**2}e0 * (a - f) + {EPS_M}e0 * x * (sin(a) - sin(f)) - {EPS_M}e0 * y * (cos(a) - cos(f))) / 2e4, 4) AS union_ha FROM o WHERE a > f GROUP BY event""")
def j9_circle_union(det):
    """Exact area of the union of the circles around an event's detections, from the arcs that no other circle covers."""
    return footprints.circle_unions(det, E.st_dbscan(det, EPS_M, EPS_S), EPS_M).withColumn("union_ha", F.round("union_ha", 4))


SEGMENTS = ((0, 134.25, -1.39, 130, 14), (1, 134.2604, -1.1102, 130, 10))
CELLS = " UNION ALL ".join(f"""SELECT {k} AS segment, CAST(x AS INTEGER) AS px, CAST(y AS INTEGER) AS py, {x0!r}e0 + x * 0.0207e0 AS lon,
    {y0!r}e0 + y * 0.0207e0 AS lat FROM range(0, {nx}) AS a(x) CROSS JOIN range(0, {ny}) AS b(y)""" for k, x0, y0, nx, ny in SEGMENTS)


@query("v_det", sql=f"""WITH g AS ({CELLS}), d AS (SELECT DISTINCT satellite, date_wit, longitude, latitude FROM v_det), t AS (SELECT satellite,
    date_wit, min_by((segment, py, px), (pow(lon - longitude, 2) + pow(lat - latitude, 2), segment, py, px)) AS c
    FROM d CROSS JOIN g GROUP BY satellite, date_wit, longitude, latitude),
  u AS (SELECT DISTINCT satellite, date_wit, c[1] AS segment, c[2] AS py, c[3] AS px FROM t)
  SELECT satellite, date_wit, segment, count(*) AS pixels, string_agg(py || ':' || px, ' ' ORDER BY py, px) AS cells
    FROM u GROUP BY ALL""")
def d6_nearest_pixels(det):
    """Of each group's detections the nearest pixels over several segments, each once; found by arithmetic in each segment's grid."""
    return geo.nearest_pixels(det, ["satellite", "date_wit"], SEGMENTS, 0.0207)


# Late detections and boxes

BOXES = """SELECT DISTINCT stratum AS box, 134.25e0 + (length(stratum) * 7 + ascii(substr(stratum, length(stratum), 1))) % 50 * 0.05e0 + 0.0023e0 AS w,
    -1.39e0 + (ascii(substr(stratum, length(stratum), 1)) % 6) * 0.05e0 + 0.0013e0 AS s FROM v_lab"""
CHIPS = ("2024-01-10", "2024-01-25", "2024-02-28")
BAND = "CASE WHEN m IS NULL THEN NULL WHEN m <= 1e-9 THEN 'inside' WHEN m <= 375 THEN '<=375' WHEN m <= 750 THEN '<=750' WHEN m <= 1500 THEN '<=1500' ELSE '>1500' END"
DEGREE = "111320.0e0"


@query("v_lab", "v_det", sql=f"""WITH b AS (SELECT *, w + 0.0011e0 AS e, s + 0.0007e0 AS n FROM ({BOXES})), c AS (SELECT unnest([{", ".join(f"DATE '{c}'" for c in CHIPS)}]) AS chip),
  d AS (SELECT box, chip, detection_id, date_wit, frp, sqrt(pow(greatest(w - longitude, longitude - e, 0) * {DEGREE} * cos(radians((s + n) / 2)),
    2) + pow(greatest(s - latitude, latitude - n, 0) * {DEGREE}, 2)) AS m FROM b CROSS JOIN c JOIN v_det ON date_wit > chip),
  t AS (SELECT b.box, c.chip, min(d.m) AS m, min_by((d.date_wit, d.frp), (d.m, DATE '2100-01-01' - d.date_wit, d.detection_id)) AS near,
    max(d.date_wit) FILTER (WHERE d.m <= 375) AS last_day, count(*) FILTER (WHERE d.m <= 375) AS late FROM b
    CROSS JOIN c LEFT JOIN d ON d.box = b.box AND d.chip = c.chip GROUP BY ALL)
  SELECT box, chip, round(m, 2) AS metres, {BAND} AS band, near[1] AS near_day, near[2] AS near_frp, last_day, late
    FROM t""")
def d16_late_detections(lab, det):
    """For each box and each chip's date the nearest later detection on both axes, its band, day and power, and the last one within 375 m."""
    x = 134.25 + (F.length("stratum") * 7 + F.ascii(F.substring("stratum", -1, 1))) % 50 * 0.05 + 0.0023
    y = -1.39 + (F.ascii(F.substring("stratum", -1, 1)) % 6) * 0.05 + 0.0013
    b = lab.select(F.col("stratum").alias("box"), x.alias("w"), y.alias("s")).distinct().withColumn("e", F.col("w") + 0.0011).withColumn("n", F.col("s") + 0.0007)
    chips = F.array(*[F.lit(c).cast("date") for c in CHIPS])
    return footprints.late_detections(b.withColumn("chip", F.explode(chips)), det).withColumn("metres", F.round("metres", 2))


@query("v_adm", sql="""WITH g AS (SELECT adm_id, (notched) AS cut, w, s, e, n, w + 0.02e0 AS w2, s + 0.004e0 AS s2, e + 0.02e0 AS e2,
    n + 0.004e0 AS n2 FROM v_adm),
  p AS (SELECT g.*, w - 0.01e0 + (i + 0.5e0) * 0.0037e0 AS x, s - 0.01e0 + (j + 0.5e0) * 0.0011e0 AS y FROM g
    CROSS JOIN range(0, 140) AS a(i) CROSS JOIN range(0, 70) AS b(j)),
  m AS (SELECT adm_id, x BETWEEN w AND e AND y BETWEEN s AND n AND NOT (cut AND x > (w + e) / 2 AND y > (s + n) / 2) AS one, x BETWEEN w2 AND e2 AND y BETWEEN s2 AND n2 AS two
    FROM p),
  c AS (SELECT adm_id, count(*) FILTER (WHERE one) AS a, count(*) FILTER (WHERE two) AS b, count(*) FILTER (WHERE one AND two) AS shared
    FROM m GROUP BY adm_id)
  SELECT adm_id, a, b, shared, round(shared / (a + b - shared), 8) AS iou, round(a / b, 8) AS plain, CASE
    WHEN shared / (a + b - shared) - a / b > 0.01 THEN 'above' WHEN shared / (a + b - shared) - a / b < -0.01 THEN 'below' ELSE 'ties' END AS verdict
    FROM c""")
def i18_rasterised_overlap(adm):
    """Two shapes painted on one grid: their overlap, and whether it beats the plain ratio of their areas by more than the grid's error."""
    ring = geo.rectangle_ring(*[F.col(c) for c in ("w", "s", "e", "n", "notched")])
    moved = geo.rectangle_ring(F.col("w") + 0.02, F.col("s") + 0.004, F.col("e") + 0.02, F.col("n") + 0.004, F.lit(False))
    shapes = adm.select("adm_id", ring.alias("one"), moved.alias("two"), (F.col("w") - 0.01).alias("x0"), (F.col("s") - 0.01).alias("y0"))
    return geo.painted_overlap(shapes, "adm_id", (0.0037, 0.0011), (140, 70), 0.01)


TILES = """SELECT n_nationkey AS desa, n_nationkey // 2 AS distrik, r_name AS kabupaten, n_nationkey % 5 AS i, n_nationkey // 5 AS j
    FROM nation JOIN region ON n_regionkey = r_regionkey"""


@query("nation", "region", sql=f"""WITH t AS ({TILES}), e AS (SELECT desa, distrik, kabupaten, unnest([(i, j, i + 1, j), (i + 1, j,
    i + 1, j + 1), (i, j + 1, i + 1, j + 1), (i, j, i, j + 1)]) AS edge FROM t),
  l AS (SELECT edge, count(*) AS uses, count(DISTINCT kabupaten) AS k, count(DISTINCT distrik) AS d FROM e
    GROUP BY edge), v AS (SELECT CASE WHEN uses = 1 OR k > 1 THEN 'kabupaten' WHEN d > 1 THEN 'distrik' ELSE 'desa' END AS level,
    uses FROM l)
  SELECT level, count(*) AS edges, CAST(sum(uses) AS BIGINT) AS sides FROM v GROUP BY level""")
def j12_boundary_lines(nation, region):
    """Each shared edge once, at the highest level that it bounds: what is left of a level once those above are subtracted."""
    return geo.boundary_levels(tiles(nation, region), ["kabupaten", "distrik", "desa"]).groupBy("level").agg(F.count(F.lit(1)).alias("edges"), F.sum("uses").alias("sides"))


@query("nation", "region", sql=f"""WITH t AS ({TILES}), e AS (SELECT kabupaten, unnest([(i, j, i + 1, j), (i + 1, j, i + 1, j + 1),
    (i, j + 1, i + 1, j + 1), (i, j, i, j + 1)]) AS edge FROM t),
  o AS (SELECT kabupaten, edge FROM e GROUP BY ALL HAVING count(*) = 1), a AS (SELECT kabupaten, count(*) AS area
    FROM t GROUP BY kabupaten) SELECT a.kabupaten, CAST(any_value(area) AS DOUBLE) AS area, CAST(count(*) AS DOUBLE) AS outline
    FROM a JOIN o USING (kabupaten) GROUP BY a.kabupaten""")
def j12_dissolved(nation, region):
    """Shapes of one name made one: its area, and the length of the edges that no two of its parts share."""
    return geo.dissolved(tiles(nation, region), "kabupaten")


def tiles(nation, region):
    t = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    i, j = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)
    ring = geo.rectangle_ring(*[x.cast("double") for x in (i, j, i + 1, j + 1)], F.lit(False))
    return t.select(F.col("n_nationkey").alias("desa"), F.floor(F.col("n_nationkey") / 2).alias("distrik"), F.col("r_name").alias("kabupaten"), ring.alias("ring"))


# Tuning

GRID = ((250.0, 10_800), (375.0, 21_600), (375.0, 86_400))


def tuned(m: float, s: int) -> str:
    labels = LABELS.replace(f"<= {EPS_S}", f"<= {s}").replace(f"<= {EPS_M**2}", f"<= {m * m}").replace(f"<= {EPS_M})", f"<= {m})")
    return f"""({labels}, a AS (SELECT m.event, p.* FROM p JOIN m ON m.detection_id = p.id), g AS (SELECT event, count(*) AS n, (epoch(max(datetime_utc)) - epoch(min(datetime_utc))) / 3600 AS hours,
    greatest(max(x) - min(x), max(y) - min(y)) / 1000 AS km, min(CAST(datetime_utc + INTERVAL 9 HOUR AS DATE)) AS first_day, max(CAST(datetime_utc + INTERVAL 9 HOUR AS DATE)) AS last_day
    FROM a GROUP BY event),
    k AS (SELECT * FROM (VALUES ('week', DATE '2024-01-05', DATE '2024-01-11', NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE), ('around',
    NULL, NULL, -1.19e0, 135.1e0, 9000e0), ('both', DATE '2024-01-05', NULL, -1.3e0, 134.6e0, 20000e0)) AS t(name, since, until,
    lat, lon, radius)),
    z AS (SELECT name, event FROM k JOIN a ON (since IS NULL OR CAST(datetime_utc + INTERVAL 9 HOUR AS DATE) >= since) AND (until IS NULL OR CAST(datetime_utc + INTERVAL 9 HOUR AS DATE) <= until) AND (radius IS NULL OR {METRES} <= radius)),
    y AS (SELECT name, CAST(sum(c) AS BIGINT) AS detections, count(*) AS events, max_by(event, (n, -event)) AS top
    FROM (SELECT name, event, count(*) AS c FROM z GROUP BY ALL) JOIN g USING (event) GROUP BY name)
    SELECT {m!r}e0 AS eps_m, {s}::BIGINT AS eps_s, 'all' AS name, (SELECT count(*) FROM p) AS detections, (SELECT count(*)
    FROM g) AS events, (SELECT count(*) FROM g WHERE n = 1) AS singletons, n AS largest, round(hours, 4) AS hours, round(km, 4) AS extent_km,
    first_day, last_day FROM (SELECT * FROM g ORDER BY n DESC, event LIMIT 1)
    UNION ALL SELECT {m!r}e0, {s}::BIGINT, name, detections, events, NULL, g.n, round(hours, 4), round(km, 4), first_day, last_day
    FROM y JOIN g ON g.event = y.top)"""


@query("v_det", sql="SELECT * FROM (" + " UNION ALL ".join(f"SELECT * FROM {tuned(*g)}" for g in GRID) + ")")
def j17_tuning(det):
    """For each setting events, singletons, the largest event's size, hours and extent, and the same of known events, from one join at the widest."""
    known = [(name, ingest.known_event(det, since, until, circle).select("detection_id")) for name, since, until, circle in KNOWN]
    t = E.tune(det, GRID, known)
    return t.withColumn("hours", F.round("hours", 4)).withColumn("extent_km", F.round("extent_km", 4))


# Rasters

BANDS = ("b2", "b3", "b4", "b6", "b7", "b8a", "b11", "b12")
PAIR = f"""WITH g AS (SELECT scene, x, y, {', '.join(f'avg({b}) AS {b}' for b in BANDS)} FROM v_pix GROUP BY ALL), j AS (SELECT a.scene AS ref,
    b.scene AS cand, a.x, a.y, {', '.join(f'a.{b} AS r_{b}, b.{b} AS c_{b}' for b in BANDS)} FROM g a JOIN g b ON a.x = b.x AND a.y = b.y AND a.scene < b.scene)"""
PER_BAND = " UNION ALL ".join(f"""SELECT ref, cand, '{b}' AS band, count(*) AS n, round(median(r_{b}), 6) AS ref_median, round(median(c_{b}),
    6) AS cand_median, round(median(c_{b} - r_{b}), 6) AS middle, round(sqrt(avg(pow(c_{b} - r_{b}, 2))), 7) AS rmse, round(100 * sqrt(avg(pow(c_{b} - r_{b},
    2))) / greatest(quantile_cont(r_{b}, 0.98) - quantile_cont(r_{b}, 0.02), 1e-9), 4) AS rmse_pct, round(100 * avg((abs(c_{b} - r_{b}) < 1e-9)::INT),
    4) AS identical_pct, corr(c_{b}, r_{b}) AS same_r, greatest({', '.join(f'corr(c_{b}, r_{o})' for o in BANDS)}) AS best_r, min(x) AS x0,
    max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM j GROUP BY ref, cand""" for b in BANDS)


@query("v_pix", sql=f"""{PAIR}, t AS ({PER_BAND}) SELECT * EXCLUDE (best_r, same_r), round(best_r, 6) AS best_r, round(same_r, 6) AS same_r,
    round(best_r - same_r, 6) + 0.0e0 AS margin, best_r - same_r > 0.02 AS decisive FROM t""")
def i19_scene_compare(pix):
    """Every pair of scenes over the pixels that both have, by band: medians, error, identical share, the best matching band's margin, and the common box."""
    t = X.compare_scenes(pix, BANDS, 0.02)
    return t.select("ref", "cand", "band", "n", *[F.round(c, 6).alias(c) for c in ("ref_median", "cand_median", "middle", "same_r", "best_r")], F.round("rmse", 7).alias("rmse"), *[F.round(c, 4).alias(c) for c in ("rmse_pct", "identical_pct")], F.round(F.col("best_r") - F.col("same_r"), 6).alias("margin"), "decisive", "x0", "x1", "y0", "y1")


DAY = "DATE '1998-06-01'"
BURN = f"""WITH RECURSIVE k AS (SELECT x, y, x // 25 * 4 + y // 25 AS tile, max_by(dn, (look_date, pixel_row)) FILTER (WHERE look_date < {DAY} AND valid) AS pre,
    min_by(dn, (look_date, pixel_row)) FILTER (WHERE look_date > {DAY} AND valid) AS post, {DAY} - max(look_date) FILTER (WHERE look_date < {DAY} AND valid) AS lag,
    max(dn) > 1980 AS member, bool_and(worldcover <> 80) AS land, min(worldcover) AS cls FROM v_pix GROUP BY x, y),
  t AS (SELECT *, post - pre AS d, EXISTS (SELECT 1 FROM k q WHERE q.member AND q.tile = k.tile AND pow(q.x - k.x, 2) + pow(q.y - k.y,
    2) <= 16) AS inside FROM k),
  r AS (SELECT tile, count(*) AS ring, CASE WHEN count(*) >= 50 THEN quantile_cont(d, 0.95) END AS limit_
    FROM t WHERE NOT inside AND land AND d IS NOT NULL GROUP BY tile),
  f AS (SELECT t.*, r.ring, r.limit_, land AND d IS NOT NULL AS clear, land AND d > limit_ AS changed FROM t
    JOIN r USING (tile) WHERE inside),
  g AS (SELECT DISTINCT tile, x, y, tile * 10000 + x * 100 + y AS id FROM f WHERE changed), e AS (SELECT a.id AS a, b.id AS b
    FROM g a JOIN g b ON a.tile = b.tile AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1), w AS (SELECT id AS node, id AS root
    FROM g UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.node AND e.b > w.root), l AS (SELECT node, min(root) AS patch
    FROM w GROUP BY node), n AS (SELECT patch // 10000 AS tile, count(DISTINCT patch) AS patches FROM l GROUP BY 1),
  c AS (SELECT tile, string_agg(cls || ':' || clear_px || ':' || changed_px, ' ' ORDER BY cls) AS by_class
    FROM (SELECT tile, cls, count(*) FILTER (WHERE clear) AS clear_px, count(*) FILTER (WHERE changed) AS changed_px
    FROM f WHERE land GROUP BY ALL) GROUP BY tile)
  SELECT tile, any_value(ring) AS ring, round(any_value(limit_), 6) AS threshold, CASE WHEN any_value(limit_) IS NULL THEN 'no local reference' ELSE 'assessed' END AS status,
    round(count(*) FILTER (WHERE land) * 0.04e0, 4) AS footprint_ha, round(count(*) FILTER (WHERE clear) * 0.04e0, 4) AS clear_ha,
    round(count(*) FILTER (WHERE changed) * 0.04e0, 4) AS changed_ha,
    round((count(*) FILTER (WHERE changed) + count(*) FILTER (WHERE land) - count(*) FILTER (WHERE clear)) * 0.04e0, 4) AS upper_ha,
    round(quantile_cont(lag, 0.5) FILTER (WHERE clear), 4) AS lag_p50, round(quantile_cont(lag, 0.9) FILTER (WHERE clear), 4) AS lag_p90,
    any_value(by_class) AS by_class, coalesce(any_value(patches), 0) AS patches FROM f LEFT JOIN c USING (tile)
    LEFT JOIN n USING (tile) GROUP BY tile"""


@query("v_pix", sql=BURN)
def n7_burned_area(pix):
    """Of each tile the pixels near its strongest ones, the change between the nearest looks, a threshold from the land around, areas by class, lags and patches."""
    return X.burned_area(pix, "1998-06-01", member_dn=1980, reach=4, quantile=0.95, least_ring=50)


@query("v_pix", "v_lab", sql="""WITH g AS (SELECT scene, x, y, max(dn) AS dn FROM v_pix GROUP BY ALL), s AS (SELECT DISTINCT scene
    FROM v_pix) SELECT s.scene, sample_id, g.dn, g.dn IS NULL AS outside FROM v_lab l CROSS JOIN s LEFT JOIN g ON g.scene = s.scene AND g.x = sample_id % 100 AND g.y = (sample_id * 7) % 100""")
def i16_samples_of_scenes(pix, lab):
    """The pixel of every scene under each sample; absent stays null and is told apart from 0."""
    g = pix.groupBy("scene", "x", "y").agg(F.max("dn").alias("dn"))
    s = lab.select("sample_id", (F.col("sample_id") % 100).alias("x"), ((F.col("sample_id") * 7) % 100).alias("y")).crossJoin(pix.select("scene").distinct())
    return s.join(g, ["scene", "x", "y"], "left").select("scene", "sample_id", "dn", F.col("dn").isNull().alias("outside"))


# Files that are written and read back

EVENT_COLUMNS = "event bigint, n_detections bigint, n_overpasses bigint, satellites string, frp_max double, n_frp_missing bigint"


@query("v_det", sql=f"""{LABELS} SELECT m.event, n_detections, n_overpasses, satellites, frp_max, n_frp_missing
    FROM (SELECT event, {RECORD} FROM m JOIN v_det USING (detection_id) GROUP BY event) m""")
def b6_event_csv(det):
    """Events as CSV with a header, satellites joined, written and read back."""
    rec = E.event_records(det.join(E.st_dbscan(det, EPS_M, EPS_S), "detection_id"))
    path = Scratch(det.sparkSession, "event-csv").path("events")
    rec.select(*[c.split()[0] for c in EVENT_COLUMNS.split(", ")]).write.csv(path, header=True)
    return det.sparkSession.read.csv(path, header=True, schema=EVENT_COLUMNS)


@query("v_det", sql="""SELECT detection_id, printf('<wpt lat="%.6f" lon="%.6f"><name>T%d</name><desc>%s</desc></wpt>', latitude, longitude,
    detection_id, satellite || ' &amp; ' || instrument) AS wpt, printf('https://www.google.com/maps/search/?api=1&query=%.6f,%.6f',
    latitude, longitude) AS url FROM v_det""")
def b10_gpx_waypoints(det):
    """Waypoints of a GPX file, texts escaped, and a link to each."""
    about = F.concat("satellite", F.lit(" & "), "instrument")
    return det.select("detection_id", ingest.gpx_waypoint(F.col("latitude"), F.col("longitude"), F.concat(F.lit("T"), F.col("detection_id").cast("string")), about).alias("wpt"), ingest.map_link(F.col("latitude"), F.col("longitude")).alias("url"))


@query("v_pix", sql="""WITH g AS (SELECT scene, x, y, CAST(max(dn) AS INTEGER) AS dn FROM v_pix GROUP BY ALL)
    SELECT CAST(s.scene AS INTEGER) AS band, CAST(y + 1 AS INTEGER) AS line, CAST(x + 1 AS INTEGER) AS col, dn AS count
    FROM (SELECT DISTINCT scene FROM v_pix) s CROSS JOIN range(0, 100) AS a(x) CROSS JOIN range(0, 100) AS b(y)
    LEFT JOIN g USING (scene, x, y)""")
def a11_satellite_segments(pix):
    """Each scene packed as a binary segment and decoded again; what has no pixel is a null count."""
    g = pix.groupBy("scene", "x", "y").agg(F.max("dn").alias("dn")).groupBy("scene").agg(F.collect_list(F.struct("x", "y", "dn")).alias("cells"))

    @F.pandas_udf("binary")
    def packed(scenes: pd.Series, cells: pd.Series) -> pd.Series:
        out = []
        for scene, rows in zip(scenes, cells, strict=True):
            grid = np.full((100, 100), 65535, dtype="<u2")
            for r in rows:
                grid[r["y"], r["x"]] = r["dn"]
            out.append(files.segment_bytes(grid, int(scene)))
        return pd.Series(out)

    blobs = g.select(F.col("scene").cast("string").alias("path"), packed("scene", "cells").alias("content"))
    return files.decode_segments(blobs).select("band", "line", "col", "count")


@query("v_det", sql="SELECT detection_id, longitude AS x, latitude AS y FROM v_det")
def a13_a14_point_blobs(det):
    """Positions as GeoPackage blobs, every second one in the other byte order, and decoded again."""

    @F.pandas_udf("binary")
    def blob(key: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        head = b"GP\x00\x00" + struct.pack("<i", 4326)
        return pd.Series([head + bytes([k % 2]) + struct.pack("<I2d" if k % 2 else ">I2d", 1, a, b) for k, a, b in zip(key, x, y, strict=True)])

    return files.gpkg_points(det.select("detection_id", blob("detection_id", "longitude", "latitude").alias("geom"))).select("detection_id", "x", "y")


@query("v_adm", sql="""SELECT a.adm_id, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y FROM v_adm a, LATERAL (SELECT unnest(range(CAST(floor((w + 180) / 360 * 4096) AS BIGINT),
    CAST(floor((e + 180) / 360 * 4096) AS BIGINT) + 1)) AS x) i, LATERAL (SELECT unnest(range(2060, 2063)) AS y) j""")
def m2_tiles_for(adm):
    """M, H30: the web tiles of each box, by a table function."""
    from pyrelith.functions.tables import register

    register(adm.sparkSession)
    x = [F.floor((F.col(c) + 180) / 360 * 4096).cast("int").alias(f"x_{c}") for c in ("w", "e")]
    return adm.sparkSession.sql("SELECT adm_id, t.x, t.y FROM {b}, LATERAL tiles_for(x_w, 2060, x_e, 2062) AS t", b=adm.select("adm_id", *x))
