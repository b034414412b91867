"""Queries of event building, spatial joins and corroboration (survey sections D, E3-E6, E10-E12, F, J)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions import scalar as S
from pyrelith.operators import events as E
from pyrelith.operators import geo, nearest, recurrence, stations
from pyrelith.plans.ingest import with_ring
from pyrelith.plans.registry import query
from pyrelith.runtime import Scratch

EPS_M, EPS_S = 375.0, 6 * 3600
PLANE = """p AS (SELECT detection_id AS id, datetime_utc, frp, satellite, latitude, longitude, longitude * (cos(radians((SELECT avg(latitude)
    FROM v_det))) * 111320) AS x, latitude * 111320 AS y, CAST(floor(epoch(datetime_utc)) AS BIGINT) AS t FROM v_det)"""
PAIRS = f"""{PLANE}, pr AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id < b.id AND abs(a.t - b.t) <= {EPS_S} AND pow(a.x - b.x,
    2) + pow(a.y - b.y, 2) <= {EPS_M**2} AND abs(a.x - b.x) <= {EPS_M})"""
LABELS = f"""WITH RECURSIVE {PAIRS}, e AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr), w AS (SELECT id AS node, id AS root
    FROM p UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.node AND e.b > w.root), l AS (SELECT node, min(root) AS comp
    FROM w GROUP BY node), f AS (SELECT l.comp, min_by(p.id, (p.datetime_utc, p.id)) AS event FROM l JOIN p ON p.id = l.node
    GROUP BY l.comp), m AS (SELECT l.node AS detection_id, f.event FROM l JOIN f USING (comp))"""


@query("v_det", sql=f"WITH {PAIRS} SELECT count(*) AS pairs, CAST(sum(a) AS BIGINT) AS sum_a, CAST(sum(b) AS BIGINT) AS sum_b FROM pr")
def d2_space_time_pairs(det):
    """Neighbours in space and time."""
    p = geo.space_time_pairs(det, EPS_M, EPS_S)
    return p.agg(F.count(F.lit(1)).alias("pairs"), F.sum("a").alias("sum_a"), F.sum("b").alias("sum_b"))


@query("v_det", sql=f"{LABELS} SELECT detection_id, event FROM m")
def j1_st_dbscan(det):
    """With two samples, the components of the neighbour pairs."""
    return E.st_dbscan(det, EPS_M, EPS_S)


@query("v_det", sql=f"""WITH {PAIRS}, e AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr), c AS (SELECT a AS id
    FROM e GROUP BY a HAVING count(*) + 1 >= 4)
  SELECT (SELECT count(*) FROM c) AS core, (SELECT count(DISTINCT e.a) FROM e JOIN c ON c.id = e.b WHERE e.a NOT IN (SELECT id
    FROM c)) AS border, (SELECT count(*) FROM p) AS points""")
def j1_core_border(det):
    """J1 with four samples: how many points are core and how many are taken in by one."""
    pairs = Scratch(det.sparkSession, "pairs").table(geo.space_time_pairs(det, EPS_M, EPS_S).select("a", "b"), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    core = both.groupBy("a").count().where("count + 1 >= 4").select(F.col("a").alias("id"))
    border = both.join(core, both["b"] == core["id"], "left_semi").join(core, both["a"] == core["id"], "left_anti").agg(F.countDistinct("a").alias("border"))
    return core.agg(F.count(F.lit(1)).alias("core")).join(F.broadcast(border)).join(F.broadcast(det.agg(F.count(F.lit(1)).alias("points"))))


RECORD = """count(*) AS n_detections, count(DISTINCT datetime_utc) AS n_overpasses, string_agg(DISTINCT satellite, '+' ORDER BY satellite) AS satellites, round(coalesce(sum(frp), 0), 4) AS frp_sum, max(frp) AS frp_max,
  count(*) FILTER (WHERE frp IS NULL) AS n_frp_missing, round(avg(latitude), 6) AS centroid_lat, round(avg(longitude), 6) AS centroid_lon, CAST(epoch(date_trunc('second', min(datetime_utc))) AS BIGINT) AS first_at, CAST(epoch(date_trunc('second', max(datetime_utc))) AS BIGINT) AS last_at"""


@query("v_det", sql=f"""{LABELS}, r AS (SELECT event, min(datetime_utc) AS first_seen, {RECORD} FROM m JOIN v_det USING (detection_id) GROUP BY event)
  SELECT printf('E%04d', row_number() OVER (ORDER BY first_seen, event)) AS event_id, * EXCLUDE (first_seen) FROM r""")
def e3_j2_f7_event_records(det):
    """Numbered event records."""
    members = det.join(E.st_dbscan(det, EPS_M, EPS_S), "detection_id")
    rec = E.number_events(E.event_records(members))
    four = [F.round("frp_sum", 4).alias("frp_sum"), *[F.round(c, 6).alias(c) for c in ("centroid_lat", "centroid_lon")]]
    at = [F.unix_seconds(F.col(c).cast("timestamp")).alias(n) for c, n in (("first_seen", "first_at"), ("last_seen", "last_at"))]
    return rec.select("event_id", "event", "n_detections", "n_overpasses", "satellites", "frp_max", "n_frp_missing", *four, *at)


@query("v_det", sql=f"""{LABELS}, x AS (SELECT event, datetime_utc, latitude, min(datetime_utc) OVER (PARTITION BY event) AS t0
    FROM m JOIN v_det USING (detection_id)) SELECT event, round(avg(latitude), 6) AS first_lat FROM x WHERE datetime_utc = t0
    GROUP BY event""")
def f10_first_position(det):
    """position at the first overpass."""
    return E.event_records(det.join(E.st_dbscan(det, EPS_M, EPS_S), "detection_id")).select("event", F.round("first_lat", 6).alias("first_lat"))


OLD = LABELS.replace("v_det", "v_old")
STABLE = f"""WITH RECURSIVE v_old AS (SELECT * FROM v_det WHERE date_wit < DATE '2024-01-25'), old AS ({OLD} SELECT detection_id, event
    FROM m),
  first AS (SELECT event, min(datetime_utc) AS t0 FROM old JOIN v_old USING (detection_id) GROUP BY event),
  named AS (SELECT event, printf('E%04d', row_number() OVER (ORDER BY t0, event)) AS event_id FROM first),
  prior AS (SELECT detection_id, event_id FROM old JOIN named USING (event)),
  now AS ({LABELS} SELECT detection_id, event FROM m),
  size AS (SELECT event, min(detection_id) AS seed FROM now GROUP BY event),
  lap AS (SELECT event, event_id, count(*) AS n FROM now JOIN prior USING (detection_id) GROUP BY ALL),
  claim AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY n DESC, event_id) AS r FROM lap),
  kept AS (SELECT event, max(event_id) FILTER (WHERE r = 1) AS event_id, coalesce(string_agg(event_id, '+'
    ORDER BY event_id) FILTER (WHERE r > 1), '') AS merged FROM claim GROUP BY event),
  fresh AS (SELECT event, printf('E%04d', 8999 + row_number() OVER (ORDER BY seed)) AS event_id, '' AS merged
    FROM size WHERE event NOT IN (SELECT event FROM kept))
  SELECT event, event_id, merged FROM kept UNION ALL SELECT event, event_id, merged FROM fresh"""


@query("v_det", sql=STABLE)
def j3_stable_ids(det):
    """Identifiers carried from an earlier run (all but the last days) to the whole store.

    Rows that are added only let events grow and join, so each earlier event lies in one event; its twin relies on that, the operator doesn't.
    """
    old = det.where("date_wit < DATE'2024-01-25'")
    before = Scratch(det.sparkSession, "earlier-run").table(E.st_dbscan(old, EPS_M, EPS_S), "events")
    first = E.number_events(E.event_records(old.join(before, "detection_id")).select("event", "first_seen")).select("event", "event_id")
    return E.stable_ids(E.st_dbscan(det, EPS_M, EPS_S), before.join(first, "event").select("detection_id", "event_id"), 9000)


@query("v_det", sql="""WITH g AS (SELECT 250.0e0 AS m, 10800 AS s UNION ALL SELECT 375.0e0, 21600), p AS (SELECT detection_id AS id,
    longitude * (cos(radians((SELECT avg(latitude) FROM v_det))) * 111320) AS x, latitude * 111320 AS y, CAST(floor(epoch(datetime_utc)) AS BIGINT) AS t
    FROM v_det)
  SELECT CAST(m AS DOUBLE) AS eps_m, CAST(s AS BIGINT) AS eps_s, count(*) AS pairs FROM g JOIN p a ON true
    JOIN p b ON a.id < b.id AND abs(a.t - b.t) <= s AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= m * m AND abs(a.x - b.x) <= m
    GROUP BY ALL""")
def j17_parameter_grid(det):
    """Neighbours under several settings from one join at the widest."""
    pairs = geo.space_time_pairs(det, 375.0, 21_600)
    grid = F.array(*[F.struct(F.lit(m).alias("eps_m"), F.lit(s).cast("long").alias("eps_s")) for m, s in ((250.0, 10_800), (375.0, 21_600))])
    hit = pairs.withColumn("g", F.explode(F.filter(grid, lambda g: (F.col("metres") <= g["eps_m"]) & (F.col("seconds") <= g["eps_s"]))))
    return hit.groupBy("g.eps_m", "g.eps_s").agg(F.count(F.lit(1)).alias("pairs"))


@query("v_det", sql="""WITH c AS (SELECT longitude, satellite, count(*) AS n FROM v_det GROUP BY longitude, satellite)
    SELECT longitude, min_by(satellite, (-n, satellite)) AS mode FROM c GROUP BY longitude""")
def e4_mode(det):
    """The most frequent value, the smallest of several."""
    n = det.groupBy("longitude", "satellite").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("longitude").agg(F.min(F.struct(-F.col("n"), "satellite"))["satellite"].alias("mode"))


SITE = "longitude, latitude"


@query("v_hist", sql=f"""SELECT round(longitude, 4) AS lon, round(latitude, 4) AS lat, count(*) AS n, count(DISTINCT date_wit) AS days,
    max(date_wit) - min(date_wit) AS span, min(date_wit) AS first_day, max(date_wit) AS last_day FROM v_hist
    GROUP BY {SITE}""")
def e5_site_stats(hist):
    """E5."""
    return recurrence.site_stats(hist, "longitude", "latitude").select(F.round("longitude", 4).alias("lon"), F.round("latitude", 4).alias("lat"), "n", "days", "span", "first_day", "last_day")


@query("v_hist", sql=f"""WITH s AS (SELECT {SITE}, count(DISTINCT date_wit) >= 10 AND max(date_wit) - min(date_wit) >= 90 AS rec
    FROM v_hist GROUP BY {SITE}), h AS (SELECT max(date_wit) - min(date_wit) >= 365 AS long FROM v_hist) SELECT detection_id, CASE
    WHEN long THEN rec ELSE false END AS recurrent FROM v_hist JOIN s USING ({SITE}) CROSS JOIN h""")
def j5_recurrence_flags(hist):
    """A flag on every row, none dropped; nothing is flagged on a short history."""
    return recurrence.flags(hist, ["longitude", "latitude"]).select("detection_id", "recurrent")


@query("v_hist", sql=f"""WITH s AS (SELECT {SITE}, count(DISTINCT date_wit) AS days FROM v_hist GROUP BY {SITE})
    SELECT round(longitude, 4) AS lon, round(latitude, 4) AS lat, count(*) AS today, max(days) AS days FROM v_hist
    JOIN s USING ({SITE}) WHERE date_wit BETWEEN DATE '2001-01-01' AND DATE '2001-01-31' GROUP BY {SITE}""")
def e6_recurrent_today(hist):
    """Sites seen in the newest month, with their whole history."""
    days = recurrence.site_stats(hist, "longitude", "latitude").select("longitude", "latitude", "days")
    now = hist.where("date_wit between DATE'2001-01-01' and DATE'2001-01-31'").groupBy("longitude", "latitude").agg(F.count(F.lit(1)).alias("today"))
    return now.join(days, ["longitude", "latitude"]).select(F.round("longitude", 4).alias("lon"), F.round("latitude", 4).alias("lat"), "today", "days")


@query("v_hist", sql="""WITH c AS (SELECT *, floor((longitude - 134.25e0 + 1e-6) / 0.05e0) AS i, floor((latitude + 1.39e0 + 1e-6) / 0.05e0) AS j FROM v_hist)
  SELECT detection_id, first_value(detection_id) OVER (PARTITION BY i, j ORDER BY date_wit, latitude, longitude, detection_id) AS cluster FROM c""")
def j4_leader_clusters(hist):
    """Clusters around running centroids, in order of day and place."""
    return recurrence.leader_clusters(hist, 750.0)


#: In rounds: a row is a seed once all stronger rows in reach are known to be members of others.
SEEDS = """WITH RECURSIVE r AS (SELECT detection_id AS id, longitude * 111320 AS x, latitude * 111320 AS y, row_number() OVER (ORDER BY frp DESC NULLS LAST,
    detection_id) AS place FROM v_det),
  pr AS (SELECT a.id AS a, b.id AS b, a.place FROM r a JOIN r b ON a.place < b.place AND abs(a.x - b.x) <= 375 AND abs(a.y - b.y) <= 375 AND pow(a.x - b.x,
    2) + pow(a.y - b.y, 2) <= 375 * 375),
  w AS (SELECT 0 AS turn, id, 0 AS state FROM r UNION ALL
    SELECT w.turn + 1, w.id, CASE WHEN w.state > 0 THEN w.state WHEN e.seed THEN 2 WHEN e.open THEN 0 ELSE 1 END
    FROM w
      LEFT JOIN (SELECT pr.b, bool_or(o.state = 1) AS seed, bool_or(o.state = 0) AS open FROM pr JOIN w o ON o.id = pr.a
    GROUP BY pr.b) e ON e.b = w.id
      WHERE EXISTS (SELECT 1 FROM w u WHERE u.state = 0)),
  f AS (SELECT id, state FROM w WHERE turn = (SELECT max(turn) FROM w))
  SELECT f.id AS detection_id, coalesce((SELECT min_by(pr.a, pr.place) FROM pr JOIN f g ON g.id = pr.a AND g.state = 1
    WHERE pr.b = f.id), f.id) AS cluster FROM f"""


@query("v_det", sql=SEEDS)
def j7_seed_clusters(det):
    """Clusters around the strongest detection within reach."""
    return recurrence.seed_clusters(det, 375.0)


ROADS = """r AS (SELECT s_suppkey AS road, s_nationkey, 134.25e0 + (s_suppkey % 50) * 0.05e0 AS x1, -1.39e0 + (s_nationkey % 5) * 0.01e0 AS y1,
    134.25e0 + (s_suppkey % 50) * 0.05e0 + 0.02e0 AS x2, -1.385e0 + (s_nationkey % 7) * 0.01e0 AS y2, CASE s_suppkey % 3
    WHEN 0 THEN 'main' WHEN 1 THEN 'track' ELSE 'path' END AS cls FROM supplier)"""


@query("v_det", "supplier", sql=f"""WITH {ROADS}, d AS (SELECT detection_id AS id, longitude AS x, latitude AS y
    FROM v_det),
  t AS (SELECT id, cls, x, y, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy, least(greatest(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (pow(x2 - x1,
    2) + pow(y2 - y1, 2)), 0), 1) AS k FROM d CROSS JOIN r),
  m AS (SELECT id, cls, sqrt(pow(x - x1 - k * dx, 2) + pow(y - y1 - k * dy, 2)) AS m FROM t)
  SELECT d.id, round(min(m), 6) AS metres, min_by(cls, (m, cls)) AS cls FROM d LEFT JOIN m ON m.id = d.id AND m.m <= 0.05e0
    GROUP BY d.id""")
def d5_nearest_road(det, supplier):
    """Nearest segment in reach, its class; null beyond."""
    roads = supplier.select((134.25 + (F.col("s_suppkey") % 50) * 0.05).alias("x1"), (-1.39 + (F.col("s_nationkey") % 5) * 0.01).alias("y1"), (134.25 + (F.col("s_suppkey") % 50) * 0.05 + 0.02).alias("x2"), (-1.385 + (F.col("s_nationkey") % 7) * 0.01).alias("y2"), F.when(F.col("s_suppkey") % 3 == 0, "main").when(F.col("s_suppkey") % 3 == 1, "track").otherwise("path").alias("cls"))
    pts = det.select(F.col("detection_id").alias("id"), F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    return geo.nearest_segment(pts, roads, 0.05).select("id", F.round("metres", 6).alias("metres"), "cls")


@query("v_det", "supplier", sql="""WITH r AS (SELECT 134.25e0 + s_suppkey % 11 * 0.05e0 AS x1, -1.39e0 + s_nationkey % 5 * 0.01e0 AS y1, 134.25e0 + s_suppkey % 11 * 0.05e0 + 0.02e0 AS x2,
    -1.385e0 + s_nationkey % 7 * 0.01e0 AS y2, CASE s_suppkey % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'track' ELSE 'path' END AS cls FROM supplier),
  p AS (SELECT DISTINCT longitude AS x, latitude AS y FROM v_det), t AS (SELECT x, y, x1, y1, x2, y2, cls, least(greatest(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 0), 1) AS t FROM p CROSS JOIN r),
  d AS (SELECT x, y, cls, sqrt(pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2)) AS m FROM t), b AS (SELECT x, y, min(m) AS m, min_by(cls, (round(m, 12), cls)) AS cls FROM d GROUP BY ALL)
  SELECT detection_id AS id, round(m, 6) AS metres, cls FROM v_det JOIN b ON longitude = x AND latitude = y""")
def d5_nearest_road_anywhere(det, supplier):
    """Nearest segment at any distance, its class: most detections lie far beyond the cells that have roads."""
    x, y = 134.25 + F.col("s_suppkey") % 11 * 0.05, F.col("s_nationkey")
    cls = F.when(F.col("s_suppkey") % 3 == 0, "main").when(F.col("s_suppkey") % 3 == 1, "track").otherwise("path")
    roads = supplier.select(x.alias("x1"), (-1.39 + y % 5 * 0.01).alias("y1"), (x + 0.02).alias("x2"), (-1.385 + y % 7 * 0.01).alias("y2"), cls.alias("cls"))
    places = det.select(F.col("longitude").alias("x"), F.col("latitude").alias("y")).distinct().withColumn("id", F.struct("x", "y"))
    near = nearest.nearest_anywhere(places, roads, 0.01, digits=12).select(F.col("id.x").alias("longitude"), F.col("id.y").alias("latitude"), "metres", "cls")
    return det.join(near, ["longitude", "latitude"]).select(F.col("detection_id").alias("id"), F.round("metres", 6).alias("metres"), "cls")


@query("v_adm", sql="SELECT adm_id, unnest(range(1, CASE WHEN notched THEN 6 ELSE 4 END)) AS part FROM v_adm")
def a16_road_segments(adm):
    """Consecutive vertices of a line."""
    v = with_ring(adm).select("adm_id", F.posexplode("ring").alias("pos", "p")).select("adm_id", "pos", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    seg = geo.road_segments(v, "adm_id", "pos")
    return seg.select("adm_id", F.row_number().over(Window.partitionBy("adm_id").orderBy("x1", "y1", "x2", "y2")).cast("long").alias("part"))


@query("v_adm", sql="""SELECT adm_id, round((e - w) * (n - s) * CASE WHEN notched THEN 0.75e0 ELSE 1 END, 9) AS area, round(CASE
    WHEN notched THEN ((w + e) / 2 * 1 - (w + (e - w) * 0.75) * 0.25) / 0.75 ELSE (w + e) / 2 END, 7) AS cx
    FROM v_adm""")
def j14_polygon_measures(adm):
    """Area and centroid of rings."""
    a = with_ring(adm)
    return a.select("adm_id", F.round(geo.ring_area(F.col("ring")), 9).alias("area"), F.round(geo.ring_centroid(F.col("ring"))[0], 7).alias("cx"))


@query("v_det", sql="""SELECT satellite, min(longitude) - 0.02e0 AS w, min(latitude) - 0.02e0 AS s, max(longitude) + 0.02e0 AS e,
    max(latitude) + 0.02e0 AS n FROM v_det GROUP BY satellite""")
def j15_extents(det):
    """Padded extents."""
    return det.groupBy("satellite").agg((F.min("longitude") - 0.02).alias("w"), (F.min("latitude") - 0.02).alias("s"), (F.max("longitude") + 0.02).alias("e"), (F.max("latitude") + 0.02).alias("n"))


@query("v_adm", sql="""SELECT CAST(sum(CASE WHEN notched THEN 6 ELSE 4 END) AS INTEGER) AS edges, CAST(sum(CASE
    WHEN notched THEN 6 ELSE 4 END) AS INTEGER) AS once FROM v_adm""")
def j12_boundary_edges(adm):
    """Undirected edges of all rings and those that belong to one polygon only."""
    e = geo.shared_edges(with_ring(adm))
    return e.agg(F.count(F.lit(1)).cast("int").alias("edges"), F.count_if(F.col("uses") == 1).cast("int").alias("once"))


WIN = "CAST(epoch(date_trunc('second', valid_utc)) AS BIGINT)"
EV = """ev AS (SELECT user_id AS event, CAST(epoch(date_trunc('second', min(ts))) AS BIGINT) AS t0, CAST(epoch(date_trunc('second',
    min(ts))) AS BIGINT) + 86400 AS t1, CAST(user_id % 90 AS DOUBLE) AS km, CAST((user_id * 31) % 360 AS DOUBLE) AS bearing
    FROM events GROUP BY user_id)"""
OB = f"""o AS (SELECT obs_id, {WIN} AS at_s, TRY_CAST(vsby AS DOUBLE) AS vsby, abs(TRY_CAST(vsby AS DOUBLE) - 6.21) < 1e-6 AS ceil,
    CASE WHEN TRY_CAST(sknt AS DOUBLE) > 0 THEN TRY_CAST(drct AS DOUBLE) END AS dir, TRY_CAST(sknt AS DOUBLE) AS k, list_contains(string_split_regex(coalesce(wxcodes,
    'M'), ' +'), 'FU') AS fu, list_contains(string_split_regex(coalesce(wxcodes, 'M'), ' +'), 'HZ') AS hz FROM v_obs)"""
HITS = f"{EV}, {OB}, h AS (SELECT * FROM ev JOIN o ON at_s BETWEEN t0 AND t1 + 7200)"


def event_windows(events: DataFrame) -> DataFrame:
    t0 = F.unix_seconds(F.min(F.col("ts").cast("timestamp")))
    e = events.groupBy(F.col("user_id").alias("event")).agg(t0.alias("t0"))
    return e.select("event", "t0", (F.col("t0") + 86_400).alias("t1"), (F.col("event") % 90).cast("double").alias("km"), ((F.col("event") * 31) % 360).cast("double").alias("bearing"))


@query("events", "v_obs", sql=f"WITH {HITS} SELECT event, obs_id FROM h")
def d3_interval_join(events, obs):
    """Reports in each event's window."""
    windows = event_windows(events).select("event", "t0", "t1")
    return stations.reports_in_window(windows, stations.parsed(obs), 7200).select("event", "obs_id")


STATION = f"""WITH {HITS}, a AS (SELECT event, count(*) AS n_obs, count(*) FILTER (WHERE fu) AS n_fu, count(*) FILTER (WHERE hz) AS n_hz,
    count(*) FILTER (WHERE fu AND k > 0 AND least((dir - bearing + 720) % 360, 360 - (dir - bearing + 720) % 360) <= 45) AS n_fu_from,
    min(vsby) AS vsby_min, round(count(*) FILTER (WHERE ceil) / nullif(count(vsby), 0), 6) AS ceiling_share
    FROM h GROUP BY event),
  c AS (SELECT x.event, count(DISTINCT y.event) AS n_concurrent FROM h x JOIN h y ON x.obs_id = y.obs_id AND x.event <> y.event
    WHERE x.fu GROUP BY x.event),
  s AS (SELECT ev.event, ev.km, coalesce(n_obs, 0) AS n_obs, coalesce(n_fu, 0) AS n_fu, coalesce(n_hz, 0) AS n_hz, coalesce(n_fu_from,
    0) AS n_fu_from, coalesce(n_concurrent, 0) AS n_concurrent, vsby_min, ceiling_share, round(coalesce(n_obs, 0) / ((t1 + 7200 - t0) // 1800 + 1),
    6) AS coverage FROM ev LEFT JOIN a USING (event) LEFT JOIN c USING (event))"""


@query("events", "v_obs", sql=f"{STATION} SELECT * FROM s")
def e11_d4_station_records(events, obs):
    """E11, D4."""
    s = stations.station_records(event_windows(events), stations.parsed(obs), 7200, 45.0)
    return s.withColumns({c: F.round(c, 6) for c in ("ceiling_share", "coverage")})


@query("events", "v_obs", sql=f"""{STATION}, k AS (SELECT unnest([25, 50, 100]) AS max_km) SELECT max_km, CASE
    WHEN coverage < 0.5 THEN 'unobserved' WHEN km > max_km THEN 'beyond range' WHEN n_fu_from >= 1 THEN 'corroborated'
    WHEN n_fu >= 1 THEN 'smoke from elsewhere' ELSE 'no smoke' END AS class, count(*) AS n FROM s CROSS JOIN k
    GROUP BY ALL""")
def e12_n4_class_counts(events, obs):
    """Classes under three ranges, from one pass."""
    s = stations.station_records(event_windows(events), stations.parsed(obs), 7200, 45.0)
    s = s.withColumn("max_km", F.explode(F.array(*[F.lit(k) for k in (25, 50, 100)])))
    return s.groupBy("max_km", stations.station_class(0.5, F.col("max_km")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("v_obs", sql=f"""WITH {OB}, d AS (SELECT *, to_timestamp(at_s) AT TIME ZONE 'UTC' AS ts FROM o) SELECT CAST(month(ts) AS INTEGER) AS month,
    CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, count(DISTINCT CASE WHEN fu THEN CAST(ts AS DATE) END) AS fu_days, count(*) FILTER (WHERE fu) AS fu
    FROM d GROUP BY GROUPING SETS ((month(ts)), (hour(ts)))""")
def e10_station_baseline(obs):
    """By month, and by hour of the day."""
    o = stations.parsed(obs).select(F.month("valid_utc").alias("month"), F.hour("valid_utc").alias("hour"), F.to_date("valid_utc").alias("day"), "fu")
    return o.groupingSets([[F.col("month")], [F.col("hour")]], F.col("month"), F.col("hour")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(F.col("fu"), F.col("day"))).alias("fu_days"), F.count_if("fu").alias("fu"))


@query("v_det", sql="""WITH a AS (SELECT longitude, latitude, date_wit, max(frp) AS frp, count(*) AS n FROM v_det
    GROUP BY ALL) SELECT round(longitude, 4) AS lon, round(latitude, 4) AS lat, date_wit, lag(date_wit) OVER w AS prior_day, lag(frp) OVER w AS prior_frp,
    coalesce(lag(n) OVER w, 0) AS prior_n FROM a WINDOW w AS (PARTITION BY longitude, latitude ORDER BY date_wit)""")
def d15_latest_prior(det):
    """Of each place and day the latest earlier day, its strongest power, and how many it had."""
    a = det.groupBy("longitude", "latitude", "date_wit").agg(F.max("frp").alias("frp"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("longitude", "latitude").orderBy("date_wit")
    return a.select(F.round("longitude", 4).alias("lon"), F.round("latitude", 4).alias("lat"), "date_wit", F.lag("date_wit").over(w).alias("prior_day"), F.lag("frp").over(w).alias("prior_frp"), F.coalesce(F.lag("n").over(w), F.lit(0)).alias("prior_n"))


@query("v_lab", "v_det", sql="""WITH b AS (SELECT DISTINCT stratum, 134.25e0 + (length(stratum) * 7 + ascii(substr(stratum, length(stratum),
    1))) % 50 * 0.05e0 + 0.0123e0 AS x FROM v_lab) SELECT stratum, round(min(CASE WHEN detection_id IS NOT NULL THEN greatest(abs(longitude - x) - 0.0005e0,
    0) END) * 111320, 3) AS metres, count(detection_id) AS late FROM b LEFT JOIN v_det ON date_wit > DATE '2024-01-20' AND abs(longitude - x) <= 0.03
    GROUP BY stratum""")
def d16_box_distance(lab, det):
    """Nearest later detection from the side of each box and how many are in reach, by cells as wide as the reach; null beyond."""
    s, reach = F.col("stratum"), 0.03
    x = 134.25 + (F.length(s) * 7 + F.ascii(F.substring(s, -1, 1))) % 50 * 0.05 + 0.0123
    boxes = lab.select("stratum", x.alias("x")).distinct().withColumn("k", F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)]))).withColumn("cell", F.floor(F.col("x") / reach) + F.col("k"))
    d = det.where("date_wit > DATE'2024-01-20'").groupBy("longitude").agg(F.count(F.lit(1)).alias("n")).withColumn("cell", F.floor(F.col("longitude") / reach))
    j = boxes.join(d, "cell", "left").withColumn("m", F.abs(F.col("longitude") - F.col("x")))
    near = F.col("m") <= reach
    return j.groupBy("stratum").agg(F.round(F.min(F.when(near, F.greatest(F.col("m") - 0.0005, F.lit(0.0)))) * 111320, 3).alias("metres"), F.coalesce(F.sum(F.when(near, F.col("n"))), F.lit(0)).alias("late"))


@query("v_det", sql="SELECT detection_id FROM v_det WHERE longitude BETWEEN 134.5 AND 135.0 AND datetime_utc BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'")
def d21_points_in_frame(det):
    """A frame and a time window; predicates that reach the scan of the store."""
    return det.where("longitude between 134.5 and 135.0 and datetime_utc between TIMESTAMP_NTZ'2024-01-10 00:00:00' and TIMESTAMP_NTZ'2024-01-12 00:00:00'").select("detection_id")


@query("v_det", sql=f"""{LABELS}, s AS (SELECT event, count(*) AS n FROM m GROUP BY event) SELECT CASE WHEN n >= 5 THEN 'assessed' ELSE 'fewer than 5 detections' END AS reason,
    count(*) AS events, CAST(sum(n) AS BIGINT) AS detections FROM s GROUP BY ALL""")
def c5_e34_size_bar(det):
    """Events above a bar and those below it, both listed."""
    s = E.st_dbscan(det, EPS_M, EPS_S).groupBy("event").agg(F.count(F.lit(1)).alias("n"))
    return s.groupBy(F.when(F.col("n") >= 5, "assessed").otherwise("fewer than 5 detections").alias("reason")).agg(F.count(F.lit(1)).alias("events"), F.sum("n").alias("detections"))


#: On whole thousandths of a degree an edge of the hull is a pair with no point to its right, and none beyond it on its line.
HULL = f"""WITH p AS (SELECT DISTINCT satellite, date_wit, CAST(round(longitude * 1000) AS BIGINT) AS x, CAST(round(latitude * 1000) AS BIGINT) AS y,
    longitude, latitude FROM v_det),
  g AS (SELECT satellite, date_wit, count(*) AS points, cos(radians(avg(latitude))) AS c FROM p GROUP BY ALL),
  e AS (SELECT a.satellite, a.date_wit, a.x * b.y - b.x * a.y AS turn FROM p a JOIN p b USING (satellite, date_wit)
    WHERE (a.x <> b.x OR a.y <> b.y) AND NOT EXISTS (SELECT 1 FROM p k WHERE k.satellite = a.satellite AND k.date_wit = a.date_wit
    AND ((b.x - a.x) * (k.y - a.y) - (b.y - a.y) * (k.x - a.x) < 0 OR (b.x - a.x) * (k.y - a.y) - (b.y - a.y) * (k.x - a.x) = 0 AND (k.x - a.x) * (k.x - b.x) + (k.y - a.y) * (k.y - b.y) > 0))),
  s AS (SELECT satellite, date_wit, sum(turn) AS turn FROM e GROUP BY ALL)
  SELECT g.satellite, g.date_wit, points, CASE WHEN turn > 0 THEN round(turn / 2e0 * c * {S.M_PER_DEG}e0 * {S.M_PER_DEG}e0 / 1e10,
    3) END AS hull_ha FROM g LEFT JOIN s ON s.satellite = g.satellite AND s.date_wit = g.date_wit"""


@query("v_det", sql=HULL)
def j10_hull_area(det):
    """Convex hull areas of the detections of each satellite and day, in hectares; null without area."""
    return recurrence.hull_areas(det, ["satellite", "date_wit"]).withColumn("hull_ha", F.round("hull_ha", 3))


@query("v_det", sql=f"""WITH {PLANE} SELECT a.id AS detection_id FROM p a WHERE a.satellite = 'Terra' AND EXISTS (SELECT 1
    FROM p b WHERE b.satellite = 'N' AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= {EPS_M**2} AND abs(a.x - b.x) <= {EPS_M})""")
def j9_circle_membership(det):
    """Detections of one sensor inside the circles around those of another."""
    return geo.within_circles(det, det.where("satellite = 'Terra'"), det.where("satellite = 'N'"), EPS_M).select("detection_id")


@query("v_adm", sql="SELECT a.adm_id, b.adm_id AS other FROM v_adm a JOIN v_adm b ON a.adm_id < b.adm_id AND a.w < b.e + 0.06 AND b.w < a.e + 0.06 AND a.s < b.n + 0.006 AND b.s < a.n + 0.006")
def j11_box_overlaps(adm):
    """Boxes, widened, that share area (touching isn't enough), by the cells that they cover."""
    return geo.overlapping_boxes(adm, 0.03, 0.003)
