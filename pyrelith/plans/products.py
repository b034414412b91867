"""Remaining operators and the products made of them (survey sections A, B, C, D, H, I, J, K, M, N)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from pyrelith.functions import scalar as S
from pyrelith.operators import events as E
from pyrelith.operators import geo, ingest, provenance, recurrence, sites
from pyrelith.plans.events import LABELS, EPS_M, EPS_S
from pyrelith.operators.ordering import numbered
from pyrelith.plans.ingest import ON_ADM, REFUSALS, with_ring
from pyrelith.plans.registry import query
from pyrelith.sources import files


@query("v_obs", sql="""SELECT obs_id, drct, sknt, vsby, coalesce(nullif(wxcodes, ''), NULL) AS wxcodes, CAST(epoch(date_trunc('minute',
    valid_utc)) AS BIGINT) AS at_s FROM v_obs""")
def a7_station_scan(obs):
    """Report lines parsed from text."""
    line = F.concat_ws(",", F.col("obs_id").cast("string"), F.date_format("valid_utc", "yyyy-MM-dd HH:mm"), "drct", "sknt", "vsby", F.coalesce("wxcodes", F.lit("")))
    p = files.station_reports(obs.select(line.alias("value")))
    return p.select(F.col("station").cast("long").alias("obs_id"), "drct", "sknt", "vsby", "wxcodes", F.unix_seconds("valid_utc").alias("at_s"))


@query("v_day", sql="""SELECT day, CASE day.day_no % 4 WHEN 0 THEN 'a web page' WHEN 1 THEN 'no header' WHEN 2 THEN 'no rows' END AS fault
    FROM (SELECT day, extract(day FROM day) AS day_no FROM v_day) day""")
def a8_report_validator(day):
    """Answers that can't be a year of reports."""
    k = F.dayofmonth("day") % 4
    body = F.when(k == 0, " <html>").when(k == 1, "x,y\n1,2\n").when(k == 2, "station,valid\n\n").otherwise("station,valid\nA,2024\n")
    return day.select("day", files.report_fault(body).alias("fault"))


@query("v_hist", sql="""WITH r AS (SELECT min(date_wit) AS a, max(date_wit) AS b FROM v_hist), y AS (SELECT unnest(range(year(a),
    year(b) + 1)) AS y, a, b FROM r) SELECT y::INTEGER AS year, greatest(make_date(y, 1, 1), a) AS since, least(make_date(y, 12,
    31), b) AS until FROM y""")
def a9_year_chunks(hist):
    """A9."""
    r = hist.agg(F.min("date_wit").alias("a"), F.max("date_wit").alias("b"))
    return r.select(F.explode(files.year_chunks(F.col("a"), F.col("b"))).alias("c")).select("c.*")


@query("v_wx", sql="""SELECT cell, date, round(least(100 * exp(17.625 * (t_noon - 4) / (243.04 + t_noon - 4)) / exp(17.625 * t_noon / (243.04 + t_noon)),
    100), 6) AS rh, rain >= 0 AND day(date) % 5 <> 0 AS valid FROM v_wx""")
def a10_weather_scan(wx):
    """A10: monthly JSON documents to days with validity and humidity."""
    n = F.when(F.dayofmonth("date") % 5 == 0, 23).otherwise(24)
    row = F.struct(F.col("cell").cast("string").alias("cell"), F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("t_noon").alias("t"), (F.col("t_noon") - 4).alias("dew"), "rain", n.alias("rain_n"), F.col("t_max").alias("tmax"), F.lit(24).alias("tmax_n"))
    docs = wx.groupBy("cell", F.year("date"), F.month("date")).agg(F.to_json(F.struct(F.collect_list(row).alias("rows"))).alias("value"))
    return files.weather_archive(docs).select(F.col("cell").cast("long").alias("cell"), "date", F.round("rh", 6).alias("rh"), "valid")


@query("supplier", sql="""WITH s AS (SELECT s_suppkey AS id, ['primary', 'track', 'footway', 'rail'][1 + (s_suppkey % 4)::INT] AS tag,
    s_suppkey % 5 AS n FROM supplier) SELECT CASE tag WHEN 'primary' THEN 'main' WHEN 'track' THEN 'track' END AS cls, count(*) AS ways
    FROM s WHERE tag <> 'footway' AND n >= 2 GROUP BY 1""")
def a15_c10_road_scan(supplier):
    """Ways of two vertices and more; unknown classes are kept as null and counted."""
    tag = F.element_at(F.array(*[F.lit(x) for x in ("primary", "track", "footway", "rail")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    pts = F.slice(F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.struct((i * 0.1).alias("lat"), (i * 0.2).alias("lon"))), F.lit(1), (F.col("s_suppkey") % 5).cast("int"))
    el = F.struct(F.col("s_suppkey").alias("id"), F.lit("way").alias("type"), F.create_map(F.lit("highway"), tag).alias("tags"), pts.alias("geometry"))
    docs = supplier.groupBy("s_nationkey").agg(F.to_json(F.struct(F.collect_list(el).alias("elements"))).alias("value"))
    return files.road_lines(docs).select("id", "cls").distinct().groupBy("cls").agg(F.count(F.lit(1)).alias("ways"))


@query("v_pix", sql="""SELECT scene, count(*) AS looks, min(look_date) AS first_look FROM v_pix WHERE x BETWEEN 10 AND 30 AND y BETWEEN 10 AND 30 AND look_date >= DATE '1997-01-01' AND look_date < DATE '1998-01-01' AND scl IN (4,
    5, 6, 7) GROUP BY scene""")
def a17_collection_scan(pix):
    """A collection cut by area, dates (end excluded) and mask; all of it reaches the scan as predicates."""
    return pix.where("x between 10 and 30 and y between 10 and 30 and look_date >= DATE'1997-01-01' and look_date < DATE'1998-01-01' and scl in (4, 5, 6, 7)").groupBy("scene").agg(F.count(F.lit(1)).alias("looks"), F.min("look_date").alias("first_look"))


@query("v_det", sql="""SELECT detection_id || ',' || printf('%.5f', latitude) || ',' || printf('%.5f', longitude) || ',' || coalesce(satellite,
    '') AS line, '<Placemark><name>' || detection_id || '</name><Point><coordinates>' || printf('%.5f,%.5f', longitude, latitude) || '</coordinates></Point></Placemark>' AS kml
    FROM v_det""")
def b10_waypoints(det):
    """Waypoints as CSV lines and placemarks."""
    d = det
    xy = F.format_string("%.5f,%.5f", "longitude", "latitude")
    return d.select(F.concat_ws(",", F.col("detection_id").cast("string"), F.format_string("%.5f", "latitude"), F.format_string("%.5f", "longitude"), "satellite").alias("line"), F.concat(F.lit("<Placemark><name>"), F.col("detection_id").cast("string"), F.lit("</name><Point><coordinates>"), xy, F.lit("</coordinates></Point></Placemark>")).alias("kml"))


@query("v_man", sql="SELECT min(chunk_start) AS first_day, min(chunk_start) >= DATE '2023-12-31' AS window_ok FROM v_man")
def c9_window_check(man):
    """A window's end (excluded) may be the first day itself, not later."""
    return man.agg(F.min("chunk_start").alias("first_day")).withColumn("window_ok", F.col("first_day") >= F.lit("2023-12-31").cast("date"))


@query("v_lab", sql="SELECT sample_id, stratum, event FROM v_lab")
def c12_whitelist(lab):
    """Only the columns that may be published."""
    return lab.select("sample_id", "stratum", "event")


@query("v_det", sql=f"{LABELS} SELECT m.event, count(*) AS n, max(frp) AS frp FROM v_det JOIN m USING (detection_id) GROUP BY m.event HAVING count(*) >= 5")
def d10_membership_join(det):
    """Detections with their events."""
    return det.join(E.st_dbscan(det, EPS_M, EPS_S), "detection_id").groupBy("event").agg(F.count(F.lit(1)).alias("n"), F.max("frp").alias("frp")).where("n >= 5")


@query("v_det", sql="""WITH g AS (SELECT x::INTEGER AS px, y::INTEGER AS py, 134.25e0 + x * 0.0207e0 AS lon, -1.39e0 + y * 0.0207e0 AS lat
    FROM range(0, 130) AS a(x) CROSS JOIN range(0, 20) AS b(y)) SELECT detection_id, min_by(px, (pow(lon - longitude, 2) + pow(lat - latitude,
    2), px, py)) AS px, min_by(py, (pow(lon - longitude, 2) + pow(lat - latitude, 2), px, py)) AS py FROM v_det
    CROSS JOIN g GROUP BY detection_id""")
def d6_nearest_pixel(det):
    """The nearest centre of a regular pixel grid, found by arithmetic and not by search."""
    d = det
    near = lambda v, o, n: F.least(F.greatest(F.ceil((F.col(v) - o) / 0.0207 - 0.5), F.lit(0)), F.lit(n - 1)).cast("int")
    return d.select("detection_id", near("longitude", 134.25, 130).alias("px"), near("latitude", -1.39, 20).alias("py"))


@query("v_det", sql="""WITH s AS (SELECT n_nationkey AS site, 134.25e0 + (n_nationkey % 5) * 0.5e0 AS sx, -1.39e0 + floor(n_nationkey / 5) * 0.02e0 AS sy
    FROM v_nat), d AS (SELECT satellite, site, sqrt(pow((longitude - sx) * 111320, 2) + pow((latitude - sy) * 111320, 2)) AS m
    FROM v_det CROSS JOIN s) SELECT satellite, site, round(min(greatest(m - 375, 0)), 3) AS edge_m FROM d GROUP BY ALL""".replace("v_nat", "(SELECT unnest(range(0, 25)) AS n_nationkey)"))
def d20_site_distances(det):
    """From each group's circles to a list of sites (25 rows, broadcast), 0 where they touch."""
    places = det.select("satellite", "longitude", "latitude").distinct()
    site = det.sparkSession.range(25).select(F.col("id").alias("site"), (134.25 + (F.col("id") % 5) * 0.5).alias("sx"), (-1.39 + F.floor(F.col("id") / 5) * 0.02).alias("sy"))
    m = F.hypot((F.col("longitude") - F.col("sx")) * 111_320, (F.col("latitude") - F.col("sy")) * 111_320)
    return places.join(F.broadcast(site)).groupBy("satellite", "site").agg(F.round(F.min(F.greatest(m - 375, F.lit(0.0))), 3).alias("edge_m"))


@query("v_adm", sql="SELECT adm_id, round(CASE WHEN notched THEN 0.75e0 ELSE 1 END, 6) AS iou, CASE WHEN notched THEN 'differs' ELSE 'same' END AS verdict FROM v_adm")
def i18_overlap_verdict(adm):
    """A ring against its box: intersection over union by area, and the verdict at a margin of 0.01."""
    a = with_ring(adm).withColumn("box", (F.col("e") - F.col("w")) * (F.col("n") - F.col("s"))).withColumn("iou", F.round(geo.ring_area(F.col("ring")) / F.col("box"), 6))
    return a.select("adm_id", "iou", F.when(F.col("iou") >= 0.99, "same").otherwise("differs").alias("verdict"))


@query("v_adm", sql="SELECT adm_id, 4 + CASE WHEN notched THEN 2 ELSE 0 END AS points, round(w, 2) AS x0, round(s, 2) AS y0 FROM v_adm")
def h33_rounded_rings(adm):
    """Coordinates rounded inside nested arrays."""
    r = with_ring(adm).select("adm_id", F.transform("ring", lambda p: F.struct(F.round(p["x"], 2).alias("x"), F.round(p["y"], 2).alias("y"))).alias("r"))
    return r.select("adm_id", F.size("r").alias("points"), F.element_at("r", 1)["x"].alias("x0"), F.element_at("r", 1)["y"].alias("y0"))


@query("v_adm", sql="""SELECT adm_id, tolerance, CASE WHEN notched AND tolerance < 0.0112 THEN 6 ELSE 4 END AS points, round((e - w) * (n - s) * CASE
    WHEN notched THEN 0.75e0 ELSE 1 END, 8) AS area
  FROM v_adm CROSS JOIN (SELECT unnest([0.01e0, 0.02e0]) AS tolerance)""")
def j13_simplified_rings(adm):
    """Douglas-Peucker on each ring; one that would vanish stays as it is. The wider tolerance cuts a notch of 0.0112 off in two corners that cancel out."""
    rings = [sites.simplify(with_ring(adm), t).select("adm_id", F.lit(t).alias("tolerance"), F.size("simple").alias("points"), F.round(geo.ring_area(F.col("simple")), 8).alias("area")) for t in (0.01, 0.02)]
    return rings[0].unionByName(rings[1])


#: The clusters of a site choose one after another among its known places; sites lie farther apart than the radius.
CLAIMS = """WITH RECURSIVE s AS (SELECT count(*) AS n, latitude AS lat, longitude AS lon, floor((longitude - 134.25e0 + 1e-6) / 0.05e0) * 1000 + floor((latitude + 1.39e0 + 1e-6) / 0.05e0) AS site
    FROM v_hist GROUP BY longitude, latitude HAVING count(DISTINCT date_wit) >= 12),
  k AS (SELECT printf('R%03d', row_number() OVER (ORDER BY lat, lon)) AS site_id, lat + 0.001e0 AS lat, lon, site
    FROM s WHERE n % 3 = 0),
  o AS (SELECT *, row_number() OVER (ORDER BY n DESC, lat, lon) AS place, row_number() OVER (PARTITION BY site
    ORDER BY n DESC, lat, lon) AS turn FROM s),
  d AS (SELECT o.place, list({'d': pow(k.lat - o.lat, 2) + pow(k.lon - o.lon, 2), 'id': k.site_id}) AS wishes
    FROM o JOIN k ON k.site = o.site AND pow(k.lat - o.lat, 2) + pow(k.lon - o.lon, 2) <= pow(750.0e0 / 111320.0e0, 2)
    GROUP BY o.place),
  c AS (SELECT site, 0::BIGINT AS turn, NULL::BIGINT AS place, NULL::VARCHAR AS got, []::VARCHAR[] AS taken
    FROM (SELECT DISTINCT site FROM s) UNION ALL
    SELECT site, turn, place, pick, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END FROM (
      SELECT c.site, o.turn, o.place, c.taken, list_sort(list_filter(d.wishes, lambda x: NOT list_contains(c.taken, x.id)))[1].id AS pick
    FROM c JOIN o ON o.site = c.site AND o.turn = c.turn + 1 LEFT JOIN d ON d.place = o.place)),
  j AS (SELECT o.*, c.got FROM o JOIN c USING (place))
  SELECT coalesce(got, printf('R%03d', CASE WHEN got IS NULL THEN 499 + row_number() OVER (PARTITION BY got IS NULL
    ORDER BY place) END)) AS site_id, lat, lon, n, got IS NULL AS new FROM j"""


@query("v_hist", sql=CLAIMS)
def j6_d7_site_registry(hist):
    """Sites matched to a registry of an earlier run by distance, in order of their counts; numbers are never used again."""
    s = recurrence.site_stats(hist, "longitude", "latitude").where("days >= 12").select("n", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    known = numbered(s.where("n % 3 = 0"), ["lat", "lon"]).select(F.format_string("R%03d", "number").alias("site_id"), (F.col("lat") + 0.001).alias("lat"), F.col("lon"))
    return sites.match_registry(s, known, 750.0, 500)


@query("v_det", sql=f"""{LABELS}, r AS (SELECT event, count(*) AS n, coalesce(sum(frp), 0) AS f FROM m JOIN v_det USING (detection_id)
    GROUP BY event) SELECT CASE WHEN n >= 5 AND f >= 200 THEN 'strong' WHEN n >= 2 OR f >= 100 THEN 'medium' ELSE 'weak' END AS rank,
    count(*) AS events FROM r GROUP BY 1""")
def j8_n17_target_ranks(det):
    """Ranks of targets."""
    r = det.join(E.st_dbscan(det, EPS_M, EPS_S), "detection_id").groupBy("event").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("frp"), F.lit(0.0)).alias("f"))
    rank = F.when((F.col("n") >= 5) & (F.col("f") >= 200), "strong").when((F.col("n") >= 2) | (F.col("f") >= 100), "medium").otherwise("weak")
    return r.groupBy(rank.alias("rank")).agg(F.count(F.lit(1)).alias("events"))


@query("v_det", "v_adm")
def j16_seeded_controls(det, adm):
    """Seeded control points inside polygons, far from every detection and from one another."""
    return sites.controls(with_ring(adm), det.select("longitude", "latitude").distinct(), seed=7, each=40, away=0.004, apart=0.01)


@query("v_det", sql="""WITH b AS (SELECT date_wit, max_by(detection_id, (frp, -detection_id)) AS brightest FROM v_det
    WHERE frp IS NOT NULL GROUP BY date_wit) SELECT b.date_wit, brightest, CAST(floor((CAST(floor(epoch(datetime_utc)) AS BIGINT) + 300) / 600) * 600 AS BIGINT) AS slot
    FROM b JOIN v_det d ON d.detection_id = b.brightest""")
def k21_brightest_slot(det):
    """Each day's brightest and the nearest ten-minute slot (the hour carries)."""
    b = det.where("frp is not null").groupBy("date_wit").agg(F.max(F.struct("frp", (-F.col("detection_id")).alias("m"), "datetime_utc")).alias("t"))
    s = F.unix_seconds(F.col("t.datetime_utc").cast("timestamp")) + 300
    return b.select("date_wit", (-F.col("t.m")).alias("brightest"), (s - s % 600).alias("slot"))


@query("v_man", sql="""SELECT source, CAST(chunk_start + CAST(o AS INTEGER) AS DATE) AS tile, CAST(least(5, 14 - o) AS INTEGER) AS days
    FROM v_man, range(0, 14, 5) AS t(o)""")
def m1_tile_range(man):
    """L4, M: tiles of five days, forward from a start, by a table function."""
    from pyrelith.functions.tables import register

    register(man.sparkSession)
    starts = man.select("source", "chunk_start")
    return man.sparkSession.sql("SELECT source, t.tile, t.days FROM {s}, LATERAL tile_range(chunk_start, 14, 5) AS t", s=starts)


BRIEF = f"""WITH h AS {ON_ADM}, b AS (SELECT x.date_wit AS day, a.distrik, count(*) AS n, round(coalesce(sum(x.frp), 0), 2) AS f
    FROM v_det x JOIN h USING (detection_id) JOIN v_adm a USING (adm_id) GROUP BY ALL),
  t AS (SELECT day, sum(n) AS total, string_agg('{{"distrik":"' || distrik || '","frp":' || printf('%.2f', f) || ',"n":' || n || '}}',
    ',' ORDER BY distrik) AS parts FROM b GROUP BY day), r AS ({REFUSALS.replace(" AND man.source <> 'MODIS'", "").replace("man.source <> 'MODIS' AND ", "")})
  SELECT r.day, '{{"districts":[' || coalesce(parts, '') || '],"refusal":' || coalesce('"' || refusal || '"', 'null') || ',"total":' || coalesce(total,
    0) || '}}' AS document FROM r LEFT JOIN t USING (day)"""


@query("v_det", "v_adm", "v_man", "v_day", sql=BRIEF)
def n1_n2_daily_brief(det, adm, man, day):
    """For each day, whether it may be published, what was seen by district, as one JSON document a day with sorted keys and fixed decimals."""
    seen = geo.assign_polygon(ingest.clip(det, (134.25, -1.39, 136.76, 0.99)), with_ring(adm), "detection_id").where("on_land")
    by = seen.groupBy(F.col("date_wit").alias("day"), "distrik").agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("frp"), F.lit(0.0)), 2).alias("f"))
    part = F.format_string('{"distrik":"%s","frp":%.2f,"n":%d}', "distrik", "f", "n")
    docs = by.groupBy("day").agg(F.sum("n").alias("total"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("distrik", part.alias("p")))), lambda x: x["p"]), ",").alias("parts"))
    refusal = F.coalesce(F.concat(F.lit('"'), "refusal", F.lit('"')), F.lit("null"))
    out = provenance.refusals(man, day).join(docs, "day", "left")
    return out.select("day", F.concat(F.lit('{"districts":['), F.coalesce("parts", F.lit("")), F.lit('],"refusal":'), refusal, F.lit(',"total":'), F.coalesce("total", F.lit(0)).cast("string"), F.lit("}")).alias("document"))


@query("v_det", sql="SELECT satellite, count(*) AS n FROM (SELECT DISTINCT detection_id, satellite FROM v_det) GROUP BY satellite")
def b1_b2_store_round_trip(det):
    """B1, B2: a store written by year and an append ledger, read back with the partition pruned."""
    return sites.store_round_trip(det).groupBy("satellite").agg(F.count(F.lit(1)).alias("n"))


@query("v_hist", sql=f"SELECT date_wit, round({math.pi!r} * count(*) * 0.375 * 0.375, 6) AS km2_upper FROM v_hist GROUP BY date_wit HAVING count(*) > 3")
def j9_footprint_bound(hist):
    """Upper bound of a day's footprint: its circles without overlap."""
    return hist.groupBy("date_wit").agg(F.count(F.lit(1)).alias("n")).where("n > 3").select("date_wit", F.round(F.lit(math.pi) * F.col("n") * 0.375 * 0.375, 6).alias("km2_upper"))
