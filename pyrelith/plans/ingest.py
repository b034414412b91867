"""Queries of sources, filters, de-duplication, provenance and published tables (survey sections A, B, C, E1-E9, G, L3-L9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions import scalar as S
from pyrelith.operators import geo, ingest, provenance
from pyrelith.plans.registry import query

ADM_RING = "ring"
BBOX = (134.25, -1.39, 136.0, -1.2)


def with_ring(adm: DataFrame) -> DataFrame:
    return adm.withColumn("ring", geo.rectangle_ring(*[F.col(c) for c in ("w", "s", "e", "n", "notched")]))


IN_ADM = "x.longitude BETWEEN a.w AND a.e AND x.latitude BETWEEN a.s AND a.n AND NOT (a.notched AND x.longitude > (a.w + a.e) / 2 AND x.latitude > (a.s + a.n) / 2)"
ON_ADM = f"(SELECT x.detection_id, min(a.adm_id) AS adm_id FROM v_det x JOIN v_adm a ON {IN_ADM} GROUP BY x.detection_id)"


@query("v_det", sql="""SELECT detection_id, sha1(printf('%s|%s|%s|%d|%.5f|%.5f', satellite, instrument, strftime(datetime_utc, '%Y-%m-%d'),
    extract(hour FROM datetime_utc) * 100 + extract(minute FROM datetime_utc), latitude, longitude)) AS stable_id,
  CAST(epoch(date_trunc('minute', datetime_utc)) AS BIGINT) AS at, CAST(date_trunc('minute', datetime_utc) + INTERVAL 9 HOUR AS DATE) AS local_day
    FROM v_det""")
def a1_detection_scan(det):
    """A1, H1, H2, H3: from text columns (a time without leading zeros) to identifier, instant and local day."""
    raw = det.select("detection_id", "satellite", "instrument", "latitude", "longitude", F.date_format("datetime_utc", "yyyy-MM-dd").alias("acq_date"), (F.hour("datetime_utc") * 100 + F.minute("datetime_utc")).cast("string").alias("acq_time"))
    at = S.acquisition_time("acq_date", "acq_time")
    return raw.select("detection_id", S.stable_id("satellite", "instrument", "acq_date", "acq_time", "latitude", "longitude").alias("stable_id"), F.unix_seconds(at).alias("at"), F.to_date(at + F.expr("INTERVAL '9' HOUR")).alias("local_day"))


@query("v_man", sql="""SELECT source, min(chunk_start) AS first_day, CAST(max(chunk_start + days - 1) AS DATE) AS last_day
    FROM v_man WHERE outcome <> 'unavailable' GROUP BY source""")
def a3_availability(man):
    """A3: first and last day that each source can serve."""
    return man.where("outcome <> 'unavailable'").groupBy("source").agg(F.min("chunk_start").alias("first_day"), F.max(F.date_add("chunk_start", F.col("days") - 1)).alias("last_day"))


@query("v_man", sql="""SELECT printf('%s_%s_%dd.csv', source, strftime(chunk_start, '%Y-%m-%d'), days) AS cache_name, chunk_start + days - 1 >= DATE '2024-01-25' - 1 AS refetch
    FROM v_man""")
def a4_cache_policy(man):
    """A4: cache name of a chunk, and whether it is young enough to be fetched again."""
    return man.select(ingest.cache_name("source", "chunk_start", "days").alias("cache_name"), ingest.refetch("chunk_start", "days", F.lit("2024-01-25").cast("date")).alias("refetch"))


@query("v_det", sql="SELECT count(*) AS n, min(date_wit) AS first_day, max(date_wit) AS last_day FROM v_det")
def a5_store_read(det):
    """A5: a store's extent, from two columns."""
    return det.agg(F.count(F.lit(1)).alias("n"), F.min("date_wit").alias("first_day"), F.max("date_wit").alias("last_day"))


@query("v_adm", sql="SELECT adm_id, CASE WHEN notched THEN 6 ELSE 4 END AS vertices, w, s, e, n FROM v_adm")
def a6_polygon_scan(adm):
    """Rings parsed from GeoJSON text, with their boxes."""
    text = with_ring(adm).select(ingest.feature("adm_id", "distrik", F.transform("ring", lambda p: F.array(p["x"], p["y"]))).alias("value"))
    return ingest.parse_features(text).select("adm_id", F.size("ring").alias("vertices"), *[c for c in "wsen"])


@query("v_adm", sql="SELECT adm_id, distrik FROM v_adm WHERE kabupaten = 'ASIA'")
def a23_filtered_polygons(adm):
    """Polygons of one regency."""
    return adm.where(F.col("kabupaten") == "ASIA").select("adm_id", "distrik")


@query("v_pix", sql="SELECT max(printf('chip_%d_swir_%s.tif', scene, strftime(look_date, '%Y%m%d'))) AS latest, count(DISTINCT look_date) AS dates FROM v_pix")
def a19_a20_filenames(pix):
    """Dates parsed from file names; the last name in order."""
    names = pix.select(F.format_string("chip_%d_swir_%s.tif", "scene", F.date_format("look_date", "yyyyMMdd")).alias("name"))
    dated = names.withColumn("day", F.try_to_timestamp(F.regexp_extract("name", r"_swir_(\d{8})\.tif$", 1), F.lit("yyyyMMdd")).cast("date"))
    return dated.agg(F.max("name").alias("latest"), F.countDistinct("day").alias("dates"))


@query("v_det", sql=f"""SELECT count(*) AS n, sum(CASE WHEN instrument = 'VIIRS' THEN 1 ELSE 0 END)::BIGINT AS viirs
    FROM v_det WHERE longitude BETWEEN {BBOX[0]} AND {BBOX[2]} AND latitude BETWEEN {BBOX[1]} AND {BBOX[3]}""")
def c1_bbox_clip(det):
    """Inclusive box."""
    return ingest.clip(det, BBOX).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("instrument") == "VIIRS").alias("viirs"))


@query("v_obs", sql="""SELECT obs_id, TRY_CAST(vsby AS DOUBLE) AS vsby, TRY_CAST(drct AS DOUBLE) AS drct, TRY_CAST(sknt AS DOUBLE) AS sknt,
    coalesce(wxcodes, 'M') AS wx FROM v_obs""")
def c2_contract(obs):
    """Text columns to their contracted types; what isn't a number is null."""
    return ingest.normalise(obs, {"vsby": "double", "drct": "double", "sknt": "double"}).select("obs_id", "vsby", "drct", "sknt", F.coalesce("wxcodes", F.lit("M")).alias("wx"))


@query("v_det", sql="SELECT date_wit, count(*) AS n FROM v_det WHERE date_wit BETWEEN DATE '2024-01-14' AND DATE '2024-01-20' GROUP BY date_wit")
def c3_week_window(det):
    """The seven days that end with one."""
    return ingest.last_days(det, "2024-01-20", 7).groupBy("date_wit").agg(F.count(F.lit(1)).alias("n"))


@query("v_hist", sql="""WITH k AS (SELECT satellite, (satellite IN ('N', 'N20')) AS kept, longitude, latitude, date_wit
    FROM v_hist), c AS (SELECT DISTINCT longitude, latitude, date_wit, kept FROM k)
  SELECT (SELECT count(*) FROM k WHERE NOT kept) AS excluded, (SELECT count(*) FROM (SELECT longitude, latitude, date_wit
    FROM c WHERE NOT kept EXCEPT SELECT longitude, latitude, date_wit FROM c WHERE kept)) AS lost_cell_days""")
def c4_g3_constellation(hist):
    """Detections outside the constellation, and the place-days that only they saw (a set difference)."""
    return ingest.constellation_split(hist, ["N", "N20"], ["longitude", "latitude", "date_wit"])


@query("v_hist", sql="""SELECT longitude, latitude, date_wit, bool_or(satellite <> 'Terra') AS positive FROM v_hist
    WHERE on_land AND satellite IN ('N', 'N20', 'Terra') GROUP BY ALL""")
def c7_positive_days(hist):
    """Place-days with a detection on land, and whether any of them is of the narrower kind."""
    return hist.where(F.col("on_land") & F.col("satellite").isin("N", "N20", "Terra")).groupBy("longitude", "latitude", "date_wit").agg(F.bool_or(F.col("satellite") != "Terra").alias("positive"))


@query("v_det", sql="""SELECT count(*) AS total, sum(CASE WHEN strftime(date_wit, '%Y-%m-%d') BETWEEN '2024-01-05' AND '2024-01-09' THEN 1 ELSE 0 END)::BIGINT AS shown
    FROM v_det""")
def c13_client_filter(det):
    """ISO day strings compare as days."""
    return det.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.date_format("date_wit", "yyyy-MM-dd").between("2024-01-05", "2024-01-09")).alias("shown"))


@query("v_pix", sql="""SELECT scene, look_date, CAST(row_number() OVER (PARTITION BY scene ORDER BY look_date) AS INTEGER) AS place
    FROM (SELECT DISTINCT scene, look_date FROM v_pix WHERE valid) QUALIFY place <= 3""")
def c14_scene_picker(pix):
    """C14: the first looks of each scene in order of date."""
    looks = pix.where("valid").select("scene", "look_date").distinct()
    return looks.withColumn("place", F.row_number().over(Window.partitionBy("scene").orderBy("look_date"))).where("place <= 3")


REFUSALS = """WITH c AS (SELECT day, man.* FROM v_day d LEFT JOIN v_man man ON man.source <> 'MODIS' AND man.chunk_start <= d.day AND man.chunk_start + man.days - 1 >= d.day - 1)
  SELECT day, CASE WHEN count(source) = 0 THEN 'no fetch' WHEN count(*) FILTER (WHERE outcome IN ('fetched', 'cached')) = 0 THEN 'no success'
    WHEN count(*) FILTER (WHERE outcome IN ('fetched', 'cached') AND utc >= CAST(day AS TIMESTAMP) + INTERVAL 15 HOUR) = 0 THEN 'too early' END AS refusal,
    coalesce(count(*) FILTER (WHERE outcome = 'failed'), 0) AS failed FROM c GROUP BY day"""


@query("v_man", "v_day", sql=REFUSALS)
def c18_refusal(man, day):
    """Why a day can't be published, or null: no fetch covers it, none succeeded, all ran before it closed."""
    return provenance.refusals(man.where("source <> 'MODIS'"), day)


@query("v_man", "v_day", "v_src", "v_det", sql="""WITH n AS (SELECT s.source, d.date_wit AS day, count(*) AS n
    FROM v_det d JOIN v_src s ON s.satellite = d.satellite GROUP BY ALL),
  c AS (SELECT s.source, y.day, count(m.source) AS covering, count(*) FILTER (WHERE m.outcome = 'failed') AS failed
    FROM v_src s CROSS JOIN v_day y LEFT JOIN v_man m ON m.source = s.source AND m.chunk_start <= y.day AND m.chunk_start + m.days - 1 >= y.day - 1
    GROUP BY ALL)
  SELECT c.source, c.day, coalesce(n.n, 0) AS detections, CASE WHEN n.n > 0 THEN 'observed' WHEN covering = 0 THEN 'norecord'
    WHEN failed > 0 THEN 'failed' ELSE 'empty' END AS status FROM c LEFT JOIN n USING (source, day)""")
def e7_source_status(man, day, src, det):
    """Per source and day, detections, or which kind of nothing."""
    counts = det.join(src, "satellite").groupBy("source", F.col("date_wit").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return provenance.source_status(man, src.select("source").crossJoin(day), counts)


@query("v_man", "v_day", sql="""SELECT day, bool_or(m.source IS NOT NULL AND m.source <> 'MODIS') AS viirs, bool_or(coalesce(m.source,
    '') = 'MODIS') AS modis, bool_or(m.source IS NOT NULL AND m.source <> 'MODIS') AND bool_or(coalesce(m.source, '') = 'MODIS') AS all_groups
  FROM v_day d LEFT JOIN v_man m ON m.outcome IN ('fetched', 'cached') AND m.utc >= CAST(d.day AS TIMESTAMP) + INTERVAL 15 HOUR AND m.chunk_start <= d.day AND m.chunk_start + m.days - 1 >= d.day - 1
    GROUP BY day""")
def e8_e9_observed_days(man, day):
    """Days that a successful fetch covered after their close, by group of sources and for all groups."""
    return provenance.observed_days(man, day)


@query("v_man", "v_day", sql="""SELECT max(day) AS newest FROM v_day d WHERE EXISTS (SELECT 1 FROM v_man m WHERE m.outcome IN ('fetched',
    'cached') AND m.utc >= CAST(d.day AS TIMESTAMP) + INTERVAL 15 HOUR AND m.chunk_start <= d.day AND m.chunk_start + m.days - 1 >= d.day - 1)""")
def e8_newest_closed_day(man, day):
    """The newest day that is over and was observed."""
    return provenance.observed_days(man, day).where("viirs or modis").agg(F.max("day").alias("newest"))


@query("v_man", "v_day", sql="""WITH d AS (SELECT s.source, y.day, bool_or(m.outcome IN ('fetched', 'cached')) AS ok
    FROM (SELECT DISTINCT source FROM v_man) s CROSS JOIN v_day y LEFT JOIN v_man m ON m.source = s.source AND y.day BETWEEN m.chunk_start AND m.chunk_start + m.days - 1
    GROUP BY ALL),
  g AS (SELECT *, coalesce(ok, false) AS served, day - CAST(row_number() OVER (PARTITION BY source, coalesce(ok, false)
    ORDER BY day) AS INTEGER) AS island FROM d),
  r AS (SELECT source, served, min(day) AS first_day, count(*) AS days FROM g GROUP BY source, served, island)
  SELECT source, served, CAST(first_day + CAST(o AS INTEGER) AS DATE) AS chunk_start, CAST(least(CASE WHEN served THEN 5 ELSE days END,
    days - o) AS INTEGER) AS days FROM r, unnest(CASE WHEN served THEN range(0, days, 5) ELSE [0::BIGINT] END) AS u(o)""")
def l8_backfill_plan(man, day):
    """Runs of days that a source serves, cut into chunks of five; runs that none serves are gaps, kept whole."""
    return provenance.backfill_plan(man, day, 5)


@query("v_man", sql="SELECT source, chunk_start FROM v_man WHERE outcome = 'failed'")
def l9_b14_work_list(man):
    """What to fetch again: asked for, and neither got nor known to be absent upstream (an anti join)."""
    return man.select("source", "chunk_start", "utc").join(man.where("outcome <> 'failed'").select("source", "chunk_start", "utc"), ["source", "chunk_start", "utc"], "left_anti").select("source", "chunk_start")


@query("v_det", sql="""WITH c AS (SELECT unnest(generate_series(min(date_wit), max(date_wit), INTERVAL 1 DAY))::DATE AS day
    FROM v_det) SELECT c.day, count(d.detection_id) AS n FROM c LEFT JOIN v_det d ON d.date_wit = c.day AND d.instrument = 'MODIS' AND d.frp > 60
    GROUP BY c.day""")
def d12_b8_dense_days(det):
    """A count for every day of the span, zeros included."""
    return ingest.dense_daily(det.where("instrument = 'MODIS' and frp > 60"), det.agg(F.min("date_wit").alias("lo"), F.max("date_wit").alias("hi")))


@query("v_det", sql="SELECT extract(year FROM date_wit)::INTEGER AS year, satellite, count(*) AS n FROM v_det GROUP BY ALL")
def e1_counts(det):
    """E1."""
    return det.groupBy(F.year("date_wit").alias("year"), "satellite").agg(F.count(F.lit(1)).alias("n"))


@query("v_det", sql="SELECT date_wit AS peak_day, count(*) AS n FROM v_det GROUP BY date_wit ORDER BY n DESC, peak_day LIMIT 1")
def f8_peak_day(det):
    """F8: the day with the most, the first of several."""
    return det.groupBy("date_wit").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "date_wit").limit(1).withColumnRenamed("date_wit", "peak_day")


@query("v_det", "v_adm", sql=f"SELECT x.detection_id, h.adm_id, h.adm_id IS NOT NULL AS on_land FROM v_det x LEFT JOIN {ON_ADM} h USING (detection_id)")
def d1_point_in_polygon(det, adm):
    """D1."""
    return geo.assign_polygon(det, with_ring(adm), "detection_id").select("detection_id", "adm_id", "on_land")


@query("v_det", "v_adm", sql=f"""SELECT a.kabupaten, a.distrik, count(x.detection_id) AS n, round(sum(x.frp), 2) AS frp_sum, max(x.frp) AS frp_max
    FROM v_adm a LEFT JOIN {ON_ADM} h USING (adm_id) LEFT JOIN v_det x USING (detection_id) GROUP BY ALL""")
def e2_d13_district_rollup(det, adm):
    """Every district, zero or not; the power of none stays null."""
    inside = geo.assign_polygon(det, with_ring(adm), "detection_id").where("on_land")
    return ingest.district_rollup(inside, adm)


@query("v_det", sql="""WITH u AS (SELECT *, 0 AS prio, detection_id AS o FROM v_det WHERE satellite IN ('N', 'N20', 'Terra')
    UNION ALL BY NAME SELECT detection_id - detection_id % 2 AS detection_id, satellite, frp, 1 AS prio, detection_id AS o
    FROM v_det WHERE satellite <> 'N') SELECT detection_id, satellite, frp, prio FROM u QUALIFY row_number() OVER (PARTITION BY detection_id
    ORDER BY prio, o) = 1""")
def g1_g2_merge_keep_first(det):
    """New rows, some columns short, are added to a store; a row that is there stays."""
    new = det.where("satellite <> 'N'").select((F.col("detection_id") - F.col("detection_id") % 2).alias("detection_id"), "satellite", "frp", F.col("detection_id").alias("o"))
    return ingest.merge_keep_first(det.where(F.col("satellite").isin("N", "N20", "Terra")).withColumn("o", F.col("detection_id")), new, "detection_id", "o").select("detection_id", "satellite", "frp", "prio")


@query("v_det", sql="""SELECT count(DISTINCT satellite) AS satellites, count(DISTINCT datetime_utc) AS overpasses, (SELECT count(*)
    FROM (SELECT detection_id FROM v_det WHERE frp > 50 INTERSECT SELECT detection_id FROM v_det WHERE instrument = 'MODIS')) AS both_sets
    FROM v_det""")
def g4_g5_sets(det):
    """G4, G5."""
    both = det.where("frp > 50").select("detection_id").intersect(det.where("instrument = 'MODIS'").select("detection_id")).agg(F.count(F.lit(1)).alias("both_sets"))
    return det.agg(F.countDistinct("satellite").alias("satellites"), F.countDistinct("datetime_utc").alias("overpasses")).join(F.broadcast(both))


@query("v_det", sql="SELECT detection_id, frp FROM v_det WHERE frp IS NOT NULL ORDER BY frp DESC, detection_id LIMIT 12")
def g6_g7_brightest(det):
    """The brightest, in a total order."""
    return det.where("frp is not null").orderBy(F.desc("frp"), "detection_id").select("detection_id", "frp").limit(12)


@query("v_det", sql="""SELECT detection_id FROM (SELECT detection_id, row_number() OVER (ORDER BY datetime_utc, detection_id) AS r
    FROM v_det WHERE instrument = 'MODIS') WHERE r % 25 = 1 ORDER BY r LIMIT 40""")
def g9_stride_sample(det):
    """Every 25th in order of time, up to 40 (the sample asked for)."""
    return ingest.stride(det.where("instrument = 'MODIS'"), ["datetime_utc", "detection_id"], 25, 40).select("detection_id")


@query("v_det", sql="""SELECT detection_id, '{"geometry":{"coordinates":[' || printf('%.5f', longitude) || ',' || printf('%.5f', latitude) || '],"type":"Point"},"properties":{"day":"' || strftime(date_wit,
    '%Y-%m-%d') || '"' || CASE WHEN frp IS NULL THEN '' ELSE ',"frp":"' || printf('%.2f', frp) || '"' END || ',"satellite":"' || satellite || '"},"type":"Feature"}' AS feature
    FROM v_det""")
def b3_b4_geojson(det):
    """Features with sorted keys, rounded coordinates, ISO days, and nulls left out."""
    return ingest.point_features(det)


@query("v_det", sql="""WITH d AS (SELECT date_wit, count(*) AS n, round(coalesce(sum(frp), 0), 2) AS f, string_agg(DISTINCT satellite,
    '+' ORDER BY satellite) AS s FROM v_det GROUP BY date_wit) SELECT date_wit, '- **' || strftime(date_wit, '%Y-%m-%d') || '**: ' || n || ' detections, ' || printf('%.2f',
    f) || ' MW (' || s || ')' AS line FROM d""")
def b6_b7_markdown(det):
    """One line a day, satellites in order."""
    d = det.groupBy("date_wit").agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("frp"), F.lit(0.0)), 2).alias("f"), F.array_join(F.array_sort(F.collect_set("satellite")), "+").alias("s"))
    return d.select("date_wit", F.format_string("- **%s**: %d detections, %.2f MW (%s)", F.date_format("date_wit", "yyyy-MM-dd"), "n", "f", "s").alias("line"))


@query("v_det", sql="""WITH t AS (SELECT detection_id, longitude, latitude, row_number() OVER (ORDER BY frp DESC, detection_id) AS r
    FROM v_det WHERE frp IS NOT NULL ORDER BY r LIMIT 10) SELECT 'https://www.google.com/maps/dir/' || string_agg(printf('%.5f,%.5f',
    latitude, longitude), '/' ORDER BY r) AS url, count(*) AS stops FROM t""")
def b10_h34_route_url(det):
    """A route over the first ten stops."""
    top = det.where("frp is not null").orderBy(F.desc("frp"), "detection_id").limit(10)
    return top.agg(ingest.route_url().alias("url"), F.count(F.lit(1)).alias("stops"))


@query("v_det", "v_hist", sql="""SELECT (SELECT count(*) FROM v_det) AS season, (SELECT count(*) FROM v_hist) AS history, (SELECT count(*)
    FROM (SELECT date_wit FROM v_hist GROUP BY date_wit HAVING count(*) > 5)) AS busy_days""")
def b9_b13_headline(det, hist):
    """Figures of several tables in one row."""
    season = det.agg(F.count(F.lit(1)).alias("season"))
    busy = hist.groupBy("date_wit").count().where("count > 5").agg(F.count(F.lit(1)).alias("busy_days"))
    return season.join(F.broadcast(hist.agg(F.count(F.lit(1)).alias("history")))).join(F.broadcast(busy))


@query("v_det", sql="SELECT CAST(epoch(time_bucket(INTERVAL 10 MINUTE, datetime_utc)) AS BIGINT) AS slot, count(*) AS n FROM v_det GROUP BY ALL")
def l3_tumbling(det):
    """L3: ten-minute windows."""
    return det.groupBy(F.window(F.col("datetime_utc").cast("timestamp"), "10 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.unix_seconds("w.start").alias("slot"), "n")


@query("v_det", sql="SELECT CAST(date_wit + CAST(k AS INTEGER) AS DATE) AS day, count(*) AS n FROM v_det, range(0, 7) AS t(k) GROUP BY ALL")
def l4_sliding(det):
    """L4: for each day, what the seven days that end with it hold."""
    return det.select(F.explode(F.sequence(F.col("date_wit"), F.date_add("date_wit", 6))).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("v_det", sql="""WITH c AS (SELECT longitude, datetime_utc, CASE WHEN epoch(datetime_utc - lag(datetime_utc) OVER (PARTITION BY longitude
    ORDER BY datetime_utc)) >= 10800 THEN 1 ELSE 0 END AS new FROM v_det), g AS (SELECT *, sum(new) OVER (PARTITION BY longitude
    ORDER BY datetime_utc) AS g FROM c) SELECT round(longitude, 4) AS lon, CAST(epoch(date_trunc('second', min(datetime_utc))) AS BIGINT) AS started,
    count(*) AS n FROM g GROUP BY longitude, g""")
def l5_sessions(det):
    """Sessions of a place, parted by three hours without anything."""
    g = det.groupBy("longitude", F.session_window(F.col("datetime_utc").cast("timestamp"), "3 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.round("longitude", 4).alias("lon"), F.unix_seconds("w.start").alias("started"), "n")
