"""From raw rows to the store and to published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions.scalar import flat_metres


def cache_name(source: str, start: str, days: str) -> Column:
    """A4: one file a source, first day and length."""
    return F.format_string("%s_%s_%dd.csv", source, F.date_format(start, "yyyy-MM-dd"), days)


def refetch(start: str, days: str, today: Column) -> Column:
    """A4, L2: a chunk that reaches yesterday or later may still change."""
    return F.date_add(start, F.col(days) - 1) >= F.date_sub(today, 1)


def clip(df: DataFrame, bbox: tuple[float, float, float, float], lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """An inclusive box; a plain predicate, so it reaches the scan."""
    w, s, e, n = bbox
    return df.where(F.col(lon).between(w, e) & F.col(lat).between(s, n))


def normalise(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns to their types; text that isn't a value becomes null, NaN too, absent columns are added as null. Idempotent."""
    out = {}
    for c, t in types.items():
        v = F.expr(f"try_cast(`{c}` AS {t})") if c in df.columns else F.lit(None).cast(t)
        out[c] = F.nullif(v, F.lit(float("nan"))) if t in ("double", "float") else v
    return df.withColumns(out)


def last_days(df: DataFrame, day: str, n: int, col: str = "date_wit") -> DataFrame:
    """The ``n`` days that end with ``day``."""
    end = F.lit(day).cast("date")
    return df.where(F.col(col).between(F.date_sub(end, n - 1), end))


def constellation_split(df: DataFrame, kept: list[str], place: list[str], col: str = "satellite") -> DataFrame:
    """How many rows are outside ``kept``, and how many place-days only those rows have. One aggregate, no set operators."""
    cells = df.groupBy(*place).agg(F.bool_or(F.col(col).isin(*kept)).alias("seen"), F.count_if(~F.col(col).isin(*kept)).alias("out"))
    return cells.agg(F.coalesce(F.sum("out"), F.lit(0)).alias("excluded"), F.count_if(~F.col("seen")).alias("lost_cell_days"))


def dense_daily(df: DataFrame, span: DataFrame, col: str = "date_wit") -> DataFrame:
    """Counts of every day between ``span``'s ``lo`` and ``hi``; days without rows count 0."""
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.join(df.groupBy(F.col(col).alias("day")).agg(F.count(F.lit(1)).alias("n")), "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def district_rollup(inside: DataFrame, districts: DataFrame) -> DataFrame:
    """Count, sum and maximum of the power for every district; a district without rows has 0, null and null."""
    sums = inside.groupBy("adm_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("frp"), 2).alias("frp_sum"), F.max("frp").alias("frp_max"))
    return districts.select("adm_id", "kabupaten", "distrik").join(sums, "adm_id", "left").select("kabupaten", "distrik", F.coalesce("n", F.lit(0)).alias("n"), "frp_sum", "frp_max")


def merge_keep_first(store: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the store, then new ones; of one key the store's row stays, else the first in ``order``.

    Columns that a side lacks are null there. A minimum over (source, order) finds the row; the window sees one key at a time.
    """
    both = store.withColumn("prio", F.lit(0)).unionByName(new.withColumn("prio", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("prio", order))).where("place = 1").drop("place")


def stride(df: DataFrame, order: list[str], step: int, most: int) -> DataFrame:
    """Every ``step``-th row in order, at most ``most``; the limit is what is asked for."""
    n = step * (most - 1) + 1
    top = df.orderBy(*order).limit(n)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order))).where(F.col("place") % step == 1).orderBy("place").limit(most)


def feature(id_col: str, name: str, ring: Column) -> Column:
    """A GeoJSON polygon as text."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col(id_col).alias("id"), F.col(name).alias("name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry")))


FEATURE = "struct<properties:struct<id:int,name:string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>"


def parse_features(text: DataFrame, col: str = "value") -> DataFrame:
    """One row a polygon: its id, name, outer ring and box. Text that is no polygon is left out."""
    f = text.select(F.from_json(col, FEATURE).alias("f")).where(F.col("f.geometry.type") == "Polygon")
    f = f.select(F.col("f.properties.id").alias("adm_id"), F.col("f.properties.name").alias("distrik"), F.transform(F.col("f.geometry.coordinates")[0], lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring"))
    return f.select("*", F.array_min("ring.x").alias("w"), F.array_min("ring.y").alias("s"), F.array_max("ring.x").alias("e"), F.array_max("ring.y").alias("n"))


def point_features(df: DataFrame) -> DataFrame:
    """GeoJSON points; keys in order, coordinates with five decimals, absent values left out."""
    number = lambda c, p: F.format_string(p, c)
    props = F.to_json(F.struct(F.date_format("date_wit", "yyyy-MM-dd").alias("day"), F.when(F.col("frp").isNotNull(), number("frp", "%.2f")).alias("frp"), "satellite"))
    text = F.concat(F.lit('{"geometry":{"coordinates":['), number("longitude", "%.5f"), F.lit(","), number("latitude", "%.5f"), F.lit('],"type":"Point"},"properties":'), props, F.lit(',"type":"Feature"}'))
    return df.select("detection_id", text.alias("feature"))


def route_url() -> Column:
    """An aggregate over the stops, brightest first."""
    stops = F.sort_array(F.collect_list(F.struct((-F.col("frp")).alias("f"), "detection_id", F.format_string("%.5f,%.5f", "latitude", "longitude").alias("at"))))
    return F.concat(F.lit("https://www.google.com/maps/dir/"), F.array_join(stops["at"], "/"))


def read_detections(spark, folder: str) -> DataFrame:
    """Detection files with or without the columns that vary by instrument, all as text, then typed.

    Each file's own first line names its columns (there are a handful of different ones), so a column that some
    files lack is null there. Rows without coordinates or a time are kept and flagged, not dropped.
    """
    from pyrelith.functions.scalar import acquisition_time, stable_id

    names = {tuple(line.value.split(",")) for line in spark.read.text(folder).where(F.col("value").startswith("latitude")).distinct().collect()}
    files = spark.read.text(folder).where(~F.col("value").startswith("latitude")).select("value", F.col("_metadata.file_path").alias("file"))
    heads = spark.read.text(folder).where(F.col("value").startswith("latitude")).select(F.col("value").alias("head"), F.col("_metadata.file_path").alias("file"))
    pairs = files.join(heads, "file").select("file", F.map_from_arrays(F.split("head", ","), F.split("value", ",")).alias("m"))
    raw = pairs.select("file", *[F.col("m").getItem(c).alias(c) for c in dict.fromkeys(c for n in sorted(names) for c in n)])
    raw = normalise(raw, {"latitude": "double", "longitude": "double", "frp": "double"})
    at = acquisition_time("acq_date", "acq_time")
    return raw.withColumns({"datetime_utc": at, "detection_id": stable_id("satellite", "instrument", "acq_date", "acq_time", "latitude", "longitude"), "usable": F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & at.isNotNull()})


def known_event(df: DataFrame, since: str | None = None, until: str | None = None, circle: tuple[float, float, float] | None = None) -> DataFrame:
    """Rows of a known event: local days from ``since`` to ``until`` (both included), within a circle ``(lat, lon, metres)``; what is None doesn't limit."""
    cond = F.lit(True)
    if since:
        cond = cond & (F.col("date_wit") >= F.lit(since).cast("date"))
    if until:
        cond = cond & (F.col("date_wit") <= F.lit(until).cast("date"))
    if circle:
        lat, lon, metres = circle
        cond = cond & (flat_metres(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude")) <= metres)
    return df.where(cond)


def escaped(text: Column) -> Column:
    """Text as XML holds it."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for raw, name in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(name))
    return out


def gpx_waypoint(lat: Column, lon: Column, name: Column, about: Column) -> Column:
    """One waypoint of a GPX file."""
    return F.concat(F.format_string('<wpt lat="%.6f" lon="%.6f"><name>', lat, lon), escaped(name), F.lit("</name><desc>"), escaped(about), F.lit("</desc></wpt>"))


def map_link(lat: Column, lon: Column) -> Column:
    """A link that searches a map for a place."""
    return F.format_string("https://www.google.com/maps/search/?api=1&query=%.6f,%.6f", lat, lon)
