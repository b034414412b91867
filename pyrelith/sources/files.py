"""File formats: station reports, weather archives, road extracts, satellite segments, geometry blobs. Fetching is left to others."""

from __future__ import annotations

import bz2
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrelith.functions.scalar import relative_humidity


def station_reports(text: DataFrame, col: str = "value") -> DataFrame:
    """Lines of ``station,valid,drct,sknt,vsby,wxcodes`` (as text; sentinels stay) to columns; header and comment lines are left out."""
    parts = F.split(F.col(col), ",")
    lines = text.where(~F.col(col).startswith("#") & ~F.col(col).startswith("station") & (F.size(parts) >= 6))
    return lines.select(*[F.nullif(parts[i], F.lit("")).alias(n) for i, n in enumerate(("station", "valid", "drct", "sknt", "vsby", "wxcodes"))]).withColumn("valid_utc", F.try_to_timestamp("valid", F.lit("yyyy-MM-dd HH:mm")))


def report_fault(body: Column) -> Column:
    """What is wrong with a year's answer, or null: a web page, no header, no rows."""
    return F.when(F.lower(F.substring(F.ltrim(body), 1, 1)) == "<", "a web page").when(~body.contains("station,valid"), "no header").when(F.size(F.filter(F.split(body, "\n"), lambda x: F.length(F.trim(x)) > 0)) < 2, "no rows")


def year_chunks(first: Column, today: Column) -> Column:
    """Years from the first to the current one, each with its first and last day to ask for."""
    years = F.sequence(F.year(first), F.year(today))
    return F.transform(years, lambda y: F.struct(y.alias("year"), F.greatest(F.make_date(y, F.lit(1), F.lit(1)), first).alias("since"), F.least(F.make_date(y, F.lit(12), F.lit(31)), today).alias("until")))


WEATHER = "struct<rows:array<struct<cell:string,date:string,t:double,dew:double,rain:double,rain_n:int,tmax:double,tmax_n:int>>>"


def weather_archive(text: DataFrame, col: str = "value") -> DataFrame:
    """A10: a month's JSON to rows; a day is valid if all 24 hours of rain and temperature were there and noon was."""
    r = text.select(F.explode(F.from_json(col, WEATHER)["rows"]).alias("r")).select("r.*")
    valid = (F.col("rain_n") == 24) & (F.col("tmax_n") == 24) & F.col("t").isNotNull()
    return r.withColumn("date", F.to_date("date")).withColumn("valid", F.coalesce(valid, F.lit(False))).withColumn("rh", relative_humidity(F.col("t"), F.col("dew")))


ROADS = "struct<elements:array<struct<id:bigint,type:string,tags:map<string,string>,geometry:array<struct<lat:double,lon:double>>>>>"
#: Classes of the public map that count, by what they are called here.
ROAD_CLASSES = {"motorway": "main", "trunk": "main", "primary": "main", "secondary": "main", "tertiary": "minor", "unclassified": "minor", "residential": "minor", "service": "minor", "track": "track", "path": "path", "footway": "path"}


def road_class(tag: Column) -> Column:
    """A class, null for those that aren't known."""
    return F.create_map(*[F.lit(x) for kv in ROAD_CLASSES.items() for x in kv])[tag]


def road_lines(text: DataFrame, col: str = "value", skip: tuple[str, ...] = ("footway",)) -> DataFrame:
    """Ways with at least two vertices and a class that isn't skipped, one row a vertex."""
    e = text.select(F.explode(F.from_json(col, ROADS)["elements"]).alias("e")).where((F.col("e.type") == "way") & (F.size("e.geometry") >= 2))
    e = e.select("e.id", F.col("e.tags")["highway"].alias("tag"), F.posexplode("e.geometry").alias("pos", "p"))
    return e.where(~F.col("tag").isin(*skip)).select("id", road_class(F.col("tag")).alias("cls"), "pos", F.col("p.lon").alias("x"), F.col("p.lat").alias("y"))


#: Bytes of an envelope by its code.
ENVELOPES = (0, 32, 48, 48, 64)


def gpkg_geometry(blob: bytes) -> bytes:
    """The well-known binary inside a GeoPackage blob."""
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    return blob[8 + ENVELOPES[(blob[3] >> 1) & 7] :]


def wkb_point(wkb: bytes) -> tuple[float, float]:
    """Coordinates of a point in either byte order."""
    order = "<" if wkb[0] else ">"
    if struct.unpack(f"{order}I", wkb[1:5])[0] % 1000 != 1:
        raise ValueError("not a point")
    return struct.unpack(f"{order}2d", wkb[5:21])


def gpkg_points(df: DataFrame, col: str = "geom") -> DataFrame:
    """Points of a layer's rows; null stays null."""

    @F.pandas_udf("x double, y double")
    def decode(blobs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if b is None else wkb_point(gpkg_geometry(bytes(b))) for b in blobs], columns=["x", "y"])

    return df.withColumn("p", decode(col)).select("*", "p.x", "p.y").drop("p")


SEGMENT = "path string, band int, segment int, first_line int, gain double, offset double, c0 double, c1 double, c2 double, wavelength double, line int, col int, count int"


def read_segment(raw: bytes) -> tuple[dict, np.ndarray]:
    """Header fields at their places (little-endian) and the grid of counts."""
    if raw[:3] == b"BZh":
        raw = bz2.decompress(raw)

    def at(fmt: str, place: int):
        return struct.unpack_from(f"<{fmt}", raw, place)[0]

    cols, lines = at("H", 287), at("H", 289)
    header = {"start": at("I", 70), "band": at("H", 601), "wavelength": at("d", 603), "error": at("H", 613), "outside": at("H", 615), "gain": at("d", 617), "offset": at("d", 625), "c0": at("d", 633), "c1": at("d", 641), "c2": at("d", 649), "segment": raw[1008], "first_line": at("H", 1009)}
    return header, np.frombuffer(raw, dtype="<u2", count=lines * cols, offset=header["start"]).reshape(lines, cols)


def segment_bytes(grid: np.ndarray, band: int, segment: int = 1, first_line: int = 1, gain: float = -0.0037, offset: float = 15.2) -> bytes:
    """A segment file of the same layout: a header of 1,500 bytes and the counts (65535 is an error, 65534 lies outside)."""
    head = bytearray(1500)
    struct.pack_into("<I", head, 70, len(head))
    struct.pack_into("<HH", head, 287, grid.shape[1], grid.shape[0])
    struct.pack_into("<H", head, 601, band)
    struct.pack_into("<d", head, 603, 3.9)
    struct.pack_into("<HHddddd", head, 613, 65535, 65534, gain, offset, 0.0, 1.0, 0.0)
    head[1008] = segment
    struct.pack_into("<H", head, 1009, first_line)
    return bytes(head) + grid.astype("<u2").tobytes()


def decode_segments(blobs: DataFrame) -> DataFrame:
    """Pixels of segments ``(path, content)``; invalid counts are null. A task holds one segment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                h, grid = read_segment(bytes(content))
                line, col = np.indices(grid.shape)
                count = pd.array(grid.ravel().astype("int64"), dtype="Int64")
                count[(grid.ravel() == h["error"]) | (grid.ravel() == h["outside"])] = pd.NA
                keys = {k: h[k] for k in ("band", "segment", "first_line", "gain", "offset", "c0", "c1", "c2", "wavelength")}
                yield pd.DataFrame({"path": path, **keys, "line": line.ravel() + h["first_line"], "col": col.ravel() + 1, "count": count})

    return blobs.select("path", "content").mapInPandas(run, SEGMENT)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Pixels of all segment files of a folder."""
    return decode_segments(spark.read.format("binaryFile").load(folder))
