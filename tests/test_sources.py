"""File formats made by hand and read back."""

import bz2
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from pyrelith.operators import ingest
from pyrelith.operators.sites import douglas_peucker, match_registry
from pyrelith.sources import files
from pyrelith.sources.listing import ChunkFolder


def segment_bytes(grid, band=7, segment=6):
    head = bytearray(1500)
    struct.pack_into("<I", head, 70, len(head))
    struct.pack_into("<HH", head, 287, grid.shape[1], grid.shape[0])
    struct.pack_into("<H", head, 601, band)
    struct.pack_into("<d", head, 603, 3.9)
    struct.pack_into("<HHdddddd", head, 613, 65535, 65534, -0.0037, 15.2, 0.1, 1.0, 0.0, 0.0)
    head[1008] = segment
    struct.pack_into("<H", head, 1009, 2751)
    return bytes(head) + grid.astype("<u2").tobytes()


def test_satellite_segments(spark, tmp_path):
    grid = np.arange(12).reshape(3, 4) + 100
    grid[1, 2], grid[2, 3] = 65535, 65534
    (tmp_path / "a.DAT").write_bytes(segment_bytes(grid))
    (tmp_path / "b.DAT.bz2").write_bytes(bz2.compress(segment_bytes(grid + 1, 14)))
    rows = files.segments(spark, str(tmp_path)).collect()
    assert len(rows) == 24 and {r.band for r in rows} == {7, 14}
    a = {(r.line, r.col): r["count"] for r in rows if r.band == 7}
    assert a[2751, 1] == 100 and a[2752, 3] is None and a[2753, 4] is None and rows[0].gain == -0.0037


@pytest.mark.parametrize("order,code", [("<", 1), (">", 0)])
@pytest.mark.parametrize("envelope", [0, 1, 2, 4])
def test_geometry_blobs(spark, order, code, envelope):
    wkb = bytes([code]) + struct.pack(f"{order}I2d", 1, 136.1, -1.2)
    blob = b"GP\x00" + bytes([envelope << 1]) + struct.pack("<i", 4326) + bytes(files.ENVELOPES[envelope]) + wkb
    assert files.wkb_point(files.gpkg_geometry(blob)) == (136.1, -1.2)
    if envelope == 1:
        d = spark.createDataFrame([(1, bytearray(blob)), (2, None)], "id int, geom binary")
        assert [(r.x, r.y) for r in files.gpkg_points(d).orderBy("id").collect()] == [(136.1, -1.2), (None, None)]
    with pytest.raises(ValueError):
        files.gpkg_geometry(b"xx")


def test_detection_files_with_different_columns(spark, tmp_path):
    (tmp_path / "A_2024-01-01_1d.csv").write_text("latitude,longitude,bright_ti4,acq_date,acq_time,satellite,instrument,frp\n-1.1,136.2,300,2024-01-01,627,N,VIIRS,3.5\nx,136.2,300,2024-01-01,627,N,VIIRS,\n")
    (tmp_path / "B_2024-01-02_1d.csv").write_text("latitude,longitude,brightness,acq_date,acq_time,satellite,instrument,frp,type\n-1.2,136.3,310,2024-01-02,5,Terra,MODIS,7,0\n")
    rows = {(r.satellite, r.usable): r for r in ingest.read_detections(spark, str(tmp_path)).collect()}
    assert set(rows) == {("N", True), ("N", False), ("Terra", True)}
    assert rows["Terra", True].bright_ti4 is None and rows["N", True].type is None and rows["N", True].datetime_utc.hour == 6 and rows["N", False].frp is None


def test_chunk_source_opens_only_the_day_asked_for(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        (tmp_path / f"S_{day}_1d.csv").write_text(f"h\n{day},a\n\n{day},b\n")
    spark.dataSource.register(ChunkFolder)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    d = spark.read.format("chunks").load(str(tmp_path))
    assert d.count() == 4
    assert [r.value for r in d.where(F.col("day") == "2024-01-02").orderBy("line").collect()] == ["2024-01-02,a", "2024-01-02,b"]


def test_simplify_and_registry(spark):
    assert douglas_peucker([(0, 0), (1, 0.001), (2, 0), (2, 2)], 0.01) == [(0, 0), (2, 0), (2, 2)]
    found = spark.createDataFrame([(5, 0.0, 0.0), (9, 0.001, 0.0), (2, 3.0, 3.0)], "n long, lat double, lon double")
    known = spark.createDataFrame([("R001", 0.0, 0.0)], "site_id string, lat double, lon double")
    got = {r.n: (r.site_id, r.new) for r in match_registry(found, known, 750.0, 8).collect()}
    assert got == {9: ("R001", False), 5: ("R008", True), 2: ("R009", True)}
    assert match_registry(found, known.limit(0), 750.0, 8).where("new").count() == 3


def test_roads_and_weather_text(spark):
    d = spark.createDataFrame([('{"elements":[{"id":1,"type":"way","tags":{"highway":"primary"},"geometry":[{"lat":0,"lon":0},{"lat":1,"lon":1}]},{"id":2,"type":"way","tags":{"highway":"footway"},"geometry":[{"lat":0,"lon":0},{"lat":1,"lon":1}]},{"id":3,"type":"node"}]}',), ("bad",)], "value string")
    assert [(r.id, r.cls, r.pos) for r in files.road_lines(d).orderBy("pos").collect()] == [(1, "main", 0), (1, "main", 1)]
    w = spark.createDataFrame([('{"rows":[{"cell":"a","date":"2024-01-01","t":30,"dew":30,"rain":1,"rain_n":24,"tmax":31,"tmax_n":24},{"cell":"a","date":"2024-01-02","t":null,"rain_n":24,"tmax_n":24}]}',)], "value string")
    rows = files.weather_archive(w).orderBy("date").collect()
    assert rows[0].valid and rows[0].rh == pytest.approx(100) and not rows[1].valid and rows[1].rh is None
