import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from pavelens.operators import lidar
from pavelens.sources import config, geopackage, las, meta, tiff
from pavelens.streaming.tiles import process_tiles


def test_settings():
    s = config.parse({"EPSG": "EPSG:25832", "Factors": {"a": {"sm4l_m": {"A": [1, 2, 3]}}}, "recordings": {"ID": "i", "time": "t", "direction": "d", "height": "h", "pitch": None}})
    assert s.factors["A"]["SM4L_M"]["A"] == (1, 2, 3) and s.factors["A"]["MSPT"]["B"] == (4, 15, 25) and s.recordings.pitch is None and s.recordings.id_base == 36
    assert ("P", "OFS", "N", 5.0, 25.0, 40.0) in s.factor_rows()
    for bad in ({"epsg": "utm32"}, {"id_mode": "x"}, {"recordings": {"id": "i"}}, {"factors": {"A": {"MSPT": {"A": [3, 2, 1]}}}}):
        with pytest.raises(ValueError):
            config.parse(bad)
    with pytest.warns(UserWarning):
        config.parse({"typo": 1})


def test_geopackage_round_trip(spark, tmp_path):
    rows = [(i, f"n{i}", i / 3, g) for i, g in enumerate(["POINT (1.0 2.0)", "LINESTRING (0.0 0.0, 1.5 1.0)", "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 0.5, 2.0 0.5, 2.0 1.0, 1.0 0.5))", "MULTIPOLYGON (((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0)), ((5.0 5.0, 6.0 5.0, 6.0 6.0, 5.0 5.0)))", None, "POLYGON EMPTY"])]
    df = spark.createDataFrame(rows, "id long, name string, v double, geometry string")
    assert geopackage.write_geopackage(df, str(tmp_path / "a.gpkg"), "areas") == 6
    spark.dataSource.register(geopackage.GeoPackageSource)
    got = spark.read.format("pavelens_gpkg").option("partitions", 3).load(str(tmp_path / "a.gpkg")).orderBy("id").collect()
    assert [tuple(r) for r in got] == rows[:5] + [(5, "n5", 5 / 3, None)]
    geopackage.write_geopackage(df.limit(0), str(tmp_path / "b.gpkg"), "areas")
    assert spark.read.format("pavelens_gpkg").load(str(tmp_path / "b.gpkg")).count() == 0


def test_las_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(y), float(z), i % 65536, i % 5 + 1, 5, 1, 0, i % 32, float(i % 90), 3, i % 1000, i / 7, i, 2, 3) for i, (x, y, z) in enumerate(np.round(rng.uniform(0, 120, (300, 3)), 3))]
    df = lidar.retile(spark.createDataFrame(rows, las.SCHEMA))
    files = las.write_las(df, str(tmp_path / "tiles")).collect()
    assert sum(r["points"] for r in files) == 300
    spark.dataSource.register(las.LasSource)
    back = spark.read.format("pavelens_las").load(str(tmp_path / "tiles")).orderBy("gps_time").collect()
    for a, b in zip(rows, back):
        assert np.allclose(a[:3], b[:3], atol=6e-4) and tuple(a[3:12]) == tuple(b[3:12]) and a[13:] == tuple(b[13:])
    (tmp_path / "x.las").write_bytes(b"nothing")
    with pytest.raises(Exception, match="no LAS file"):
        spark.read.format("pavelens_las").load(str(tmp_path / "x.las")).count()


def test_meta_and_done(spark, tmp_path):
    (tmp_path / "run" / "a").mkdir(parents=True)
    (tmp_path / ".hidden").mkdir()
    image = {"sensor_id": "ladybug_front", "path": "i.jpg", "time_stamp": 1715001968.5, "pose": {"translation": [1, 2, 3], "orientation_roll_pitch_yaw": [0, -1.5707963267948966, 3.141592653589793]}}
    text = json.dumps({"spherical_images": [image, image | {"sensor_id": "back"}, image], "point_clouds": [{"sensor_id": "CPS", "path": "p.laz", "bounding_box": {"min": [0, 1, 2], "max": [3, 4, 5]}}]})
    (tmp_path / "run/a/meta.json").write_text(text)
    (tmp_path / ".hidden/meta.json").write_text(text)
    r = meta.recording_points(spark, str(tmp_path)).orderBy("image_no").collect()
    assert [x["image_no"] for x in r] == [0, 2] and r[0]["recorded_at"] == "2024-05-06T15:26:08.500000" and abs(r[0]["pitch"]) < 1e-9 and abs(r[0]["direction"] - 180) < 1e-9
    assert tuple(meta.cloud_extents(spark, str(tmp_path)).first())[2:] == (0, 1, 3, 4)
    index = str(tmp_path / "done")
    assert meta.read_done(spark, index).count() == 0
    for _ in range(2):
        meta.mark_done(spark.createDataFrame([("1_2",), ("3_4",)], "tile_id string"), index)
    assert meta.read_done(spark, index).count() == 2 and spark.read.parquet(index).count() == 2


def test_tiff():
    b = tiff.tiff_bytes(np.arange(24, dtype=np.uint16).reshape(2, 3, 4), 100.0, 200.0, 0.5)
    at = struct.unpack_from("<I", b, 4)[0]
    tags = {t[0]: t for t in (struct.unpack_from("<HHI4s", b, at + 2 + 12 * k) for k in range(struct.unpack_from("<H", b, at)[0]))}
    start = struct.unpack("<I", tags[273][3])[0]
    assert np.frombuffer(b[start:], "<u2").tolist() == list(range(24)) and list(tags) == sorted(tags)
    with pytest.raises(ValueError):
        tiff.tiff_bytes(np.zeros((2, 2)), 0, 0, 1)


def test_stream_of_tiles(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    work = lambda d: d.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    spark.range(10).selectExpr("id % 2 as t").write.parquet(src)
    process_tiles(spark, src, "t long", work, out, cp)
    spark.range(4).selectExpr("7L as t").write.mode("append").parquet(src)
    process_tiles(spark, src, "t long", work, out, cp)  # only what is new
    assert {r["t"]: r["n"] for r in spark.read.parquet(out).groupBy("t").agg(F.sum("n").alias("n")).collect()} == {0: 5, 1: 5, 7: 4}
