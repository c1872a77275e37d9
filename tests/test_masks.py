import numpy as np
import pytest
from pyspark.sql import functions as F

from pavelens.functions import scalars
from pavelens.operators import lidar, markings, polygons, raster, relational
from pavelens.sources import cache, config, images, las, meta
from pavelens.streaming import tiles as streams


def _regions(mask, diagonal):
    """Lists of cells of equal non-zero value that touch, by flooding."""
    seen, out = np.zeros(mask.shape, bool), []
    for y, x in zip(*np.nonzero(mask)):
        if seen[y, x]:
            continue
        todo, cells = [(y, x)], []
        seen[y, x] = True
        while todo:
            a, b = todo.pop()
            cells.append((a, b))
            for c in range(max(0, a - 1), min(mask.shape[0], a + 2)):
                for d in range(max(0, b - 1), min(mask.shape[1], b + 2)):
                    if not seen[c, d] and mask[c, d] == mask[y, x] and (diagonal or c == a or d == b):
                        seen[c, d] = True
                        todo.append((c, d))
        out.append(cells)
    return out


def test_markings_from_masks(spark):
    rng = np.random.default_rng(2)
    rows, want = [], []
    for t in range(6):
        types = (rng.integers(0, 6, (9, 12)) * (rng.random((9, 12)) < 0.5)).astype(np.uint8)
        cond = rng.integers(0, 4, (9, 12)).astype(np.uint8) * (t > 0)
        merged = np.where(types == 2, 1, np.where(types == 4, 3, types))
        for cells in _regions(merged, True):
            own, state = np.bincount([types[c] for c in cells], minlength=9), np.bincount([cond[c] for c in cells], minlength=4)
            if state[1:].sum():
                good, mid, bad = 100.0 * state[1:4] / state[1:].sum()
                zustand = "schlecht" if bad >= 25 else "mittel" if mid + bad >= 25 else "gut"
                want.append((f"t{t}", markings.TYPES[int(own.argmax()) - 1], zustand, round(good, 6), round(mid, 6), round(bad, 6), float(len(cells))))
        rows.append((f"t{t}", "0", 100.0, 209.0, 9, 12, bytearray(types.tobytes()), bytearray(cond.astype(np.uint8).tobytes())))
    df = spark.createDataFrame(rows, "tile_id string, ebene string, x0 double, y1 double, height int, width int, types binary, conditions binary").withColumn("typ", F.lit("clash"))
    got = polygons.polygon_areas(raster.markings_from_masks(df.select("tile_id", "ebene", "x0", "y1", "height", "width", "types", "conditions"), 1.0), ["tile_id", "typ", "zustand", "gut", "mittel", "schlecht"])
    have = sorted((r["tile_id"], r["typ"], r["zustand"], round(r["gut"], 6), round(r["mittel"], 6), round(r["schlecht"], 6), round(r["area"], 6)) for r in got.collect())
    assert have == sorted(want) and not any(w[0] == "t0" for w in want) and len(want) > 50


def test_damage_from_masks(spark):
    rng = np.random.default_rng(3)
    bands = [(rng.random((8, 8)) < 0.45).astype(np.uint8) for _ in range(4)]
    df = spark.createDataFrame([("t", 2, 0.0, 8.0, 8, 8, [bytearray(b.tobytes()) for b in bands])], "tile_id string, ebene int, x0 double, y1 double, height int, width int, bands array<binary>")
    for least in ({}, {"r": 4, "aa": 3}):
        got = polygons.polygon_areas(raster.damage_from_masks(df, 1.0, least), ["typ"]).collect()
        want = sorted((t, float(len(c))) for t, b in zip(raster.BANDS, bands) for c in _regions(b, False) if len(c) >= least.get(t, 1))
        assert sorted((r["typ"], round(r["area"], 9)) for r in got) == want
    assert raster.damage_from_masks(df.limit(0), 1.0).count() == 0


def test_grids_of_tiles(spark):
    tiles = spark.createDataFrame([(0, 0), (50, 0)], "tile_x long, tile_y long")
    cells = raster.mesh(tiles, 50.0, 5).withColumn("cid", F.col("tile_x") * 100 + F.col("cell"))
    assert sorted((r["x"], r["y"]) for r in cells.filter("tile_x = 50 and row = 1").collect()) == [(55.0 + 10 * k, 15.0) for k in range(5)]
    points = spark.createDataFrame([(1, 5.0, 5.5, 7.0), (2, 5.0, 4.5, 9.0), (3, 60.0, 44.0, 1.0)], "pid long, rx double, ry double, z double")
    got = {r["cid"]: r["z"] for r in raster.grid_values(cells, points, "cid", "pid", ("z",), 1.0).collect()}
    assert len(got) == 50 and got[0] == 7.0 and sum(v is not None for v in got.values()) == 1
    near = raster.nearest_recordings(cells, points, "cid", "pid", 2, 150.0).collect()
    assert len(near) == 100 and {(r["rank"], r["pid"]) for r in near if r["cid"] == 0} == {(1, 1), (2, 2)}
    g = np.arange(36.0).reshape(6, 6)
    out = raster.smooth_tiles(spark.createDataFrame([("t", 6, 6, bytearray(g.tobytes()))], "tile_id string, height int, width int, grid binary"), 1.0, 2).first()
    assert (out["height"], out["width"]) == (3, 3) and np.allclose(np.frombuffer(out["grid"]).reshape(3, 3), raster.smooth(g, 1.0)[::2, ::2])


def test_clouds_of_tiles(spark):
    extents = spark.createDataFrame([("a", 10.0, 10.0, 60.0, 20.0), ("b", 400.0, 400.0, 420.0, 420.0), ("c", 48.0, 0.0, 52.0, 4.0)], "path string, x0 double, y0 double, x1 double, y1 double")
    areas = spark.createDataFrame([("POLYGON ((0 0, 100 0, 100 100, 0 100, 0 0))",), (None,), ("POLYGON ((20 12, 30 12, 30 15, 20 12))",)], "geometry string")
    done = spark.createDataFrame([(0, 0)], "tile_x long, tile_y long")
    got = sorted(map(tuple, lidar.clouds_of_tiles(extents, areas, done).collect()))
    assert got == [(50, 0, "a"), (50, 0, "c")]
    assert lidar.clouds_of_tiles(extents.limit(0), areas, done).count() == 0
    boxes = spark.createDataFrame([(1, 10.0, 10.0, 10.0, 10.0), (2, -5.0, 40.0, 105.0, 45.0), (3, 101.0, 0.0, 102.0, 5.0), (4, None, 0.0, 1.0, 1.0)], "b int, x0 double, y0 double, x1 double, y1 double")
    own = areas.limit(1).withColumn("a", F.lit(1))
    assert sorted(r["b"] for r in polygons.boxes_in_areas(boxes, own, ["a"]).collect()) == [1, 2]
    with pytest.raises(Exception, match="larger"):
        polygons.boxes_in_areas(boxes, own, ["a"], largest=50.0).collect()


def test_marking_states_and_factors(spark):
    stored = spark.createDataFrame([(1, 10.0, 10.0, "gut"), (2, 0.0, 30.0, "gut"), (3, None, None, "x")], "k int, mittel double, schlecht double, zustand string")
    assert [r["zustand"] for r in markings.reclassify_markings(stored, 0.2, 0.25).orderBy("k").collect()] == ["mittel", "schlecht", "gut"]
    factors = config.marking_factors({"condition": {"SCHLECHT": 2}, "type": {"PFEILE": 0.5}})
    assert len(factors) == 27 and factors[3, 7] == 1.0 and factors[1, 7] == 0.5 and factors[2, 6] == 0.0 and factors[3, 1] == 2.0
    t = spark.createDataFrame([("a", 1, 1, 6), ("a", 7, 3, 4), ("a", 6, 3, 99), ("b", 6, 1, 3)], "tile string, type_id int, cond_id int, n int")
    got = {r["tile"]: r for r in markings.classify_tiles(t, markings.weight_of(factors)).collect()}
    assert got["a"]["schlecht"] == 0.4 and got["a"]["zustand"] == "schlecht" and got["b"]["zustand"] is None
    assert markings.empty_tiles(t.select("tile").distinct()).filter("gut is null and zustand is null").count() == 2
    one = spark.createDataFrame([(2,), (4,), (5,)], "t int").select(markings.merge_types(F.col("t"), {2: 1, 4: 3, 6: 5}).alias("m"), markings.type_name(F.col("t")).alias("n")).collect()
    assert [r["m"] for r in one] == [1, 3, 5] and one[0]["n"] == "Linie dünn gestrichelt"


def test_images(spark, tmp_path):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 256, (4, 6, 3), dtype=np.uint8), rng.integers(0, 256, (2, 3), dtype=np.uint8)
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.ppm").write_bytes(b"P6\n# c\n6 4\n255\n" + a.tobytes())
    (tmp_path / "b.pgm").write_bytes(b"P5 3 2 255\n" + b.tobytes())
    (tmp_path / "cut.pgm").write_bytes(b"P5 3 2 255\n" + b.tobytes()[:-1])
    (tmp_path / "x.jpg").write_bytes(b"\xff\xd8")
    infos = spark.createDataFrame([(1, "s/a.ppm"), (2, "b.pgm"), (3, "cut.pgm"), (4, "x.jpg"), (5, "gone.ppm"), (6, None)], "k int, image_path string")
    got = {r["k"]: r for r in images.load_images(spark, infos, str(tmp_path)).collect()}
    assert set(got) == {1, 2} and got[1]["pixels"] == a.tobytes() and (got[2]["height"], got[2]["width"], got[2]["bands"]) == (2, 3, 1)
    mask = np.zeros((2, 2), bool)
    mask[1] = True
    small = {r["k"]: r for r in images.load_images(spark, infos, str(tmp_path), (2, 3), mask).collect()}
    assert small[1]["pixels"] == a[::2, ::2][:1].tobytes() + bytes(9)


def test_output_and_caches(spark, tmp_path):
    out = cache.Output(f"file://{tmp_path}/out").create(spark)
    df = spark.createDataFrame([("1_2", 0, 5), ("1_2", 1, 6), ("3_4", 0, 7)], "tile_id string, height_layer int, v int")
    cache.write_cache(df, out.damage)
    cache.write_cache(spark.createDataFrame([("1_2", 0, 50)], "tile_id string, height_layer int, v int"), out.damage)
    assert sorted(r["v"] for r in spark.read.parquet(out.damage).collect()) == [6, 7, 50]
    heights = spark.createDataFrame([(1, 0, 0, k, t, z) for k, t, z in ((0, "a", 1.0), (0, "b", 2.0), (1, "a", None), (2, "a", 9.0))], "cluster long, direction int, lane int, index int, tile_id string, z double")
    cache.write_cache(heights, out.samples, ("tile_id",))
    samples = spark.createDataFrame([(1, 0, 0, k, None) for k in range(4)], "cluster long, direction int, lane int, index int, z double")
    assert [r["z"] for r in cache.merge_heights(samples, out.samples).orderBy("index").collect()] == [2.0, None, 9.0, None]
    (tmp_path / "t_1_2.las").write_bytes(b"1234")
    (tmp_path / "t_1_2.txt").write_bytes(b"1")
    assert [(r["name"], r["n_bytes"]) for r in cache.list_tiles(spark, str(tmp_path)).collect()] == [("t_1_2.las", 4)]
    tile = spark.createDataFrame([("7_8", 0.0, 50.0, 2, 3, 3, bytearray(range(18)))], "tile_id string, x0 double, y1 double, height int, width int, bands int, pixels binary")
    done = cache.write_rasters(tile, str(tmp_path / "r"), 25.0).collect()
    assert (tmp_path / "r" / "7_8.tif").read_bytes().endswith(bytes(range(18))) and done[0]["n_bytes"] > 18


def test_small_functions(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first()["v"]
    assert value(scalars.intensity_byte(F.lit(65535))) == 255 and value(scalars.height_code(F.lit(60.0), F.lit(10.0))) == 32767 and value(scalars.image_folder(F.lit("WE9001AB"))) == "WE9001"
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 0.0))])
    assert value(scalars.ring_area(ring)) == 6.0
    m = np.array(value(scalars.rotation_zxy(F.lit(30.0), F.lit(20.0), F.lit(10.0))))
    turned = scalars.rotated(F.lit(1.0), F.lit(2.0), F.lit(3.0), scalars.rotation_zxy(F.lit(30.0), F.lit(20.0), F.lit(10.0)))
    assert np.allclose([value(c) for c in turned], np.array([1.0, 2, 3]) @ m.reshape(3, 3))
    px, py = scalars.panorama_pixel(F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(0.0), 400, 200)
    assert (value(px), value(py)) == (200, 100)  # north at eye level is in the middle
    df = spark.createDataFrame([(2, "g", 1), (1, "h", None)], "a int, geometry string, b int")
    assert relational.geometry_first(df, "b").columns == ["geometry", "b", "a"] and relational.without(df, "a", "zz").columns == ["geometry", "b"]
    assert [r["a"] for r in relational.in_order(df, "a").collect()] == [1, 2]


def test_streams(spark, tmp_path):
    spark.range(10).selectExpr("id", "timestamp_seconds(id * 1000) AS t").repartition(3).write.parquet(f"{tmp_path}/in")
    q = streams.process_tiles(spark, f"{tmp_path}/in", "id long, t timestamp", lambda d: d.filter("id > 3"), f"{tmp_path}/out", f"{tmp_path}/cp", 1)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6 and streams.mean_batch_seconds(q) > 0
    stream = spark.readStream.schema("id long, t timestamp").parquet(f"{tmp_path}/in")
    counts = streams.running_counts(stream, "t", []).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination()
    assert sum(r["n"] for r in spark.sql("select n from counts").collect()) == 10


def test_nearest_in_time_without_bound(spark):
    rng = np.random.default_rng(5)
    recs = [("a", float(t), f"r{k}", k) for k, t in enumerate(rng.integers(0, 60, 9))] + [("a", None, "x", 99), ("c", 1.0, "y", 98)]
    pts = [("a", float(t), k) for k, t in enumerate(rng.integers(-20, 90, 80))] + [("a", None, 500), ("b", 1.0, 501), (None, 2.0, 502)]
    got = lidar.nearest_in_time(spark.createDataFrame(pts, "run string, t double, pid long"), spark.createDataFrame(recs, "run string, t double, recording_id string, layer int"), "run", ("layer",)).collect()
    assert len(got) == len(pts)
    for r in got:
        near = sorted((abs(t - r["t"]), t, i, k) for run, t, i, k in recs if run == r["run"] and t is not None) if r["t"] is not None else []
        assert r["layer"] == (near[0][3] if near else None)


def test_recordings_by_settings(spark):
    fields = config.parse({"recordings": {"id": "ID", "time": "T", "direction": "D", "height": "H", "pitch": "P"}}).recordings
    df = spark.createDataFrame([("ABCD1234", "2024-01-01T00:00:00Z", 1.0, 50.0, 0.5, 100.0, 200.0)], "ID string, T string, D double, H double, P double, x double, y double")
    r = meta.recordings_of(df, fields).first()
    assert (r["image_no"], r["pitch"], r["roll"], r["image_path"], r["height"]) == (808333725136, 0.5, 0.0, None, 50.0)
    box = lambda x: meta.recordings_in_box(meta.recordings_of(df, fields), x, 0, 50, 300).select("info.*")
    assert box(40).count() == 0 and meta.recordings_in_box(df, 107.5, 0, 200, 300).count() == 1 and meta.recordings_in_box(df, 107.6, 0, 200, 300).count() == 0


def test_ranges(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (5.0, 2.0, 9.0), (None, 1.0, 1.0)], "x double, y double, z double")
    assert df.filter(scalars.within(slice(0, 5), slice(None, 2))).count() == 2 and df.filter(scalars.within(slice(0, 5), slice(None), slice(4, None))).count() == 1
    for bad in ((slice(0, 1),), (slice(0, 1), 5), (slice(0, 1), slice(0, 4, 2))):
        with pytest.raises(ValueError):
            scalars.within(*bad)
    cloud = las.cloud_from_arrays(spark, {"x": np.array([1.0]), "y": np.array([2.0]), "z": np.array([3.0]), "intensity": np.array([7])})
    assert cloud.first()["intensity"] == 7 and cloud.first()["gps_time"] is None and len(cloud.columns) == 16
    with pytest.raises(ValueError):
        las.cloud_from_arrays(spark, {"x": np.array([1.0])})
