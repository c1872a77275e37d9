import math
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavelens.functions import scalars, wkt
from pavelens.operators import areas, evaluate, lidar, markings, polygons, profiles, raster, relational, sampling, sequences


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("x, want", [(0.0, 1.0), (4.0, 1.5), (12.0, 3.5), (16.0, 4.5), (18.0, 5.0), (99.0, 5.0), (2.0, 1.25), (None, None), (8.0, 2.5)])
def test_normalise(spark, x, want):
    lit = F.lit(x).cast("double")
    assert value(spark, evaluate.normalise(lit, F.lit(4.0), F.lit(12.0), F.lit(16.0))) == want


@pytest.mark.parametrize("v, want", [(1.5, 1), (1.51, 2), (3.5, 2), (4.5, 3), (4.51, 4), (None, 0)])
def test_quantise(spark, v, want):
    assert value(spark, evaluate.quantise(F.lit(v).cast("double"))) == want


def test_rating_with_missing_measures(spark):
    nan = float("nan")
    rows = [(1, "A", "A", 4.0, 1.0, 4.0, 0.1, 1.0, 1.0, 1.0), (2, "A", "N", 99.0, 1.0, 4.0, 0.1, 5.0, 5.0, 10.0), (3, "P", "A", None, 1.0, 4.0, 0.1, 7.0, 7.0, 25.0), (4, "A", "A", nan, 1.0, 4.0, 0.1, None, 1.0, 99.0), (5, None, None, *[None] * 7)]
    df = spark.createDataFrame(rows, "area_id long, bw string, fk string, sm4l_m double, sm4l_a double, mspt double, msph double, riss double, afli double, ofs double").withColumn("GW", F.lit("old"))
    from pavelens.plans.pipeline import factor_frame
    from pavelens.sources.config import Settings

    got = {r["area_id"]: r for r in evaluate.rerate(df, factor_frame(spark, Settings())).collect()}
    assert got[1]["TWGEB"] == 1.5 and got[1]["TWSUB"] == 1.5 and got[1]["GK"] == 1
    assert got[2]["TWGEB"] is None and got[2]["GW"] == got[2]["TWSUB"] and got[2]["TKGEB"] is None
    assert got[3]["TWSUB"] == got[3]["ZWOFS"] == 4.5 and got[3]["ZWRISS"] is None and got[3]["ZKRISS"] == 0
    assert got[4]["TWSUB"] is None and got[4]["GW"] is None and got[4]["GK"] == 0
    assert got[5]["GW"] is None


def test_rounding(spark):
    rnd = random.Random(9)
    values = [2.675, 1.005, 0.125, 0.375, 1e9 + 0.335, -2.675, -0.125, 0.0, 1.125, 4.495, 1e13 + 0.5] + [k / 200 for k in range(-600, 600)] + [rnd.uniform(-50, 50) for _ in range(500)] + [math.nextafter(k / 200, s) for k in range(300) for s in (-9.0, 9.0)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", *[scalars.round_exact(F.col("v"), d).alias(f"r{d}") for d in (0, 2, 3)], scalars.round_half_up(F.col("v")).alias("h"))
    for r in df.collect():
        if abs(r["v"]) < 2**40:
            assert [r["r0"], r["r2"], r["r3"]] == [round(r["v"], 0), round(r["v"], 2), round(r["v"], 3)]
        else:
            assert r["r2"] == r["v"]
        assert r["h"] == math.floor(r["v"] * 100 + 0.5) / 100
    assert value(spark, scalars.round_exact(F.lit(None).cast("double"))) is None


def test_ids_and_tiles(spark):
    assert value(spark, scalars.base_number(F.lit("abcd1234"))) == 808333725136
    assert value(spark, scalars.tile_id(F.lit("x_12_34_h0.las"))) == "12_34" and value(spark, scalars.tile_id(F.lit("none"))) is None
    assert value(spark, scalars.tile_id(F.lit("1.5 2.3"), ".")) == "1.5"  # the delimiter is no pattern
    assert value(spark, scalars.max_known(F.lit(1.0), F.lit(None).cast("double"))) is None
    m = np.array(value(spark, scalars.rotation_zxy(F.lit(30.0), F.lit(20.0), F.lit(10.0)))).reshape(3, 3)
    assert np.allclose(m @ m.T, np.eye(3)) and abs(np.linalg.det(m) - 1) < 1e-12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-1, 1), min_size=13, max_size=13), st.floats(-0.05, 0.05))
def test_straight_edge(h, ramp):
    h = np.array([h])
    left, right, gap = profiles.contacts(h)
    assert gap.max() < 1e-9
    hull = sequences._hull_depth(h)
    assert abs(-gap[0, 6] - hull[0]) < 1e-9 and hull[0] >= 0
    assert abs(sequences._hull_depth(h + ramp * np.arange(13))[0] - hull[0]) < 1e-9
    rut, water = profiles.rut_and_water(h)
    assert rut[0] >= 0 and water[0] >= 0


def test_gaps_and_kerbs(spark):
    nan = np.nan
    assert np.allclose(profiles.fill_row(np.array([[nan, 1, nan, 3, nan]])), [[0, 1, 2, 3, 4]])
    assert np.isnan(profiles.fill_row(np.array([[nan, 1, nan]]))).all()
    h = np.full((1, 25), 5.0)
    h[0, :3], h[0, 23:] = 5.04, 5.1
    m = profiles.mask_kerbs(h, 0.0399)
    assert np.isnan(m[0, :3]).all() and np.isnan(m[0, 23:]).all() and not np.isnan(m[0, 3:23]).any()
    rows = [([5.0] * 25,), ([None] * 25,), ([5.0] * 3,), (None,)]
    got = spark.createDataFrame(rows, "h array<double>").select(profiles.transverse(F.col("h")).alias("t")).select("t.*").collect()
    assert got[0]["rut_depth_left"] == 0 and [r["gradient"] for r in got[1:]] == [None] * 3


def test_fill_along_blocks(spark):
    random.seed(1)
    rows = [(k, i, random.random() if random.random() < 0.3 and k else None) for k in (0, 1, 2, None) for i in range(60)] + [(7, 3, 1.0)]
    df = spark.createDataFrame(rows, "k int, i int, z double").withColumn("_b0", F.lit(1))
    got = {(r["k"], r["i"]): r["z"] for r in profiles.fill_along(df, ["k"], "i", "z", block=4).collect()}
    for k in (0, 1, 2, None):
        z = np.array([[np.nan if r[2] is None else r[2] for r in rows if r[0] == k and r[0] != 7]])
        want = profiles.fill_row(z)[0]
        have = np.array([np.nan if got[k, i] is None else got[k, i] for i in range(60)])
        assert np.allclose(have, want, equal_nan=True)
    assert got[7, 3] is None and len(got) == 241


def test_blocks_change_nothing(spark):
    rows = [(k, i, float((i * 37 + k) % 11)) for k in (1, 2) for i in range(90)] + [(1, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, i long, z double")
    for f in (lambda b: sequences.moving_average_deltas(df, ["k"], "i", "z", (11, 31), b), lambda b: sequences.straight_edge_depth(df, ["k"], "i", "z", 21, b)):
        one, many = (sorted(map(tuple, f(b).collect()), key=str) for b in (10_000, 7))
        assert one == many and len(one) == 180


def test_islands(spark):
    n = [1, 2, 3, 5, 6, 9, 11, 12, 13, 14, None]
    df = spark.createDataFrame([("a", x, float(5 * (x or 0)), 0.0) for x in n] + [(None, 1, 0.0, 0.0), (None, 2, 5.0, 0.0)], "run string, n long, x double, y double")
    for block in (3, 1000):
        got = sequences.islands(df, ["run"], "n", "x", "y", (4.0, 6.0), block).collect()
        by = {}
        for r in got:
            by.setdefault((r["run"], r["cluster"]), []).append(r["n"])
        assert sorted(map(sorted, by.values())) == [[1, 2], [1, 2, 3], [5, 6], [11, 12, 13, 14]]
    assert sequences.islands(df.limit(0), ["run"], "n").count() == 0


def test_polygon_areas_against_sampling(spark):
    p = polygons.Polygon(*np.array([[0, 4, 4, 0, 0, 1, 3, 3, 1, 1], [0, 0, 4, 4, 0, 1, 1, 3, 3, 1]], float), np.array([1, 0, 0, 0, 0, 1, 0, 0, 0, 0], bool))
    assert p.area() == 12 and p.area_in(0, 0, 2, 2) == 3 and p.area_in(1.5, 1.5, 2.5, 2.5) == 0
    rng = np.random.default_rng(3)
    u = np.array([[0, 0], [6, 0], [6, 5], [4, 5], [4, 2], [2, 2], [2, 5], [0, 5]], float)  # concave
    for _ in range(30):
        a, b = np.sort(rng.uniform(-1, 7, (2, 2)), 0)
        q = rng.uniform(a, b, (4000, 2))
        share = np.mean([polygons._inside(v, u) for v in q[:800]])
        assert abs(abs(polygons.surface(polygons.clip_ring(u, *a, *b))) - share * np.prod(b - a)) < 0.12 * np.prod(b - a) + 1e-9


def test_areas_in_cells_against_clipping():
    rng = np.random.default_rng(8)
    texts = []
    for k in range(60):
        n = rng.integers(4, 9)
        a = (np.arange(n) + rng.uniform(0, 0.8, n)) * 2 * np.pi / n  # no gap of half a turn, so that no edges cross
        r = rng.uniform(0.3, 3, len(a))
        xy = np.column_stack([5 + r * np.cos(a), 5e6 + 5 + r * np.sin(a)])[:: 1 if k % 2 else -1]
        texts.append("POLYGON ((" + ", ".join(f"{x:.6f} {y:.6f}" for x, y in [*xy, xy[0]]) + "))")
    texts += ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1.5 1.5, 2.5 1.5, 2.5 2.5, 1.5 2.5, 1.5 1.5))", None, "POLYGON EMPTY", "POLYGON ((1 1, 3 1, 3 2, 1 2, 1 1))"]
    s = wkt.parse_wkt(texts)
    rows = np.repeat(np.arange(len(texts)), 121)
    cx, cy = np.tile(np.repeat(np.arange(11), 11), len(texts)), np.tile(np.arange(11), 11 * len(texts)) + np.where(rows < 60, 5_000_000, 0)
    got = polygons.areas_in_cells(s, rows, cx, cy, block=500)
    for i in range(len(rows)):
        p = polygons._polygon(s, rows[i])
        want = p.area_in(cx[i], cy[i], cx[i] + 1, cy[i] + 1) if s.count()[rows[i]] else 0.0
        assert abs(got[i] - want) < 1e-6, (i, got[i], want)
    assert np.allclose(np.bincount(rows, got, minlength=len(texts)), polygons.shape_areas(s), atol=1e-5)


def test_damaged_share(spark):
    sq = lambda x, y, w, h: f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}))"
    areas_ = spark.createDataFrame([(1, "A", sq(0, 0, 10, 10)), (2, "A", sq(9.5, 0, 5, 1)), (3, "P", sq(0, 0, 10, 10)), (4, "A", None), (5, "A", "POLYGON EMPTY")], "area_id long, bw string, geometry string")
    damage = spark.createDataFrame([(" R", sq(9.2, 0.2, 0.6, 0.6)), ("r", sq(3, 3, 0.01, 0.01)), ("zz", sq(4, 4, 1, 1)), (None, sq(4, 4, 1, 1)), ("aa", sq(1.5, 1.5, 1, 0.5)), ("b", None)], "typ string, geometry string")
    damage = damage.union(spark.createDataFrame([("r", sq(10.1, 5.0, 0.5, 0.5)), ("r", sq(9.95, 7.0, 0.5, 0.5))], "typ string, geometry string"))  # beside the area, and mostly
    got = {r["area_id"]: r for r in polygons.damaged_share(areas_, damage, "A").collect()}
    assert got[1]["riss"] == 2.0 and got[1]["ofs"] == 2.0 and got[2]["riss"] == 20.0 and got[4]["riss"] == got[5]["riss"] == 0.0 and 3 not in got
    assert polygons.damaged_share(areas_, damage, "P").first()["ofs"] == 0.0
    assert polygons.damaged_share(areas_.limit(0), damage.limit(0), "A").count() == 0


def test_common_area_against_sampling():
    rng = np.random.default_rng(1)

    def star(cx, cy, r0):
        n = rng.integers(4, 9)
        a, r = (np.arange(n) + rng.uniform(0, 0.8, n)) * 2 * np.pi / n, rng.uniform(0.3, 1, n) * r0
        return np.column_stack([cx + r * np.cos(a), cy + r * np.sin(a)])

    g = np.stack(np.meshgrid(*[np.linspace(-0.7, 1.7, 300)] * 2), -1).reshape(-1, 2)
    inside = lambda ring: np.sum([((a[1] > g[:, 1]) != (b[1] > g[:, 1])) & (g[:, 0] < (b[0] - a[0]) * (g[:, 1] - a[1]) / (b[1] - a[1] + 1e-300) + a[0]) for a, b in zip(ring, np.roll(ring, -1, 0))], axis=0) % 2 == 1
    for k in range(30):
        p, many = star(0.5, 0.5, 0.6), [star(*rng.uniform(0, 1, 2), 0.6) for _ in range(rng.integers(1, 5))]
        many += [many[0].copy()] * (k % 5 == 0) + [p.copy()] * (k % 7 == 0)  # the same ground twice, the shape itself
        want = (np.logical_or.reduce([inside(a) for a in many]) & inside(p)).mean() * 2.4**2
        assert abs(polygons.common_area([p], [[a] for a in many]) - want) < 8e-3
    assert polygons.common_area([p], []) == 0.0


def test_points_lines_and_cells_in_areas(spark):
    rng = np.random.default_rng(5)
    ring = lambda xy: "((" + ", ".join(f"{x!r} {y!r}" for x, y in [*xy, xy[0]]) + "))"
    shapes = []
    for k in range(25):
        n = int(rng.integers(3, 8))
        a = (np.arange(n) + rng.uniform(0, 0.8, n)) * 2 * np.pi / n
        r = rng.uniform(0.4, 1, n) * (300 if k == 0 else 8)
        shapes.append(np.column_stack([50 + rng.uniform(-40, 40) + r * np.cos(a), 50 + rng.uniform(-40, 40) + r * np.sin(a)]).tolist())
    areas_ = spark.createDataFrame([(k, "A", "POLYGON " + ring(s)) for k, s in enumerate(shapes)] + [(90, "A", None), (91, "A", "POLYGON EMPTY")], "area_id long, bw string, geometry string")
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-20, 120, (400, 2)))] + [(900, None, 1.0), (901, float("nan"), 1.0)]
    want = {(i, k) for i, x, y in pts[:400] for k, s in enumerate(shapes) if polygons._inside(np.array([x, y]), np.array(s))}
    df = spark.createDataFrame(pts, "pid long, x double, y double").withColumn("xy", F.lit("clash"))
    got = [(r["pid"], r["area_id"]) for r in polygons.points_in_areas(df.drop("xy"), areas_, ["area_id"]).collect()]
    assert sorted(got) == sorted(want) and len(want) > 400
    lines = [(i, float(x), float(y), float(x + dx), float(y + dy)) for i, ((x, y), (dx, dy)) in enumerate(zip(rng.uniform(-20, 120, (400, 2)), rng.uniform(-2.4, 2.4, (400, 2))))]

    def crosses(l, s):
        (ax, ay, bx, by), s = l, np.array(s)
        side = lambda px, py, qx, qy, rx, ry: (qx - px) * (ry - py) - (qy - py) * (rx - px)
        c, d = s, np.roll(s, -1, 0)
        one = side(ax, ay, bx, by, c[:, 0], c[:, 1]) * side(ax, ay, bx, by, d[:, 0], d[:, 1]) < 0
        return bool((one & (side(*c.T, *d.T, ax, ay) * side(*c.T, *d.T, bx, by) < 0)).any()) or polygons._inside(np.array([ax, ay]), s)

    want = {(i, k) for i, *l in lines for k, s in enumerate(shapes) if crosses(l, s)}
    ldf = spark.createDataFrame(lines, "lid long, lx0 double, ly0 double, lx1 double, ly1 double")
    got = [(r["lid"], r["area_id"]) for r in polygons.lines_in_areas(ldf, areas_, ["area_id"]).collect()]
    assert sorted(got) == sorted(want)
    cells = spark.createDataFrame([(x, y) for x in range(0, 100, 3) for y in range(0, 100, 3)], "cx long, cy long")
    part = {(r["area_id"], r["cx"], r["cy"]): r for r in polygons.cells_in_areas(cells, areas_, ["area_id"]).collect()}
    for k, s in enumerate(shapes):
        for x in range(0, 100, 3):
            for y in range(0, 100, 3):
                a = abs(polygons.surface(polygons.clip_ring(np.array(s), x, y, x + 1, y + 1)))
                r = part.get((k, x, y))
                assert (r is None and a < 1e-8) or abs(r["part"] - a) < 1e-6 and (r["xy"] is None) == (a > 1 - 1e-7)


def test_shape_problems(spark):
    rows = ["POLYGON ((0 0, 4 0, 4 4, 0 0))", "POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))", "POLYGON ((0 0, 1 1, 0 0))", "LINESTRING (0 0, 1 1)", "POLYGON EMPTY", None]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(rows)], "k int, geometry string")
    assert [r["problem"] for r in polygons.shape_problem(df).orderBy("k").collect()] == [None, "crossing", "short", "kind", "missing", "missing"]
    assert [r["problem"] for r in polygons.shape_problem(df, kind="LINESTRING").orderBy("k").collect()][3] is None


def test_joins(spark):
    a = spark.createDataFrame([(1, None, float("nan"), "x"), (2, "b", 1.0, "y")], "k int, s string, d double, l string")
    b = spark.createDataFrame([(None, float("nan"), "p"), ("b", 2.0, "q")], "s string, d double, r string")
    assert [tuple(r)[0] for r in relational.natural_join(a, b).select("k", "l", "r").collect()] == [1]
    got = relational.update(a.select("k", "s", "l"), spark.createDataFrame([(1, "new", None), (9, "z", "z")], "k int, s string, l string"), ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "new", "x"), (2, "b", "y")]
    with pytest.raises(ValueError):
        relational.natural_join(a, spark.range(1))


def test_lines_touch_boxes(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0)], "b int, x0 double, y0 double, x1 double, y1 double")
    lines = [(1, -5.0, 5.0, 15.0, 5.0), (2, 10.0, 20.0, 10.0, 10.0), (3, -1.0, 9.0, 2.0, 13.0), (4, 5.0, 5.0, 5.0, 5.0), (5, 11.0, 0.0, 11.0, 9.0), (6, -30.0, -30.0, 40.0, 40.0)]
    got = areas.lines_in_boxes(spark.createDataFrame(lines, "l int, lx0 double, ly0 double, lx1 double, ly1 double"), boxes, 4.0)
    assert sorted(r["l"] for r in got.collect()) == [1, 2, 4, 6]


def test_laser(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 0.02, 0.0, 3.0), (3, 5.0, 5.0, 9.0)], "pid long, rx double, ry double, z double")
    s = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.01, 0.0), (3, 9.0, 9.0)], "sid long, x double, y double")
    z = {r["sid"]: r["z"] for r in lidar.inverse_distance_height(s, p, "sid", "pid", 0.025).collect()}
    assert z == {1: 1.0, 2: 2.0, 3: None}
    q = spark.createDataFrame([(50.0, 10.0), (49.9, 60.0)], "x double, y double")
    assert lidar.retile(q, 50.0, edges_twice=True).count() == 3 and lidar.retile(q).count() == 2


def test_markings(spark):
    px = spark.createDataFrame([("t", 2, 1), ("t", 1, 1), ("t", 2, 3), ("t", 1, 2), ("u", 1, 0)], "tile string, type_id int, cond_id int")
    px = px.union(spark.createDataFrame([("t", 7, 0)] * 3 + [("t", 2, 0)], "tile string, type_id int, cond_id int"))
    r = markings.classify_markings(px, ["tile"]).collect()
    assert len(r) == 1 and (r[0]["typ"], r[0]["n"], r[0]["gut"], r[0]["zustand"]) == (2, 4, 50.0, "schlecht")  # pixels without a condition count for the type


def test_curve_and_samples():
    t = np.linspace(0, 1.2, 14)
    xy = np.column_stack([80 * np.sin(t), 80 - 80 * np.cos(t)])
    c = sampling.Curve(xy)
    assert np.allclose(c.at(c.u), xy)
    assert np.abs(np.hypot(c.at(np.linspace(0, 1, 300))[:, 0], 80 - c.at(np.linspace(0, 1, 300))[:, 1]) - 80).max() < 1e-3
    cubic = lambda u: np.column_stack([u, u**3 - u])
    d = sampling.sample_line(xy, np.arange(14).astype(str))
    assert set(d[d.direction == 0].lane) == set(range(5)) and set(d[d.direction == 1].lane) == set(range(25))
    a = d[(d.direction == 0) & (d.lane == 2)].sort_values("index")[["x", "y"]].to_numpy()
    assert abs(np.hypot(*np.diff(a, axis=0).T)[20:-20].mean() - 0.1 * (80 + 0.75) / 80) < 2e-3
    assert len(sampling.sample_line(xy[:1], np.array(["a"]))) == 0 and cubic(np.zeros(1)).shape == (1, 2)
    big = np.column_stack([np.arange(500.0), np.sin(np.arange(500.0))])
    assert np.allclose(sampling.Curve(big).at(np.array([0.3, 0.7])), [_dense(big, 0.3), _dense(big, 0.7)], atol=1e-6)


def _dense(xy, t):
    c = sampling.Curve(xy[:4])
    c.u = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(xy, axis=0).T))])
    c.u, c.xy, n = c.u / c.u[-1], xy, len(xy)
    h, s = np.diff(c.u), np.diff(xy, axis=0) / np.diff(c.u)[:, None]
    a, r = np.zeros((n, n)), np.zeros((n, 2))
    a[0, :3], a[-1, -3:] = (h[1], -(h[0] + h[1]), h[0]), (h[-1], -(h[-2] + h[-1]), h[-2])
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2], r[i] = (h[i - 1], 2 * (h[i - 1] + h[i]), h[i]), 6 * (s[i] - s[i - 1])
    c.m = np.linalg.solve(a, r)
    return c.at(np.array([t]))[0]


def test_long_curve_of_equal_distances():
    k = np.arange(3_000)
    c = sampling.Curve(np.column_stack([5.0 * k, 2.0 * k]))
    assert np.allclose(c.m, 0, atol=1e-3) and np.allclose(c.at(np.array([0.0001, 0.5])), [[1.4995, 0.5998], [7497.5, 2999.0]])


def test_sampling_of_a_line_over_a_cut(spark):
    k = np.arange(26)
    xy = np.column_stack([5.0 * k, 3 * np.sin(k / 3)])
    rows = [(7, 4_990 + int(i), f"r{i}", *map(float, xy[i])) for i in k] + [(8, int(i), f"s{i}", *map(float, xy[i])) for i in range(3)]
    lines = spark.createDataFrame(rows, "cluster long, image_no long, recording_id string, x double, y double")
    key = ["direction", "lane", "index"]
    for size in (5_000, 6):
        got = sampling.sampling_points(lines, line_rows=size).toPandas()
        for cluster, n, name in ((7, 26, "r"), (8, 3, "s")):
            want = sampling.sample_line(xy[:n], np.array([f"{name}{i}" for i in range(n)])).sort_values(key).reset_index(drop=True)
            g = got[got["cluster"] == cluster].sort_values(key).reset_index(drop=True)
            assert not g.duplicated(key).any() and len(g) == len(want) and (g[key].to_numpy() == want[key].to_numpy()).all()
            assert np.allclose(g[["x", "y"]], want[["x", "y"]], atol=1e-7) and (g["recording_id"] == want["recording_id"]).mean() > 0.999


def test_lines_along():
    assert sampling.simplify(np.array([[0, 0], [1, 0.01], [2, 0], [2, 5.0]]), 0.1).tolist() == [True, False, True, True]
    assert len(sampling.along(np.array([[0, 0], [12.0, 0]]))) == 3


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**36 - 1), st.booleans())
def test_regions(bits, diagonal):
    m = np.array([bits >> k & 1 for k in range(36)], np.uint8).reshape(6, 6)
    labels = raster.label_regions(m, diagonal)
    seen, n = np.zeros((6, 6), bool), 0
    for y, x in zip(*np.nonzero(m)):
        if not seen[y, x]:
            n += 1
            todo = [(y, x)]
            seen[y, x] = True
            while todo:
                a, b = todo.pop()
                assert labels[a, b] == labels[y, x]
                for c in range(max(0, a - 1), min(6, a + 2)):
                    for d in range(max(0, b - 1), min(6, b + 2)):
                        if m[c, d] and not seen[c, d] and (diagonal or c == a or d == b):
                            seen[c, d] = True
                            todo.append((c, d))
    assert labels.max() == n
    for k in range(1, n + 1):
        twice = sum(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(r, r[1:])) for r in raster.outline(labels == k))
        assert abs(twice) / 2 == (labels == k).sum()


def test_grids():
    assert np.allclose(raster.smooth(np.full((30, 30), 3.0), 2.0), 3.0)
    with pytest.raises(ValueError):
        raster.subsample(np.zeros((5, 5)), 2)


def test_every_pixel_is_in_one_mask(spark):
    from pavelens.plans.survey import type_masks

    px = spark.createDataFrame([(1, 1)] * 1_500 + [(1, 8)] * 700 + [(2, 4)] * 5, "tile long, type_id int")
    for rows in (1_024, 32):
        got = type_masks(px, rows).collect()
        count = {v: sum(r["mask"].count(v) for r in got if r["tile_id"].split("/")[0] == "1") for v in (1, 2)}
        assert count == {1: 1_500, 2: 700} and all(len(r["mask"]) == r["height"] * 32 <= rows * 32 for r in got)
        assert [(r["height"], r["mask"].count(1)) for r in got if r["tile_id"] == "2"] == [(1, 5)]
    assert len({r["tile_id"] for r in got}) == len(got) == 4


def test_damaged_shares_against_brute_force(spark):
    rng = np.random.default_rng(12)
    text = lambda xy: "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*xy, xy[0]]) + "))"

    def star(r0):
        n = int(rng.integers(4, 8))
        a, r = (np.arange(n) + rng.uniform(0, 0.8, n)) * 2 * np.pi / n, rng.uniform(0.5, 1, n) * r0
        cx, cy = rng.uniform(0, 14, 2)
        return np.round(np.column_stack([cx + r * np.cos(a), cy + r * np.sin(a)]), 3).tolist()

    ground = [(k, "AP"[k % 2], star(4)) for k in range(8)]
    ground.append((8, "A", ground[0][2]))  # surveyed again on the same ground
    damage = [(t, star(0.4)) for t in areas.TYPES for _ in range(12)] + [("r", star(2))]
    got = polygons.damaged_shares(
        spark.createDataFrame([(k, b, text(s)) for k, b, s in ground], "area_id long, bw string, geometry string"),
        spark.createDataFrame([(t, text(s)) for t, s in damage], "typ string, geometry string"),
    ).collect()
    ring = lambda s: np.array(s) if polygons.surface(np.array(s)) > 0 else np.array(s)[::-1]
    part = lambda s, x, y: polygons.clip_ring(ring(s), x, y, x + 1, y + 1)
    want = {}
    for mode in "AP":
        own = [[ring(s)] for _, b, s in ground if b == mode]
        flags = {}
        for x in range(-6, 20):
            for y in range(-6, 20):
                m2 = dict.fromkeys(areas.MODES[mode], 0)
                for t, s in damage:
                    if t in m2 and abs(polygons.surface(ring(s))) >= areas.SIEVE_PIXELS[t] * areas.PIXEL_M**2 and len(p := part(s, x, y)) > 2:
                        origin = np.array([x, y])
                        m2[t] += int(np.floor(max(0.0, polygons.common_area([p - origin], [[r - origin for r in a] for a in own])) * 1e6 + 0.5))
                flags[x, y] = {t for t, v in m2.items() if v >= round(areas.CELL_M2[t] * 1e6)}
        for k, b, s in ground:
            if b == mode:
                cells = [c for c in flags if abs(polygons.surface(part(s, *c))) > 1e-9]
                of = {g: 100 * sum(bool(flags[c] & set(ts)) for c in cells) / abs(polygons.surface(ring(s))) for g, ts in areas.GROUPS[mode].items()}
                want[k] = [of.get(g) for g in ("riss", "afli", "ofs")]
    assert len(got) == 9 and sum(v[2] > 0 for v in want.values()) > 5
    for r in got:
        for have, need in zip((r["riss"], r["afli"], r["ofs"]), want[r["area_id"]]):
            assert (have is None) == (need is None) and (need is None or abs(have - need) < 1e-6), (r, want[r["area_id"]])


def nodes(df):
    """Name and numOutputRows of each node of the plan by which all rows were collected."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
        elif p.metrics().contains("numOutputRows"):
            found.append((p.nodeName(), p.metrics().apply("numOutputRows").value()))
        children = p.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def values(spark, rows, schema):
    """A table whose size the planner knows, so that it chooses its joins by sizes."""
    text = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    names = [f.split() for f in schema.split(", ")]
    rows = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)
    return spark.sql("SELECT " + ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in names) + f" FROM VALUES {rows} AS t({', '.join(n for n, _ in names)})")


def broadcast_rows(df):
    return [n for name, n in nodes(df) if name == "BroadcastExchange"]


def generated_rows(df):
    return [n for name, n in nodes(df) if name == "Generate"]


def test_areas_of_clipped_damage_stay_off_the_driver(spark):
    """A few boxes cover many cells: their sizes mustn't have them broadcast, large ones and several of a cell neither lose nor double damage."""
    boxes = values(spark, [(0.0, 0.0, 300.0, 300.0), (-7.5, -8.0, 1.25, 9.5), (250.5, 0.0, 320.0, 16.0), (250.5, 0.0, 320.0, 16.0), (5.0, 5.0, 5.0, 9.0)], "x0 double, y0 double, x1 double, y1 double")
    found = [("r", -1.5, -1.0, 0.5, 0.5), ("r", -1.5, -1.0, 0.5, 0.5), ("g", 299.5, 8.0, 301.0, 16.5), ("r", 7.75, 7.75, 8.25, 16.0), ("r", 400.0, 0.0, 401.0, 1.0), ("r", 3.0, 3.0, 3.0, 4.0), (None, 20.0, 20.0, 20.5, 21.0), ("r", None, 0.0, 1.0, 1.0)]
    damage = values(spark, found, "typ string, x0 double, y0 double, x1 double, y1 double")
    df = areas.cell_damage(damage, boxes)
    want = {}
    cover = [tuple(b) for b in boxes.distinct().collect()]
    for typ, x0, y0, x1, y1 in (f for f in found if f[1] is not None):
        for cx in range(int(np.floor(x0)), int(np.ceil(x1))):
            for cy in range(int(np.floor(y0)), int(np.ceil(y1))):
                xs, ys = (np.arange(c + 0.125, c + 1, 0.25) for c in (cx, cy))  # all sides are whole quarters
                n = sum(x0 < x < x1 and y0 < y < y1 and any(b[0] < x < b[2] and b[1] < y < b[3] for b in cover) for x in xs for y in ys)
                if n:
                    want[cx, cy, typ] = want.get((cx, cy, typ), 0) + n * 62_500
    assert {(r["cx"], r["cy"], r["typ"]): r["um2"] for r in df.collect()} == want and len(want) > 20
    assert max(broadcast_rows(df), default=0) < 100


def test_cells_of_areas_stay_off_the_driver(spark):
    """Shares of areas of many cells, with several areas in a damaged cell, one twice and one that only touches it: no cells of areas are broadcast."""
    ground = [(1, "A", 0.0, 0.0, 300.0, 200.0), (2, "A", -0.5, -9.0, 8.0, 0.25), (3, "A", 1.0, 0.0, 1.0, 5.0), (4, "P", 0.0, 0.0, 9.0, 9.0), (5, "A", -8.0, -8.0, 0.0, 0.0), (5, "A", -8.0, -8.0, 0.0, 0.0)]
    own = values(spark, ground, "area_id long, bw string, x0 double, y0 double, x1 double, y1 double")
    flag = [(0, 0, "r"), (-1, -1, "af"), (7, -8, "r"), (8, -8, "b"), (299, 199, "r"), (300, 0, "r"), (12, 7, "ae"), (-8, -8, "onf"), *[(1_000 + k, 0, "r") for k in range(200)]]
    flags = values(spark, [(x, y, *[t == k for k in areas.MODES["A"]]) for x, y, t in flag], "cx long, cy long, " + ", ".join(f"{k} boolean" for k in areas.MODES["A"]))
    df = areas.damaged_share(own, flags, "A")
    got = sorted(tuple(r) for r in df.collect())
    want = []
    for k, bw, x0, y0, x1, y1 in ground:
        if bw == "A":
            same = sum(a[0] == k for a in ground)
            hit = [t for x, y, t in flag if min(x1, x + 1) > max(x0, x) and min(y1, y + 1) > max(y0, y)]
            size = (x1 - x0) * (y1 - y0)
            want.append((k, bw, *[sum(t in ts for t in hit) * same * 100.0 / size if size else 0.0 for ts in areas.GROUPS["A"].values()]))
    assert got == sorted(want) and sum(w[2] > 0 for w in want) == 2
    assert max(broadcast_rows(df), default=0) < 1_000


def test_cells_without_points_are_never_made(spark, tmp_path):
    """Tiles of one point each hold 400 cells; only cells near a point are made, over borders of tiles too, and a cell's point may have no height."""
    from pavelens.plans.survey import QUERIES

    cloud = [(k, 500.0 * k + 1.25, 1.5, float(k), k) for k in range(60)]
    cloud += [(200, 149.9, 21.2, 5.0, 1), (201, 150.9, 21.2, 6.0, 2), (202, 249.9, 21.2, 7.0, 3), (203, 249.9, 21.2, 7.0, 3), (301, -1.0, -1.25, 8.0, 4), (300, -1.5, -1.25, None, 5), (400, None, 1.0, 1.0, 1), (None, 61.25, 61.25, 9.0, 6)]
    spark.createDataFrame(cloud, "point_id long, x double, y double, z double, intensity int").write.parquet(f"{tmp_path}/point_cloud.parquet")
    df = QUERIES["grid_from_points"](spark, str(tmp_path))
    got = {tuple(r)[:4]: tuple(r)[4:] for r in df.collect()}
    points = [p for p in cloud if p[1] is not None]
    tiles, want = {(int(x // 50) * 50, int(y // 50) * 50) for _, x, y, _, _ in points}, {}
    for tx, ty in tiles:
        for r in range(20):
            for c in range(20):
                x, y = tx + (c + 0.5) * 2.5, ty + (r + 0.5) * 2.5
                near = [((x - p[1]) ** 2 + (y - p[2]) ** 2, p[0] or 999, p[3], float(p[4])) for p in points if (x - p[1]) ** 2 + (y - p[2]) ** 2 <= 1]
                if near:
                    want[tx, ty, r, c] = min(near, key=lambda n: n[:2])[2:]
    assert got == want and len(want) == 63 and (None, 5.0) in want.values()
    assert max(generated_rows(df)) < 500


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="the generated tables aren't here")
def test_cells_of_paved_areas_stay_off_the_driver(spark):
    """50 paved areas have some 7,000 cells, of which none is broadcast."""
    from pavelens.plans.survey import QUERIES

    df = QUERIES["substance_paved"](spark, "/root/testdata/sf0.001")
    assert max(broadcast_rows(df), default=0) <= 50 == df.count()
