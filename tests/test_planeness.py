import numpy as np
import pytest
from pyspark.sql import functions as F

from pavelens.operators import planeness, profiles, sampling
from pavelens.plans import pipeline
from pavelens.sources import config


def _points(heights, cluster):
    """heights (n, lanes) as rows."""
    return [(cluster, lane, i, i * 0.1, lane * 0.1, None if np.isnan(v) else float(v)) for i, row in enumerate(heights) for lane, v in enumerate(row)]


SCHEMA = "cluster long, lane int, index int, x double, y double, z double"


def _along(h):
    """Measures of an (n, 5) matrix by the plain rule: straight edge laid sample by sample, moving averages over full frames."""
    h = profiles.fill_row(profiles.fill_row(h).T).T
    n = len(h)
    depth, slope = np.full(h.shape, np.nan), np.full(h.shape, np.nan)
    for lane in range(5):
        for m in range(20, n - 20):
            w = h[m - 20 : m + 21, lane]
            a, b, g = profiles.contacts(w[None])
            depth[m, lane] = abs(g[0, 20])
            slope[m, lane] = 100 * (w[b[0]] - w[a[0]]) / (b[0] - a[0]) if b[0] > a[0] else 0.0
    deltas = []
    for s in planeness.AVERAGES:
        d = np.full(h.shape, np.nan)
        for m in range(s // 2, n - s // 2):
            d[m] = depth[m] - depth[m - s // 2 : m + s // 2 + 1].mean(0)
        deltas.append(d)
    return depth, slope, deltas


@pytest.mark.parametrize("block", [50_000, 64])
def test_longitudinal_against_the_plain_rule(spark, block):
    rng = np.random.default_rng(1)
    a = 50 + np.cumsum(rng.normal(0, 0.002, (400, 5)), 0)
    a[rng.random(a.shape) < 0.2] = np.nan
    a[100:140] = np.nan
    b = 50 + np.cumsum(rng.normal(0, 0.002, (60, 5)), 0)
    none = np.full((50, 5), np.nan)
    df = spark.createDataFrame(_points(a, 1) + _points(b, 2) + _points(none, 3), SCHEMA)
    got = {(r["cluster"], r["lane"], r["index"]): r for r in planeness.longitudinal(df, block=block).collect()}
    assert len(got) == 510 * 5
    for cluster, h in ((1, a), (2, b)):
        depth, slope, deltas = _along(h)
        for i in range(len(h)):
            for lane in range(5):
                r = got[cluster, lane, i]
                for want, name in ((depth, "depth_mid"), (slope, "gradient"), *zip(deltas, planeness.DELTAS)):
                    v = want[i, lane]
                    assert (r[name] is None and np.isnan(v)) or abs(r[name] - v) < 1e-9, (cluster, lane, i, name)
    assert all(got[3, lane, i]["depth_mid"] is None for lane in range(5) for i in range(50))
    flat = planeness.longitudinal(df.filter("cluster = 3"), True).filter("depth_mid is not null").collect()
    assert len(flat) == 10 * 5 and {r["depth_mid"] for r in flat} == {0.0}
    assert planeness.longitudinal(df.limit(0)).count() == 0


def test_transverse_against_the_plain_rule(spark):
    rng = np.random.default_rng(2)
    h = 50 + np.cumsum(rng.normal(0, 0.004, (40, 25)), 1)
    h[rng.random(h.shape) < 0.15] = np.nan
    h[7] = np.nan  # filled in from its neighbours along the lanes
    h[9, 22:] = np.nanmax(h) + 0.5  # a kerb
    got = {r["index"]: r for r in planeness.transverse(spark.createDataFrame(_points(h, 4), SCHEMA)).collect()}
    full = profiles.fill_row(profiles.mask_kerbs(profiles.fill_row(profiles.fill_row(h).T).T))
    (ll, lw), (rl, rw) = profiles.rut_and_water(full[:, :13]), profiles.rut_and_water(full[:, 12:])
    x = np.arange(25) - 12.0
    for i in range(40):
        want = (ll[i], rl[i], lw[i], rw[i], -100 * (full[i] @ x) / (x @ x))
        assert np.allclose([got[i][c] for c in (*planeness.SIDES, "gradient")], want, atol=1e-9)
        assert [got[i][c] for c in ("lx0", "ly0", "lx1", "ly1")] == pytest.approx([i * 0.1, 0.0, i * 0.1, 2.4])


def test_areas_without_points_stay(spark):
    areas = spark.createDataFrame([(1, "A", "A", "p"), (2, "A", "N", "q"), (3, "P", "B", "r")], "area_id long, bw string, fk string, geometry string")
    names = ["depth_mid", *planeness.DELTAS, "gradient"]
    points = spark.createDataFrame([(1, 0.0025, *[0.001] * 4, 1.5), (1, 0.0015, *[0.003] * 4, None), (2, 0.1, *[0.0] * 4, 1.0)], "area_id long, " + ", ".join(f"{n} double" for n in names))
    lines = spark.createDataFrame([(1, 0.004, None, 0.001, 0.002, 2.0), (1, 0.002, None, float("nan"), 0.004, 4.0)], "area_id long, " + ", ".join(f"{n} double" for n in (*planeness.SIDES, "gradient")))
    got = {r["area_id"]: r for r in planeness.to_ap9(planeness.aggregate(areas, points, lines)).collect()}
    r = got[1]
    assert (r["SM4L_M"], r["SM4L_A"], r["S01"], r["LN"], r["MSPTL"], r["MSPTR"], r["MSPT"], r["SPTMAX"], r["MSPHL"], r["MSPH"], r["QN"]) == (2.5, 2.0, 1.0, 1.5, 3.0, None, 3.0, 4.0, 1.0, 3.0, 3.0)
    assert got[2]["SM4L_M"] is None and got[3]["SM4L_M"] is None and got[3]["geometry"] == "r" and "depth_mid_max" not in r.asDict()
    assert planeness.to_ap9(planeness.aggregate(areas, points, lines), only=True).columns == ["area_id", "geometry", *planeness.AP9.values()]


def _road(rng):
    """Laser points on a 2.5 cm grid along a straight line: a plane across with a rut 1 m right of the line, and a few far above."""
    x, y = (a.ravel() for a in np.meshgrid(np.arange(-2, 32, 0.05), np.arange(-1.5, 1.5, 0.05)))
    z = 50 + 0.01 * y - 0.02 * np.exp(-(((y + 0.75) / 0.2) ** 2)) + 0.004 * np.sin(x)
    return [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, z))] + [(10**6 + k, 0.3 * k, 0.0, 58.0) for k in range(30)]


def test_the_whole_run(spark, tmp_path):
    recordings = spark.createDataFrame([("run", 10 + k, f"r{k}", 5.0 * k, 0.0) for k in range(7)] + [("run", 99, "alone", 900.0, 0.0)], "run_id string, image_no long, recording_id string, x double, y double")
    cloud = spark.createDataFrame(_road(np.random.default_rng(3)), "point_id long, x double, y double, z double")
    sq = lambda x, y, w, h: f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}))"
    areas = spark.createDataFrame([(1, "A", "A", sq(5.03, -3.03, 10, 6)), (2, "P", "B", sq(15.03, -3.03, 10, 6)), (3, "A", "B", sq(500, 0, 5, 5)), (4, "A", "N", sq(5.03, -3.03, 4, 6))], "area_id long, bw string, fk string, geometry string").withColumn("owner", F.lit("city"))
    damage = spark.createDataFrame([("r", sq(6.1, 0.1, 0.5, 0.5)), ("of", sq(16.2, 0.2, 0.5, 0.5)), ("r", sq(40.0, 0, 1, 1))], "typ string, geometry string")
    settings = config.parse({"weights": {"evenness": {"SM4L": 0.5, "MSPT": 0.25}}})
    assert settings.weights.evenness == {"SM4L": 0.5, "MSPT": 0.25, "MSPH": 0.25} and settings.weights.paved_evenness["MSPT"] == 0.5
    got = {r["area_id"]: r for r in pipeline.full_run(spark, areas, recordings, cloud, damage, settings, f"file://{tmp_path}/out").collect()}
    a = got[1]
    assert a["owner"] == "city" and 15 < a["mspt"] < 20 and 0.05 < a["qn"] < 0.25 and 0 < a["sm4l_m"] < 8 and a["riss"] == round(100 / 60, 2)
    assert a["GW"] is not None and a["TWGEB"] is not None and a["GK"] in (1, 2, 3, 4)
    assert got[2]["riss"] is None and got[2]["ofs"] > 1 and got[3]["sm4l_m"] is None and got[3]["riss"] == 0.0 and got[4]["sm4l_m"] is None
    other = config.parse({"weights": {"evenness": {"SM4L": 0.0, "MSPT": 1.0, "MSPH": 0.0}}})
    again = {r["area_id"]: r for r in pipeline.reevaluate(spark, f"file://{tmp_path}/out", other, f"file://{tmp_path}/again").collect()}
    assert again[1]["TWGEB"] == again[1]["ZWMSPT"] or again[1]["TWGEB"] > 3.5
    with pytest.raises(ValueError):
        pipeline.reevaluate(spark, "x/", other, "x")


@pytest.mark.parametrize("row, why", [((None, "A", "A"), "area_id"), ((1, "Q", "A"), "bw"), ((1, "A", None), "bw"), ((1, "A", "A"), "crossing")])
def test_bad_areas(spark, row, why):
    ring = "POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))" if why == "crossing" else "POLYGON ((0 0, 4 0, 4 4, 0 0))"
    df = spark.createDataFrame([(*row, ring)], "area_id long, bw string, fk string, geometry string")
    with pytest.raises(Exception, match=why):
        pipeline.check_areas(df).collect()
    with pytest.raises(ValueError):
        pipeline.check_areas(df, "4326", config.Settings())


def test_pseudo_lanes_and_layers(spark):
    rec = spark.createDataFrame([("a", k, f"r{k}", 5.0 * k, 0.0) for k in range(3)], "run_id string, image_no long, recording_id string, x double, y double")
    lanes = spark.createDataFrame([(1, "LINESTRING (0 50, 22 50)"), (2, "POINT (1 1)"), (3, None), (4, "LINESTRING (0 0, 3 0)")], "id long, geometry string")
    got = sampling.create(rec, lanes)
    assert {r["recording_id"] for r in got.select("recording_id").distinct().collect()} == {"r0", "r1", "r2", sampling.PSEUDO} and got.select("cluster").distinct().count() == 2
    layer = spark.createDataFrame([("r1",)], "recording_id string")
    assert {r["recording_id"] for r in sampling.of_layer(got, layer).select("recording_id").distinct().collect()} == {"r1", sampling.PSEUDO}
    assert {r["recording_id"] for r in sampling.of_layer(got, layer, 1).select("recording_id").distinct().collect()} == {"r1"}
