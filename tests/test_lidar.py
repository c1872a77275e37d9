import numpy as np
import pytest
from pyspark.sql import functions as F

from pavelens.operators import lidar


def _cloud(seed, n):
    rng = np.random.default_rng(seed)
    xy = np.round(np.concatenate([rng.uniform(0, 30, (n, 2)), rng.normal(12, 0.4, (n, 2)), np.repeat([[3.0, 3.0]], 20, 0)]), 3)
    z = np.round(rng.uniform(0, 2, len(xy)), 3)
    return [(i, float(x), float(y), float(h)) for i, ((x, y), h) in enumerate(zip(xy, z))]


@pytest.mark.parametrize("block_rows", [50_000, 40, 7])
def test_nearest_against_brute_force(spark, block_rows):
    left, right = _cloud(1, 150), _cloud(2, 200)
    l = spark.createDataFrame(left + [(9_000, None, 1.0, 1.0), (9_001, float("nan"), 1.0, 1.0)], "lid long, x double, y double, z double").withColumn("right", F.lit("clash"))
    r = spark.createDataFrame(right + [(9_000, None, 1.0, 1.0)], "rid long, rx double, ry double, z double")
    got = {}
    for row in lidar.nearest(l, r, "lid", "rid", 1.5, 4, ("z",), wide=8.0, block_rows=block_rows).collect():
        got[row["lid"], row["rank"]] = (row["rid"], row["d2"], row["z"])
    want = {}
    for i, x, y, _ in left:
        near = sorted(((x - a) * (x - a) + (y - b) * (y - b), j, h) for j, a, b, h in right)
        for k, (d2, j, h) in enumerate([n for n in near if n[0] <= 1.5 * 1.5][:4]):
            want[i, k + 1] = (j, d2, h)
    assert got == want and len(want) > 400
    assert lidar.nearest(l.limit(0), r, "lid", "rid", 1.5, 4).count() == 0 == lidar.nearest(l, r.limit(0), "lid", "rid", 1.5, 4).count()


@pytest.mark.parametrize("block_rows", [50_000, 30])
def test_outliers_in_space(spark, block_rows):
    rows = _cloud(3, 300) + [(5_000, 12.0, 12.0, 12.0)]  # high above the densest place
    df = spark.createDataFrame(rows, "id long, x double, y double, z double")
    p = np.array([r[1:] for r in rows])
    some = p[np.array([r[0] for r in rows]) % 5 == 0]
    n = (((p[:, None] - some[None]) ** 2).sum(2) < 0.25).sum(1)
    want = {r[0] for r, k in zip(rows, n) if k < 4}
    got = {r["id"] for r in lidar.outliers(df, "id", wide=16.0, block_rows=block_rows).collect()}
    assert got == want and 5_000 in got and 0 < len(want) < len(rows)
    assert lidar.outliers(df, "id", threshold=0).count() == 0
    with pytest.raises(ValueError):
        lidar.outliers(df, "id", subsample=0)


def _ground_of_bin(z, bin_m=0.02, least=10, look=10, around=2):
    low, bins = z.min(), int(np.ceil((z.max() - z.min()) / bin_m))
    if bins == 0:
        return np.ones(len(z), bool)
    hist = np.bincount(np.minimum(np.floor((z - low) / bin_m).astype(int), bins - 1), minlength=bins)
    first = int(np.argmax(hist > least))
    top = first + int(np.argmax(hist[first : first + look]))
    return (z >= low + bin_m * max(top - around, 0)) & (z < low + bin_m * min(top + around + 1, bins))


def test_ground_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(40):
        n = int(rng.integers(1, 60))
        z = np.round(rng.choice([0.0, 0.02, 0.03, 0.5, 3.0], n) + (rng.uniform(0, 0.02, n) if c % 2 else 0), 4)
        rows += [(c, k, 0.2 * c + 0.1, 0.1, float(v)) for k, v in enumerate(z)]
    rows += [(99, 0, 40.1, 0.1, 7.0)] + [(98, k, 30.1, 0.1, v) for k, v in enumerate([1.0] * 8 + [4.0])]
    got = {(r["c"], r["k"]) for r in lidar.ground(spark.createDataFrame(rows, "c int, k int, x double, y double, z double")).collect()}
    want = set()
    for c in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == c]
        want |= {(c, r[1]) for r, on in zip(mine, _ground_of_bin(np.array([r[4] for r in mine]))) if on}
    assert got == want and (98, 8) not in got and (99, 0) in got


def _fold(lines, overlap=15.0, apart=2.0):
    order = sorted(lines, key=lambda k: (np.mean(lines[k][:, 2]), k))
    layers, now = [], None
    for k in order:
        if now is None:
            now = [k]
            continue
        a, b = np.concatenate([lines[m] for m in now]), lines[k]
        near = np.hypot(a[:, None, 0] - b[None, :, 0], a[:, None, 1] - b[None, :, 1]) < overlap
        if (np.abs(a[:, None, 2] - b[None, :, 2])[near] < apart).all():
            now.append(k)
        else:
            layers.append(now)
            now = [k]
    layers.append(now)
    layers.sort(key=lambda ks: np.mean(np.concatenate([lines[k][:, 2] for k in ks])))
    return {k: i for i, ks in enumerate(layers) for k in ks}


@pytest.mark.parametrize("block_rows", [50_000, 10])
def test_height_layers_against_fold(spark, block_rows):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for tile in ("a", "b", "c"):
        lines = {k: np.column_stack([rng.uniform(0, 60, 6), rng.uniform(0, 60, 6), rng.choice([1.0, 2.5, 6.0, 9.0]) + rng.uniform(0, 0.5, 6)]) for k in range(7)}
        want |= {(tile, k): v for k, v in _fold(lines).items()}
        rows += [(tile, k, *map(float, p)) for k, pts in lines.items() for p in pts]
    df = spark.createDataFrame(rows + [("a", 0, None, 1.0, None)], "tile string, line long, x double, y double, height double")
    got = {(r["tile"], r["line"]): r["layer"] for r in lidar.height_layers(df, block_rows=block_rows).collect()}
    assert got == want and max(want.values()) > 1
    assert lidar.height_layers(df.limit(0)).count() == 0
