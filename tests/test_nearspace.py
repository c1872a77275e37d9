import numpy as np
import pytest

from pavelens.functions import wkt
from pavelens.operators import nearspace


def test_wkt_spellings():
    s = wkt.parse_wkt(["POINT (1 2)", "srid=25832;point z(1 2 9)", None, "", "POINT EMPTY", "POLYGON((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "POINT (1 x)", "POLYGON ((0 0, 1 1", "CIRCLE (1 2)", "POINT M (1 2 3)", "POINT (1e1 -2.5E0)"])
    assert s.count().tolist() == [1, 1, 0, 0, 0, 8, 8, 0, 0, 0, 1, 1]
    assert s.first.tolist()[2:18] == [True, False, False, False] * 4
    assert (s.x[-1], s.y[-1]) == (10, -2.5)


@pytest.mark.parametrize("metric", ["plane", "great_circle"])
def test_tree_finds_all(metric):
    rng = np.random.default_rng(1)
    x, y = rng.uniform(7, 7.01, 700), rng.uniform(50, 50.01, 700)
    x[:60], y[:60] = x[0], y[0]
    reach = rng.uniform(0, 1e-3 if metric == "plane" else 90, 700)
    m = nearspace.METRICS[metric]
    tree = nearspace.VantageTree(x, y, reach, m)
    r = np.full(700, 1e-3 if metric == "plane" else 80.0)
    q, p, d = tree.within(x, y, r)
    full = m(x[:, None], y[:, None], x, y)
    assert set(zip(q, p)) == set(zip(*np.nonzero(full <= r[:, None] + reach + nearspace.SLACK)))
    assert (tree.near(x + 1e-4, y) >= m((x + 1e-4)[:, None], y[:, None], x, y).min(1) - 1e-9).all()


@pytest.mark.parametrize("block", [1_000, 40])
def test_pairs_and_regions_against_brute_force(spark, block):
    rng = np.random.default_rng(2)
    pts = [(i, f"r{i % 3}", f"POINT ({x:.3f} {y:.3f})", "clash") for i, (x, y) in enumerate(rng.uniform(0, 60, (500, 2)))]
    pts += [(1000 + i, f"r{i % 3}", "POINT (30.000 30.000)", "clash") for i in range(90)]  # a third in one place
    pts += [pts[0], (2000, None, "POINT (30 30)", None), (2001, "r1", None, None), (2002, "r1", "POINT EMPTY", None), (None, "r1", "POINT (1 1)", None)]
    df = spark.createDataFrame(pts, "id long, grp string, geometry string, cell string")
    got = nearspace.radius_pairs(df, 2.5, cell_rows=50, block_rows=block).collect()
    xy = {i: tuple(map(float, g[7:-1].split())) for i, _, g, _ in pts if i is not None and g and "EMPTY" not in g}
    run = {i: r for i, r, _, _ in pts}
    want = {(a, b) for a in xy for b in xy if a < b and run[a] and run[b] and run[a] != run[b] and np.hypot(xy[a][0] - xy[b][0], xy[a][1] - xy[b][1]) <= 2.5}
    assert sorted((r["a_id"], r["b_id"]) for r in got) == sorted(want)

    boxes = [(i, f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + 3}, {x} {y + 3}, {x} {y}))") for i, (x, y, w) in enumerate(np.round(rng.uniform(0, 50, (80, 3)), 2).tolist())]
    hole = (500, "POLYGON ((10 10, 40 10, 40 40, 10 40, 10 10), (29 29, 31 29, 31 31, 29 31, 29 29))")
    regions = spark.createDataFrame([*boxes, boxes[3], hole, (501, None), (502, "POLYGON EMPTY")], "id long, geometry string")
    small = [(i, f"POLYGON (({x} {y}, {x + 1} {y}, {x + 1} {y + 1}, {x} {y}))") for i, (x, y) in enumerate(np.round(rng.uniform(0, 59, (200, 2)), 3).tolist())] + [(300, "POLYGON ((28 28, 32 28, 32 32, 28 32, 28 28))")]
    objects = df.selectExpr("'p' as kind", "id", "geometry").union(spark.createDataFrame(small, "id long, geometry string").selectExpr("'s' as kind", "id", "geometry"))
    got = {tuple(r) for r in nearspace.containing_regions(objects, regions, cell_rows=40, block_rows=block).collect()}
    inside = lambda x, y, k: (lambda b: b[0] < x < b[1] and b[2] < y < b[3])(ext[k]) and not (k == 500 and 29 < x < 31 and 29 < y < 31)
    num = lambda g: np.array([list(map(float, p.split())) for p in g[10:].split(")")[0].split(",")])
    ext = {i: (*np.array([num(g).min(0), num(g).max(0)]).T.ravel(),) for i, g in [*boxes, hole]}
    want = {("p", i, k) for i, (x, y) in xy.items() for k in ext if inside(x, y, k)}
    for i, g in small:
        for k in ext:
            v = num(g)
            if all(inside(x, y, k) for x, y in v) and not (k == 500 and v[:, 0].min() < 31 and v[:, 0].max() > 29 and v[:, 1].min() < 31 and v[:, 1].max() > 29):
                want.add(("s", i, k))
    assert got == want and ("s", 300, 500) not in got


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, grp string, geometry string")
    assert nearspace.radius_pairs(none, 1.0).count() == 0
    assert nearspace.containing_regions(none.selectExpr("'p' as kind", "id", "geometry"), none).count() == 0


@pytest.mark.parametrize("cell_rows, block", [(4_000, 40_000), (30, 60), (10_000, 50)])
def test_great_circle_pairs_against_brute_force(spark, cell_rows, block):
    rng = np.random.default_rng(3)
    xy = np.round(np.concatenate([np.column_stack([rng.uniform(-180, 180, 200), rng.uniform(-85, 85, 200)]), rng.normal([7.0, 50.0], 0.01, (400, 2)), np.repeat([[7.0, 50.0]], 30, 0)]), 6)
    rows = [(i, f"r{i % 2}", f"POINT ({x!r} {y!r})") for i, (x, y) in enumerate(xy.tolist())]
    d = nearspace.great_circle(xy[:, 0][:, None], xy[:, 1][:, None], xy[:, 0], xy[:, 1])
    want = {(i, j) for i, j in zip(*np.nonzero(d <= 150.0)) if i < j and (i + j) % 2}
    got = nearspace.radius_pairs(spark.createDataFrame(rows, "id long, grp string, geometry string"), 150.0, "great_circle", cell_rows, block).collect()
    assert sorted((r["a_id"], r["b_id"]) for r in got) == sorted(want) and len(want) > 500
