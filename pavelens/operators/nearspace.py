"""Points near other points, and the regions that contain points or polygons, for very many of each.

Pivots cut the space into Voronoi cells; a query lies in the cell of its nearest pivot, and what it
could match is replicated to every cell that the triangle inequality can't rule out: an object with
centre c and reach R goes to the pivots p with d(c, p) <= d(c, nearest pivot) + 2 R. In a cell a
vantage-point tree finds the candidates and an exact test decides. The join is complete.

Crowded cells get pivots of their own, drawn from their rows, and are cut by the same rule once more, so cells stay small
however many rows there are. What is still crowded then lies at nearly one place: it is cut into blocks of queries and
blocks of objects, each pair of blocks a task of its own, so no task holds more than two blocks.

Null, empty and unreadable geometries match nothing. Rows repeated with the same id and geometry count
once. Boundaries: distances up to and including the radius match; points on an outline are undefined.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelens.functions import wkt
from pavelens.session import Scratch

EARTH_RADIUS_M = 6_371_008.8
#: Bound on the pivots that go to every task (1 MB); also the bound on the sample that they come from.
MAX_PIVOTS = 65_536
SLACK = 1e-6


def plane(ax, ay, bx, by):
    return np.hypot(ax - bx, ay - by)


def great_circle(ax, ay, bx, by):
    """Metres between points given as longitude and latitude in degrees."""
    ax, ay, bx, by = map(np.radians, (ax, ay, bx, by))
    h = np.sin((by - ay) / 2) ** 2 + np.cos(ay) * np.cos(by) * np.sin((bx - ax) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


METRICS: dict[str, Callable] = {"plane": plane, "great_circle": great_circle}


class VantageTree:
    """Vantage-point tree over points that reach `reach` around themselves; searched with many queries at once."""

    LEAF = 48

    def __init__(self, x: np.ndarray, y: np.ndarray, reach: np.ndarray, metric: Callable):
        self.x, self.y, self.reach, self.metric = x, y, reach, metric
        self.nodes: list[tuple] = []
        rng = np.random.default_rng(7)
        todo = [(np.arange(len(x)), -1, 0)] if len(x) else []
        while todo:
            rows, parent, side = todo.pop()
            me = len(self.nodes)
            if len(rows) <= self.LEAF:
                self.nodes.append(("leaf", rows))
            else:
                v = rows[rng.integers(len(rows))]
                rest = rows[rows != v]
                d = metric(x[v], y[v], x[rest], y[rest])
                order = np.argsort(d, kind="stable")
                half = len(rest) // 2
                kids = []
                for part in (order[:half], order[half:]):
                    kids.append([-1, d[part].min(), d[part].max(), reach[rest[part]].max()])
                    todo.append((rest[part], me, len(kids) - 1))
                self.nodes.append(("node", v, kids))
            if parent >= 0:
                self.nodes[parent][2][side][0] = me

    def near(self, qx: np.ndarray, qy: np.ndarray) -> np.ndarray:
        """An upper bound on each query's distance to its nearest point: the best on one way down the tree."""
        best = np.full(len(qx), np.inf)
        todo = [(0, np.arange(len(qx)))] if self.nodes else []
        while todo:
            n, q = todo.pop()
            if not len(q):
                continue
            kind, *rest = self.nodes[n]
            if kind == "leaf":
                rows = rest[0]
                for lo in range(0, len(q), 20_000):
                    p = q[lo : lo + 20_000]
                    best[p] = np.minimum(best[p], self.metric(qx[p, None], qy[p, None], self.x[rows], self.y[rows]).min(1))
                continue
            v, kids = rest
            d = self.metric(qx[q], qy[q], self.x[v], self.y[v])
            best[q] = np.minimum(best[q], d)
            left = d <= (kids[0][2] + kids[1][1]) / 2
            todo += [(kids[0][0], q[left]), (kids[1][0], q[~left])]
        return best

    def within(self, qx: np.ndarray, qy: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, distance) of all with distance <= radius + reach."""
        qs, ps, ds = [], [], []
        todo = [(0, np.arange(len(qx)))] if self.nodes and len(qx) else []
        while todo:
            n, q = todo.pop()
            kind, *rest = self.nodes[n]
            if kind == "leaf":
                rows = rest[0]
                for lo in range(0, len(q), 20_000):
                    p = q[lo : lo + 20_000]
                    d = self.metric(qx[p, None], qy[p, None], self.x[rows], self.y[rows])
                    i, j = np.nonzero(d <= radius[p, None] + self.reach[rows] + SLACK)
                    qs.append(p[i])
                    ps.append(rows[j])
                    ds.append(d[i, j])
                continue
            v, kids = rest
            d = self.metric(qx[q], qy[q], self.x[v], self.y[v])
            hit = d <= radius[q] + self.reach[v] + SLACK
            qs.append(q[hit])
            ps.append(np.full(hit.sum(), v))
            ds.append(d[hit])
            for child, near, far, reach in kids:
                r = radius[q] + reach + SLACK
                go = q[(d >= near - r) & (d <= far + r)]
                if len(go):
                    todo.append((child, go))
        if not qs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate(qs), np.concatenate(ps), np.concatenate(ds)


def choose_pivots(frames: list[DataFrame], cell_rows: int) -> np.ndarray:
    """Pivots drawn by a hash of the id, so that crowded places get more of them. At most MAX_PIVOTS; they only shape the cells."""
    total = sum(f.count() for f in frames)
    want = int(min(MAX_PIVOTS, max(1, total // cell_rows)))
    share = int(min(1.0, 1.3 * want / max(1, total)) * (1 << 30))
    number = r"\(+\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)"
    picked = None
    for f in frames:
        first = f.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= share).select(*[F.regexp_extract("geometry", number, i).try_cast("double").alias(c) for i, c in ((1, "x"), (2, "y"))])
        picked = first if picked is None else picked.union(first)
    rows = picked.filter("x is not null and y is not null").distinct().limit(2 * MAX_PIVOTS).toPandas().sort_values(["x", "y"])
    if not len(rows):
        return np.zeros((1, 2))
    at = np.unique(np.linspace(0, len(rows) - 1, min(want, len(rows))).round().astype(int)) if len(rows) > want else np.arange(len(rows))
    return rows.to_numpy()[at]


_PLACED = "cell int, build boolean, kind string, id bigint, grp string, x double, y double, reach double, xy binary, first binary"
_PLACED_NAMES = [c.split()[0] for c in _PLACED.split(", ")]


def place(df: DataFrame, pivots, metric: str, build: bool, radius: float, keep_shape: bool) -> DataFrame:
    """df(kind, id, grp, geometry) with the cell of each query, or the cells of each object to match."""

    def run(batches):
        measure = METRICS[metric]
        p = pivots.value
        tree = VantageTree(p[:, 0].copy(), p[:, 1].copy(), np.zeros(len(p)), measure)
        for b in batches:
            s = wkt.parse_wkt(b.column("geometry").to_pylist())
            rows = np.flatnonzero(s.count() > 0)
            if not len(rows):
                continue
            lo = s.start[:-1][rows]
            if build:
                x = (np.minimum.reduceat(s.x, lo) + np.maximum.reduceat(s.x, lo)) / 2
                y = (np.minimum.reduceat(s.y, lo) + np.maximum.reduceat(s.y, lo)) / 2
                n = s.count()[rows]
                reach = np.maximum.reduceat(measure(np.repeat(x, n), np.repeat(y, n), s.x, s.y), np.cumsum(n) - n)
                widen = 2 * (reach + radius)
            else:
                x, y, reach = s.x[lo], s.y[lo], np.zeros(len(rows))
                widen = np.zeros(len(rows))
            q, cell = _to_pivots(tree, x, y, widen, np.full(len(rows), build))
            at = pa.array(rows[q])
            if keep_shape:
                xy, first = (c.take(at) for c in wkt.to_binary(s))
            else:
                xy = first = pa.nulls(len(q), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(np.full(len(q), build)), b.column("kind").take(at), b.column("id").take(at), b.column("grp").take(at),
                 pa.array(x[q]), pa.array(y[q]), pa.array(reach[q]), xy, first],
                names=["cell", "build", "kind", "id", "grp", "x", "y", "reach", "xy", "first"],
            )

    return df.select("kind", F.col("id").cast("bigint").alias("id"), F.col("grp").cast("string").alias("grp"), F.col("geometry").cast("string").alias("geometry")).mapInArrow(run, _PLACED)


def _match(t: pa.Table, metric: str, radius: float, relation: str) -> pa.Table:
    build = t.column("build").to_numpy(zero_copy_only=False)
    col = lambda n, at: t.column(n).to_numpy(zero_copy_only=False)[at]
    ids = t.column("id").to_numpy()

    def once(at):  # repeated rows lie in one block; the shape tells different geometries of an id apart
        if not len(at):
            return at
        x, y, r = (col(c, at) for c in ("x", "y", "reach"))
        order = np.lexsort((r, y, x, ids[at]))
        k = np.column_stack([x, y, r])[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(ids[at][order]) != 0) | (np.diff(k, axis=0) != 0).any(1)
        if relation != "points":
            # equal circles may hold different outlines: keep these rows if the bytes differ
            shape = t.column("xy").take(pa.array(at[order])).to_pylist()
            new[1:] |= np.array([shape[i] != shape[i - 1] for i in range(1, len(shape))], dtype=bool)
        return at[order][new]

    q, b = once(np.flatnonzero(~build)), once(np.flatnonzero(build))
    none = pa.table({"kind": pa.array([], pa.string()), "a_id": pa.array([], pa.int64()), "b_id": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
    if not len(q) or not len(b):
        return none
    tree = VantageTree(col("x", b), col("y", b), col("reach", b), METRICS[metric])
    i, j, d = tree.within(col("x", q), col("y", q), np.full(len(q), radius))
    if relation == "points":
        group = t.column("grp").combine_chunks().dictionary_encode()
        group = (pa.concat_arrays(group.chunks) if isinstance(group, pa.ChunkedArray) else group).indices.to_numpy(zero_copy_only=False)
        keep = (d <= radius) & (ids[q[i]] < ids[b[j]]) & (group[q[i]] != group[b[j]])
    else:
        outer = wkt.from_binary(t.column("xy").take(pa.array(b)), t.column("first").take(pa.array(b)))
        eo = wkt.edges(outer)
        keep = wkt.inside(col("x", q)[i], col("y", q)[i], j, eo)
        at = np.flatnonzero(keep)
        inner = wkt.from_binary(t.column("xy").take(pa.array(q)), t.column("first").take(pa.array(q)))
        wide = at[inner.count()[i[at]] > 1]  # more than a point: all of it has to be inside
        keep[wide] = wkt.contains(j[wide], eo, i[wide], wkt.edges(inner))
    i, j, d = i[keep], j[keep], d[keep]
    return pa.table({"kind": t.column("kind").take(pa.array(q[i])).combine_chunks(), "a_id": pa.array(ids[q[i]]), "b_id": pa.array(ids[b[j]]), "distance": pa.array(d)})


#: Pivots of a crowded cell at most, and rows of it that one task puts to them.
FINER_PIVOTS, FINER_ROWS = 4_096, 500_000
#: Crowded blocks up to which their list is broadcast (20 bytes each); beyond it they are joined by a shuffle.
BROADCAST_BLOCKS = 200_000


def _crowded(placed: DataFrame, keys: list[str], block_rows: int) -> tuple[DataFrame, int]:
    """Keys with more than block_rows queries or objects, with the numbers of both, and how many such keys there are."""
    counts = placed.groupBy(*keys).agg(F.count_if(F.col("build")).alias("nb"), F.count_if(~F.col("build")).alias("nq"))
    crowded = counts.filter((F.col("nb") > block_rows) | (F.col("nq") > block_rows)).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "nb", "nq")
    many = crowded.count()
    return (F.broadcast(crowded) if many <= BROADCAST_BLOCKS else crowded), many


def finer(heavy: DataFrame, metric: str, radius: float, cell_rows: int) -> DataFrame:
    """Rows of crowded cells (as place() gives them, with n, the rows of their cell) with sub, their cell around the pivots of the crowded one.

    The pivots of a cell come before its rows in each of its tasks, so a task holds these and a batch of rows.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / FINER_ROWS)).cast("int")
    share = F.lit(1 << 30) / F.greatest(F.lit(cell_rows), F.col("n") / FINER_PIVOTS)
    picked = heavy.filter(F.pmod(F.xxhash64("id", F.lit("pivot")), F.lit(1 << 30)) < share)
    names = _PLACED_NAMES
    spread = picked.select("cell", "x", "y", parts.alias("parts")).distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    kinds = {f.name: f.dataType for f in heavy.schema}
    heads = spread.select(F.lit(False).alias("row"), "part", *[F.col(c) if c in ("cell", "x", "y") else F.lit(None).cast(kinds[c]).alias(c) for c in names])
    rows = heavy.select(F.lit(True).alias("row"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"), *names)

    def run(batches):
        measure, at, px, py, tree = METRICS[metric], None, [], [], None
        for b in batches:
            if not b.num_rows:
                continue
            cell, part, row = (b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "part", "row"))
            x, y = (b.column(c).to_numpy(zero_copy_only=False) for c in "xy")
            cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(row.astype(np.int8)) != 0)) + 1
            for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(cell))):
                if (cell[lo], part[lo]) != at:
                    at, px, py, tree = (cell[lo], part[lo]), [], [], None
                if not row[lo]:
                    px.append(x[lo:hi].copy())
                    py.append(y[lo:hi].copy())
                    continue
                if tree is None:
                    p = np.concatenate(px) if px else np.zeros(1), np.concatenate(py) if py else np.zeros(1)
                    tree = VantageTree(*p, np.zeros(len(p[0])), measure)
                build = b.column("build").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                reach = b.column("reach").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                q, sub = _to_pivots(tree, x[lo:hi], y[lo:hi], np.where(build, 2 * (reach + radius), 0.0), build)
                take = pa.array(lo + q)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in names), pa.array(sub, pa.int32())], names=[*names, "sub"])

    # among rows of one cell and part the pivots come first
    ordered = heads.union(rows).repartition("cell", "part").sortWithinPartitions("cell", "part", "row")
    return ordered.mapInArrow(run, _PLACED + ", sub int")


def _to_pivots(tree: VantageTree, x: np.ndarray, y: np.ndarray, widen: np.ndarray, build: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, pivot): the nearest pivot of a query, and of an object all pivots up to `widen` further away than its nearest."""
    q, p, d = tree.within(x, y, tree.near(x, y) + widen)
    order = np.lexsort((p, d, q))
    q, p, d = q[order], p[order], d[order]
    head = np.flatnonzero(np.diff(q, prepend=-1))
    near = np.repeat(d[head], np.diff(np.append(head, len(q))))
    first = np.zeros(len(q), bool)
    first[head] = True
    keep = np.where(build[q], d <= near + widen[q] + SLACK, first)
    return q[keep], p[keep]


def _blocks(placed: DataFrame, metric: str, radius: float, cell_rows: int, block_rows: int, scratch: Scratch, name: str) -> DataFrame:
    """placed with sub and block: crowded cells cut by place, what is still crowded by id."""
    crowded, many = _crowded(placed, ["cell"], block_rows)  # at most a row per pivot
    if not many:
        return placed.withColumn("sub", F.lit(0)).withColumn("block", F.lit(0))
    joined = placed.join(crowded, F.col("cell") == F.col("_k_cell"), "left")
    heavy = joined.filter("nb is not null").withColumn("n", F.col("nb") + F.col("nq"))
    plain = joined.filter("nb is null").select(*_PLACED_NAMES, F.lit(0).alias("sub"))
    cut = scratch.keep(plain.union(finer(heavy, metric, radius, cell_rows)), name)
    crowded, many = _crowded(cut, ["cell", "sub"], block_rows)
    if not many:
        return cut.withColumn("block", F.lit(0))
    parts = lambda c: F.greatest(F.lit(1), F.ceil(F.coalesce(F.col(c), F.lit(0)) / block_rows)).cast("int")
    joined = cut.join(crowded, (F.col("cell") == F.col("_k_cell")) & (F.col("sub") == F.col("_k_sub")), "left")
    pb, pq, h = parts("nb"), parts("nq"), F.xxhash64("id")
    own = F.when(F.col("build"), F.pmod(h, pb)).otherwise(F.pmod(h, pq)).cast("int")
    block = F.when(F.col("build"), F.transform(F.sequence(F.lit(0), pq - 1), lambda k: own * pq + k)).otherwise(F.transform(F.sequence(F.lit(0), pb - 1), lambda k: k * pq + own))
    return joined.withColumn("block", F.explode(block)).drop("_k_cell", "_k_sub", "nb", "nq")


def _join(queries: DataFrame, builds: DataFrame, pivots, metric: str, radius: float, relation: str, scratch: Scratch, block_rows: int, cell_rows: int) -> DataFrame:
    shape = relation != "points"
    placed = place(queries, pivots, metric, False, 0.0, shape).union(place(builds, pivots, metric, True, radius, shape))
    placed = _blocks(scratch.keep(placed, f"placed-{relation}"), metric, radius, cell_rows, block_rows, scratch, f"finer-{relation}")
    return placed.groupBy("cell", "sub", "block").applyInArrow(lambda t: _match(t, metric, radius, relation), "kind string, a_id bigint, b_id bigint, distance double")


def _pivots(spark: SparkSession, frames: list[DataFrame], cell_rows: int):
    return spark.sparkContext.broadcast(choose_pivots(frames, cell_rows))


def radius_pairs(points: DataFrame, radius: float, metric: str = "plane", cell_rows: int = 4_000, block_rows: int = 40_000, pivots=None, scratch: Scratch | None = None) -> DataFrame:
    """points(id, grp, geometry) → (a_id, b_id, distance), a_id < b_id, of all pairs of different non-null grp within radius."""
    spark = points.sparkSession
    points = points.filter("grp is not null and id is not null and geometry is not null").withColumn("kind", F.lit("point"))
    pivots = pivots or _pivots(spark, [points], cell_rows)
    return _join(points, points, pivots, metric, radius, "points", scratch or Scratch(spark, "nearspace"), block_rows, cell_rows).drop("kind")


def containing_regions(objects: DataFrame, regions: DataFrame, cell_rows: int = 4_000, block_rows: int = 40_000, pivots=None, scratch: Scratch | None = None) -> DataFrame:
    """objects(kind, id, geometry) × regions(id, geometry) → (kind, a_id, b_id) where the region contains all of the object."""
    spark = objects.sparkSession
    objects = objects.select("kind", "id", F.lit(None).cast("string").alias("grp"), "geometry").filter("id is not null and geometry is not null")
    regions = regions.select(F.lit("region").alias("kind"), "id", F.lit(None).cast("string").alias("grp"), "geometry").filter("id is not null and geometry is not null")
    pivots = pivots or _pivots(spark, [objects, regions], cell_rows)
    return _join(objects, regions, pivots, "plane", 0.0, "regions", scratch or Scratch(spark, "nearspace"), block_rows, cell_rows).drop("distance")
