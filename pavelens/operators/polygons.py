"""Polygons, holes and several pieces included: what lies in areas, damage on a 1 m raster, the damaged share of areas.

Areas go to the grid squares that they touch with their outline (only the part around a square, if they are large);
points, lines and cells go to their own square, so every join is one on whole numbers and its test runs on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelens.functions import wkt
from pavelens.functions.scalars import round_exact
from pavelens.operators.areas import CELL_M2, GROUPS, MODES, PIXEL_M, TYPES, sieve
from pavelens.session import Scratch


def clip_ring(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """The part of a ring's surface in a rectangle: cut along one side after another."""
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        if not len(ring):
            break
        d = sign * (ring[:, axis] - bound)
        nxt, dn = np.roll(ring, -1, 0), np.roll(d, -1)
        cross = (d > 0) != (dn > 0)
        t = np.divide(d, d - dn, out=np.zeros_like(d), where=cross)
        out = np.empty((2 * len(ring), 2))
        out[0::2], out[1::2] = ring, ring + t[:, None] * (nxt - ring)
        ring = out[np.column_stack([d > 0, cross]).ravel()]
    return ring


def surface(ring: np.ndarray) -> float:
    if len(ring) < 3:
        return 0.0
    p = ring - ring[0]  # near the origin, so that large coordinates don't cost digits
    return 0.5 * float(np.sum(p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1]))


class Polygon:
    """Rings with a sign: +1 for a piece, -1 for a hole, told by how many other rings they lie in."""

    def __init__(self, x: np.ndarray, y: np.ndarray, first: np.ndarray):
        begin = np.flatnonzero(first)
        begin = begin if len(begin) and begin[0] == 0 else np.append(0, begin)
        self.rings = [np.column_stack([x[a:b], y[a:b]]) for a, b in zip(begin, np.append(begin[1:], len(x)))]
        self.signs = [1] * len(self.rings)
        if len(self.rings) > 1:
            for i, r in enumerate(self.rings):
                depth = sum(_inside(r[0], o) for j, o in enumerate(self.rings) if j != i)
                self.signs[i] = -1 if depth % 2 else 1

    def area(self) -> float:
        return sum(s * abs(surface(r)) for s, r in zip(self.signs, self.rings))

    def area_in(self, x0: float, y0: float, x1: float, y1: float) -> float:
        return sum(s * abs(surface(clip_ring(r, x0, y0, x1, y1))) for s, r in zip(self.signs, self.rings))


def _inside(p: np.ndarray, ring: np.ndarray) -> bool:
    a, b = ring, np.roll(ring, -1, 0)
    up = (a[:, 1] > p[1]) != (b[:, 1] > p[1])
    a, b = a[up], b[up]
    return int((p[0] < (b[:, 0] - a[:, 0]) * (p[1] - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]).sum()) % 2 == 1


def _polygon(s: wkt.Shapes, i: int) -> Polygon:
    lo, hi = s.start[i], s.start[i + 1]
    return Polygon(s.x[lo:hi], s.y[lo:hi], s.first[lo:hi])


def shape_areas(s: wkt.Shapes) -> np.ndarray:
    """Area of every row at once; rows of several rings are taken singly."""
    out = np.zeros(len(s))
    rows = np.flatnonzero(s.count() > 2)
    if len(rows):
        lo = s.start[:-1]
        ox, oy = np.repeat(s.x[np.minimum(lo, len(s.x) - 1)], s.count()), np.repeat(s.y[np.minimum(lo, len(s.y) - 1)], s.count())
        _, x0, y0, x1, y1 = wkt.edges(s)
        twice = (x0 - ox) * (y1 - oy) - (x1 - ox) * (y0 - oy)
        out[rows] = np.abs(np.add.reduceat(twice, lo[rows])) / 2
        rings = np.add.reduceat(s.first.astype(int), lo[rows])
        for i in rows[rings > 1]:
            out[i] = _polygon(s, i).area()
    return out


def _strip(y: np.ndarray) -> np.ndarray:
    """Integral from 0 to y of the part of a height that lies between 0 and 1."""
    c = np.clip(y, 0.0, 1.0)
    return c * c / 2 + np.maximum(y - 1.0, 0.0)


def areas_in_cells(s: wkt.Shapes, rows: np.ndarray, cx: np.ndarray, cy: np.ndarray, block: int = 1_000_000) -> np.ndarray:
    """Area of row rows[i] in the unit cell at (cx[i], cy[i]), for all i at once.

    The surface of a ring in a cell is the integral over the cell's width of its edges' heights, cut off
    at the cell's bottom and top; each edge has a closed form. Rows of several rings are taken singly,
    as their holes have to be told first.
    """
    out = np.zeros(len(rows))
    rings = np.add.reduceat(s.first.astype(int), s.start[:-1][s.count() > 0]) if len(s.x) else np.zeros(0, int)
    n_rings = np.zeros(len(s), int)
    n_rings[s.count() > 0] = rings
    plain = np.flatnonzero(n_rings[rows] <= 1)
    start, *ends = wkt.edges(s)
    weight = np.cumsum(s.count()[rows[plain]])
    lo = 0
    while lo < len(plain):
        hi = max(lo + 1, int(np.searchsorted(weight, (weight[lo - 1] if lo else 0) + block)))
        at = plain[lo:hi]
        owner, k = wkt.ragged(start, rows[at])
        ax, ay, bx, by = (e[k] for e in ends)
        ox, oy = cx[at][owner], cy[at][owner]
        ax, bx, ay, by = ax - ox, bx - ox, ay - oy, by - oy
        dx = bx - ax
        slope = np.divide(by - ay, dx, out=np.zeros_like(dx), where=dx != 0)
        a, b = np.clip(ax, 0.0, 1.0), np.clip(bx, 0.0, 1.0)
        ya, yb = ay + slope * (a - ax), ay + slope * (b - ax)
        rise = yb - ya
        flat = np.abs(rise) < 1e-7
        mean = np.where(flat, np.clip((ya + yb) / 2, 0.0, 1.0), np.divide(_strip(yb) - _strip(ya), rise, out=np.zeros_like(rise), where=~flat))
        out[at] = np.abs(np.bincount(owner, (b - a) * mean, minlength=len(at)))
        lo = hi
    known: dict[int, Polygon] = {}
    for i in np.flatnonzero(n_rings[rows] > 1):
        p = known.get(rows[i]) or known.setdefault(rows[i], _polygon(s, rows[i]))
        out[i] = p.area_in(cx[i], cy[i], cx[i] + 1, cy[i] + 1)
    return out


def polygon_areas(df: DataFrame, keep: list[str]) -> DataFrame:
    """df(keep, geometry) with area double; 0 for null, empty and other geometries."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches):
        for b in batches:
            s = wkt.parse_wkt(b.column("geometry").to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in [*keep, "geometry"]), pa.array(shape_areas(s))], names=[*keep, "geometry", "area"])

    return df.select(*keep, "geometry").mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in [*keep, "geometry"]) + ", area double")


def _boxes(s: wkt.Shapes):
    """Rows with a surface and their bounding boxes."""
    rows = np.flatnonzero(s.count() > 2)
    if not len(rows):
        return rows, *(np.zeros(0),) * 4
    lo = s.start[:-1][rows]
    ends = np.minimum.reduceat(s.x, lo), np.minimum.reduceat(s.y, lo), np.maximum.reduceat(s.x, lo), np.maximum.reduceat(s.y, lo)
    return rows, *ends


def oriented(p: Polygon) -> list[np.ndarray]:
    """The rings with the surface on their left."""
    return [r if (surface(r) > 0) == (s > 0) else r[::-1] for s, r in zip(p.signs, p.rings)]


def _stack(shapes: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Edges (x0, y0, x1, y1) of all rings and the shape that each belongs to."""
    edges = [np.hstack([r, np.roll(r, -1, 0)]) for rings in shapes for r in rings]
    owner = np.repeat(np.arange(len(shapes)), [sum(map(len, rings)) for rings in shapes])
    return (np.concatenate(edges) if edges else np.zeros((0, 4))), owner


def common_area(part: list[np.ndarray], areas: list[list[np.ndarray]], nudge: float = 1e-8) -> float:
    """Surface of a shape within the union of areas, all given as rings with the surface on their left.

    The outline of what they share consists of the shape's edges inside any area and of the areas' edges inside the
    shape and no other area; its surface is a sum over these pieces. Areas are moved by different 1e-8 m, so that no
    edges lie upon one another; that is the error per metre of outline.
    """
    turn = 2.399963 * np.arange(1, len(areas) + 1)
    moved = [[r + nudge * np.array([np.cos(t), np.sin(t)]) for r in rings] for t, rings in zip(turn, areas)]
    e, owner = _stack([part, *moved])
    if not len(e) or not (owner == 0).any() or not len(areas):
        return 0.0
    x0, y0, x1, y1 = e.T
    dx, dy = x1 - x0, y1 - y0
    cross = dx[:, None] * dy[None, :] - dy[:, None] * dx[None, :]
    bx, by = x0[None, :] - x0[:, None], y0[None, :] - y0[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = (bx * dy[None, :] - by * dx[None, :]) / cross, (bx * dy[:, None] - by * dx[:, None]) / cross
        i, j = np.nonzero((owner[:, None] != owner[None, :]) & (cross != 0) & (t > 0) & (t < 1) & (u >= 0) & (u <= 1))
    n = np.arange(len(e))
    at, place = np.concatenate([n, i, n]), np.concatenate([np.zeros(len(n)), t[i, j], np.ones(len(n))])
    order = np.lexsort((place, at))
    at, place = at[order], place[order]
    same = at[1:] == at[:-1]
    k, a, b = at[:-1][same], place[:-1][same], place[1:][same]
    mx, my = x0[k] + dx[k] * (a + b) / 2, y0[k] + dy[k] * (a + b) / 2
    up = (y0[None, :] > my[:, None]) != (y1[None, :] > my[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        left = up & (mx[:, None] < x0 + dx * (my[:, None] - y0) / dy)
    inside = np.add.reduceat(left, np.searchsorted(owner, np.unique(owner)), axis=1) % 2 == 1
    shapes = np.unique(owner)
    inside[np.arange(len(k)), np.searchsorted(shapes, owner[k])] = False  # of the others
    in_part, in_area = inside[:, 0], inside[:, 1:].any(1)
    keep = np.where(owner[k] == 0, in_area, in_part & ~in_area)
    k, a, b = k[keep], a[keep], b[keep]
    return 0.5 * float(np.sum((x0[k] + dx[k] * a) * (y0[k] + dy[k] * b) - (x0[k] + dx[k] * b) * (y0[k] + dy[k] * a)))


#: An area of at most this many squares goes whole to each of them; of larger ones only what lies around a square.
WHOLE_SQUARES = 16
SQUARE = 32.0


def _take_rings(shapes: list[list[np.ndarray] | None]) -> tuple[pa.Array, pa.Array]:
    """Rings as to_binary() writes them; None is null."""
    first = [None if rings is None else b"".join(b"\1" + b"\0" * (len(r) - 1) for r in rings) for rings in shapes]
    xy = [None if rings is None else np.concatenate(rings).astype("<f8").tobytes() if rings else b"" for rings in shapes]
    return pa.array(xy, pa.binary()), pa.array(first, pa.binary())


def area_squares(areas: DataFrame, keep: list[str], margin: float, size: float = SQUARE) -> DataFrame:
    """areas(keep, geometry) → keep, gx, gy, bx, by, xy, first: the outline in each grid square that the bounding box, `margin` wider, meets.

    bx, by: lower corner of the bounding box. Null, empty and other geometries give nothing.
    """
    kinds = {f.name: f.dataType.simpleString() for f in areas.schema}

    def run(batches):
        for b in batches:
            s = wkt.parse_wkt(b.column("geometry").to_pylist())
            rows, x0, y0, x1, y1 = _boxes(s)
            i0, j0, i1, j1 = (np.floor(v / size).astype(np.int64) for v in (x0 - margin, y0 - margin, x1 + margin, y1 + margin))
            wide, high = i1 - i0 + 1, j1 - j0 + 1
            few = wide * high <= WHOLE_SQUARES
            owner = np.repeat(np.flatnonzero(few), (wide * high)[few])
            nth = np.arange(len(owner)) - np.repeat(np.cumsum((wide * high)[few]) - (wide * high)[few], (wide * high)[few])
            gx, gy = i0[owner] + nth // high[owner], j0[owner] + nth % high[owner]
            xy, first = wkt.to_binary(s)
            names = [*keep, "gx", "gy", "bx", "by", "xy", "first"]

            def give(owner, gx, gy, xy, first):
                at = pa.array(rows[owner])
                return pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in keep), pa.array(gx), pa.array(gy), pa.array(x0[owner]), pa.array(y0[owner]), xy, first], names=names)  # noqa: B023

            yield give(owner, gx, gy, xy.take(pa.array(rows[owner])), first.take(pa.array(rows[owner])))
            for k in np.flatnonzero(~few):
                rings = oriented(_polygon(s, rows[k]))
                for x in range(i0[k], i1[k] + 1):  # column by column, so that a long area isn't cut as a whole for each square
                    strip = [c for r in rings if len(c := clip_ring(r, x * size - margin, -np.inf, (x + 1) * size + margin, np.inf)) > 2]
                    found = []
                    for y in range(j0[k], j1[k] + 1):
                        cut = [c for r in strip if len(c := clip_ring(r, x * size - margin, y * size - margin, (x + 1) * size + margin, (y + 1) * size + margin)) > 2]
                        if cut:
                            found.append((y, cut))
                    if found:
                        n = len(found)
                        yield give(np.full(n, k), np.full(n, x, np.int64), np.array([y for y, _ in found], np.int64), *_take_rings([c for _, c in found]))

    out = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", gx bigint, gy bigint, bx double, by double, xy binary, first binary"
    return areas.select(*keep, "geometry").filter("geometry is not null").mapInArrow(run, out)


def _shapes_of(b: pa.RecordBatch) -> tuple[wkt.Shapes, np.ndarray]:
    """The different outlines of a batch and which of them each row has."""
    both = pa.compute.binary_join_element_wise(b.column("xy"), b.column("first"), pa.scalar(b"", pa.binary()))
    code = both.dictionary_encode()
    k = code.indices.to_numpy(zero_copy_only=False)
    at = pa.array(np.unique(k, return_index=True)[1])
    return wkt.from_binary(b.column("xy").take(at), b.column("first").take(at)), k


def _in_squares(left: DataFrame, squares: DataFrame, columns: list[str], keep: list[str], test: Callable) -> DataFrame:
    """left(columns, gx, gy) joined with squares; test(batch, shapes, which) says which rows stay."""
    kinds = {f.name: f.dataType.simpleString() for f in [*left.schema, *squares.schema]}

    def run(batches):
        for b in batches:
            on = np.flatnonzero(test(b, *_shapes_of(b))) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(on)) for c in [*columns, *keep]], names=[*columns, *keep])

    return left.join(squares, ["gx", "gy"]).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in [*columns, *keep]))


def points_in_areas(points: DataFrame, areas: DataFrame, keep: list[str], size: float = SQUARE) -> DataFrame:
    """points(x, y, …) inner joined with areas(keep, geometry) that have the point inside; a point may be in several. keep: names that points lacks."""
    known = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    p = points.filter(known).withColumn("gx", F.floor(F.col("x") / size).cast("bigint")).withColumn("gy", F.floor(F.col("y") / size).cast("bigint"))

    def test(b, s, k):
        x, y = (b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in "xy")
        return wkt.inside(x, y, k, wkt.edges(s))

    return _in_squares(p, area_squares(areas, keep, 1.0, size), points.columns, keep, test)


def lines_in_areas(lines: DataFrame, areas: DataFrame, keep: list[str], longest: float = 3.0, size: float = SQUARE) -> DataFrame:
    """lines(lx0, ly0, lx1, ly1, …), each up to `longest` long, inner joined with areas(keep, geometry) that they meet; an end inside or an edge crossed.

    A pair meets in the square of the larger of the lower corners of line and area, so it comes once. Longer lines are an error when run.
    """
    lo = {a: F.least(f"l{a}0", f"l{a}1") for a in "xy"}
    hi = {a: F.greatest(f"l{a}0", f"l{a}1") for a in "xy"}
    known = " and ".join(f"{c} is not null and not isnan({c})" for c in ("lx0", "ly0", "lx1", "ly1"))
    fits = (hi["x"] - lo["x"] <= longest) & (hi["y"] - lo["y"] <= longest)
    l = lines.filter(known).filter(F.when(fits, True).otherwise(F.raise_error(F.lit(f"a line is longer than {longest}")).cast("boolean")))
    for a in "xy":
        l = l.withColumn(f"g{a}", F.explode(F.sequence(F.floor(lo[a] / size).cast("bigint"), F.floor(hi[a] / size).cast("bigint"))))

    def test(b, s, k):
        ax, ay, cx, cy, gx, gy, bx, by = (b.column(c).to_numpy(zero_copy_only=False) for c in ("lx0", "ly0", "lx1", "ly1", "gx", "gy", "bx", "by"))
        first = (gx == np.floor(np.maximum(np.minimum(ax, cx), bx) / size)) & (gy == np.floor(np.maximum(np.minimum(ay, cy), by) / size))
        out = np.zeros(len(ax), bool)
        at = np.flatnonzero(first)
        e = wkt.edges(s)
        out[at] = wkt.inside(ax[at], ay[at], k[at], e) | wkt.inside(cx[at], cy[at], k[at], e)
        rest = at[~out[at]]
        own = np.arange(len(rest) + 1), ax[rest], ay[rest], cx[rest], cy[rest]  # one edge a line
        out[rest] = wkt.crossing(k[rest], e, np.arange(len(rest)), own)
        return out

    return _in_squares(l, area_squares(areas, keep, longest + 1.0, size), lines.columns, keep, test)


def boxes_in_areas(boxes: DataFrame, areas: DataFrame, keep: list[str], largest: float = 200.0, size: float = 64.0) -> DataFrame:
    """boxes(x0, y0, x1, y1, …), each up to `largest` wide and high, inner joined with areas(keep, geometry) that they meet.

    They meet if a corner of the area is in the box, borders included, a corner of the box in the area, or two edges cross.
    A pair comes once. Larger boxes are an error when run; boxes with null ends meet nothing.
    """
    known = " and ".join(f"{c} is not null and not isnan({c})" for c in ("x0", "y0", "x1", "y1"))
    fits = (F.col("x1") - F.col("x0") <= largest) & (F.col("y1") - F.col("y0") <= largest)
    b_ = boxes.filter(known).filter(F.when(fits, True).otherwise(F.raise_error(F.lit(f"a box is larger than {largest}")).cast("boolean")))
    for a in "xy":
        b_ = b_.withColumn(f"g{a}", F.explode(F.sequence(F.floor(F.col(f"{a}0") / size).cast("bigint"), F.floor(F.col(f"{a}1") / size).cast("bigint"))))

    def test(b, s, k):
        x0, y0, x1, y1, gx, gy, bx, by = (b.column(c).to_numpy(zero_copy_only=False) for c in ("x0", "y0", "x1", "y1", "gx", "gy", "bx", "by"))
        at = np.flatnonzero((gx == np.floor(np.maximum(x0, bx) / size)) & (gy == np.floor(np.maximum(y0, by) / size)))
        out, e = np.zeros(len(x0), bool), wkt.edges(s)
        owner, i = wkt.ragged(s.start, k[at])
        here = (s.x[i] >= x0[at][owner]) & (s.x[i] <= x1[at][owner]) & (s.y[i] >= y0[at][owner]) & (s.y[i] <= y1[at][owner])
        out[at] = np.bincount(owner[here], minlength=len(at)) > 0
        out[at] |= wkt.inside(x0[at], y0[at], k[at], e)
        for ends in ((x0, y0, x1, y0), (x1, y0, x1, y1), (x1, y1, x0, y1), (x0, y1, x0, y0)):
            rest = at[~out[at]]
            out[rest] = wkt.crossing(k[rest], e, np.arange(len(rest)), (np.arange(len(rest) + 1), *(v[rest] for v in ends)))
        return out

    return _in_squares(b_, area_squares(areas, keep, largest + 1.0, size), boxes.columns, keep, test)


def cells_in_areas(cells: DataFrame, areas: DataFrame, keep: list[str], size: float = SQUARE) -> DataFrame:
    """cells(cx, cy) of 1 m joined with areas(keep, geometry) that cover some of them: cx, cy, keep, part, xy, first.

    part: covered area in m². xy, first: the area's outline in the cell, surface on the left; null where all of the cell is covered.
    """
    kinds = {f.name: f.dataType.simpleString() for f in areas.schema}
    names = ["cx", "cy", *keep, "part", "xy", "first"]

    def run(batches):
        for b in batches:
            s, k = _shapes_of(b) if b.num_rows else (None, None)
            if s is None:
                continue
            cx, cy = b.column("cx").to_numpy(), b.column("cy").to_numpy()
            n = np.flatnonzero(s.count() > 0)
            box = np.full((4, len(s)), np.nan)
            box[:, n] = [f.reduceat(v, s.start[:-1][n]) for f, v in ((np.minimum, s.x), (np.minimum, s.y), (np.maximum, s.x), (np.maximum, s.y))]
            near = np.flatnonzero((box[0, k] < cx + 1) & (box[2, k] > cx) & (box[1, k] < cy + 1) & (box[3, k] > cy))
            part = areas_in_cells(s, k[near].astype(np.int64), cx[near], cy[near])
            near, part = near[part > 1e-9], part[part > 1e-9]
            known, shapes = {}, [None] * len(near)
            for i in np.flatnonzero(part < 1 - 1e-7):
                if (rings := known.get(k[near[i]])) is None:
                    rings = known[k[near[i]]] = oriented(_polygon(s, k[near[i]]))
                x, y = cx[near[i]], cy[near[i]]
                shapes[i] = [c for r in rings if len(c := clip_ring(r, x - 0.5, y - 0.5, x + 1.5, y + 1.5)) > 2]
            at = pa.array(near)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in names[:-3]), pa.array(part), *_take_rings(shapes)], names=names)

    c = cells.select("cx", "cy", F.floor(F.col("cx") / size).cast("bigint").alias("gx"), F.floor(F.col("cy") / size).cast("bigint").alias("gy"))
    # cutting costs time, not bytes: a set number of partitions, which size-based merging leaves alone; the join takes them over
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c, squares = c.repartition(n, "gx", "gy"), area_squares(areas, keep, 1.0, size).repartition(n, "gx", "gy")
    out = "cx bigint, cy bigint, " + ", ".join(f"`{x}` {kinds[x]}" for x in keep) + ", part double, xy binary, first binary"
    return c.join(squares, ["gx", "gy"]).drop("gx", "gy", "bx", "by").mapInArrow(run, out)


def damage_pieces(damage: DataFrame) -> DataFrame:
    """damage(did, typ, geometry) → (did, typ, cx, cy, um2): each object's area in each 1 m cell, in 1e-6 m²."""

    def run(batches):
        for b in batches:
            s = wkt.parse_wkt(b.column("geometry").to_pylist())
            whole = shape_areas(s)
            rows, x0, y0, x1, y1 = _boxes(s)
            i0, j0, i1, j1 = (np.floor(v).astype(np.int64) for v in (x0, y0, x1, y1))
            wide, high = i1 - i0 + 1, j1 - j0 + 1
            owner = np.repeat(np.arange(len(rows)), wide * high)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(wide * high) - wide * high, wide * high)
            at, xs, ys = rows[owner], i0[owner] + nth // high[owner], j0[owner] + nth % high[owner]
            one = (wide * high)[owner] == 1  # most objects lie in one cell
            out = whole[at].copy()
            out[~one] = areas_in_cells(s, at[~one], xs[~one], ys[~one])
            ok = np.flatnonzero(out > 1e-9)
            take = lambda v: pa.array(v[ok].astype(np.int64))  # noqa: B023, E731
            own = take(at)
            yield pa.RecordBatch.from_arrays([b.column("did").take(own), b.column("typ").take(own), take(xs), take(ys), pa.array(np.floor(out[ok] * 1e6 + 0.5).astype(np.int64))], names=["did", "typ", "cx", "cy", "um2"])

    return damage.select("did", "typ", "geometry").mapInArrow(run, "did bigint, typ string, cx bigint, cy bigint, um2 bigint")


#: Damage objects in one 1 m cell that one task cuts.
OBJECTS_PER_TASK = 10_000


def cell_damage_in_areas(damage: DataFrame, areas: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """damage(typ, geometry), areas(area_id, bw, geometry) → damaged area per cell, mode and type inside the areas of the mode, and the cells of the areas.

    Where an area of a mode covers all of a cell, all damage of the cell counts; where areas cover parts of it, the
    damage is cut to their union. First result: (bw, cx, cy, typ, um2), the second: (area_id, bw, cx, cy).
    The areas that cover parts of one and the same cell are held together, equal outlines once; its objects are cut in parts.
    """
    damage = scratch.keep(damage.select("typ", "geometry").withColumn("did", F.monotonically_increasing_id()), "damage")
    pieces = scratch.keep(damage_pieces(damage), "pieces")
    cells = pieces.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    cover = scratch.keep(cells_in_areas(cells, areas, ["area_id", "bw"]), "cover")
    state = cover.groupBy("bw", "cx", "cy").agg(F.max(F.col("xy").isNull()).alias("full"))
    of_mode = F.create_map(*[F.lit(v) for m, ts in MODES.items() for v in (m, F.array(*map(F.lit, ts)))])
    met = pieces.join(state, ["cx", "cy"]).filter(F.array_contains(F.element_at(of_mode, F.col("bw")), F.col("typ")))
    whole = met.filter("full").groupBy("bw", "cx", "cy", "typ").agg(F.sum("um2").alias("um2"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / OBJECTS_PER_TASK)).cast("int")
    torn = state.filter("not full").join(cells, ["cx", "cy"]).select("bw", "cx", "cy", parts.alias("parts"))
    pieces_ = met.filter("not full").join(torn, ["bw", "cx", "cy"]).join(damage.select("did", "geometry"), "did")
    none = F.lit(None).cast("binary")
    objects = pieces_.select("bw", "cx", "cy", F.pmod(F.xxhash64("did"), F.col("parts")).cast("int").alias("part"), "typ", "geometry", none.alias("xy"), none.alias("first"))
    outlines = cover.filter("xy is not null").select("bw", "cx", "cy", "xy", "first").distinct().join(torn, ["bw", "cx", "cy"])
    outlines = outlines.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    outlines = outlines.select("bw", "cx", "cy", "part", F.lit(None).cast("string").alias("typ"), F.lit(None).cast("string").alias("geometry"), "xy", "first")

    def cut(t: pa.Table) -> pa.Table:
        here = pa.compute.is_valid(t.column("xy")).to_numpy(zero_copy_only=False)
        outer, o = t.take(pa.array(np.flatnonzero(here))), t.take(pa.array(np.flatnonzero(~here)))
        s, d = wkt.from_binary(outer.column("xy"), outer.column("first")), wkt.parse_wkt(o.column("geometry").to_pylist())
        by_cell: dict[tuple, list[int]] = {}
        for i, cell in enumerate(zip(outer.column("cx").to_pylist(), outer.column("cy").to_pylist())):
            by_cell.setdefault(cell, []).append(i)
        um2, known = np.zeros(len(d), np.int64), {}
        for i, cell in enumerate(zip(o.column("cx").to_pylist(), o.column("cy").to_pylist())):
            origin = np.array(cell, float)
            if (areas_ := known.get(cell)) is None:
                areas_ = known[cell] = [[r - origin for r in oriented(_polygon(s, k))] for k in by_cell.get(cell, [])]
            rings = [c for r in oriented(_polygon(d, i)) if len(c := clip_ring(r - origin, 0.0, 0.0, 1.0, 1.0)) > 2]
            um2[i] = np.floor(max(0.0, common_area(rings, areas_)) * 1e6 + 0.5)
        return pa.table({"bw": o.column("bw"), "cx": o.column("cx"), "cy": o.column("cy"), "typ": o.column("typ"), "um2": pa.array(um2)})

    n = int(areas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["bw", *[F.floor(F.col(c) / 16) for c in ("cx", "cy")], "part"]  # many cells at once, as a group has its price
    border = objects.union(outlines).repartition(n, *group).groupBy(*group).applyInArrow(cut, "bw string, cx bigint, cy bigint, typ string, um2 bigint")
    border = border.groupBy("bw", "cx", "cy", "typ").agg(F.sum("um2").alias("um2")).filter("um2 > 0")
    return scratch.keep(whole.union(border), "damaged"), cover.select("area_id", "bw", "cx", "cy")


def damaged_shares(areas: DataFrame, damage: DataFrame, clip: bool = False) -> DataFrame:
    """areas(area_id, bw, geometry) with the damaged percentage of their ground per group of damage types: riss, afli, ofs (bw P: ofs only).

    damage(typ, geometry): small objects and unknown types are dropped first; spelling of typ in case and blanks is
    ignored. Damage is cut to the areas of the same bw before a cell is judged. A damaged cell counts 1 m² in each
    area that covers some of it, so shares above 100 can occur unless clip is set. Areas without ground: 0; bw other than A and P: no row.
    """
    scratch = Scratch(areas.sparkSession, "polygons")
    known = damage.select(F.lower(F.btrim("typ", F.lit(" \t\r\n"))).alias("typ"), "geometry").filter(F.col("typ").isin(*TYPES) & F.col("geometry").isNotNull())
    big = sieve(polygon_areas(known, ["typ"]), F.col("area"), PIXEL_M).select("typ", "geometry")
    own = areas.filter(F.col("bw").isin(*MODES)).select("area_id", "bw", "geometry")
    damaged, cover = cell_damage_in_areas(big, own, scratch)
    limit = F.create_map(*[F.lit(v) for t, a in CELL_M2.items() for v in (t, int(round(a * 1e6)))])
    hit = damaged.filter(F.col("um2") >= F.element_at(limit, F.col("typ")))
    groups = sorted({g for m in GROUPS.values() for g in m})
    in_group = lambda g: reduce(Column.__or__, [(F.col("bw") == m) & F.col("typ").isin(*ts[g]) for m, ts in GROUPS.items() if g in ts])
    flags = hit.groupBy("bw", "cx", "cy").agg(*[F.max(in_group(g)).alias(f"_{g}") for g in groups])
    counts = cover.join(flags, ["bw", "cx", "cy"]).groupBy("area_id", "bw").agg(*[F.count_if(F.col(f"_{g}")).alias(f"_{g}") for g in groups])
    ground = polygon_areas(own, ["area_id", "bw"]).drop("geometry")
    out = ground.join(counts, ["area_id", "bw"], "left")
    for g in groups:
        share = F.coalesce(F.try_divide(F.col(f"_{g}") * F.lit(100.0), F.col("area")), F.lit(0.0))
        share = F.least(share, F.lit(100.0)) if clip else share
        out = out.withColumn(g, F.when(F.col("bw").isin(*[m for m, ts in GROUPS.items() if g in ts]), share))
    return out.select("area_id", "bw", "riss", "afli", "ofs")


def substance_columns(areas: DataFrame, digits: int = 2, only: bool = False) -> DataFrame:
    """areas(area_id, …, riss, afli, ofs) with the norm's columns RISS, AFLI and OFS, rounded; only: nothing but area_id, geometry and these."""
    own = [c for c in areas.columns if c not in ("riss", "afli", "ofs") and (not only or c in ("area_id", "geometry"))]
    return areas.select(*[F.col(f"`{c}`") for c in own], *[round_exact(F.col(c), digits).alias(c.upper()) for c in ("riss", "afli", "ofs")])


def damaged_share(areas: DataFrame, damage: DataFrame, mode: str, clip: bool = False) -> DataFrame:
    """The areas of one mode alone; see damaged_shares."""
    return damaged_shares(areas.filter(F.col("bw") == mode), damage, clip).select("area_id", "bw", *GROUPS[mode])


def shape_problem(areas: DataFrame, column: str = "geometry", kind: str = "POLYGON") -> DataFrame:
    """areas with problem string: 'missing', 'kind' (no polygon, or no line), 'short' (a ring or line of too few places), 'crossing' (a ring meets itself), or null."""
    names = [*areas.columns, "problem"]

    def judge(text, s, i):
        if text is None or s.count()[i] == 0:
            return "missing"
        head = text[: text.find("(")].upper()
        if kind not in head:
            return "kind"
        p = s.start[i], s.start[i + 1]
        x, y, first = s.x[p[0] : p[1]], s.y[p[0] : p[1]], s.first[p[0] : p[1]]
        if kind == "LINESTRING":
            return "short" if len(set(zip(x, y))) < 2 else None
        for a, b in zip(begin := np.flatnonzero(first), np.append(begin[1:], len(x))):
            ring = np.column_stack([x[a:b], y[a:b]])
            ring = ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring
            if len(ring) < 3:
                return "short"
            if len(np.unique(ring, axis=0)) < len(ring) or _meets_itself(ring):
                return "crossing"
            if surface(ring) == 0:
                return "short"
        return None

    def run(batches):
        for b in batches:
            texts = b.column(column).to_pylist()
            s = wkt.parse_wkt(texts)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([judge(t, s, i) for i, t in enumerate(texts)], pa.string())], names=names)

    return areas.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in areas.schema) + ", problem string")


def _meets_itself(ring: np.ndarray) -> bool:
    """Whether two edges of a closed ring that aren't neighbours cross."""
    a, b = ring, np.roll(ring, -1, 0)
    side = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    s, t = side(a[:, None], b[:, None], a[None]), side(a[:, None], b[:, None], b[None])
    hit = (s * t < 0) & (s * t < 0).T
    return bool(hit.any())
