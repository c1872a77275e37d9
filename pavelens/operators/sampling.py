"""Sampling points along drive lines: an interpolating curve through the recording points, lanes beside it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelens.operators.sequences import islands


class Curve:
    """Interpolating parametric cubic spline (not-a-knot ends, chord-length parameter 0..1); straight pieces below four points."""

    def __init__(self, xy: np.ndarray):
        d = np.hypot(*np.diff(xy, axis=0).T)
        self.u = np.concatenate([[0], np.cumsum(d) / d.sum()])
        self.xy, n = xy, len(xy)
        self.m = None  # second derivatives at the knots
        if n >= 4:
            h, s = np.diff(self.u), np.diff(xy, axis=0) / np.diff(self.u)[:, None]
            self.m = _solve(h, 6 * np.diff(s, axis=0))

    def _piece(self, t):
        k = np.clip(np.searchsorted(self.u, t, side="right") - 1, 0, len(self.u) - 2)
        return k, (self.u[k + 1] - self.u[k])[:, None], (t - self.u[k])[:, None]

    def at(self, t: np.ndarray) -> np.ndarray:
        k, h, e = self._piece(t)
        y0, y1 = self.xy[k], self.xy[k + 1]
        if self.m is None:
            return y0 + (y1 - y0) * e / h
        m0, m1, f = self.m[k], self.m[k + 1], h - e
        return m0 * f**3 / (6 * h) + m1 * e**3 / (6 * h) + (y0 / h - m0 * h / 6) * f + (y1 / h - m1 * h / 6) * e

    def direction(self, t: np.ndarray) -> np.ndarray:
        k, h, e = self._piece(t)
        y0, y1 = self.xy[k], self.xy[k + 1]
        d = (y1 - y0) / h
        if self.m is not None:
            m0, m1, f = self.m[k], self.m[k + 1], h - e
            d = -m0 * f**2 / (2 * h) + m1 * e**2 / (2 * h) + (y1 - y0) / h - (m1 - m0) * h / 6
        return d / np.hypot(d[:, 0], d[:, 1])[:, None]


def _solve(h: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Second derivatives at the knots, by elimination along three diagonals. The end rows are put into their neighbours
    (not the other way about: at equal distances nothing would be left on the diagonal)."""
    lo, mid, up, b = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy(), r.copy()
    mid[0] += h[0] * (h[0] + h[1]) / h[1]
    up[0] -= h[0] ** 2 / h[1]
    mid[-1] += h[-1] * (h[-2] + h[-1]) / h[-2]
    lo[-1] -= h[-1] ** 2 / h[-2]
    for i in range(1, len(b)):
        f = lo[i] / mid[i - 1]
        mid[i] -= f * up[i - 1]
        b[i] -= f * b[i - 1]
    b[-1] /= mid[-1]
    for i in range(len(b) - 2, -1, -1):
        b[i] = (b[i] - up[i] * b[i + 1]) / mid[i]
    first = ((h[0] + h[1]) * b[0] - h[0] * b[1]) / h[1]
    last = ((h[-2] + h[-1]) * b[-1] - h[-1] * b[-2]) / h[-2]
    return np.vstack([first, b, last])


_COLUMNS = ["recording_id", "direction", "lane", "index", "x", "y"]


def fit_line(xy: np.ndarray, ids: np.ndarray, step: float = 0.1):
    """The curve of one drive line, its ids, and how many sampling points it has; None if it has no length."""
    if not len(xy):
        return None
    keep = np.concatenate([[True], np.hypot(*np.diff(xy, axis=0).T) > 0])
    xy, ids = xy[keep], ids[keep]
    if len(xy) < 2:
        return None
    c = Curve(xy)
    fine = c.at(np.linspace(0, 1, 1000))
    return c, ids, int(np.hypot(*np.diff(fine, axis=0).T).sum() / step) + 1


def sample_range(c: Curve, ids: np.ndarray, n: int, lo: int, hi: int, step: float = 0.1, offset: float = 0.75, beyond: float = 1.5) -> pd.DataFrame:
    """Points lo to hi (without) of the n along a line, and those beyond its ends if they are among them."""
    e = int(round(beyond / step))
    every_t = np.minimum(np.arange(lo, hi) * (1 / max(1, n - 1)), 1.0)
    if hi == n > 1:
        every_t[-1] = 1.0
    mid, ahead = c.at(every_t), c.direction(every_t)
    before, after = (e if lo == 0 else 0), (e if hi == n else 0)
    left = np.column_stack([-ahead[:, 1], ahead[:, 0]])
    extra = step * np.arange(1, e + 1)[:, None]
    mid = np.concatenate([(mid[0] - ahead[0] * extra)[::-1][e - before :], mid, (mid[-1] + ahead[-1] * extra)[:after]])
    left = np.concatenate([np.repeat(left[:1], before, 0), left, np.repeat(left[-1:], after, 0)])
    tt = np.concatenate([np.zeros(before), every_t, np.ones(after)])
    near = np.abs(np.searchsorted(c.u, tt)[:, None] + np.array([-1, 0]))
    near = np.clip(near, 0, len(c.u) - 1)
    pick = near[np.arange(len(tt)), np.abs(c.u[near] - tt[:, None]).argmin(1)]
    at = np.arange(len(tt)) + lo + e - before  # place among all points of the line
    parts = []
    for direction, lanes, every in ((0, offset + 0.1 * np.arange(-2, 3), 1), (1, 0.1 * np.arange(-12, 13), 5)):
        on = at % every == 0
        m, l, k = mid[on], left[on], pick[on]
        p = m[:, None, :] - lanes[None, :, None] * l[:, None, :]
        rows, cols = p.shape[:2]
        parts.append(pd.DataFrame({
            "recording_id": np.repeat(ids[k], cols), "direction": direction, "lane": np.tile(np.arange(cols), rows), "index": np.repeat(at[on] // every, cols),
            "x": p[..., 0].ravel(), "y": p[..., 1].ravel(),
        }))
    return pd.concat(parts, ignore_index=True)


def sample_line(xy: np.ndarray, ids: np.ndarray, step: float = 0.1, offset: float = 0.75, beyond: float = 1.5) -> pd.DataFrame:
    """Sampling points of one drive line: direction 0 along five lanes at the right wheels each step, direction 1 across 25 lanes every fifth step."""
    if (fit := fit_line(xy, ids, step)) is None:
        return pd.DataFrame(columns=_COLUMNS)
    c, ids, n = fit
    return sample_range(c, ids, n, 0, n, step, offset, beyond)


SAMPLE = "cluster bigint, recording_id string, direction int, lane int, index int, x double, y double"
_PIECE = "cluster bigint, n bigint, lo bigint, hi bigint, ids array<string>, u array<double>, x array<double>, y array<double>, mx array<double>, my array<double>"


def sampling_points(lines: DataFrame, line_rows: int = 5_000) -> DataFrame:
    """lines(cluster, image_no, recording_id, x, y) → sampling points of each drive line.

    One curve is fitted to each whole line: a task holds its recording points and a few numbers of each. The
    sampling points, many times as many, are then made in pieces of `line_rows` recording points of that curve, numbered
    through, with points beyond the line's own ends only. Null coordinates are left out; lines of one point give nothing.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("image_no")
        line = fit_line(pdf[["x", "y"]].to_numpy(float), pdf["recording_id"].to_numpy())
        rows = []
        if line is not None:
            c, ids, n = line
            cuts = [*range(0, len(ids) - 1, line_rows), len(ids) - 1]
            t = np.linspace(0, 1, n)
            edges = [0, *np.searchsorted(t, c.u[cuts[1:-1]]).tolist(), n]
            for (a, b), lo, hi in zip(zip(cuts, cuts[1:]), edges, edges[1:]):
                a, b = max(0, a - 1), min(len(ids), b + 2)  # a knot more on each side, for what rounding moves across the cut
                m = (None, None) if c.m is None else (c.m[a:b, 0], c.m[a:b, 1])
                if hi > lo:
                    rows.append((pdf["cluster"].iloc[0], n, lo, hi, ids[a:b], c.u[a:b], c.xy[a:b, 0], c.xy[a:b, 1], *m))
        return pd.DataFrame(rows, columns=["cluster", "n", "lo", "hi", "ids", "u", "x", "y", "mx", "my"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p in b.itertuples(index=False):
                c = Curve.__new__(Curve)
                c.u, c.xy, c.m = p.u, np.column_stack([p.x, p.y]), None if p.mx is None else np.column_stack([p.mx, p.my])
                for lo in range(p.lo, p.hi, 20_000):
                    out = sample_range(c, p.ids, p.n, lo, min(lo + 20_000, p.hi))
                    out.insert(0, "cluster", p.cluster)
                    yield out

    pieces = lines.filter("x is not null and y is not null").groupBy("cluster").applyInPandas(fit, _PIECE)
    return pieces.repartition("cluster", "lo").mapInPandas(run, SAMPLE)


#: What stands for a recording id on pseudo-lanes.
PSEUDO = "_pseudo"


def drive_lines(recordings: DataFrame, distance: float = 5.0, off: float = 0.2, block: int = 50_000) -> DataFrame:
    """recordings(run_id, image_no, recording_id, x, y) → the same with cluster bigint: runs of consecutive numbers, each step distance ± off long; single recordings go."""
    lines = islands(recordings, ["run_id"], "image_no", "x", "y", (distance * (1 - off), distance * (1 + off)), block)
    return lines.withColumn("cluster", F.xxhash64("run_id", "cluster"))


def pseudo_lines(lanes: DataFrame, step: float = 5.0) -> DataFrame:
    """lanes(id, geometry WKT LINESTRING) → rows like drive_lines(): a place each step, all with the id PSEUDO."""
    at = points_along(lanes, step)
    return at.select(F.xxhash64(F.lit(PSEUDO), "id").alias("cluster"), F.col("index").cast("bigint").alias("image_no"), F.lit(PSEUDO).alias("recording_id"), "x", "y")


def create(recordings: DataFrame, lanes: DataFrame | None = None) -> DataFrame:
    """Sampling points of the drive lines of recordings(run_id, image_no, recording_id, x, y) and of pseudo-lanes(id, geometry)."""
    columns = ["cluster", "image_no", "recording_id", "x", "y"]
    lines = drive_lines(recordings).select(*columns)
    return sampling_points(lines if lanes is None else lines.unionByName(pseudo_lines(lanes).select(*columns)))


def of_layer(samples: DataFrame, layer: DataFrame, number: int = 0) -> DataFrame:
    """The samples whose recording is in layer(recording_id); those of pseudo-lanes belong to layer 0."""
    own = layer.select("recording_id").distinct()
    return samples.filter(F.col("recording_id") != PSEUDO).join(own, "recording_id", "left_semi").unionByName(samples.filter((F.col("recording_id") == PSEUDO) & F.lit(number == 0)))


def along(xy: np.ndarray, step: float = 5.0) -> np.ndarray:
    """Points of a line each step from its start, the start included."""
    d = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(xy, axis=0).T))])
    at = np.arange(0, int(d[-1]), step)
    return np.column_stack([np.interp(at, d, xy[:, k]) for k in (0, 1)])


def points_along(lines: DataFrame, step: float = 5.0) -> DataFrame:
    """lines(id, geometry WKT LINESTRING) → (id, index, x, y) each step; other and empty geometries give nothing."""
    from pavelens.functions.wkt import parse_wkt

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = parse_wkt([None if g is None or "LINESTRING" not in g.upper() else g for g in b["geometry"]])
            for i, c in zip(b["id"], range(len(s))):
                lo, hi = s.start[c], s.start[c + 1]
                if hi - lo > 1:
                    p = along(np.column_stack([s.x[lo:hi], s.y[lo:hi]]), step)
                    yield pd.DataFrame({"id": i, "index": np.arange(len(p)), "x": p[:, 0], "y": p[:, 1]})

    return lines.select("id", "geometry").mapInPandas(run, "id bigint, index int, x double, y double")


def simplify(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker: which points of a line stay, the ends always."""
    keep = np.zeros(len(xy), bool)
    keep[[0, -1]] = True
    todo = [(0, len(xy) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p, d = xy[a + 1 : b] - xy[a], xy[b] - xy[a]
        n = np.hypot(*d)
        off = np.abs(p[:, 0] * d[1] - p[:, 1] * d[0]) / n if n else np.hypot(p[:, 0], p[:, 1])
        k = int(off.argmax())
        if off[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep
