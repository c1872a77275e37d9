"""Masks of a tile as numpy arrays, one row of a DataFrame per tile: connected regions, outlines, fills, smoothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelens.operators import lidar, markings


def label_regions(mask: np.ndarray, diagonal: bool = True) -> np.ndarray:
    """Number of the connected region of equal value of each cell, from 1 in reading order; 0 where the mask is 0."""
    h, w = mask.shape
    parent = np.arange(h * w)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    shifts = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if diagonal else [])
    index = parent.reshape(h, w).copy()
    for dy, dx in shifts:
        a = (slice(0, h - dy), slice(max(0, -dx), w - max(0, dx)))
        b = (slice(dy, h), slice(max(0, dx), w + min(0, dx)))
        same = (mask[a] == mask[b]) & (mask[a] != 0)
        for i, j in zip(index[a][same], index[b][same]):
            ri, rj = root(i), root(j)
            if ri != rj:
                parent[max(ri, rj)] = min(ri, rj)
    roots = np.array([root(i) for i in range(h * w)]).reshape(h, w)
    out = np.zeros((h, w), int)
    on = mask != 0
    _, out_on = np.unique(roots[on], return_inverse=True)
    out[on] = out_on + 1
    return out


def outline(region: np.ndarray) -> list[list[tuple[int, int]]]:
    """Closed rings (x, y of cell corners) around the True cells, holes included, each edge once with the region on its left."""
    p = np.pad(region, 1)
    edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for y, x in zip(*np.nonzero(p)):
        for (ny, nx), a, b in (((y - 1, x), (x + 1, y), (x, y)), ((y + 1, x), (x, y + 1), (x + 1, y + 1)), ((y, x - 1), (x, y), (x, y + 1)), ((y, x + 1), (x + 1, y + 1), (x + 1, y))):
            if not p[ny, nx]:
                edges.setdefault(a, []).append(b)
    rings = []
    while edges:
        start = next(iter(edges))
        ring, at = [start], start
        while True:
            after = edges[at].pop()
            if not edges[at]:
                del edges[at]
            ring.append(after)
            at = after
            if at == start:
                break
        rings.append([(x - 1, y - 1) for x, y in ring])
    return rings


def vectorise(tiles: DataFrame, diagonal: bool, cell_m: float, merge: dict[int, int] | None = None) -> DataFrame:
    """tiles(tile_id, x0, y1, height, width, mask binary) → (tile_id, region, value, cells, area_m2, geometry WKT)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for t in b.itertuples(index=False):
                mask = np.frombuffer(t.mask, np.uint8).reshape(t.height, t.width).copy()
                for a, into in (merge or {}).items():
                    mask[mask == a] = into
                labels, rows = label_regions(mask, diagonal), []
                size, first = np.bincount(labels.ravel()), np.unique(labels, return_index=True)
                value = dict(zip(first[0].tolist(), mask.ravel()[first[1]].tolist()))
                for k, geometry in _outlines(labels, t.x0, t.y1, cell_m):
                    rows.append((t.tile_id, k, value[k], int(size[k]), float(size[k] * cell_m * cell_m), geometry))
                yield pd.DataFrame(rows, columns=["tile_id", "region", "value", "cells", "area_m2", "geometry"])

    return tiles.mapInPandas(run, "tile_id string, region int, value int, cells bigint, area_m2 double, geometry string")


def markings_from_masks(tiles: DataFrame, cell_m: float, t_mid: float = 0.25, t_bad: float = 0.25, merge: dict[int, int] | None = None) -> DataFrame:
    """tiles(tile_id, ebene, x0, y1, height, width, types binary, conditions binary) → one row per marking.

    Regions (corners touching count) are those of the types after `merge` (2 → 1 and 4 → 3 if not given); a marking's typ is
    the commonest of its pixels' own types, the lowest of equal ones, and its percentages are of the pixels with a condition.
    Regions without such a pixel are left out. Rows: tile_id, region, typ, zustand, gut, mittel, schlecht, ebene, geometry.
    """
    into = {2: 1, 4: 3} if merge is None else merge
    names = ["tile_id", "region", "type_id", "gut", "mittel", "schlecht", "ebene", "geometry"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b.itertuples(index=False):
                types, cond = (np.frombuffer(m, np.uint8).reshape(t.height, t.width) for m in (t.types, t.conditions))
                merged = types.copy()
                for a, to in into.items():
                    merged[types == a] = to
                labels = label_regions(merged, True)
                n = int(labels.max(initial=0))
                kinds = np.zeros((n + 1, 256), np.int64)
                np.add.at(kinds, (labels.ravel(), types.ravel()), 1)
                states = np.zeros((n + 1, 256), np.int64)
                np.add.at(states, (labels.ravel(), cond.ravel()), 1)
                known = states[:, 1:].sum(1)
                for k, geometry in _outlines(labels, t.x0, t.y1, cell_m):
                    if known[k]:
                        rows.append((t.tile_id, k, int(kinds[k].argmax()), *(100.0 * states[k, 1:4] / known[k]).tolist(), t.ebene, geometry))
            yield pd.DataFrame(rows, columns=names)

    found = tiles.mapInPandas(run, "tile_id string, region int, type_id int, gut double, mittel double, schlecht double, ebene string, geometry string")
    state = markings.state_of(F.col("mittel"), F.col("schlecht"), t_mid, t_bad)
    return found.select("tile_id", "region", markings.type_name(F.col("type_id")).alias("typ"), state.alias("zustand"), "gut", "mittel", "schlecht", "ebene", "geometry")


# Damage types of the bands of a damage mask.
BANDS = ("r", "onf", "af", "aa")


def damage_from_masks(tiles: DataFrame, cell_m: float, least: dict[str, int] | None = None) -> DataFrame:
    """tiles(tile_id, ebene, x0, y1, height, width, bands array<binary>) → (typ, ebene, geometry): regions (sides touching count) of each band, those below `least` pixels of their type left out."""
    need = least or {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b.itertuples(index=False):
                for typ, band in zip(BANDS, t.bands):
                    labels = label_regions(np.frombuffer(band, np.uint8).reshape(t.height, t.width), False)
                    size = np.bincount(labels.ravel())
                    rows += [(typ, t.ebene, g) for k, g in _outlines(labels, t.x0, t.y1, cell_m) if size[k] >= need.get(typ, 1)]
            yield pd.DataFrame(rows, columns=["typ", "ebene", "geometry"])

    return tiles.mapInPandas(run, "typ string, ebene int, geometry string")


def _outlines(labels: np.ndarray, x0: float, y1: float, cell_m: float) -> Iterator[tuple[int, str]]:
    """Number and outline of each region; a region is looked at within its own box only."""
    ys, xs = np.nonzero(labels)
    order = np.argsort(labels[ys, xs], kind="stable")
    ys, xs = ys[order], xs[order]
    for part in np.split(np.arange(len(ys)), np.flatnonzero(np.diff(labels[ys, xs])) + 1):
        if not len(part):
            continue
        y, x = ys[part], xs[part]
        k = int(labels[y[0], x[0]])
        sub = labels[y.min() : y.max() + 1, x.min() : x.max() + 1] == k
        rings = [[(x0 + (a + x.min()) * cell_m, y1 - (c + y.min()) * cell_m) for a, c in r] for r in outline(sub)]
        text = ", ".join("(" + ", ".join(f"{a:.6f} {c:.6f}" for a, c in r) + ")" for r in sorted(rings, key=len, reverse=True))
        yield k, f"POLYGON ({text})"


def mesh(tiles: DataFrame, size: float, cells: int) -> DataFrame:
    """tiles(tile_x, tile_y, …), the lower left corners → row, col, cell and the centre x, y of each of cells × cells cells of a tile."""
    every = F.sequence(F.lit(0), F.lit(cells - 1))
    step = size / cells
    out = tiles.withColumn("row", F.explode(every)).withColumn("col", F.explode(every))
    return out.withColumns({"cell": F.col("row") * cells + F.col("col"), "x": F.col("tile_x") + (F.col("col") + 0.5) * F.lit(step), "y": F.col("tile_y") + (F.col("row") + 0.5) * F.lit(step)})


def grid_values(cells: DataFrame, points: DataFrame, cell_id: str, point_id: str, values: tuple[str, ...], limit: float = 1.0) -> DataFrame:
    """cells(cell_id, x, y) with the values of the nearest of points(point_id, rx, ry, values) up to `limit` away, null beyond; of equally near ones the smallest id."""
    near = lidar.nearest(cells, points, cell_id, point_id, limit, 1, values)
    return cells.drop(*values).join(near.select(cell_id, *values), cell_id, "left")


def mesh_values(tiles: DataFrame, points: DataFrame, size: float, cells: int, point_id: str, values: tuple[str, ...], limit: float = 1.0) -> DataFrame:
    """tiles(tile_x, tile_y), each once → tile_x, tile_y, row, col and values for the cells of mesh(tiles, size, cells) with a point up to `limit` away.

    The nearest of points(point_id, rx, ry, values) counts, of equally near ones the smallest id. size: whole metres. Points look
    for the cells around them, so cells without a point near are never made, however many the tiles have.
    """
    step, near = size / cells, points
    for a, nth in (("x", "col"), ("y", "row")):
        at, tile = F.col(f"r{a}"), f"tile_{a}"
        g = F.explode(F.sequence(F.floor((at - limit) / step - 0.5).cast("bigint"), F.ceil((at + limit) / step - 0.5).cast("bigint")))
        near = near.filter(at.isNotNull() & ~F.isnan(at)).withColumn("_g", g)
        near = near.withColumns({tile: (F.floor(F.col("_g") / cells) * size).cast("bigint"), nth: F.pmod("_g", F.lit(cells)).cast("int")})
        near = near.withColumn(f"_d{a}", F.col(tile) + (F.col(nth) + 0.5) * F.lit(step) - at).filter(F.col(f"_d{a}") * F.col(f"_d{a}") <= limit * limit)
    key, d2 = ["tile_x", "tile_y", "row", "col"], F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy")
    near = near.withColumn("_d2", d2).filter(F.col("_d2") <= limit * limit).join(tiles, ["tile_x", "tile_y"], "left_semi")
    best = near.groupBy(*key).agg(F.min(F.struct("_d2", F.col(point_id).isNull().alias("_no"), point_id, *values)).alias("_best"))
    return best.select(*key, *[F.col("_best")[v].alias(v) for v in values])


def nearest_recordings(cells: DataFrame, recordings: DataFrame, cell_id: str, recording_id: str, k: int = 7, reach: float = 90.0) -> DataFrame:
    """(cell_id, recording_id, d2, rank): the k recordings nearest to each cell; reach has to cover a tile with its surroundings."""
    return lidar.nearest(cells, recordings, cell_id, recording_id, reach, k, wide=8.0)


def smooth_tiles(tiles: DataFrame, sigma: float, every: int = 1) -> DataFrame:
    """tiles(tile_id, height, width, grid binary of doubles) smoothed (see smooth) and, with every > 1, thinned out to each n-th row and column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b.itertuples(index=False):
                g = smooth(np.frombuffer(t.grid, float).reshape(t.height, t.width), sigma)
                g = np.ascontiguousarray(subsample(g, every))
                rows.append((t.tile_id, *g.shape, g.tobytes()))
            yield pd.DataFrame(rows, columns=["tile_id", "height", "width", "grid"])

    return tiles.select("tile_id", "height", "width", "grid").mapInPandas(run, "tile_id string, height int, width int, grid binary")


def smooth(grid: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing along both axes, edges mirrored, NaN left out of the weights."""
    r = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)

    def along(a: np.ndarray) -> np.ndarray:
        return np.apply_along_axis(lambda v: np.convolve(np.pad(v, r, mode="symmetric"), k / k.sum(), "valid"), 0, a)

    known = ~np.isnan(grid)
    total, weight = np.where(known, grid, 0.0), known.astype(float)
    total, weight = along(along(total).T).T, along(along(weight).T).T
    return np.divide(total, weight, out=np.full(grid.shape, np.nan), where=weight > 1e-9)


def subsample(grid: np.ndarray, n: int) -> np.ndarray:
    if grid.shape[0] % n or grid.shape[1] % n:
        raise ValueError("the factor doesn't divide the grid")
    return grid[::n, ::n]
