"""Laser points: ground, outliers, heights at sampling points, nearest recordings, height layers.

Neighbourhoods are found in square blocks many radii wide. The left side stays in its block, the right side is
copied across a block's border only where it lies within the radius of it, so nearly nothing is copied. Crowded
blocks are cut on both sides into parts of `block_rows` rows and every pair of parts is a task of its own; what a
task keeps for each left row (its k nearest, a count) is settled afterwards. Rows without coordinates match nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows of one side that one task holds at most.
BLOCK_ROWS = 50_000
#: Crowded blocks are broadcast up to this many (24 bytes each); beyond it the blocks are joined by a shuffle.
BROADCAST_BLOCKS = 200_000


def ground(points: DataFrame, size: float = 0.2, bin_m: float = 0.02, least: int = 10, look: int = 10, around: int = 2) -> DataFrame:
    """points(x, y, z) that are ground, judged in each `size` bin of the plan by a histogram of the heights.

    Heights are counted in bins of bin_m from the lowest point of the plan bin up to its highest, which belongs to the
    last bin. From the first bin with more than `least` points on (the lowest bin if there is none) the fullest of the
    next `look` bins is the ground, the lower of equal ones; points from `around` bins below to `around` bins above it
    stay, without the upper border. A plan bin whose points are all at one height keeps them. Rows without x, y or z go.
    """
    bx, by = (F.floor(F.col(c) / F.lit(size)) for c in ("x", "y"))
    known = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull() & ~F.isnan("x") & ~F.isnan("y") & ~F.isnan("z")
    p = points.filter(known).withColumn("_bx", bx).withColumn("_by", by)
    extent = p.groupBy("_bx", "_by").agg(F.min("z").alias("_low"), F.max("z").alias("_high"))
    extent = extent.withColumn("_bins", F.ceil((F.col("_high") - F.col("_low")) / F.lit(bin_m)))
    nth = F.least(F.floor((F.col("z") - F.col("_low")) / F.lit(bin_m)), F.col("_bins") - 1)
    counts = p.join(extent, ["_bx", "_by"]).filter("_bins > 0").groupBy("_bx", "_by", nth.alias("_bz")).agg(F.count(F.lit(1)).alias("n"))
    first = F.coalesce(F.min(F.when(F.col("n") > least, F.col("_bz"))).over(W.partitionBy("_bx", "_by")), F.lit(0))
    # the rows of a plan bin here are its height bins, not its points
    near = counts.withColumn("_first", first).filter(F.col("_bz").between(F.col("_first"), F.col("_first") + look - 1))
    # where no bin of the range holds a point, all are equally full and the first one counts
    top = near.groupBy("_bx", "_by").agg((-F.max(F.struct("n", (-F.col("_bz")).alias("low")))["low"]).alias("_mode"))
    level = extent.join(top, ["_bx", "_by"], "left").withColumn("_mode", F.coalesce("_mode", F.lit(0)))
    edge = lambda k: F.col("_low") + F.least(F.greatest(k, F.lit(0)), F.col("_bins")) * F.lit(bin_m)
    level = level.select("_bx", "_by", "_bins", edge(F.col("_mode") - around).alias("_from"), edge(F.col("_mode") + around + 1).alias("_to"))
    inside = (F.col("_bins") == 0) | ((F.col("z") >= F.col("_from")) & (F.col("z") < F.col("_to")))
    return p.join(level, ["_bx", "_by"]).filter(inside).select(*[F.col(f"`{c}`") for c in points.columns])


def near_pairs(lx: np.ndarray, ly: np.ndarray, rx: np.ndarray, ry: np.ndarray, radius: float, chunk: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right, squared distance) of all pairs at most radius apart; all pairs of a left row come in one piece."""
    if not len(lx) or not len(rx):
        return
    x0, y0 = rx.min(), ry.min()
    gx, gy = np.floor((rx - x0) / radius).astype(np.int64), np.floor((ry - y0) / radius).astype(np.int64)
    high = int(gy.max()) + 4
    key = gx * high + gy + 1
    order = np.argsort(key, kind="stable")
    key = key[order]
    cx, cy = np.floor((lx - x0) / radius).astype(np.int64), np.floor((ly - y0) / radius).astype(np.int64)
    ok = (cy >= -1) & (cy <= high - 3)
    los, his = [], []
    for d in (-1, 0, 1):
        lo = np.searchsorted(key, (cx + d) * high + np.clip(cy, -1, high - 3), "left")
        hi = np.searchsorted(key, (cx + d) * high + np.clip(cy, -1, high - 3) + 2, "right")
        los.append(lo)
        his.append(np.where(ok, hi, lo))
    n = sum(h - l for h, l in zip(his, los))
    total = np.concatenate([[0], np.cumsum(n)])
    a = 0
    while a < len(lx):
        b = max(a + 1, int(np.searchsorted(total, total[a] + chunk, "right")) - 1)
        i, j = [], []
        for lo, hi in zip(los, his):
            m = hi[a:b] - lo[a:b]
            i.append(np.repeat(np.arange(a, b), m))
            j.append(np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo[a:b], m))
        i, j = np.concatenate(i), order[np.concatenate(j)]
        dx, dy = lx[i] - rx[j], ly[i] - ry[j]
        d2 = dx * dx + dy * dy
        near = d2 <= radius * radius
        yield i[near], j[near], d2[near]
        a = b


def _crowded(both: DataFrame, keys: list[str], block_rows: int) -> DataFrame | None:
    """Keys with more than block_rows rows of a side, and their numbers of rows; None if there are none. Broadcast if few."""
    n = both.groupBy(*keys).agg(F.count_if(~F.col("right")).alias("nl"), F.count_if(F.col("right")).alias("nr"))
    crowded = n.filter((F.col("nl") > block_rows) | (F.col("nr") > block_rows)).select(*[F.col(k).alias(f"_k{k}") for k in keys], "nl", "nr")
    many = crowded.count()
    return None if not many else F.broadcast(crowded) if many <= BROADCAST_BLOCKS else crowded


def _with_crowded(both: DataFrame, crowded: DataFrame, keys: list[str]) -> DataFrame:
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_k{k}") for k in keys])
    return both.join(crowded, same, "left").drop(*[f"_k{k}" for k in keys])


#: How many finer blocks a crowded block has along a side.
FINER = 16


def in_blocks(left: DataFrame, right: DataFrame, radius: float, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str, carry: tuple[str, ...] = (), wide: float = 256.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """left(id, x, y, z) and right(id, x, y, z, carry) in blocks of `wide` radii; work gets a part of each side and all its near rows.

    Crowded blocks are cut into FINER × FINER by place, and what is still crowded into parts by id. work sees carry as _c_<name>.
    """
    size, fine = wide * radius, wide * radius / FINER
    slack = radius * (1 + 1e-9) + 1e-9
    known = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y") & F.col("id").isNotNull()
    cell = lambda c, s: F.floor(c / F.lit(s)).cast("bigint")
    columns = ["right", "id", "x", "y", "z", *[f"_c_{c}" for c in carry]]
    l = left.filter(known).select(F.lit(False).alias("right"), "id", "x", "y", "z", *[F.lit(None).cast("double").alias(f"_c_{c}") for c in carry])
    l = l.withColumn("_cx", cell(F.col("x"), size)).withColumn("_cy", cell(F.col("y"), size))
    r = right.filter(known).select(F.lit(True).alias("right"), "id", "x", "y", "z", *[F.col(f"_c_{c}").cast("double").alias(f"_c_{c}") for c in carry])
    for a in "xy":
        r = r.withColumn(f"_c{a}", F.explode(F.sequence(cell(F.col(a) - slack, size), cell(F.col(a) + slack, size))))
    both, keys = l.union(r).withColumn("_part", F.lit(0)), ["_cx", "_cy"]
    if (crowded := _crowded(both, keys, block_rows)) is not None:
        both = _with_crowded(both, crowded, keys)
        for a in "xy":  # finer blocks of this block only: others have their own copy of the row
            first = F.col(f"_c{a}") * FINER
            place = F.when(F.col("right"), F.sequence(F.greatest(cell(F.col(a) - slack, fine), first), F.least(cell(F.col(a) + slack, fine), first + FINER - 1)))
            near = F.least(F.greatest(cell(F.col(a), fine), first), first + FINER - 1)
            reach = F.greatest(cell(F.col(a) - slack, fine), first) <= F.least(cell(F.col(a) + slack, fine), first + FINER - 1)
            spots = F.when(F.col("nl").isNull(), F.array(F.lit(-1).cast("bigint"))).when(~F.col("right"), F.array(near)).when(reach, place).otherwise(F.array(near))
            both = both.withColumn(f"_f{a}", F.explode(spots))
        both, keys = both.drop("nl", "nr"), [*keys, "_fx", "_fy"]
        if (crowded := _crowded(both, keys, block_rows)) is not None:
            both = _with_crowded(both, crowded, keys)
            parts = lambda c: F.greatest(F.lit(1), F.ceil(F.coalesce(F.col(c), F.lit(0)) / block_rows)).cast("int")
            pl, pr, h = parts("nl"), parts("nr"), F.xxhash64("id")
            own = F.pmod(h, F.when(F.col("right"), pr).otherwise(pl)).cast("int")
            of_right, of_left = F.transform(F.sequence(F.lit(0), pl - 1), lambda k: k * pr + own), F.transform(F.sequence(F.lit(0), pr - 1), lambda k: own * pr + k)
            both = both.withColumn("_part", F.explode(F.when(F.col("right"), of_right).otherwise(of_left)))

    def run(t: pa.Table) -> pa.Table:
        side = t.column("right").to_numpy(zero_copy_only=False)
        return work(t.take(pa.array(np.flatnonzero(~side))), t.take(pa.array(np.flatnonzero(side))))

    return both.select(*columns, *keys, "_part").groupBy(*keys, "_part").applyInArrow(run, schema)


def _numbers(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names]


def _one_side(df: DataFrame, key: str, x: str, y: str, z: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), z.cast("double").alias("z"), *[F.col(c).alias(f"_c_{c}") for c in carry])


def nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, radius: float, k: int, carry: tuple[str, ...] = (), wide: float = 256.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(left_id, right_id, d2, rank, carry): the k nearest of right(right_id, rx, ry, carry) at most radius from each left(left_id, x, y).

    rank counts from 1; of equally near rows the smaller right_id comes first. carry: columns of numbers of the right side.
    """
    none = F.lit(None).cast("double")

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        ids = b.column("id").to_numpy()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for i, j, d2 in near_pairs(*_numbers(a, "x", "y"), *_numbers(b, "x", "y"), radius):
            order = np.lexsort((ids[j], d2, i))
            i, j, d2 = i[order], j[order], d2[order]
            head = np.flatnonzero(np.diff(i, prepend=-1))
            keep = np.arange(len(i)) - np.repeat(head, np.diff(np.append(head, len(i)))) < k
            found.append((i[keep], j[keep], d2[keep]))
        i, j, d2 = (np.concatenate(c) for c in zip(*found))
        at = pa.array(j)
        cols = {"l": a.column("id").take(pa.array(i)), "r": b.column("id").take(at), "d2": pa.array(d2)}
        return pa.table(cols | {c: b.column(f"_c_{c}").take(at) for c in carry})

    schema = "l bigint, r bigint, d2 double" + "".join(f", `{c}` double" for c in carry)
    part = in_blocks(_one_side(left, left_id, "x", "y", none), _one_side(right, right_id, "rx", "ry", none, carry), radius, work, schema, carry, wide, block_rows)
    # at most k rows of each left row and part of a block
    rank = F.row_number().over(W.partitionBy("l").orderBy("d2", "r"))
    out = part.withColumn("rank", rank).filter(F.col("rank") <= k)
    return out.select(F.col("l").alias(left_id), F.col("r").alias(right_id), "d2", "rank", *carry)


def inverse_distance_height(samples: DataFrame, points: DataFrame, sample_id: str, point_id: str, radius: float = 0.025, k: int = 10, exact: bool = True) -> DataFrame:
    """samples(sample_id, x, y) with z: the mean height of the k nearest points(point_id, rx, ry, z) weighted by 1 / d².

    None within the radius: null. A point at the very place gives its height (the mean of such points), or null if exact is off.
    """
    near = nearest(samples, points, sample_id, point_id, radius, k, ("z",))
    weight = F.try_divide(F.lit(1.0), F.col("d2"))
    hit = F.avg(F.when(F.col("d2") == 0, F.col("z")))
    mean = F.try_divide(F.sum(weight * F.col("z")), F.sum(F.when(F.col("z").isNotNull(), weight)))
    z = near.groupBy(sample_id).agg(F.when(F.count_if(F.col("d2") == 0) > 0, hit if exact else F.lit(None).cast("double")).otherwise(mean).alias("z"))
    return samples.drop("z").join(z, sample_id, "left")


def outliers(points: DataFrame, point_id: str, radius: float = 0.5, threshold: int = 20, subsample: int = 5, position: str | None = None, wide: float = 256.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """points(point_id, x, y, z) with fewer than threshold // subsample of every subsample-th point nearer than radius in space.

    Every subsample-th point by `position` (point_id if none is named) is counted, a point itself too if it is one of
    them; all points are judged. A threshold of 0 makes no outliers, a subsample above the threshold becomes the
    threshold. Points without coordinates are outliers; repeated ids must be repeated rows. Gives the outliers' rows.
    """
    if subsample < 1:
        raise ValueError("subsample is 1 or more")
    if threshold < 1:
        return points.limit(0)
    subsample = min(subsample, threshold)
    k = threshold // subsample

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        (ax, ay, az), (bx, by, bz) = _numbers(a, "x", "y", "z"), _numbers(b, "x", "y", "z")
        n = np.zeros(len(ax), np.int64)
        for i, j, d2 in near_pairs(ax, ay, bx, by, radius):
            dz = az[i] - bz[j]
            n += np.bincount(i[d2 + dz * dz < radius * radius], minlength=len(ax))
        on = np.flatnonzero(n)
        return pa.table({"id": a.column("id").take(pa.array(on)), "n": pa.array(np.minimum(n[on], k))})

    side = _one_side(points, point_id, "x", "y", F.col("z"))
    some = _one_side(points.filter(F.pmod(F.col(position or point_id), F.lit(subsample)) == 0), point_id, "x", "y", F.col("z"))
    counts = in_blocks(side, some, radius, work, "id bigint, n bigint", wide=wide, block_rows=block_rows)
    inside = counts.groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= k).select(F.col("id").alias("_in"))
    return points.join(inside, F.col(point_id) == F.col("_in"), "left_anti")


def height_layers(shots: DataFrame, overlap: float = 15.0, apart: float = 2.0, wide: float = 64.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """shots(tile, line, x, y, height), one row per recording → (tile, line, mean_height, layer).

    The drive lines of a tile are taken by mean height (then number), the lowest first. A line joins the layer that is
    being gathered unless it has a recording within `overlap` in the plane of one of that layer's, `apart` or more
    higher or lower; then it opens the next layer. Layers count from 0 in each tile, in order of their mean height.
    Which lines exclude each other comes from a block join over recordings; the fold sees a row per line of a tile.
    """
    known = shots.filter("height is not null and not isnan(height)")
    lines = known.groupBy("tile", "line").agg(F.avg("height").alias("mean_height"), F.count(F.lit(1)).alias("n")).withColumn("_line", F.xxhash64("tile", "line"))
    # tile and line as one number; recordings of other tiles at the same place are told apart afterwards
    side = known.select(F.xxhash64("tile", "line").alias("id"), "x", "y", F.col("height").alias("z"))
    tiles = lines.select(F.col("_line").alias("_id"), F.xxhash64("tile").alias("_tile"))

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        (ax, ay, az), (bx, by, bz) = _numbers(a, "x", "y", "z"), _numbers(b, "x", "y", "z")
        ai, bi = a.column("id").to_numpy(), b.column("id").to_numpy()
        pairs = [np.zeros((0, 2), np.int64)]
        for i, j, d2 in near_pairs(ax, ay, bx, by, overlap):
            hit = (d2 < overlap * overlap) & (np.abs(az[i] - bz[j]) >= apart) & (ai[i] < bi[j])
            pairs.append(np.unique(np.column_stack([ai[i[hit]], bi[j[hit]]]), axis=0))
        p = np.unique(np.concatenate(pairs), axis=0)
        return pa.table({"a": pa.array(p[:, 0].copy()), "b": pa.array(p[:, 1].copy())})

    apart_ = in_blocks(side, side, overlap, work, "a bigint, b bigint", wide=wide, block_rows=block_rows).distinct()
    ta, tb = tiles.select(F.col("_id").alias("a"), F.col("_tile").alias("_ta")), tiles.select(F.col("_id").alias("b"), F.col("_tile").alias("_tb"))
    apart_ = apart_.join(ta, "a").join(tb, "b").filter("_ta = _tb").select("a", "b")
    against = apart_.union(apart_.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.collect_set("b").alias("against"))
    rows = lines.join(against, F.col("_line") == F.col("a"), "left").select("tile", "line", "mean_height", "n", "_line", "against")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mean_height", "line"], kind="stable").reset_index(drop=True)
        group, now, members = np.zeros(len(pdf), int), 0, set()
        for k, (me, against) in enumerate(zip(pdf["_line"], pdf["against"])):
            if against is not None and members.intersection(against):
                now, members = now + 1, set()
            members.add(me)
            group[k] = now
        total = np.bincount(group, pdf["mean_height"] * pdf["n"]) / np.bincount(group, pdf["n"])
        place = np.empty(len(total), int)
        place[np.argsort(total, kind="stable")] = np.arange(len(total))
        return pd.DataFrame({"tile": pdf["tile"], "line": pdf["line"], "mean_height": pdf["mean_height"], "layer": place[group].astype(np.int32)})

    return rows.groupBy("tile").applyInPandas(fold, f"tile {kinds['tile']}, line {kinds['line']}, mean_height double, layer int")


def nearest_in_time(points: DataFrame, recordings: DataFrame, key: str, carry: tuple[str, ...]) -> DataFrame:
    """points(key, t, …) with carry of recordings(key, t, recording_id, carry) of the same key nearest in time, however far; null where the key has none.

    Two passes in order of time hand on the last recording, so a row costs the same however many there are. key is a tile or
    run: its rows go through one sort. Of equally near recordings the earlier one counts, of equal times the smaller id.
    Points without a time get null.
    """
    kinds = {f.name: f.dataType.simpleString() for f in recordings.schema}
    r = F.struct(F.col("t").cast("double").alias("t"), F.col("recording_id").alias("i"), *[F.col(c).alias(c) for c in carry])
    shots = recordings.filter("t is not null").select(F.col(key), F.col("t").cast("double").alias("_t"), r.alias("_r"))
    shots = shots.groupBy(key, "_t").agg(F.min_by("_r", "_r.i").alias("_r"))
    whole = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    rows = points.filter("t is not null").select(F.col(key), F.col("t").cast("double").alias("_t"), whole.alias("_p"))
    both = shots.unionByName(rows, allowMissingColumns=True)
    up = W.partitionBy(key).orderBy(F.col("_t"), F.col("_p").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    down = W.partitionBy(key).orderBy(F.desc("_t"), F.col("_p").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    both = both.withColumn("_a", F.last("_r", True).over(up)).withColumn("_b", F.last("_r", True).over(down)).filter("_p is not null")
    ahead = F.col("_a").isNull() | (F.col("_b.t") - F.col("_t") < F.col("_t") - F.col("_a.t"))
    pick = F.when(ahead, F.col("_b")).otherwise(F.col("_a"))
    out = both.select("_p.*", *[pick[c].alias(c) for c in carry])
    return out.unionByName(points.filter("t is null").select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in carry]))


def retile(points: DataFrame, size: float = 50.0, edges_twice: bool = False) -> DataFrame:
    """points with tile_x, tile_y, the lower left corner of their tile; edges_twice puts points on a border into both tiles."""
    if not edges_twice:
        return points.withColumn("tile_x", (F.floor(F.col("x") / size) * size).cast("bigint")).withColumn("tile_y", (F.floor(F.col("y") / size) * size).cast("bigint"))

    def both(c: str) -> Column:
        k = F.floor(F.col(c) / size)
        return F.explode(F.when(F.col(c) == k * size, F.array(k - 1, k)).otherwise(F.array(k)))

    out = points.withColumn("_tx", both("x")).withColumn("_ty", both("y"))
    return out.withColumn("tile_x", (F.col("_tx") * size).cast("bigint")).withColumn("tile_y", (F.col("_ty") * size).cast("bigint")).drop("_tx", "_ty")


def bounds(df: DataFrame, keys: list[str]) -> DataFrame:
    """Extent in x, y and z per key, NaN left out."""
    clean = lambda c: F.when(~F.isnan(c), F.col(c))
    return df.groupBy(*keys).agg(*[f(clean(c)).alias(f"{n}_{c}") for c in ("x", "y", "z") for n, f in (("min", F.min), ("max", F.max))])


def clouds_of_tiles(extents: DataFrame, areas: DataFrame, done: DataFrame, size: float = 50.0) -> DataFrame:
    """extents(path, x0, y0, x1, y1), areas(geometry), done(tile_x, tile_y) → (tile_x, tile_y, path): which clouds each tile needs that isn't there yet.

    Clouds whose box meets no area are left out. A box touches the tiles of its borders too.
    """
    from pavelens.operators.polygons import boxes_in_areas

    numbered = areas.select(F.lit(1).alias("_a"), "geometry")
    wide = extents.agg(F.max(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).first()[0] or 0.0
    met = boxes_in_areas(extents.select("path", "x0", "y0", "x1", "y1"), numbered, ["_a"], largest=wide, size=max(64.0, wide)).drop("_a").distinct()
    for a in "xy":
        at = F.sequence(F.floor(F.col(f"{a}0") / size), F.floor(F.col(f"{a}1") / size))
        met = met.withColumn(f"tile_{a}", F.explode(F.transform(at, lambda k: (k * size).cast("bigint"))))
    return met.select("tile_x", "tile_y", "path").distinct().join(done.select("tile_x", "tile_y").distinct(), ["tile_x", "tile_y"], "left_anti")
