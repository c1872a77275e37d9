"""Operators over ordered rows: moving averages, the rolling straight edge, runs of neighbouring records.

Rows of one sequence may be any share of a table, so sequences are cut into blocks of `block` positions
with the neighbouring positions that a window needs copied along (the halo); no window has to see a
whole sequence. Positions are whole numbers; null positions are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLOCK = 50_000


def in_blocks(df: DataFrame, position: str, halo: int, block: int = BLOCK) -> DataFrame:
    """df with _block and _own: each row in its block, and in the blocks whose rows have it within `halo` positions. Null positions are left out."""
    p = F.col(position)
    blocks = F.sequence(F.floor((p - halo) / block).cast("bigint"), F.floor((p + halo) / block).cast("bigint"))
    cut = df.filter(p.isNotNull()).withColumn("_block", F.explode(blocks))
    return cut.withColumn("_own", F.col("_block") == F.floor(p / block).cast("bigint"))


def over_blocks(df: DataFrame, keys: list[str], position: str, halo: int, steps: list[Callable[[W], dict[str, Column]]], block: int = BLOCK) -> DataFrame:
    """df with window columns that look at most `halo` positions to either side.

    steps: each from a window ordered by the position within a block to columns to add, which later steps may use.
    """
    w = W.partitionBy(*keys, "_block").orderBy(position)
    cut = in_blocks(df, position, halo, block)
    for step in steps:
        cut = cut.withColumns(step(w))
    return cut.filter("_own").drop("_own", "_block")


def moving_average_deltas(df: DataFrame, keys: list[str], position: str, value: str, sizes: tuple[int, ...] = (11, 31, 101, 301), block: int = BLOCK) -> DataFrame:
    """Adds delta_<size>: the value less the mean of the `size` rows around it; null where the frame isn't full.

    Positions are consecutive within a sequence (0, 1, …); nulls in the frame leave the result null. A frame's sum is the
    difference of two running sums of its block, so the work of a row doesn't depend on the sizes; whole numbers are exact.
    """
    running = lambda w: {"_sum": F.coalesce(F.sum(value).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0.0)), "_n": F.count(value).over(w.rowsBetween(W.unboundedPreceding, 0))}

    def frames(w):
        out = {}
        for s in sizes:
            n, total = (F.lead(c, s // 2).over(w) - F.coalesce(F.lag(c, s // 2 + 1).over(w), F.lit(0)) for c in ("_n", "_sum"))
            out[f"delta_{s}"] = F.when(n == s, F.col(value) - total / F.lit(float(s)))
        return out

    return over_blocks(df, keys, position, max(sizes) // 2 + 1, [running, frames], block).drop("_sum", "_n")


def _hull_depth(frames: np.ndarray) -> np.ndarray:
    """Depth of the middle below the upper hull of each row of frames."""
    mid = frames.shape[1] // 2
    best = frames[:, mid].copy()
    for i in range(mid):
        for j in range(mid + 1, frames.shape[1]):
            np.maximum(best, (frames[:, i] * (j - mid) + frames[:, j] * (mid - i)) / (j - i), out=best)
    return best - frames[:, mid]


#: Frames that are computed at once.
FRAMES = 20_000


def straight_edge_depth(df: DataFrame, keys: list[str], position: str, value: str, window: int = 41, block: int = BLOCK, gradient: bool = False) -> DataFrame:
    """Adds depth_mid: how far the middle of a straight edge of `window` samples lies above the surface; gradient: also its slope.

    The resting straight edge is the upper concave hull of its window, so the depth is hull less height and needs no
    iteration. The slope, in percent of a sample's distance, is that between the points where it rests left and right
    of the middle, 0 where it rests on the middle itself. Null within half a window of either end or of a null.
    """
    from pavelens.operators.profiles import contacts

    half = window // 2
    added = ["depth_mid", *(["gradient"] if gradient else [])]
    kept = [c for c in df.columns if c not in added]

    def run(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t.column(position)))
        h = t.column(value).to_numpy(zero_copy_only=False).astype(float)
        out = np.full((len(added), len(h)), np.nan)
        if len(h) >= window:
            frames = np.lib.stride_tricks.sliding_window_view(h, window)
            full = np.flatnonzero(~np.isnan(frames).any(1))
            for lo in range(0, len(full), FRAMES):
                at = full[lo : lo + FRAMES]
                f = np.ascontiguousarray(frames[at])
                out[0, at + half] = _hull_depth(f)
                if gradient:
                    a, b, _ = contacts(f)
                    rows = np.arange(len(f))
                    out[1, at + half] = 100 * np.where(b > a, (f[rows, b] - f[rows, a]) / np.maximum(b - a, 1), 0.0)
        own = t.column("_own")
        t = t.select(kept)
        for name, v in zip(added, out):
            t = t.append_column(name, pa.array(v, from_pandas=True))
        return t.filter(own)

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + "".join(f", {c} double" for c in added)
    return in_blocks(df.select(*kept), position, half, block).groupBy(*keys, "_block").applyInArrow(run, schema)


def islands(df: DataFrame, keys: list[str], number: str, x: str | None = None, y: str | None = None, step: tuple[float, float] | None = None, block: int = BLOCK) -> DataFrame:
    """Adds cluster: runs of consecutive numbers, in which each step is also of a length within `step` if given.

    Runs of one row are dropped, but counted: clusters count all runs of a key from 0. Rows of equal number must be one row.
    A run goes on only from a number to the next one, so a block needs the row before it and the two after it, as a row
    is alone if it and the next one both start a run; the blocks' counts of starts are added up in a table of a row per block.
    """
    n = F.col(number)
    steps = [lambda w: {"_start": F.when(_goes_on(w, number, x, y, step), 0).otherwise(1)}, lambda w: {"_alone": (F.col("_start") == 1) & (F.coalesce(F.lead("_start").over(w), F.lit(1)) == 1)}]
    cut = over_blocks(df, keys, number, 2, steps, block).withColumn("_block", F.floor(n / block).cast("bigint"))
    w = W.partitionBy(*keys, "_block").orderBy(number)
    cut = cut.withColumn("_nth", F.sum("_start").over(w.rowsBetween(W.unboundedPreceding, 0)))
    starts = cut.groupBy(*keys, "_block").agg(F.sum("_start").alias("_starts"))
    before = F.coalesce(F.sum("_starts").over(W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_b"), before.alias("_before"))
    same = F.col("_block") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = cut.filter("not _alone").join(starts, same).withColumn("cluster", (F.col("_before") + F.col("_nth") - 1).cast("bigint"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "cluster")


def _goes_on(w: W, number: str, x: str | None, y: str | None, step: tuple[float, float] | None) -> Column:
    """Whether a row continues the run of the row before it."""
    on = F.coalesce(F.col(number) - F.lag(number).over(w) == 1, F.lit(False))
    if step and x and y:
        dx, dy = (F.col(c) - F.lag(c).over(w) for c in (x, y))
        on = on & F.coalesce(F.sqrt(dx * dx + dy * dy).between(*step), F.lit(False))
    return on


def slope(df: DataFrame, keys: list[str], lane: str, value: str) -> DataFrame:
    """gradient: -100 times the least-squares slope of the value over the lanes of each key, from whole-number sums."""
    s = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(lane).cast("double").alias("sx"), F.sum(value).cast("double").alias("sy"),
        F.sum(F.col(lane) * F.col(lane)).cast("double").alias("sxx"), F.sum(F.col(lane) * F.col(value)).cast("double").alias("sxy"),
    )
    gradient = F.try_divide(F.lit(-100.0) * (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return s.select(*keys, gradient.alias("gradient"))
