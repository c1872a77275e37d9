"""Height profiles: gaps filled, kerbs left out, ruts and water depths under a straight edge.

Row functions take arrays of heights (one profile per row) in Arrow batches; filling along a sequence is
plain windows over blocks, with the two nearest values of the blocks before and after carried in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLOCK = 50_000


def fill_row(h: np.ndarray) -> np.ndarray:
    """Each row with NaN filled in on straight lines, beyond the ends too; fewer than two values: all NaN."""
    out = h.astype(float).copy()
    at = np.arange(out.shape[1])
    for r in np.flatnonzero(np.isnan(out).any(1)):
        ok = np.flatnonzero(~np.isnan(out[r]))
        if len(ok) < 2:
            out[r] = np.nan
            continue
        v = out[r, ok]
        k = np.clip(np.searchsorted(ok, at) - 1, 0, len(ok) - 2)
        line = v[k] + (v[k + 1] - v[k]) * (at - ok[k]) / (ok[k + 1] - ok[k])
        gap = np.isnan(out[r])
        out[r, gap] = line[gap]
    return out


def mask_kerbs(h: np.ndarray, height: float = 0.04, reach: int = 6) -> np.ndarray:
    """Each row with NaN outside of kerbs: rises of `height` or more, going outwards, within `reach` samples of an edge. The innermost counts."""
    out = h.copy()
    n = h.shape[1]
    for r, row in enumerate(h):
        left = [i for i in range(reach, 0, -1) if row[i - 1] - row[i] >= height]
        right = [i for i in range(n - 1 - reach, n - 1) if row[i + 1] - row[i] >= height]
        if left:
            out[r, : left[0]] = np.nan
        if right:
            out[r, right[0] + 1 :] = np.nan
    return out


def contacts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a straight edge laid over each row touches left and right of its middle, and the heights relative to it.

    The first left and the last right contact count where several touch. Rows are centred first, so that float rounding
    doesn't keep a row from coming to rest; as each round moves a contact towards the middle, one that hasn't come to rest
    after as many rounds as it has samples, and four more, is an error.
    """
    n, w = h.shape
    mid, at = w // 2, np.arange(w)
    base = h - h.mean(1, keepdims=True)
    left, right = np.zeros(n, int), np.zeros(n, int)
    gap, moving = base.copy(), np.arange(n)
    for _ in range(w + 4):
        if not len(moving):
            break
        g = gap[moving]
        a = g[:, : mid + 1].argmax(1)
        b = w - 1 - g[:, ::-1][:, : w - mid].argmax(1)
        y = base[moving]
        ya, yb = np.take_along_axis(y, a[:, None], 1), np.take_along_axis(y, b[:, None], 1)
        slope = np.where(b > a, (yb - ya)[:, 0] / np.maximum(b - a, 1), 0.0)[:, None]
        g = y - (ya + slope * (at - a[:, None]))
        left[moving], right[moving], gap[moving] = a, b, g
        moving = moving[g.max(1) >= 1e-12 * np.maximum(1.0, np.abs(y).max(1))]
    if len(moving):
        raise ArithmeticError("a straight edge didn't come to rest")
    return left, right, gap


def rut_and_water(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rut depth (deepest below the straight edge between its contacts) and water depth (lower rim less bottom) of each row."""
    left, right, gap = contacts(h)
    rut, water = np.zeros(len(h)), np.zeros(len(h))
    for r in range(len(h)):
        part = h[r, left[r] : right[r] + 1]
        rut[r] = abs(gap[r, left[r] : right[r] + 1].min())
        low = int(part.argmin())
        water[r] = abs(min(part[: low + 1].max(), part[low:].max()) - part[low])
    return rut, water


_TRANSVERSE = "rut_depth_left double, rut_depth_right double, water_depth_left double, water_depth_right double, gradient double"


def transverse(heights: Column, kerbs: bool = True) -> Column:
    """Struct of ruts, water depths and gradient of an array of 25 heights (lanes from left to right); null if heights are missing."""

    @F.pandas_udf(_TRANSVERSE)
    def run(s: pd.Series) -> pd.DataFrame:
        out = np.full((len(s), 5), np.nan)
        ok = s.map(lambda a: a is not None and len(a) == 25).to_numpy(dtype=bool)
        if ok.any():
            h = fill_row(np.array([[np.nan if v is None else v for v in a] for a in s[ok]], dtype=float))
            if kerbs:
                h = fill_row(mask_kerbs(h))
            good = ~np.isnan(h).any(1)
            if good.any():
                g = h[good]
                lr, lw = rut_and_water(g[:, :13])
                rr, rw = rut_and_water(g[:, 12:])
                x = np.arange(25) - 12.0
                rows = np.flatnonzero(ok)[good]
                out[rows] = np.column_stack([lr, rr, lw, rw, -100 * (g @ x) / (x @ x)])
        return pd.DataFrame(out, columns=[c.split()[0] for c in _TRANSVERSE.split(", ")])

    return run(heights)


def fill_along(df: DataFrame, keys: list[str], position: str, value: str, block: int = BLOCK) -> DataFrame:
    """value filled in along each sequence: between the values before and after, and beyond the ends along the last two.

    Sequences with fewer than two values become null. A block of positions is filled alone from its own
    values and the two values before and after it, which come from a table of at most four rows per block.
    """
    p = F.col(position)
    d = df.withColumn("_b", F.floor(p / block).cast("bigint")).withColumn("_v", F.when(F.col(value).isNotNull() & ~F.isnan(value), F.struct(p.cast("double").alias("i"), F.col(value).alias("v"))))
    w = W.partitionBy(*keys, "_b").orderBy(position)
    up, down = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(1, W.unboundedFollowing)
    d = d.withColumn("_p1", F.last("_v", True).over(up)).withColumn("_n1", F.first("_v", True).over(down))
    own = F.col("_v").isNotNull()
    ends = d.filter(own).groupBy(*keys, "_b").agg(F.array(F.max("_p1"), F.max("_v"), F.min("_v"), F.min("_n1")).alias("e"))
    ends = ends.withColumn("e", F.array_distinct(F.filter("e", lambda s: s.isNotNull())))
    every = d.select(*keys, "_b").distinct().join(ends, [*keys, "_b"], "left")
    # the last two before and the first two after each block: folded over blocks, so a row per block and two values kept
    wb = W.partitionBy(*keys).orderBy("_b")
    two = every.withColumn("_hi", F.sort_array("e", False)).withColumn("_lo", F.sort_array("e"))
    last1 = F.last(F.when(F.size("_hi") > 0, F.struct(F.get("_hi", F.lit(0)).alias("a"), F.get("_hi", F.lit(1)).alias("b"), F.col("_b").alias("k"))), True)
    first1 = F.first(F.when(F.size("_lo") > 0, F.struct(F.get("_lo", F.lit(0)).alias("a"), F.get("_lo", F.lit(1)).alias("b"), F.col("_b").alias("k"))), True)
    two = two.withColumn("_in", last1.over(wb.rowsBetween(W.unboundedPreceding, -1))).withColumn("_out", first1.over(wb.rowsBetween(1, W.unboundedFollowing)))
    # a block with one value has no second: it is the nearest value of the blocks beyond it
    prior = two.select(*keys, F.col("_b").alias("_k"), F.col("_in.a").alias("_in2"), F.col("_out.a").alias("_out2"))
    carry = two.select(*keys, "_b", "_in", "_out")
    ki = prior.select(*[F.col(k).alias(f"_a{n}") for n, k in enumerate(keys)], F.col("_k").alias("_ik"), "_in2")
    ko = prior.select(*[F.col(k).alias(f"_c{n}") for n, k in enumerate(keys)], F.col("_k").alias("_ok"), "_out2")
    on_i, on_o = F.col("_in.k") == F.col("_ik"), F.col("_out.k") == F.col("_ok")
    for n, k in enumerate(keys):
        on_i, on_o = on_i & F.col(k).eqNullSafe(F.col(f"_a{n}")), on_o & F.col(k).eqNullSafe(F.col(f"_c{n}"))
    carry = carry.join(ki, on_i, "left").join(ko, on_o, "left")
    carry = carry.select(
        *[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col("_b").alias("_cb"),
        F.col("_in.a").alias("_i1"), F.coalesce("_in.b", "_in2").alias("_i2"), F.col("_out.a").alias("_o1"), F.coalesce("_out.b", "_out2").alias("_o2"),
    )
    same = F.col("_b") == F.col("_cb")
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{n}"))
    d = d.withColumn("_p2", F.last(F.when(own, F.struct("_v", F.col("_p1").alias("q"))), True).over(up)["q"]).withColumn("_n2", F.first(F.when(own, F.struct("_v", F.col("_n1").alias("q"))), True).over(down)["q"])
    d = d.join(carry, same, "left")
    before, after = F.coalesce("_p1", "_i1"), F.coalesce("_n1", "_o1")
    before2 = F.when(F.col("_p1").isNull(), F.col("_i2")).otherwise(F.coalesce("_p2", "_i1"))
    after2 = F.when(F.col("_n1").isNull(), F.col("_o2")).otherwise(F.coalesce("_n2", "_o1"))
    x = p.cast("double")
    line = lambda a, b: a["v"] + (b["v"] - a["v"]) * (x - a["i"]) / (b["i"] - a["i"])
    filled = F.when(before.isNotNull() & after.isNotNull(), line(before, after)).when(before.isNotNull(), line(before2, before)).otherwise(line(after, after2))
    alone = own & before.isNull() & after.isNull()
    out = F.when(alone, F.lit(None).cast("double")).when(own, F.col(value)).otherwise(filled)
    return d.withColumn("_filled", out).select(*[F.col("_filled").alias(c) if c == value else F.col(f"`{c}`") for c in df.columns])
