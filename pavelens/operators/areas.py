"""Boxes, grids and areas: grid-keyed spatial joins, damage per 1 m cell, shares of damaged area, evenness per area.

Theta joins on geometry become equi-joins: both sides get the keys of the grid cells that they touch, and
the exact predicate stays as a condition. Where both sides touch several cells a pair is reported only in
the cell of the larger lower corner, so no distinct is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Damage types, their least size in pixels and what a cell must hold in m² to count as damaged.
SIEVE_PIXELS = {"r": 5, "onf": 5, "af": 10, "aa": 10, "b": 20, "of": 10, "gvvf": 10, "g": 10, "mt": 20, "ae": 10, "ab": 10}
CELL_M2 = {"r": 0.005, "onf": 0.005, "af": 0.02, "aa": 0.01, "b": 0.02, "of": 0.005, "gvvf": 0.005, "g": 0.005, "mt": 0.01, "ae": 0.005, "ab": 0.005}
PIXEL_M = 0.009765625
# Types that count per construction, and the groups that they make up.
MODES = {"A": ("r", "onf", "af", "aa", "b", "ae", "ab"), "P": ("of", "gvvf", "g", "mt", "ae", "ab")}
GROUPS = {"A": {"riss": ("r",), "afli": ("af",), "ofs": ("onf", "aa", "b")}, "P": {"ofs": ("of", "gvvf", "g", "mt")}}
TYPES = tuple(SIEVE_PIXELS)


def cells(low: Column, high: Column, size: float) -> Column:
    """Numbers of the grid lines' cells that the closed interval touches."""
    return F.sequence(F.floor(low / size).cast("bigint"), F.floor(high / size).cast("bigint"))


def with_cells(df: DataFrame, x0: str, y0: str, x1: str, y1: str, size: float) -> DataFrame:
    return df.withColumn("_cx", F.explode(cells(F.col(x0), F.col(x1), size))).withColumn("_cy", F.explode(cells(F.col(y0), F.col(y1), size)))


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float = 20.0) -> DataFrame:
    """points(x, y, …) inner joined with boxes(x0, y0, x1, y1, …) where the point is inside, edges excluded."""
    p = points.withColumn("_cx", F.floor(F.col("x") / size).cast("bigint")).withColumn("_cy", F.floor(F.col("y") / size).cast("bigint"))
    b = with_cells(boxes, "x0", "y0", "x1", "y1", size)
    inside = (F.col("x") > F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") > F.col("y0")) & (F.col("y") < F.col("y1"))
    return p.join(b, ["_cx", "_cy"]).filter(inside).drop("_cx", "_cy")


def _hits(a0: Column, a1: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Where along a → b (0..1) the segment is within low..high in one coordinate."""
    d = a1 - a0
    one, two = F.try_divide(low - a0, d), F.try_divide(high - a0, d)
    always = (a0 >= low) & (a0 <= high)
    enter = F.when(d == 0, F.when(always, 0.0).otherwise(2.0)).otherwise(F.least(one, two))
    leave = F.when(d == 0, F.when(always, 1.0).otherwise(-1.0)).otherwise(F.greatest(one, two))
    return enter, leave


def lines_in_boxes(lines: DataFrame, boxes: DataFrame, size: float = 20.0) -> DataFrame:
    """lines(lx0, ly0, lx1, ly1, …) inner joined with boxes where they intersect, touching included."""
    ends = lines.withColumns({f"_l{i}": F.least(f"l{a}0", f"l{a}1") for i, a in enumerate("xy")} | {f"_h{i}": F.greatest(f"l{a}0", f"l{a}1") for i, a in enumerate("xy")})
    left = with_cells(ends, "_l0", "_l1", "_h0", "_h1", size)
    joined = left.join(with_cells(boxes, "x0", "y0", "x1", "y1", size), ["_cx", "_cy"])
    first = (F.col("_cx") == F.floor(F.greatest("_l0", "x0") / size)) & (F.col("_cy") == F.floor(F.greatest("_l1", "y0") / size))
    ex, lx = _hits(F.col("lx0"), F.col("lx1"), F.col("x0"), F.col("x1"))
    ey, ly = _hits(F.col("ly0"), F.col("ly1"), F.col("y0"), F.col("y1"))
    meets = F.greatest(ex, ey, F.lit(0.0)) <= F.least(lx, ly, F.lit(1.0))
    return joined.filter(first & meets).drop("_cx", "_cy", "_l0", "_l1", "_h0", "_h1")


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def sieve(damage: DataFrame, area: Column, pixel_m: float = PIXEL_M) -> DataFrame:
    """Drop objects below the least size of their type; unknown and null types are dropped."""
    least = F.lit(None).cast("double")
    for t, px in SIEVE_PIXELS.items():
        least = F.when(F.col("typ") == t, F.lit(float(px) * pixel_m * pixel_m)).otherwise(least)
    return damage.filter(area >= least)


def unit_cells(boxes: DataFrame) -> DataFrame:
    """boxes with cx, cy of every 1 m cell that they touch."""
    return with_cells(boxes, "x0", "y0", "x1", "y1", 1.0).withColumnsRenamed({"_cx": "cx", "_cy": "cy"})


def union_area(boxes: Column) -> Column:
    """Surface that boxes (array of structs x0, y0, x1, y1) cover together: between neighbouring x, the length that their y cover."""
    xs = F.array_sort(F.array_distinct(F.concat(F.transform(boxes, lambda b: b["x0"]), F.transform(boxes, lambda b: b["x1"]))))
    upper = F.lit(float("-inf"))

    def covered(lo: Column, hi: Column) -> Column:
        on = F.array_sort(F.transform(F.filter(boxes, lambda b: (b["x0"] <= lo) & (b["x1"] >= hi)), lambda b: F.struct(b["y0"], b["y1"])))
        step = lambda s, b: F.struct(F.greatest(s["top"], b["y1"]).alias("top"), (s["sum"] + F.greatest(F.lit(0.0), b["y1"] - F.greatest(b["y0"], s["top"]))).alias("sum"))
        return F.aggregate(on, F.struct(upper.alias("top"), F.lit(0.0).alias("sum")), step, lambda s: s["sum"])

    slabs = F.when(F.size(xs) < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.size(xs) - 1))
    width = lambda i: F.element_at(xs, i + 1) - F.element_at(xs, i)
    return F.aggregate(slabs, F.lit(0.0), lambda s, i: s + width(i) * covered(F.element_at(xs, i), F.element_at(xs, i + 1)))


#: Side in metres of the squares in which boxes meet damage and damaged cells: whole 1 m cells, and a power of two, so that no division rounds.
SQUARE_M = 8


def cell_damage(damage: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """damage(typ, x0, y0, x1, y1) → (cx, cy, typ, um2): damaged area in each 1 m cell, each object's in whole 1e-6 m².

    within(x0, y0, x1, y1): only what lies in the union of these boxes counts. An object meets the boxes of its square together.
    """
    sides = {f"p{a}{i}": (F.greatest if i == 0 else F.least)(f"{a}{i}", F.col(f"c{a}").cast("double") + i) for a in "xy" for i in (0, 1)}
    um2 = lambda a: F.floor(a * 1e6 + 0.5).cast("bigint")
    if within is None:
        part = unit_cells(damage).select("cx", "cy", "typ", *[c.alias(n) for n, c in sides.items()]).filter("px1 > px0 and py1 > py0")
        return part.groupBy("cx", "cy", "typ").agg(F.sum(um2((F.col("px1") - F.col("px0")) * (F.col("py1") - F.col("py0")))).alias("um2"))
    box, some = ["x0", "y0", "x1", "y1"], "x1 > x0 and y1 > y0"
    boxes = with_cells(within.select(*box).filter(some).distinct(), *box, SQUARE_M).groupBy("_cx", "_cy").agg(F.collect_list(F.struct(*box)).alias("_boxes"))
    objects = with_cells(damage.select("typ", *box).filter(some), *box, SQUARE_M)
    meets = F.exists("_boxes", lambda b: (b["x0"] < F.col("x1")) & (b["x1"] > F.col("x0")) & (b["y0"] < F.col("y1")) & (b["y1"] > F.col("y0")))
    # boxes grow to their squares after sizes are estimated, so a join by estimates would broadcast them however many they are
    part = objects.join(boxes.hint("merge"), ["_cx", "_cy"]).filter(meets)
    for a in "xy":
        first = F.col(f"_c{a}") * SQUARE_M
        part = part.withColumn(f"c{a}", F.explode(F.sequence(F.greatest(F.floor(f"{a}0").cast("bigint"), first), F.least(F.floor(f"{a}1").cast("bigint"), first + (SQUARE_M - 1)))))
    part = part.select("cx", "cy", "typ", "_boxes", *[c.alias(n) for n, c in sides.items()]).filter("px1 > px0 and py1 > py0")
    cut = lambda b: F.struct(*[f(F.col(f"p{n}"), b[n]).alias(n) for n, f in zip(box, (F.greatest, F.greatest, F.least, F.least))])
    part = part.withColumn("_cuts", F.filter(F.transform("_boxes", cut), lambda c: (c["x1"] > c["x0"]) & (c["y1"] > c["y0"])))
    only = F.col("_cuts")[0]
    inside = F.when(F.size("_cuts") == 1, (only["x1"] - only["x0"]) * (only["y1"] - only["y0"])).when(F.size("_cuts") > 1, union_area(F.col("_cuts")))
    return part.groupBy("cx", "cy", "typ").agg(F.sum(um2(inside)).alias("um2")).filter("um2 is not null")


def cell_pivot(by_type: DataFrame, types: tuple[str, ...] = TYPES) -> DataFrame:
    """(cx, cy, a column of area per type); types that don't occur are null columns."""
    return by_type.groupBy("cx", "cy").pivot("typ", list(types)).agg(F.sum("um2"))


def cell_flags(by_type: DataFrame, mode: str) -> DataFrame:
    """Cells with any damage that counts for the mode: (cx, cy, a boolean per type of the mode)."""
    flags = {t: F.coalesce(F.sum(F.when(F.col("typ") == t, F.col("um2"))), F.lit(0)) >= int(round(CELL_M2[t] * 1e6)) for t in MODES[mode]}
    out = by_type.groupBy("cx", "cy").agg(*[f.alias(t) for t, f in flags.items()])
    return out.filter(reduce(Column.__or__, [F.col(t) for t in MODES[mode]]))


def damaged_share(areas: DataFrame, flags: DataFrame, mode: str, clip: bool = False) -> DataFrame:
    """areas(area_id, bw, x0..y1) of the mode with the percentage of their ground in damaged cells, per group.

    A damaged cell counts as 1 m² however little of it the area covers, so shares above 100 can occur
    unless clip is set. Cells that only touch an area don't count.
    """
    own = areas.filter(F.col("bw") == mode)
    parts = with_cells(own.select("area_id", "x0", "y0", "x1", "y1"), "x0", "y0", "x1", "y1", SQUARE_M)
    squares = {f"_c{a}": F.floor(F.col(f"c{a}") / SQUARE_M).cast("bigint") for a in "xy"}
    part = flags.withColumns(squares).join(parts.hint("merge"), ["_cx", "_cy"])  # not by estimates, see cell_damage
    a = overlap(F.col("x0"), F.col("x1"), F.col("cx").cast("double"), F.col("cx").cast("double") + 1.0) * overlap(F.col("y0"), F.col("y1"), F.col("cy").cast("double"), F.col("cy").cast("double") + 1.0)
    counts = part.filter(a > 0).groupBy("area_id").agg(*[F.count_if(reduce(Column.__or__, [F.col(t) for t in ts])).alias(f"_{g}") for g, ts in GROUPS[mode].items()])
    ground = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    out = own.join(counts, "area_id", "left")
    for g in GROUPS[mode]:
        share = F.coalesce(F.try_divide(F.col(f"_{g}") * F.lit(100.0), ground), F.lit(0.0))
        out = out.withColumn(g, F.least(share, F.lit(100.0)) if clip else share)
    return out.select("area_id", "bw", *GROUPS[mode])


def spread(n: Column, s: Column, ss: Column) -> Column:
    """Population standard deviation from whole-number sums."""
    return F.sqrt(F.greatest(F.lit(0.0), n.cast("double") * ss.cast("double") - s.cast("double") * s.cast("double"))) / n.cast("double")


def aggregate_measures(joined: DataFrame, key: str, measures: dict[str, tuple[str, ...]], unit: float = 1e6) -> DataFrame:
    """One groupBy for all measures, in `unit`ths. measures: column → of 'max', 'mean', 'std'. Nulls are left out; NaN counts as null.

    Values are counted in whole units (1e-6 by default), so sums don't depend on their order.
    """
    aggs = []
    for c, kinds in measures.items():
        v = F.floor(F.when(~F.isnan(c), F.col(c)) * F.lit(unit) + F.lit(0.5)).cast("bigint")
        n, s, wide = F.count(v), F.sum(v.cast("decimal(28,0)")), v.cast("decimal(19,0)")
        ss = F.sum((wide * wide).cast("decimal(38,0)"))
        if "max" in kinds:
            aggs.append(F.max(v).alias(f"{c}_max"))
        if "mean" in kinds:
            aggs.append(F.try_divide(s.cast("double"), n.cast("double")).alias(f"{c}_mean"))
        if "std" in kinds:
            aggs.append(F.when(n > 0, spread(n, s, ss)).alias(f"{c}_std"))
    return joined.groupBy(key).agg(*aggs)


def pick_tiles(files: DataFrame, done: DataFrame, areas: DataFrame, size: float, delimiter: str = "_") -> DataFrame:
    """files(name) whose tile id can be read, isn't done yet and whose square meets an area: (tile_id, x0, y0, x1, y1), each once."""
    from pavelens.functions.scalars import boxes_overlap, tile_corner, tile_id

    x, y = tile_corner(F.col("tile_id"), delimiter)
    tiles = files.select(tile_id(F.col("name"), delimiter).alias("tile_id")).filter("tile_id is not null").distinct()
    tiles = tiles.join(done.select("tile_id"), "tile_id", "left_anti").select("tile_id", x.cast("double").alias("x0"), y.cast("double").alias("y0"))
    tiles = tiles.withColumn("x1", F.col("x0") + size).withColumn("y1", F.col("y0") + size)
    a = with_cells(areas.select(*[F.col(c).alias(f"a{c}") for c in ("x0", "y0", "x1", "y1")]), "ax0", "ay0", "ax1", "ay1", size)
    t = with_cells(tiles, "x0", "y0", "x1", "y1", size)
    meets = boxes_overlap(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.col("ax0"), F.col("ay0"), F.col("ax1"), F.col("ay1"))
    same = (t["_cx"] == a["_cx"]) & (t["_cy"] == a["_cy"]) & meets
    return t.join(a, same, "left_semi").select("tile_id", "x0", "y0", "x1", "y1").distinct()
