"""Evenness of road surfaces: from heights at sampling points to measures per aggregation area in the norm's columns.

Longitudinal points (direction 0): cluster, lane 0 to 4, index each 10 cm, x, y, z. Transverse points (direction 1): the
same with lanes 0 to 24, index each 50 cm. Clusters are drive lines and may be of any length: all sequences are cut into blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelens.functions.scalars import round_exact
from pavelens.operators import profiles, sequences
from pavelens.operators.areas import aggregate_measures

WINDOW = 41
AVERAGES = (11, 31, 101, 301)
LANES = {0: 5, 1: 25}
DELTAS = tuple(f"delta_depth_mid_moving_average_{s}" for s in AVERAGES)
#: Values are summed in whole units of 1e-9.
UNIT = 1e9

# Columns of the norm by measure.
AP9 = {
    "depth_mid_max": "SM4L_M", "depth_mid_mean": "SM4L_A", f"{DELTAS[0]}_std": "S01", f"{DELTAS[1]}_std": "S03", f"{DELTAS[2]}_std": "S10", f"{DELTAS[3]}_std": "S30",
    "gradient_longitudinal_mean": "LN", "rut_depth_left_mean": "MSPTL", "rut_depth_right_mean": "MSPTR", "rut_depth_mean_max": "MSPT", "rut_depth_max": "SPTMAX",
    "rut_depth_left_std": "SSPTL", "rut_depth_right_std": "SSPTR", "water_depth_left_mean": "MSPHL", "water_depth_right_mean": "MSPHR", "water_depth_mean_max": "MSPH",
    "water_depth_left_std": "SSPHL", "water_depth_right_std": "SSPHR", "gradient_transverse_mean": "QN",
}
SIDES = ("rut_depth_left", "rut_depth_right", "water_depth_left", "water_depth_right")


def fill_across(points: DataFrame, lanes: int) -> DataFrame:
    """points(cluster, index, lane, x, y, z) with gaps in z filled in from the other lanes at the same index; lanes that lack a row are left out."""
    at = F.struct("lane", "x", "y", F.when(~F.isnan("z"), F.col("z")).alias("z"))
    rows = points.filter(F.col("lane").between(0, lanes - 1)).groupBy("cluster", "index").agg(F.array_sort(F.collect_list(at)).alias("p"))
    # heights by lane number, so that a lane without a row leaves its gap
    heights = F.transform(F.sequence(F.lit(0), F.lit(lanes - 1)), lambda k: F.try_element_at(F.filter("p", lambda q: q["lane"] == k), F.lit(1))["z"])
    rows = rows.withColumn("h", heights)

    def fill(batches):
        for b in batches:
            h = b.column("h").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, lanes)
            full = pa.array(profiles.fill_row(h).ravel(), from_pandas=True)
            whole = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * lanes, pa.int32()), full)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("cluster", "index", "p")), whole], names=["cluster", "index", "p", "h"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    rows = rows.select("cluster", "index", "p", "h").mapInArrow(fill, f"cluster {kinds['cluster']}, index {kinds['index']}, p {kinds['p']}, h array<double>")
    out = rows.select("cluster", "index", "h", F.explode("p").alias("p"))
    return out.select("cluster", "index", "p.lane", "p.x", "p.y", F.element_at("h", F.col("p.lane") + 1).alias("z"))


def longitudinal(points: DataFrame, unmeasured_flat: bool = False, block: int = sequences.BLOCK) -> DataFrame:
    """points of direction 0 → cluster, lane, index, x, y, z, depth_mid, its differences to moving averages and the gradient of the straight edge.

    Gaps are filled across the lanes, then along each lane. A cluster without heights has null measures, or those of a
    flat surface if unmeasured_flat is set.
    """
    p = fill_across(points, LANES[0])
    p = profiles.fill_along(p, ["cluster", "lane"], "index", "z", block)
    if unmeasured_flat:
        some = p.groupBy("cluster").agg(F.count("z").alias("_k")).filter("_k = 0").select("cluster", F.lit(1.0).alias("_flat"))
        p = p.join(some, "cluster", "left").withColumn("z", F.coalesce("z", "_flat")).drop("_flat")
    p = sequences.straight_edge_depth(p, ["cluster", "lane"], "index", "z", WINDOW, block, gradient=True)
    p = sequences.moving_average_deltas(p, ["cluster", "lane"], "index", "depth_mid", AVERAGES, block)
    return p.withColumnsRenamed({f"delta_{s}": d for s, d in zip(AVERAGES, DELTAS)})


def transverse(points: DataFrame, block: int = profiles.BLOCK) -> DataFrame:
    """points of direction 1 → cluster, index, ruts, water depths, gradient, and the line lx0, ly0, lx1, ly1 from lane 0 to lane 24.

    Gaps are filled across, along and, with what lies outside of kerbs taken out, across again. Profiles without lane 0 or 24 have no line.
    """
    p = profiles.fill_along(fill_across(points, LANES[1]), ["cluster", "lane"], "index", "z", block)
    rows = p.groupBy("cluster", "index").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lane", "z"))), lambda s: s["z"]).alias("h"),
        *[F.max(F.when(F.col("lane") == k, F.col(a))).alias(f"l{a}{i}") for i, k in enumerate((0, LANES[1] - 1)) for a in "xy"],
    )
    return rows.withColumn("t", profiles.transverse(F.col("h"))).select("cluster", "index", "t.*", "lx0", "ly0", "lx1", "ly1")


def aggregate(areas: DataFrame, points: DataFrame, lines: DataFrame) -> DataFrame:
    """areas(area_id, …) with the measures of the points and lines joined to them (both with area_id); areas without any keep their row.

    Maxima and means of left and right also come as the greater of the two; a side that is missing is left out.
    """
    taken = {"depth_mid": ("max", "mean")} | {d: ("std",) for d in DELTAS} | {"gradient": ("mean",)}
    along = aggregate_measures(points, "area_id", taken, UNIT).withColumnRenamed("gradient_mean", "gradient_longitudinal_mean")
    across = aggregate_measures(lines, "area_id", {s: ("max", "mean", "std") for s in SIDES} | {"gradient": ("mean",)}, UNIT).withColumnRenamed("gradient_mean", "gradient_transverse_mean")
    for m in ("rut_depth", "water_depth"):
        across = across.withColumn(f"{m}_mean_max", F.greatest(f"{m}_left_mean", f"{m}_right_mean")).withColumn(f"{m}_max", F.greatest(f"{m}_left_max", f"{m}_right_max"))
    metres = {c: (F.col(c) / UNIT) for t in (along, across) for c in t.columns if c != "area_id"}
    return areas.join(along, "area_id", "left").join(across, "area_id", "left").withColumns(metres)


def to_ap9(aggregated: DataFrame, digits: int = 2, only: bool = False) -> DataFrame:
    """The norm's columns: millimetres (gradients stay percent), rounded, null for fk N; what served to compute them goes. only: nothing but area_id, geometry and these."""
    inner = {f"{s}_max" for s in SIDES} | {"water_depth_max"}
    value = lambda c: F.col(c) if "gradient" in c else F.col(c) * 1e3
    # a column of its own first, as rounding names it several times
    df = aggregated.withColumns({f"_{n}": value(c) for c, n in AP9.items()})
    own = [c for c in ("area_id", "geometry") if c in aggregated.columns] if only else [c for c in aggregated.columns if c not in AP9 and c not in inner]
    rounded = [F.when(F.col("fk") != "N", round_exact(F.col(f"_{n}"), digits)).alias(n) for n in AP9.values()]
    return df.select(*[F.col(f"`{c}`") for c in own], *rounded)
