"""The runs as whole: evenness from recordings and laser points, substance from damage objects, rating; rating only; rating again. Each ends in a parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelens.functions.scalars import round_exact
from pavelens.operators import evaluate, lidar, planeness, polygons, sampling
from pavelens.session import Scratch
from pavelens.sources.config import Settings


def factor_frame(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.createDataFrame(settings.factor_rows(), "bw string, metric string, fk string, f1 double, f2 double, f3 double")


def check_areas(areas: DataFrame, crs: str | None = None, settings: Settings | None = None) -> DataFrame:
    """areas unchanged; raises when run if ids are missing, bw isn't A or P, fk isn't A, B or N, or a geometry is no sound polygon.

    Areas without a geometry column are judged by the rest. crs: what the areas are in; another one than the settings' is an error at once.
    """
    if crs is not None and settings is not None:
        from pavelens.sources.config import crs_name

        if crs_name(crs) != settings.epsg:
            raise ValueError(f"the areas are in {crs}, the run in {settings.epsg}; there is no reprojection")
    bad = F.col("area_id").isNull() | ~F.coalesce(F.col("bw").isin("A", "P"), F.lit(False)) | ~F.coalesce(F.col("fk").isin("A", "B", "N"), F.lit(False))
    stop = lambda wrong, why: F.when(wrong, F.raise_error(why).cast("boolean")).otherwise(True)
    out = areas.filter(stop(bad, F.lit("bw is A or P, fk is A, B or N, and area_id is given")))
    if "geometry" not in areas.columns:
        return out
    why = F.concat(F.lit("area "), F.col("area_id").cast("string"), F.lit(": geometry is "), F.col("problem"))
    return polygons.shape_problem(out).filter(stop(F.col("problem").isNotNull(), why)).drop("problem")


def check_lanes(lanes: DataFrame) -> DataFrame:
    """lanes(id, geometry) unchanged; raises when run if a geometry is no line of two or more places."""
    why = F.concat(F.lit("lane "), F.coalesce(F.col("id").cast("string"), F.lit("?")), F.lit(": geometry is "), F.col("problem"))
    bad = F.when(F.col("problem").isNotNull(), F.raise_error(why).cast("boolean")).otherwise(True)
    return polygons.shape_problem(lanes, kind="LINESTRING").filter(bad).drop("problem")


def with_substance(areas: DataFrame, damage: DataFrame) -> DataFrame:
    """areas with riss, afli, ofs computed anew from damage polygons, asphalt and paved areas by their own rules; rounded to two digits."""
    base = areas.drop("riss", "afli", "ofs")
    shares = polygons.damaged_shares(base, damage)
    return base.join(shares.select("area_id", *[round_exact(F.col(c)).alias(c) for c in ("riss", "afli", "ofs")]), "area_id", "left")


def sample_heights(samples: DataFrame, cloud: DataFrame, scratch: Scratch, radius: float = 0.025) -> DataFrame:
    """samples(cluster, direction, lane, index, x, y) with z from the ground points of cloud(point_id, x, y, z) that are no outliers."""
    ground = scratch.keep(lidar.ground(cloud.select("point_id", "x", "y", "z")), "ground")
    off = lidar.outliers(ground, "point_id").select("point_id")
    points = ground.join(off, "point_id", "left_anti").select("point_id", F.col("x").alias("rx"), F.col("y").alias("ry"), "z")
    # a number for each sample that stays the same, as it is written down
    own = scratch.keep(samples.drop("z").withColumn("_sid", F.monotonically_increasing_id()), "samples")
    return lidar.inverse_distance_height(own, points, "_sid", "point_id", radius).drop("_sid")


def with_evenness(areas: DataFrame, samples: DataFrame, scratch: Scratch) -> DataFrame:
    """areas(area_id, fk, geometry, …) with the norm's evenness measures (sm4l_m … qn) from samples with heights."""
    samples = scratch.keep(samples, "heights")
    points = scratch.keep(planeness.longitudinal(samples.filter("direction = 0")), "longitudinal")
    lines = scratch.keep(planeness.transverse(samples.filter("direction = 1")), "transverse")
    shapes = areas.select("area_id", "geometry")
    along = polygons.points_in_areas(points, shapes, ["area_id"])
    across = polygons.lines_in_areas(lines, shapes, ["area_id"])
    names = {n: n.lower() for n in planeness.AP9.values()}
    base = areas.drop(*names.values())
    return planeness.to_ap9(planeness.aggregate(base, along, across)).withColumnsRenamed(names)


def full_run(spark: SparkSession, areas: DataFrame, recordings: DataFrame, cloud: DataFrame, damage: DataFrame, settings: Settings, target: str, lanes: DataFrame | None = None) -> DataFrame:
    """Areas, recordings(run_id, image_no, recording_id, x, y), laser points, damage objects and pseudo-lanes → rated areas, written to target and read back."""
    scratch = Scratch(spark, "run")
    try:
        areas = scratch.keep(check_areas(areas), "areas")
        samples = sample_heights(sampling.create(recordings, None if lanes is None else check_lanes(lanes)), cloud, scratch)
        measured = with_substance(with_evenness(areas, samples, scratch), damage)
        evaluate.rate(measured, factor_frame(spark, settings), settings.weights).write.mode("error").parquet(target)
    finally:
        scratch.drop()
    return spark.read.parquet(target)


def evaluate_only(spark: SparkSession, areas: DataFrame, samples: DataFrame, damage: DataFrame, settings: Settings, target: str) -> DataFrame:
    """Like full_run from cached samples with heights and cached damage on."""
    scratch = Scratch(spark, "run")
    try:
        measured = with_substance(with_evenness(scratch.keep(check_areas(areas), "areas"), samples, scratch), damage)
        evaluate.rate(measured, factor_frame(spark, settings), settings.weights).write.mode("error").parquet(target)
    finally:
        scratch.drop()
    return spark.read.parquet(target)


def reevaluate(spark: SparkSession, source: str, settings: Settings, target: str) -> DataFrame:
    """Rate a rated table again with other settings and write it to another place (a table can't be replaced while it is read)."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target are the same")
    evaluate.rerate(spark.read.parquet(source), factor_frame(spark, settings), settings.weights).write.mode("error").parquet(target)
    return spark.read.parquet(target)
