"""Recordings and point-cloud extents from trees of meta.json files, and the index of finished tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelens.functions.scalars import base_number, in_range
from pavelens.sources.config import RecordingFields

META = (
    "spherical_images array<struct<sensor_id: string, path: string, time_stamp: double, pose: struct<translation: array<double>, orientation_roll_pitch_yaw: array<double>>>>, "
    "point_clouds array<struct<sensor_id: string, path: string, bounding_box: struct<min: array<double>, max: array<double>>>>"
)


def _meta(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(META).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "meta.json").json(path)
    return df.withColumn("_file", F.col("_metadata.file_path")).filter(~F.col("_file").rlike(r"/\.[^/]+/"))


def recording_points(spark: SparkSession, path: str, sensor: str = "ladybug_front", zone: str = "Europe/Berlin") -> DataFrame:
    """One row per image of the sensor: run (its file), image_no from 0 in the file, time in the zone, place, angles in degrees."""
    d = _meta(spark, path).select("_file", F.posexplode("spherical_images").alias("image_no", "i")).filter(F.col("i.sensor_id") == sensor)
    at, angle = F.col("i.pose.translation"), F.col("i.pose.orientation_roll_pitch_yaw")
    local = F.from_utc_timestamp(F.timestamp_micros((F.col("i.time_stamp") * 1_000_000).cast("bigint")), zone)
    return d.select(
        F.col("_file").alias("run"), "image_no", F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("recorded_at"),
        F.get(at, F.lit(0)).alias("x"), F.get(at, F.lit(1)).alias("y"), F.get(at, F.lit(2)).alias("height"),
        F.degrees(F.get(angle, F.lit(0))).alias("roll"), (-(F.degrees(F.get(angle, F.lit(1))) + 90.0)).alias("pitch"), F.degrees(F.get(angle, F.lit(2))).alias("direction"), F.col("i.path").alias("image_path"),
    )


def cloud_extents(spark: SparkSession, path: str, sensor: str = "CPS") -> DataFrame:
    d = _meta(spark, path).select("_file", F.explode("point_clouds").alias("c")).filter(F.col("c.sensor_id") == sensor)
    lo, hi = F.col("c.bounding_box.min"), F.col("c.bounding_box.max")
    return d.select(F.col("_file").alias("run"), F.col("c.path").alias("path"), F.get(lo, F.lit(0)).alias("x0"), F.get(lo, F.lit(1)).alias("y0"), F.get(hi, F.lit(0)).alias("x1"), F.get(hi, F.lit(1)).alias("y1"))


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """(tile_id) of finished tiles; empty if there is no index yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "tile_id string")
    return spark.read.schema("tile_id string").parquet(path).distinct()


def mark_done(tiles: DataFrame, path: str) -> None:
    """Append tiles that aren't in the index yet; marking twice changes nothing."""
    new = tiles.select("tile_id").distinct().join(read_done(tiles.sparkSession, path), "tile_id", "left_anti")
    new.write.mode("append").parquet(path)


def merge_tables(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """All cached results below a folder as one table; columns that a file lacks are null."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).parquet(folder)


def recordings_of(table: DataFrame, fields: RecordingFields) -> DataFrame:
    """A table of recordings with the settings' names → image_id, image_no, recorded_at, direction, x, y, height, image_path, mask_path, pitch, roll.

    image_no is the id read in the settings' base. pitch and roll are 0, paths null where no field is named for them.
    """
    own = lambda name, kind, other=None: F.col(f"`{name}`").cast(kind) if name else F.lit(other).cast(kind)
    return table.select(
        own(fields.id, "string").alias("image_id"), base_number(own(fields.id, "string"), fields.id_base).cast("bigint").alias("image_no"), own(fields.time, "string").alias("recorded_at"),
        own(fields.direction, "double").alias("direction"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), own(fields.height, "double").alias("height"),
        own(fields.path, "string").alias("image_path"), own(fields.mask, "string").alias("mask_path"), own(fields.pitch, "double", 0.0).alias("pitch"), own(fields.roll, "double", 0.0).alias("roll"),
    )


def recordings_in_box(recordings: DataFrame, x0: float, y0: float, x1: float, y1: float, buffer: float = 7.5) -> DataFrame:
    """(info): the recordings in a box widened by `buffer`, borders included, each as one struct of its columns; the bounds reach the scan."""
    near = in_range(F.col("x"), x0 - buffer, x1 + buffer) & in_range(F.col("y"), y0 - buffer, y1 + buffer)
    return recordings.filter(near).select(F.struct(*[F.col(f"`{c}`") for c in recordings.columns]).alias("info"))
