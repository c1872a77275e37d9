"""The queries of the general data problems over the survey tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelens.operators import compaction, nearspace, timestamps
from pavelens.plans import checks
from pavelens.session import Scratch, ship, table


def recording_instants(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """The given columns of recordings with utc_us of every time stamp that states one instant."""
    df = table(spark, sf_dir, "recordings").select(*dict.fromkeys([*columns, "run_id", "time_stamp"]))
    out = timestamps.normalise_timestamps(df, "time_stamp", source="run_id")
    return out.filter(F.col("ts_status") == "resolved").select(*columns, "utc_us")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    scratch = Scratch(spark, "p3")
    rec = table(spark, sf_dir, "recordings").select(F.col("rec_id").alias("id"), F.col("run_id").alias("grp"), "geometry")
    sub = table(spark, sf_dir, "substance").select(F.col("substance_id").alias("id"), "geometry")
    area = table(spark, sf_dir, "strassenzustand").select(F.col("area_id").alias("id"), "geometry")
    pivots = nearspace._pivots(spark, [rec, sub, area], 4_000)
    near = nearspace.radius_pairs(rec, 2.5, pivots=pivots, scratch=scratch)
    objects = rec.select(F.lit("rec_area").alias("kind"), "id", "geometry").union(sub.select(F.lit("sub_area").alias("kind"), "id", "geometry"))
    within = nearspace.containing_regions(objects, area, pivots=pivots, scratch=scratch)
    return near.select(F.lit("rec_rec").alias("relation"), "a_id", "b_id").union(within.select(F.col("kind").alias("relation"), "a_id", "b_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return recording_instants(spark, sf_dir, ["rec_id"]).distinct()


def p4_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every recording row with its reading, the unresolved ones marked."""
    ship(spark)
    df = table(spark, sf_dir, "recordings").select("rec_id", "run_id", "time_stamp").distinct()
    return timestamps.normalise_timestamps(df, "time_stamp", source="run_id")


#: Bytes of a consolidated file of the test tables, whose payloads are a few MB: dozens of bins at sf0.1, hundreds at ten times that.
P5_TARGET_BYTES = 128 << 10


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    done = compaction.compact(table(spark, sf_dir, "cache_files"), Scratch(spark, "p5").path("compacted"), P5_TARGET_BYTES)
    return done.data.select("table_name", "record_id")


def p5_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of the consolidation at 1 MB a bin: table, bin, files, bytes."""
    ship(spark)
    return compaction.file_plan(table(spark, sf_dir, "cache_files"), 1 << 20)


QUERIES = {"p3_found": p3_found, "p4_found": p4_found, "p4_status": p4_status, "p5_found": p5_found, "p5_plan": p5_plan}
ORACLES: dict[str, str] = dict(checks.SQL)
