"""Tiles processed as they arrive: a file stream with a checkpoint in place of a list of finished tiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def process_tiles(spark: SparkSession, source: str, schema: T.StructType | str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, files_per_batch: int = 1_000):
    """Run `work` on each batch of new parquet files below source and write its result under target/batch=<n>; ends when all are done.

    A batch that is run again after a failure replaces its own folder, so results are written once.
    """

    def write(df: DataFrame, batch: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{target}/batch={batch}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def running_counts(stream: DataFrame, time: str, keys: list[str], window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per window and key of a stream; rows later than `late` are left out and finished windows are forgotten."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("n"))


def mean_batch_seconds(query) -> float | None:
    """Mean seconds of the batches that a stream of tiles has run, from its recent progress; None if it has run none."""
    took = [p["durationMs"].get("triggerExecution") for p in query.recentProgress if p["numInputRows"]]
    return sum(took) / len(took) / 1000 if took else None
