"""What a job needs around its plans: the package on the executors and a shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Put this package on every executor, once per application; lost executors fetch it again."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return spark
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="pavelens-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "pavelens_pkg.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path("pavelens") / p.relative_to(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset (tests, local mode) one is made and set."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="pavelens-scratch-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        at = f"file://{at}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


class Scratch:
    """Tables written to the shared folder so that lineage ends there and nothing is computed twice.

    Results may still be read from them, so they stay until drop() or, at the latest, until the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/pavelens/{name}-{uuid.uuid4().hex[:12]}"
        p = self._path(self.root)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)

    def _path(self, at: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(at)

    def path(self, part: str) -> str:
        return f"{self.root}/{part}"

    def keep(self, df: DataFrame, part: str) -> DataFrame:
        """Write df and return a scan of what was written."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(part))
        return self.spark.read.schema(df.schema).parquet(self.path(part))

    def drop(self, part: str = "") -> None:
        """Delete a part no plan needs any more (all of them if none is named)."""
        p = self._path(self.path(part) if part else self.root)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
