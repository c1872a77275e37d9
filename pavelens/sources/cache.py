"""Where a run keeps its results: the output tree, caches by tile and layer, tables that grow tile by tile, finished recordings, rasters."""

from __future__ import annotations

import os
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelens.sources.tiff import tiff_bytes


@dataclass(frozen=True)
class Output:
    """The folders of a run below one root."""

    root: str

    @property
    def markings(self) -> str:
        return f"{self.root}/Zwischenergebnisse/Markierungen"

    @property
    def damage(self) -> str:
        return f"{self.root}/Zwischenergebnisse/Substanz"

    @property
    def samples(self) -> str:
        return f"{self.root}/Geodaten/Ebenheit"

    @property
    def rated(self) -> str:
        return f"{self.root}/Geodaten/Strassenzustand"

    @property
    def rasters(self) -> str:
        return f"{self.root}/Raster"

    @property
    def done(self) -> str:
        return f"{self.root}/done"

    def create(self, spark: SparkSession) -> Output:
        """Make the folders that aren't there."""
        for folder in (self.markings, self.damage, self.samples, self.rated, self.rasters):
            p = spark._jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
        return self


def write_cache(df: DataFrame, folder: str, keys: tuple[str, ...] = ("tile_id", "height_layer")) -> None:
    """df by tile and layer; the tiles and layers in df replace what was there of them, others stay."""
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(folder)


def merge_heights(samples: DataFrame, folder: str, keys: tuple[str, ...] = ("cluster", "direction", "lane", "index")) -> DataFrame:
    """samples(keys, …, z) with the heights cached by tile in folder (keys, z); where tiles overlap the newest tile by name counts.

    Each tile writes its own part (write_cache), so no tile rewrites the whole table.
    """
    cached = samples.sparkSession.read.parquet(folder).filter("z is not null")
    best = cached.groupBy(*keys).agg(F.max_by("z", "tile_id").alias("_z"))
    return samples.join(best, list(keys), "left").withColumn("z", F.coalesce("_z", "z")).drop("_z")


def list_tiles(spark: SparkSession, folder: str, glob: str = "*.la[sz]") -> DataFrame:
    """(name, path, n_bytes) of the files of a folder in any file system that Spark reads; contents aren't read."""
    # read with its sub-folders, as these may look like partitions, which then are left out
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    own = F.col("path").endswith(F.concat(F.lit(folder.removeprefix("file://").rstrip("/") + "/"), name))
    return files.filter(own).select(name.alias("name"), "path", F.col("length").alias("n_bytes"))


def write_rasters(tiles: DataFrame, folder: str, cell_m: float, epsg: int = 25832) -> DataFrame:
    """tiles(tile_id, x0, y1, height, width, bands, pixels binary uint8) as one GeoTIFF each in a folder all executors share; gives (path, n_bytes)."""
    import numpy as np

    def run(batches):
        for b in batches:
            out = []
            for t in b.to_pylist():
                image = np.frombuffer(t["pixels"], np.uint8).reshape(t["height"], t["width"], t["bands"])
                path, data = os.path.join(folder, f"{t['tile_id']}.tif"), tiff_bytes(image, t["x0"], t["y1"], cell_m, epsg)
                with open(f"{path}.{os.getpid()}.part", "wb") as f:
                    f.write(data)
                os.replace(f.name, path)
                out.append((path, len(data)))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], names=["path", "n_bytes"])

    os.makedirs(folder, exist_ok=True)
    return tiles.select("tile_id", "x0", "y1", "height", "width", "bands", "pixels").mapInArrow(run, "path string, n_bytes bigint")
