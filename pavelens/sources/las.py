"""Uncompressed LAS point clouds (point formats 0 to 3) as a Spark data source, and a writer of one file per partition.

spark.dataSource.register(LasSource); spark.read.format("pavelens_las").load("dir/*.las"). Files are cut
into ranges of points that are read in parallel. Compressed LAZ isn't read.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = (
    "x double, y double, z double, intensity int, return_number smallint, number_of_returns smallint, scan_direction_flag smallint, edge_of_flight_line smallint, "
    "classification smallint, scan_angle_rank float, user_data smallint, point_source_id int, gps_time double, red int, green int, blue int"
)
_CORE = [("X", "<i4"), ("Y", "<i4"), ("Z", "<i4"), ("intensity", "<u2"), ("flags", "u1"), ("classification", "u1"), ("angle", "i1"), ("user", "u1"), ("source", "<u2")]
_TIME, _COLOUR = [("gps", "<f8")], [("r", "<u2"), ("g", "<u2"), ("b", "<u2")]
_FORMATS = {0: _CORE, 1: _CORE + _TIME, 2: _CORE + _COLOUR, 3: _CORE + _TIME + _COLOUR}


def _header(path: str) -> dict:
    with open(path, "rb") as f:
        h = f.read(375)
    if h[:4] != b"LASF":
        raise ValueError(f"{path} is no LAS file")
    if h[104] & 0x80 or (h[104] & 0x3F) not in _FORMATS:
        raise ValueError(f"{path}: compressed points or point format {h[104]} aren't read")
    offset, fmt, size, count = struct.unpack_from("<I", h, 96)[0], h[104], *struct.unpack_from("<HI", h, 105)
    return {"offset": offset, "fmt": fmt, "size": size, "count": count, "scale": struct.unpack_from("<3d", h, 131), "shift": struct.unpack_from("<3d", h, 155)}


class _Range(InputPartition):
    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


class _Reader(DataSourceReader):
    POINTS = 1_000_000

    def __init__(self, path: str):
        self.paths = sorted(p for q in glob.glob(path) for p in (glob.glob(os.path.join(q, "*.las")) if os.path.isdir(q) else [q]))
        if not self.paths:
            raise FileNotFoundError(path)

    def partitions(self):
        return [_Range(p, lo, min(lo + self.POINTS, n)) for p in self.paths for n in [_header(p)["count"]] for lo in range(0, max(1, n), self.POINTS)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        h = _header(part.path)
        kind = np.dtype(_FORMATS[h["fmt"]])
        raw = np.fromfile(part.path, np.uint8, (part.high - part.low) * h["size"], offset=h["offset"] + part.low * h["size"]).reshape(-1, h["size"])
        a = np.ascontiguousarray(raw[:, : kind.itemsize]).view(kind).ravel() if len(raw) else np.zeros(0, kind)
        f, n = a["flags"], len(a)
        some = lambda k, t: pa.array(a[k].astype(t)) if k in a.dtype.names else pa.nulls(n, pa.from_numpy_dtype(t))
        xyz = [pa.array(a[c] * s + o) for c, s, o in zip("XYZ", h["scale"], h["shift"])]
        rest = [a["intensity"].astype("i4"), (f & 7).astype("i2"), (f >> 3 & 7).astype("i2"), (f >> 6 & 1).astype("i2"), (f >> 7).astype("i2"), (a["classification"] & 31).astype("i2"), a["angle"].astype("f4"), a["user"].astype("i2"), a["source"].astype("i4")]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([*xyz, *map(pa.array, rest), some("gps", "f8"), *(some(c, "i4") for c in "rgb")], names=names)


class LasSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pavelens_las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def las_bytes(t: pa.Table, scale: float = 0.001) -> bytes:
    """A LAS 1.2 file of point format 3; coordinates are stored from the least ones on in steps of `scale`."""
    col = lambda n: t.column(n).fill_null(0).to_numpy() if n in t.column_names else np.zeros(t.num_rows)
    xyz = [col(c).astype(float) for c in "xyz"]
    low, high = [a.min() if len(a) else 0.0 for a in xyz], [a.max() if len(a) else 0.0 for a in xyz]
    a = np.zeros(t.num_rows, np.dtype(_FORMATS[3]))
    for c, v, o in zip("XYZ", xyz, low):
        a[c] = np.round((v - o) / scale)
    u = {n: col(n).astype(np.int64) for n in ("return_number", "number_of_returns", "scan_direction_flag", "edge_of_flight_line")}
    a["flags"] = (u["return_number"] & 7) | (u["number_of_returns"] & 7) << 3 | (u["scan_direction_flag"] & 1) << 6 | (u["edge_of_flight_line"] & 1) << 7
    for k, n in (("intensity", "intensity"), ("classification", "classification"), ("angle", "scan_angle_rank"), ("user", "user_data"), ("source", "point_source_id"), ("gps", "gps_time"), ("r", "red"), ("g", "green"), ("b", "blue")):
        a[k] = col(n)
    head = bytearray(227)
    head[0:4] = b"LASF"
    head[24:26] = bytes((1, 2))
    struct.pack_into("<HII", head, 94, 227, 227, 0)
    struct.pack_into("<BHI", head, 104, 3, a.dtype.itemsize, len(a))
    struct.pack_into("<6d", head, 131, *[scale] * 3, *low)
    struct.pack_into("<6d", head, 179, *(v for lo, hi in zip(low, high) for v in (hi, lo)))
    return bytes(head) + a.tobytes()


def write_las(df: DataFrame, folder: str, tile_x: str = "tile_x", tile_y: str = "tile_y") -> DataFrame:
    """One file <x>_<y>.las per tile in a folder all executors share; gives (path, points). Written under another name and renamed."""

    def run(t: pa.Table) -> pa.Table:
        path = os.path.join(folder, f"{t.column(tile_x)[0].as_py()}_{t.column(tile_y)[0].as_py()}.las")
        with open(f"{path}.{os.getpid()}.part", "wb") as f:
            f.write(las_bytes(t))
        os.replace(f.name, path)
        return pa.table({"path": [path], "points": pa.array([t.num_rows], pa.int64())})

    os.makedirs(folder, exist_ok=True)
    return df.groupBy(tile_x, tile_y).applyInArrow(run, "path string, points bigint")


def cloud_from_arrays(spark: SparkSession, arrays: dict[str, np.ndarray]) -> DataFrame:
    """Points of arrays by column name; x, y and z are needed, others of SCHEMA may be missing and are null."""
    if not {"x", "y", "z"} <= set(arrays):
        raise ValueError("x, y and z are needed")
    known = [c.split() for c in SCHEMA.split(", ")]
    if extra := set(arrays) - {n for n, _ in known}:
        raise ValueError(f"unknown columns {sorted(extra)}")
    have = spark.createDataFrame(pa.table({n: pa.array(arrays[n]) for n, _ in known if n in arrays}))
    return have.select(*[F.col(n).cast(t).alias(n) if n in arrays else F.lit(None).cast(t).alias(n) for n, t in known])
