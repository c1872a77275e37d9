"""GeoPackage layers as a Spark data source (read) and as a sink. A GeoPackage is SQLite, so only the standard library is needed.

Reading: spark.dataSource.register(GeoPackageSource); spark.read.format("pavelens_gpkg").load(path) with
options `layer` (the only one by default) and `partitions` (row ranges read in parallel). The geometry
column comes as WKT; points, lines, polygons and their multi forms are read, others give null.
"""

from __future__ import annotations

import re
import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_NAMES = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON"}


def wkb_to_wkt(b: bytes) -> str | None:
    """WKT of a WKB geometry; extra dimensions are dropped."""

    def read(at: int) -> tuple[str, str, int]:
        order = "<" if b[at] == 1 else ">"
        kind = struct.unpack_from(order + "I", b, at + 1)[0]
        dims = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        kind &= 0x0FFFFFFF
        dims = max(dims, {0: 2, 1: 3, 2: 3, 3: 4}[kind // 1000])
        kind %= 1000
        at += 5

        def points(n: int, at: int) -> tuple[list[str], int]:
            v = struct.unpack_from(f"{order}{n * dims}d", b, at)
            return [f"{v[i]!r} {v[i + 1]!r}" for i in range(0, n * dims, dims)], at + 8 * n * dims

        count = lambda at: (struct.unpack_from(order + "I", b, at)[0], at + 4)
        if kind == 1:
            p, at = points(1, at)
            return "POINT", f"({p[0]})", at
        if kind == 2:
            n, at = count(at)
            p, at = points(n, at)
            return "LINESTRING", "(" + ", ".join(p) + ")", at
        n, at = count(at)
        parts = []
        for _ in range(n):
            if kind == 3:
                m, at = count(at)
                p, at = points(m, at)
                parts.append("(" + ", ".join(p) + ")")
            else:
                _, body, at = read(at)
                parts.append(body)
        return _NAMES[kind], "(" + ", ".join(parts) + ")", at

    try:
        name, body, _ = read(0)
    except (struct.error, KeyError, IndexError):
        return None
    return f"{name} {body if '()' not in body else 'EMPTY'}"


def wkt_to_wkb(text: str | None) -> bytes | None:
    """WKB of a POINT, LINESTRING, POLYGON or MULTIPOLYGON in WKT; None for null, empty and other texts."""
    m = re.match(r"\s*(?:SRID=\d+;)?\s*(POINT|LINESTRING|POLYGON|MULTIPOLYGON)\s*(?:Z|M|ZM)?\s*(\(.*\))\s*$", text or "", re.IGNORECASE | re.DOTALL)
    if not m:
        return None
    pts = lambda s: [tuple(map(float, p.split()[:2])) for p in s.split(",")]
    pack = lambda ps: b"".join(struct.pack("<2d", *p) for p in ps)
    poly = lambda s: (lambda rs: struct.pack("<BII", 1, 3, len(rs)) + b"".join(struct.pack("<I", len(r)) + pack(r) for r in rs))([pts(r) for r in re.findall(r"\(([^()]*)\)", s)])
    kind, body = m[1].upper(), m[2]
    if kind == "POINT":
        return struct.pack("<BI", 1, 1) + pack(pts(body.strip("() ")))
    if kind == "LINESTRING":
        p = pts(body.strip("() "))
        return struct.pack("<BII", 1, 2, len(p)) + pack(p)
    if kind == "POLYGON":
        return poly(body)
    parts = re.findall(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)", body)
    return struct.pack("<BII", 1, 6, len(parts)) + b"".join(map(poly, parts))


def _blob_to_wkt(b: bytes | None) -> str | None:
    if not b or b[:2] != b"GP":
        return None
    envelope = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}.get((b[3] >> 1) & 7, 0)
    return wkb_to_wkt(b[8 + envelope :])


class _Rows(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str, geometry: str | None, schema: T.StructType, parts: int):
        self.path, self.table, self.geometry, self.schema, self.parts = path, table, geometry, schema, parts

    def partitions(self):
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            low, high = c.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return [_Rows(0, 0)]
        step = (high - low) // self.parts + 1
        return [_Rows(a, a + step) for a in range(low, high + 1, step)]

    def read(self, partition: _Rows) -> Iterator[tuple]:
        names = [f.name for f in self.schema]
        real = [self.geometry if n == "geometry" and self.geometry else n for n in names]
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            cols = ", ".join(f'"{n}"' for n in real)
            for row in c.execute(f'SELECT {cols} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?', (partition.low, partition.high)):
                yield tuple(_blob_to_wkt(v) if n == self.geometry else v for n, v in zip(real, row))


class GeoPackageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pavelens_gpkg"

    def _layer(self):
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as c:
            layer = self.options.get("layer") or c.execute("SELECT table_name FROM gpkg_contents ORDER BY rowid LIMIT 1").fetchone()[0]
            geometry = c.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
            columns = c.execute(f'PRAGMA table_info("{layer}")').fetchall()
        return layer, geometry[0] if geometry else None, columns

    def schema(self) -> T.StructType:
        _, geometry, columns = self._layer()
        out = T.StructType()
        for _, name, kind, *_ in columns:
            k = kind.upper()
            t = T.LongType() if "INT" in k else T.DoubleType() if any(x in k for x in ("REAL", "DOUBLE", "FLOAT")) else T.StringType()
            out.add("geometry" if name == geometry else name, T.StringType() if name == geometry else t)
        return out

    def reader(self, schema: T.StructType) -> DataSourceReader:
        layer, geometry, _ = self._layer()
        return _Reader(self.options["path"], layer, geometry, schema, max(1, int(self.options.get("partitions", "8"))))


def write_geopackage(df: DataFrame, path: str, layer: str, srs: int = 25832) -> int:
    """Write df (with a WKT column `geometry`) as one layer of a new file; rows stream through the driver a partition at a time.

    The format is one SQLite file with one writer; tables that are to be processed further go to parquet.
    """
    names = [f.name for f in df.schema]
    kinds = {T.LongType: "INTEGER", T.IntegerType: "INTEGER", T.DoubleType: "REAL", T.BooleanType: "INTEGER"}
    cols = ", ".join(f'"{f.name}" {"BLOB" if f.name == "geometry" else kinds.get(type(f.dataType), "TEXT")}' for f in df.schema)
    n = 0
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER)")
        c.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT)")
        c.execute(f'CREATE TABLE "{layer}" ({cols})')
        c.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", (layer, layer, srs))
        if "geometry" in names:
            c.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geometry', 'GEOMETRY', ?, 0, 0)", (layer, srs))
        head = b"GP\x00\x01" + struct.pack("<i", srs)
        into = f'INSERT INTO "{layer}" VALUES ({", ".join("?" * len(names))})'
        for row in df.toLocalIterator():
            c.execute(into, tuple((head + w if (w := wkt_to_wkb(v)) else None) if k == "geometry" else v if v is None or isinstance(v, (int, float, str, bytes)) else str(v) for k, v in zip(names, row)))
            n += 1
    return n
