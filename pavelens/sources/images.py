"""Panorama images as rows of pixels. Portable pixmaps (P5, P6) are decoded here; other formats by a function that is given."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HEAD = re.compile(rb"^(P[56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s")


def decode_pixmap(data: bytes) -> np.ndarray | None:
    """(height, width, bands) uint8 of a binary portable grey- or pixmap; None if it is none or cut short."""
    m = _HEAD.match(data)
    if not m or int(m[4]) > 255:
        return None
    width, height, bands = int(m[2]), int(m[3]), 3 if m[1] == b"P6" else 1
    body = data[m.end() :]
    return np.frombuffer(body, np.uint8, width * height * bands).reshape(height, width, bands) if len(body) >= width * height * bands else None


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The nearest pixels of an image at another size."""
    h, w = image.shape[:2]
    return image[(np.arange(height) * h // height)[:, None], (np.arange(width) * w // width)[None, :]]


def load_images(spark: SparkSession, infos: DataFrame, folder: str, shape: tuple[int, int] | None = None, mask: np.ndarray | None = None, decode: Callable[[bytes], np.ndarray | None] = decode_pixmap, glob: str = "*") -> DataFrame:
    """infos(image_path, …), relative to folder → infos with height, width, bands, pixels binary; images that can't be read are left out.

    shape: height and width to bring all to. mask: true where the recording vehicle is seen, any size; such pixels become 0.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).select("path", "content")
    home = folder.removeprefix("file://").rstrip("/")
    joined = infos.join(files.withColumn("image_path", F.substring_index("path", f"{home}/", -1)).drop("path"), "image_path")
    kinds = {f.name: f.dataType.simpleString() for f in infos.schema}
    names = list(infos.columns)
    hidden = spark.sparkContext.broadcast(mask)  # one image

    def run(batches):
        for b in batches:
            at, out = [], []
            for i, c in enumerate(b.column("content")):
                image = decode(c.as_py())
                if image is None:
                    continue
                image = resized(image, *shape) if shape else image
                if hidden.value is not None:
                    image = np.where(resized(hidden.value, *image.shape[:2])[..., None], 0, image).astype(np.uint8)
                at.append(i)
                out.append((*image.shape, np.ascontiguousarray(image).tobytes()))
            cols = list(zip(*out)) or [[]] * 4
            kept = [b.column(n).take(pa.array(at, pa.int64())) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary())))], names=[*names, "height", "width", "bands", "pixels"])

    return joined.select(*names, "content").mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", height int, width int, bands int, pixels binary")
