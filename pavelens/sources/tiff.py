"""Uncompressed GeoTIFF of one raster tile: north up, one to four bands of 8 or 16 bits."""

from __future__ import annotations

import struct

import numpy as np


def tiff_bytes(image: np.ndarray, x0: float, y1: float, cell: float, epsg: int = 25832) -> bytes:
    """image (height, width[, bands]) uint8 or uint16; x0, y1: upper left corner."""
    a = image[..., None] if image.ndim == 2 else image
    if a.dtype not in (np.uint8, np.uint16) or not 1 <= a.shape[2] <= 4:
        raise ValueError("one to four bands of uint8 or uint16")
    h, w, n = a.shape
    data = a.astype(a.dtype.newbyteorder("<")).tobytes()
    keys = struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg)
    scale, tie = struct.pack("<3d", cell, cell, 0), struct.pack("<6d", 0, 0, 0, x0, y1, 0)
    bits = struct.pack(f"<{n}H", *[8 * a.dtype.itemsize] * n)
    extra = [(338, 3, 1, struct.pack("<H", 2))] if n in (2, 4) else []
    tags = sorted([
        (256, 4, 1, struct.pack("<I", w)), (257, 4, 1, struct.pack("<I", h)), (258, 3, n, bits), (259, 3, 1, struct.pack("<H", 1)), (262, 3, 1, struct.pack("<H", 2 if n >= 3 else 1)),
        (273, 4, 1, None), (277, 3, 1, struct.pack("<H", n)), (278, 4, 1, struct.pack("<I", h)), (279, 4, 1, struct.pack("<I", len(data))), (284, 3, 1, struct.pack("<H", 1)),
        (33550, 12, 3, scale), (33922, 12, 6, tie), (34735, 3, 16, keys), *extra,
    ])
    at = 8 + 2 + 12 * len(tags) + 4
    body, entries, starts = b"", [], at + sum(len(v) for *_, v in tags if v and len(v) > 4)
    for tag, kind, count, v in tags:
        if v is None:
            v = struct.pack("<I", starts)
        if len(v) > 4:
            entries.append(struct.pack("<HHII", tag, kind, count, at + len(body)))
            body += v
        else:
            entries.append(struct.pack("<HHI", tag, kind, count) + v.ljust(4, b"\0"))
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(tags)) + b"".join(entries) + b"\0\0\0\0" + body + data
