"""WKT read for a whole Arrow batch at once into flat coordinate arrays.

Spelling, letter case, an SRID prefix and Z or M values don't matter; Z and M are dropped. Null, empty
and unreadable texts have no points.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_HEADER = re.compile(r"^\s*(?:SRID\s*=\s*\d+\s*;)?\s*(?:POINT|LINESTRING|POLYGON|MULTIPOINT|MULTILINESTRING|MULTIPOLYGON)\s*(ZM|Z|M)?\s*$", re.IGNORECASE)
_BLANK = str.maketrans("(),\n", "    ")


@dataclass
class Shapes:
    """Points of row i: x[start[i]:start[i+1]]; first[p] marks the first point of a ring."""

    start: np.ndarray
    x: np.ndarray
    y: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def count(self) -> np.ndarray:
        return np.diff(self.start)


def _bulk(bodies: list[str], dims: int):
    """Flat arrays of bodies that all have points of dims numbers; None if any of them doesn't."""
    joined = "\n".join(bodies)
    try:
        numbers = np.array(joined.translate(_BLANK).split(), dtype=np.float64)
    except ValueError:
        return None
    b = np.frombuffer(joined.encode("utf-8", "replace"), dtype=np.uint8)
    lines = b == 10
    segment = np.cumsum((b == 44) | lines)
    n = int(segment[-1]) + 1 if len(b) else 0
    if len(numbers) != n * dims or not np.isfinite(numbers).all():
        return None
    first = np.bincount(segment[b == 40], minlength=n) > 0
    per_row = np.diff(np.concatenate([[0], segment[lines], [n]]))
    return per_row, numbers[0::dims], numbers[1::dims], first


def parse_wkt(texts: list[str | None]) -> Shapes:
    known: dict[str, int] = {}
    by_dims: dict[int, tuple[list[int], list[str]]] = {}
    for i, s in enumerate(texts):
        at = s.find("(") if s else -1
        if at < 0:
            continue
        head = s[:at]
        dims = known.get(head)
        if dims is None:
            m = _HEADER.match(head)
            dims = known[head] = 2 + len(m.group(1) or "") if m else 0
        if dims:
            rows, bodies = by_dims.setdefault(dims, ([], []))
            rows.append(i)
            bodies.append(s[at:].replace("\n", " ").replace("\r", " "))
    counts = np.zeros(len(texts), dtype=np.int64)
    blocks = []
    for dims, (rows, bodies) in by_dims.items():
        done = _bulk(bodies, dims)
        if done is None:  # something in it is broken: take the rows one by one and leave out the broken ones
            kept = [(r, one) for r, body in zip(rows, bodies) if body.count("(") == body.count(")") and (one := _bulk([body], dims)) is not None]
            rows = [r for r, _ in kept]
            done = tuple(np.concatenate([one[k] for _, one in kept]) for k in range(4)) if kept else None
        if done is not None:
            counts[rows] = done[0]
            blocks.append((np.array(rows), done))
    start = np.concatenate([[0], np.cumsum(counts)])
    x, y, first = np.empty(start[-1]), np.empty(start[-1]), np.zeros(start[-1], dtype=bool)
    for rows, (per_row, bx, by, bf) in blocks:
        to = np.repeat(start[rows] - np.concatenate([[0], np.cumsum(per_row)[:-1]]), per_row) + np.arange(len(bx))
        x[to], y[to], first[to] = bx, by, bf
    return Shapes(start, x, y, first)


def to_binary(s: Shapes) -> tuple[pa.Array, pa.Array]:
    """The points of each row as bytes (x, y as doubles) and the ring marks as bytes."""
    xy = np.column_stack([s.x, s.y]).astype("<f8")
    if len(s.x) * 16 >= 2**31:
        raise ValueError("an Arrow batch holds more than 2 GB of coordinates; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    both = [pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer((s.start * w).astype("<i4")), pa.py_buffer(d.tobytes())]) for w, d in ((16, xy), (1, s.first.astype(np.uint8)))]
    return both[0], both[1]


def from_binary(xy: pa.ChunkedArray, first: pa.ChunkedArray) -> Shapes:
    def flat(col, dtype):
        a = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        if isinstance(a, pa.ChunkedArray):
            a = pa.concat_arrays(a.chunks)
        if a.null_count:
            a = a.fill_null(b"")
        offsets = np.frombuffer(a.buffers()[1], dtype="<i4" if pa.types.is_binary(a.type) else "<i8")[a.offset : a.offset + len(a) + 1].astype(np.int64)
        data = np.frombuffer(a.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(a) else np.zeros(0, np.uint8)
        return offsets - offsets[0], np.frombuffer(data.tobytes(), dtype=dtype)

    if not len(xy):
        return Shapes(np.zeros(1, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, bool))
    o, v = flat(xy, "<f8")
    _, f = flat(first, np.uint8)
    return Shapes(o // 16, v[0::2], v[1::2], f.astype(bool))


def edges(s: Shapes):
    """Edge offsets of each row and the edges' ends; every ring is closed."""
    n = len(s.x)
    if not n:
        return s.start, *(np.zeros(0) for _ in range(4))
    begin = s.first.copy()
    begin[s.start[:-1][s.count() > 0]] = True
    at = np.flatnonzero(begin)
    after = np.arange(1, n + 1)
    after[np.append(at[1:], n) - 1] = at
    return s.start, s.x, s.y, s.x[after], s.y[after]


def ragged(start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows `which`: the position in `which` and the element index of all their elements."""
    n = start[which + 1] - start[which]
    owner = np.repeat(np.arange(len(which)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[which], n)


def inside(px: np.ndarray, py: np.ndarray, region: np.ndarray, e) -> np.ndarray:
    """Whether point i is inside row region[i] of the edges e, by even and odd crossings over all rings."""
    start, x0, y0, x1, y1 = e
    out = np.zeros(len(px), dtype=bool)
    total = np.cumsum(start[region + 1] - start[region])
    lo = 0
    while lo < len(px):  # blocks of about two million edges
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + 2_000_000)))
        owner, k = ragged(start, region[lo:hi])
        qx, qy = px[lo:hi][owner], py[lo:hi][owner]
        a, b = y0[k] > qy, y1[k] > qy
        cross = a != b
        o, k, qx, qy = owner[cross], k[cross], qx[cross], qy[cross]
        left = qx < (x1[k] - x0[k]) * (qy - y0[k]) / (y1[k] - y0[k]) + x0[k]
        out[lo:hi] = np.bincount(o[left], minlength=hi - lo) % 2 == 1
        lo = hi
    return out


def crossing(a_rows: np.ndarray, ea, b_rows: np.ndarray, eb) -> np.ndarray:
    """Whether any edge of a_rows[i] properly crosses an edge of b_rows[i]."""
    out = np.zeros(len(a_rows), dtype=bool)
    weight = np.cumsum((ea[0][a_rows + 1] - ea[0][a_rows]) * (eb[0][b_rows + 1] - eb[0][b_rows]))
    lo = 0
    while lo < len(a_rows):
        hi = max(lo + 1, int(np.searchsorted(weight, (weight[lo - 1] if lo else 0) + 2_000_000)))
        owner, i = ragged(ea[0], a_rows[lo:hi])
        again, j = ragged(eb[0], b_rows[lo:hi][owner])
        owner, i = owner[again], i[again]
        ax, ay, bx, by = (c[i] for c in ea[1:])
        cx, cy, dx, dy = (c[j] for c in eb[1:])
        side = lambda px, py, qx, qy, rx, ry: (qx - px) * (ry - py) - (qy - py) * (rx - px)
        hit = (side(cx, cy, dx, dy, ax, ay) * side(cx, cy, dx, dy, bx, by) < 0) & (side(ax, ay, bx, by, cx, cy) * side(ax, ay, bx, by, dx, dy) < 0)
        out[lo:hi] = np.bincount(owner[hit], minlength=hi - lo) > 0
        lo = hi
    return out


def contains(outer: np.ndarray, eo, inner: np.ndarray, ei) -> np.ndarray:
    """Whether row outer[i] contains all of row inner[i]: its vertices are inside, no edges cross, and no ring of the outer lies in the inner."""
    ok = np.ones(len(outer), dtype=bool)
    for check in ("vertices", "edges", "rings"):
        at = np.flatnonzero(ok)
        if not len(at):
            break
        o, i = outer[at], inner[at]
        if check == "edges":
            ok[at[crossing(i, ei, o, eo)]] = False
            continue
        (rows, e), (into, f) = ((i, ei), (o, eo)) if check == "vertices" else ((o, eo), (i, ei))
        owner, k = ragged(e[0], rows)
        bad = inside(e[1][k], e[2][k], into[owner], f) != (check == "vertices")
        ok[at[np.unique(owner[bad])]] = False
    return ok
