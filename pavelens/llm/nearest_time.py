"""Each record of one table paired with the record of another nearest in time, for the same entity.

Both tables are cut by entity and time slice; right records are also put into the slice before or after
if they are within the tolerance of it, so a slice can be matched alone and one entity may hold any
share of all rows. Within partitions the rows are sorted by time and one pass merges them: it holds the
last right record and the left records that still wait for the next one, never more than the tolerance
back in time.

Ties: of equally near right records the smallest id wins. Rows without entity, time or id match nothing.
Rows repeated with equal id and time count once. Left records without a match don't appear.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A slice with more left rows than this is shared out to several tasks.
SLICE_ROWS = 2_000_000
#: Such slices are broadcast up to this many (20 bytes each; there is at most one for each SLICE_ROWS rows), else joined by a shuffle.
BROADCAST_SLICES = 100_000


class _Merge:
    """The pass over one sorted stream of (entity, slice, t, left, id)."""

    def __init__(self, tolerance: int):
        self.tol = tolerance
        self.at = None  # the place (entity, slice, part) that the stream is in
        self.right = None  # (t, id) of the last right record there; of equal times the first, so the smallest id
        self.seen = None  # (t, id) of the last left record there
        self.waiting: list[tuple] = []  # left records without a next right record so far: t, id, gap and id of the last right one

    def _choose(self, t, ids, gap, rid, nt, nid):
        """Left records with what is before them and, if any, the next right record."""
        if nt is not None:
            after = nt - t
            better = (after < gap) | ((after == gap) & (nid < rid))
            gap, rid = np.where(better, after, gap), np.where(better, nid, rid)
        ok = gap <= self.tol
        return ids[ok], rid[ok], gap[ok]

    def flush(self, nt=None, nid=None):
        out = [self._choose(*w, nt, nid) for w in self.waiting]
        self.waiting = []
        return out

    def settle(self, late, out):
        """Left records before `late` can't match a later right record any more."""
        kept = []
        for w in self.waiting:
            old = w[0] < late
            if old.any():
                out.append(self._choose(*(c[old] for c in w), None, None))
                w = tuple(c[~old] for c in w)
            if len(w[0]):
                kept.append(w)
        self.waiting = kept

    def piece(self, t, left, ids):
        """Rows of one place, in order."""
        out, n = [], len(t)
        never = np.int64(1) << 62
        order = np.arange(n)
        is_right = ~left
        # last right record up to each row, of equal times the first
        head = is_right.copy()
        head[1:] &= ~(is_right[:-1] & (t[1:] == t[:-1]))
        if n and head[0] and self.right is not None and self.right[0] == t[0]:
            head[0] = False
        back = np.maximum.accumulate(np.where(head, order, -1))
        forth = np.minimum.accumulate(np.where(head, order, n)[::-1])[::-1]
        if head.any():
            k = int(np.flatnonzero(head)[0])
            nt, nid = t[k], ids[k]
        else:
            nt = nid = None
        keep = left.copy()
        keep[1:] &= ~(left[:-1] & (t[1:] == t[:-1]) & (ids[1:] == ids[:-1]))
        if n and left[0] and self.seen == (t[0], ids[0]):
            keep[0] = False
        li = np.flatnonzero(keep)
        lt, lid, b, f = t[li], ids[li], back[li], forth[li]
        known = b >= 0
        gap = np.where(known, lt - t[np.maximum(b, 0)], never)
        rid = np.where(known, ids[np.maximum(b, 0)], never)
        if self.right is not None:
            gap, rid = np.where(known, gap, lt - self.right[0]), np.where(known, rid, self.right[1])
        if nt is not None:
            out += self.flush(nt, nid)
        done = f < n
        if done.any():
            fn = f[done]
            out.append(self._choose(lt[done], lid[done], gap[done], rid[done], t[fn], ids[fn]))
        if (~done).any():
            self.waiting.append((lt[~done], lid[~done], gap[~done], rid[~done]))
        if n:
            self.settle(t[-1] - self.tol, out)
            last = np.flatnonzero(head)
            if len(last):
                self.right = (t[last[-1]], ids[last[-1]])
            lefts = np.flatnonzero(left)
            if len(lefts):
                self.seen = (t[lefts[-1]], ids[lefts[-1]])
        return out

    def batch(self, places, t, left, ids):
        out = []
        cut = np.zeros(len(t), dtype=bool)
        for p in places:
            cut[1:] |= p[1:] != p[:-1]
        begins = np.append(np.flatnonzero(cut), len(t))
        lo = 0
        for hi in begins:
            if hi > lo:
                here = tuple(p[lo] for p in places)
                if here != self.at:
                    out += self.flush()
                    self.at, self.right, self.seen = here, None, None
                out += self.piece(t[lo:hi], left[lo:hi], ids[lo:hi])
                lo = hi
        return out


def nearest_in_time(left: DataFrame, right: DataFrame, tolerance_us: int, slice_us: int | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """left(entity bigint, t_us bigint, id bigint), right likewise → (left_id, right_id, gap_us).

    Other columns are ignored. slice_us: length of a time slice, 40 tolerances if not given.
    """
    length = max(1, slice_us or 40 * max(1, tolerance_us))
    cols = [F.col(c).cast("bigint").alias(c) for c in ("entity", "t_us", "id")]
    whole = "entity is not null and t_us is not null and id is not null"
    at = lambda t: F.floor(t / length).cast("bigint")
    lefts = left.select(*cols).filter(whole).withColumn("slice", at(F.col("t_us")))
    rights = right.select(*cols).filter(whole).withColumn("slice", F.explode(F.sequence(at(F.col("t_us") - tolerance_us), at(F.col("t_us") + tolerance_us))))
    # slices above slice_rows: at most one for each slice_rows rows of the table
    hot = lefts.groupBy("entity", "slice").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows)
    hot = hot.select(F.col("entity").alias("_e"), F.col("slice").alias("_s"), F.ceil(F.col("n") / slice_rows).cast("int").alias("parts"))
    many = hot.count()
    if many:
        hot = F.broadcast(hot) if many <= BROADCAST_SLICES else hot
        same = (F.col("entity") == F.col("_e")) & (F.col("slice") == F.col("_s"))
        lefts = lefts.join(hot, same, "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int"))
        rights = rights.join(hot, same, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    else:
        lefts, rights = (df.withColumn("part", F.lit(0)) for df in (lefts, rights))
    names = ["entity", "slice", "part", "t_us", "left", "id"]
    both = lefts.withColumn("left", F.lit(True)).select(*names).union(rights.withColumn("left", F.lit(False)).select(*names))
    ordered = both.repartition("entity", "slice", "part").sortWithinPartitions(*names)
    schema = pa.schema([("left_id", pa.int64()), ("right_id", pa.int64()), ("gap_us", pa.int64())])

    def run(batches):
        merge = _Merge(tolerance_us)

        def give(found):
            if found:
                a, b, c = (np.concatenate([f[i] for f in found]) for i in range(3))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], schema=schema)

        for b in batches:
            if b.num_rows:
                arr = lambda n: b.column(n).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                yield from give(merge.batch([arr("entity"), arr("slice"), arr("part")], arr("t_us"), arr("left"), arr("id")))
        yield from give(merge.flush())

    return ordered.mapInArrow(run, "left_id bigint, right_id bigint, gap_us bigint")
