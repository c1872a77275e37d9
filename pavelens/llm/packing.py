"""Texts packed into containers of a fixed number of tokens, whole unless longer than a container.

1. Every text is counted in tokens of a public tokenizer (once; the counts are written down). Longer
   texts are cut into pieces of the capacity and one rest.
2. The histogram of piece lengths, at most `capacity` numbers, goes to the driver. Non-negative least squares
   fits how often to repeat patterns of up to four lengths that nearly fill a container, so that together they use
   up the histogram. The patterns aren't listed beforehand, as there are billions: each round of the active set finds
   for every length the pattern along which the residual falls most. Repeats are rounded to what is there, what
   rounding leaves is fitted again, and the few pieces that are left then are packed longest first with the best fit.
3. The plan is a list of runs: the pieces of one length with ranks from..to go to consecutive
   containers. Each piece gets its rank within its length (counts per salt first, then ranks within a
   salt, so that a length that a third of all pieces have is spread) and finds its run by bisection.

Null and empty texts have no tokens: they make one piece of length 0 in container 0. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import math
import os

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pavelens.session import Scratch

#: Pieces of one length that one task ranks.
RANK_ROWS = 1_000_000
#: Times that the histogram is fitted, each time to what rounding left.
FITS = 3
#: Searches for patterns in one round of the fit.
PASSES = 6


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def load_encoder(path: str, pattern: str | None = None):
    import tiktoken

    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(id, n_tokens) of every text, whole. The tokenizer's file is read here and sent to the executors, which need tiktoken only."""
    import public_tokenizers

    spark, name, pattern = docs.sparkSession, os.path.basename(path), public_tokenizers.PATTERN
    spark.sparkContext.addFile(path)  # once for an application; adding it again does nothing

    def run(batches):
        enc = load_encoder(SparkFiles.get(name), pattern)
        for b in batches:
            texts = b.column("text")
            n = [len(enc.encode_ordinary(t.as_py())) if t.is_valid else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64())], names=["id", "n_tokens"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id bigint, n_tokens bigint")


def best_patterns(lengths: np.ndarray, gain: np.ndarray, capacity: int, waste: int, pieces: int = 4) -> list[tuple[float, tuple[int, ...]]]:
    """For each length that one exists for, the pattern with it of the highest total gain: up to `pieces` lengths that leave at most `waste` free.

    Exact: best[k][t] is the highest gain of up to k pieces of total length t, found for all t at once.
    """
    none = -1e300
    best, choice = [np.full(capacity + 1, none)], []
    best[0][0] = 0.0
    for _ in range(pieces - 1):
        last = best[-1]
        now, which = last.copy(), np.zeros(capacity + 1, np.int64)  # 0: no piece more
        for i, (L, g) in enumerate(zip(lengths.tolist(), gain.tolist())):
            more = last[: capacity + 1 - L] + g
            better = more > now[L:]
            now[L:][better] = more[better]
            which[L:][better] = i + 1
        best.append(now)
        choice.append(which)
    out = []
    for i, L in enumerate(lengths.tolist()):
        lo, hi = max(0, capacity - waste - L), capacity - L
        t = lo + int(np.argmax(best[-1][lo : hi + 1]))
        if best[-1][t] <= none / 2:
            continue
        value, pattern = gain[i] + best[-1][t], [L]
        for k in range(pieces - 2, -1, -1):
            j = choice[k][t]
            if j:
                pattern.append(int(lengths[j - 1]))
                t -= pattern[-1]
        out.append((float(value), tuple(sorted(pattern, reverse=True))))
    return out


def descend(g: np.ndarray, b: np.ndarray, x: np.ndarray, sweeps: int) -> np.ndarray:
    """x >= 0 that makes x G x / 2 - b x smaller: one repeat after another set to its best value, `sweeps` times over."""
    x, slack, diagonal = x.copy(), b - g @ x, np.diag(g).tolist()
    for _ in range(sweeps):
        moved = 0.0
        for j, d in enumerate(diagonal):
            step = slack[j] / d
            if step < -x[j]:
                step = -x[j]
            if step > 1e-9 or step < -1e-9:
                x[j] += step
                slack -= step * g[j]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return x


def fit_patterns(lengths: np.ndarray, h: np.ndarray, capacity: int, waste: int, rounds: int = 40, sweeps: int = 6, enough: float = 0.02) -> tuple[list[dict[int, int]], np.ndarray, float]:
    """Patterns and their repeats x >= 0 that make |A x - h| small (non-negative least squares), and the residual over |h|.

    Only columns with a positive repeat are kept. Each round adds the patterns along which the residual falls most (they are
    found, not listed beforehand) and goes on with the descent from where it was, so the residual never grows.
    """
    index = {int(L): i for i, L in enumerate(lengths)}
    patterns: list[dict[int, int]] = []
    a, x = np.zeros((len(h), 0)), np.zeros(0)
    g, b = np.zeros((0, 0)), np.zeros(0)
    size, left = np.linalg.norm(h), 1.0
    for _ in range(rounds):
        r = h - a @ x
        left = float(np.linalg.norm(r) / size)
        if left < enough:
            break
        known = {tuple(sorted(p.items())) for p in patterns}
        new, gain = [], r.copy()
        for _ in range(PASSES):  # lengths that were used stand back, so that one round adds patterns for most lengths
            used = np.zeros(len(h), bool)
            for value, pattern in sorted(best_patterns(lengths, gain, capacity, waste), reverse=True):
                p = {L: pattern.count(L) for L in pattern}
                rows = [index[L] for L in p]
                key = tuple(sorted(p.items()))
                if r[rows] @ list(p.values()) > 1e-6 * size and not used[rows].any() and key not in known:
                    used[rows] = True
                    known.add(key)
                    new.append(p)
            gain[used] = np.minimum(gain[used], 0.0)
        if not new:
            break
        more = np.zeros((len(h), len(new)))
        for k, p in enumerate(new):
            for L, times in p.items():
                more[index[L], k] = times
        cross = a.T @ more
        g = np.block([[g, cross], [cross.T, more.T @ more]])
        a, b, patterns, x = np.hstack([a, more]), np.concatenate([b, more.T @ h]), patterns + new, np.concatenate([x, np.zeros(len(new))])
        x = descend(g, b, x, sweeps)
        keep = x > 1e-9
        a, b, g, x, patterns = a[:, keep], b[keep], g[np.ix_(keep, keep)], x[keep], [p for p, k in zip(patterns, keep) if k]
    return patterns, x, float(np.linalg.norm(h - a @ x) / size)


def plan_containers(histogram: dict[int, int], capacity: int, waste_share: float = 0.0005, report: dict | None = None) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[(pattern as ((length, how many), …), repeats)] that uses every piece of the histogram once.

    report, if given, gets the residual of the fit, how many pieces it placed and how many there are.
    """
    left = {L: n for L, n in histogram.items() if 0 < L <= capacity and n > 0}
    plan: list[tuple[tuple[tuple[int, int], ...], int]] = []
    whole = sum(left.values())

    def take(pattern: dict[int, int], repeats: int) -> None:
        if repeats > 0:
            plan.append((tuple(sorted(pattern.items(), reverse=True)), repeats))
            for L, k in pattern.items():
                left[L] -= k * repeats
                if not left[L]:
                    del left[L]

    if capacity in left:
        take({capacity: 1}, left[capacity])
    residuals = []
    for _ in range(FITS):  # what rounding leaves is fitted again
        lengths = np.array(sorted(left))
        if not len(lengths):
            break
        patterns, x, residual = fit_patterns(lengths, np.array([left[int(L)] for L in lengths], dtype=float), capacity, int(capacity * waste_share))
        residuals.append(residual)
        before = sum(left.values())
        for i in np.argsort(-x, kind="stable"):
            if x[i] >= 0.5:
                take(patterns[i], min(int(round(x[i])), min(left.get(L, 0) // k for L, k in patterns[i].items())))
        if before - sum(left.values()) < 0.05 * before:
            break
    if report is not None:
        report |= {"residual": residuals[0] if residuals else 0.0, "placed": whole - sum(left.values()), "pieces": whole}
    while left:  # the rest: longest first, best fit, as often as it fits again
        present = np.array(sorted(left))
        pattern, space = {}, capacity
        while True:
            i = np.searchsorted(present, space, side="right") - 1
            while i >= 0 and left[int(present[i])] - pattern.get(int(present[i]), 0) <= 0:
                i -= 1
            if i < 0:
                break
            L = int(present[i])
            k = min(space // L, left[L] - pattern.get(L, 0))
            pattern[L] = pattern.get(L, 0) + k
            space -= k * L
        take(pattern, min(left[L] // k for L, k in pattern.items()))
    return plan


def _runs(plan, capacity: int) -> dict[str, np.ndarray]:
    """The plan by length: pieces with rank first, first + 1, … of a length, `per` to a container, from container `base` on."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for pattern, repeats in plan:
        at = 0
        for L, k in pattern:
            rows.append((L, used.get(L, 0), k, base, at))
            used[L] = used.get(L, 0) + k * repeats
            at += L * k
        base += repeats
    rows.sort()
    a = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {"length": a[:, 0], "first": a[:, 1], "per": a[:, 2], "base": a[:, 3], "at": a[:, 4]}


def pack(docs: DataFrame, id_col: str, text_col: str, capacity: int = 2048, path: str | None = None, rank_rows: int = RANK_ROWS) -> DataFrame:
    """docs → (id, piece, token_start, n_tokens, container_id, container_offset), one row per piece."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    counted = scratch.keep(token_counts(docs, id_col, text_col, path or tokenizer_path()), "counts")
    pieces = counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.call_function("div", F.col("n_tokens") - 1, F.lit(capacity).cast("bigint"))))))
    pieces = pieces.select("id", "piece", (F.col("piece") * capacity).alias("token_start"), F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece") * capacity).alias("n_tokens"))
    # at most capacity + 1 rows
    histogram = {r["n_tokens"]: r["n"] for r in pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = _runs(plan_containers(histogram, capacity), capacity)
    salts = max(1, math.ceil(max(histogram.values(), default=0) / rank_rows))
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)).cast("int"))
    before = F.sum("n").over(W.partitionBy("n_tokens").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    offsets = pieces.groupBy("n_tokens", "salt").agg(F.count(F.lit(1)).alias("n")).select("n_tokens", "salt", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(W.partitionBy("n_tokens", "salt").orderBy("id", "piece"))
    ranked = pieces.withColumn("rank", within).join(offsets, ["n_tokens", "salt"]).select("id", "piece", "token_start", "n_tokens", (F.col("offset") + F.col("rank") - 1).alias("rank"))
    shared = spark.sparkContext.broadcast(runs)  # a run per length of each pattern: bounded by the patterns, not by the pieces

    def place(batches):
        r = shared.value
        begin = np.searchsorted(r["length"], np.arange(capacity + 2))
        for b in batches:
            L, rank = b.column("n_tokens").to_numpy(), b.column("rank").to_numpy()
            container, offset = np.zeros(len(L), np.int64), np.zeros(len(L), np.int64)
            for each in np.unique(L):
                lo, hi = begin[each], begin[each + 1]
                if each == 0 or lo == hi:
                    continue
                at = np.flatnonzero(L == each)
                k = lo + np.searchsorted(r["first"][lo:hi], rank[at], side="right") - 1
                d = rank[at] - r["first"][k]
                container[at] = r["base"][k] + d // r["per"][k]
                offset[at] = r["at"][k] + each * (d % r["per"][k])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "piece", "token_start", "n_tokens")), pa.array(container), pa.array(offset)], names=["id", "piece", "token_start", "n_tokens", "container_id", "container_offset"])

    return ranked.mapInArrow(place, "id bigint, piece bigint, token_start bigint, n_tokens bigint, container_id bigint, container_offset bigint")


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """(containers, tokens, fill, least): how many containers there are and how many any packing needs."""
    each = packed.filter("n_tokens > 0").groupBy("container_id").agg(F.sum("n_tokens").alias("t"))
    total = each.agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"), F.coalesce(F.max("t"), F.lit(0)).alias("fullest"))
    return total.select("containers", "tokens", "fullest", F.try_divide("tokens", F.col("containers") * capacity).alias("fill"), F.ceil(F.col("tokens") / capacity).cast("bigint").alias("least"))
