"""Text statistics of each document and how far they are from prose of its language.

One pass over the texts takes the statistics. The prose mean and covariance of each language are
estimated robustly over all documents: medians and median deviations first, then rounds that leave out
what lies beyond the chi-squared bound and take mean and covariance of the rest. The squared Mahalanobis
distance of a document splits into one part per statistic; the parts add up to it.

A document is of a kind (list, table, junk) when over half of its non-blank lines are. Lists, tables and most junk are told
by the shape of a line. What a line can't tell alone, as letters that hardly form words may be names or another language, is
doubtful: such lines are junk if the document's words are far from prose, by the distance over the statistics of words alone,
beyond the median that prose of the language has (chi squared of as many degrees); else they are no junk.

A document of a kind has a share over 0.5 in one statistic i, so its distance over all statistics is at least
(0.5 - mean_i)² / var_i; the bound for candidates is the least of these and the chi-squared bound, so no document of a kind is missed.

Null and empty texts have no lines and words: statistics 0, language 'und', no kind. The language is
read from the text, as the lang column may be wrong. Languages with fewer than `min_docs` documents, and
texts without function words, are held against the prose of all languages together.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelens.llm.lines import COMMON, line_counts
from pavelens.session import Scratch

#: Statistics, each with the least standard deviation that counts (so that a constant one can't dominate).
STATISTICS = {
    "log_words": 0.3, "mean_word_length": 0.5, "symbol_ratio": 0.03, "digit_ratio": 0.03, "upper_ratio": 0.03,
    "punctuated_lines": 0.1, "common_words": 0.05, "list_lines": 0.08, "table_lines": 0.08, "junk_lines": 0.08,
}
KINDS = {"list": "list_lines", "table": "table_lines", "junk": "junk_lines"}
#: Statistics of words and characters, which don't know the kinds of lines: the first ones of STATISTICS.
WORDS = 7
#: Median of chi squared with as many degrees of freedom (7).
CHI2_MEDIAN = 6.346
#: 0.975 quantile of chi squared with as many degrees of freedom as there are statistics (10).
CHI2_BOUND = 20.483
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_PUNCTUATED = re.compile(r"[.!?:;,][\"')\]]*[ \t]*(?=[\r\n]|\Z)")


def statistics_of(text: str | None) -> tuple:
    """(language, lines, words, *STATISTICS, share of doubtful lines, which are among the junk lines) of a text."""
    text = text or ""
    none, lists, tables, junk, doubtful = line_counts(text)
    lines = none + lists + tables + junk + doubtful
    tokens = text.lower().split()
    n = len(tokens)
    in_language = {k: sum(map(v.__contains__, tokens)) for k, v in COMMON.items()}
    language = max(in_language, key=in_language.get) if n and max(in_language.values()) else "und"
    raw = text.encode("utf-8", "replace")
    dense = len(raw.translate(None, b" \t\r\n\v\f"))
    share = lambda table: (len(raw) - len(raw.translate(None, table))) / dense if dense else 0.0
    per_line = lambda k: k / lines if lines else 0.0
    return (
        language, lines, n, float(np.log1p(n)), dense / n if n else 0.0, share(_SYMBOLS), share(b"0123456789"), share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        min(1.0, per_line(len(_PUNCTUATED.findall(text)))), max(in_language.values()) / n if n else 0.0, per_line(lists), per_line(tables), per_line(junk + doubtful), per_line(doubtful),
    )


_COLUMNS = ["id bigint", "language string", "n_lines bigint", "n_words bigint", *(f"{s} double" for s in STATISTICS), "doubtful_lines double"]
_NAMES = [c.split()[0] for c in _COLUMNS]


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, language, n_lines, n_words and the statistics."""

    def run(batches):
        for b in batches:
            rows = [statistics_of(t.as_py()) for t in b.column("text")]
            cols = list(zip(*rows)) or [[] for _ in _NAMES[1:]]
            kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.float64()] * (len(STATISTICS) + 1)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=_NAMES)

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, ", ".join(_COLUMNS))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([b.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS])


def _parts(x: np.ndarray, mean: np.ndarray, precision: np.ndarray) -> np.ndarray:
    d = x - mean
    return d * (d @ precision)


def prose_models(stats: DataFrame, min_docs: int = 200, rounds: int = 4) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean and covariance of prose by language, and of all together under ''. Every document takes part."""
    names, floor = list(STATISTICS), np.array(list(STATISTICS.values()))
    p = len(names)
    some = stats.filter("n_lines > 0")
    both = some.filter("language <> 'und'").withColumn("language", F.explode(F.array("language", F.lit(""))))
    mid = {r["language"]: r for r in both.groupBy("language").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(s, 0.5, 1000).alias(s) for s in names]).collect()}
    kept = {k: np.array([r[s] for s in names]) for k, r in mid.items() if k == "" or r["n"] >= min_docs}
    if not kept:
        return {"": (np.zeros(p), np.diag(floor**2))}
    spread = both.filter(F.col("language").isin(list(kept)))
    centre = {s: F.element_at(F.create_map(*[F.lit(v) for k in kept for v in (k, float(kept[k][i]))]), F.col("language")) for i, s in enumerate(names)}
    off = {r["language"]: r for r in spread.groupBy("language").agg(*[F.percentile_approx(F.abs(F.col(s) - centre[s]), 0.5, 1000).alias(s) for s in names]).collect()}
    models = {k: (kept[k], np.diag(np.maximum(1.4826 * np.array([off[k][s] for s in names]), floor) ** 2)) for k in kept}
    for _ in range(rounds):
        ready = {k: (m, np.linalg.inv(c)) for k, (m, c) in models.items()}

        def moments(batches, ready=ready):
            total = {k: np.zeros(1 + p + p * p) for k in ready}
            for b in batches:
                x, lang = _matrix(b), np.array(b.column("language").to_pylist(), dtype=object)
                for k, (mean, precision) in ready.items():
                    y = x if k == "" else x[lang == k]
                    y = y[_parts(y, mean, precision).sum(1) <= CHI2_BOUND] - mean
                    total[k] += np.concatenate([[len(y)], y.sum(0), (y.T @ y).ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(list(total), dtype=object), 1 + p + p * p), pa.string()), pa.array(np.tile(np.arange(1 + p + p * p), len(total)), pa.int32()), pa.array(np.concatenate(list(total.values())))],
                names=["language", "k", "v"],
            )

        found = some.filter("language <> 'und'").mapInArrow(moments, "language string, k int, v double").groupBy("language", "k").agg(F.sum("v").alias("v")).collect()
        sums = {k: np.zeros(1 + p + p * p) for k in ready}
        for r in found:
            sums[r["language"]][r["k"]] = r["v"]
        for k, v in sums.items():
            n = v[0]
            if n > p + 1:
                shift = v[1 : 1 + p] / n
                cov = v[1 + p :].reshape(p, p) / n - np.outer(shift, shift)
                models[k] = (models[k][0] + shift, cov + np.diag(floor**2))
    return models


def prose_distance(stats: DataFrame, models: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """stats with model, distance2, bound2 (what a candidate exceeds), words2 (distance of the words alone) and part_<statistic> of each statistic."""
    shares = [list(STATISTICS).index(s) for s in KINDS.values()]
    ready = {}
    for k, (m, c) in models.items():
        least = min(max(0.0, 0.5 - m[i]) ** 2 / c[i, i] for i in shares)
        ready[k] = (m, np.linalg.inv(c), np.linalg.inv(c[:WORDS, :WORDS]), min(CHI2_BOUND, 0.999 * least))
    out = [*_COLUMNS, "model string", "distance2 double", "bound2 double", "words2 double", *(f"part_{s} double" for s in STATISTICS)]
    names = [c.split()[0] for c in out]

    def run(batches):
        for b in batches:
            x = _matrix(b)
            model = np.array([k if k in ready else "" for k in b.column("language").to_pylist()], dtype=object)
            parts, bound, word = np.zeros_like(x), np.zeros(len(x)), np.zeros(len(x))
            for k in set(model):
                m, precision, of_words, least = ready[k]
                at = model == k
                parts[at], bound[at] = _parts(x[at], m, precision), least
                word[at] = _parts(x[at, :WORDS], m[:WORDS], of_words).sum(1)
            extra = [pa.array(model, pa.string()), pa.array(parts.sum(1)), pa.array(bound), pa.array(word), *(pa.array(parts[:, i].copy()) for i in range(x.shape[1]))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _NAMES), *extra], names=names)

    return stats.mapInArrow(run, ", ".join(out))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 200, scratch: Scratch | None = None) -> DataFrame:
    """Statistics, distance from prose and parts of every document, with outlier boolean and klass ('list', 'table', 'junk' or null)."""
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    stats = scratch.keep(text_statistics(docs, id_col, text_col), "statistics")
    far = prose_distance(stats, prose_models(stats, min_docs))
    # doubtful lines are junk where the words are far from prose
    share = {s: F.col(s) for s in KINDS.values()} | {"junk_lines": F.col("junk_lines") - F.when(F.col("words2") > CHI2_MEDIAN, 0.0).otherwise(F.col("doubtful_lines"))}
    klass = F.lit(None).cast("string")
    for k, s in KINDS.items():
        klass = F.when(share[s] > 0.5, k).otherwise(klass)
    far = far.withColumn("outlier", F.col("distance2") > F.col("bound2"))
    return far.withColumn("klass", F.when(F.col("outlier"), klass))
