"""Exact percentiles per group over very many values, by bisection of value intervals.

State: per group, metric and percentile an interval that holds the wanted value and the number of
values below it. A pass counts the values between the midpoints of `levels` successive bisections
(2 ** levels - 1 midpoints, so one read does the work of `levels` passes) and keeps the part that holds
the wanted rank, cut to the values that are there. The smallest and the largest value of an interval
fall into different parts, so every pass narrows and the search ends. An interval is settled when it
holds one value, when the wanted rank is its first or last, or when it holds at most
`max_rank_error` of the group's values; the error is reported and 0 means exact.

What a pass reads are rows as they come (`value_rows`) or counts per value (`value_counts`); only counts per interval are
shuffled. Counts of separate days or partitions add up (`merge_counts`), and percentiles of the merged counts are those of all
rows together.

Values that are null, NaN or outside the valid range don't count. Groups may have null keys. Groups
without a valid value don't appear. An empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pavelens.session import Scratch

#: States are broadcast up to this many rows (each under 200 bytes); beyond it the join is a shuffle of the counts per value,
#: with salts for groups of more than SALT_ROWS values (or a ten-thousandth of all, if that is more).
BROADCAST_STATES = 40_000
SALT_ROWS = 1_000_000


def value_rows(df: DataFrame, groups: list[str], metrics: dict[str, Column], low: float, high: float) -> DataFrame:
    """Every valid value with its group and metric, and n = 1. metrics: name → value column (null where it doesn't apply)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in metrics.items()])
    valid = F.filter(pairs, lambda s: s["value"].isNotNull() & ~F.isnan(s["value"]) & s["value"].between(low, high))
    # 0.0 and -0.0 are one value
    long = df.select(*groups, F.explode(valid).alias("_s")).select(*groups, "_s.metric", (F.col("_s.value") + F.lit(0.0)).alias("value"))
    return long.withColumn("n", F.lit(1).cast("bigint"))


def value_counts(df: DataFrame, groups: list[str], metrics: dict[str, Column], low: float, high: float) -> DataFrame:
    """Counts per group, metric and valid value, to be kept and merged with those of other days; they take a shuffle of all values."""
    return value_rows(df, groups, metrics, low, high).groupBy(*groups, "metric", "value").agg(F.sum("n").alias("n"))


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Counts of several days or partitions as one."""
    keys = [c for c in counts[0].columns if c != "n"]
    return reduce(DataFrame.unionByName, counts).groupBy(*keys).agg(F.sum("n").alias("n"))


def _rank(p: float, n: Column) -> Column:
    """The smallest rank with at least the share p at or below it, in whole numbers; 1 for p = 0."""
    f = Fraction(str(p))
    return F.greatest(F.lit(1).cast("bigint"), F.call_function("div", n * f.numerator + (f.denominator - 1), F.lit(f.denominator).cast("bigint")))


def _part(value: Column, lo: Column, hi: Column, levels: int) -> Column:
    parts = 1 << levels
    at = F.when(hi > lo, F.floor((value - lo) / (hi - lo) * parts)).otherwise(0)
    return F.greatest(F.lit(0), F.least(at.cast("int"), F.lit(parts - 1)))


def _narrow(parts: DataFrame, keys: list[str], max_rank_error: float) -> DataFrame:
    """parts(keys, total, rank, below, part, n, mn, mx) → the part with the wanted rank as the new interval."""
    upto = F.sum("n").over(W.partitionBy(*keys).orderBy("part").rowsBetween(W.unboundedPreceding, 0))
    at = parts.withColumn("_upto", F.col("below") + upto).filter((F.col("_upto") >= F.col("rank")) & (F.col("_upto") - F.col("n") < F.col("rank")))
    at = at.withColumn("_first", F.col("_upto") - F.col("n") + 1)
    few = (F.col("n") <= F.col("total") * F.lit(max_rank_error)) & F.lit(max_rank_error > 0)
    value = F.when((F.col("mn") == F.col("mx")) | (F.col("rank") == F.col("_first")), F.col("mn")).when(F.col("rank") == F.col("_upto"), F.col("mx")).when(few, F.col("mn"))
    exact = (F.col("mn") == F.col("mx")) | (F.col("rank") == F.col("_first")) | (F.col("rank") == F.col("_upto"))
    error = F.when(exact, F.lit(0.0)).otherwise((F.col("rank") - F.col("_first")) / F.col("total"))
    return at.select(*keys, "total", "rank", (F.col("_first") - 1).alias("below"), F.col("mn").alias("lo"), F.col("mx").alias("hi"), value.alias("value"), error.alias("rank_error"))


def _salted(counts: DataFrame, states: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Counts with _slot and states with _salt, so that a large group's values lie in as many slots as it needs."""
    rows = counts.groupBy(*keys, "value").agg(F.sum("n").alias("n"))  # so that one value is one row
    per = F.lit(max(SALT_ROWS, (counts.agg(F.sum("n")).first()[0] or 0) // 10_000))
    salts = F.ceil(F.col("total") / per).cast("int")
    # groups above a ten-thousandth of all values: at most 10,000
    large = states.filter(F.col("total") > per).select(*[F.col(f"_{k}").alias(f"_l_{k}") for k in keys], salts.alias("_n")).distinct()
    rows = rows.join(F.broadcast(large), reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in keys]), "left")
    rows = rows.withColumn("_slot", F.pmod(F.xxhash64("value"), F.coalesce("_n", F.lit(1))).cast("int")).drop("_n", *[f"_l_{k}" for k in keys])
    return rows, states.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), salts) - 1)))


def percentiles_of_counts(counts: DataFrame, groups: list[str], wanted: dict[str, list[float]], levels: int = 8, max_rank_error: float = 0.0, low: float | None = None, high: float | None = None, scratch: Scratch | None = None) -> DataFrame:
    """counts(groups, metric, value, n) → groups, metric, p, n_valid, value, rank_error."""
    spark = counts.sparkSession
    scratch = scratch or Scratch(spark, "percentiles")
    counts = scratch.keep(counts.filter(F.col("metric").isin(list(wanted))), "counts")
    if low is None or high is None:
        low, high = counts.agg(F.min("value"), F.max("value")).first()
        low, high = low or 0.0, high or 0.0
    keys = [*groups, "metric", "p"]
    first = counts.withColumn("part", _part(F.col("value"), F.lit(float(low)), F.lit(float(high)), levels))
    first = first.groupBy(*groups, "metric", "part").agg(F.sum("n").alias("n"), F.min("value").alias("mn"), F.max("value").alias("mx"))
    first = first.withColumn("total", F.sum("n").over(W.partitionBy(*groups, "metric")))  # at most 2 ** levels rows a group
    ps = F.lit(None).cast("array<struct<p:double,rank:bigint>>")
    for m, each in wanted.items():
        ps = F.when(F.col("metric") == m, F.array(*[F.struct(F.lit(float(p)).alias("p"), _rank(p, F.col("total")).alias("rank")) for p in each])).otherwise(ps)
    first = first.withColumn("_p", F.explode(ps)).select(*groups, "metric", "_p.p", "_p.rank", "total", F.lit(0).cast("bigint").alias("below"), "part", "n", "mn", "mx")
    state = scratch.keep(_narrow(first, keys, max_rank_error), "state-0")
    settled, k = [state.filter(F.col("value").isNotNull())], 0
    while True:
        active = state.filter(F.col("value").isNull())
        open_ = active.count()
        if not open_:
            break
        k += 1
        same = [F.col(f"_{g}").eqNullSafe(F.col(g)) for g in [*groups, "metric"]]
        s = active.select(*[F.col(g).alias(f"_{g}") for g in [*groups, "metric"]], "p", "total", "rank", "below", "lo", "hi")
        rows = counts
        if open_ <= BROADCAST_STATES:
            s = F.broadcast(s)
        else:
            rows, s = _salted(counts, s, [*groups, "metric"])
            same.append(F.col("_salt") == F.col("_slot"))
        hit = rows.join(s, reduce(Column.__and__, [*same, F.col("value").between(F.col("lo"), F.col("hi"))]))
        hit = hit.withColumn("part", _part(F.col("value"), F.col("lo"), F.col("hi"), levels))
        hit = hit.groupBy(*keys, "total", "rank", "below", "part").agg(F.sum("n").alias("n"), F.min("value").alias("mn"), F.max("value").alias("mx"))
        state = scratch.keep(_narrow(hit, keys, max_rank_error), f"state-{k}")
        settled.append(state.filter(F.col("value").isNotNull()))
    return reduce(DataFrame.unionByName, settled).select(*groups, "metric", "p", F.col("total").alias("n_valid"), "value", "rank_error")
