"""Measures normalised to 1..5, weighted to partial and overall values, and put into classes.

Missing measures stay missing: a null makes what is computed from it null, except that the overall value
falls back to the substance value where there is no evenness value. Classes of missing values are 0 for
substance measures and null for evenness measures. NaN counts as null. Values are rounded to two digits
before they are weighted and put into classes, ties of the binary value to the even digit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelens.functions.scalars import max_known, nan_to_null, round_exact

EVENNESS = ("SM4L_M", "SM4L_A", "MSPT", "MSPH")
SUBSTANCE = ("RISS", "AFLI", "OFS")


@dataclass(frozen=True)
class Weights:
    """Shares of the partial values. evenness: of SM4L, MSPT, MSPH (paved areas: paved_evenness if given); substance: of RISS, AFLI, OFS."""

    evenness: dict = field(default_factory=lambda: {"SM4L": 0.25, "MSPT": 0.5, "MSPH": 0.25})
    substance: dict = field(default_factory=lambda: {"RISS": 0.56, "AFLI": 0.31, "OFS": 0.13})
    veto: float = 3.5
    paved_evenness: dict | None = None


def normalise(x: Column, f1: Column, f2: Column, f3: Column) -> Column:
    """1 at 0, 1.5 at f1, 3.5 at f2, 4.5 at f3, 5 from 1.5 f3 - 0.5 f2 on, straight in between."""
    end = F.lit(1.5) * f3 - F.lit(0.5) * f2
    return (
        F.when(x < f1, F.lit(1.0) + F.lit(0.5) * x / f1)
        .when(x <= f2, F.lit(1.5) + F.lit(2.0) * (x - f1) / (f2 - f1))
        .when(x <= f3, F.lit(3.5) + (x - f2) / (f3 - f2))
        .when(x <= end, F.lit(4.5) + F.lit(0.5) * (x - f3) / (end - f3))
        .when(x > end, F.lit(5.0))
    )


def quantise(v: Column) -> Column:
    return F.when(v.isNull(), 0).when(v <= 1.5, 1).when(v <= 3.5, 2).when(v <= 4.5, 3).otherwise(4)


def _partial(worst: Column, weighted: Column, veto: float) -> Column:
    return F.when(worst > veto, worst).otherwise(weighted)


def factor_table(factors: DataFrame) -> DataFrame:
    """factors(bw, metric, fk, f1, f2, f3) as one row per (bw, fk) with a struct per metric."""
    picks = [F.max(F.when(F.col("metric") == m, F.struct("f1", "f2", "f3"))).alias(f"_{m}") for m in (*EVENNESS, *SUBSTANCE)]
    return factors.groupBy("bw", "fk").agg(*picks)


def rate(areas: DataFrame, factors: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """areas(area_id, bw, fk, lower-case measures) with ZW*, TWGEB, TWSUB, GW, ZK*, TKGEB, TKSUB, GK.

    One narrow pass after a join with the factors (a row per bw and fk). Paved areas (bw P) have no RISS
    and AFLI: their substance value is ZWOFS. Measures without a factor, as evenness for fk N, are null.
    """
    df = areas.join(factor_table(factors).withColumnsRenamed({"bw": "_bw", "fk": "_fk"}), (F.col("bw") == F.col("_bw")) & (F.col("fk") == F.col("_fk")), "left")
    raw = {}
    for m in (*EVENNESS, *SUBSTANCE):
        f = F.col(f"_{m}")
        x = nan_to_null(F.col(m.lower()))
        if m in ("RISS", "AFLI"):
            x = F.when(F.col("bw") == "A", x)
        if m in EVENNESS:
            x = F.when(F.col("fk") != "N", x)
        raw[f"_z{m}"] = normalise(x, f["f1"], f["f2"], f["f3"])
    # values before they are rounded are columns of their own, as rounding names them several times
    df = df.withColumns(raw).withColumns({f"ZW{m}": round_exact(F.col(f"_z{m}")) for m in (*EVENNESS, *SUBSTANCE)})
    df = df.withColumn("ZWSM4L", max_known(F.col("ZWSM4L_M"), F.col("ZWSM4L_A")))
    sm, mt, mh, ri, af, of = (F.col(f"ZW{m}") for m in ("SM4L", "MSPT", "MSPH", "RISS", "AFLI", "OFS"))
    paved = F.col("bw") == "P"
    even = _partial(max_known(sm, mt), _by_bw(weights, "evenness", "SM4L") * sm + _by_bw(weights, "evenness", "MSPT") * mt + _by_bw(weights, "evenness", "MSPH") * mh, weights.veto)
    ws = weights.substance
    asphalt = _partial(max_known(ri, of), F.lit(ws["RISS"]) * ri + F.lit(ws["AFLI"]) * af + F.lit(ws["OFS"]) * of, weights.veto)
    df = df.withColumns({"_even": even, "_sub": F.when(paved, of).otherwise(asphalt)})
    df = df.withColumns({"TWGEB": round_exact(F.col("_even")), "TWSUB": round_exact(F.col("_sub"))})
    df = df.withColumn("GW", max_known(F.coalesce("TWGEB", "TWSUB"), F.col("TWSUB")))
    zk = {m: quantise(F.col(f"ZW{m}")) for m in (*EVENNESS, "SM4L", *SUBSTANCE)}
    classes = {f"ZK{m}": F.when(c > 0, c) if m in (*EVENNESS, "SM4L") else c for m, c in zk.items()}
    classes |= {"TKGEB": F.when(F.col("TWGEB").isNotNull(), quantise(F.col("TWGEB"))), "TKSUB": quantise(F.col("TWSUB")), "GK": quantise(F.col("GW"))}
    helpers = [f"_{k}{m}" for k in ("", "z") for m in (*EVENNESS, *SUBSTANCE)]
    return df.withColumns(classes).drop("_bw", "_fk", "_even", "_sub", *helpers)


def _by_bw(weights: Weights, of: str, part: str) -> Column:
    """A weight of the evenness value, which paved areas may have their own of."""
    own = weights.paved_evenness or weights.evenness
    return F.when(F.col("bw") == "P", F.lit(float(own[part]))).otherwise(F.lit(float(getattr(weights, of)[part])))


def rerate(rated: DataFrame, factors: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Rate a rated table again with other factors or weights; what was derived before is replaced."""
    old = [c for c in rated.columns if c.startswith(("ZW", "ZK", "TW", "TK")) or c in ("GW", "GK")]
    return rate(rated.drop(*old), factors, weights)
