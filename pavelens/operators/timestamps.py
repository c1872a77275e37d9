"""Mixed timestamp formats and zones normalised to one UTC instant.

Every text is read in every way that a catalogue of formats allows: dotted and slashed dates in both orders, wall
times without a zone in the local zone and in UTC, plain numbers in every unit. What is stated about the data (day
first, local zone, years) enters as a prior weight of the readings: 1 for a stated one, `rival` for one against it, and
`noise`, in between, for the text meaning nothing at all. An expectation-maximisation per source learns how often the
source writes each format, from the counts of each set of readings; the posterior of each reading is its format's share
times its weight, over all readings. The best reading is taken if its posterior reaches `min_posterior`.

So an order of the date that nothing is stated about is settled by the source's other texts, a text that only reads
against what is stated means nothing, and wall times that occur twice have two readings of one format and weight,
which share their posterior: no evidence can tell them apart, and they stay ambiguous. Wall times that never occur
have no local reading.

Status: 'resolved'; 'ambiguous' if no reading is sure; 'unparsable' for nulls, texts without a reading and those that
most likely mean nothing. Extra columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavelens.session import Scratch

# Zone names with a constant offset in minutes.
ZONE_MINUTES = {"Z": 0, "UTC": 0, "GMT": 0, "MEZ": 60, "CET": 60, "MESZ": 120, "CEST": 120}
# English month abbreviations.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
# Unix time units, microseconds of one unit as (multiply, divide).
UNITS = {"unix_s": (1_000_000, 1), "unix_ms": (1_000, 1), "unix_us": (1, 1), "unix_ns": (1, 1_000)}

_ZONE = r"\s*(Z|UTC|GMT|MESZ|MEZ|CEST|CET|(?:UTC|GMT)?[+-]\d{2}(?::?\d{2})?)?\s*(?:\[([A-Z0-9_+/\-]+)\])?$"
_TIME = r"(\d{1,2}):(\d{2}):(\d{2})(?:[.,](\d+))?\s*(AM|PM)?"
# Blanks and quotes that mean nothing at either end of a text.
EDGE = " \t\r\n\v\f\u00a0\u2007\u202f\ufeff\"'`“”„‘’‚«»"


#: Years in which plain numbers are read at all.
WIDE_YEARS = (1971, 2100)
#: Posteriors of sets of readings are broadcast up to this many rows (under 400 bytes each); beyond it they are joined by a shuffle.
BROADCAST_POSTERIORS = 20_000


@dataclass(frozen=True)
class TimestampRules:
    """local_zone: of texts without a zone. day_first: order of dates by separator, None where the
    source is to be asked (both orders then weigh 1). Years bound what a plain number is stated to mean.
    rival, noise: prior weights of a reading against a stated rule and of no meaning at all. noise is below any share that a
    format can have in a source of 10^10 texts, so it never competes with a stated reading; rival is as far below noise."""

    local_zone: str = "Europe/Berlin"
    day_first: dict = field(default_factory=lambda: {".": True, "/": False})
    named_zones: tuple = ("Europe/Berlin",)
    first_year: int = 2021
    last_year: int = 2027
    min_posterior: float = 0.95
    em_rounds: int = 50
    rival: float = 1e-24
    noise: float = 1e-12


def _shows(us: Column, zone: str):
    """Whether clocks in the zone show the wall time us at an instant."""
    return lambda u: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(u), zone)) == us


def _formats() -> list[tuple[str, str, str]]:
    """(name, pattern, the replacement that lists year, month, day, hour, minute, second, fraction, AM/PM, zone, bracket); dotted and slashed dates as day first."""
    time = "|".join(f"${i}" for i in range(4, 11))
    out = [
        ("iso", rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_TIME}{_ZONE}", f"$1|$2|$3|{time}"),
        ("basic", rf"^(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})(\d{{2}})(?:[.,](\d+))?{_ZONE}", "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
        ("mail", rf"^(?:[A-Z]{{3}},?\s+)?(\d{{1,2}})\s+([A-Z]{{3}})\s+(\d{{4}})\s+{_TIME}{_ZONE}", f"$3|$2|$1|{time}"),
    ]
    return out + [(name, rf"^(\d{{1,2}})\{sep}(\d{{1,2}})\{sep}(\d{{4}})[ T,]\s*{_TIME}{_ZONE}", f"$3|$2|$1|{time}") for sep, name in ((".", "dotted"), ("/", "slashed"))]


_READINGS = "array<struct<fmt:string,w:double,us:bigint>>"


def _calendar_readings(df: DataFrame, tag: str, swapped: bool, rules: TimestampRules) -> DataFrame:
    """Add _hits{tag} from _fmt and _parts; swapped: day and month of dotted and slashed dates change places. Each step is a column of its own, so that nothing is computed twice."""
    us, zone, named = (f"_{x}{tag}" for x in ("us", "zone", "named"))
    none = F.array().cast("array<bigint>")
    fmt, either = F.col("_fmt"), F.col("_fmt").isin("dotted", "slashed")
    part = lambda i: F.get(F.col("_parts"), F.lit(i))
    two = lambda c: F.lpad(c, 2, "0")
    month = F.when(fmt == "mail", F.array_position(F.array(*map(F.lit, MONTHS)), part(1)).cast("string")).otherwise(part(2 if swapped else 1))
    half, h = part(7), part(3).try_cast("int")
    hour = F.when(half == "", h).when(h.between(1, 12), F.pmod(h, F.lit(12)) + F.when(half == "PM", 12).otherwise(0))
    wall = F.concat(part(0), F.lit("-"), two(month), F.lit("-"), two(part(1 if swapped else 2)), F.lit(" "), two(hour.cast("string")), F.lit(":"), part(4), F.lit(":"), part(5), F.lit("Z"))
    df = df.withColumn(f"_wall{tag}", F.when(either, wall) if swapped else wall)
    wall = F.col(f"_wall{tag}")
    df = df.withColumn(us, F.when(F.length(wall) == 20, F.unix_micros(wall.try_cast("timestamp")) + F.rpad(F.substring(part(6), 1, 6), 6, "0").try_cast("bigint")))
    df = df.withColumn(zone, F.when(F.col(us).isNotNull(), part(8))).withColumn(named, part(9)).withColumn(f"_digits{tag}", F.regexp_extract(zone, r"[+-]\d{2}:?\d{0,2}$", 0))
    digits = F.col(f"_digits{tag}")
    hh, mm = F.substring(digits, 2, 2).try_cast("int"), F.coalesce(F.regexp_extract(digits, r"(\d{2}):?(\d{2})$", 2).try_cast("int"), F.lit(0))
    constant = F.lit(None).cast("int")
    for z, minutes in ZONE_MINUTES.items():
        constant = F.when(F.col(zone) == z, minutes).otherwise(constant)
    numeric = F.when((hh <= 18) & (mm < 60), F.when(digits.startswith("-"), -1).otherwise(1) * (hh * 60 + mm))
    df = df.withColumn(f"_minutes{tag}", F.when(digits != "", numeric).otherwise(constant))
    t = F.col(us)
    local = F.when(F.col(named).isin("UTC", "Z", "GMT", "ETC/UTC"), F.array(t))
    for k, z in enumerate(dict.fromkeys([rules.local_zone, *rules.named_zones])):
        asked = (F.col(named) == z.upper()) | ((F.col(named) == "") & F.lit(z == rules.local_zone))
        df = df.withColumn(f"_guess{k}{tag}", F.when((F.col(zone) == "") & asked, F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(t), z))))
        near = F.array(*[F.col(f"_guess{k}{tag}") + m * 60_000_000 for m in (-60, -30, 0, 30, 60)])
        local = local.when(asked, F.filter(near, _shows(t, z)))
    found = F.when(t.isNull(), none).when(F.col(zone) != "", F.array(t - F.col(f"_minutes{tag}").cast("bigint") * 60_000_000)).otherwise(F.coalesce(local, none))
    df = df.withColumn(f"_found{tag}", found)
    order = F.lit("_mdy" if swapped else "_dmy")
    name = F.when(either, F.concat(fmt, order)).otherwise(fmt)
    weight = F.lit(1.0)
    for sep, kind in ((".", "dotted"), ("/", "slashed")):
        rule = rules.day_first.get(sep)
        if rule is not None and rule == swapped:
            weight = F.when(fmt == kind, F.lit(rules.rival)).otherwise(weight)
    df = df.withColumn(f"_name{tag}", name).withColumn(f"_w{tag}", weight)
    name, weight = F.col(f"_name{tag}"), F.col(f"_w{tag}")
    hits = F.transform(F.filter(f"_found{tag}", lambda u: u.isNotNull()), lambda u: F.struct(name.alias("fmt"), weight.alias("w"), u.alias("us")))
    # a wall time without a zone, taken as UTC against the rule
    utc = F.when((F.col(zone) == "") & (F.col(named) == "") & t.isNotNull(), F.array(F.struct(F.concat(name, F.lit("_utc")).alias("fmt"), F.lit(rules.rival).alias("w"), t.alias("us"))))
    none = F.array().cast(_READINGS)
    return df.withColumn(f"_hits{tag}", F.concat(F.coalesce(hits, none), F.coalesce(utc, none)))


def with_readings(df: DataFrame, clean: Column, rules: TimestampRules) -> DataFrame:
    """df with _readings: array of struct(fmt, w, us), one per format and instant that the text can mean, w its prior weight."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    df = df.withColumn("_text", clean)
    text = F.col("_text")
    kind, split = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    for name, pattern, order in reversed(_formats()):
        kind = F.when(text.rlike(pattern), name).otherwise(kind)
        split = F.when(F.col("_fmt") == name, F.split(F.regexp_replace(text, pattern, order), r"\|", -1)).otherwise(split)
    df = df.withColumn("_fmt", kind).withColumn("_parts", split)
    df = _calendar_readings(_calendar_readings(df, "1", False, rules), "2", True, rules)
    at = lambda y: int(pd.Timestamp(year=y, month=1, day=1).value // 1000)
    lo, hi, low, high = at(rules.first_year), at(rules.last_year + 1), at(WIDE_YEARS[0]), at(WIDE_YEARS[1])
    plain, none = r"^(\d{1,19})(?:\.(\d+))?$", F.array().cast(_READINGS)
    df = df.withColumn("_number", F.when(text.rlike(plain), F.split("_text", r"\.")))
    df = df.withColumn("_whole", F.get("_number", F.lit(0)).try_cast("bigint"))
    df = df.withColumn("_below", F.coalesce(F.rpad(F.substring(F.get("_number", F.lit(1)), 1, 6), 6, "0").try_cast("bigint"), F.lit(0).cast("bigint")))
    units = []
    for name, (times, over) in UNITS.items():
        whole, below = F.col("_whole"), F.col("_below")
        us = F.call_function("div", whole, F.lit(over).cast("bigint")) if over > 1 else F.try_multiply(whole, F.lit(times).cast("bigint"))
        us = F.try_add(us, F.call_function("div", below * times, F.lit(1_000_000 * over).cast("bigint")))
        weight = F.when(us.between(lo, hi - 1), F.lit(1.0)).otherwise(F.lit(rules.rival))
        units.append(F.struct(F.lit(name).alias("fmt"), weight.alias("w"), F.when(us.between(low, high - 1), us).alias("us")))
    df = df.withColumn("_numbers", F.when(F.col("_whole").isNull(), none).otherwise(F.filter(F.array(*units), lambda c: c["us"].isNotNull())))
    return df.select(*keep, F.concat("_hits1", "_hits2", "_numbers").alias("_readings"))


def posteriors(pdf: pd.DataFrame, rounds: int, noise_weight: float) -> pd.DataFrame:
    """(source, readings, n) → one row each with the posterior of every format in the set and of no meaning; all sources of pdf at once.

    readings: 'fmt=weight' joined by '|', several instants of one format several times; their posterior is shared.
    """
    sources, of = np.unique(pdf["source"].to_numpy(str), return_inverse=True)
    n = pdf["n"].to_numpy(float)
    row, name, weight, times = [], [], [], []
    for i, text in enumerate(pdf["readings"]):
        each: dict[str, int] = {}
        for r in text.split("|"):
            each[r] = each.get(r, 0) + 1
        for r, k in each.items():
            fmt, w = r.rsplit("=", 1)
            row.append(i)
            name.append(fmt)
            weight.append(float(w))
            times.append(k)
    row, weight, times = np.array(row, int), np.array(weight), np.array(times, float)
    names, f = np.unique(np.array(name, str), return_inverse=True)
    slots, slot = np.unique(of[row] * (len(names) + 1) + f, return_inverse=True)  # a share of each format that a source may write
    owner = slots // (len(names) + 1)
    width = np.bincount(owner, minlength=len(sources)) + 1.0
    share, nothing = 1 / width[owner], 1 / width
    total = np.bincount(of, n, minlength=len(sources))
    for _ in range(rounds):
        joint = share[slot] * weight
        whole = np.bincount(row, joint, minlength=len(pdf)) + nothing[of] * noise_weight
        new = np.bincount(slot, joint / whole[row] * n[row], minlength=len(slots)) / total[owner]
        none = np.bincount(of, nothing[of] * noise_weight / whole * n, minlength=len(sources)) / total
        moved = max(np.abs(new - share).max(initial=0.0), np.abs(none - nothing).max(initial=0.0))
        share, nothing = np.maximum(new, 1e-30), np.maximum(none, 1e-30)
        if moved < 1e-9:
            break
    joint = share[slot] * weight
    noise = nothing[of] * noise_weight
    whole = np.bincount(row, joint, minlength=len(pdf)) + noise
    begin = np.searchsorted(row, np.arange(len(pdf) + 1))
    part = joint / whole[row] / times
    found = [[(name[k], float(part[k])) for k in range(begin[i], begin[i + 1])] for i in range(len(pdf))]
    return pd.DataFrame({"source": pdf["source"].to_numpy(), "readings": pdf["readings"].to_numpy(), "post": found, "noise": noise / whole})


#: Sets of readings that one task takes, all of a source together.
SETS_PER_TASK = 20_000


def normalise_timestamps(df: DataFrame, text: str, source: str | None = None, rules: TimestampRules = TimestampRules(), scratch: Scratch | None = None) -> DataFrame:
    """df with utc_us bigint, ts_format, ts_posterior double and ts_status ('resolved', 'ambiguous', 'unparsable').

    utc_us is null unless the status is 'resolved'. Rows are kept as they are, repeated ones too.
    Columns of these names already in df are an error. An empty df gives an empty result.
    """
    clash = {"utc_us", "ts_format", "ts_posterior", "ts_status", "_readings", "_formats", "_source", "_post", "_noise", "_each", "_top"} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are already there")
    scratch = scratch or Scratch(df.sparkSession, "timestamps")
    clean = F.upper(F.btrim(F.col(f"`{text}`").cast("string"), F.lit(EDGE)))
    src = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")) if source else F.lit("")
    read = with_readings(df.withColumn("_source", src), clean, rules)
    name = lambda r: F.concat(r["fmt"], F.lit("="), r["w"].cast("string"))
    read = read.withColumn("_formats", F.array_join(F.array_sort(F.transform("_readings", name)), "|"))
    read = scratch.keep(read, "readings")
    counts = read.filter("_formats <> ''").groupBy(F.col("_source").alias("source"), F.col("_formats").alias("readings")).agg(F.count(F.lit(1)).alias("n"))
    counts = scratch.keep(counts, "sets")
    rows, rounds, noise = counts.count(), rules.em_rounds, rules.noise
    # a source has a row per set of readings, a few dozen at most; many sources go into one group
    bucket = F.pmod(F.xxhash64("source"), F.lit(max(1, -(-rows // SETS_PER_TASK)))).alias("bucket")
    post = counts.groupBy(bucket).applyInPandas(lambda pdf: posteriors(pdf, rounds, noise), "source string, readings string, post array<struct<fmt:string,p:double>>, noise double")
    post = post.select(F.col("source").alias("_s"), F.col("readings").alias("_r"), F.map_from_entries("post").alias("_post"), F.col("noise").alias("_noise"))
    post = F.broadcast(post) if rows <= BROADCAST_POSTERIORS else post
    out = read.join(post, (F.col("_source") == F.col("_s")) & (F.col("_formats") == F.col("_r")), "left")
    weighed = F.transform("_readings", lambda r: F.struct(F.try_element_at("_post", r["fmt"]).alias("p"), r["fmt"].alias("fmt"), r["us"].alias("us")))
    out = out.withColumn("_each", weighed)
    # readings of several formats may mean one instant: their posteriors add up
    whole = lambda r: F.aggregate(F.filter("_each", lambda q: q["us"] == r["us"]), F.lit(0.0), lambda a, q: a + q["p"])
    out = out.withColumn("_top", F.array_max(F.transform("_each", lambda r: F.struct(whole(r).alias("p"), r["fmt"].alias("fmt"), r["us"].alias("us")))))
    top = F.col("_top")
    sure = F.coalesce(top["p"] >= rules.min_posterior, F.lit(False))
    nothing = top.isNull() | F.coalesce(F.col("_noise") >= top["p"], F.lit(False))
    status = F.when(sure, "resolved").when(nothing, "unparsable").otherwise("ambiguous")
    best = F.when(~nothing | sure, top["p"])
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.when(sure, top["us"]).alias("utc_us"), F.when(sure, top["fmt"]).alias("ts_format"), best.alias("ts_posterior"), status.alias("ts_status"))
