"""Queries of the operators in this subpackage, and their SQL where SQL can say them."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelens.llm import leakage, nearest_time, packing, percentiles, quality
from pavelens.plans.checks import instants
from pavelens.plans.dataset import recording_instants
from pavelens.session import Scratch, ship, table

#: gps_time + this = Unix seconds.
GPS_TO_UNIX_S = 1_315_964_800
P1_PERCENTILES = {"SM4L_M": [0.95], "MSPT": [0.5], "RISS": [0.9]}


def p1_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentile of every group of road section, construction type, class and metric."""
    ship(spark)
    scratch = Scratch(spark, "p1")
    areas = table(spark, sf_dir, "strassenzustand").select("area_id", "strecke_id", "bw", "fk", "sm4l_m", "mspt", "riss").distinct()
    metrics = {"SM4L_M": F.col("sm4l_m"), "MSPT": F.col("mspt"), "RISS": F.when(F.col("bw") == "A", F.col("riss"))}
    groups = ["strecke_id", "bw", "fk"]
    counts = percentiles.value_rows(areas, groups, metrics, 0.0, 1000.0)
    return percentiles.percentiles_of_counts(counts, groups, P1_PERCENTILES, low=0.0, high=1000.0, scratch=scratch)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = p1_percentiles(spark, sf_dir).filter(F.col("n_valid") >= 30)
    limits = table(spark, sf_dir, "factors").select("bw", "metric", "fk", "f2").distinct()
    return found.join(limits, ["bw", "metric", "fk"]).filter(F.col("value") > F.col("f2")).select("strecke_id", "bw", "fk", "metric").distinct()


_RANKED = """
WITH d AS (SELECT DISTINCT area_id, strecke_id, bw, fk, sm4l_m, mspt, riss FROM strassenzustand),
l AS (SELECT strecke_id, bw, fk, 'SM4L_M' AS metric, 95 AS pc, sm4l_m AS v FROM d
  UNION ALL SELECT strecke_id, bw, fk, 'MSPT', 50, mspt FROM d
  UNION ALL SELECT strecke_id, bw, fk, 'RISS', 90, riss FROM d WHERE bw = 'A'),
r AS (SELECT *, row_number() OVER (PARTITION BY strecke_id, bw, fk, metric ORDER BY v) AS rk,
    count(*) OVER (PARTITION BY strecke_id, bw, fk, metric) AS n
  FROM l WHERE v IS NOT NULL AND NOT isnan(v) AND v BETWEEN 0 AND 1000),
g AS (SELECT * FROM r WHERE rk = (pc * n + 99) // 100)
"""


def p2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every laser point with a time and the recording of its run nearest in time, up to 0.25 s away."""
    ship(spark)
    points = table(spark, sf_dir, "point_cloud").filter("gps_time is not null and not isnan(gps_time)")
    us = F.round(F.col("gps_time") * 1e6).cast("bigint") + GPS_TO_UNIX_S * 1_000_000
    points = points.select(F.col("point_source_id").alias("entity"), us.alias("t_us"), F.col("point_id").alias("id"))
    recs = recording_instants(spark, sf_dir, ["rec_id", "run_id"])
    recs = recs.select(F.regexp_extract("run_id", r"^run_(\d+)$", 1).try_cast("bigint").alias("entity"), F.col("utc_us").alias("t_us"), F.col("rec_id").alias("id"))
    return nearest_time.nearest_in_time(points, recs, 250_000).select(F.col("right_id").alias("rec_id"), F.col("left_id").alias("point_id"), "gap_us")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_pairs(spark, sf_dir).select("rec_id", "point_id")


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in containers of 2,048 tokens."""
    ship(spark)
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", 2048).withColumnRenamed("id", "doc_id")


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many containers that takes, how full they are, and how many any packing needs."""
    return packing.fill(p6_containers(spark, sf_dir), 2048)


def _leaks(spark: SparkSession, sf_dir: str, rules: leakage.LeakRules) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leakage.find_leaks(docs, table(spark, sf_dir, "eval_items").select("item_id", "item_text"), rules)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir, leakage.LeakRules()).select("item_id", "doc_id")


def p7_paraphrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with 16 of 24 words of an item's passage in order, and whether the item's question is there too."""
    return _leaks(spark, sf_dir, leakage.PARAPHRASE)


def p8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, its distance from prose and what each statistic adds to it."""
    ship(spark)
    return quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_quality(spark, sf_dir).filter("klass is not null").select("doc_id", "klass")


QUERIES = {
    "p1_found": p1_found, "p1_percentiles": p1_percentiles, "p2_found": p2_found, "p2_pairs": p2_pairs,
    "p6_containers": p6_containers, "p6_fill": p6_fill, "p7_found": p7_found, "p7_paraphrases": p7_paraphrases,
    "p8_found": p8_found, "p8_quality": p8_quality,
}
_NEAREST = "WITH " + instants() + f""",
rc AS (SELECT DISTINCT rec_id, TRY_CAST(regexp_extract(run_id, '^run_([0-9]+)$', 1) AS BIGINT) AS run, utc_us FROM recordings JOIN ts USING (time_stamp)),
pt AS (SELECT DISTINCT point_id, point_source_id AS run, CAST(round(gps_time * 1e6) AS BIGINT) + {GPS_TO_UNIX_S * 1_000_000} AS us FROM point_cloud
 WHERE gps_time IS NOT NULL AND NOT isnan(gps_time)),
pr AS (SELECT rec_id, point_id, abs(us - utc_us) AS gap_us, row_number() OVER (PARTITION BY point_id, us ORDER BY abs(us - utc_us), rec_id) AS r
 FROM pt JOIN rc ON rc.run = pt.run AND abs(us - utc_us) <= 250000)
"""


def _one_letter_forms() -> tuple[str, str]:
    """Characters that NFKC writes as one other character, and these."""
    pairs = [(chr(o), unicodedata.normalize("NFKC", chr(o))) for o in range(0xA0, 0x10000) if not 0xD800 <= o < 0xE000]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1 and a != "'" and b != "'"]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _shared_runs(need: int = 12) -> str:
    """Documents and items with a run of words in common, by joining all runs of that length. Forms that NFKC writes as several characters aren't taken apart."""
    a, b = _one_letter_forms()
    text = lambda c: f"regexp_extract_all(lower(translate({c}, '{a}', '{b}')), '[\\p{{L}}\\p{{N}}]+')"
    runs = lambda key: f"""SELECT DISTINCT {key}, hash(w[i:i + {need - 1}]) AS g, w[i:i + {need - 1}] AS run FROM (SELECT {key}, w,
 unnest(generate_series(1, len(w) - {need - 1})) AS i FROM {{0}})"""  # noqa: E731
    return (
        f"WITH d AS (SELECT doc_id, {text('text')} AS w FROM documents), i AS (SELECT item_id, {text('item_text')} AS w FROM eval_items), "
        f"dr AS ({runs('doc_id').format('d')}), ir AS ({runs('item_id').format('i')}) SELECT DISTINCT item_id, doc_id FROM ir JOIN dr ON ir.g = dr.g AND ir.run = dr.run"
    )


ORACLES = {
    "p2_found": _NEAREST + "SELECT rec_id, point_id FROM pr WHERE r = 1",
    "p2_pairs": _NEAREST + "SELECT rec_id, point_id, gap_us FROM pr WHERE r = 1",
    "p7_found": _shared_runs(),
    "p1_found": _RANKED + """SELECT DISTINCT strecke_id, g.bw, g.fk, g.metric FROM g JOIN factors f ON f.bw = g.bw AND f.fk = g.fk AND f.metric = g.metric
WHERE n >= 30 AND v > f.f2""",
    "p1_percentiles": _RANKED + """SELECT strecke_id, bw, fk, metric, CAST(pc / 100.0 AS DOUBLE) AS p, n AS n_valid, v AS value, 0.0::DOUBLE AS rank_error FROM g""",
}
