"""Queries of the survey operators, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pavelens.functions import scalars
from pavelens.operators import areas, evaluate, lidar, markings, planeness, polygons, profiles, raster, relational, sampling, sequences
from pavelens.plans import checks
from pavelens.plans.fixtures import cte, fixture
from pavelens.session import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_SQL: dict[str, str | Callable[[], str]] = {}


def query(sql: str | Callable[[], str] | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(ship(spark), sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            _SQL[f.__name__] = sql
        return run

    return add


# ---- rating -----------------------------------------------------------------------------------------

MEASURES = ["sm4l_m", "sm4l_a", "mspt", "msph", "riss", "afli", "ofs"]
_R2 = "CAST(format('{{:.2f}}', CAST({0} AS DOUBLE)) AS DOUBLE)"  # decimal digits of the binary value
_NORM = """CASE WHEN x < f1 THEN 1.0e0 + 0.5e0 * x / f1 WHEN x <= f2 THEN 1.5e0 + 2.0e0 * (x - f1) / (f2 - f1)
 WHEN x <= f3 THEN 3.5e0 + (x - f2) / (f3 - f2) WHEN x <= 1.5e0 * f3 - 0.5e0 * f2 THEN 4.5e0 + 0.5e0 * (x - f3) / ((1.5e0 * f3 - 0.5e0 * f2) - f3)
 WHEN x > 1.5e0 * f3 - 0.5e0 * f2 THEN 5.0e0 END"""
_CLASS = "CASE WHEN {0} IS NULL THEN 0 WHEN {0} <= 1.5e0 THEN 1 WHEN {0} <= 3.5e0 THEN 2 WHEN {0} <= 4.5e0 THEN 3 ELSE 4 END"
_LONG = "WITH d AS (SELECT DISTINCT area_id, bw, fk, {0} FROM strassenzustand), l AS (".format(", ".join(MEASURES)) + " UNION ALL ".join(
    f"SELECT area_id, bw, fk, '{m.upper()}' AS metric, {m} AS v FROM d" for m in MEASURES
) + """), n AS (SELECT area_id, l.bw, l.fk, l.metric, f1, f2, f3,
 CASE WHEN isnan(v) THEN NULL WHEN l.metric IN ('RISS', 'AFLI') AND l.bw <> 'A' THEN NULL WHEN l.metric IN ('SM4L_M', 'SM4L_A', 'MSPT', 'MSPH')
 AND l.fk = 'N' THEN NULL ELSE v END AS x
 FROM l LEFT JOIN factors f ON f.bw = l.bw AND f.fk = l.fk AND f.metric = l.metric), z AS (SELECT *, """ + _R2.format(_NORM) + " AS zw FROM n)"


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "strassenzustand").select("area_id", "bw", "fk", *MEASURES).distinct()


def _rated(spark: SparkSession, sf_dir: str, weights: evaluate.Weights = evaluate.Weights()) -> DataFrame:
    return evaluate.rate(_areas(spark, sf_dir), table(spark, sf_dir, "factors"), weights)


def _rated_sql(we: str, ws: str) -> str:
    zw = lambda m: f"max(CASE WHEN metric = '{m}' THEN zw END) AS zw{m.lower()}"
    return (
        _LONG + ", w AS (SELECT area_id, bw, fk, " + ", ".join(zw(m.upper()) for m in MEASURES) + """ FROM z GROUP BY ALL), s AS (SELECT *, CASE
 WHEN zwsm4l_m IS NOT NULL AND zwsm4l_a IS NOT NULL THEN greatest(zwsm4l_m, zwsm4l_a) END AS zwsm4l FROM w), """
        f"""t AS (SELECT *,
 {_R2.format(f'CASE WHEN zwsm4l IS NOT NULL AND zwmspt IS NOT NULL AND greatest(zwsm4l, zwmspt) > 3.5e0 THEN greatest(zwsm4l, zwmspt) ELSE {we} END')} AS twgeb,
 """
        f"""{_R2.format(f'CASE WHEN bw = {chr(39)}P{chr(39)} THEN zwofs WHEN zwriss IS NOT NULL AND zwofs IS NOT NULL AND greatest(zwriss, zwofs) > 3.5e0 THEN greatest(zwriss, zwofs) ELSE {ws} END')} AS twsub
 FROM s), """
        "g AS (SELECT *, CASE WHEN twsub IS NOT NULL THEN greatest(coalesce(twgeb, twsub), twsub) END AS gw FROM t) "
    )


@query(_LONG + " SELECT area_id, bw, fk, metric, zw FROM z")
def normalize_metric(spark, sf_dir):
    f = table(spark, sf_dir, "factors")
    d = _areas(spark, sf_dir)
    long = d.select("area_id", "bw", "fk", F.explode(F.array(*[F.struct(F.lit(m.upper()).alias("metric"), F.col(m).alias("v")) for m in MEASURES])).alias("s")).select("area_id", "bw", "fk", "s.metric", "s.v")
    x = F.when(F.col("metric").isin("RISS", "AFLI") & (F.col("bw") != "A"), None).when(F.col("metric").isin(*evaluate.EVENNESS) & (F.col("fk") == "N"), None).otherwise(scalars.nan_to_null(F.col("v")))
    j = long.join(f, ["bw", "fk", "metric"], "left")
    return j.select("area_id", "bw", "fk", "metric", scalars.round_exact(evaluate.normalise(x, F.col("f1"), F.col("f2"), F.col("f3"))).alias("zw"))


@query(_LONG + f" SELECT area_id, metric, {_CLASS.format('zw')} AS zk FROM z")
def quantize_class(spark, sf_dir):
    return normalize_metric(spark, sf_dir).select("area_id", "metric", evaluate.quantise(F.col("zw")).alias("zk"))


_RATED_COLUMNS = "area_id, bw, fk, zwsm4l, zwmspt, zwmsph, zwriss, zwafli, zwofs, twgeb, twsub, gw"
_TK = f"CASE WHEN twgeb IS NOT NULL THEN {_CLASS.format('twgeb')} END AS tkgeb, {_CLASS.format('twsub')} AS tksub, {_CLASS.format('gw')} AS gk"


def _named(df: DataFrame) -> DataFrame:
    names = [*_RATED_COLUMNS.split(", "), "tkgeb", "tksub", "gk"]
    return df.select(*[F.col(n).alias(n) for n in names])


@query(_rated_sql("0.25e0 * zwsm4l + 0.5e0 * zwmspt + 0.25e0 * zwmsph", "0.56e0 * zwriss + 0.31e0 * zwafli + 0.13e0 * zwofs") + f"SELECT {_RATED_COLUMNS}, {_TK} FROM g")
def rate_areas(spark, sf_dir):
    return _named(_rated(spark, sf_dir))


@query(_rated_sql("0.25e0 * zwsm4l + 0.5e0 * zwmspt + 0.25e0 * zwmsph", "0.56e0 * zwriss + 0.31e0 * zwafli + 0.13e0 * zwofs") + f"""SELECT {_RATED_COLUMNS},
 {_TK} FROM g WHERE bw = 'A'""")
def rate_asphalt(spark, sf_dir):
    return _named(evaluate.rate(_areas(spark, sf_dir).filter("bw = 'A'"), table(spark, sf_dir, "factors")))


@query(_rated_sql("0.25e0 * zwsm4l + 0.5e0 * zwmspt + 0.25e0 * zwmsph", "0.56e0 * zwriss + 0.31e0 * zwafli + 0.13e0 * zwofs") + f"""SELECT {_RATED_COLUMNS},
 {_TK} FROM g WHERE bw = 'P'""")
def rate_paved(spark, sf_dir):
    return _named(evaluate.rate(_areas(spark, sf_dir).filter("bw = 'P'"), table(spark, sf_dir, "factors")))


@query(_rated_sql("0.5e0 * zwsm4l + 0.25e0 * zwmspt + 0.25e0 * zwmsph", "0.25e0 * zwriss + 0.25e0 * zwafli + 0.5e0 * zwofs") + f"SELECT {_RATED_COLUMNS}, {_TK} FROM g")
def reevaluate_weights(spark, sf_dir):
    other = evaluate.Weights({"SM4L": 0.5, "MSPT": 0.25, "MSPH": 0.25}, {"RISS": 0.25, "AFLI": 0.25, "OFS": 0.5})
    return _named(evaluate.rerate(_rated(spark, sf_dir), table(spark, sf_dir, "factors"), other))


# ---- evenness ---------------------------------------------------------------------------------------

_IN = "FROM fx_samples s JOIN fx_areas a ON s.x > a.x0 AND s.x < a.x1 AND s.y > a.y0 AND s.y < a.y1"
def _inside(spark, sf_dir):
    return areas.points_in_boxes(fixture(spark, sf_dir, "fx_samples"), fixture(spark, sf_dir, "fx_areas"))


@query(cte("fx_areas", "fx_samples") + f" SELECT area_id, l_orderkey, l_linenumber, x, y {_IN}")
def point_in_area(spark, sf_dir):
    return _inside(spark, sf_dir).select("area_id", "l_orderkey", "l_linenumber", "x", "y")


_DELTAS = list(planeness.DELTAS)
_LONG_POINTS = f"""SELECT x, y, depth_mid, depth_mid - l_quantity / 6000e0 AS {_DELTAS[0]}, CASE WHEN l_linenumber > 2
 THEN rut_left - 0.01e0 END AS {_DELTAS[1]}, rut_right - 0.02e0 AS {_DELTAS[2]},
 CAST(NULL AS DOUBLE) AS {_DELTAS[3]}, CASE WHEN l_linenumber <> 3 THEN (l_quantity - 25) / 10e0 END AS gradient FROM {{fx_samples}}"""
_TRANS_LINES = """SELECT x AS lx0, y AS ly0, x + rut_left * 50e0 AS lx1, y + rut_right * 40e0 AS ly1, CASE WHEN l_linenumber <> 4
 THEN rut_left END AS rut_depth_left, CASE WHEN l_linenumber < 4 THEN rut_right END AS rut_depth_right,
 CASE WHEN l_linenumber = 2 THEN rut_left / 2 END AS water_depth_left, rut_right / 3 AS water_depth_right, (l_quantity - 20) / 7e0 AS gradient
 FROM {fx_samples} WHERE rut_left IS NOT NULL AND rut_right IS NOT NULL"""


def _moments(c: str, kinds: str, name: str = "") -> str:
    """Aggregates of c in whole 1e-9, as sums of whole numbers don't depend on their order."""
    name, u = name or c, f"CAST(floor({c} * 1e9 + 0.5e0) AS BIGINT)"
    n, s, ss = f"count({c})::DOUBLE", f"sum({u})::DOUBLE", f"sum({u}::HUGEINT * {u})::DOUBLE"
    sql = {"max": f"max({u}) / 1e9 AS {name}_max", "mean": f"CASE WHEN count({c}) > 0 THEN {s} / {n} / 1e9 END AS {name}_mean", "std": f"""CASE
 WHEN count({c}) > 0 THEN sqrt(greatest(0.0::DOUBLE, {n} * {ss} - {s} * {s})) / {n} / 1e9 END AS {name}_std"""}
    return ", ".join(sql[k] for k in kinds.split())


def _planeness_sql() -> str:
    along = [_moments("depth_mid", "max mean"), *[_moments(d, "std") for d in _DELTAS], _moments("gradient", "mean", "gradient_longitudinal")]
    across = [*[_moments(c, "max mean std") for c in planeness.SIDES], _moments("gradient", "mean", "gradient_transverse")]
    both = ", ".join(f"greatest({m}_left_{k}, {m}_right_{k}) AS {m}_{n}" for m in ("rut_depth", "water_depth") for k, n in (("mean", "mean_max"), ("max", "max")))
    box = "least(lx0, lx1) <= x1 AND greatest(lx0, lx1) >= x0 AND least(ly0, ly1) <= y1 AND greatest(ly0, ly1) >= y0"
    return (
        cte("fx_areas", "fx_samples") + f", pt AS ({_LONG_POINTS.format(fx_samples='fx_samples')}), ln AS ({_TRANS_LINES.format(fx_samples='fx_samples')}), "
        f"al AS (SELECT area_id, {', '.join(along)} FROM pt JOIN fx_areas ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY area_id), "
        f"ac AS (SELECT area_id, {', '.join(across)} FROM ln JOIN fx_areas ON {box} WHERE greatest({_EX}, {_EY}, 0e0) <= least({_LX}, {_LY}, 1e0) GROUP BY area_id), "
        f"""ag AS (SELECT a.area_id, a.bw, a.fk, al.* EXCLUDE (area_id), ac.* EXCLUDE (area_id), {both} FROM fx_areas a LEFT
 JOIN al ON al.area_id = a.area_id LEFT JOIN ac ON ac.area_id = a.area_id)"""
    )


def _planeness(spark, sf_dir):
    own, samples = fixture(spark, sf_dir, "fx_areas"), fixture(spark, sf_dir, "fx_samples")
    points = areas.points_in_boxes(spark.sql(_LONG_POINTS, fx_samples=samples), own)
    lines = areas.lines_in_boxes(spark.sql(_TRANS_LINES, fx_samples=samples), own)
    return planeness.aggregate(own.select("area_id", "bw", "fk"), points, lines)


_ALONG = ["depth_mid_max", "depth_mid_mean", *[f"{d}_std" for d in _DELTAS], "gradient_longitudinal_mean"]


@query(lambda: _planeness_sql() + f" SELECT area_id, {', '.join(_ALONG)} FROM ag")
def planeness_agg_long(spark, sf_dir):
    """Measures of the points inside each area; areas without points have their row."""
    return _planeness(spark, sf_dir).select("area_id", *_ALONG)


@query(lambda: _planeness_sql() + f" SELECT * EXCLUDE (bw, fk, {', '.join(_ALONG)}) FROM ag")
def planeness_agg_trans(spark, sf_dir):
    """Measures of the transverse lines that meet each area, left, right and the greater of the two."""
    return _planeness(spark, sf_dir).drop("bw", "fk", *_ALONG)


def _ap9_sql() -> str:
    value = lambda c: _R2.format(c if "gradient" in c else f"{c} * 1000e0")
    return _planeness_sql() + " SELECT area_id, bw, fk, " + ", ".join(f"CASE WHEN fk <> 'N' AND {c} IS NOT NULL THEN {value(c)} END AS {n}" for c, n in planeness.AP9.items()) + " FROM ag"


@query(lambda: _ap9_sql())
def ap9_projection(spark, sf_dir):
    """The norm's 19 evenness columns: renamed, in millimetres, rounded, null for class N."""
    return planeness.to_ap9(_planeness(spark, sf_dir))


_MA = lambda n: f"""CASE WHEN count(z) OVER (PARTITION BY cluster ORDER BY idx ROWS BETWEEN {n // 2} PRECEDING AND {n // 2} FOLLOWING) = {n}
 THEN z - sum(z) OVER (PARTITION BY cluster ORDER BY idx ROWS BETWEEN {n // 2} PRECEDING AND {n // 2} FOLLOWING) / {n}e0 END AS delta_{n}"""  # noqa: E731
_LANES = """SELECT l_suppkey AS cluster, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity,
 l_extendedprice, l_shipdate) - 1 AS BIGINT) AS idx, CAST(floor(l_extendedprice) AS DOUBLE) AS z FROM {lineitem}"""


@query(f"WITH h AS ({_LANES.format(lineitem='lineitem')}) SELECT cluster, idx, z, {', '.join(map(_MA, (11, 31, 101, 301)))} FROM h")
def moving_average_delta(spark, sf_dir):
    h = spark.sql(_LANES, lineitem=table(spark, sf_dir, "lineitem"))
    return sequences.moving_average_deltas(h, ["cluster"], "idx", "z", block=400)


@query(cte("fx_heights") + """, n AS (SELECT cluster, idx, z, count(*) OVER (PARTITION BY cluster) AS n FROM fx_heights),
 d AS (SELECT m.cluster, m.idx, max((a.z * (b.idx - m.idx) + b.z * (m.idx - a.idx)) / (b.idx - a.idx)::DOUBLE) AS hull FROM n m
 JOIN n a ON a.cluster = m.cluster AND a.idx BETWEEN m.idx - 20 AND m.idx - 1 JOIN n b ON b.cluster = m.cluster AND b.idx BETWEEN m.idx + 1 AND m.idx + 20
 WHERE m.idx >= 20 AND m.idx + 20 < m.n GROUP BY m.cluster, m.idx)
 SELECT n.cluster, n.idx, n.z, CASE WHEN hull IS NOT NULL THEN greatest(hull, n.z) - n.z END AS depth_mid FROM n LEFT JOIN d ON d.cluster = n.cluster AND d.idx = n.idx""")
def straight_edge_depth(spark, sf_dir):
    return sequences.straight_edge_depth(fixture(spark, sf_dir, "fx_heights"), ["cluster"], "idx", "z", block=400)


_SHOTS = "SELECT DISTINCT run_id, CAST(image_id AS BIGINT) AS image_no, x, y FROM recordings"
_ISLAND = """WITH r AS ({0}), f AS (SELECT *, CASE WHEN {1} THEN 0 ELSE 1 END AS s FROM (SELECT *, lag(image_no) OVER w AS pn, lag(x) OVER w AS px,
 lag(y) OVER w AS py FROM r WINDOW w AS (PARTITION BY run_id ORDER BY image_no))),
 c AS (SELECT *, CAST(sum(s) OVER (PARTITION BY run_id ORDER BY image_no ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS cluster FROM f)
 SELECT run_id, image_no, cluster FROM (SELECT *, count(*) OVER (PARTITION BY run_id, cluster) AS n FROM c) WHERE n > 1"""
_ONE = "SELECT run_id, image_no, min(x) AS x, min(y) AS y FROM (" + _SHOTS + ") GROUP BY run_id, image_no"


def _shots(spark, sf_dir):
    r = table(spark, sf_dir, "recordings").select("run_id", F.col("image_id").cast("bigint").alias("image_no"), "x", "y").distinct()
    return r.groupBy("run_id", "image_no").agg(F.min("x").alias("x"), F.min("y").alias("y"))


@query(_ISLAND.format(_ONE, "coalesce(image_no - pn = 1, false) AND coalesce(sqrt((x - px) * (x - px) + (y - py) * (y - py)) BETWEEN 4e0 AND 6e0, false)"))
def gap_island_clusters(spark, sf_dir):
    """Drive lines: consecutive images of a run, 4 to 6 m apart."""
    return sequences.islands(_shots(spark, sf_dir), ["run_id"], "image_no", "x", "y", (4.0, 6.0), block=64).select("run_id", "image_no", "cluster")


@query(_ISLAND.format(_ONE, "coalesce(image_no - pn = 1, false)"))
def consecutive_id_clusters(spark, sf_dir):
    return sequences.islands(_shots(spark, sf_dir), ["run_id"], "image_no", block=64).select("run_id", "image_no", "cluster")


@query("""WITH s AS (SELECT l_orderkey, count(*)::DOUBLE AS n, sum(l_linenumber)::DOUBLE AS sx, sum(CAST(floor(l_quantity) AS BIGINT))::DOUBLE AS sy,
 sum(l_linenumber * l_linenumber)::DOUBLE AS sxx, sum(l_linenumber * CAST(floor(l_quantity) AS BIGINT))::DOUBLE AS sxy FROM lineitem GROUP BY l_orderkey)
 SELECT l_orderkey, CASE WHEN n * sxx - sx * sx <> 0 THEN -100e0 * (n * sxy - sx * sy) / (n * sxx - sx * sx) END AS gradient FROM s""")
def transverse_gradient(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("lane"), F.floor("l_quantity").cast("bigint").alias("v"))
    return sequences.slope(d, ["l_orderkey"], "lane", "v")


# ---- damage -----------------------------------------------------------------------------------------

_TYPES = list(areas.TYPES)
_TYP = "CASE typ_id " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TYPES)) + " END"
_OVER = "greatest(0e0, least({0}1, {1} + 1e0) - greatest({0}0, {1}::DOUBLE))"
_CELLS = "SELECT *, unnest(generate_series(CAST(floor(x0) AS BIGINT), CAST(floor(x1) AS BIGINT))) AS cx FROM {0}"
_DAMAGE = cte("fx_areas", "fx_damage") + f", dmg AS (SELECT *, {_TYP} AS typ FROM fx_damage)"
_PARTS = ", dx AS (" + _CELLS.format("dmg") + """), dc AS (SELECT *, unnest(generate_series(CAST(floor(y0) AS BIGINT), CAST(floor(y1) AS BIGINT))) AS cy
 FROM dx), da AS (SELECT cx, cy, typ, """ + _OVER.format("x", "cx") + " * " + _OVER.format("y", "cy") + """ AS a
 FROM dc), bt AS (SELECT cx, cy, typ, CAST(sum(CAST(floor(a * 1e6 + 0.5e0) AS BIGINT)) AS BIGINT) AS um2 FROM da WHERE a > 0 GROUP BY cx, cy, typ)"""


def _damage(spark, sf_dir):
    typ = F.element_at(F.array(*map(F.lit, _TYPES)), F.col("typ_id") + 1)
    return fixture(spark, sf_dir, "fx_damage").withColumn("typ", typ)


@query(_DAMAGE + " SELECT l_orderkey, l_linenumber, typ, x0, y0 FROM dmg WHERE (x1 - x0) * (y1 - y0) >= CASE typ " + " ".join(f"WHEN '{t}' THEN {float(p)}e0 * {areas.PIXEL_M}e0 * {areas.PIXEL_M}e0" for t, p in areas.SIEVE_PIXELS.items()) + " END")
def sieve_damage(spark, sf_dir):
    d = _damage(spark, sf_dir)
    return areas.sieve(d, (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).select("l_orderkey", "l_linenumber", "typ", "x0", "y0")


_AREA_CELLS = ", ax AS (" + _CELLS.format("fx_areas") + "), ac AS (SELECT *, unnest(generate_series(CAST(floor(y0) AS BIGINT), CAST(floor(y1) AS BIGINT))) AS cy FROM ax)"


@query(cte("fx_areas") + _AREA_CELLS + " SELECT area_id, cx, cy FROM ac")
def grid_cells(spark, sf_dir):
    return areas.unit_cells(fixture(spark, sf_dir, "fx_areas")).select("area_id", "cx", "cy")


@query(_DAMAGE + _PARTS + " SELECT cx, cy, typ, um2 FROM bt")
def cell_damage_area(spark, sf_dir):
    return areas.cell_damage(_damage(spark, sf_dir))


@query(_DAMAGE + _PARTS + " SELECT cx, cy, " + ", ".join(f"CAST(sum(CASE WHEN typ = '{t}' THEN um2 END) AS BIGINT) AS {t}" for t in _TYPES) + " FROM bt GROUP BY cx, cy")
def cell_damage_pivot(spark, sf_dir):
    return areas.cell_pivot(areas.cell_damage(_damage(spark, sf_dir)))


def _flags_sql(mode: str) -> str:
    flags = ", ".join(f"coalesce(sum(CASE WHEN typ = '{t}' THEN um2 END), 0) >= {int(round(areas.CELL_M2[t] * 1e6))} AS {t}" for t in areas.MODES[mode])
    return f", fl AS (SELECT * FROM (SELECT cx, cy, {flags} FROM bt GROUP BY cx, cy) WHERE {' OR '.join(areas.MODES[mode])})"


_RECT = "greatest(0e0, least(q.x1, b.x1, cx + 1e0) - greatest(q.x0, b.x0, cx::DOUBLE)) * greatest(0e0, least(q.y1, b.y1, cy + 1e0) - greatest(q.y0, b.y0, cy::DOUBLE))"


def _clipped_sql(mode: str) -> str:
    """Damage in the union of the areas of a mode: by inclusion and exclusion, as no three of the areas overlap."""
    areas_ = f"(SELECT * FROM fx_areas WHERE bw = '{mode}')"
    pairs = f"""(SELECT greatest(a.x0, b.x0) AS x0, greatest(a.y0, b.y0) AS y0, least(a.x1, b.x1) AS x1, least(a.y1, b.y1) AS y1 FROM {areas_} a
 JOIN {areas_} b ON a.area_id < b.area_id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)"""
    near = "b.x0 < q.x1 AND b.x1 > q.x0 AND b.y0 < q.y1 AND b.y1 > q.y0"
    return (
        ", dx AS (" + _CELLS.format("(SELECT *, row_number() OVER () AS rn FROM dmg)") + """), q AS (SELECT *,
 unnest(generate_series(CAST(floor(y0) AS BIGINT), CAST(floor(y1) AS BIGINT))) AS cy FROM dx), """
        f"""g AS (SELECT rn, cx, cy, typ, sum({_RECT}) AS a FROM q JOIN {areas_} b ON {near} GROUP BY rn, cx, cy, typ), l AS (SELECT rn, cx, cy,
 sum({_RECT}) AS a FROM q JOIN {pairs} b ON {near} GROUP BY rn, cx, cy), """
        """bt AS (SELECT cx, cy, typ, CAST(sum(CAST(floor((g.a - coalesce(l.a, 0)) * 1e6 + 0.5e0) AS BIGINT)) AS BIGINT) AS um2 FROM g LEFT
 JOIN l USING (rn, cx, cy) GROUP BY cx, cy, typ)"""
    )


def _share_sql(mode: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {' OR '.join(ts)}) AS n_{g}" for g, ts in areas.GROUPS[mode].items())
    shares = ", ".join(f"coalesce(n_{g}, 0) * 100e0 / ((x1 - x0) * (y1 - y0)) AS {g}" for g in areas.GROUPS[mode])
    return (
        _DAMAGE + _clipped_sql(mode) + _flags_sql(mode) + _AREA_CELLS + """, hit AS (SELECT area_id, fl.* FROM ac JOIN fl ON fl.cx = ac.cx
 AND fl.cy = ac.cy WHERE """ + _OVER.format("x", "ac.cx") + " * " + _OVER.format("y", "ac.cy") + f" > 0 AND bw = '{mode}'), "
        f"k AS (SELECT area_id, {counts} FROM hit GROUP BY area_id) SELECT a.area_id, a.bw, {shares} FROM fx_areas a LEFT JOIN k ON k.area_id = a.area_id WHERE a.bw = '{mode}'"
    )


@query(_DAMAGE + _PARTS + _flags_sql("A") + " SELECT * FROM fl")
def cell_flags(spark, sf_dir):
    return areas.cell_flags(areas.cell_damage(_damage(spark, sf_dir)), "A")


def _share(spark, sf_dir, mode):
    own = fixture(spark, sf_dir, "fx_areas")
    return areas.damaged_share(own, areas.cell_flags(areas.cell_damage(_damage(spark, sf_dir), own.filter(F.col("bw") == mode)), mode), mode)


@query(_DAMAGE + _clipped_sql("A") + " SELECT cx, cy, typ, um2 FROM bt WHERE um2 > 0")
def clipped_damage(spark, sf_dir):
    """Damage per 1 m cell and type inside the union of the asphalt areas."""
    return areas.cell_damage(_damage(spark, sf_dir), fixture(spark, sf_dir, "fx_areas").filter("bw = 'A'")).filter("um2 > 0")


@query(_share_sql("A"))
def area_damage_percent(spark, sf_dir):
    return _share(spark, sf_dir, "A")


@query(_share_sql("P"))
def substance_paved(spark, sf_dir):
    return _share(spark, sf_dir, "P")


_LINES = """SELECT l_orderkey, l_linenumber, x AS lx0, y AS ly0, x + rut_left * 500e0 AS lx1, y + rut_right * 400e0 AS ly1 FROM fx_samples
 WHERE rut_left IS NOT NULL AND rut_right IS NOT NULL"""


def _clip_sql(a: str, k: str) -> tuple[str, str]:
    d, lo, hi = f"(l{a}1 - l{a}0)", f"{a}0", f"{a}1"
    one, two = f"({lo} - l{a}0) / nullif({d}, 0)", f"({hi} - l{a}0) / nullif({d}, 0)"
    within = f"l{a}0 BETWEEN {lo} AND {hi}"
    return (f"CASE WHEN {d} = 0 THEN CASE WHEN {within} THEN 0e0 ELSE 2e0 END ELSE least({one}, {two}) END", f"""CASE WHEN {d} = 0 THEN CASE
 WHEN {within} THEN 1e0 ELSE -1e0 END ELSE greatest({one}, {two}) END""")


_EX, _LX = _clip_sql("x", "x")
_EY, _LY = _clip_sql("y", "y")


@query(cte("fx_areas", "fx_samples") + f""", ln AS ({_LINES}) SELECT area_id, l_orderkey, l_linenumber, lx0, ly0 FROM ln JOIN fx_areas ON least(lx0,
 lx1) <= x1 AND greatest(lx0, lx1) >= x0 AND least(ly0, ly1) <= y1 AND greatest(ly0, ly1) >= y0 WHERE greatest({_EX}, {_EY}, 0e0) <= least({_LX},
 {_LY}, 1e0)""")
def line_in_area(spark, sf_dir):
    lines = fixture(spark, sf_dir, "fx_samples").selectExpr("l_orderkey", "l_linenumber", "x AS lx0", "y AS ly0", "x + rut_left * 500e0 AS lx1", "y + rut_right * 400e0 AS ly1").filter("lx1 is not null and ly1 is not null")
    return areas.lines_in_boxes(lines, fixture(spark, sf_dir, "fx_areas")).select("area_id", "l_orderkey", "l_linenumber", "lx0", "ly0")


# ---- tiles, boxes, ids ------------------------------------------------------------------------------

@query("""SELECT file_id, nullif(regexp_extract(file_path, '([0-9]+_[0-9]+)', 1), '') AS tile, CAST(split_part(nullif(regexp_extract(file_path,
 '([0-9]+_[0-9]+)', 1), ''), '_', 1) AS BIGINT) AS tile_x, CAST(split_part(nullif(regexp_extract(file_path, '([0-9]+_[0-9]+)', 1), ''), '_',
 2) AS BIGINT) AS tile_y FROM cache_files""")
def tile_id_parse(spark, sf_dir):
    d = table(spark, sf_dir, "cache_files").select("file_id", scalars.tile_id(F.col("file_path")).alias("tile"))
    x, y = scalars.tile_corner(F.col("tile"))
    return d.select("file_id", "tile", x.alias("tile_x"), y.alias("tile_y"))


@query("""WITH f AS (SELECT DISTINCT tile_id FROM substance WHERE regexp_full_match(tile_id, '[0-9]+_[0-9]+')), d AS (SELECT DISTINCT tile_id
 FROM cache_files WHERE attempt > 1 AND tile_id IS NOT NULL),
 t AS (SELECT tile_id, CAST(split_part(tile_id, '_', 1) AS DOUBLE) AS x0, CAST(split_part(tile_id, '_', 2) AS DOUBLE) AS y0 FROM f
 WHERE tile_id NOT IN (SELECT tile_id FROM d)),
 b AS (SELECT DISTINCT x - 5 AS bx0, y - 5 AS by0, x + 5 AS bx1, y + 5 AS by1 FROM recordings),
 c AS (SELECT DISTINCT tx * 50e0 AS x0, ty * 50e0 AS y0 FROM (SELECT *, unnest(generate_series(CAST(ceil(bx0 / 50 - 1) AS BIGINT),
 CAST(floor(bx1 / 50) AS BIGINT))) AS tx FROM b) q, generate_series(CAST(ceil(by0 / 50 - 1) AS BIGINT), CAST(floor(by1 / 50) AS BIGINT)) g(ty))
 SELECT tile_id, t.x0, t.y0, t.x0 + 50 AS x1, t.y0 + 50 AS y1 FROM t JOIN c ON c.x0 = t.x0 AND c.y0 = t.y0""")
def tile_filter_semi_anti(spark, sf_dir):
    """Tiles that aren't done yet and meet a 10 m box around a recording."""
    files = table(spark, sf_dir, "substance").select(F.concat(F.lit("kachel_"), F.col("tile_id"), F.lit(".las")).alias("name"))
    done = table(spark, sf_dir, "cache_files").filter("attempt > 1").select("tile_id").distinct()
    boxes = table(spark, sf_dir, "recordings").selectExpr("x - 5 AS x0", "y - 5 AS y0", "x + 5 AS x1", "y + 5 AS y1").distinct()
    return areas.pick_tiles(files, done, boxes, 50.0)


@query("SELECT DISTINCT rec_id, x, y, height FROM recordings WHERE x BETWEEN 120000 - 7.5e0 AND 150000 + 7.5e0 AND y BETWEEN 5210000 - 7.5e0 AND 5250000 + 7.5e0")
def box_select(spark, sf_dir):
    """Recordings in a box widened by 7.5 m, both ends included."""
    r = table(spark, sf_dir, "recordings").select("rec_id", "x", "y", "height")
    return r.filter(scalars.in_range(F.col("x"), 120000 - 7.5, 150000 + 7.5) & scalars.in_range(F.col("y"), 5210000 - 7.5, 5250000 + 7.5)).distinct()


@query("SELECT point_source_id, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z FROM point_cloud GROUP BY point_source_id")
def range_bounds(spark, sf_dir):
    return lidar.bounds(table(spark, sf_dir, "point_cloud"), ["point_source_id"])


@query("SELECT DISTINCT point_id, CAST(floor(x / 50) * 50 AS BIGINT) AS tile_x, CAST(floor(y / 50) * 50 AS BIGINT) AS tile_y FROM point_cloud")
def retile_points(spark, sf_dir):
    return lidar.retile(table(spark, sf_dir, "point_cloud").select("point_id", "x", "y").distinct()).select("point_id", "tile_x", "tile_y")


_B36 = """WITH RECURSIVE d AS (SELECT o_orderkey AS k, o_orderkey AS r, '' AS s FROM orders UNION ALL SELECT k, r // 36,
 substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(r % 36 AS INT) + 1, 1) || s FROM d WHERE r > 0) SELECT k AS o_orderkey, CASE WHEN k = 0 THEN '0'
 ELSE s END AS id36, k AS id_number FROM d WHERE r = 0 AND (s <> '' OR k = 0)"""


@query(_B36)
def base36_id(spark, sf_dir):
    """Keys written in base 36 and read back."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", scalars.to_base(F.col("o_orderkey")).alias("id36"))
    return o.withColumn("id_number", scalars.base_number(F.col("id36")).cast("bigint"))


# ---- markings ---------------------------------------------------------------------------------------

_PX = cte("fx_pixels")


@query(_PX + """, s AS (SELECT tile, count(*) AS n, count(*) FILTER (WHERE cond_id = 1) * 100e0 / count(*) AS gut,
 count(*) FILTER (WHERE cond_id = 2) * 100e0 / count(*) AS mittel, count(*) FILTER (WHERE cond_id = 3) * 100e0 / count(*) AS schlecht FROM fx_pixels
 WHERE cond_id > 0 GROUP BY tile)
 SELECT *, CASE WHEN schlecht / 100e0 >= 0.25e0 THEN 'schlecht' WHEN (mittel + schlecht) / 100e0 >= 0.25e0 THEN 'mittel' ELSE 'gut' END AS zustand
 FROM s""")
def marking_classify(spark, sf_dir):
    return markings.classify_markings(fixture(spark, sf_dir, "fx_pixels"), ["tile"]).drop("typ")


@query(_PX + """, c AS (SELECT tile, type_id, count(*) AS n, count(*) FILTER (WHERE cond_id > 0) AS k FROM fx_pixels GROUP BY ALL) SELECT tile,
 type_id AS typ FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY n DESC, type_id) AS r, sum(k) OVER (PARTITION BY tile) AS s FROM c)
 WHERE r = 1 AND s > 0""")
def marking_majority_type(spark, sf_dir):
    return markings.pixel_shares(fixture(spark, sf_dir, "fx_pixels"), ["tile"]).select("tile", "typ")


@query(_PX + """, c AS (SELECT tile, type_id, cond_id, count(*) AS n FROM fx_pixels WHERE type_id <> 9 GROUP BY ALL) SELECT *,
 n * 100e0 / sum(n) OVER (PARTITION BY tile)::DOUBLE AS of_tile, n * 100e0 / sum(n) OVER (PARTITION BY tile, type_id)::DOUBLE AS of_type FROM c""")
def tile_condition_counts(spark, sf_dir):
    return markings.condition_table(fixture(spark, sf_dir, "fx_pixels"), (9,))


@query(_PX + """, w AS (SELECT tile, sum(CASE WHEN cond_id > 0 THEN 1 + type_id % 4 END)::DOUBLE AS w, sum(CASE WHEN cond_id = 1 THEN 1 + type_id % 4
 ELSE 0 END)::DOUBLE AS g, sum(CASE WHEN cond_id = 2 THEN 1 + type_id % 4 ELSE 0 END)::DOUBLE AS m, sum(CASE WHEN cond_id = 3 THEN 1 + type_id % 4
 ELSE 0 END)::DOUBLE AS b FROM fx_pixels GROUP BY tile),
 s AS (SELECT tile, g / w AS gut, m / w AS mittel, b / w AS schlecht FROM w)
 SELECT *, CASE WHEN schlecht >= 0.3e0 THEN 'schlecht' WHEN mittel + schlecht >= 0.2e0 OR schlecht >= 0.02e0 THEN 'mittel' WHEN gut IS NOT NULL
 THEN 'gut' END AS zustand FROM s""")
def tile_class_weighted(spark, sf_dir):
    px = fixture(spark, sf_dir, "fx_pixels")
    t = px.groupBy("tile", "type_id", "cond_id").agg(F.count(F.lit(1)).alias("n"))
    return markings.classify_tiles(t, (F.lit(1) + F.col("type_id") % 4).cast("double"))


# ---- laser points -----------------------------------------------------------------------------------

_GP = """SELECT l_orderkey, l_linenumber, x / 100e0 AS x, y / 100e0 AS y, CASE WHEN l_partkey % 3 = 0 THEN (CAST(floor(l_quantity) AS BIGINT) % 3) * 0.03e0
 WHEN l_partkey % 3 = 1 THEN (CAST(floor(l_quantity) AS BIGINT) % 40) * 0.02e0 ELSE 7.5e0 END + 100e0 AS z FROM fx_samples"""


@query(cte("fx_samples") + f""", p AS ({_GP}), k AS (SELECT *, floor(x / 0.2e0) AS bx, floor(y / 0.2e0) AS by_ FROM p), e AS (SELECT bx, by_,
 min(z) AS lo, ceil((max(z) - min(z)) / 0.02e0) AS nb FROM k GROUP BY ALL),
 h AS (SELECT k.*, lo, nb, least(floor((z - lo) / 0.02e0), nb - 1) AS bz FROM k JOIN e USING (bx, by_)), c AS (SELECT bx, by_, bz, count(*) AS n
 FROM h WHERE nb > 0 GROUP BY ALL),
 f AS (SELECT bx, by_, coalesce(min(bz) FILTER (WHERE n > 10), 0) AS first FROM c GROUP BY ALL), r AS (SELECT c.*,
 row_number() OVER (PARTITION BY c.bx, c.by_ ORDER BY n DESC, bz) AS r FROM c JOIN f USING (bx, by_) WHERE bz BETWEEN first AND first + 9),
 m AS (SELECT bx, by_, bz AS mode FROM r WHERE r = 1)
 SELECT l_orderkey, l_linenumber, x, y, z FROM h LEFT JOIN m USING (bx, by_) WHERE nb = 0 OR (z >= lo + least(greatest(mode - 2, 0), nb) * 0.02e0
 AND z < lo + least(mode + 3, nb) * 0.02e0)""")
def ground_filter(spark, sf_dir):
    """Ground points by the height histogram of each 0.2 m bin."""
    return lidar.ground(spark.sql(_GP.replace("fx_samples", "{s}"), s=fixture(spark, sf_dir, "fx_samples")))


_POINTS = "p AS (SELECT DISTINCT point_id, x, y, z FROM point_cloud)"
_CELL3 = "n AS (SELECT point_id, x, y, z, floor(x / {0}) + dx AS cx, floor(y / {0}) + dy AS cy FROM p, (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy))"


@query("WITH " + _POINTS + ", " + _CELL3.format("0.5e0") + """, c AS (SELECT p.point_id, count(*) AS k FROM p JOIN n ON n.cx = floor(p.x / 0.5e0) AND n.cy = floor(p.y / 0.5e0)
 WHERE n.point_id % 5 = 0 AND (p.x - n.x) * (p.x - n.x) + (p.y - n.y) * (p.y - n.y) + (p.z - n.z) * (p.z - n.z) < 0.25e0 GROUP BY p.point_id)
 SELECT point_id, x, y, z FROM p WHERE point_id NOT IN (SELECT point_id FROM c WHERE k >= 4)""")
def outlier_filter(spark, sf_dir):
    """Points with fewer than 20 // 5 of every fifth point within 0.5 m in space."""
    return lidar.outliers(table(spark, sf_dir, "point_cloud").select("point_id", "x", "y", "z").distinct(), "point_id")


_REC = "r AS (SELECT rec_id, min(x) AS x, min(y) AS y FROM recordings GROUP BY rec_id)"
_KNN = "WITH " + _POINTS + ", " + _REC + ", " + _CELL3.format("5e0") + """, d AS (SELECT r.rec_id, n.point_id, n.z,
 (r.x - n.x) * (r.x - n.x) + (r.y - n.y) * (r.y - n.y) AS d2 FROM r JOIN n ON n.cx = floor(r.x / 5e0) AND n.cy = floor(r.y / 5e0)),
 k AS (SELECT *, CAST(row_number() OVER (PARTITION BY rec_id ORDER BY d2, point_id) AS INT) AS rank FROM d WHERE d2 <= 25e0)"""


def _rec_points(spark, sf_dir):
    rec = table(spark, sf_dir, "recordings").groupBy("rec_id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    pts = table(spark, sf_dir, "point_cloud").select("point_id", F.col("x").alias("rx"), F.col("y").alias("ry"), "z").distinct()
    return rec, pts


@query(_KNN + " SELECT rec_id, point_id, rank FROM k WHERE rank <= 7")
def nearest_k_points(spark, sf_dir):
    """The seven laser points nearest to each recording, at most 5 m away."""
    rec, pts = _rec_points(spark, sf_dir)
    return lidar.nearest(rec, pts, "rec_id", "point_id", 5.0, 7).select("rec_id", "point_id", "rank")


@query(_KNN + """, h AS (SELECT rec_id, CASE WHEN count(*) FILTER (WHERE d2 = 0) > 0 THEN avg(z) FILTER (WHERE d2 = 0) ELSE sum(z / nullif(d2,
 0)) / sum(1e0 / nullif(d2, 0)) END AS z FROM k WHERE rank <= 10 GROUP BY rec_id) SELECT r.rec_id, CAST(floor(h.z * 1e6 + 0.5e0) AS BIGINT) AS z_um
 FROM r LEFT JOIN h ON h.rec_id = r.rec_id""")
def idw_height(spark, sf_dir):
    """Height at each recording from the ten nearest laser points, weighted by 1 / d², in micrometres."""
    rec, pts = _rec_points(spark, sf_dir)
    h = lidar.inverse_distance_height(rec, pts, "rec_id", "point_id", 5.0, 10)
    return h.select("rec_id", F.floor(F.col("z") * 1e6 + 0.5).cast("bigint").alias("z_um"))


# ---- tables -----------------------------------------------------------------------------------------

@query("""SELECT DISTINCT area_id, coalesce(CASE WHEN NOT isnan(msptl) THEN msptl END, CASE WHEN NOT isnan(msptr) THEN msptr END, CASE
 WHEN NOT isnan(mspt) THEN mspt END) AS v FROM strassenzustand""")
def coalesce_projection(spark, sf_dir):
    return table(spark, sf_dir, "strassenzustand").select("area_id", relational.first_known(F.col("msptl"), F.col("msptr"), F.col("mspt")).alias("v")).distinct()


@query("""SELECT s.s_suppkey, coalesce(n.acct, s.s_acctbal) AS s_acctbal FROM supplier s LEFT JOIN (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0
 THEN s_acctbal + 1 END AS acct FROM supplier WHERE s_suppkey % 3 = 0) n ON n.s_suppkey = s.s_suppkey""")
def table_update(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    changes = s.filter("s_suppkey % 3 = 0").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal") + 1).alias("s_acctbal"))
    return relational.update(s, changes, ["s_suppkey"])


@query("""SELECT DISTINCT area_id, bw, riss, ofs FROM strassenzustand WHERE bw = 'A' AND NOT coalesce(isnan(riss), false) AND NOT coalesce(isnan(ofs),
 false) UNION ALL SELECT DISTINCT area_id, bw, NULL, ofs FROM strassenzustand WHERE bw = 'P' AND NOT coalesce(isnan(ofs), false)""")
def union_missing_columns(spark, sf_dir):
    d = table(spark, sf_dir, "strassenzustand").filter("not coalesce(isnan(ofs), false)")
    a = d.filter("bw = 'A' and not coalesce(isnan(riss), false)").select("area_id", "bw", "riss", "ofs").distinct()
    return relational.stack(a, d.filter("bw = 'P'").select("area_id", "bw", "ofs").distinct())


@query("""WITH a AS (SELECT DISTINCT doc_id, lang, branch FROM documents), b AS (SELECT lang, branch, count(*) AS n FROM documents GROUP BY ALL)
 SELECT a.doc_id, a.lang, a.branch, b.n FROM a JOIN b ON a.lang IS NOT DISTINCT FROM b.lang AND a.branch IS NOT DISTINCT FROM b.branch""")
def natural_join_nullsafe(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return relational.natural_join(d.select("doc_id", "lang", "branch").distinct(), d.groupBy("lang", "branch").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT DISTINCT s.substance_id, s.tile_id FROM substance s WHERE s.tile_id NOT IN (SELECT tile_id FROM cache_files WHERE table_name = 'Substance' AND tile_id IS NOT NULL)")
def skip_done_tiles(spark, sf_dir):
    """Damage objects of tiles that no cache file covers."""
    work = table(spark, sf_dir, "substance").select("substance_id", "tile_id").filter("tile_id is not null").distinct()
    return relational.skip_done(work, table(spark, sf_dir, "cache_files").filter("table_name = 'Substance' and tile_id is not null"), "tile_id")


@query(cte("fx_heights") + " SELECT cluster, idx, z FROM fx_heights WHERE idx % 5 = 0")
def every_fifth_sample(spark, sf_dir):
    return relational.every_nth(fixture(spark, sf_dir, "fx_heights"), "idx", 5)


@query("SELECT DISTINCT point_id, CAST(round(gps_time * 1e6) AS BIGINT) + 1315964800000000 AS utc_us FROM point_cloud WHERE gps_time IS NOT NULL")
def gps_to_utc(spark, sf_dir):
    p = table(spark, sf_dir, "point_cloud").filter("gps_time is not null")
    return p.select("point_id", scalars.utc_micros(F.col("gps_time")).alias("utc_us")).distinct()


@query("WITH " + checks.instants() + """, r AS (SELECT DISTINCT CAST(regexp_extract(run_id, '^run_([0-9]+)$', 1) AS BIGINT) AS run, rec_id,
 utc_us::DOUBLE AS t FROM recordings JOIN ts USING (time_stamp) WHERE regexp_matches(run_id, '^run_[0-9]+$')),
 p AS (SELECT DISTINCT point_id, point_source_id AS run, CAST(round(gps_time * 1e6) AS BIGINT) + 1315964800000000 AS t FROM point_cloud WHERE gps_time IS NOT NULL),
 d AS (SELECT point_id, rec_id, row_number() OVER (PARTITION BY point_id, p.t ORDER BY abs(p.t - r.t), r.t, rec_id) AS n FROM p LEFT
 JOIN r ON r.run = p.run) SELECT point_id, rec_id FROM d WHERE n = 1""")
def nearest_in_time(spark, sf_dir):
    """The recording of its run nearest in time to each laser point, however far."""
    from pavelens.plans.dataset import recording_instants

    r = recording_instants(spark, sf_dir, ["rec_id", "run_id"])
    r = r.select(F.regexp_extract("run_id", r"^run_(\d+)$", 1).try_cast("bigint").alias("run"), F.col("utc_us").alias("t"), F.col("rec_id").alias("recording_id"), "rec_id").filter("run is not null").distinct()
    p = table(spark, sf_dir, "point_cloud").filter("gps_time is not null")
    p = p.select(F.col("point_source_id").cast("bigint").alias("run"), scalars.utc_micros(F.col("gps_time")).alias("t"), "point_id").distinct()
    return lidar.nearest_in_time(p, r, "run", ("rec_id",)).select("point_id", "rec_id")


@query("WITH " + checks.instants() + " SELECT DISTINCT rec_id, utc_us / 1e6 - 1315964800.0e0 AS gps FROM recordings JOIN ts USING (time_stamp)")
def utc_to_gps(spark, sf_dir):
    """Recording times as seconds of the laser points' clock."""
    from pavelens.plans.dataset import recording_instants

    return recording_instants(spark, sf_dir, ["rec_id"]).select("rec_id", scalars.gps_seconds(F.timestamp_micros("utc_us")).alias("gps")).distinct()


@query("""SELECT DISTINCT point_id, CAST(floor(least(greatest(intensity, 0), 65535) / 256e0) AS INT) AS intensity8,
 CAST(floor(least(greatest((z - (SELECT min(z) FROM point_cloud)) / 100e0, 0e0), 1e0) * 65535) AS INT) AS height16 FROM point_cloud""")
def raster_codes(spark, sf_dir):
    """Intensities as bytes and heights above the lowest point as 16-bit numbers."""
    p = table(spark, sf_dir, "point_cloud").select("point_id", "z", "intensity")
    low = F.lit(p.agg(F.min("z")).first()[0]).cast("double")
    return p.select("point_id", scalars.intensity_byte(F.col("intensity")).alias("intensity8"), scalars.height_code(F.col("z"), low).alias("height16")).distinct()


@query("SELECT DISTINCT rec_id, image_id, substr(image_id, 1, 6) AS folder FROM recordings")
def image_folders(spark, sf_dir):
    return table(spark, sf_dir, "recordings").select("rec_id", "image_id", scalars.image_folder(F.col("image_id")).alias("folder")).distinct()


_S2 = lambda c: f"CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) THEN {_R2.format(c)} END"


@query(lambda: f"SELECT DISTINCT area_id, {', '.join(f'{_S2(c)} AS {c.upper()}' for c in ('riss', 'afli', 'ofs'))} FROM strassenzustand")
def substance_projection(spark, sf_dir):
    """The norm's three substance columns, rounded."""
    d = table(spark, sf_dir, "strassenzustand").select("area_id", *[scalars.nan_to_null(F.col(c)).alias(c) for c in ("riss", "afli", "ofs")])
    return polygons.substance_columns(d).distinct()


@query("SELECT DISTINCT r.rec_id, r.run_id, r.x, r.y FROM recordings r WHERE r.image_id IN (SELECT image_id FROM recordings WHERE height < 300)")
def points_of_layer(spark, sf_dir):
    """Recording points of the images of one height layer."""
    r = table(spark, sf_dir, "recordings")
    layer = r.filter("height < 300").select(F.col("image_id").alias("recording_id"))
    points = r.select("rec_id", "run_id", "x", "y", F.col("image_id").alias("recording_id")).distinct()
    return sampling.of_layer(points, layer).select("rec_id", "run_id", "x", "y").distinct()


_BOX = "SELECT rec_id, min(x) - 3 AS x0, min(y) - 3 AS y0, min(x) + 3 AS x1, min(y) + 3 AS y1 FROM recordings GROUP BY rec_id"
_EDGE_CROSSES = " OR ".join(
    f"(((e.y > {h}) <> (e.v > {h})) AND e.x + ({h} - e.y) * (e.u - e.x) / nullif(e.v - e.y, 0) BETWEEN b.x0 AND b.x1)" for h in ("b.y0", "b.y1")
) + " OR " + " OR ".join(f"(((e.x > {w}) <> (e.u > {w})) AND e.y + ({w} - e.x) * (e.v - e.y) / nullif(e.u - e.x, 0) BETWEEN b.y0 AND b.y1)" for w in ("b.x0", "b.x1"))


@query(f"""WITH {checks.shapes('ar', 'strassenzustand', 'area_id')}, b AS ({_BOX}),
 c AS (SELECT b.*, a.k, a.id FROM b JOIN ar_b a ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0),
 t AS (SELECT b.rec_id, b.k, b.id, bool_or(e.x BETWEEN b.x0 AND b.x1 AND e.y BETWEEN b.y0 AND b.y1) AS corner, bool_or({_EDGE_CROSSES}) AS crossed,
  count(*) FILTER (WHERE (e.y > b.y0) <> (e.v > b.y0) AND b.x0 < (e.u - e.x) * (b.y0 - e.y) / nullif(e.v - e.y, 0) + e.x) % 2 = 1 AS inn FROM c b
 JOIN ar_e e ON e.k = b.k GROUP BY b.rec_id, b.k, b.id)
 SELECT DISTINCT rec_id, id AS area_id FROM t WHERE corner OR crossed OR inn""")
def boxes_in_areas(spark, sf_dir):
    """6 m boxes around recordings and the areas that they meet."""
    r = table(spark, sf_dir, "recordings").groupBy("rec_id").agg(F.min("x").alias("x"), F.min("y").alias("y")).filter("rec_id is not null")
    boxes = r.selectExpr("rec_id", "x - 3 AS x0", "y - 3 AS y0", "x + 3 AS x1", "y + 3 AS y1")
    own = table(spark, sf_dir, "strassenzustand").select("area_id", "geometry").distinct()
    return polygons.boxes_in_areas(boxes, own, ["area_id"], largest=10.0).select("rec_id", "area_id").distinct()


@query(f"""WITH {checks.shapes('ar', 'strassenzustand', 'area_id')}, q AS (SELECT r.point_id AS p, r.x, r.y, b.k, b.id FROM (SELECT DISTINCT point_id,
 x, y FROM point_cloud) r JOIN ar_b b ON r.x > b.x0 AND r.x < b.x1 AND r.y > b.y0 AND r.y < b.y1),
 t AS (SELECT q.p, q.id, q.k, count(*) FILTER (WHERE (e.y > q.y) <> (e.v > q.y) AND q.x < (e.u - e.x) * (q.y - e.y) / nullif(e.v - e.y,
 0) + e.x) % 2 = 1 AS inn FROM q JOIN ar_e e ON e.k = q.k GROUP BY q.p, q.id, q.k)
 SELECT DISTINCT p AS point_id, id AS area_id FROM t WHERE inn""")
def points_in_polygons(spark, sf_dir):
    """Laser points and the areas with holes and pieces that they lie in."""
    p = table(spark, sf_dir, "point_cloud").select("point_id", "x", "y").distinct()
    own = table(spark, sf_dir, "strassenzustand").select("area_id", "geometry").distinct()
    return polygons.points_in_areas(p, own, ["area_id"]).select("point_id", "area_id").distinct()


_TILES = "t AS (SELECT DISTINCT CAST(floor({0}.x / 50) * 50 AS BIGINT) AS tile_x, CAST(floor({0}.y / 50) * 50 AS BIGINT) AS tile_y FROM {0})"
_MESH = "m AS (SELECT tile_x, tile_y, r, c, tile_x + (c + 0.5e0) * {0} AS x, tile_y + (r + 0.5e0) * {0} AS y FROM t, range({1}) a(r), range({1}) b(c))"


def _mesh(df: DataFrame, cells: int) -> DataFrame:
    tiles = lidar.retile(df, 50.0).select("tile_x", "tile_y").distinct()
    m = raster.mesh(tiles, 50.0, cells)
    return m.withColumn("cell_id", (F.col("tile_x") * 100_000_000 + F.col("tile_y")) * 1_000 + F.col("cell"))


@query("WITH " + _POINTS + ", " + _TILES.format("point_cloud") + ", " + _MESH.format("2.5e0", 20) + """, v AS (SELECT DISTINCT point_id, x, y, z,
 intensity::DOUBLE AS intensity FROM point_cloud),
 d AS (SELECT m.tile_x, m.tile_y, r, c, z, intensity, row_number() OVER (PARTITION BY m.tile_x, m.tile_y, r, c
 ORDER BY (m.x - v.x) * (m.x - v.x) + (m.y - v.y) * (m.y - v.y), point_id) AS n
  FROM v JOIN m ON m.x BETWEEN v.x - 1 AND v.x + 1 AND m.y BETWEEN v.y - 1 AND v.y + 1 AND m.tile_x BETWEEN v.x - 51 AND v.x + 1
 AND (m.x - v.x) * (m.x - v.x) + (m.y - v.y) * (m.y - v.y) <= 1)
 SELECT tile_x, tile_y, r AS "row", c AS col, z, intensity FROM d WHERE n = 1""")
def grid_from_points(spark, sf_dir):
    """Height and intensity of the nearest laser point to each cell of a 2.5 m raster, up to 1 m away."""
    p = table(spark, sf_dir, "point_cloud").filter("x is not null and y is not null and not isnan(x) and not isnan(y)")
    tiles = lidar.retile(p.select("x", "y"), 50.0).select("tile_x", "tile_y").distinct()
    p = p.select("point_id", F.col("x").alias("rx"), F.col("y").alias("ry"), "z", F.col("intensity").cast("double").alias("intensity"))
    near = raster.mesh_values(tiles, p, 50.0, 20, "point_id", ("z", "intensity"))
    return near.select("tile_x", "tile_y", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), "z", "intensity")


@query("WITH r0 AS (SELECT rec_id, min(x) AS x, min(y) AS y FROM recordings GROUP BY rec_id), " + _TILES.format("r0") + ", " + _MESH.format("12.5e0", 4) + """,
 k AS (SELECT *, floor(x / 60e0) AS kx, floor(y / 60e0) AS ky FROM m), n AS (SELECT rec_id, x, y, floor(x / 60e0) + dx AS kx,
 floor(y / 60e0) + dy AS ky FROM r0, (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy)),
 d AS (SELECT k.tile_x, k.tile_y, r, c, n.rec_id, CAST(row_number() OVER (PARTITION BY k.tile_x, k.tile_y, r, c
 ORDER BY (k.x - n.x) * (k.x - n.x) + (k.y - n.y) * (k.y - n.y), rec_id) AS INT) AS rank
  FROM k JOIN n ON n.kx = k.kx AND n.ky = k.ky WHERE (k.x - n.x) * (k.x - n.x) + (k.y - n.y) * (k.y - n.y) <= 3600)
 SELECT tile_x, tile_y, r AS "row", c AS col, rec_id, rank FROM d WHERE rank <= 7""")
def nearest_recordings(spark, sf_dir):
    """The seven recordings nearest to each cell of a 12.5 m raster, up to 60 m away."""
    r = table(spark, sf_dir, "recordings").groupBy("rec_id").agg(F.min("x").alias("rx"), F.min("y").alias("ry")).filter("rec_id is not null")
    cells = _mesh(r.select(F.col("rx").alias("x"), F.col("ry").alias("y")), 4)
    near = raster.nearest_recordings(cells, r, "cell_id", "rec_id", 7, 60.0)
    own = cells.select("cell_id", "tile_x", "tile_y", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"))
    return near.join(own, "cell_id").select("tile_x", "tile_y", "row", "col", "rec_id", "rank")


@query(_PX + """, s AS (SELECT tile, count(*) FILTER (WHERE cond_id = 2) * 100e0 / count(*) FILTER (WHERE cond_id > 0) AS mittel,
 count(*) FILTER (WHERE cond_id = 3) * 100e0 / count(*) FILTER (WHERE cond_id > 0) AS schlecht FROM fx_pixels
 GROUP BY tile HAVING count(*) FILTER (WHERE cond_id > 0) > 0)
 SELECT *, CASE WHEN schlecht / 100e0 >= 0.3e0 THEN 'schlecht' WHEN (mittel + schlecht) / 100e0 >= 0.6e0 THEN 'mittel' ELSE 'gut' END AS zustand
 FROM s""")
def reclassify_markings(spark, sf_dir):
    """Stored markings classified anew with other thresholds."""
    stored = markings.classify_markings(fixture(spark, sf_dir, "fx_pixels"), ["tile"]).select("tile", "mittel", "schlecht", "zustand")
    return markings.reclassify_markings(stored, 0.6, 0.3)


@query("SELECT DISTINCT rec_id, CAST(floor(atan(tan(radians(height / 100 - 9)) * sin(radians(51))) * 1e6) AS BIGINT) AS urad FROM recordings WHERE height IS NOT NULL")
def grid_convergence(spark, sf_dir):
    """Meridian convergence in microradians at made-up longitudes."""
    angle = scalars.convergence(F.col("height") / 100, F.lit(51.0))
    return table(spark, sf_dir, "recordings").filter("height is not null").select("rec_id", F.floor(angle * 1e6).cast("bigint").alias("urad")).distinct()


@query("""WITH p AS (SELECT DISTINCT point_id, x - floor(x / 50) * 50 - 25 AS dx, y - floor(y / 50) * 50 - 25 AS dy, z / 50 - 3 AS dz FROM point_cloud)
 SELECT point_id, CAST(trunc((atan2(dx, dy) + pi() + 0.01e0) / (2 * pi()) * 4096) AS INT) % 4096 AS px, CAST(trunc(atan2(sqrt(dx * dx + dy * dy),
 dz) / pi() * 2048) AS INT) AS py FROM p""")
def panorama_pixels(spark, sf_dir):
    """Where panoramas in the middle of each tile see the laser points."""
    p = table(spark, sf_dir, "point_cloud").select("point_id", "x", "y", "z").distinct()
    dx, dy = (F.col(c) - F.floor(F.col(c) / 50) * 50 - 25 for c in ("x", "y"))
    px, py = scalars.panorama_pixel(dx, dy, F.col("z") / 50 - 3, F.lit(0.01), 4096, 2048)
    return p.select("point_id", px.alias("px"), py.alias("py"))


# ---- what SQL can't say: checked against brute force in the tests ------------------------------------

@query()
def height_layers(spark, sf_dir):
    """Drive lines of each 50 m tile put into height layers."""
    r = table(spark, sf_dir, "recordings").select("run_id", F.col("image_id").cast("bigint").alias("image_no"), "x", "y", "height").filter("run_id is not null and image_id is not null")
    one = r.groupBy("run_id", "image_no").agg(*[F.min(c).alias(c) for c in ("x", "y", "height")])
    tiles = lidar.retile(one).withColumn("tile", F.concat_ws("_", "tile_x", "tile_y"))
    lines = tiles.withColumn("line", F.xxhash64("run_id", F.floor(F.col("image_no") / 1_000)))
    return lidar.height_layers(lines.select("tile", "line", "x", "y", "height"))


def _polygon_share(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    damage = table(spark, sf_dir, "substance").select("substance_id", "typ", "geometry").distinct()
    ground = table(spark, sf_dir, "strassenzustand").select("area_id", "bw", "geometry").distinct()
    return polygons.damaged_share(ground, damage, mode)


@query()
def polygon_damage_percent(spark, sf_dir):
    """Damaged share of the asphalt areas from the damage polygons, on the 1 m raster."""
    return _polygon_share(spark, sf_dir, "A")


@query()
def polygon_damage_percent_paved(spark, sf_dir):
    return _polygon_share(spark, sf_dir, "P")


@query()
def sampling_points(spark, sf_dir):
    """Sampling points along the drive lines of the recordings."""
    d = sequences.islands(_shots(spark, sf_dir), ["run_id"], "image_no", "x", "y", (4.0, 6.0), block=4096)
    lines = d.select(F.xxhash64("run_id", "cluster").alias("cluster"), "image_no", F.col("image_no").cast("string").alias("recording_id"), "x", "y")
    return sampling.sampling_points(lines)


@query()
def transverse_profile(spark, sf_dir):
    """Ruts, water depths and gradient of profiles of 25 heights, with gaps and kerbs."""
    h = fixture(spark, sf_dir, "fx_heights")
    z = F.when(F.col("idx") % 7 != 3, F.lit(50.0) + F.col("z") / 1e7)
    rows = h.select("cluster", F.floor(F.col("idx") / 25).cast("bigint").alias("profile"), F.struct((F.col("idx") % 25).alias("lane"), z.alias("z")).alias("s"))
    profiles_ = rows.groupBy("cluster", "profile").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["z"]).alias("heights"))
    return profiles_.withColumn("t", profiles.transverse(F.col("heights"))).select("cluster", "profile", "t.*")


_FILL = cte("fx_heights") + """, h AS (SELECT cluster, idx, CASE WHEN idx % 7 IN (2, 3) OR idx < 2 THEN NULL ELSE z END AS z FROM fx_heights),
 v AS (SELECT * FROM h WHERE z IS NOT NULL),
 n AS (SELECT h.cluster, h.idx, h.z, (SELECT max(idx) FROM v WHERE v.cluster = h.cluster AND v.idx < h.idx) AS p1, (SELECT min(idx) FROM v
 WHERE v.cluster = h.cluster AND v.idx > h.idx) AS n1 FROM h),
 m AS (SELECT n.*, (SELECT max(idx) FROM v WHERE v.cluster = n.cluster AND v.idx < n.p1) AS p2, (SELECT min(idx) FROM v WHERE v.cluster = n.cluster
 AND v.idx > n.n1) AS n2 FROM n),
 e AS (SELECT *, CASE WHEN p1 IS NOT NULL AND n1 IS NOT NULL THEN p1 WHEN p1 IS NOT NULL THEN p2 ELSE n1 END AS a, CASE WHEN p1 IS NOT NULL
 AND n1 IS NOT NULL THEN n1 WHEN p1 IS NOT NULL THEN p1 ELSE n2 END AS b FROM m)
 SELECT e.cluster, e.idx, CASE WHEN e.p1 IS NULL AND e.n1 IS NULL THEN NULL WHEN e.z IS NOT NULL THEN e.z
 ELSE va.z + (vb.z - va.z) * (e.idx - va.idx)::DOUBLE / (vb.idx - va.idx)::DOUBLE END AS z
 FROM e LEFT JOIN v va ON va.cluster = e.cluster AND va.idx = e.a LEFT JOIN v vb ON vb.cluster = e.cluster AND vb.idx = e.b"""


@query(_FILL)
def interpolate_heights(spark, sf_dir):
    """Gaps along a lane filled in, beyond its ends too."""
    h = fixture(spark, sf_dir, "fx_heights").withColumn("z", F.when(~((F.col("idx") % 7).isin(2, 3) | (F.col("idx") < 2)), F.col("z")))
    return profiles.fill_along(h, ["cluster"], "idx", "z", block=16)


@query()
def cell_regions(spark, sf_dir):
    """Connected regions of pixels of equal type in masks of 32 cells across, outlined; see type_masks."""
    return raster.vectorise(type_masks(fixture(spark, sf_dir, "fx_pixels")), True, 1.0)


def type_masks(pixels: DataFrame, rows: int = 1_024) -> DataFrame:
    """pixels(tile, type_id) → masks in which every pixel is once, in order of its type, zeros after the last.

    Only counts per tile and type are gathered. A tile of more than `rows` rows goes on in masks <tile>/1, <tile>/2, …
    that lie below one another; a region that crosses from one to the next is outlined in both.
    """
    size = 32 * rows
    w = W.partitionBy("tile").orderBy("type_id")
    runs = pixels.filter("type_id is not null").groupBy("tile", "type_id").agg(F.count(F.lit(1)).alias("n")).withColumn("end", F.sum("n").over(w))
    part = F.explode(F.sequence(F.floor((F.col("end") - F.col("n")) / size), F.floor((F.col("end") - 1) / size)))
    runs = runs.withColumn("part", part).withColumn("n", F.least("end", (F.col("part") + 1) * size) - F.greatest(F.col("end") - F.col("n"), F.col("part") * size))
    parts = runs.groupBy("tile", "part").agg(F.array_sort(F.collect_list(F.struct("type_id", "n"))).alias("r"))
    parts = parts.select("tile", "part", F.col("r.type_id").alias("types"), F.col("r.n").alias("counts"))

    def masks(batches):
        for b in batches:
            out = []
            for tile, part, types, counts in b.itertuples(index=False):
                t = np.repeat(np.asarray(types) % 3, counts).astype(np.uint8)
                height = -(-len(t) // 32)
                out.append((f"{tile}/{part}" if part else str(tile), 0.0, 32.0 - part * rows, height, 32, np.pad(t, (0, height * 32 - len(t))).tobytes()))
            yield pd.DataFrame(out, columns=["tile_id", "x0", "y1", "height", "width", "mask"])

    return parts.mapInPandas(masks, "tile_id string, x0 double, y1 double, height int, width int, mask binary")


ORACLES |= {name: sql if isinstance(sql, str) else sql() for name, sql in _SQL.items()}
