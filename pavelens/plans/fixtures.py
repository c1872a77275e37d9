"""Views that give the generic test tables the shape of survey data; the same SQL runs on Spark and on the SQL check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pavelens.session import table

VIEWS = {
    "fx_areas": """SELECT p_partkey AS area_id, CASE WHEN p_partkey % 4 = 3 THEN 'P' ELSE 'A' END AS bw,
 CASE WHEN p_size % 3 = 0 THEN 'A' WHEN p_size % 3 = 1 THEN 'B' ELSE 'N' END AS fk,
 CAST((p_partkey % 50) * 20 AS DOUBLE) AS x0, CAST(floor(p_partkey / 50e0) * 20 AS DOUBLE) AS y0,
 CAST((p_partkey % 50) * 20 + 6 + (p_size % 15) AS DOUBLE) + 0.5e0 AS x1,
 CAST(floor(p_partkey / 50e0) * 20 + 5 + (p_size % 11) AS DOUBLE) + 0.25e0 AS y1 FROM {part}""",
    "fx_samples": """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, CAST((l_partkey % 50) * 20 AS DOUBLE) + l_discount * 200e0 AS x,
 CAST(floor(l_partkey / 50e0) * 20 AS DOUBLE) + l_quantity * 0.4e0 AS y,
 CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity / 5000e0 END AS depth_mid,
 CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice / 5000000e0 END AS rut_left,
 CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice / 4000000e0 END AS rut_right FROM {lineitem}""",
    "fx_heights": """SELECT user_id AS cluster, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS idx,
 CAST(floor(value * 1000e0) AS DOUBLE) AS z FROM {events}""",
    "fx_damage": """SELECT l_orderkey, l_linenumber, CAST((l_orderkey + l_linenumber) % 11 AS INT) AS typ_id,
 CAST((l_partkey % 50) * 20 AS DOUBLE) + l_quantity * 0.4e0 AS x0, CAST(floor(l_partkey / 50e0) * 20 AS DOUBLE) + l_discount * 150e0 AS y0,
 CAST((l_partkey % 50) * 20 AS DOUBLE) + l_quantity * 0.4e0 + l_tax * 10e0 AS x1,
 CAST(floor(l_partkey / 50e0) * 20 AS DOUBLE) + l_discount * 155e0 AS y1 FROM {lineitem}""",
    "fx_pixels": """SELECT user_id AS tile, CAST(event_id % 10 AS INT) AS type_id,
 CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END AS cond_id FROM {events}""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in ("part", "lineitem", "events") if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def cte(*names: str) -> str:
    """WITH clause of the views for the SQL check."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(part='part', lineitem='lineitem', events='events')})" for n in names)
