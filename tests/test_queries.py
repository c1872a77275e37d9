"""Every query with SQL gives the rows of its SQL on the smallest tables; every query has a stable schema."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the generated tables aren't here")


def rows(it):
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return Counter(tuple(clean(v) for v in r) for r in it)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith(("p1_", "p2_", "p6_", "p7_", "p8_"))))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = c.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == cols
    assert rows(map(tuple, df.select(*cols).collect())) == rows(want.select(*[duckdb.ColumnExpression(x) for x in cols]).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
