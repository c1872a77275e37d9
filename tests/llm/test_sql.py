"""Every query of this subpackage with SQL gives the rows of its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from pavelens.llm import queries

import test_queries

DATA, rows = test_queries.DATA, test_queries.rows

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the generated tables aren't here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    df = queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = c.sql(queries.ORACLES[name])
    assert sorted(want.columns) == cols
    assert rows(map(tuple, df.select(*cols).collect())) == rows(want.select(*[duckdb.ColumnExpression(x) for x in cols]).fetchall())
