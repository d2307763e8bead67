"""Every query of the training-data operators that has SQL gives the same rows as that SQL in another engine."""

import os

import pytest

from millrace.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, name):
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    df = queries.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = c.sql(queries.oracle_sql()[name])
    at = [want.columns.index(x) for x in cols]
    assert sorted(want.columns) == cols
    assert sorted([str(r[x]) for x in cols] for r in df.collect()) == sorted([str(r[i]) for i in at] for r in want.fetchall())
