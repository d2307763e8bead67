"""Every query with SQL gives the same rows as that SQL in another engine, over the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith("p") or n.startswith("p3_"))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for f in os.listdir(DATA):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = duck.sql(entry.oracle_sql()[name])
    at = [want.columns.index(c) for c in cols]
    assert sorted(want.columns) == cols
    assert sorted([plain(r[c]) for c in cols] for r in df.collect()) == sorted([plain(r[i]) for i in at] for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
