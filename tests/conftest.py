import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session, ship_package

    s = local_session(4, partitions=4, app="tests")
    ship_package(s)
    yield s


@pytest.fixture
def rows():
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_tables(spark, tmp_path_factory):
    """Folders with the same tables: empty ones, ones whose rows are all null, and ones with null rows, repeats and further columns added."""
    if not os.path.isdir(DATA):
        pytest.skip("the test tables are not here")
    from pyspark.sql import functions as F

    out = {}
    for kind in ("empty", "nulls", "mixed"):
        d = tmp_path_factory.mktemp(kind)
        for f in os.listdir(DATA):
            t = spark.read.parquet(f"{DATA}/{f}")
            if kind == "empty":
                t = t.limit(0)
            else:
                gone = t.limit(3).select(*[F.lit(None).cast(t.schema[c].dataType).alias(c) for c in t.columns])
                t = gone if kind == "nulls" else t.limit(300).unionByName(t.limit(5)).unionByName(gone).selectExpr("*", "1 as n", "'x' as key", "2 as id", "3 as _r", "4 as kind", "5 as rank")
            t.coalesce(1).write.parquet(f"{d}/{f}")
        out[kind] = str(d)
    return out
