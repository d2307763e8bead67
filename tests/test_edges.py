"""Every core query runs over empty tables, all-null rows, and tables with null rows, repeats and columns of clashing names."""

import pytest

from millrace.plans import catalogue


@pytest.mark.parametrize("kind", ["empty", "nulls", "mixed"])
@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_runs(spark, odd_tables, name, kind):
    df = catalogue.queries()[name](spark, odd_tables[kind])
    assert len(set(df.columns)) == len(df.columns)
    df.collect()
