"""Every query of the training-data operators runs over empty tables, all-null rows, and tables with null rows, repeats and clashing columns."""

import pytest

from millrace.llm import queries

EMPTY = {"p2_found", "p2_top", "p4_found", "p5_found", "p6_found", "p6_groups", "p7_found", "p7_by_month", "p8_ids", "p9_mix", "p10_found", "p1_sample"}


@pytest.mark.parametrize("kind", ["empty", "nulls", "mixed"])
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs(spark, odd_tables, name, kind):
    df = queries.queries()[name](spark, odd_tables[kind])
    assert len(set(df.columns)) == len(df.columns)
    got = df.collect()
    if kind == "empty" and name in EMPTY:
        assert got == []


def test_null_rows_change_nothing(spark, odd_tables, rows):
    """Rows of nulls and repeats add nothing to the found cases."""
    for name in ("p2_found", "p4_found", "p6_found", "p7_found"):
        assert not [r for r in queries.queries()[name](spark, odd_tables["nulls"]).collect()], name
