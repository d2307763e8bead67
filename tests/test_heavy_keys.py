from collections import Counter, defaultdict

import pytest

from millrace.operators import heavy_keys


def brute(data):
    n, seen, best = Counter(), defaultdict(set), {}
    for a, b, s, p, t in data:
        k = (a, b)
        n[k] += 1
        if s is not None:
            seen[k].add(s)
        if t is not None:
            rank = (-(p if p is not None and p == p else float("-inf")), t)
            best[k] = min(best.get(k, rank), rank)
    return sorted(((*k, n[k], len(seen[k]), best[k][1] if k in best else None) for k in n), key=str)


DATA = [("m", "x", f"s{i % 7}", float(i % 5), f"t{i:03d}") for i in range(900)] + [
    ("m", None, None, None, None), (None, "x", "s", float("nan"), "z"), (None, "x", "s", float("nan"), "a"), ("r", "x", "s", None, "q"), ("r", "x", "s", -1.0, "y"),
] + [(f"k{i}", "b", "s", 1.0, "t") for i in range(1300)]


@pytest.mark.parametrize("limit", [200_000, 10])
def test_totals_match_brute_force(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(heavy_keys, "MAX_BROADCAST_KEYS", limit)
    df = spark.createDataFrame(DATA, "a string, b string, s string, p double, t string").selectExpr("*", "1 as key_id", "2 as n", "3 as block")
    assert rows(heavy_keys.key_totals(df, ["a", "b"], "s", "p", "t")) == brute(DATA)


def test_empty(spark):
    df = spark.createDataFrame([], "a string, b string, s string, p double, t string")
    assert heavy_keys.key_totals(df, ["a", "b"], "s", "p", "t").count() == 0


def test_heavy_keys_of_a_large_dictionary_stay_out_of_the_shuffle(spark, monkeypatch):
    """The key of most rows meets its code by broadcast; only rows of other keys are joined by shuffle."""
    monkeypatch.setattr(heavy_keys, "MAX_BROADCAST_KEYS", 10)
    monkeypatch.setattr(heavy_keys, "HEAVY_KEYS", 3)
    df = spark.createDataFrame(DATA, "a string, b string, s string, p double, t string").select("a", "b")
    codes, small = heavy_keys.dictionary(df, ["a", "b"])
    top = heavy_keys.heavy(codes, ["a", "b"]).collect()
    assert not small and len(top) == 3 and (top[0]["a"], top[0]["b"], top[0]["key_rows"]) == ("m", "x", 900)
    coded = heavy_keys.encode(df, ["a", "b"], codes, small)
    assert coded.count() == len(DATA) and coded.groupBy("key_id").count().agg({"count": "max"}).first()[0] == 900
