"""Sampling, top-n, caps and mixing against brute force, with nulls, ties, repeats, clashing columns and empty tables."""

import random
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import cap, draw, mixing, proportions, topn

R = random.Random(3)


def brute_top(data, n, full_only):
    best = defaultdict(dict)
    for g, i, s in data:
        if i is not None and s is not None:
            best[g][i] = max(best[g].get(i, s), s)
    out = []
    for g, items in best.items():
        if not full_only or len(items) > n:
            out += [(g, i) for i, _ in sorted(items.items(), key=lambda x: (-x[1], x[0]))[:n]]
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [50_000, 20])
@pytest.mark.parametrize("full_only", [False, True])
def test_top_n(spark, rows, heavy, full_only):
    data = [("hot", f"r{R.randint(0, 400)}", R.randint(-3, 9)) for _ in range(900)] + [(f"g{i % 40}", f"r{i % 9}", R.choice([None, 1, 1, 2])) for i in range(300)]
    data += [(None, f"n{i}", i % 3) for i in range(40)] + [("hot", None, 99), ("x", "only", 0)]
    df = spark.createDataFrame(data, "g string, i string, s int").selectExpr("*", "'z' as rank", "1 as _g", "2 as _r")
    assert rows(topn.top_n(df, "g", "i", "s", 5, full_only, heavy_rows=heavy).select("g", "i")) == brute_top(data, 5, full_only)


def test_top_n_nan_and_empty(spark, rows):
    df = spark.createDataFrame([("g", "a", float("nan")), ("g", "b", 1.0)], "g string, i string, s double")
    assert rows(topn.top_n(df, "g", "i", "s", 3)) == [("g", "b", 1.0, 1)]
    assert topn.top_n(df.limit(0), "g", "i", "s", 3).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.floats(0, 9)), min_size=1, max_size=8), st.integers(0, 60))
def test_apportion(strata, limit):
    have = np.array([h for h, _ in strata])
    got = cap.apportion(limit, have, np.array([w for _, w in strata]))
    assert (got <= have).all() and (got >= 0).all() and got.sum() == min(limit, have.sum())


def test_apportion_shares_and_spare_slots():
    assert cap.apportion(10, [100, 100, 100], np.array([5, 3, 2])).tolist() == [5, 3, 2]
    assert cap.apportion(10, [1, 100, 100], np.array([5, 3, 2])).tolist() == [1, 5, 4]


def _cap_frame(spark):
    data = [("hot", f"t{i:04d}", R.choice([None, 1.0, 2.0, 2.5, 3.0]), "ab"[i % 2]) for i in range(500)] + [("small", f"s{i}", 1.0, None) for i in range(4)] + [(None, f"n{i}", 1.0, "a") for i in range(30)]
    return data, spark.createDataFrame(data, "who string, task string, q double, topic string").selectExpr("*", "7 as stratum_rank", "8 as _stratum", "9 as _weight")


def order():
    return [F.col("q").desc_nulls_last(), F.col("task")]


def test_cap_by_bands_is_the_overall_best(spark, rows):
    data, df = _cap_frame(spark)
    band = F.floor(F.col("q") / 0.5)
    got = rows(cap.cap_per_contributor(df, "who", band, order(), cap=60, weight=F.coalesce(band, F.lit(-1000)), best_first=True, over_only=True).select("who", "task"))
    best = sorted((x for x in data if x[0] == "hot"), key=lambda x: (x[2] is None, -(x[2] or 0), x[1]))[:60]
    assert got == sorted((("hot", x[1]) for x in best), key=str)


def test_cap_over_topics_keeps_the_rest(spark):
    _, df = _cap_frame(spark)
    got = cap.cap_per_contributor(df, "who", F.col("topic"), order(), cap=60).collect()
    n = Counter((r["who"], r["topic"]) for r in got)
    assert n[("hot", "a")] == n[("hot", "b")] == 30 and n[("small", None)] == 4 and n[(None, "a")] == 30
    assert cap.cap_per_contributor(df.limit(0), "who", F.col("topic"), order(), cap=60).count() == 0
    part = cap.cap_per_contributor(df, "who", F.col("topic"), order(), share=0.1).collect()
    assert sum(r["who"] == "hot" for r in part) == int(534 * 0.1)


def test_prefix_is_exact_and_repeatable(spark, rows):
    df = spark.createDataFrame([("a" if i % 3 else "b", i, i % 7) for i in range(3000)] + [(None, -1, 1)], "g string, i int, w int").selectExpr("*", "1 as _h", "2 as _b")
    one = rows(draw.permuted_prefix(df, "g", F.col("i"), {"a": 501, "b": 5000, "c": 3}, 7))
    assert Counter(r[0] for r in one) == {"a": 501, "b": 1000}
    assert one == rows(draw.permuted_prefix(df.repartition(3), "g", F.col("i"), {"a": 501, "b": 5000}, 7))
    assert one != rows(draw.permuted_prefix(df, "g", F.col("i"), {"a": 501, "b": 5000}, 8))
    w = draw.permuted_prefix(df, "g", F.col("i"), {"a": 1000}, 7, F.col("w")).agg(F.sum("w")).first()[0]
    assert 1000 <= w <= 1006
    assert draw.permuted_prefix(df, "g", F.col("i"), {}, 7).count() == 0


TARGETS = [("mode", "x", 0.5, 5), ("mode", "y", 0.4, 5), ("mode", "z", 0.1, 3), ("tier", "A", 0.5, 0), ("tier", "B", 0.5, 0)]


def test_sample_matches_shares(spark):
    data = [(f"k{i}", "xyyyyyyyyq"[i % 10], "ABB"[i % 3]) for i in range(3000)] + [("z0", "z", "A"), ("z1", "z", None), (None, None, None)]
    df = spark.createDataFrame(data, "key string, mode string, tier string").withColumn("_leaf", F.lit(1))
    t = spark.createDataFrame(TARGETS, "dim string, category string, target_share double, min_rows int")
    got = proportions.sample_to_targets(df, F.col("key"), ["mode", "tier"], t, 0.1).collect()
    n = Counter(r["mode"] for r in got)
    assert len(got) == 300 and n["z"] == 2 and n["q"] == 0 and 150 <= n["x"] <= 178 and 120 <= n["y"] <= 148
    tier = Counter(r["tier"] for r in got)
    assert abs(tier["A"] - 150) <= 2
    rep = {(r["dim"], r["category"]): r for r in proportions.target_report(df, ["mode", "tier"], t, 0.1).collect()}
    assert rep["mode", "z"]["shortfall"] == 28 and rep["mode", "x"]["drawn"] == n["x"] and abs(sum(r["actual_share"] for (d, _), r in rep.items() if d == "mode") - 1) < 1e-9
    assert proportions.sample_to_targets(df.limit(0), F.col("key"), ["mode", "tier"], t, 0.1).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz")), st.integers(0, 40), min_size=1), st.integers(0, 90))
def test_allocation_is_whole_and_possible(leaves, n):
    got, moved = proportions.allocate(leaves, [{"a": 0.7, "b": 0.3}, {"x": 0.5, "y": 0.5}], [{"b": 4}, {"y": 3}], n)
    assert 0 <= moved and sum(got.values()) == min(n, sum(leaves.values())) and all(0 <= got[k] <= leaves[k] for k in leaves)


def test_the_tree_meets_targets_without_moving_rows():
    r = random.Random(3)
    leaves = {(a, b, c): r.choice([3, 40, 700, 9000]) for a in "pqrs" for b in "xyz" for c in "uvw"}
    targets = [{"p": 0.5, "q": 0.24, "r": 0.18, "s": 0.08}, {"x": 0.3, "y": 0.25, "z": 0.45}, {"u": 0.55, "v": 0.25, "w": 0.2}]
    n = sum(leaves.values()) // 10
    got, moved = proportions.allocate(leaves, targets, [{}, {}, {}], n)
    assert moved <= n // 100
    for d in (0, 1, 2):
        for c, share in targets[d].items():
            assert abs(sum(v for k, v in got.items() if k[d] == c) - n * share) <= 2


def test_allocation_is_near_the_best_one():
    r = random.Random(5)
    for _ in range(20):
        leaves = {(a, b): r.randint(0, 5) for a in "ab" for b in "xy"}
        targets, n = [{"a": 0.7, "b": 0.3}, {"x": 0.5, "y": 0.5}], r.randint(1, 8)
        n = min(n, sum(leaves.values()))
        err = lambda q: sum(abs(sum(v for k, v in q.items() if k[d] == c) - n * s) for d in (0, 1) for c, s in targets[d].items())  # noqa: B023, E731
        best = min((err(dict(zip(leaves, x, strict=True))) for x in product(*[range(v + 1) for v in leaves.values()]) if sum(x) == n), default=0)
        assert err(proportions.allocate(leaves, targets, [{}, {}], n)[0]) <= best + 1e-9


def test_largest_remainder_divides_whole_weights_exactly():
    assert cap.apportion(60, np.array([7, 100, 313]), np.array([7, 100, 313])).tolist() == [1, 14, 45]
    assert cap.apportion(10, np.array([1, 50, 50]), np.array([8.0, 1.0, 1.0])).tolist() == [1, 5, 4]
    assert cap.apportion(3, np.array([5, 5, 5]), np.zeros(3)).tolist() == [1, 1, 1]


def test_rank_with_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(draw, "BUCKET_ROWS", 10)
    df = spark.range(5000).select(F.lit("a").alias("g"), F.col("id").alias("i"))
    got = [x["i"] for x in draw.permuted_prefix(df, "g", F.col("i"), {"a": 1234}, 7).collect()]
    assert len(set(got)) == len(got) == 1234


def test_water_fill():
    got = mixing.water_fill(100, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 10, "b": 100, "c": 100}, {"a": 2, "b": 1, "c": 1})
    assert got["a"] == 20 and abs(got["b"] - 48) < 1e-9 and abs(got["c"] - 32) < 1e-9
    assert sum(mixing.water_fill(1000, {"a": 1.0, "b": 1.0}, {"a": 10, "b": 5}, {"a": 1, "b": 3}).values()) == 25


def test_mix(spark):
    data = [(i, "big", 10) for i in range(500)] + [(1000 + i, "small", 10) for i in range(10)] + [(2000, "nobody", 5), (2001, None, 5), (2002, "small", 0), (2003, "big", None)]
    df = spark.createDataFrame(data, "doc_id long, source string, tokens long").withColumn("copies", F.lit(9))
    t = spark.createDataFrame([("big", 0.8, 1), ("small", 0.1, 3), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    plan = mixing.plan_mix(df, t, "source", "tokens", total=1000)
    m = mixing.mix_sources(df, plan, "source", F.col("doc_id"), "tokens")
    by = {r["source"]: r for r in mixing.mix_report(m, plan, "source", "tokens").collect()}
    assert by["small"]["taken_tokens"] in (110, 120) and by["small"]["most_copies"] <= 3
    assert abs(by["big"]["taken_tokens"] - 890) <= 10 and by["gone"]["taken_tokens"] == 0 and by["gone"]["shortfall"] == 100
    assert set(r["source"] for r in m.collect()) == {"big", "small"}
    none = mixing.plan_mix(df.limit(0), t, "source", "tokens")
    assert mixing.mix_sources(df.limit(0), none, "source", F.col("doc_id"), "tokens").count() == 0
