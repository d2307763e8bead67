import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import config
from millrace.operators import greedy, prompts, runner
from millrace.sources import files
from tests.test_planning import profile

SEEDS = "seed_id string, model_name string, level string, tier string, route_mode string, extension_family string, question string, answer string"


def seeds(spark):
    return spark.createDataFrame(
        [
            ("S1", "rebellion", "L1", "A", "core_paraphrase", None, "How does `grievance` grow?", "It grows with `perceived-hardship`."),
            ("S2", "rebellion", "L1", "A", "skip", None, "Finance?", "No."),
            ("S3", "rebellion", "L1", "B", "core_repair", None, "What is `threshold`?", "A limit for `agents`."),
            ("S4", "rebellion", "L1", "B", "core_repair", None, "how does  `GRIEVANCE` grow?", "It grows with `perceived-hardship`."),
        ],
        SEEDS,
    )


def plan(spark):
    s = seeds(spark)
    return s.select(F.sha1("seed_id").alias("task_key"), "seed_id", "model_name", "route_mode", "extension_family", F.lit("lexical_paraphrase").alias("transform_type"), "level", F.when(F.col("seed_id") == "S1", 2.0).otherwise(1.0).alias("priority"))


def test_run_and_resume(spark, tmp_path, rows):
    s = seeds(spark).drop("model_name", "level", "route_mode", "extension_family")
    first = runner.run(spark, plan(spark), s, profile(spark), prompts.echo, str(tmp_path / "r"), 10, 1, ["grievance"], max_tranches=1)
    assert [(x["tranche"], x["total"], x["accepted"]) for x in first] == [(0, 1, 1)]
    rest = runner.run(spark, plan(spark), s, profile(spark), prompts.echo, str(tmp_path / "r"), 10, 10, [])
    assert rest[0]["tranche"] == 1 and rest[0]["total"] == 3
    reasons = rows(runner._logs(spark, str(tmp_path / "r"), "rejected").select("seed_id", "reason"))
    assert reasons == [("S2", "UNKNOWN_MODE"), ("S4", "EXACT_QA_DUP")]
    assert rows(runner._logs(spark, str(tmp_path / "r"), "accepted").select("seed_id")) == [("S1",), ("S3",)]


def test_unreadable_log_is_an_error_and_stays(spark, tmp_path):
    log = tmp_path / "r" / "tranche_000" / "accepted"
    log.mkdir(parents=True)
    (log / "part-0.json.gz").write_bytes(b"no gzip at all")
    s = seeds(spark).drop("model_name", "level", "route_mode", "extension_family")
    with pytest.raises(Exception):
        runner.run(spark, plan(spark), s, profile(spark), prompts.echo, str(tmp_path / "r"), 10, 1, [])
    assert (log / "part-0.json.gz").read_bytes() == b"no gzip at all"


def test_a_written_tranche_is_not_overwritten(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    files.write_jsonl(df, str(tmp_path / "t"), fresh=True)
    with pytest.raises(Exception):
        files.write_jsonl(df.limit(0), str(tmp_path / "t"), fresh=True)
    assert spark.read.json(str(tmp_path / "t")).count() == 1
    assert files.exists(spark, f"{tmp_path}/*") and not files.exists(spark, f"{tmp_path}/none_*/x")


def brute(n, pairs):
    ok = {}
    for k in range(n):
        ok[k] = not any(ok[a] for a, b in pairs if b == k)
    return ok


def test_greedy_equals_the_sequential_rule(spark):
    r = random.Random(4)
    pairs = {tuple(sorted(r.sample(range(60), 2))) for _ in range(90)} | {(i, i + 1) for i in range(20)}
    rows = spark.createDataFrame([(i,) for i in range(60)], "k long")
    got = greedy.admit_in_order(rows, spark.createDataFrame(list(pairs), "earlier long, later long"), "k").collect()
    assert {x["k"]: x["accepted"] for x in got} == brute(60, pairs)
    assert all((x["by"] is None) == x["accepted"] for x in got)
    none = greedy.admit_in_order(rows, spark.createDataFrame([], "earlier long, later long"), "k")
    assert none.filter("accepted").count() == 60


def test_cosine_pairs_recall(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    near = base + rng.standard_normal((40, 16)) * 0.05
    data = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))] + [(100, None), (101, [1.0])]
    df = spark.createDataFrame(data, "k long, v array<double>")
    got = {(r["earlier"], r["later"]) for r in greedy.cosine_pairs(df, "k", "v", 0.98, 16).collect()}
    x = np.array([v for _, v in data[:80]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i in range(80) for j in range(i + 1, 80) if x[i] @ x[j] >= 0.98}
    assert got == want and len(want) > 30


def test_config():
    assert config.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert config.load("json:dumps")([1]) == "[1]" and config.load("json.dumps")([1]) == "[1]"
    with pytest.raises(ValueError):
        config.load("no.such:thing")
    assert config.build("builtins:dict", {"a": 1}) == {"a": 1}


def test_bits_grow_with_the_vectors():
    few, many = greedy.bits_and_bands(500, 0.985), greedy.bits_and_bands(10**8, 0.985)
    assert few[0] < many[0] <= 24 and few[1] < many[1]


def test_hot_keys_are_paired_in_blocks(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal(8)
    data = [(i, (base + rng.standard_normal(8) * 0.02).tolist()) for i in range(40)] + [(99, [0.0] * 8)]
    df = spark.createDataFrame(data, "k long, v array<double>")
    got = {(r["earlier"], r["later"]) for r in greedy.cosine_pairs(df, "k", "v", 0.9, 8, hot=7).collect()}
    assert got == {(i, j) for i in range(40) for j in range(i + 1, 40)}


def test_a_long_chain_is_settled(spark):
    n = 210
    got = greedy.admit_in_order(spark.range(n).withColumnRenamed("id", "k"), spark.createDataFrame([(0, 1), (1, 2), (2, 3), (0, 3)], "earlier long, later long"), "k")
    assert {r["k"]: r["accepted"] for r in got.collect() if r["k"] < 4} == {0: True, 1: False, 2: True, 3: False}


def test_all_gates_providers_and_logs(spark, tmp_path):
    s = seeds(spark).drop("model_name", "level", "route_mode", "extension_family")
    t = plan(spark).withColumn("provider_hint", F.when(F.col("seed_id") != "S2", F.lit("p1")))
    far = lambda df: df.select("task_key", F.when(F.col("seed_id") == "S3", "LOW_EMBED_SIM").alias("reason"))
    alike = lambda df: df.sparkSession.createDataFrame([], "earlier string, later string")
    out = runner.run(spark, t, s, profile(spark), {"p1": prompts.echo}, str(tmp_path / "r"), 10, 10, ["grievance"], nearest=far, conflicts=alike)
    assert out[0]["total"] == 4 and out[0]["accepted"] == 1
    reasons = {r["seed_id"]: r["reason"] for r in runner._logs(spark, str(tmp_path / "r"), "rejected").collect()}
    assert reasons == {"S2": "NO_RESPONSE", "S3": "LOW_EMBED_SIM", "S4": "EXACT_QA_DUP"}
    events = spark.read.json(str(tmp_path / "r" / "tranche_000" / "telemetry"))
    assert events.count() == 4 and events.filter("status = 'accepted'").count() == 1
    meta = spark.read.json(str(tmp_path / "r" / "tranche_000" / "batch_meta")).first()
    assert meta["providers"]["p1"]["requests"] == 3 and meta["providers"]["unknown"]["replies"] == 0


def test_near_duplicates_of_accepted_rows(spark):
    df = spark.createDataFrame([(f"k{i}", "rebellion", "core_repair", None, f"What is `threshold` {i}?", "A limit for `agents`.") for i in range(3)], "task_key string, model_name string, route_mode string, extension_family string, question string, answer string")
    pairs = lambda x: x.sparkSession.createDataFrame([("k0", "k1"), ("k1", "k2")], "earlier string, later string")
    got = {r["task_key"]: r["reason"] for r in runner.gate(prompts.echo(df), profile(spark), [], None, conflicts=pairs).collect()}
    assert got == {"k0": None, "k1": "NEAR_DUP_QUESTION", "k2": None}
