from pyspark.sql import functions as F

from millrace.operators import dedup, enrich, normalize, telemetry


def test_normalize_lists_every_issue(spark):
    df = spark.createDataFrame([(None, " ", None, None), ("corpus::a", "q", "a", "My Model")], "record_id string, question string, answer string, model_name string")
    got = {r["record_id"]: r for r in normalize.normalize(df, "corpus").collect()}
    assert got[None]["issues"] == ["MISSING_ID", "MISSING_MODEL", "MISSING_QUESTION", "MISSING_ANSWER"]
    assert got["corpus::a"]["issues"] == [] and got["corpus::a"]["model_name"] == "my_model"


def test_messages_fill_each_side_by_itself(spark):
    df = spark.createDataFrame([("q", None, [("user", " "), ("user", "u"), ("assistant", "a")])], "question string, answer string, messages array<struct<role:string,content:string>>")
    q, a = normalize.question_answer(df)
    assert df.select(q, a).first()[:] == ("q", "a")


def test_last_wins_and_fill(spark, rows):
    side = spark.createDataFrame([("k", "old", 1), ("k", "new", 2), (None, "x", 9)], "k string, v string, at int")
    assert rows(normalize.last_wins(side, "k", F.col("at")).select("v")) == [("new",)]
    seeds = spark.createDataFrame([("k", None), ("n", None), ("k", "own")], "id string, v string")
    assert rows(normalize.fill_from(seeds, side, "id", "k", ["v"], [F.col("at")])) == sorted([("k", "new", "filled"), ("n", None, "miss"), ("k", "own", "complete")], key=str)


def test_first_id_that_fits(spark, rows):
    r = spark.createDataFrame([("corpus::G", "S", None, "X"), ("r2", None, None, "")], "record_id string, seed_id string, global_id string, source_id string")
    look = spark.createDataFrame([("S", 1), ("G", 2)], "id string, class_id int")
    got = rows(enrich.join_first_id(r, look, "id").select("record_id", "found.class_id", "found_at"))
    assert got == [("corpus::G", 1, 1), ("r2", None, None)]


def test_gate_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "Q", "a"), (2, " q ", "A"), (3, "q", "b"), (4, "other", "a"), (5, None, None), (6, None, None)], "pos int, question string, answer string")
    v = {r["pos"]: r["verdict"] for r in dedup.gate_duplicates(df, "pos").collect()}
    assert v == {1: "ACCEPTED", 2: "EXACT_QA_DUP", 3: "QUESTION_TEMPLATE_DUP", 4: "ACCEPTED", 5: "ACCEPTED", 6: "EXACT_QA_DUP"}
    old = spark.createDataFrame([("q", "b")], "question string, answer string")
    v = {r["pos"]: r["verdict"] for r in dedup.gate_duplicates(df, "pos", history=old).collect()}
    assert v[1] == "QUESTION_TEMPLATE_DUP" and v[3] == "EXACT_QA_DUP" and v[4] == "ACCEPTED"


def test_stop_conditions(spark):
    def stop(total, bad_json=0, failed=0, dup=0, ok=None):
        df = spark.createDataFrame([(total, bad_json, failed, dup, total if ok is None else ok)], "t int, b int, f int, d int, a int")
        return df.select(telemetry.stop_reason(*[F.col(c) for c in "tbfda"])).first()[0]

    assert stop(0) == "EMPTY_TRANCHE"
    assert stop(100, bad_json=6) == "BAD_JSON_RATE=6.00%"
    assert stop(100, failed=6) == "LLM_ERROR_RATE=6.00%"
    assert stop(100, dup=26) == "TEMPLATE_DUP_RATE=26.00%"
    assert stop(100, ok=74) == "ACCEPTANCE_RATE=74.00%"
    assert stop(100, bad_json=5, ok=75) is None


def test_tranche_pick_respects_what_remains(spark, rows):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(20)], "i int, mode string")
    got = rows(telemetry.pick_tranche(df, 8, [F.col("i")], "mode", {"a": 2}))
    assert sorted(r[0] for r in got) == [0, 1, 2, 3, 4, 6, 8, 10]
