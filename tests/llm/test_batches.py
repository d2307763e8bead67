"""p4_found on a small folder of tables: tranches, rejected tasks, same and near questions, blanks and repeats."""

import datetime as dt

from millrace.llm import queries

BASE = "how does raising alpha change the way red foxes answer to beta when no hares are left near the border"
NEAR = "how does raising alpha change the way red foxes answer to beta when no hares are left near the river"
FAR = "which procedure resets gamma before blue foxes meet"


def _write(spark, d, responses, records, rejected):
    now = dt.datetime(2025, 1, 1)
    spark.createDataFrame([(*r, now) for r in responses], "response_id long, task_key string, tranche int, question string, generated_at timestamp").write.parquet(f"{d}/responses.parquet")
    spark.createDataFrame(records, "record_id string, source string, question string").write.parquet(f"{d}/records.parquet")
    spark.createDataFrame(rejected, "task_key string, tranche int").write.parquet(f"{d}/rejected.parquet")


def test_kinds(spark, tmp_path):
    responses = [
        (1, "a", 0, BASE.upper() + "?!"),  # the words of a record
        (2, "b", 0, NEAR),  # near it
        (3, "c", 0, FAR),
        (4, "d", 1, FAR + "!"),  # of an accepted earlier one
        (5, "e", 1, None), (6, "f", 1, "  "), (7, "g", 1, "???"),
        (8, "h", 2, "a wholly different thing to ask about here"),
        (9, "bad", 2, "first try of something else entirely now"),  # rejected in tranche 2, tried again in 3
        (10, "bad", 3, "second try of quite another thing today"),
        (11, "i", 3, "first try of something else entirely now"),  # a rejected response is no history
        (12, "j", 2, "a wholly different thing to ask about here"),  # the same tranche is no history
        (13, None, 3, FAR),
    ]
    records = [("r1", "corpus", BASE), ("r1", "corpus", BASE), ("r2", "rejected_synth", "second try of quite another thing today"), ("r3", None, None), ("r4", "seed", " ")]
    _write(spark, tmp_path, responses, records, [("bad", 2), ("bad", 4), (None, 1)])
    got = {r["response_id"]: r["kind"] for r in queries.p4_found(spark, str(tmp_path)).collect()}
    assert got == {1: "same", 2: "near", 4: "same", 10: "retried", 13: "same"}


def test_empty_tables(spark, tmp_path):
    _write(spark, tmp_path, [], [], [])
    assert queries.p4_found(spark, str(tmp_path)).count() == 0
