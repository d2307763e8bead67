import json

from pyspark.sql import functions as F

from millrace.operators import prompts
from millrace.sources import files
from millrace.streaming import logs


def test_jsonl(spark, tmp_path, rows):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n\nbroken\n{"a": 2, "b": "x"}\n')
    assert rows(files.read_jsonl(spark, str(p), "a int, b string", tolerant=True)) == [(1, None), (2, "x")]
    assert files.corrupt_lines(spark, str(p)).collect()[0]["text"] == "broken"
    files.write_jsonl(files.read_jsonl(spark, str(p), "a int, b string", tolerant=True).coalesce(1), str(tmp_path / "out"))
    lines = [json.loads(x) for f in (tmp_path / "out").glob("part*") for x in f.read_text().splitlines()]
    assert {"a": 1, "b": None} in lines


def test_document_and_sources(spark, tmp_path, rows):
    (tmp_path / "d.json").write_text('{"m": {"n": 1}, "o": {"n": 2}}')
    assert rows(files.read_document(spark, str(tmp_path / "d.json"), "struct<n:int>").select("key", "value.n")) == [("m", 1), ("o", 2)]
    for sub in ("a", "b"):
        (tmp_path / "src" / sub).mkdir(parents=True)
        (tmp_path / "src" / sub / "Wolf Sheep.nlogo").write_text(sub)
    assert rows(files.read_sources(spark, str(tmp_path / "src")).select("model_name", "text")) == [("wolf_sheep", "b")]


def test_positions(spark, rows):
    df = spark.range(100).select((99 - F.col("id")).alias("x"))
    assert rows(files.with_position(df, F.col("x")).select((F.col("x") - F.col("pos")).alias("d")).distinct()) == [(0,)]


def test_stream_gate_over_batches(spark, tmp_path, rows):
    src = tmp_path / "in"
    schema = "pos int, question string, answer string"
    for n, part in enumerate(([(1, "q", "a"), (2, "q", "b")], [(3, "Q ", "a"), (4, "new", "x")])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(src))
        q = logs.gate_stream(logs.read_stream(spark, str(src), spark.createDataFrame([], schema).schema), "pos", str(tmp_path / "acc"), str(tmp_path / "ver"), str(tmp_path / "chk"))
        q.awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "ver")).select("pos", "verdict"))
    assert got == [(1, "ACCEPTED"), (2, "QUESTION_TEMPLATE_DUP"), (3, "EXACT_QA_DUP"), (4, "ACCEPTED")]


def test_windowed_stream(spark, tmp_path, rows):
    spark.sql("select timestamp'2025-01-01 00:00:10' as ts, 'a' as k union all select timestamp'2025-01-01 00:01:10', 'a'").coalesce(1).write.parquet(str(tmp_path / "e"))
    s = logs.read_stream(spark, str(tmp_path / "e"), spark.read.parquet(str(tmp_path / "e")).schema)
    logs.run_to_table(logs.windowed_counts(s, "ts", "1 minute", "1 hour", "k"), str(tmp_path / "o"), str(tmp_path / "c"), "complete")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_prompt_pieces(spark):
    df = spark.createDataFrame([("  " + "x" * 30, "call sk-abc token=zz")], "a string, b string")
    r = df.select(prompts.shorten("a", 10), prompts.redact("b")).first()
    assert r[0] == "x" * 9 + "…" and r[1] == "call [REDACTED] [REDACTED]"


def test_generate_retries_transient_errors(spark):
    def client(p):
        if p == "bad":
            raise ValueError("no such model")
        return p.upper()

    got = {r["prompt"]: (r["reply"], r["reply_error"]) for r in prompts.generate(spark.createDataFrame([("hi",), ("bad",), (None,)], "prompt string"), client).collect()}
    assert got == {"hi": ("HI", None), "bad": (None, "no such model"), None: (None, "NO_PROMPT")}


def test_quota_stream(spark, tmp_path, rows):
    src, schema = tmp_path / "in", "i int, model string, admitted int"
    for part in ([(1, "a", 0), (2, "a", 0), (3, "b", 0), (4, None, 0)], [(5, "a", 0), (6, "b", 0), (7, None, 0), (8, "c", 0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(src))
        s = logs.quota_stream(logs.read_stream(spark, str(src), spark.createDataFrame([], schema).schema), "model", 2)
        logs.run_to_table(s, str(tmp_path / "out"), str(tmp_path / "state"), "append")
    got = rows(spark.read.parquet(str(tmp_path / "out")).groupBy("model").agg(F.count_if("admitted"), F.count("*")))
    assert got == sorted([("a", 2, 3), ("b", 2, 2), ("c", 1, 1), (None, 2, 2)], key=str)


def test_words_of_a_file(spark, tmp_path):
    (tmp_path / "w.txt").write_text("Ticks\n\n tick \nticks\n")
    assert files.read_words(spark, str(tmp_path / "w.txt")) == ["ticks", "tick"]
