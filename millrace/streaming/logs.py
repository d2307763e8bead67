"""Event logs and accepted pairs as streams: incremental summaries and incremental duplicate gates."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.numbers import q_hash, qa_hash
from millrace.operators.dedup import gate_duplicates
from millrace.sources.files import exists


def read_stream(spark: SparkSession, path: str, schema, per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of a folder, as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def count_by(stream: DataFrame, *keys: str) -> DataFrame:
    """Running counts per combination of keys; the state holds one row per combination."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(stream: DataFrame, at: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts per time window and keys; rows later than `late` behind the newest are dropped and old windows leave the state."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> None:
    """Runs the stream over all there is now and leaves its result as a Parquet folder."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path)

    q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
    q.awaitTermination()


def first_questions(stream: DataFrame, question: str = "question") -> DataFrame:
    """The first row of every question, compared by its key; the state holds one hash per question."""
    return stream.withColumn("q_hash", q_hash(question)).dropDuplicates(["q_hash"])


def gate_stream(stream: DataFrame, pos: str, accepted: str, verdicts: str, checkpoint: str) -> StreamingQuery:
    """Gives every row of every micro-batch its verdict against all accepted before, and appends what is accepted.

    History holds two hashes per accepted question. A batch that runs again after a failure is recognised by
    its number, so nothing is accepted twice.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        history = spark.read.parquet(accepted).filter(F.col("batch") < number) if exists(spark, f"{accepted}/batch=*") else None
        out = batch.withColumns({"_q": q_hash("question"), "_qa": qa_hash("question", "answer")})
        if history is not None:
            old = history.select("_q", F.col("_qa").alias("_old"))
            out = out.join(old, "_q", "left")
        else:
            out = out.withColumn("_old", F.lit(None).cast("string"))
        fresh = gate_duplicates(out.filter("_old is null"), pos)
        stale = out.filter("_old is not null").withColumn("verdict", F.when(F.col("_old") == F.col("_qa"), "EXACT_QA_DUP").otherwise("QUESTION_TEMPLATE_DUP"))
        done = fresh.unionByName(stale).withColumn("batch", F.lit(number)).persist()
        done.drop("_q", "_qa", "_old").write.mode("overwrite").parquet(f"{verdicts}/batch={number}")
        done.filter("verdict = 'ACCEPTED'").select("_q", "_qa").write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        done.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step).trigger(availableNow=True).start()


def quota_stream(stream: DataFrame, key: str, cap: int) -> DataFrame:
    """The rows of a stream with `admitted`: true for the first `cap` of every key, as they come; null is a key of its own.

    The state holds one count per key and nothing else. Rows of a key pass in batches, never all at once.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def run(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        used = state.get[0] if state.exists else 0
        for pdf in chunks:
            yield pdf.assign(admitted=[used + i < cap for i in range(len(pdf))])
            used = min(cap, used + len(pdf))
        state.update((used,))

    kinds = ", ".join(f"`{n}` {t}" for n, t in stream.dtypes if n != "admitted")
    rows = stream.select(*[F.col(f"`{n}`") for n in stream.columns if n != "admitted"])
    return rows.groupBy(key).applyInPandasWithState(run, f"{kinds}, admitted boolean", "used long", "append", GroupStateTimeout.NoTimeout)
