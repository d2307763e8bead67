"""The duplicate gate: who came first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import q_hash, qa_hash


def gate_duplicates(df: DataFrame, pos: str, question: str = "question", answer: str = "answer", history: DataFrame | None = None) -> DataFrame:
    """Every row with `verdict`: ACCEPTED, EXACT_QA_DUP or QUESTION_TEMPLATE_DUP, in the order of pos (unique, ascending).

    The first row of a question (compared by its key) is accepted; a later one with the same answer is an exact
    duplicate, with another answer a template duplicate. history: earlier accepted pairs, which come before all
    rows. The first row of each question is found by partial aggregation, not by a window, so a question that
    very many rows share is never gathered in one task.
    """
    x = df.withColumns({"_q": q_hash(question), "_qa": qa_hash(question, answer)})
    firsts = x.select("_q", F.struct(F.lit(1).alias("new"), F.col(pos).cast("string").alias("tie"), F.col(pos).alias("pos"), F.col("_qa").alias("qa")).alias("_s"))
    rank = F.min(F.struct("_s.new", "_s.pos", "_s.qa"))
    if history is not None:
        kind = dict(df.dtypes)[pos]
        old = history.select(q_hash(question).alias("_q"), F.struct(F.lit(0).alias("new"), F.lit("").alias("tie"), F.lit(None).cast(kind).alias("pos"), qa_hash(question, answer).alias("qa")).alias("_s"))
        firsts = firsts.unionByName(old)
    first = firsts.groupBy("_q").agg(rank.alias("_first"))
    y = x.join(first, "_q")
    own = (F.col("_first.new") == 1) & (F.col("_first.pos") == F.col(pos))
    verdict = F.when(own, "ACCEPTED").when(F.col("_first.qa") == F.col("_qa"), "EXACT_QA_DUP").otherwise("QUESTION_TEMPLATE_DUP")
    return y.select(*df.columns, verdict.alias("verdict"))
