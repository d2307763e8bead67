"""Raw rows of any source to normalised records, with every issue of a row listed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.lexical import first_message, tag_value
from millrace.functions.text import blank_to_null, model_key, squeeze

# The order in which sources follow each other.
SOURCES = ("corpus", "seed", "accepted_synth", "rejected_synth")
COLUMNS = ("record_id", "source", "source_id", "model_name", "question", "answer", "seed_id", "class_id", "level", "tier", "global_id", "tags")


def has(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or null where df has none of that name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def question_answer(df: DataFrame) -> tuple[Column, Column]:
    """Explicit columns first; each missing side falls back on the messages, if there are any, by itself."""
    q, a = blank_to_null(has(df, "question")), blank_to_null(has(df, "answer"))
    if "messages" in df.columns:
        q = F.coalesce(q, first_message("messages", "user"))
        a = F.coalesce(a, first_message("messages", "assistant"))
    return q, a


def model_and_level(df: DataFrame) -> tuple[Column, Column]:
    """model_name, else model, else a tag; level, else a tag."""
    tags = F.col("tags") if "tags" in df.columns else None
    model = F.coalesce(model_key(has(df, "model_name")), model_key(has(df, "model")))
    level = blank_to_null(has(df, "level"))
    if tags is not None:
        model = F.coalesce(model, model_key(tag_value(tags, "model")))
        found = squeeze(tag_value(tags, "level"))
        level = F.coalesce(level, F.when(found != "", found))
    return model, level


def issues_of(checks: dict[str, Column]) -> Column:
    """The names of all checks that fail, in their order."""
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]), lambda x: x.isNotNull())


def normalize(df: DataFrame, source: str | None = None) -> DataFrame:
    """Normalised columns of every row, `issues` added; a row with an issue is not fit for use.

    source: the rows' source where the table has no such column. record_id is kept where there is one, else
    made from source and source_id. Null or blank text is null; rows are neither dropped nor merged.
    """
    q, a = question_answer(df)
    model, level = model_and_level(df)
    src = F.lit(source) if source else blank_to_null(has(df, "source"))
    source_id = F.coalesce(blank_to_null(has(df, "source_id")), blank_to_null(has(df, "id")), blank_to_null(has(df, "global_id")), F.lit(""))
    made = F.when(source_id != "", F.concat(src, F.lit("::"), source_id))
    out = df.select(
        F.coalesce(blank_to_null(has(df, "record_id")), made).alias("record_id"),
        src.alias("source"),
        source_id.alias("source_id"),
        model.alias("model_name"),
        q.alias("question"),
        a.alias("answer"),
        blank_to_null(has(df, "seed_id")).alias("seed_id"),
        has(df, "class_id", "int").cast("int").alias("class_id"),
        level.alias("level"),
        F.upper(blank_to_null(has(df, "tier"))).alias("tier"),
        blank_to_null(has(df, "global_id")).alias("global_id"),
        has(df, "tags", "array<string>").alias("tags"),
        *[F.col(c) for c in ("ingested_at",) if c in df.columns],
    )
    checks = {
        "MISSING_ID": F.col("record_id").isNull(),
        "MISSING_MODEL": F.col("model_name").isNull(),
        "MISSING_QUESTION": F.col("question").isNull(),
        "MISSING_ANSWER": F.col("answer").isNull(),
    }
    return out.withColumn("issues", issues_of(checks))


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts; a column that a part lacks is null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def last_wins(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per non-null key, the last by the given order (ascending, nulls first).

    The last row is found by aggregation, so a key of very many rows is reduced before it is shuffled.
    """
    names = df.columns
    rank = F.struct(*order, *[F.col(c) for c in names if c != key])
    best = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), rank).alias("_row"))
    return best.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])


def fill_from(seeds: DataFrame, corpus: DataFrame, seed_key: str, corpus_key: str, columns: list[str], order: list[Column]) -> DataFrame:
    """seeds with missing values of columns taken from the last corpus row of the same key; `fill` says what happened.

    fill: complete (nothing was missing), filled, part (something is still missing) or miss (no corpus row).
    """
    side = last_wins(corpus.select(corpus_key, *columns, *[c for c in corpus.columns if c not in {corpus_key, *columns}]), corpus_key, *order)
    side = side.select(F.col(corpus_key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    x = seeds.join(side, seeds[seed_key] == side["_key"], "left")
    need = F.lit(False)
    still = F.lit(False)
    for c in columns:
        need = need | blank_to_null(F.col(c)).isNull()
        still = still | F.coalesce(blank_to_null(F.col(c)), blank_to_null(F.col(f"_{c}"))).isNull()
    state = F.when(~need, "complete").when(F.col("_key").isNull(), "miss").when(still, "part").otherwise("filled")
    filled = {c: F.coalesce(blank_to_null(F.col(c)), blank_to_null(F.col(f"_{c}"))) for c in columns}
    return x.select(*[filled.get(c, F.col(c)).alias(c) for c in seeds.columns], state.alias("fill"))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of non-null keys that stand more than once."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def consistency_report(records: DataFrame) -> DataFrame:
    """(kind, name, n): rows and sound rows by source, issues by source, and rows by model of corpus and seeds, in one pass of grouping."""
    x = records.select("source", "model_name", "issues", (F.size("issues") == 0).alias("ok"))
    rows = x.groupBy("source").agg(F.count(F.lit(1)).alias("raw"), F.count_if("ok").alias("ok"))
    by_source = rows.select(F.expr("stack(2, 'raw', raw, 'normalized_ok', ok) as (kind, n)"), "source").select("kind", F.col("source").alias("name"), "n")
    issue = x.select("source", F.explode("issues").alias("issue")).groupBy("source", "issue").agg(F.count(F.lit(1)).alias("n"))
    issue = issue.select(F.lit("issue").alias("kind"), F.concat_ws(":", "source", "issue").alias("name"), "n")
    model = x.filter(F.col("source").isin("corpus", "seed")).groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))
    model = model.select(F.lit("model").alias("kind"), F.coalesce("model_name", F.lit("unknown")).alias("name"), "n")
    return by_source.unionByName(issue).unionByName(model)


def seed_record_id(seed_id: Column, seed_type: Column, *content: Column) -> Column:
    """seed::id::type, seed::id, or for a seed without id a name made from its content, the same at every run."""
    anonymous = F.concat(F.lit("seed::_anon_"), F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in content]), 256))
    return F.when(seed_id.isNull(), anonymous).when(seed_type.isNull(), F.concat(F.lit("seed::"), seed_id)).otherwise(F.concat_ws("::", F.lit("seed"), seed_id, seed_type))
