"""Which terms of the records their model's profile covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.lexical import SINGLE_IDENTIFIER, STOPWORDS, backtick_spans, identifier_tokens, quoted_phrases, runs_of
from millrace.functions.text import as_col, evaluated, strip, text_key

CLASSES = ("core", "supported", "parser_miss", "extension_candidate", "drift")
#: Classes of terms that the profile does not cover.
UNSUPPORTED = ("parser_miss", "extension_candidate", "drift")
# Words one of which a phrase must have, and further words that carry none.
PHRASE_KEYWORDS = (
    "state states diagram transition threshold vision grievance legitimacy risk arrest active quiet jail jailing neighbor neighbors neighborhood police cop cops agent agents rebel rebels rebellion "
    "media broadcast network friends friend links link cluster clustering clustered path small-world long-range leader leaders homophily density critical tipping uprising phase time series warning indicator indicators "
    "autocorrelation variance metric metrics optimization speed execution efficiency cache hub centrality"
).split()
MORE_STOPWORDS = ["use", "using", "used"]


def _text() -> Column:
    return F.concat_ws("\n", F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit("")))


def marked_terms(text: Column | str) -> Column:
    """Terms that are written as identifiers, repeats included: back-ticked spans, single identifiers in brackets, and tokens with a hyphen or a question mark."""
    brackets = F.transform(F.regexp_extract_all(F.coalesce(as_col(text), F.lit("")), F.lit(r"\[([^\]]+)\]"), F.lit(1)), strip)
    single = F.transform(F.filter(brackets, lambda b: b.rlike(SINGLE_IDENTIFIER)), F.lower)
    return F.concat(F.transform(backtick_spans(text), text_key), single, F.filter(F.transform(identifier_tokens(text), F.lower), _is_marked))


def _is_marked(token: Column) -> Column:
    return F.contains(token, F.lit("-")) | token.endswith("?")


def term_uses(records: DataFrame) -> DataFrame:
    """(model_name, term, marked, plain): how often a term stands marked, and as a token without a mark, in the records of a model."""
    x = evaluated(records.filter(F.col("model_name").isNotNull()).select("model_name", _text().alias("_t")), {"_marked": marked_terms("_t"), "_plain": F.filter(F.transform(identifier_tokens("_t"), F.lower), lambda t: ~_is_marked(t))}, drop=("_t",))
    both = F.concat(F.transform("_marked", lambda t: F.struct(t.alias("term"), F.lit(1).alias("m"))), F.transform("_plain", lambda t: F.struct(t.alias("term"), F.lit(0).alias("m"))))
    x = x.select("model_name", F.inline(both)).filter("term <> ''")
    return x.groupBy("model_name", "term").agg(F.sum("m").alias("marked"), F.sum(1 - F.col("m")).alias("plain"))


def classified_terms(records: DataFrame, profiles: DataFrame, allow: list[str], hints: DataFrame | None = None) -> DataFrame:
    """(model_name, term, n, class): uses of every exact term in the records of models that have a profile.

    Exact terms are the marked ones, and any token that is a core identifier or that the source parse left
    unresolved. class: core; supported (in `allow`, or told by the source as a widget or literal); parser_miss
    (unresolved in the source); extension_candidate (used at least twice) or drift (once). hints: (model_name,
    term, kind) with kind `aux` or `unresolved`, of the source parse. Records of models without a profile are
    left out. Uses are counted before the shuffle; profiles and hints meet the counts, once per model and term.
    """
    x = term_uses(records).join(profiles.select("model_name", "core"), "model_name")
    if hints is None:
        x = x.withColumns({"_aux": F.lit(False), "_unresolved": F.lit(False)})
    else:
        told = hints.filter("model_name is not null and term is not null").groupBy("model_name", F.lower("term").alias("term"))
        told = told.agg(F.bool_or(F.col("kind") == "aux").alias("_aux"), F.bool_or(F.col("kind") == "unresolved").alias("_unresolved"))
        x = x.join(told, ["model_name", "term"], "left").fillna(False, ["_aux", "_unresolved"])
    core = F.array_contains("core", F.col("term"))
    n = F.col("marked") + F.when(core | F.col("_unresolved"), F.col("plain")).otherwise(0)
    cls = F.when(core, "core").when(F.col("_aux") | F.col("term").isin(allow), "supported").when(F.col("_unresolved"), "parser_miss").when(F.col("n") >= 2, "extension_candidate").otherwise("drift")
    return x.withColumn("n", n).filter("n > 0").select("model_name", "term", "n", cls.alias("class"))


def phrase_uses(records: DataFrame) -> DataFrame:
    """(model_name, phrase, n): quoted phrases of up to five words, and runs of two to four terms that have one of the keywords."""
    tokens = F.filter(F.transform(identifier_tokens("_t"), F.lower), lambda t: ~t.isin(STOPWORDS + MORE_STOPWORDS))
    x = records.filter(F.col("model_name").isNotNull()).select("model_name", _text().alias("_t"))
    x = evaluated(evaluated(x, {"_w": tokens}), {"_told": F.transform("_w", lambda t: t.isin(PHRASE_KEYWORDS))})
    phrases = F.concat(quoted_phrases("_t", single=True), runs_of(F.col("_w"), 2, 4, F.col("_told")))
    return x.select("model_name", F.explode(phrases).alias("phrase")).groupBy("model_name", "phrase").agg(F.count(F.lit(1)).alias("n"))


def top_terms(classified: DataFrame, k: int) -> DataFrame:
    """The k most used terms of each model and class, ties by term, with their rank."""
    w = Window.partitionBy("model_name", "class").orderBy(F.desc("n"), "term")
    return classified.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def examples(records: DataFrame, classified: DataFrame, k: int = 3, chars: int = 220) -> DataFrame:
    """(model_name, term, class, record_id, example): up to k records per term of any class, the first by record_id, shortened.

    A term's record is one that holds it marked or as a token.
    """
    all_terms = F.array_union(marked_terms("_t"), F.transform(identifier_tokens("_t"), F.lower))
    used = records.filter("record_id is not null and model_name is not null").select("model_name", "record_id", F.substring(F.coalesce("question", F.lit("")), 1, chars).alias("example"), _text().alias("_t"))
    used = used.select("model_name", "record_id", "example", F.explode(all_terms).alias("term"))
    w = Window.partitionBy("model_name", "term").orderBy("record_id", "example")
    cut = used.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
    return cut.join(classified.select("model_name", "term", "class"), ["model_name", "term"]).select("model_name", "term", "class", "record_id", "example")


def roll_up(top: DataFrame, k: int) -> DataFrame:
    """(class, term, n): the k most used terms over all models, summed from the models' own top lists."""
    x = top.groupBy("class", "term").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("class").orderBy(F.desc("n"), "term")
    return x.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def pressure(classified: DataFrame, k: int = 20) -> DataFrame:
    """(model_name, n): the k models with most uses of terms that their profile does not cover, ties by name."""
    n = classified.filter(F.col("class").isin(*UNSUPPORTED)).groupBy("model_name").agg(F.sum("n").alias("n"))
    return n.orderBy(F.desc("n"), "model_name").limit(k)
