"""Per-model profiles: core identifiers, extension families, and how they compare to what was there before.

A profile row: model_name, core array<string>, summary string, families array<struct<name, identifiers,
concepts>>, cues array<string>, themes array<string>; identifiers and concepts are keys (lower case, squeezed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.lexical import backticked_identifiers

FAMILY = "struct<name:string,identifiers:array<string>,concepts:array<string>>"


def identifier_counts(records: DataFrame) -> DataFrame:
    """(model_name, term, n): records of the model whose question or answer has the back-ticked identifier."""
    t = F.array_distinct(F.concat(backticked_identifiers("question"), backticked_identifiers("answer")))
    x = records.filter(F.col("model_name").isNotNull()).select("model_name", F.explode(t).alias("term"))
    return x.groupBy("model_name", "term").agg(F.count(F.lit(1)).alias("n"))


def derive_profiles(records: DataFrame, core: int = 20, family: int = 5, families: int = 3) -> DataFrame:
    """Profiles from the records themselves: the `core` most frequent identifiers, then `families` groups of `family` each.

    Ties by identifier. Models without identifiers have no profile. Only the leading terms of a model are
    gathered, whatever its size.
    """
    most = core + family * families
    w = Window.partitionBy("model_name").orderBy(F.desc("n"), "term")
    lead = identifier_counts(records).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most)
    g = lead.groupBy("model_name").agg(F.array_sort(F.collect_list(F.struct("r", "term"))).alias("t"))
    names = F.transform("t", lambda s: s["term"])
    fams = []
    for k in range(families):
        ids = F.slice(names, core + k * family + 1, family)
        fams.append(F.struct(F.lit(f"family_{k + 1}").alias("name"), ids.alias("identifiers"), F.transform(ids, lambda i: F.replace(i, F.lit("-"), F.lit(" "))).alias("concepts")))
    none = F.array().cast("array<string>")
    kept = F.filter(F.array(*fams), lambda f: F.size(f["identifiers"]) > 0)
    return g.select("model_name", F.slice(names, 1, core).alias("core"), F.lit("").alias("summary"), kept.alias("families"), none.alias("cues"), none.alias("themes"))


def extension_ids(families: Column | str = "families") -> Column:
    f = F.col(families) if isinstance(families, str) else families
    return F.array_distinct(F.flatten(F.transform(f, lambda x: x["identifiers"])))


def extension_concepts(families: Column | str = "families") -> Column:
    f = F.col(families) if isinstance(families, str) else families
    return F.array_distinct(F.flatten(F.transform(f, lambda x: x["concepts"])))


def merge_profiles(core: DataFrame, ext: DataFrame) -> DataFrame:
    """(model_name, core, families): full outer; missing families are the empty list, a missing core is null."""
    x = core.select("model_name", "core").join(ext.select("model_name", "families"), "model_name", "full_outer")
    return x.select("model_name", "core", F.coalesce("families", F.array().cast(f"array<{FAMILY}>")).alias("families"))


def compare_identifiers(now: DataFrame, before: DataFrame) -> DataFrame:
    """Per model: only_now, only_before and both, the identifiers that only one side or both have, regardless of case, sorted, and their counts n_*.

    Both sides: (model_name, term). The lists hold a model's identifiers, as its profile does.
    """
    a = now.select("model_name", F.lower("term").alias("term")).distinct().withColumn("a", F.lit(True))
    b = before.select("model_name", F.lower("term").alias("term")).distinct().withColumn("b", F.lit(True))
    x = a.join(b, ["model_name", "term"], "full_outer")
    sides = {"only_now": F.col("b").isNull(), "only_before": F.col("a").isNull(), "both": F.col("a") & F.col("b")}
    g = x.groupBy("model_name").agg(*[F.array_sort(F.collect_list(F.when(c, F.col("term")))).alias(n) for n, c in sides.items()])
    return g.select("model_name", *sides, *[F.size(n).cast("long").alias(f"n_{n}") for n in sides])


def family_support(profiles: DataFrame, terms: DataFrame, phrases: DataFrame) -> DataFrame:
    """(model_name, family, unsupported, candidates, parser_misses, phrases, support): what the audit has on each family.

    terms: the audit's classified terms (model_name, term, n, class); phrases: its phrases (model_name, phrase,
    n). support is the uses of a family's identifiers that the core does not cover, those of extension
    candidates counted once more, and the uses of its concepts as phrases. A family nothing speaks for has 0.
    """
    f = profiles.select("model_name", F.explode("families").alias("f"))
    ids = f.select("model_name", F.col("f.name").alias("family"), F.explode(F.array_distinct("f.identifiers")).alias("term"))
    loose = terms.filter(~F.col("class").isin("core", "supported"))
    i = ids.join(loose, ["model_name", "term"], "left").groupBy("model_name", "family")
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    i = i.agg(n(F.lit(True)).alias("unsupported"), n(F.col("class") == "extension_candidate").alias("candidates"), n(F.col("class") == "parser_miss").alias("parser_misses"))
    concepts = f.select("model_name", F.col("f.name").alias("family"), F.explode(F.array_distinct("f.concepts")).alias("phrase"))
    c = concepts.join(phrases, ["model_name", "phrase"], "left").groupBy("model_name", "family").agg(n(F.lit(True)).alias("phrases"))
    x = i.join(c, ["model_name", "family"], "full_outer").fillna(0, ["unsupported", "candidates", "parser_misses", "phrases"])
    return x.withColumn("support", F.col("unsupported") + F.col("candidates") + F.col("phrases"))


def validate_specs(profiles: DataFrame, specs: DataFrame) -> DataFrame:
    """Per model of specs (model_name, families): missing_core, and the identifiers that the core already has."""
    x = specs.alias("s").join(profiles.select("model_name", "core").alias("p"), "model_name", "left")
    return x.select("model_name", F.col("core").isNull().alias("missing_core"), F.array_sort(F.array_intersect(extension_ids(F.col("families")), F.coalesce("core", F.array().cast("array<string>")))).alias("overlap"))


def extension_summary(support: DataFrame, k: int = 100) -> DataFrame:
    """The k families with most support, ties by model and family, with their place. support: (model_name, family, support)."""
    order = [F.desc("support"), F.col("model_name"), F.col("family")]
    top = support.orderBy(*order).limit(k)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def with_defaults(specific: Column, defaults: list[str]) -> Column:
    """Default phrases, then the model's own, each once regardless of case."""
    both = F.concat(F.array(*[F.lit(d) for d in defaults]), F.coalesce(specific, F.array().cast("array<string>")))
    low = F.transform(both, F.lower)
    return F.filter(both, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)
