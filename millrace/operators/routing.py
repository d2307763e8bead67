"""Every record to a mode of processing, by a table of rules over its terms and its model's profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.lexical import STOPWORDS, summary_keywords, terms, words_literal
from millrace.functions.text import evaluated, text_key
from millrace.operators.profiles import extension_concepts, extension_ids

# Words that speak of a change to the model.
INTENT = (
    "add adding extend extension modify modifying introduce introducing layer layers network networks broadcast media friends friend leader leaders "
    "state states diagram long-range small-world optimize optimization cache scaling hub hubs centrality warning indicator indicators metric metrics"
).split()
# Thresholds and weights.
STRONG, WEAK, W_ID, W_PHRASE, W_TOKEN = 4, 2, 3, 2, 1
PARAPHRASE_HITS, PARAPHRASE_UNKNOWN, REPAIR_HITS, REPAIR_UNKNOWN = 2, 0.35, 1, 0.75
# Patterns.
TOPOLOGY = r"(?i)\b(?:network|graph|preferential.attachment|scale.free|small.world|random.network|degree.distribution|topology)\b"
MODIFICATION = (
    r"(?i)\b(?:how\s+(?:can|do|would|should)\s+I\s+(?:add|implement|introduce|include|incorporate|extend|modify|model))"
    r"|\b(?:add(?:ing)?\s+(?:a\s+)?(?:new\s+)?(?:\w+\s+)?(?:to|into)\s+(?:the|a|my))"
    r"|\b(?:implement(?:ing)?|introduc(?:e|ing)|incorporat(?:e|ing))\s+\w+"
    r"|\b(?:extend(?:ing)?)\s+(?:the\s+)?(?:original\s+)?(?:\w+\s+)?model"
)
HEX_GRID = r"(?i)\bhex(?:agonal)?\s+grid\b"
PATHOGENS = r"(?i)\b(?:multiple\s+pathogen|multi.?pathogen|coevolut|multiple\s+strain|multi.?strain)\b"
#: Words of the modelling language that are known everywhere; a session passes its own list.
ALLOW = "ticks tick turtles patches links agent agents observer breed monitor plot reporter button chooser slider switch world ask count mean sum min max distance of one-of n-of ifelse let set run repeat foreach map filter random random-float color heading xcor ycor size shape who label to end true false list item length first last experiment metric parameter threshold ratio time series density".split()


def family_scores(families: Column, found: Column, key: Column) -> Column:
    """Per family: name and score, from identifiers found, concept phrases in the text's key and single words of concepts found."""

    def score(f: Column) -> Column:
        ids = F.size(F.array_intersect(f["identifiers"], found))
        phrases = F.size(F.array_distinct(F.filter(f["concepts"], lambda p: (p != "") & F.contains(key, p))))
        words = F.array_except(F.flatten(F.transform(f["concepts"], lambda c: F.split(c, " "))), words_literal(STOPWORDS))
        return ids * W_ID + phrases * W_PHRASE + F.size(F.array_intersect(words, found)) * W_TOKEN

    return F.transform(families, lambda f, i: F.struct(score(f).alias("score"), (-i).alias("before"), f["name"].alias("name")))


def route(df: DataFrame, profiles: DataFrame, question: str = "question", answer: str = "answer", allow: list[str] = ALLOW) -> DataFrame:
    """df with route, route_reason, family, core_hits, best_family_score, unknown_ratio and extension_intent.

    Null texts are empty. Rows whose model has no profile are skipped with reason missing_model_profile. One
    projection after one join with the profiles; Spark broadcasts these as long as they are small.
    """
    none = F.array().cast("array<string>")
    names = df.columns
    # What a profile says is made once per model, what a text says once per row.
    side = {"_p_ext": F.coalesce(extension_ids("families"), none), "_p_phrases": F.coalesce(extension_concepts("families"), none), "_p_summary": summary_keywords("summary")}
    known = evaluated(profiles.select("model_name", "core", "families", "summary"), side).select(F.col("model_name").alias("_m"), F.col("core").alias("_p_core"), F.col("families").alias("_p_families"), "_p_ext", "_p_phrases", "_p_summary")
    x = df.join(known, F.col("model_name") == F.col("_m"), "left")
    text = F.concat(F.coalesce(question, F.lit("")), F.lit("\n"), F.coalesce(answer, F.lit("")))
    empty = F.array().cast("array<struct<name:string,identifiers:array<string>,concepts:array<string>>>")
    made = {"_text": text, "_low": text_key(text), "_terms": terms(text), "_core": F.coalesce("_p_core", none), "_ext": F.coalesce("_p_ext", none), "_phrases": F.coalesce("_p_phrases", none), "_summary": F.coalesce("_p_summary", none), "_fam": F.coalesce("_p_families", empty)}
    x = evaluated(x, made)
    unknown = F.size(F.array_except(F.array_except(F.array_except("_terms", "_core"), "_ext"), words_literal(allow)))
    x = evaluated(
        x,
        {
            "_hits": F.size(F.array_intersect("_terms", "_core")),
            "_unknown": unknown / F.greatest(F.lit(1), F.size("_terms")),
            "_ids": F.size(F.array_intersect("_terms", "_ext")),
            "_concepts": F.exists("_phrases", lambda p: (p != "") & F.contains(F.col("_low"), p)),
            "_overlap": F.size(F.array_intersect("_summary", "_terms")),
            "_intent": F.arrays_overlap("_terms", words_literal(INTENT)),
            "_best": F.array_max(family_scores(F.col("_fam"), F.col("_terms"), F.col("_low"))),
        },
    )
    score = F.greatest(F.coalesce(F.col("_best.score"), F.lit(0)), F.lit(0))
    family = F.when(score > 0, F.col("_best.name"))
    intent = F.col("_intent")
    anchor = (F.col("_hits") >= 1) | (F.col("_overlap") >= 2)
    lower_core = F.array_join("_core", " ")
    mismatch = F.when(F.col("_text").rlike(HEX_GRID), "seed_requires_hex_grid").when(F.col("_text").rlike(PATHOGENS) & ~F.contains(lower_core, F.lit("sick?")) & ~F.contains(lower_core, F.lit("infected")), "seed_requires_multi_pathogen")
    layer = F.col("_text").rlike(TOPOLOGY) & F.exists("_fam", lambda f: f["name"] == "network_layer")
    s = lambda mode, why, fam=None: F.struct(F.lit(mode).alias("route"), F.lit(why).alias("why"), (fam if fam is not None else F.lit(None).cast("string")).alias("family"))
    rule = (
        F.when(F.col("_m").isNull(), s("skip", "missing_model_profile"))
        .when(mismatch.isNotNull(), F.struct(F.lit("skip").alias("route"), F.concat(F.lit("scope_mismatch:"), mismatch).alias("why"), F.lit(None).cast("string").alias("family")))
        .when(family.isNotNull() & ((score >= STRONG) | (intent & (score >= WEAK))), s("anchored_extension", "strong_extension_family_match", family))
        .when((F.col("_hits") >= PARAPHRASE_HITS) & (score == 0) & (F.col("_unknown") <= PARAPHRASE_UNKNOWN), s("core_paraphrase", "strong_core_match"))
        .when((F.col("_hits") >= REPAIR_HITS) & (score == 0) & (F.col("_unknown") <= REPAIR_UNKNOWN), s("core_repair", "core_match_with_noise"))
        .when(family.isNotNull() & (score >= WEAK) & (intent | (F.col("_ids") > 0) | F.col("_concepts")), s("anchored_extension", "mixed_core_extension_content", family))
        .when(layer, s("anchored_extension", "network_topology_routed_to_network_layer", F.lit("network_layer")))
        .when(anchor & (F.col("_unknown") > REPAIR_UNKNOWN) & F.col("_text").rlike(MODIFICATION), s("freeform_extension", "extension_intent_with_weak_core_anchor"))
        .when(anchor, s("core_repair", "weak_core_anchor"))
        .otherwise(s("skip", "insufficient_anchor"))
    )
    x = x.withColumn("_rule", rule)
    made_here = ("route", "route_reason", "family", "core_hits", "best_family_score", "unknown_ratio", "extension_intent")
    return x.select(*[F.col(f"`{c}`") for c in names if c not in made_here], F.col("_rule.route").alias("route"), F.col("_rule.why").alias("route_reason"), F.col("_rule.family").alias("family"), F.col("_hits").alias("core_hits"), score.alias("best_family_score"), F.col("_unknown").alias("unknown_ratio"), F.col("_intent").alias("extension_intent"))
