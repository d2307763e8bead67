"""How much a model can yield: features of each model, scaled, weighted and turned into caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import lerp_int

# Weights of the features, summing to 1, and of the risk.
WEIGHTS = {
    "n_seed_anchors": 0.14, "n_corpus_records": 0.12, "n_classes_covered": 0.18, "n_core_procedures": 0.08, "n_core_variables": 0.05, "n_core_widgets": 0.05,
    "n_core_breeds": 0.03, "n_extension_families": 0.14, "n_extension_identifiers": 0.08, "support_pool_avg_size": 0.13,
}
RISK = {"dedup_rate": 0.55, "bad_model_rate": 0.20, "reject_rate": 0.15}
LOW_SUPPORT = 0.10
HIGH, MID = 0.72, 0.45
CAPS = {"cap_core_paraphrase": (4, 12), "cap_core_repair": (2, 7), "cap_anchored_extension": (4, 14), "cap_total": (10, 30), "cap_support_reuse": (25, 120)}
DEDUP = ["EXACT_QA_DUP", "QUESTION_TEMPLATE_DUP", "NEAR_DUP_QUESTION"]
BAD_MODEL = ["UNKNOWN_CORE_IDENTIFIER", "UNAPPROVED_EXTENSION_IDENTIFIER", "CROSS_FAMILY_EXTENSION_IDENTIFIER", "BASE_MODEL_MISREPRESENTATION", "EXTENSION_REQUIRES_FRAMING", "INSUFFICIENT_CORE_ANCHOR", "DISALLOWED_THEME"]


def seed_features(seeds: DataFrame) -> DataFrame:
    """Per model: distinct seeds and classes, seeds by mode, distinct families. Exact counts."""
    mode = lambda m: F.count_if(F.col("route_mode") == m)
    return seeds.filter("model_name is not null").groupBy("model_name").agg(
        F.count_distinct("seed_id").alias("n_seed_anchors"),
        F.count_distinct("class_id").alias("n_classes_covered"),
        mode("core_paraphrase").alias("n_core_paraphrase"),
        mode("core_repair").alias("n_core_repair"),
        mode("anchored_extension").alias("n_anchored_extension"),
        F.count_distinct("extension_family").alias("n_families_used"),
    )


def profile_features(profiles: DataFrame) -> DataFrame:
    """Per model: core identifiers, families, and identifiers of all families (a shared one counts in each)."""
    return profiles.select("model_name", F.size("core").alias("n_core_procedures"), F.size("families").alias("n_extension_families"), F.aggregate("families", F.lit(0), lambda n, f: n + F.size(f["identifiers"])).alias("n_extension_identifiers"))


def corpus_features(records: DataFrame) -> DataFrame:
    return records.filter("model_name is not null").groupBy("model_name").agg(F.count(F.lit(1)).alias("n_corpus_records"), F.count_distinct("class_id").alias("n_corpus_classes"))


def pool_features(pools: DataFrame, seeds: DataFrame) -> DataFrame:
    """Per model: average, median and largest pool of its seeds, and average and largest reuse of its support records."""
    x = pools.join(seeds.select("seed_id", "model_name").distinct(), "seed_id")
    sizes = x.groupBy("model_name", "seed_id").agg(F.count(F.lit(1)).alias("n")).groupBy("model_name")
    sizes = sizes.agg(F.bround(F.avg("n"), 4).alias("support_pool_avg_size"), F.percentile("n", 0.5).alias("support_pool_median_size"), F.max("n").alias("support_pool_max_size"))
    reuse = x.groupBy("model_name", "record_id").agg(F.count(F.lit(1)).alias("n")).groupBy("model_name")
    return sizes.join(reuse.agg(F.bround(F.avg("n"), 4).alias("reuse_avg"), F.max("n").alias("reuse_max")), "model_name", "full_outer")


def feature_matrix(parts: list[DataFrame]) -> DataFrame:
    """Full outer join of per-model features; where several parts have a column, the later one counts."""
    out = parts[0]
    for p in parts[1:]:
        both = [c for c in p.columns if c in out.columns and c != "model_name"]
        x = out.withColumnsRenamed({c: f"_{c}" for c in both}).join(p, "model_name", "full_outer")
        out = x.withColumns({c: F.coalesce(c, f"_{c}") for c in both}).drop(*[f"_{c}" for c in both]) if both else x
    return out


def scaled(matrix: DataFrame, names: list[str]) -> DataFrame:
    """Each feature scaled to 0..1 over all models; missing to 0, all equal to 1. One row per model, so the whole-table window is small."""
    w = Window.partitionBy(F.lit(1))
    out = {}
    for n in names:
        v = F.col(n).cast("double") if n in matrix.columns else F.lit(None).cast("double")
        low, high = F.min(v).over(w), F.max(v).over(w)
        out[f"norm_{n}"] = F.when(v.isNull(), 0.0).when(high <= low, 1.0).otherwise((v - low) / (high - low))
    return matrix.withColumns(out)


def risk(matrix_columns: list[str]) -> Column:
    """Weighted rates and a penalty for small pools, clamped to 0..1; missing rates are 0."""
    avg = F.coalesce(F.col("support_pool_avg_size"), F.lit(0.0)) if "support_pool_avg_size" in matrix_columns else F.lit(0.0)
    total = LOW_SUPPORT * F.when(avg < 2, 1.0).when(avg < 4, 0.6).when(avg < 6, 0.3).otherwise(0.0)
    for n, w in RISK.items():
        if n in matrix_columns:
            total = total + w * F.coalesce(F.col(n), F.lit(0.0))
    return F.bround(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)), 6)


def bucket(effective: Column) -> Column:
    return F.when(effective >= HIGH, "high_capacity").when(effective >= MID, "mid_capacity").otherwise("low_capacity")


def weighted_score() -> Column:
    """The weighted sum of the scaled features, not rounded."""
    score = F.lit(0.0)
    for n, w in WEIGHTS.items():
        score = score + w * F.col(f"norm_{n}")
    return score


def report(matrix: DataFrame) -> DataFrame:
    """Per model: capacity_score, dedup_risk, effective_capacity, capacity_bucket and the suggested caps."""
    x = scaled(matrix, list(WEIGHTS))
    x = x.withColumn("capacity_score", F.bround(weighted_score(), 6)).withColumn("dedup_risk", risk(matrix.columns))
    x = x.withColumn("effective_capacity", F.bround(F.col("capacity_score") * (1 - F.col("dedup_risk")), 6))
    caps = [lerp_int(low, high, F.col("effective_capacity")).alias(n) for n, (low, high) in CAPS.items()]
    return x.select("model_name", "capacity_score", "dedup_risk", "effective_capacity", bucket(F.col("effective_capacity")).alias("capacity_bucket"), *caps)


def top_models(capacities: DataFrame, k: int = 50) -> DataFrame:
    """The k models of highest effective capacity, ties by name."""
    return capacities.orderBy(F.desc("effective_capacity"), "model_name").limit(k)
