"""Tasks from routed seeds and their support pools: enumerated, keyed, capped, ordered, selected."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import joined_key, sha1_mod
from millrace.operators.capacity import CAPS as capacity_caps


@dataclass
class Plan:
    """Settings of the planner; the defaults are fixed values."""

    transforms: dict[str, list[str]] = field(
        default_factory=lambda: {
            "core_paraphrase": ["lexical_paraphrase", "syntactic_reframe", "mechanism_focus_shift", "measurement_reframe", "experiment_design_reframe", "limitation_reframe"],
            "core_repair": ["unsupported_identifier_repair", "mechanism_grounding_repair", "core_operationalization_repair"],
            "anchored_extension": ["extension_reframing", "extension_operationalization", "extension_compare_baseline", "extension_experiment_design", "extension_limitation_analysis"],
        }
    )
    supports: dict[str, int] = field(default_factory=lambda: {"core_paraphrase": 4, "core_repair": 3, "anchored_extension": 5})
    tasks: dict[str, int] = field(default_factory=lambda: {"core_paraphrase": 8, "core_repair": 5, "anchored_extension": 10})
    per_support: int = 60
    provider: str = "provider-a"
    alternate: str = "provider-b"
    alternate_share: dict[str, float] = field(default_factory=lambda: {"state_refinement": 0.60, "broadcast_media": 0.35, "long_range_links": 0.35, "network_layer": 0.20, "large_scale_optimization": 0.20})
    tier_weight: dict[str, float] = field(default_factory=lambda: {"A": 1.00, "B": 0.82, "C": 0.55})
    route_weight: dict[str, float] = field(default_factory=lambda: {"core_paraphrase": 0.95, "core_repair": 0.82, "anchored_extension": 0.90})
    high: int = 8
    mid: int = 12
    version: str = "v1"


def _pick(key: Column, values: dict, default) -> Column:
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def model_buckets(seeds: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(model_name, model_bucket): the models with most seeds that aren't skipped are high_volume, then mid_volume, then long_tail; ties by name."""
    n = seeds.filter("route_mode <> 'skip' and model_name is not null").groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))
    r = F.row_number().over(Window.orderBy(F.desc("n"), "model_name"))  # one row per model
    return n.select("model_name", F.when(r <= plan.high, "high_volume").when(r <= plan.high + plan.mid, "mid_volume").otherwise("long_tail").alias("model_bucket"))


def provider_hint(plan: Plan, mode: Column, family: Column, seed: Column, transform: Column, support: Column) -> Column:
    """The alternate provider for a fixed share of each listed family's tasks, split by hash: the same task always goes the same way."""
    share = _pick(family, {f: round(s * 100) for f, s in plan.alternate_share.items()}, 0)
    bucket = sha1_mod(joined_key(seed, mode, family, transform, support), 100)
    return F.when((mode == "anchored_extension") & (bucket < share), plan.alternate).otherwise(plan.provider)


def priority(plan: Plan, tier: Column, mode: Column, score: Column, source: Column, relation: Column, jitter_key: Column, capacity: Column | None = None) -> Column:
    """Weights of tier, mode and support, and a small jitter by hash that settles ties; rounded to six digits."""
    base = _pick(F.coalesce(F.upper(tier), F.lit("C")), plan.tier_weight, 0.5) + _pick(mode, plan.route_weight, 0.7) + score / 100.0
    base = base + F.when(source == "corpus", 0.05).otherwise(0.0) - F.when(relation == "seed_only", 0.08).otherwise(0.0)
    if capacity is not None:
        base = base * F.coalesce(capacity, F.lit(1.0))
    return F.bround(base + sha1_mod(jitter_key, 1000) / 1_000_000.0, 6)


def enumerate_tasks(seeds: DataFrame, pools: DataFrame, plan: Plan = Plan(), capacities: DataFrame | None = None) -> DataFrame:
    """One row per task: every transform of a seed's mode with each of its first supports, best first, up to the mode's cap.

    seeds: seed_id (unique), model_name, class_id, tier, level, route_mode, extension_family. pools: as of
    support_pools. A seed without support gets tasks of relation seed_only. Modes without transforms, skip
    among them, get none. Tasks of equal key are one. Each support record gives at most plan.per_support tasks,
    the first by seed and rank.

    capacities: one row per model as of capacity.report. Then a seed's cap is the model's cap_<mode> where there
    is one, the priority before the jitter is multiplied with effective_capacity, and model_bucket is
    capacity_bucket; a model that is not listed is planned as without.
    """
    mode = F.col("route_mode")
    kinds = F.create_map(*[x for m, t in plan.transforms.items() for x in (F.lit(m), F.array(*[F.lit(v) for v in t]))])
    s = seeds.filter(mode.isin(list(plan.transforms)) & F.col("seed_id").isNotNull())
    most, room, worth = max(plan.tasks.values()), _pick(mode, plan.tasks, 4), None
    if capacities is not None:
        # Made per seed, before supports and transforms multiply the rows.
        own = [c for c in capacities.columns if c.startswith("cap_")]
        s = s.join(capacities.select("model_name", F.col("effective_capacity").alias("_worth"), F.col("capacity_bucket").alias("_bucket"), *own), "model_name", "left")
        caps = {m: F.coalesce(F.col(f"cap_{m}"), F.lit(plan.tasks.get(m, 4))) for m in plan.transforms if f"cap_{m}" in own}
        for m, c in caps.items():
            room = F.when(mode == m, c).otherwise(room)
        most = max([most, *[capacity_caps[f"cap_{m}"][1] for m in caps if f"cap_{m}" in capacity_caps]])
        worth = F.col("_worth")
    p = pools.select("seed_id", F.col("record_id").alias("support_record_id"), F.col("source").alias("support_source"), F.col("relation").alias("support_relation"), F.col("score").cast("double").alias("support_score"), F.col("rank").alias("_rank"))
    p = p.filter(F.col("_rank") <= max(plan.supports.values()))
    x = s.join(p, "seed_id", "left").filter(F.col("_rank").isNull() | (F.col("_rank") <= _pick(mode, plan.supports, 3)))
    x = x.withColumns({"support_source": F.coalesce("support_source", F.lit("seed_only")), "support_relation": F.coalesce("support_relation", F.lit("seed_only")), "support_score": F.coalesce("support_score", F.lit(0.0))})
    x = x.withColumn("transform_type", F.explode(kinds[mode]))
    x = x.withColumn("provider_hint", provider_hint(plan, mode, F.col("extension_family"), F.col("seed_id"), F.col("transform_type"), F.col("support_record_id")))
    fields = [F.col(c) for c in ("seed_id", "route_mode", "extension_family", "transform_type", "support_record_id", "provider_hint")]
    x = x.withColumn("task_key", F.sha1(joined_key(*fields, F.lit(plan.version))))
    jitter = joined_key(*[F.col(c) for c in ("seed_id", "route_mode", "extension_family", "support_record_id", "provider_hint")])
    x = x.withColumn("priority", priority(plan, F.col("tier"), mode, F.col("support_score"), F.col("support_source"), F.col("support_relation"), jitter, worth))
    best = Window.partitionBy("seed_id").orderBy(F.desc("support_score"), "transform_type", F.coalesce("support_record_id", F.lit("")))
    x = x.withColumn("_r", F.row_number().over(best)).filter((F.col("_r") <= most) & (F.col("_r") <= room))
    free = x.filter("support_record_id is null")
    tied = x.filter("support_record_id is not null").withColumn("_s", F.row_number().over(Window.partitionBy("support_record_id").orderBy("seed_id", "_r"))).filter(F.col("_s") <= plan.per_support).drop("_s")
    out = tied.unionByName(free).join(model_buckets(seeds, plan), "model_name", "left")
    names = ("task_key", "seed_id", "model_name", "class_id", "tier", "level", "route_mode", "extension_family", "transform_type", "support_record_id", "support_relation", "support_source", "support_score", "provider_hint", "priority")
    return out.select(*names, F.concat_ws("::", F.coalesce("tier", F.lit("None")), mode).alias("tier_route_key"), F.concat_ws("::", mode, F.col("transform_type"), F.lit(plan.version)).alias("template_id"), F.coalesce(*(["_bucket"] if capacities is not None else []), "model_bucket", F.lit("long_tail")).alias("model_bucket"))


def target_counts(total: int, shares: dict[str, float]) -> dict[str, int]:
    """Whole counts as they are; shares as floors of total, the rest one by one to the largest shares (ties by name)."""
    if all(isinstance(v, int) for v in shares.values()):
        return dict(shares)
    out = {k: int(total * v) for k, v in shares.items()}
    order = sorted(shares, key=lambda k: (-shares[k], k))
    for i in range(total - sum(out.values())) if order else ():
        out[order[i % len(order)]] += 1
    return out


def select_tasks(tasks: DataFrame, total: int, targets: dict[str, dict[str, int]], key: str = "task_key", order: str = "priority", strict: bool = False, only_in: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """`total` tasks by priority under the quotas of several columns: four passes that give up family, then provider, then all quotas.

    A column's null, and a value without target, is free. only_in: a column's quota counts and holds only tasks
    with a given value of another column, like families in the mode that has them: {column: (other, value)}. strict leaves out the last pass. One admission changes
    the counts that the next one sees, so this runs on the driver, over the first `total` tasks of each
    combination of what the quotas tell apart. That is exact: tasks of one combination fit or fail alike, so they
    are taken in order, and at most `total` of them in all. Values without target are one. With a single quota
    use quota_cut, which runs in the cluster.
    """
    dims = list(targets)
    scope = {d: F.col(c).eqNullSafe(F.lit(v)) for d, (c, v) in (only_in or {}).items()}
    told = [F.when(F.col(d).isin(list(targets[d])) & scope.get(d, F.lit(True)), F.col(d)).alias(d) for d in dims]
    by = [F.desc_nulls_last("_o"), F.col("_k")]
    lead = tasks.select(F.col(key).alias("_k"), F.col(order).alias("_o"), *told)
    lead = lead.withColumn("_n", F.row_number().over(Window.partitionBy(*dims).orderBy(*by))).filter(F.col("_n") <= total)
    rows = lead.orderBy(*by).select("_k", *dims).collect()
    used: dict[str, Counter] = {d: Counter() for d in dims}
    chosen: list = []
    taken = [False] * len(rows)
    soft = [d for d in ("extension_family",) if d in dims], [d for d in ("extension_family", "provider_hint") if d in dims], dims
    for dropped in ([], *soft[: 2 if strict else 3]):
        held = [d for d in dims if d not in dropped]
        for i, r in enumerate(rows):
            if len(chosen) >= total:
                break
            if taken[i] or any(r[d] is not None and r[d] in targets[d] and used[d][r[d]] >= targets[d][r[d]] for d in held):
                continue
            taken[i] = True
            chosen.append((r["_k"], len(chosen) + 1))
            for d in dims:
                used[d][r[d]] += 1
    picked = tasks.sparkSession.createDataFrame(chosen, f"`{key}` {dict(tasks.dtypes)[key]}, selected long")
    return tasks.join(picked, key)


def quota_cut(tasks: DataFrame, column: str, targets: dict[str, int], order: list[Column]) -> DataFrame:
    """The first targets[v] tasks of every listed value of one column by order; other values are free."""
    most = max(targets.values())
    limited = tasks.filter(F.col(column).isin(list(targets))).withColumn("_r", F.row_number().over(Window.partitionBy(column).orderBy(*order))).filter(F.col("_r") <= most)
    limited = limited.filter(F.col("_r") <= _pick(F.col(column), targets, 0)).drop("_r")
    return limited.unionByName(tasks.filter(~F.coalesce(F.col(column).isin(list(targets)), F.lit(False))))
