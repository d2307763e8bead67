"""Summaries of event logs, stop conditions, quotas and resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import durable


def summary(events: DataFrame, singles: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """(kind, key, key2, n): totals, counts by each single column and by each pair, in one pass by grouping sets.

    Null keys are left out of the single counts and pairs, not of the total.
    """
    cols = list(dict.fromkeys([*singles, *[c for p in pairs for c in p]]))
    sets = [[], *[[c] for c in singles], *[list(p) for p in pairs]]
    g = events.select(*cols).groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*cols).alias("_g"))
    out: Column | None = None
    keep: Column | None = None
    for s in sets:
        code = sum(0 if c in s else 1 << (len(cols) - 1 - i) for i, c in enumerate(cols))
        row = F.struct(F.lit("+".join(s) or "total").alias("kind"), (F.col(s[0]).cast("string") if s else F.lit(None).cast("string")).alias("key"), (F.col(s[1]).cast("string") if len(s) > 1 else F.lit(None).cast("string")).alias("key2"))
        ok = F.lit(True)
        for c in s:
            ok = ok & F.col(c).isNotNull()
        is_set = F.col("_g") == code
        out = F.when(is_set, row) if out is None else out.when(is_set, row)
        keep = F.when(is_set, ok) if keep is None else keep.when(is_set, ok)
    return g.filter(keep).select(out.alias("_r"), "n").select("_r.kind", "_r.key", "_r.key2", "n")


def histograms(rows: DataFrame, columns: list[str], most: dict[str, int] | None = None) -> DataFrame:
    """(kind, key, n): the total and the count of every value of each column, in one pass; of the columns in `most` only the most frequent values, ties by value. Nulls are left out."""
    x = summary(rows, columns, []).select("kind", "key", "n")
    if not most:
        return x
    cut = F.lit(None).cast("long")
    for c, k in most.items():
        cut = F.when(F.col("kind") == c, F.lit(k)).otherwise(cut)
    w = Window.partitionBy("kind").orderBy(F.desc("n"), "key")
    limited = F.col("kind").isin(list(most))
    # The constant bound cuts a long histogram before the shuffle.
    top = x.filter(limited).withColumn("_r", F.row_number().over(w)).filter((F.col("_r") <= max(most.values())) & (F.col("_r") <= cut)).drop("_r")
    return x.filter(~limited).unionByName(top)


def stop_reason(total: Column, bad_json: Column, failed: Column, template_dup: Column, accepted: Column) -> Column:
    """Why a tranche ends the run, null if it does not: first empty, then the rates against their fixed limits."""

    def rate(n: Column) -> Column:
        return n / total

    def told(name: str, n: Column) -> Column:
        return F.format_string(f"{name}=%.2f%%", rate(n) * 100)

    return (
        F.when(total == 0, "EMPTY_TRANCHE")
        .when(rate(bad_json) > 0.05, told("BAD_JSON_RATE", bad_json))
        .when(rate(failed) > 0.05, told("LLM_ERROR_RATE", failed))
        .when(rate(template_dup) > 0.25, told("TEMPLATE_DUP_RATE", template_dup))
        .when(rate(accepted) < 0.75, told("ACCEPTANCE_RATE", accepted))
    )


def tranche_stops(events: DataFrame, tranche: str = "tranche") -> DataFrame:
    """Per tranche: total, the counts that the conditions look at, and stop_reason. events: tranche, status, reason."""
    n = lambda *r: F.count_if(F.col("reason").isin(*r))
    x = events.groupBy(tranche).agg(
        F.count(F.lit(1)).alias("total"),
        n("BAD_JSON").alias("bad_json"),
        n("LLM_ERROR", "NO_RESPONSE").alias("failed"),
        n("QUESTION_TEMPLATE_DUP", "NEAR_DUP_QUESTION").alias("template_dup"),
        F.count_if(F.col("status") == "accepted").alias("accepted"),
    )
    return x.withColumn("stop_reason", stop_reason(*[F.col(c) for c in ("total", "bad_json", "failed", "template_dup", "accepted")]))


def rates(events: DataFrame, by: str, groups: dict[str, list[str]]) -> DataFrame:
    """Per `by`: events, accept_rate, reject_rate (any other status) and <name>_rate of each named group of reasons."""
    ok = F.count_if(F.col("status") == "accepted")
    n = F.count(F.lit(1))
    x = events.filter(F.col(by).isNotNull()).groupBy(by)
    return x.agg(n.alias("events"), (ok / n).alias("accept_rate"), ((n - ok) / n).alias("reject_rate"), *[(F.count_if(F.col("reason").isin(r)) / n).alias(f"{name}_rate") for name, r in groups.items()])


#: Caps of the admission check; the share of a mode is of the model's cap, rounded down.
QUOTA = {"per_model": 50_000, "per_mode": {"core_paraphrase": 0.30, "core_repair": 0.20, "anchored_extension": 0.50}, "per_family": 10_000, "per_seed_per_mode": 5, "per_seed_per_family": 3}


def admit(candidates: DataFrame, history: DataFrame, quota: dict = QUOTA) -> DataFrame:
    """Candidates with `refused`: the first cap that accepted history has reached, null if none.

    Both sides: model_name, route_mode, extension_family, seed_id; null counts as "unknown". The caps look at
    history only, so candidates don't compete with each other. Each count is made by partial aggregation and
    joined by its own key.
    """
    dims = ["model_name", "route_mode", "extension_family", "seed_id"]
    fill = {d: F.coalesce(F.col(d), F.lit("unknown")).alias(f"_{d}") for d in dims}
    h = history.select(*fill.values())
    x = candidates.select("*", *fill.values())
    keys = {"_n_model": ["_model_name"], "_n_mode": ["_model_name", "_route_mode"], "_n_family": ["_extension_family"], "_n_seed_mode": ["_seed_id", "_route_mode"], "_n_seed_family": ["_seed_id", "_extension_family"]}
    for name, by in keys.items():
        x = x.join(h.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), by, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    share = F.lit(None).cast("long")
    for mode, part in quota["per_mode"].items():
        share = F.when(F.col("_route_mode") == mode, F.lit(int(quota["per_model"] * part))).otherwise(share)
    has_family = F.col("_extension_family") != "unknown"
    refused = (
        F.when(F.col("_n_model") >= quota["per_model"], "MODEL_QUOTA")
        .when(F.col("_n_mode") >= share, "MODE_QUOTA")
        .when(has_family & (F.col("_n_family") >= quota["per_family"]), "FAMILY_QUOTA")
        .when(F.col("_n_seed_mode") >= quota["per_seed_per_mode"], "SEED_MODE_QUOTA")
        .when(has_family & (F.col("_n_seed_family") >= quota["per_seed_per_family"]), "SEED_FAMILY_QUOTA")
    )
    return x.select(*candidates.columns, refused.alias("refused"))


def unseen(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among those done; a null key was never done."""
    return df.join(done.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def pick_tranche(tasks: DataFrame, n: int, order: list[Column], mode: str | None = None, remaining: dict[str, int] | None = None) -> DataFrame:
    """The first n tasks by order, of each mode in `remaining` at most that many; other modes are free."""
    x = tasks
    if mode and remaining:
        limit = F.create_map(*[F.lit(v) for kv in remaining.items() for v in kv])[F.col(mode)]
        most = max(remaining.values())
        limited = x.filter(F.col(mode).isin(list(remaining))).withColumn("_r", F.row_number().over(Window.partitionBy(mode).orderBy(*order)))
        limited = limited.filter((F.col("_r") <= most) & (F.col("_r") <= limit)).drop("_r")
        x = x.filter(~F.coalesce(F.col(mode).isin(list(remaining)), F.lit(False))).unionByName(limited)
    return x.orderBy(*order).limit(n)


def chunks(df: DataFrame, size: int, by: str, order: list[Column]) -> DataFrame:
    """Rows numbered within `by` and cut into chunks of a fixed size: chunk counts from 0; null is a value of its own.

    No value is gathered in one task: rows are sorted in ranges over all tasks, counted per range and value,
    and numbered from where their range begins within the value.
    """
    part = df.repartitionByRange(F.col(by), *order).sortWithinPartitions(F.col(by), *order)
    part = durable(part.withColumn("_chunk_part", F.spark_partition_id()).withColumn("_chunk_row", F.monotonically_increasing_id()))
    own = F.col(by).alias("_chunk_by")
    counts = part.groupBy("_chunk_part", own).agg(F.count(F.lit(1)).alias("_chunk_n"), F.min("_chunk_row").alias("_chunk_first"))
    earlier = Window.partitionBy("_chunk_by").orderBy("_chunk_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_chunk_start", F.coalesce(F.sum("_chunk_n").over(earlier), F.lit(0))).withColumnRenamed("_chunk_part", "_chunk_of")
    x = part.join(starts, (F.col("_chunk_part") == F.col("_chunk_of")) & F.col(by).eqNullSafe(F.col("_chunk_by")))
    at = F.col("_chunk_start") + F.col("_chunk_row") - F.col("_chunk_first")
    return x.select(*[F.col(f"`{c}`") for c in df.columns if c != "chunk"], F.floor(at / size).cast("long").alias("chunk"))


def collection_rate(asked: DataFrame, got: DataFrame, key: str, by: str) -> DataFrame:
    """Per `by`: requests, distinct answers to them, and their share."""
    x = asked.select(by, key).distinct().join(got.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return x.groupBy(by).agg(F.count(F.lit(1)).alias("asked"), F.count("_hit").alias("collected"), (F.count("_hit") / F.count(F.lit(1))).alias("rate"))
