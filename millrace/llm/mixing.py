"""Sources mixed to target weights.

Capped water-filling: a source whose share asks for more than its allowed repetitions is clamped there and the
excess goes to the others in proportion to their weights, until all fits. Whole repetitions are given to every
document, the fraction to a seeded selection of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.draw import permuted_prefix


def water_fill(total: float, weight: dict[str, float], size: dict[str, int], repeats: dict[str, int]) -> dict[str, float]:
    """Amount of each source: proportional to weight, at most size * repeats, in all total where that is feasible."""
    top = {s: float(size.get(s, 0)) * max(0, repeats.get(s, 1)) for s in weight}
    out = dict.fromkeys(weight, 0.0)
    free = {s for s in weight if weight[s] > 0 and top[s] > 0}
    left = float(total)
    while free and left > 0:
        w = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / w >= top[s]}
        if not full:
            for s in free:
                out[s] = left * weight[s] / w
            break
        for s in full:
            out[s] = top[s]
        left -= sum(top[s] for s in full)
        free -= full
    return out


def plan_mix(sized: DataFrame, targets: DataFrame, source: str, size: str, total: int | None = None) -> list[dict]:
    """Per target source: weight, max repeats, documents, tokens there are and tokens wanted. One row per source of `targets`."""
    asked = {r["source"]: r for r in targets.select("source", "target_share", "max_repeats").collect() if r["source"] is not None}
    have = {r["_s"]: r for r in sized.filter(F.col(source).isin(list(asked))).groupBy(F.col(source).alias("_s")).agg(F.sum(size).alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    tokens = {s: int(have[s]["t"] or 0) if s in have else 0 for s in asked}
    weight = {s: float(r["target_share"] or 0) for s, r in asked.items()}
    repeats = {s: int(r["max_repeats"] or 0) for s, r in asked.items()}
    total = sum(tokens.values()) if total is None else total
    fill = water_fill(total, weight, tokens, repeats)
    return [{"source": s, "target_share": weight[s], "max_repeats": repeats[s], "documents": int(have[s]["n"]) if s in have else 0, "tokens": tokens[s], "wanted": fill[s], "total": total} for s in sorted(asked)]


def mix_sources(sized: DataFrame, plan: list[dict], source: str, key: Column, size: str, seed: int = 11) -> DataFrame:
    """The documents that take part, with `copies`, at most max_repeats each.

    Every document of a source gets the whole part of wanted / tokens; a seeded selection, cut at the wanted
    number of tokens, gets one more. Documents of no target source or of size null count nothing; those of
    size 0 get the whole copies only. Same seed and rows, same mix.
    """
    sized = sized.drop("copies")
    whole, extra = {}, {}
    for p in plan:
        if p["tokens"] > 0:
            whole[p["source"]] = int(p["wanted"] // p["tokens"])
            if whole[p["source"]] < p["max_repeats"]:
                extra[p["source"]] = round(p["wanted"] - whole[p["source"]] * p["tokens"])
    base = sized.filter(F.col(source).isin(list(whole))) if whole else sized.limit(0)
    times = F.create_map(*[F.lit(x) for kv in whole.items() for x in kv])[F.col(source)] if whole else F.lit(0)
    first = base.withColumn("copies", times.cast("int")).filter("copies > 0")
    more = permuted_prefix(base.filter(F.col(size) > 0), source, key, extra, seed, F.col(size)).withColumn("copies", F.lit(1))
    names = [c for c in sized.columns]
    return first.unionByName(more).groupBy(*names).agg(F.sum("copies").cast("int").alias("copies"))


def mix_report(mixed: DataFrame, plan: list[dict], source: str, size: str) -> DataFrame:
    """Per target source: target and actual share, tokens there are and taken, largest repetition, shortfall of tokens against the plain target."""
    got = {r["_s"]: r for r in mixed.groupBy(F.col(source).alias("_s")).agg(F.sum(F.col(size) * F.col("copies")).alias("taken"), F.max("copies").alias("most")).collect()}  # one row per target source
    total = sum(int(r["taken"] or 0) for r in got.values())
    rows = []
    for p in plan:
        r = got.get(p["source"])
        taken = int(r["taken"] or 0) if r else 0
        rows.append((p["source"], p["target_share"], p["max_repeats"], p["documents"], p["tokens"], taken, int(r["most"]) if r else 0, taken / total if total else 0.0, max(0.0, p["target_share"] * p["total"] - taken)))
    return mixed.sparkSession.createDataFrame(rows, "source string, target_share double, max_repeats int, documents long, tokens long, taken_tokens long, most_copies int, actual_share double, shortfall double")
