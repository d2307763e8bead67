"""Support pools: the best records of every seed's model, without comparing every seed with every record.

All seeds of one kind (model, class, level) score a record alike, and within a stratum (model, class, level,
source) all records score alike and are told apart by their id only. So of each stratum only the first few ids
can enter any pool. A kind meets all strata of its own class, but of the other classes only the first ids per level
and source: with k per stratum, the first 2 k of these hold k of other classes, whichever the kind's own is. A
kind's work is thus the same however many records and classes its model has; a seed then drops its own records from
its kind's pool. A pool is cut with as many to spare as it has places. Only the seeds that lose more than that to
their own records draw again, from a longer pool of their kind, until each has its k or its kind has no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import durable

# What counts how much.
SAME_MODEL, SAME_CLASS, SAME_LEVEL = 50, 40, 5
SOURCE_BONUS = {"corpus": 8, "seed": 3}
#: Places to spare for each place of a pool, before a seed's own records are dropped from it.
SPARE = 1


def support_pools(seeds: DataFrame, records: DataFrame, k: int = 12, sources: tuple[str, ...] = ("corpus", "seed")) -> DataFrame:
    """(seed_id, record_id, source, relation, score, rank): up to k records of the seed's model for each seed.

    seeds: seed_id (unique, not null), model_name, class_id, level; records: record_id, source, source_id,
    seed_id, model_name, class_id, level. A record listed several times counts with its highest score. A seed's
    own records are left out. Order: score descending, record_id ascending. Null models match nothing, null
    classes and levels are equal to none.
    """
    rec = records.filter(F.col("source").isin(list(sources)) & F.col("record_id").isNotNull() & F.col("model_name").isNotNull())
    rec = rec.select("record_id", "source", "model_name", "class_id", "level", F.col("seed_id").alias("own"), F.when(F.col("source") == "seed", F.col("source_id")).alias("made_of")).distinct()
    kind = F.xxhash64("model_name", F.coalesce(F.col("class_id").cast("string"), F.lit("~")), F.coalesce("level", F.lit("~")))
    s = seeds.filter("seed_id is not null and model_name is not null").select("seed_id", "model_name", "class_id", "level").withColumn("kind", kind)
    own = rec.select(F.explode(F.array_distinct(F.array_compact(F.array("own", "made_of")))).alias("seed_id"), "record_id").distinct()
    done: DataFrame | None = None
    most = k + SPARE * k
    while True:
        drawn = durable(_drawn(s, rec, own, k, most))
        ready = drawn.filter("not short").drop("short")
        done = ready if done is None else done.unionByName(ready)
        short = drawn.filter("short").select("seed_id").distinct()
        if not short.limit(1).count():
            return done.filter("record_id is not null")
        # Few seeds, so only their kinds and models are read again.
        s = durable(s.join(short, "seed_id", "left_semi"))
        rec = rec.join(s.select("model_name").distinct(), "model_name", "left_semi")
        most *= 8


def _drawn(s: DataFrame, rec: DataFrame, own: DataFrame, k: int, most: int) -> DataFrame:
    """The pools of the seeds s from the first `most` of their kinds' pools, with `short` for a seed that may have more to draw; a seed without any has one row of nulls."""
    stratum = Window.partitionBy("model_name", "class_id", "level", "source").orderBy("record_id")
    # Read twice below and small: `most` rows a stratum.
    lead = durable(rec.withColumn("_r", F.row_number().over(stratum)).filter(F.col("_r") <= most).drop("_r"))
    kinds = s.select("model_name", "class_id", "level", "kind").distinct()
    first = Window.partitionBy("model_name", "level", "source").orderBy("record_id", "class_id")
    others = lead.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= 2 * most).drop("_r")
    same_class = F.coalesce(F.col("a.class_id") == F.col("b.class_id"), F.lit(False))
    same_level = F.coalesce(F.col("a.level") == F.col("b.level"), F.lit(False))
    bonus = F.lit(0)
    for src, v in SOURCE_BONUS.items():
        bonus = F.when(F.col("b.source") == src, v).otherwise(bonus)
    score = F.lit(SAME_MODEL) + F.when(same_class, SAME_CLASS).otherwise(0) + F.when(same_level, SAME_LEVEL).otherwise(0) + bonus

    def scored(side: DataFrame, on) -> DataFrame:
        met = kinds.alias("a").join(side.alias("b"), on)
        return met.select("a.kind", "b.record_id", "b.source", F.when(same_class, "same_class_same_model").otherwise("same_model").alias("relation"), score.alias("score"))

    same_model = F.col("a.model_name") == F.col("b.model_name")
    x = scored(lead, same_model & (F.col("a.class_id") == F.col("b.class_id"))).unionByName(scored(others, same_model))
    best = x.groupBy("kind", "record_id").agg(F.max(F.struct("score", "source", "relation")).alias("m"))
    order = Window.partitionBy("kind").orderBy(F.desc("m.score"), "record_id")
    pool = best.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most)
    every = s.select("seed_id", "kind").join(pool, "kind").join(own, ["seed_id", "record_id"], "left_anti")
    rank = Window.partitionBy("seed_id").orderBy(F.desc("m.score"), "record_id")
    kept = every.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    kept = kept.select("seed_id", "record_id", F.col("m.source").alias("source"), F.col("m.relation").alias("relation"), F.col("m.score").alias("score"), "rank")
    sizes = pool.groupBy("kind").agg(F.max("_r").alias("_size"))
    got = kept.groupBy("seed_id").agg(F.max("rank").alias("_got"))
    ends = s.select("seed_id", "kind").join(sizes, "kind", "left").join(got, "seed_id", "left")
    ends = ends.select("seed_id", (F.coalesce("_size", F.lit(0)) >= most).alias("_cut"), F.coalesce("_got", F.lit(0)).alias("_got"))
    return ends.join(kept, "seed_id", "left").withColumn("short", F.col("_cut") & (F.col("_got") < k)).drop("_cut", "_got")


def pool_summary(pools: DataFrame, seeds: DataFrame) -> DataFrame:
    """(kind, key, value): seeds, average, smallest and largest size of their pools, empty ones included, and entries by relation and by source."""
    n = seeds.select("seed_id").distinct().join(pools.groupBy("seed_id").agg(F.count(F.lit(1)).alias("n")), "seed_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    one = n.agg(F.count(F.lit(1)).cast("double").alias("seeds"), F.round(F.avg("n"), 4).alias("avg_size"), F.min("n").cast("double").alias("min_size"), F.max("n").cast("double").alias("max_size"))
    whole = one.select(F.inline(F.array(*[F.struct(F.lit("pools").alias("kind"), F.lit(c).alias("key"), F.col(c).alias("value")) for c in one.columns])))
    g = pools.groupingSets([[F.col("relation")], [F.col("source")]], "relation", "source").agg(F.count(F.lit(1)).cast("double").alias("value"), F.grouping("relation").alias("_by_source"))
    by = g.select(F.when(F.col("_by_source") == 1, "source").otherwise("relation").alias("kind"), F.coalesce(F.when(F.col("_by_source") == 1, F.col("source")).otherwise(F.col("relation")), F.lit("none")).alias("key"), "value")
    return whole.unionByName(by)
