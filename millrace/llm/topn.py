"""The N best items of every group, also of groups of millions of items.

Hot-cold split: exact counts of rows send heavy groups to a range sort, in which a group is cut into as many
runs as its size needs (the range partition is the salt), and light groups to an ordinary ranked window. Both
results are ranked the same way and united.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A group of more rows than this is heavy ...
HEAVY_ROWS = 50_000
#: ... and than total / MAX_HEAVY, so there are at most this many heavy groups and their list is small at any size.
MAX_HEAVY = 1_000


def heavy_groups(df: DataFrame, group: str, heavy_rows: int = HEAVY_ROWS, max_heavy: int = MAX_HEAVY) -> list:
    """Values of group with more than max(heavy_rows, total / max_heavy) rows: at most max_heavy values."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    return [r[0] for r in counts.filter(F.col("_n") > max(heavy_rows, total // max_heavy)).select(group).collect()]


def top_n(df: DataFrame, group: str, item: str, score: str, n: int, full_only: bool = False, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(group, item, score, rank) of the n best items of each group.

    An item listed several times in a group counts once, with its highest score. Rows whose score or item is
    null or NaN do not compete; a null group is a group. Equal scores are ordered by ascending item (code
    point). rank counts from 1 without gaps. full_only keeps only groups with more than n competing items.
    An empty table gives no rows; other columns are dropped.
    """
    slim = df.select(F.col(f"`{group}`").alias("_g"), F.col(f"`{item}`").alias("_i"), F.col(f"`{score}`").alias("_s"))
    slim = slim.filter(F.col("_i").isNotNull() & F.col("_s").isNotNull() & ~F.isnan(F.col("_s").cast("double")))
    heavy = heavy_groups(slim, "_g", heavy_rows)
    best = slim.groupBy("_g", "_i").agg(F.max("_s").alias("_s"))
    order = [F.col("_s").desc(), F.col("_i").asc()]
    take = n + full_only
    # The filter on the rank lets Spark cut each group to `take` rows before the shuffle.
    final = Window.partitionBy("_g").orderBy(*order)

    def ranked(x: DataFrame) -> DataFrame:
        return x.withColumn("_r", F.row_number().over(final)).filter(F.col("_r") <= take)

    null_heavy = any(g is None for g in heavy)
    values = [g for g in heavy if g is not None]
    is_heavy = F.coalesce(F.col("_g").isin(values), F.lit(False)) if values else F.lit(False)
    if null_heavy:
        is_heavy = is_heavy | F.col("_g").isNull()
    out = ranked(best.filter(~is_heavy) if heavy else best)
    if heavy:
        runs = best.filter(is_heavy).repartitionByRange(F.col("_g").asc(), *order).withColumn("_run", F.spark_partition_id())
        within = Window.partitionBy("_g", "_run").orderBy(*order)
        cut = runs.withColumn("_q", F.row_number().over(within)).filter(F.col("_q") <= take).drop("_q", "_run")
        out = out.unionByName(ranked(cut))
    if full_only:
        whole = Window.partitionBy("_g")
        out = out.withColumn("_most", F.max("_r").over(whole)).filter((F.col("_most") > n) & (F.col("_r") <= n))
    return out.select(F.col("_g").alias(group), F.col("_i").alias(item), F.col("_s").alias(score), F.col("_r").alias("rank"))
