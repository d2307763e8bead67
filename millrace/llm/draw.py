"""Exact seeded prefixes: from every group the first rows of a seeded permutation, up to a given weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a bucket of the permutation holds in the mean, of the largest group, and bits of the number of buckets.
BUCKET_ROWS, LEAST_BITS, MOST_BITS = 65_536, 6, 20


def permuted_prefix(df: DataFrame, group: str, key: Column, quotas: dict[str, int], seed: int, weight: Column | None = None) -> DataFrame:
    """The rows of each group whose rank in a seeded permutation is within the group's quota.

    Without weight a group g gives exactly min(quotas[g], its rows) rows if keys are unique. With weight
    (non-negative whole numbers), rows are taken while the weight before them is below the quota, so the
    weight taken exceeds the quota by less than one row. Groups without a quota and rows of a null group give
    nothing. `quotas` must be a small map (one entry per category).

    The rank is that of the row's hash, and no group is sorted whole: hashes are counted in equal buckets, as
    many as the largest group needs to keep one small. A row of a bucket that ends below the quota is within,
    and only in the bucket where the quota ends are ranks made row by row.
    """
    spark = df.sparkSession
    wanted = [(g, int(q)) for g, q in quotas.items() if q > 0 and g is not None]
    if not wanted:
        return df.limit(0)
    one = (weight if weight is not None else F.lit(1)).cast("long")
    rows = df.withColumns({"_draw_h": F.xxhash64(F.lit(seed), key), "_draw_w": F.coalesce(one, F.lit(0))})
    largest = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (largest // BUCKET_ROWS).bit_length()))
    rows = rows.withColumn("_draw_b", F.shiftrightunsigned("_draw_h", 64 - bits).cast("int"))
    counts = rows.groupBy(F.col(group).alias("_draw_group"), "_draw_b").agg(F.sum("_draw_w").alias("_draw_sum"))
    quota = spark.createDataFrame(wanted, "_draw_qg string, _draw_quota long")
    before = F.coalesce(F.sum("_draw_sum").over(Window.partitionBy("_draw_group").orderBy("_draw_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = counts.join(F.broadcast(quota), F.col("_draw_group") == F.col("_draw_qg")).withColumn("_draw_before", before)
    # The last bucket that begins below the quota: one row per group of the map.
    cuts = cuts.filter(F.col("_draw_before") < F.col("_draw_quota")).groupBy("_draw_group", "_draw_quota").agg(F.max(F.struct("_draw_b", "_draw_before")).alias("_draw_edge"))
    cuts = cuts.select("_draw_group", "_draw_quota", F.col("_draw_edge._draw_b").alias("_draw_cb"), F.col("_draw_edge._draw_before").alias("_draw_before"))
    found = rows.join(F.broadcast(cuts), (F.col(group) == F.col("_draw_group")) & (F.col("_draw_b") <= F.col("_draw_cb")))
    inside = F.coalesce(F.sum("_draw_w").over(Window.partitionBy("_draw_group").orderBy("_draw_h", key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = found.filter("_draw_b < _draw_cb").select(*df.columns)
    edge = found.filter("_draw_b = _draw_cb").withColumn("_draw_in", inside).filter(F.col("_draw_before") + F.col("_draw_in") < F.col("_draw_quota")).select(*df.columns)
    return within.unionByName(edge)
