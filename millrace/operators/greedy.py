"""Greedy admission in order: a row is accepted if no accepted earlier row is in conflict with it.

Which rows conflict is given by pairs (same question, or similarity above a threshold). The sequential rule is
carried out in rounds: a row is accepted once all its earlier neighbours are rejected, and rejected once one
of them is accepted. The order has no cycles, so every round settles at least the first open row of each
group, and chains settle in parallel.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import durable


def admit_in_order(rows: DataFrame, conflicts: DataFrame, key: str) -> DataFrame:
    """(key, accepted, by): every row of rows; by is the first accepted earlier row that it conflicts with.

    conflicts: (earlier, later), each a key. Rows without conflicts are accepted at once. Only rows in
    conflicts take part in the rounds, of which there are as many as the longest chain of conflicts asks for:
    each settles at least the first open row.
    """
    edges = durable(conflicts.select("earlier", "later").filter("earlier is not null and later is not null and earlier <> later").distinct())
    open_ = durable(edges.select(F.col("later").alias("k")).distinct())
    accepted = edges.select(F.col("earlier").alias("k")).distinct().join(open_, "k", "left_anti")
    done = durable(accepted.select("k", F.lit(True).alias("ok"), F.lit(None).cast(dict(edges.dtypes)["earlier"]).alias("by")))
    while open_.limit(1).count():
        state = edges.join(open_.withColumnRenamed("k", "later"), "later").join(done.select(F.col("k").alias("earlier"), "ok"), "earlier", "left")
        seen = state.groupBy("later").agg(F.count_if(F.col("ok").isNull()).alias("waiting"), F.min(F.when(F.col("ok"), F.col("earlier"))).alias("by"))
        settled = durable(seen.filter("by is not null or waiting = 0").select(F.col("later").alias("k"), F.col("by").isNull().alias("ok"), "by"))
        done = durable(done.unionByName(settled))
        open_ = durable(open_.join(settled.select("k"), "k", "left_anti"))
    x = rows.select(key).join(done.withColumnRenamed("k", key), key, "left")
    return x.select(key, F.coalesce("ok", F.lit(True)).alias("accepted"), "by")


#: Vectors that a key holds in the mean, and those beyond which a key is paired block by block.
PER_KEY, HOT = 256, 4096
#: Chance that a pair at the threshold shares no key, at most.
MISS = 1e-6


def bits_and_bands(n: int, threshold: float) -> tuple[int, int]:
    """Signs in a key, so that a key holds PER_KEY vectors in the mean whatever their number, and keys, so that a pair at the threshold misses with a chance of MISS at most."""
    bits = min(24, max(4, math.ceil(math.log2(max(n, 1) / PER_KEY + 1))))
    share = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    hit = share**bits
    return bits, 1 if hit >= 1 else max(1, math.ceil(math.log(MISS) / math.log1p(-hit)))


def cosine_pairs(vectors: DataFrame, key: str, vector: str, threshold: float, size: int, seed: int = 7, hot: int | None = None) -> DataFrame:
    """(earlier, later, similarity) with earlier < later: vectors whose cosine is at least threshold.

    Candidates share a key of random-hyperplane signs; bits_and_bands says how many. They are verified exactly.
    A key of more than `hot` vectors (HOT) is paired block by block, in tasks of their own. Null vectors, those
    of another size or with a null, and those without length are in no pair.
    """
    from collections.abc import Iterator

    import pyarrow as pa

    bits, bands = bits_and_bands(vectors.count(), threshold)
    planes = np.random.default_rng(seed).standard_normal((size, bits * bands)).astype(np.float32)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 2 ** np.arange(bits)
        for batch in batches:
            lists = batch.column(1)
            ok = np.array([v is not None and len(v) == size and None not in v for v in lists.to_pylist()], bool)
            b = batch.filter(pa.array(ok))
            x = np.array(b.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, size)
            some = np.flatnonzero(np.abs(x).sum(axis=1) > 0)
            for lo in range(0, len(some), 1024):
                at = some[lo : lo + 1024]
                code = ((x[at] @ planes > 0).reshape(len(at), bands, bits) * weights).sum(axis=2) + (np.arange(bands, dtype=np.int64) << bits)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.repeat(at, bands))), pa.array(code.reshape(-1), pa.int64())], ["k", "code"])

    kind = dict(vectors.dtypes)[key]
    coded = durable(vectors.select(key, vector).mapInArrow(keys, f"k {kind}, code long"))
    sizes = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / (hot or HOT)).alias("_n")).filter("_n > 1")
    blocked = coded.join(sizes, "code", "left").select("k", "code", F.coalesce("_n", F.lit(1)).alias("_n")).withColumn("_own", F.pmod(F.xxhash64("k"), F.col("_n")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    a = blocked.select("k", "code", F.col("_own").alias("i"), every.alias("j")).alias("a")
    b = blocked.select("k", "code", every.alias("i"), F.col("_own").alias("j")).alias("b")
    same = (F.col("a.code") == F.col("b.code")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    met = a.join(b, same & (F.col("a.k") < F.col("b.k"))).select(F.col("a.k").alias("earlier"), F.col("b.k").alias("later")).distinct()
    from millrace.operators.gates import cosine

    v = vectors.select(F.col(key).alias("k"), F.col(vector).alias("v"))
    both = met.join(v.select(F.col("k").alias("earlier"), F.col("v").alias("va")), "earlier").join(v.select(F.col("k").alias("later"), F.col("v").alias("vb")), "later")
    return both.select("earlier", "later", cosine(F.col("va"), F.col("vb")).alias("similarity")).filter(F.col("similarity") >= threshold)
