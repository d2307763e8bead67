"""Connected components of a graph of pairs, in the cluster.

Large-star and small-star steps in turn: every node hangs its larger neighbours, then its smaller ones and
itself, under the smallest it knows, until nothing changes. The number of rounds grows with the logarithm of
the longest chain. Edges never gather in one row, a node's smallest neighbour is found by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import durable


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = down.join(_least(down), "u")
    moved = hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(hung.select("u", F.col("m").alias("v"))).distinct()


def components(pairs: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(node, component): every node of a pair with the smallest node it is linked to, directly or not.

    Pairs of a node with itself are dropped, as are pairs with a null; repeats and direction don't matter. No
    pairs, no rows.
    """
    edges = durable(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())

    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = state(edges)
    for _ in range(max_rounds):
        edges = durable(_small_star(_large_star(edges)))
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"not settled after {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
