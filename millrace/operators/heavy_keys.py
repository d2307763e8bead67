"""Per-key totals where a few keys hold most rows.

Keys are dictionary-encoded to dense numbers; every input split adds its rows into dense numpy arrays
(bincount for counts, a scatter-reduce for the best row), and the blocks of these arrays are summed by a
distributed reduction. A key of a third of all rows costs each split one array cell, so no task gets more
work than its equal share of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import durable

BLOCK = 512
#: Blocks held by a task before they are put out; bounds its memory at BLOCK * FLUSH cells.
FLUSH = 256
#: A dictionary of up to this many keys of up to KEY_BYTES bytes in the mean (32 MB) is sent to every executor; a larger one is joined by shuffle.
MAX_BROADCAST_KEYS = 200_000
KEY_BYTES = 160


#: Of a larger dictionary the most frequent keys, at most so many and none of more bytes, are sent to every executor, so that only rows of rarer keys are shuffled to meet it.
HEAVY_KEYS, HEAVY_BYTES = 1_000, 32_768


def dictionary(df: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """(keys..., key_id) with ids dense within blocks, and whether its size is proven small; a large one has `key_rows` as well."""
    spark = df.sparkSession
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    head = counted.select(*keys).limit(MAX_BROADCAST_KEYS + 1).toArrow()
    if head.num_rows <= MAX_BROADCAST_KEYS and head.nbytes <= MAX_BROADCAST_KEYS * KEY_BYTES:
        head = head.sort_by([(k, "ascending") for k in keys])
        ids = pa.array(np.arange(head.num_rows), pa.int64())
        return spark.createDataFrame(head.append_column("key_id", ids)), True
    # Ids made in place are not the same when a task runs again, so they are fixed in the shared folder.
    return durable(counted.withColumn("key_id", F.monotonically_increasing_id())), False


def heavy(codes: DataFrame, keys: list[str]) -> DataFrame:
    """The codes of the most frequent keys, a bounded number of rows of bounded length."""
    size = F.lit(0)
    for k in keys:
        size = size + F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0))
    return codes.filter(size <= HEAVY_BYTES).orderBy(F.desc("key_rows"), "key_id").limit(HEAVY_KEYS)


def encode(df: DataFrame, keys: list[str], codes: DataFrame, small: bool) -> DataFrame:
    """The rows of df with key_id in place of the keys."""
    rest = [c for c in df.columns if c not in keys]

    def coded(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
        own = side.select("key_id", *[F.col(k).alias(f"_c{k}") for k in keys])
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_c{k}"))
        return rows.join(own, cond, how)

    if small:
        return coded(df, F.broadcast(codes)).select("key_id", *rest)
    top = durable(heavy(codes, keys))
    frequent = coded(df, F.broadcast(top)).select("key_id", *rest)
    rare = coded(coded(df, F.broadcast(top), "left_anti"), codes.join(F.broadcast(top.select("key_id")), "key_id", "left_anti")).select("key_id", *rest)
    return frequent.unionByName(rare)


def _accumulate(best: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def put() -> pa.RecordBatch:
            blocks = sorted(held)
            cols = [pa.array(blocks, pa.int64()), pa.array([held[b][0].tolist() for b in blocks], pa.list_(pa.int64()))]
            names = ["block", "n"]
            if best:
                cols += [pa.array([held[b][1].tolist() for b in blocks], pa.list_(pa.float64())), pa.array([held[b][2].tolist() for b in blocks], pa.list_(pa.string()))]
                names += ["top", "who"]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, names)

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            blocks = ids // BLOCK
            if best:
                score = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                score = np.where(np.isnan(score), -np.inf, score)
                who = batch.column(2)
            for b in np.unique(blocks):
                at = np.flatnonzero(blocks == b)
                cell = (ids[at] - b * BLOCK).astype(np.int64)
                own = held.get(b)
                if own is None:
                    own = held[int(b)] = [np.zeros(BLOCK, np.int64)] + ([np.full(BLOCK, -np.inf), np.full(BLOCK, None, object)] if best else [])
                own[0] += np.bincount(cell, minlength=BLOCK)
                if best:
                    high = np.full(BLOCK, -np.inf)
                    np.maximum.at(high, cell, score[at])
                    ties = np.flatnonzero((score[at] == high[cell]) & (high[cell] >= own[1][cell]))
                    for c, name in zip(cell[ties].tolist(), who.take(pa.array(at[ties])).to_pylist(), strict=True):
                        if name is not None and (high[c] > own[1][c] or own[2][c] is None or name < own[2][c]):
                            own[1][c], own[2][c] = high[c], name
            if len(held) >= FLUSH:
                yield put()
        if held:
            yield put()

    return run


def _reduced(blocks: DataFrame, best: bool) -> DataFrame:
    """Sums the array blocks cell by cell; each split sends a cell once, whatever its rows."""
    cells = blocks.select("block", F.posexplode(F.arrays_zip(*[c for c in ("n", "top", "who") if c in blocks.columns])).alias("cell", "x")).filter("x.n > 0")
    aggs = [F.sum("x.n").alias("n")]
    if best:
        # The smallest of (-score, id) is the highest score with the first id.
        aggs.append(F.min(F.when(F.col("x.who").isNotNull(), F.struct((-F.col("x.top")).alias("minus"), F.col("x.who").alias("who")))).alias("best"))
    return cells.groupBy((F.col("block") * BLOCK + F.col("cell")).alias("key_id")).agg(*aggs)


def key_totals(df: DataFrame, keys: list[str], distinct_of: str | None = None, score: str | None = None, item: str | None = None) -> DataFrame:
    """One row per distinct combination of keys: keys, rows, and where asked for distinct values and the best item.

    rows counts every row, repeats included. distinct (with distinct_of) counts the different non-null values
    of that column. best (with score and item) is the item of highest score, the first by code point among
    equals; null and NaN scores count below all others, null items never win. Null keys form a key of their
    own. An empty table gives no rows. Other columns, also ones called key_id or n, are ignored.
    """
    cols = {f"_k{i}": F.col(f"`{k}`") for i, k in enumerate(keys)}
    slim = df.select(*[c.alias(a) for a, c in cols.items()], *([F.col(f"`{distinct_of}`").alias("_d")] if distinct_of else []), *([F.col(f"`{score}`").cast("double").alias("_s"), F.col(f"`{item}`").cast("string").alias("_i")] if score and item else []))
    names = list(cols)
    codes, small = dictionary(slim, names)
    best = bool(score and item)
    rows = encode(slim.select(*names, *(["_s", "_i"] if best else [])), names, codes, small)
    schema = "block long, n array<long>" + (", top array<double>, who array<string>" if best else "")
    out = _reduced(rows.mapInArrow(_accumulate(best), schema), best)
    out = out.select("key_id", F.col("n").alias("_rows"), *([F.col("best.who").alias("_best")] if best else []))
    if distinct_of:
        # Repeats collapse before the shuffle; a heavy key is spread by the counted value.
        once = slim.filter("_d is not null").select(*names, "_d").distinct()
        seen = _reduced(encode(once, names, codes, small).select("key_id").mapInArrow(_accumulate(False), "block long, n array<long>"), False)
        out = out.join(seen.select("key_id", F.col("n").alias("_distinct")), "key_id", "left")
    result = out.join(F.broadcast(codes) if small else codes, "key_id")
    return result.select(*[F.col(a).alias(k) for a, k in zip(names, keys, strict=True)], F.col("_rows").alias("rows"), *([F.coalesce("_distinct", F.lit(0)).cast("long").alias("distinct")] if distinct_of else []), *([F.col("_best").alias("best")] if best else []))
