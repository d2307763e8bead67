"""Pairs of texts that share at least a given part of their runs of three words.

Multi-index Hamming join. A text's signature has SYMBOLS symbols of 16 bits (b-bit minwise hashes of its
runs), of which CHUNKS chunks of WIDTH are indexed and all give a sketch of one bit each. Every chunk is looked
up with ERRORS errors allowed, by enumerating the ways to leave that many symbols out. By the pigeonhole
principle every pair whose indexed symbols differ in at most RADIUS of all places meets. A pair of similarity s
differs in (1 - s) of them in the mean, so of the pairs at 0.5 exactly 82 % are within the radius, at 0.55 93 %
and at 0.6 98 %; beyond it pairs still meet in most cases (at 0.5 98.4 % of all do). What meets is held against
the sketch distance and, at the end, exactly against the runs.

Equal texts are one class and are compared once; classes are known by the hash of their words. The join runs in
parts: a chunk's keys are grouped by the first symbol that they keep, so that a text stands in three parts of a
chunk however many there are, and a part holds TEXTS_PER_PART texts in the mean. Keys travel as packed arrays.
Symbols and keys that very many texts share are found on a sample beforehand; such a symbol's keys are spread
by the whole key, and what such a key holds is not gathered but paired block by block, in tasks of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shingles import RUN, class_id, distinct_runs, mix64, runs_of, words_of
from millrace.session import durable

CHUNKS, WIDTH, ERRORS = 6, 5, 2
INDEXED = CHUNKS * WIDTH
#: Indexed symbols that may differ for a pair to meet surely.
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: The symbols that each key of a chunk keeps, grouped by the first of them.
_KEPT = list(combinations(range(WIDTH), WIDTH - ERRORS))
_GROUPS = [[k for k, kept in enumerate(_KEPT) if kept[0] == first] for first in range(ERRORS + 1)]
SYMBOLS = 128  # the first INDEXED are indexed; all of them are in the sketch
#: Sketch bits that may differ. A pair of similarity s differs in (1 - s) / 2 of them in the mean: 32 at 0.5, with a standard deviation of 4.9.
SKETCH_BITS = 43
HOT = 8192
#: Texts that a part of the join holds in the mean. A symbol or key of more than CROWD of that is spread beforehand.
TEXTS_PER_PART = 100_000
CROWD = 0.25
#: Texts of a symbol or key at the limit that the sample holds in the mean, and texts that a task packs at once.
SEEN, FLUSH_TEXTS = 64, 32_768
#: Fixed size of the filter over the classes in candidate pairs: 2^23 bits (1 MB), whatever the input.
FILTER_BITS = 23
_rng = np.random.default_rng(20240229)
_A = (_rng.integers(1, 2**63, SYMBOLS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def signatures(words: list[list[str]]) -> np.ndarray:
    """(texts, SYMBOLS) symbols of 16 bits; every text must have a run."""
    n, h = runs_of(words)
    at = np.cumsum(n) - n
    out = np.empty((len(n), SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        out[:, k] = (mix64(np.minimum.reduceat(h * _A[k], at)) >> np.uint64(48)).astype(np.uint16)
    return out


def chunk_keys(symbols: np.ndarray, chunk: int) -> np.ndarray:
    """(texts, len(_KEPT)) keys of a chunk, each of all its symbols but ERRORS."""
    part = symbols[:, chunk * WIDTH : (chunk + 1) * WIDTH].astype(np.uint64)
    out = np.empty((len(part), len(_KEPT)), np.uint64)
    for at, kept in enumerate(_KEPT):
        h = np.full(len(part), chunk * len(_KEPT) + at + 1, np.uint64)
        for k in kept:
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + part[:, k])
        out[:, at] = h
    return out


def sketches(symbols: np.ndarray) -> np.ndarray:
    """(texts, SYMBOLS / 32) words of 32 bits."""
    return np.packbits((symbols & 1).astype(np.uint8), axis=1).view(np.uint32)


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, list[list[str]]]:
    """Distinct classes of a batch (one text column) that have a run."""
    found: dict[int, list[str]] = {}
    for t in batch.column(0).to_pylist():
        words = words_of(t)
        if len(words) >= RUN:
            found.setdefault(class_id(words), words)
    return np.fromiter(found, np.int64, len(found)), list(found.values())


def class_ids(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id): the class of every text with at least three words; others have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            some = [len(w) >= RUN for w in words]
            ids = pa.array([class_id(w) for w, ok in zip(words, some, strict=True) if ok], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(some, pa.bool_())), ids], [key, "id"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, id long")


def _symbol_code(symbols: np.ndarray, chunk: int, first: int) -> np.ndarray:
    """One number per text for its first kept symbol and the place of it."""
    return symbols[:, chunk * WIDTH + first].astype(np.int64) + ((chunk * (ERRORS + 1) + first) << 16)


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, symbols) of the distinct classes of about `size` texts at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        ids, words = _texts(batch)
        if len(ids):
            held.append((ids, signatures(words)))
        if sum(len(i) for i, _ in held) >= size:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _crowds(texts: DataFrame, rows: int, split: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbol codes, keys) that more than CROWD * TEXTS_PER_PART texts share, as a sample tells.

    They only decide where work is done, never what is found. There are fewer of them than parts, whatever
    the number of texts, times the number of symbols and keys of a text.
    """
    if split == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    part = min(1.0, SEEN * split / CROWD / rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, symbols in _packed(batches, FLUSH_TEXTS):
            codes = [_symbol_code(symbols, c, f) for c in range(CHUNKS) for f in range(ERRORS + 1)]
            keys = [chunk_keys(symbols, c).reshape(-1).view(np.int64) for c in range(CHUNKS)]
            for is_key, values in ((False, codes), (True, keys)):
                v, n = np.unique(np.concatenate(values), return_counts=True)
                if is_key:
                    v, n = v[n > 1], n[n > 1]  # a crowd of a task's share is never alone there
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), is_key)), pa.array(v), pa.array(n)], ["is_key", "v", "n"])

    sample = texts.sample(part, 1) if part < 1 else texts
    seen = sample.coalesce(max(1, split // 8)).mapInArrow(count, "is_key boolean, v long, n long").groupBy("is_key", "v").agg(F.sum("n").alias("n"))
    found = seen.filter(F.col("n") >= CROWD * TEXTS_PER_PART * part).select("is_key", "v").collect()
    codes = np.array(sorted(r["v"] for r in found if not r["is_key"]), np.int64)
    keys = np.sort(np.array([r["v"] for r in found if r["is_key"]], np.int64).view(np.uint64))
    return codes, keys


def _inside(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(values.shape, bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def _index(split: int, codes: np.ndarray, crowded: np.ndarray):
    """Packed records (part, classes, sketches, 32-bit keys of each class in turn); crowded keys are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, symbols in _packed(batches, FLUSH_TEXTS):
            sketch = sketches(symbols)
            rows: list[tuple] = []

            def put(part: np.ndarray, who: np.ndarray, keys: np.ndarray) -> None:
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order])) + 1
                for at in np.split(order, cuts):  # noqa: B023
                    if len(at):
                        rows.append((int(part[at[0]]), ids[who[at]].tobytes(), sketch[who[at]].tobytes(), keys[at].astype(np.uint32).tobytes()))  # noqa: B023

            for c in range(CHUNKS):
                keys = chunk_keys(symbols, c)
                for f, group in enumerate(_GROUPS):
                    base = (c * len(_GROUPS) + f) * 2 * split
                    code = _symbol_code(symbols, c, f)
                    spread = _inside(code, codes)
                    calm = np.flatnonzero(~spread)
                    put(base + (mix64(code[calm].view(np.uint64)) % np.uint64(split)).astype(np.int64), calm, keys[np.ix_(calm, group)])
                    busy = np.flatnonzero(spread)
                    for k in group if len(busy) else []:
                        own = keys[busy, k]
                        rest = ~_inside(own, crowded)
                        put(base + split + (own[rest] >> np.uint64(32)).astype(np.int64) % split, busy[rest], own[rest][:, None])
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 4)]], ["part", "ids", "sketch", "keys"])

    return run


def _members(crowded: np.ndarray):
    """(bucket, id) of every class and crowded key that it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, symbols in _packed(batches, FLUSH_TEXTS):
            for c in range(CHUNKS):
                keys = chunk_keys(symbols, c)
                at, which = np.nonzero(_inside(keys, crowded))
                yield pa.RecordBatch.from_arrays([pa.array(keys[at, which].view(np.int64)), pa.array(ids[at])], ["bucket", "id"])

    return run


def _close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1) <= bits


def _join(bits: int, hot: int):
    """Pairs (a, b) of a part's records whose sketches are close; or, with hot set, (key, class)."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py() if table.num_rows else 0
        ids, sketch, keys, own, base = [], [], [], [], 0
        for i, s, k in zip(*[table.column(c).to_pylist() for c in ("ids", "sketch", "keys")], strict=True):
            n, m = len(i) // 8, len(k) // 4
            ids.append(np.frombuffer(i, np.int64))
            sketch.append(np.frombuffer(s, np.uint32).reshape(n, -1))
            keys.append(np.frombuffer(k, np.uint32))
            own.append(np.repeat(np.arange(base, base + n), m // n))
            base += n
        ids, sketch, keys, own = (np.concatenate(x) for x in (ids, sketch, keys, own))
        # The same class from several batches is one.
        _, first, same = np.unique(ids, return_index=True, return_inverse=True)
        ids, sketch, own = ids[first], sketch[first], same[own]
        both = np.sort((keys.astype(np.uint64) << np.uint64(32)) | own.astype(np.uint64))
        both = both[np.r_[True, both[1:] != both[:-1]]]
        keys, own = (both >> np.uint64(32)).astype(np.uint32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[begin, len(keys)])
        big = size > hot
        out_a, out_b, out_hot = [], [], []
        for s, n in zip(begin[big].tolist(), size[big].tolist(), strict=True):
            out_a.append(np.full(n, (part << 32) | int(keys[s]), np.int64))
            out_b.append(ids[own[s : s + n]])
            out_hot.append(np.ones(n, bool))
        some = ~big & (size > 1)
        begin, size = begin[some], size[some]
        for step in range(1, int(size.max(initial=1))):
            more = size > step
            begin, size = begin[more], size[more]
            left = np.repeat(begin - np.cumsum(size - step) + (size - step), size - step) + np.arange((size - step).sum())
            a, b = own[left], own[left + step]
            for lo in range(0, len(a), 1_000_000):
                x, y = a[lo : lo + 1_000_000], b[lo : lo + 1_000_000]
                ok = _close(sketch[x], sketch[y], bits)
                p, q = ids[x[ok]], ids[y[ok]]
                out_a.append(np.minimum(p, q))
                out_b.append(np.maximum(p, q))
                out_hot.append(np.zeros(len(p), bool))
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        a, b, h = cat(out_a, np.int64), cat(out_b, np.int64), cat(out_hot, bool)
        if len(a):
            _, keep = np.unique(np.stack([a, b, h.astype(np.int64)], axis=1), axis=0, return_index=True)
            a, b, h = a[keep], b[keep], h[keep]
        return pa.table({"a": a, "b": b, "hot": h})

    return run


def _places(ids: np.ndarray) -> list[np.ndarray]:
    h = mix64(ids.view(np.uint64))
    return [(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (h & np.uint64(2**FILTER_BITS - 1)).astype(np.int64)]


def _filter_of(ids: DataFrame) -> bytes:
    """A filter of 2^FILTER_BITS bits, two per id; merged in the cluster by blocks, 1 MB at most comes here."""
    block = 2**13

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(2**FILTER_BITS, bool)
        for batch in batches:
            for p in _places(batch.column(0).to_numpy(zero_copy_only=False)):
                bits[p] = True
        packed = np.packbits(bits).reshape(-1, block // 8)
        some = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([packed[i].tobytes() for i in some], pa.binary())], ["block", "bits"])

    def join(t: pa.Table) -> pa.Table:
        both = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in t.column("bits").to_pylist()])
        return pa.table({"block": t.column("block").slice(0, 1), "bits": pa.array([both.tobytes()], pa.binary())})

    out = np.zeros((2**FILTER_BITS // block, block // 8), np.uint8)
    for r in ids.mapInArrow(mark, "block long, bits binary").groupBy("block").applyInArrow(join, "block long, bits binary").collect():
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def _sketch_rows(mask: bytes):
    """The sketch of the classes that pass a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(mask, np.uint8)).astype(bool)
        for batch in batches:
            ids, words = _texts(batch)
            p, q = _places(ids)
            hit = np.flatnonzero(wanted[p] & wanted[q])
            if len(hit):
                sketch = sketches(signatures([words[i] for i in hit.tolist()]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array([x.tobytes() for x in sketch], pa.binary())], ["id", "sketch"])

    return run


def _block_pairs(bits: int):
    """Close pairs of two blocks of a hot key (or of one block), row by row against the rest."""

    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        ids = table.column("id").to_numpy()
        own = table.column("own").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(len(ids), -1)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = [], []
        for x in left.tolist():
            hit = right[_close(sketch[right], sketch[x], bits)]
            if i == j:
                hit = hit[hit > x]
            a.append(np.minimum(ids[hit], ids[x]))
            b.append(np.maximum(ids[hit], ids[x]))
        cat = lambda v: np.concatenate(v) if v else np.zeros(0, np.int64)
        return pa.table({"a": cat(a), "b": cat(b)})

    return run


def _hot_pairs(texts: DataFrame, members: DataFrame, block: int, bits: int) -> DataFrame:
    """All close pairs within hot keys (bucket, id): a key's classes are cut into blocks, and every two blocks are a task of their own.

    Nothing is left out, whatever the key's size; the work of a key grows with the square of its classes, spread
    over tasks of at most about 2 * block classes. Only pairs whose sketches are close are put out.
    """
    members = durable(members.distinct())
    rows = texts.mapInArrow(_sketch_rows(_filter_of(members.select("id"))), "id long, sketch binary").dropDuplicates(["id"])
    blocks = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).alias("n"))
    x = members.join(blocks, "bucket").join(rows, "id").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    x = x.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "sketch")
    return x.groupBy("bucket", "i", "j").applyInArrow(_block_pairs(bits), "a long, b long")


def candidate_pairs(texts: DataFrame, hot: int = HOT, bits: int = SKETCH_BITS, rows: int | None = None) -> DataFrame:
    """(a, b) with a < b: classes that meet in the index and whose sketches are close. texts: one text column."""
    n = texts.count() if rows is None else rows
    split = max(1, -(-n // TEXTS_PER_PART))
    codes, crowded = _crowds(texts, n, split)
    packed = texts.mapInArrow(_index(split, codes, crowded), "part int, ids binary, sketch binary, keys binary")
    # As many tasks as parts, so that a task's input stays the same when the table grows.
    packed = packed.repartition(CHUNKS * len(_GROUPS) * split, "part")
    met = durable(packed.groupBy("part").applyInArrow(_join(bits, hot), "a long, b long, hot boolean"))
    pairs = met.filter("not hot").select("a", "b")
    many = [met.filter("hot").select(F.col("a").alias("bucket"), F.col("b").alias("id"))] if met.filter("hot").limit(1).count() else []
    if len(crowded):
        many.append(texts.mapInArrow(_members(crowded), "bucket long, id long"))
    if many:
        pairs = pairs.unionByName(_hot_pairs(texts, many[0] if len(many) == 1 else many[0].unionByName(many[1]), hot, bits))
    return pairs.distinct()


def _runs(mask: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(mask, np.uint8)).astype(bool)
        for batch in batches:
            ids, words = _texts(batch)
            p, q = _places(ids)
            hit = np.flatnonzero(wanted[p] & wanted[q])
            if len(hit):
                n, h = distinct_runs([words[i] for i in hit.tolist()])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array((h >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), lists], ["id", "runs"])

    return run


def record_pairs(pairs: DataFrame, members: DataFrame, expand: int | None) -> DataFrame:
    """(record_a, record_b), record_a < record_b: the pairs of records that pairs of classes stand for.

    members: id, record_id, copies and first (the class' number of records and least record). expand None is
    the exact way: all pairs of copies, and all copies of one class with all of a class it is similar to. A
    number bounds what a group of copies can put out: a class of more records is then shown by its first record,
    and each of its other records stands in one pair with that one, so that membership is part of the result.
    """
    shown = members if expand is None else members.filter((F.col("copies") <= expand) | (F.col("record_id") == F.col("first")))
    a, b = shown.select(F.col("id").alias("a"), F.col("record_id").alias("ra")), shown.select(F.col("id").alias("b"), F.col("record_id").alias("rb"))
    out = pairs.select("a", "b").join(a, "a").join(b, "b").select("ra", "rb")
    few = members.filter("copies > 1" if expand is None else F.col("copies").between(2, expand)).select("id", "record_id")
    within = few.select("id", F.col("record_id").alias("ra")).join(few.select("id", F.col("record_id").alias("rb")), "id").filter("ra < rb")
    out = out.unionByName(within.select("ra", "rb"))
    if expand is not None:
        out = out.unionByName(members.filter(F.col("copies") > expand).select(F.col("first").alias("ra"), F.col("record_id").alias("rb")))
    return out.filter("ra <> rb").select(F.least("ra", "rb").alias("record_a"), F.greatest("ra", "rb").alias("record_b")).distinct()


def similar_classes(texts: DataFrame, threshold: float, hot: int = HOT, rows: int | None = None) -> DataFrame:
    """(a, b, similarity) of classes a < b whose distinct runs shared are at least `threshold` of those in either.

    texts: one text column, repeats allowed; equal sequences of words are one class, known by class_ids. Null
    texts and texts of fewer than three words have no run and are similar to none. The similarity is exact but
    for collisions of 32-bit hashes within a pair (about two in a million pairs of a hundred runs).
    """
    pairs = durable(candidate_pairs(texts, hot, rows=rows))
    mask = _filter_of(pairs.select(F.explode(F.array("a", "b")).alias("id")))
    runs = texts.mapInArrow(_runs(mask), "id long, runs array<int>").dropDuplicates(["id"])
    both = pairs.join(runs.select(F.col("id").alias("a"), F.col("runs").alias("ra")), "a").join(runs.select(F.col("id").alias("b"), F.col("runs").alias("rb")), "b")
    shared = F.size(F.array_intersect("ra", "rb"))
    x = both.select("a", "b", shared.alias("_s"), (F.size("ra") + F.size("rb")).alias("_n"))
    return x.select("a", "b", (F.col("_s") / (F.col("_n") - F.col("_s"))).alias("similarity")).filter(F.col("similarity") >= threshold)
