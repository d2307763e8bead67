"""New batches held against all history by a stored segment index for edit distance.

A question is taken as the string of its distinct runs of three words, rarest first. Two such sorted strings of
distinct letters differ by insertions and deletions only, and their edit distance is the number of runs that
one has and the other has not. So a share t of common runs is the same as an edit distance of at most
(1 - t) / (1 + t) times the sum of the lengths: a bounded edit distance, and no approximation.

For a bound of k edits a string is cut into k + 1 segments, of which one must come through unchanged: the k
rarest letters, one each, and what follows them. A string of a given length has a fixed number of segments, that
of the largest bound it can meet, and each is stored with the string's length and its position. A batch probes
its own leading letters; a hit counts only where lengths and positions leave room for the bound, and then the
exact distance decides.

The index is kept in two bucketed tables, segments by letter and strings by id, so that neither is shuffled when
a batch is held against it. A letter that very many strings lead with is salted: its strings are spread over
several buckets and a batch probes all of them. A question enters the index once, whatever its repeats;
appending reads nothing of what is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shingles import distinct_runs, long_lists, mix64, split_key
from millrace.session import durable

#: Slots of the table of run frequencies that orders the letters: fixed size (1 MB), whatever the corpus. Runs that share a slot share a rank, which costs time and no result.
SLOTS = 2**18
_BLOCK = 4096
#: Strings of the history that lead with a letter, for each of its salts.
SALT_ROWS = 100_000
#: Strings for each bucket of a new index.
BUCKET_ROWS = 200_000


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        _, h = distinct_runs([split_key(k) for k in batch.column(0).to_pylist()])
        total += np.bincount((h & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
    blocks = [b for b in range(SLOTS // _BLOCK) if total[b * _BLOCK : (b + 1) * _BLOCK].any()]
    yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([total[b * _BLOCK : (b + 1) * _BLOCK].tobytes() for b in blocks], pa.binary())], ["block", "n"])


def _sum_blocks(t: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in t.column("n").to_pylist())
    return pa.table({"block": t.column("block").slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})


def run_frequencies(keys: DataFrame) -> np.ndarray:
    """Occurrences of the runs of all texts by slot, summed in the cluster; keys: one string column."""
    got = keys.mapInArrow(_count_runs, "block int, n binary").groupBy("block").applyInArrow(_sum_blocks, "block int, n binary").collect()
    out = np.zeros(SLOTS, np.int64)
    for r in got:
        out[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = np.frombuffer(r["n"], np.int64)
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def strings(texts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per text (id long, key string) with a run: id, size (number of distinct runs), runs, then the columns `keep`."""
    kinds = dict(texts.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h = distinct_runs([split_key(k) for k in batch.column(1).to_pylist()])
            some = n > 0
            own = batch.filter(pa.array(some))
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array(n[some], pa.int32()), long_lists(n[some], h), *own.columns[2:]], ["id", "size", "runs", *keep])

    schema = ", ".join(["id long, size int, runs array<long>", *[f"`{c}` {kinds[c]}" for c in keep]])
    return texts.select("id", "key", *keep).mapInArrow(run, schema)


def segments(rows: DataFrame, frequencies: np.ndarray, t: float, probe: bool) -> DataFrame:
    """(letter, at, id, size): the leading letters of strings(), rarest first, with their positions.

    A frequent letter has as many salts as SALT_ROWS asks for: a stored string takes one by its id, a probe all.
    """
    order = frequencies.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(order, np.int32)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            h = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            text = np.repeat(np.arange(len(n)), n)
            seen = rank[(h & np.uint64(SLOTS - 1)).astype(np.int64)]
            by = np.lexsort((h, seen, text))
            at = np.arange(len(h)) - (np.cumsum(n) - n)[text]
            # The shortest partner, t times as long, leaves the most room for edits and so needs the most segments.
            lead = at < (n - np.ceil(t * n - 1e-9).astype(np.int64) + 1)[text]
            letter, at, text = h[by][lead], at[lead], text[lead]
            salts = 1 + seen[by][lead].astype(np.int64) // SALT_ROWS
            if probe:
                letter, at, text = np.repeat(letter, salts), np.repeat(at, salts), np.repeat(text, salts)
                salt = np.arange(len(letter)) - np.repeat(np.cumsum(salts) - salts, salts)
            else:
                salt = (mix64(ids[text].view(np.uint64)) % salts.astype(np.uint64)).astype(np.int64)
            letter = np.where(salt > 0, mix64(letter + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), letter)
            yield pa.RecordBatch.from_arrays([pa.array(letter.view(np.int64)), pa.array(at, pa.int32()), pa.array(ids[text]), pa.array(n[text], pa.int32())], ["letter", "at", "id", "size"])

    return rows.select("id", "size", "runs").mapInArrow(run, "letter long, at int, id long, size int")


def near_pairs(stored: DataFrame, known: DataFrame, probes: DataFrame, batch: DataFrame, t: float) -> DataFrame:
    """(id, other): strings of a batch and stored ones within the edit distance that a share t of common runs allows.

    stored, probes: segments(); known, batch: strings(). A string is not held against itself.
    """
    i, b = stored.alias("i"), probes.alias("b")
    total = F.col("i.size") + F.col("b.size")
    room = F.least(F.col("i.size") - F.col("i.at"), F.col("b.size") - F.col("b.at"))
    fits = (room >= F.ceil(F.lit(t / (1 + t)) * total - 1e-9)) & (F.least("i.size", "b.size") >= F.lit(t) * F.greatest("i.size", "b.size") - 1e-9)
    # Sorted joins only: they split a hot letter, and nothing is sent to the driver to be broadcast.
    met = b.join(i.hint("merge"), (F.col("i.letter") == F.col("b.letter")) & (F.col("i.id") != F.col("b.id")) & fits).select(F.col("b.id").alias("id"), F.col("i.id").alias("other")).distinct()
    own = batch.select("id", F.col("runs").alias("_rb"))
    both = met.join(own.hint("merge"), "id").join(known.select(F.col("id").alias("other"), F.col("runs").alias("_ri")).hint("merge"), "other")
    length = F.size("_rb") + F.size("_ri")
    edits = length - 2 * F.size(F.array_intersect("_rb", "_ri"))
    return both.filter(edits <= F.floor(F.lit((1 - t) / (1 + t)) * length + 1e-9)).select("id", "other")


class SegmentIndex:
    """A stored index of accepted texts: the frequencies that fix the order of letters, and bucketed segments and strings.

    The folder must be one that all executors share. A later session opens what is there by the same folder. In a
    session that can't have tables (its warehouse folder can't be made) the same files are read and written by
    their paths: results are equal, but a probe then shuffles the history.
    """

    COLUMNS = {"segments": ("letter LONG, at INT, id LONG, size INT", "letter"), "strings": ("id LONG, size INT, runs ARRAY<LONG>", "id")}

    def __init__(self, spark: SparkSession, folder: str, t: float) -> None:
        self.spark, self.folder, self.t = spark, folder, t
        self._name = "segment_index_" + xxhash.xxh3_64_hexdigest(folder)
        self._order: np.ndarray | None = None
        self._tables = False

    def create(self, texts: DataFrame, buckets: int | None = None) -> None:
        """Starts the index from the history (id long, key string); the order of letters and the number of buckets are fixed from here on."""
        counts = run_frequencies(texts.select("key"))
        buckets = buckets or max(8, -(-texts.count() // BUCKET_ROWS))
        self.spark.createDataFrame([(counts.tobytes(), buckets)], "counts binary, buckets int").coalesce(1).write.mode("errorifexists").parquet(f"{self.folder}/order")
        self._order = counts
        self._open(buckets)
        self.append(texts)

    def _open(self, buckets: int) -> None:
        self._buckets = buckets
        try:
            for part, (columns, by) in self.COLUMNS.items():
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name}_{part} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.folder}/{part}'")
            self._tables = True
        except PySparkException:
            self._tables = False

    def _stored(self, part: str) -> DataFrame:
        if self._tables:
            return self.spark.table(f"{self._name}_{part}")
        return self.spark.read.schema(self.COLUMNS[part][0]).parquet(f"{self.folder}/{part}")

    def _add(self, rows: DataFrame, part: str) -> None:
        rows = rows.repartition(self._buckets, self.COLUMNS[part][1])
        if self._tables:
            rows.write.insertInto(f"{self._name}_{part}")
        else:
            rows.write.mode("append").parquet(f"{self.folder}/{part}")

    def _counts(self) -> np.ndarray:
        if self._order is None:
            row = self.spark.read.parquet(f"{self.folder}/order").first()
            self._order = np.frombuffer(row["counts"], np.int32)
            self._open(row["buckets"])
        return self._order

    def append(self, texts: DataFrame) -> None:
        """Adds texts (id long, key string), each id once; what is stored is neither read nor rewritten."""
        self.append_strings(durable(strings(texts.dropDuplicates(["id"]))))

    def append_strings(self, rows: DataFrame) -> None:
        """Adds strings() that were made already."""
        found = segments(rows, self._counts(), self.t, False)
        self._add(rows.select("id", "size", "runs"), "strings")
        self._add(found, "segments")

    def near(self, batch: DataFrame) -> DataFrame:
        """(id, other) of batch texts (id long, key string) near an indexed text."""
        return self.near_strings(strings(batch.dropDuplicates(["id"])))

    def near_strings(self, rows: DataFrame) -> DataFrame:
        """(id, other) of strings() near an indexed one."""
        order = self._counts()
        return near_pairs(self._stored("segments"), self._stored("strings"), segments(rows, order, self.t, True), rows, self.t)

    def close(self, delete: bool = False) -> None:
        """Forgets the tables in this session; with delete, their files go as well."""
        for part in self.COLUMNS if self._tables else ():
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name}_{part}")
        if delete:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
