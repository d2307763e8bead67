"""Token ids of whole texts by a public byte-level BPE vocabulary.

The corpus' frequent words are compiled, with their ids, into a minimal acyclic automaton that every executor
memory-maps. Words that it doesn't hold are merged exactly, pair by pair, by the vocabulary's ranks, so the
automaton changes the speed and never the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.automaton import Automaton, build, to_bytes
from millrace.session import shared_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the word pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words in the automaton, and their longest length in bytes: it stays under some MB for any corpus.
LEXICON_WORDS, LEXICON_BYTES = 32_768, 64
#: Merged words that a worker remembers before it starts anew, and the length up to which it does.
MEMO_WORDS, MEMO_CHARS = 200_000, 100
#: Characters that are split into words at a time; bounds a worker's memory. A longer text is taken whole.
CHUNK_CHARS = 1_000_000


def read_ranks(file: str) -> dict[bytes, int]:
    with open(file, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact ids of one word: the adjacent pair of lowest rank is joined first, the leftmost among equals.

    A heap of pairs keeps this near-linear, so a word of a million characters is no special case.
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # a part starts at i and ends before end[i]
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != stop or not alive[j]:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def frequent_words(texts: DataFrame, text: str) -> list[str]:
    """The corpus' most frequent words, counted over all whole texts; their number and length are bounded."""
    words = texts.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0))).alias("w"))
    counts = words.filter(F.octet_length("w") <= LEXICON_BYTES).groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return [r[0] for r in counts.orderBy(F.desc("n"), "w").limit(LEXICON_WORDS).collect()]


def publish(spark: SparkSession, name: str, data: bytes) -> str:
    """Puts a small file into the shared folder and has every executor fetch it; returns its name there."""
    sc = spark.sparkContext
    name = f"{hashlib.sha256(data).hexdigest()[:16]}-{name}"
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path)
        out.write(bytearray(data))
        out.close()
    sc.addFile(path.toString())
    return name


_held: dict[str, tuple] = {}


def _tools(lexicon: str, vocabulary: str) -> tuple:
    if lexicon not in _held:
        _held.clear()
        _held[lexicon] = (Automaton(SparkFiles.get(lexicon)), read_ranks(SparkFiles.get(vocabulary)), regex.compile(PATTERN), {})
    return _held[lexicon]


def _pieces(texts: list[str | None]) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_texts(texts: list[str | None], tools: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of ids of each text, all ids) of successive runs of texts."""
    automaton, ranks, pattern, memo = tools
    for part in _pieces(texts):
        split = [pattern.findall(t) for t in part]
        new = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in memo]
        raw = [w.encode() for w in new]
        table = dict(memo) if len(memo) < 20_000 else memo
        for w, b, r in zip(new, raw, automaton.ranks(raw).tolist(), strict=True):
            table[w] = automaton.output(r) if r >= 0 else merge(b, ranks)
        flat = [list(chain.from_iterable(map(table.__getitem__, words))) for words in split]
        yield np.fromiter(map(len, flat), np.int64, len(flat)), np.fromiter(chain.from_iterable(flat), np.int32)
        if len(memo) > MEMO_WORDS:
            memo.clear()
        memo.update((w, table[w]) for w in new if len(w) <= MEMO_CHARS)
        for w in new:
            if len(w) > MEMO_CHARS and table is memo:
                memo.pop(w, None)


def _ship(df: DataFrame, text: str, vocabulary: str) -> tuple[str, str]:
    spark = df.sparkSession
    ranks = read_ranks(vocabulary)
    words = {w.encode(): merge(w.encode(), ranks) for w in frequent_words(df, text)}
    with open(vocabulary, "rb") as f:
        name = publish(spark, "vocabulary", f.read())
    return publish(spark, "lexicon", to_bytes(build(words))), name


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): the ids of each whole text; no special tokens, their strings are ordinary text.

    Null and empty texts have the empty list. Every row of df gives one row, repeats too; other columns are
    dropped. vocabulary is the path of a rank file on the driver.
    """
    lexicon, name = _ship(df, text, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            tools = _tools(lexicon, name)
            for sizes, ids in encode_texts(batch.column(1).to_pylist(), tools):
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sizes)), lists], [key, "ids"])
                at += len(sizes)

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, keep: list[str], text: str, vocabulary: str = VOCABULARY, out: str = "tokens") -> DataFrame:
    """The columns `keep` and the number of ids of each text (0 for null and empty), by the same encoding."""
    lexicon, name = _ship(df, text, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [s for s, _ in encode_texts(batch.column(len(keep)).to_pylist(), _tools(lexicon, name))]
            total = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(total, pa.int64())], [*keep, out])

    kinds = dict(df.dtypes)
    return df.select(*keep, text).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", `{out}` long")
