"""Words and runs of three successive words.

Words are maximal runs of letters or digits in lower case; `word_key` is their sequence, joined by blanks.
A run is known by a 64-bit hash of its three words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

RUN = 3
# Odd multipliers of the mixing steps: any would do, but stored indexes rely on them.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def word_key(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def has_text(x: str) -> Column:
    """True where there is more than white space; never null. It reads no further than the first other character."""
    return F.coalesce(F.col(x).rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """The same words as word_key's, outside the JVM."""
    return _WORD.findall(text.lower()) if text else []


def class_id(words: list[str]) -> int:
    """64-bit signed hash of a sequence of words."""
    h = xxhash.xxh3_64_intdigest(" ".join(words))
    return h - 2**64 if h >= 2**63 else h


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs_of(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(number of runs of each text, hashes of all runs in order), repeats included."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    code: dict[str, int] = {}
    flat = [w for ws in words for w in ws]
    for w in flat:
        if w not in code:
            code[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(code.__getitem__, flat), np.uint64, len(flat))
    n = np.maximum(size - RUN + 1, 0)
    if not n.sum():
        return n, np.zeros(0, np.uint64)
    start = np.cumsum(size) - size
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
    out = np.zeros(len(at), np.uint64)
    for k in range(RUN):
        out += mix64(h[at + k] * _MIX[k])
    return n, mix64(out)


def split_key(key: str | None) -> list[str]:
    return key.split(" ") if key else []


def distinct_runs(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(number of distinct runs of each text, their hashes ascending text by text)."""
    n, h = runs_of(words)
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return np.bincount(text[new], minlength=len(n)), h[new]


def long_lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values.view(np.int64)))
