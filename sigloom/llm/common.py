"""Helpers shared by the operators: written tables and vectorised word hashing."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sigloom.sources.folders import new_folder as new_path

PIECE_BYTES = 1 << 20  # text handled at once inside a task; bounds the temporary arrays
SHINGLE = 5

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, reread: lineage is cut and survives a lost executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, which Spark keeps for many tasks.  For memory only, never for results."""
    module = sys.modules.setdefault("sigloom_worker_store", types.ModuleType("sigloom_worker_store"))
    return module.__dict__.setdefault(name, {})


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each (one row at least)."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    if len(cuts) == 2:
        yield batch
        return
    for a, b in zip(cuts, cuts[1:]):
        yield batch.take(pa.array(np.arange(a, b)))  # copied: some string kernels misread an array that begins inside a buffer


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept between calls of one worker."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                out = np.full(n, U64(base))
                out[0] = 1
                _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"], _POWERS["down"]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """Words (runs without ASCII white space) of many texts: hashes, and the text each belongs to.

    A word's hash is a polynomial in its bytes modulo 2**64, taken from prefix sums over the whole buffer, then mixed.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if lower:
            texts = pc.utf8_lower(texts)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
        self.starts_of_text = ends - ends[0]
        self.data = data
        n = len(data)
        inside = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[self.starts_of_text] = True  # a text ends the word
        before = np.concatenate(([False], inside[:-1])) if n else inside
        first = inside & (~before | edge[:n])
        after = np.concatenate((inside[1:], [False])) if n else inside
        last = inside & (~after | edge[1:])
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _powers(n + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * up[:n], dtype=U64)))
            raw = (sums[self.end] - sums[self.start]) * down[self.start]
            self.hash = mix(raw + (self.end - self.start).astype(U64))
        self.text = np.searchsorted(self.starts_of_text, self.start, side="right") - 1  # empty texts share a start: the last one owns it
        self.count = np.bincount(self.text, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)

    def shingles(self, k: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(group, hash) of every run of ``k`` words inside a group (default: a text); a shorter group gives one shingle."""
        group = self.text if group is None else group
        n = len(self.hash)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        new = np.concatenate(([True], group[1:] != group[:-1]))
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, n))
        left = np.repeat(begin + length, length) - np.arange(n)  # words from here to the end of the group
        keep = (left >= k) | new
        with np.errstate(over="ignore"):
            out = self.hash.copy()
            for j in range(1, k):
                there = left > j
                out[there] = mix(out[there] * U64(_BASE)) + self.hash[np.flatnonzero(there) + j]
            out = mix(out)
        return group[keep], out[keep]
