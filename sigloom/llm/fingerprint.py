"""Homomorphic multiset hash of paragraphs.

A paragraph is hashed to a wide vector: eight 64-bit lanes from a keyless BLAKE2b digest, and ``LANES`` small lanes to
which each run of three words adds plus or minus one.  A fingerprint is the sum over all paragraphs, modulo 2**64 in the
wide lanes and modulo 2**32 in the small ones, more than one text can have runs.  So the order of paragraphs does not matter, and paragraphs can be put in
or taken out by adding or subtracting their vectors.  The wide lanes tell equality; the squared difference of the small
lanes estimates by how many runs two texts differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import U64, Words, pieces

WIDE = 8
LANES = 128
RUN = 3
RESULT = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


class Sums:
    """Fingerprints of many texts as two arrays that add and subtract: ``wide`` (n, 8) and ``small`` (n, LANES)."""

    def __init__(self, wide: np.ndarray, small: np.ndarray):
        self.wide, self.small = wide, small

    @classmethod
    def of(cls, texts: list[str]) -> Sums:
        wide = np.zeros((len(texts), WIDE), U64)
        lines = [[p for p in t.split("\n") if p] for t in texts]
        flat = [p for ps in lines for p in ps]
        owner = np.repeat(np.arange(len(texts)), [len(ps) for ps in lines])
        if flat:
            digests = b"".join([hashlib.blake2b(p.encode(), digest_size=8 * WIDE).digest() for p in flat])
            with np.errstate(over="ignore"):
                np.add.at(wide, owner, np.frombuffer(digests, "<u8").reshape(-1, WIDE))
        words = Words(pa.array(flat, pa.large_string()), lower=False)
        paragraph, h = words.shingles(RUN)
        cell = owner[paragraph] * LANES + (h % U64(LANES)).astype(np.int64) if len(h) else np.zeros(0, np.int64)
        sign = ((h >> U64(32)) & U64(1)).astype(np.float64) * 2 - 1
        small = np.bincount(cell, weights=sign, minlength=len(texts) * LANES).reshape(len(texts), LANES)
        return cls(wide, small.astype(np.int64).astype(np.uint32))

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.wide + other.wide, self.small + other.small)

    def __sub__(self, other: Sums) -> Sums:
        return Sums(self.wide - other.wide, self.small - other.small)

    def hex(self) -> list[str]:
        return [(w.astype("<u8").tobytes() + s.astype("<u4").tobytes()).hex() for w, s in zip(self.wide, self.small)]

    def likeness(self, other: Sums) -> np.ndarray:
        """1 for equal fingerprints, about the share of common word runs for others, 0 for unrelated ones."""
        a, b = self.small.astype(np.int32).astype(np.float64), other.small.astype(np.int32).astype(np.float64)
        apart = (self.small - other.small).astype(np.int32).astype(np.float64)
        size = (a * a).sum(1) + (b * b).sum(1)
        near = np.clip(1 - (apart * apart).sum(1) / np.where(size > 0, size, 1), 0, 1) * (size > 0)
        return np.where((self.wide == other.wide).all(1) & (self.small == other.small).all(1), 1.0, near)

    def rows(self, which) -> Sums:
        return Sums(self.wide[which], self.small[which])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): hexadecimal sums over the paragraphs (lines that are not empty) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(Sums.of(piece.column(1).fill_null("").to_pylist()).hex())], ["id", "fingerprint"])

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "id bigint, fingerprint string")


def edited(text: str, following: str) -> tuple[str, str, str]:
    """The edited text, and what an incremental update takes out and puts in: the lines from the first changed one on."""
    n = len(text) // 4
    cut = len(text) - n
    new = text[:cut] + following[:n]
    line = text.rfind("\n", 0, cut) + 1
    return new, text[line:], new[line:]


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt to ranges of ids and sorted there.  The first row of a range also ends the range before (``ghost``).

    The cuts are quantiles of the ids: one long value per range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    cuts = sorted(set(cuts))
    # A null id sorts before all others.
    at = F.when(F.col("id").isNull(), F.lit(0)).otherwise(_count_below(F.col("id"), cuts, 0, len(cuts)))
    placed = rows.withColumn("part", at)
    heads = placed.groupBy("part").agg(F.min("id").alias("head"), F.count("id").alias("some"), F.count(F.lit(1)).alias("all")).collect()  # one row per range
    order = sorted(heads, key=lambda r: r.part)
    # The range that an id opens also sends its first row to the one before it; the first range's goes to the last.
    # The row itself is the first one in (id, text) order, so all rows with the opening id travel and the smallest counts.
    wanted = [(None if r.some < r.all else r.head, r.part, order[i - 1].part) for i, r in enumerate(order)]
    if not wanted:
        return placed.withColumn("ghost", F.lit(False))
    table = spark.createDataFrame(wanted, "first_id bigint, opens int, sends int")
    ghosts = (placed.join(F.broadcast(table), (F.col("part") == F.col("opens")) & F.col("id").eqNullSafe(F.col("first_id")))
                    .select("id", "text", F.col("sends").alias("part"), F.lit(True).alias("ghost")))
    both = placed.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    return both.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "ghost", F.col("id").asc_nulls_first(), "text")


def _count_below(value, cuts: list[int], low: int, high: int):
    """Number of cuts at or below ``value``, as a balanced tree of comparisons."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(value < F.lit(cuts[mid]), _count_below(value, cuts, low, mid)).otherwise(_count_below(value, cuts, mid + 1, high))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text, its edited form and its successor in ascending id order: the columns of ``RESULT``.

    In the edited text the last quarter is replaced by the first as many characters of the next document; after the last
    document comes the first.  A null text counts as empty.  Rows that repeat an id follow one another in text order, null
    ids come first.  A table of one row is its own successor; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a range in order; each is judged when its successor has come.  The first ghost ends the range."""
        ids: list[int | None] = []
        texts: list[str] = []
        ended = False
        for batch in batches:
            for piece in pieces(batch, "text"):
                for key, text, ghost in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), piece.column(2).to_pylist()):
                    if ended:
                        continue
                    ended = ghost
                    ids.append(key)
                    texts.append(text)
                if len(texts) > 1:
                    yield judged(ids, texts)
                    ids, texts = ids[-1:], texts[-1:]

    def judged(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
        """All rows but the last, which is the successor of the one before."""
        edits = [edited(t, n) for t, n in zip(texts, texts[1:])]
        sums = Sums.of(texts)
        own = sums.rows(slice(0, -1))
        changed = own - Sums.of([e[1] for e in edits]) + Sums.of([e[2] for e in edits])
        return pa.RecordBatch.from_arrays([
            pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e[0].encode()).hexdigest() for e in edits]), pa.array(own.hex()), pa.array(changed.hex()),
            pa.array(own.likeness(changed)), pa.array(own.likeness(sums.rows(slice(1, None))))],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    ordered = _in_order(docs, id_col, text_col)
    return ordered.select("id", "text", "ghost").mapInArrow(run, RESULT)
