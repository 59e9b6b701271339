"""Token alignment between two tokenizers, with corpus counts of token pairs under a minimal perfect hash.

Pass one writes both id sequences of every text.  Tokens of the two are linked where their byte ranges overlap; byte
offsets at which tokens of both end cut a text into groups.  The distinct linked pairs get a minimal perfect hash, built
per segment of some ten thousand pairs: in every round keys alone on their bit keep it, the others go to the next round,
and a key's slot is the number of set bits before its own.  Tasks count links in dense vectors indexed by that slot;
the vectors are summed up a tree.  The second pass aligns the written ids again and looks the counts up; the key stored
in a slot tells strangers from members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm.common import U64, mix, pieces, written

SEGMENT = 1 << 16  # pairs per segment of the hash, on average
BLOCK = 64  # segments whose tables a worker holds at once: about 4 million pairs, 24 bytes each
SLICE = 1 << 16  # counters per row of a summed vector
FAN = 64  # vectors added at once
TEXT_BYTES = 4 << 20  # text handled at once
ID_BYTES = 1 << 19  # ids of one side aligned at once
TOGETHER = 1 << 12  # bytes of units encoded in one call
# Fixed value: how byte-level BPE splits a text before it merges.
BYTE_LEVEL_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

TOKENS = "uid bigint, id bigint, a binary, b binary"


class _Vocabulary:
    """Bytes of all tokens of a tokenizer, also end to end in one array."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spelled(self, ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bytes of tokens, one after the other."""
        return self.flat[np.repeat(self.start[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class ByteLevel(_Vocabulary):
    """Tokenizer A: byte-level BPE from a ``tokenizers`` file.

    Plain text (ASCII and Latin letters) goes through ``tiktoken`` with the same vocabulary, which is faster, if the file's
    merges are in the order of their ids, as ranks are; all other text through ``tokenizers``.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        self.tool = Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True  # their strings in a text are plain text
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = self.tool.get_vocab()
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        super().__init__(tokens)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, before, added = told["model"], told["pre_tokenizer"] or {}, {t["id"] for t in told["added_tokens"]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        order = [model["vocab"].get(x + y, -1) for x, y in merges]
        self.ranked = None
        if (model.get("type", "BPE") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                and told.get("normalizer") is None and not model.get("ignore_merges") and order == sorted(order) and len(set(order)) == len(order) == len(set(model["vocab"].values()) - added) - 256):
            import tiktoken
            ranks = {t: i for i, t in enumerate(tokens) if i not in added}
            self.ranked = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: bytes, plain: bool = False) -> list[int]:
        """Ids of a text that begins with the added space."""
        if plain and self.ranked:
            return self.ranked.encode_ordinary(text.decode())
        return self.tool.encode(text.decode(), add_special_tokens=False).ids


class Pieces(_Vocabulary):
    """Tokenizer B: a ``sentencepiece`` model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.tool.get_piece_size()
        piece = self.tool.id_to_piece
        super().__init__([bytes([int(piece(i)[1:-1], 16)]) if self.tool.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(n)])

    def encode(self, text: bytes, plain: bool = False) -> list[int]:
        return self.tool.encode(text[1:].decode(), num_threads=1)


def id_type(tokenizer: _Vocabulary) -> str:
    return "<u2" if len(tokenizer.bytes) <= 1 << 16 else "<u4"


class Encoder:
    """Ids of many texts under both tokenizers.

    A text (with its space in front) is cut before single blanks between two characters that are plain ASCII or Latin
    letters.  Neither pattern nor vocabulary reaches over such a blank (``safe`` checks the vocabularies), so a text's ids
    are those of its units.  Each distinct unit of a piece of text is encoded once, many in a call.
    """

    _CUT = rb"(?:[!-~]|\xc3.) [!-~\xc3]"

    def __init__(self, a: ByteLevel, b: Pieces):
        import re
        self.a, self.b = a, b
        crossing = re.compile(self._CUT, re.S)
        self.safe = not any(crossing.search(t) for tool in (a, b) for t in tool.bytes)
        self.kinds = id_type(a), id_type(b)

    def units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(units of all texts, index of each text's first unit and the end)."""
        spaced = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), texts.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        ends = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
        data = np.frombuffer(spaced.buffers()[2], np.uint8)
        cut = np.zeros(len(data) + 1, bool)
        if self.safe and len(data) > 2:
            plain = (data > 32) & (data < 127)
            latin = data == 0xC3
            before = plain.copy()
            before[1:] |= latin[:-1]
            cut[2:-2] = (data[2:-1] == 32) & before[1:-2] & (plain | latin)[3:]
        cut[ends] = True
        at = np.flatnonzero(cut)
        at = at[(at >= ends[0]) & (at <= ends[-1])]
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), spaced.buffers()[2]])
        return units, np.searchsorted(at, ends)

    def _ids(self, tool: _Vocabulary, joined: bytes, stops: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids of a joined text, number per unit); null where they do not give its bytes back or a token crosses a unit's end."""
        ids = np.array(tool.encode(joined, plain), np.int64)
        sizes = tool.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids) or ends[-1] != len(joined) or tool.spelled(ids, sizes, ends).tobytes() != joined:
            return None
        last = np.searchsorted(ends, stops)
        return (ids, np.diff(last + 1, prepend=0)) if np.array_equal(ends[last], stops) else None

    def _of_units(self, tool: _Vocabulary, kind: str, units: pa.Array, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number of ids of each; none for a unit that the tokenizer changes)."""
        if not len(units):
            return np.zeros(0, kind), np.zeros(0, np.int64)
        ends = np.frombuffer(units.buffers()[1], np.int64)[units.offset:units.offset + len(units) + 1]
        data = memoryview(units.buffers()[2])
        group = ends[1:] // TOGETHER
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(units)]
        all_ids, counts = [], []
        for x, y in zip(cuts, cuts[1:]):
            found = self._ids(tool, data[ends[x]:ends[y]].tobytes(), ends[x + 1:y + 1] - ends[x], plain)
            if found:
                parts = [found]
            else:
                alone = [self._ids(tool, data[ends[i]:ends[i + 1]].tobytes(), ends[i + 1:i + 2] - ends[i], plain) for i in range(x, y)]
                parts = [p or (np.zeros(0, np.int64), np.zeros(1, np.int64)) for p in alone]
            for ids, n in parts:
                all_ids.append(ids.astype(kind))
                counts.append(n)
        return np.concatenate(all_ids), np.concatenate(counts)

    def encode(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Both id sequences of each text as bytes; empty ones for texts that are null, empty or changed."""
        there = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False)
        units, first = self.units(pc.fill_null(texts, ""))
        coded = units.dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()
        # Plain units first, so that either kind can be joined.
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)
        odd = ~((data >= 32) & (data < 127) | (data == 0xC3))
        odd[1:] &= ~((data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] == 0xC3))
        before = np.concatenate(([0], np.cumsum(odd)))
        strange = before[ends[1:]] > before[ends[:-1]]
        order = np.argsort(strange, kind="stable")
        split = len(order) - int(strange.sum())
        parts = [words.take(pa.array(order[:split])), words.take(pa.array(order[split:]))]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[at]
        sides = []
        for tool, kind in zip((self.a, self.b), self.kinds):
            found = [self._of_units(tool, kind, p, plain) for p, plain in zip(parts, (True, False))]
            sides.append((np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])))
        changed = (sides[0][1] == 0) | (sides[1][1] == 0)
        wrong = np.concatenate(([0], np.cumsum(changed[at])))
        there &= wrong[first[1:]] == wrong[first[:-1]]
        kept = np.repeat(there, np.diff(first))
        out = []
        for (flat, n), kind in zip(sides, self.kinds):
            length = n[at] * kept
            ends = np.concatenate(([0], np.cumsum(length)))
            body = flat[np.repeat((np.cumsum(n) - n)[at] - ends[:-1], length) + np.arange(int(ends[-1]))]
            offsets = ends[first] * np.dtype(kind).itemsize
            out.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)]))
        return out[0], out[1]


def tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of pass one: uid, id, a, b (little-endian ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # cores belong to Spark's tasks
        encoder = Encoder(ByteLevel(a_path), Pieces(b_path))
        for batch in batches:
            for piece in pieces(batch, "text", TEXT_BYTES):
                a, b = encoder.encode(piece.column(2))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), a.cast(pa.binary()), b.cast(pa.binary())], ["uid", "id", "a", "b"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return written(rows.mapInArrow(run, TOKENS), "tokens")


@dataclass
class Sides:
    """What the alignment needs to know of the vocabularies."""
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    kinds: tuple[str, str]

    @classmethod
    def of(cls, a: ByteLevel, b: Pieces) -> Sides:
        return cls(a.sizes, b.sizes, (id_type(a), id_type(b)))


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, number of ids per row)."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].tobytes() if data else b""
    return np.frombuffer(body, kind).astype(np.int64), np.diff(ends) // np.dtype(kind).itemsize


class Aligned:
    """Links and groups of many texts at once.

    The tokens of either side tile the bytes of all texts.  Between two neighbouring ends of any side lies one stretch of
    bytes inside one token of each: one link.  An end of both sides closes a group, and every text ends in one.
    """

    def __init__(self, a_column: pa.Array, b_column: pa.Array, sides: Sides):
        self.a, self.n_a = _flat(a_column, sides.kinds[0])
        self.b, self.n_b = _flat(b_column, sides.kinds[1])
        a_ends, b_ends = np.cumsum(sides.a_sizes[self.a]), np.cumsum(sides.b_sizes[self.b])
        rows, size = len(self.n_a), int(a_ends[-1]) if len(a_ends) else 0
        # One mark per byte at which a token of a side ends.
        marks = np.zeros((2, size + 1), bool)
        marks[0, a_ends], marks[1, b_ends] = True, True
        ends = np.flatnonzero(marks[0] | marks[1])
        shared = (marks[0] & marks[1])[ends]
        at_a, at_b = (np.cumsum(m, dtype=np.int32)[ends - 1] for m in marks)
        self.pair = self.a[at_a] << 32 | self.b[at_b]
        row = np.repeat(np.arange(rows, dtype=np.int32), self.n_a)[at_a]
        self.n_links = np.bincount(row, minlength=rows)
        self.n_groups = np.bincount(row[shared], minlength=rows)
        closed = np.cumsum(shared) - shared  # number of the group a link is in
        self.a_group, self.b_group = (closed[m[ends]] for m in marks)

    def groups_as_text(self, numbers: pa.Array) -> tuple[bytes, np.ndarray]:
        """(``a1,a2|b1;a3|b2,b3;`` of all rows one after the other, end of each row's text)."""
        last_a = np.append(self.a_group[1:] != self.a_group[:-1], True)[:len(self.a)]
        last_b = np.append(self.b_group[1:] != self.b_group[:-1], True)[:len(self.b)]
        # A token's place: all tokens of its side before it, and those of the other side in earlier (or, for b, the same) groups.
        groups = int(self.a_group[-1]) + 1 if len(self.a) else 0
        of_a, of_b = (np.cumsum(np.bincount(g, minlength=groups)) for g in (self.a_group, self.b_group))
        place_a = np.arange(len(self.a)) + np.concatenate(([0], of_b))[self.a_group]
        place_b = np.arange(len(self.b)) + of_a[self.b_group]
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[place_a] = self.a * 3 + last_a  # 0: comma, 1: bar
        code[place_b] = self.b * 3 + np.where(last_b, 2, 0)  # 2: semicolon
        text = numbers.take(pa.array(code))
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        body = text.buffers()[2]
        return (body.to_pybytes() if body else b""), ends[np.cumsum(self.n_a + self.n_b)] if len(text) else np.zeros(len(self.n_a), np.int64)


def _numbers(sides: Sides) -> pa.Array:
    """Every id as text with each of the three characters that can follow it."""
    most = max(len(sides.a_sizes), len(sides.b_sizes))
    return pa.array([f"{i}{end}" for i in range(most) for end in ",|;"], pa.large_string()).cast(pa.large_binary())


def _counted(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct pairs in order, how often each comes)."""
    pair = np.sort(pair)
    new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))[:len(pair)]
    return pair[new].astype(U64), np.diff(np.append(new, len(pair)))


def _round(keys: np.ndarray, number: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys + U64(0x9E3779B97F4A7C15) * U64(number + 1))


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((mix(keys ^ U64(0x5851F42D4C957F2D)) >> U64(32)) % U64(segments)).astype(np.int64)


def perfect(keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Minimal perfect hash of distinct keys: (bits per round, bit arrays of all rounds, keys in slot order)."""
    sizes, arrays, slots = [], [], []
    rest = keys
    while len(rest):
        size = max(64, -(-len(rest) * 3 // 2 // 64) * 64)
        at = (_round(rest, len(sizes)) % U64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        won = alone[at]
        order = np.argsort(at[won])
        slots.append(rest[won][order])
        arrays.append(np.packbits(alone, bitorder="little").tobytes())
        sizes.append(size)
        rest = rest[~won]
    return sizes, b"".join(arrays), np.concatenate(slots) if slots else keys


class Perfect:
    """A block of segments joined to one hash: slot of a key, or -1 for a key that is not a member."""

    def __init__(self, segments: int, first: int, sizes: list[list[int]], bits: list[bytes], keys: np.ndarray):
        self.segments, self.first, self.keys = segments, first, keys
        rounds = max(map(len, sizes), default=0)
        self.size = np.zeros((len(sizes), rounds), np.int64)
        for i, s in enumerate(sizes):
            self.size[i, :len(s)] = s
        flat = self.size.ravel()
        self.begin = (np.cumsum(flat) - flat).reshape(self.size.shape)
        self.words = np.frombuffer(b"".join(bits), "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.rank = np.cumsum(ones) - ones

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1)
        segment = segment_of(keys, self.segments) - self.first
        open_ = np.flatnonzero((segment >= 0) & (segment < len(self.size)))
        for r in range(self.size.shape[1]):
            size = self.size[segment[open_], r]
            open_, size = open_[size > 0], size[size > 0]
            at = self.begin[segment[open_], r] + (_round(keys[open_], r) % size.astype(U64)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(U64)
            hit = (word >> bit) & U64(1) == 1
            below = word[hit] & ((U64(1) << bit[hit]) - U64(1))
            out[open_[hit]] = self.rank[at[hit] >> 6] + np.bitwise_count(below)
            open_ = open_[~hit]
        found = np.flatnonzero(out >= 0)
        out[found[self.keys[out[found]] != keys[found]]] = -1
        return out


def _hashes(written_tokens: DataFrame, sides: Sides) -> tuple[DataFrame, int]:
    """(written segments: segment, n, sizes, bits, keys; number of segments)."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, U64)
        for batch in batches:
            for piece in pieces(batch, "a", ID_BYTES):
                new = _counted(Aligned(piece.column(0), piece.column(1), sides).pair)[0]
                seen = _counted(np.concatenate((seen, new)))[0]
                if len(seen) > 2_000_000:  # bounds the memory; what is said twice is merged below
                    yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64))], ["pair"])
                    seen = seen[:0]
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64))], ["pair"])

    distinct = written(written_tokens.select("a", "b").mapInArrow(pairs, "pair bigint").distinct(), "pairs")
    segments = max(1, -(-distinct.count() // SEGMENT))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(segment_of(keys.view(U64), segments).astype(np.int32)), batch.column(0)], ["segment", "pair"])

    def build(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("pair").combine_chunks().to_numpy().view(U64))
        sizes, bits, slots = perfect(keys)
        return pa.table({"segment": table.column("segment").slice(0, 1), "n": pa.array([len(keys)], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                         "bits": pa.array([bits]), "keys": pa.array([slots.astype("<u8").tobytes()])})

    dealt = distinct.mapInArrow(numbered, "segment int, pair bigint")
    built = dealt.groupBy("segment").applyInArrow(build, "segment int, n bigint, sizes array<bigint>, bits binary, keys binary")
    return written(built, "hash"), segments


def _block(hashes: DataFrame, segments: int, first: int) -> Perfect:
    """The hash of ``BLOCK`` segments from ``first`` on, on the driver: a bounded number of pairs, however large the corpus."""
    rows = {r.segment: r for r in hashes.filter(F.col("segment").between(first, first + BLOCK - 1)).toLocalIterator()}
    here = range(first, min(first + BLOCK, segments))
    keys = np.frombuffer(b"".join(rows[i].keys for i in here if i in rows), "<u8")
    return Perfect(segments, first, [list(rows[i].sizes) if i in rows else [] for i in here], [bytes(rows[i].bits) if i in rows else b"" for i in here], keys)


def _summed(written_tokens: DataFrame, table, sides: Sides, name: str) -> np.ndarray:
    """Counts by slot: one dense vector per task, cut into slices and added up a tree of ``FAN``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        perfect_hash = table.value
        total = np.zeros(len(perfect_hash.keys), np.int64)
        for batch in batches:
            for piece in pieces(batch, "a", ID_BYTES):
                pair, n = _counted(Aligned(piece.column(0), piece.column(1), sides).pair)
                slot = perfect_hash(pair)
                total[slot[slot >= 0]] += n[slot >= 0]
        part = TaskContext.get().partitionId()
        for i in range(0, len(total), SLICE):
            if total[i:i + SLICE].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // SLICE], pa.int32()), pa.array([part], pa.int64()), pa.array([total[i:i + SLICE].astype("<i8").tobytes()])], ["slice", "part", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = reduce(np.add, (np.frombuffer(v.as_buffer(), "<i8") for c in rows.column("counts").chunks for v in c))
        return pa.table({"slice": rows.column("slice").slice(0, 1), "part": rows.column("part").slice(0, 1), "counts": pa.array([total.astype("<i8").tobytes()])})

    schema = "slice int, part bigint, counts binary"
    level = written(written_tokens.select("a", "b").mapInArrow(count, schema), f"{name}-0")
    width, step = 1 + (level.agg(F.max("part")).first()[0] or 0), 0
    while width > 1:
        step += 1
        level = level.select("slice", F.floor(F.col("part") / FAN).cast("bigint").alias("part"), "counts")
        level = written(level.groupBy("slice", "part").applyInArrow(add, schema), f"{name}-{step}")
        width = -(-width // FAN)
    total = np.zeros(len(table.value.keys), np.int64)
    for r in level.toLocalIterator():
        total[r.slice * SLICE:(r.slice + 1) * SLICE] = np.frombuffer(r.counts, "<i8")
    return total


def counted_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are null, empty, or changed by a tokenizer have no tokens: zeros and an empty string.  Rows that repeat are
    documents of their own; their links count as often.  Ties for the highest count of a B id all count as best.  An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    sides = Sides.of(ByteLevel(a_path), Pieces(b_path))
    both = tokens(docs, a_path, b_path, id_col, text_col)
    hashes, segments = _hashes(both, sides)
    firsts = range(0, segments, BLOCK)
    highest = np.zeros(len(sides.b_sizes), np.int64)
    counts = []
    for first in firsts:
        block = _block(hashes, segments, first)
        shared = spark.sparkContext.broadcast(block)
        counts.append(_summed(both, shared, sides, f"counts{first}"))
        np.maximum.at(highest, (block.keys & U64(0xFFFFFFFF)).astype(np.int64), counts[-1])
        shared.unpersist()
    parts = [_looked_up(spark, both, _block(hashes, segments, first), n, highest, sides, first == 0) for first, n in zip(firsts, counts)]
    whole = reduce(DataFrame.unionByName, parts)
    same = [F.max(c).alias(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
    return whole.groupBy("uid").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.max("groups_sha256").alias("groups_sha256")).drop("uid")


def _looked_up(spark: SparkSession, both: DataFrame, block: Perfect, counts: np.ndarray, highest: np.ndarray, sides: Sides, with_groups: bool) -> DataFrame:
    """Second pass over one block of pairs: what it adds to each document."""
    best = counts == highest[(block.keys & U64(0xFFFFFFFF)).astype(np.int64)]
    table = spark.sparkContext.broadcast((block, counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perfect_hash, n, top = table.value
        numbers = _numbers(sides) if with_groups else None
        for batch in batches:
            for piece in pieces(batch, "a", ID_BYTES):
                x = Aligned(piece.column(2), piece.column(3), sides)
                pair, back = np.unique(x.pair, return_inverse=True)
                slot = perfect_hash(pair.astype(U64))
                here = slot >= 0
                number, is_best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
                number[here], is_best[here] = n[slot[here]], top[slot[here]]
                stop = np.cumsum(x.n_links)
                per_row = lambda v: np.diff(np.concatenate(([0], np.cumsum(v[back])))[np.concatenate(([0], stop))])
                digests = [None] * piece.num_rows
                if with_groups:
                    text, ends = x.groups_as_text(numbers)
                    view, starts = memoryview(text), np.concatenate(([0], ends[:-1]))
                    digests = [hashlib.sha256(view[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), *[pa.array(v.astype(np.int64)) for v in (x.n_a, x.n_b, x.n_groups, x.n_links, per_row(is_best), per_row(number))],
                     pa.array(digests, pa.string())],
                    ["uid", "id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return both.mapInArrow(run, "uid bigint, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
