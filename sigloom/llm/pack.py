"""Packing token streams: concatenate and cut.

Pass one turns every document into ids, notes how many ids of the same task precede it, and writes both.  The totals per
task are a table of one row per task; its prefix sums give every task its global offset.  Pass two adds the two and cuts
the stream at multiples of the window.  A document that crosses a cut gives one boundary piece per window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import PIECE_BYTES, pieces, worker_store, written

WINDOW = 4096
END_ID = 2
STORE_BYTES = 64 << 20  # memory of the chunks and words that a worker remembers, each; only speed depends on it
ENTRY_BYTES = 200  # what Python needs for an entry besides its bytes
LONGEST_KEPT = 256  # bytes of a chunk that is remembered
TEXT_BYTES = 4 << 20  # text encoded at once

IDS_SCHEMA = "part int, before bigint, n bigint, ids binary, id bigint"
PIECE_SCHEMA = "id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    No token of this vocabulary reaches over white space (its pattern has none and its merges stay inside a word), so a
    text's ids are those of its chunks between ASCII white space, in order.  Chunks come back often: a piece of text is
    reduced to its distinct chunks, and what was encoded before is remembered.  A chunk of plain letters, digits and
    symbols falls into the vocabulary's words, which are encoded many at a time; each of them ends in a word-end token.
    Every other chunk goes to the tokenizer as it is.
    """

    LETTERS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"  # Latin-1 letters in UTF-8: nothing to normalise
    SYMBOLS = rb"[!-&(-/:-@\[-`{-~]+"  # ASCII without the apostrophe, which may begin a contraction
    TOGETHER = 500

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.others = worker_store(f"words of {path}"), worker_store(f"other chunks of {path}")
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.word = re.compile(self.LETTERS + rb"|[0-9]|" + self.SYMBOLS)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        texts = texts.fill_null("").cast(pa.large_string())
        marked = pc.any(pc.match_substring(texts, "<|")).as_py()  # special tokens depend on case
        split = pc.ascii_split_whitespace(texts if marked else pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        ids = self._of_chunks(coded.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, start = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        length = sizes[at]
        before = np.cumsum(length) - length
        out = flat[np.repeat(start[at] - before, length) + np.arange(int(length.sum()))]
        ends = np.append(before, len(out))[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return out, np.diff(ends)

    def _of_chunks(self, chunks: list[bytes]) -> list[bytes]:
        known, others = self.words, self.others
        for store in (known, others):
            if store.get(None, 0) > STORE_BYTES:  # the size stands beside the entries
                store.clear()
        new = [c for c in chunks if c not in known and c not in others]
        split = list(map(self.word.findall, new))
        plain = [b"".join(ws) == c and b"<|" not in c for c, ws in zip(new, split)]
        self._learn_words(list({w for ws, p in zip(split, plain) if p for w in ws if w not in known}))
        found = {c: known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for c, ws, p in zip(new, split, plain) if p}
        odd = [c for c, p in zip(new, plain) if not p]
        coded = {c: np.asarray(e.ids, "<u4").tobytes() for c, e in zip(odd, self.tokenizer.encode_batch_fast([c.decode() for c in odd], add_special_tokens=False))}
        out = [known.get(c) or others.get(c) or found.get(c) or coded.get(c, b"") for c in chunks]
        short = {c: ids for c, ids in coded.items() if ids and len(c) <= LONGEST_KEPT}
        others.update(short)
        others[None] = others.get(None, 0) + sum(len(c) + len(ids) + ENTRY_BYTES for c, ids in short.items())
        for w in [w for c, ws in zip(new, split) if len(c) > LONGEST_KEPT for w in ws if len(w) > LONGEST_KEPT]:
            known.pop(w, None)
        return out

    def _learn_words(self, words: list[bytes]) -> None:
        for i in range(0, len(words), self.TOGETHER):
            group = words[i:i + self.TOGETHER]
            ids = np.asarray(self.tokenizer.encode(b" ".join(group).decode(), add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(group):
                raise ValueError("this vocabulary does not close every word with a word-end token")
            for w, a, b in zip(group, [0, *stops], stops):
                self.words[w] = ids[a:b].tobytes()
            self.words[None] = self.words.get(None, 0) + sum(len(w) + ENTRY_BYTES for w in group) + 4 * len(ids)


def token_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Pass one: every document's ids (closed by ``end_id``), its task and the ids before it in that task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # cores belong to Spark's tasks
        encoder, part, before = Encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch, "text", TEXT_BYTES):
                flat, n = encoder.encode(piece.column(1))
                ids = np.insert(flat, np.cumsum(n), end_id).astype("<u4")
                n = n + 1
                first = before + np.cumsum(n) - n
                before += int(n.sum())
                offsets = np.concatenate(([0], np.cumsum(n))) * 4
                packed_ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(first), pa.array(n), packed_ids.cast(pa.binary()), piece.column(0)],
                    ["part", "before", "n", "ids", "id"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return written(narrow.mapInArrow(run, IDS_SCHEMA), "ids")


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids: id, start, length, ids, doc_tokens, sequence_id, offset.

    All sequences are full but the last.  A null or empty text is its end id alone.  Repeated rows and null ids are
    packed like any other row.  An empty table gives no pieces.
    """
    tokens = token_table(docs, tokenizer_path, id_col, text_col, end_id)
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))  # one row per task of pass one
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "ids", PIECE_BYTES):
                rows = []
                for key, ids, n, at in zip(*(c.to_pylist() for c in piece.columns)):
                    start = 0
                    while start < n:
                        sequence, offset = divmod(at + start, window)
                        length = min(n - start, window - offset)
                        rows.append((key, start, length, ids[4 * start:4 * (start + length)], n, sequence, offset))
                        start += length
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    # 16 bytes per task of pass one: a size that follows the number of input splits, not the rows in them.
    placed = tokens.join(F.broadcast(base), "part").select("id", "ids", "n", (F.col("base") + F.col("before")).alias("at"))
    return placed.mapInArrow(cut, PIECE_SCHEMA)
