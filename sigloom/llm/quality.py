"""Quality from compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled texts.  A whole text is compressed with
either and with none; the normalised difference of the two sizes and the two compression ratios go through a logistic
curve fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sigloom.llm.common import pieces

SAMPLE_ROWS = 2000  # labelled rows per class that a fit reads at most
SAMPLE_BYTES = 8 << 20  # and their text bytes per class
LONGEST_SAMPLED = 1 << 20  # bytes of a text from which a fit passes it over, so that no text fills the sample by itself
DICTIONARY_BYTES = 112 << 10
DICTIONARY_SHARE = 0.6  # of the sample; the rest fits the curve
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


class _Sizes:
    """Compressed sizes of one text, turned into features."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False}
        self.tools = []
        for content in (good, bad):
            d = z.ZstdCompressionDict(content)
            d.precompute_compress(level=LEVEL)
            self.tools.append(z.ZstdCompressor(dict_data=d, write_dict_id=False, **plain))
        self.tools.append(z.ZstdCompressor(**plain))

    def features(self, text: bytes) -> list[float]:
        good, bad, alone = (len(t.compress(text)) for t in self.tools)
        x = [(bad - good) / max(bad, good), alone / (len(text) + 20), good / (len(text) + 20)]
        return x + [x[i] * x[j] for i in range(3) for j in range(i, 3)]


def _dictionary(texts: list[bytes]) -> bytes:
    import zstandard as z
    texts = [t for t in texts if len(t) >= 8]
    total = sum(map(len, texts))
    try:
        return z.train_dictionary(min(DICTIONARY_BYTES, max(total // 4, 256)), texts).as_bytes()
    except z.ZstdError:  # too little text for the trainer: the text itself is the dictionary
        return b"".join(texts)[-DICTIONARY_BYTES:]


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict[int, list[bytes]]:
    """A bounded sample per class, in hash order of the id.  Ids with contradicting labels are left out."""
    clean = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).filter("id is not null and label in (0, 1)")
                   .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other"))
    out = {}
    short = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).alias("bytes")).filter(F.col("bytes") <= LONGEST_SAMPLED)
    for label in (0, 1):
        chosen = clean.filter(F.col("label") == label).join(short, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
        rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
                    .filter(F.octet_length("text") <= LONGEST_SAMPLED)
                    .join(F.broadcast(chosen), "id")  # SAMPLE_ROWS ids at most
                    .orderBy(F.xxhash64("id"), "id", F.xxhash64("text"), "text").limit(SAMPLE_ROWS))
        texts, size = [], 0
        for row in rows.toLocalIterator():
            text = row.text.encode()
            if size + len(text) <= SAMPLE_BYTES:
                size += len(text)
                texts.append(text)
        out[label] = texts
    return out


def fit(docs: DataFrame, labels: DataFrame, **names: str) -> Model | None:
    """A model from the labelled rows given; None if a class has no row (then every score is the neutral 0.5)."""
    sample = labelled(docs, labels, **names)
    if not sample[0] or not sample[1]:
        return None
    cut = {k: max(1, math.ceil(len(v) * DICTIONARY_SHARE)) for k, v in sample.items()}
    good, bad = _dictionary(sample[1][:cut[1]]), _dictionary(sample[0][:cut[0]])
    sizes = _Sizes(good, bad)
    rest = {k: v[cut[k]:] or v for k, v in sample.items()}
    x = np.array([sizes.features(t) for k in (0, 1) for t in rest[k]])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(a.shape[1])
    for _ in range(50):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w)), a.T @ (p - y) + 0.1 * w)
    return Model(good, bad, tuple(mean), tuple(scale), tuple(w))


def scored(docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (higher: label 1 likelier) in place of any column of that name.

    The score sees the whole text and nothing else.  A null text counts as empty; an empty one has a score like any other.
    Repeated rows get equal scores; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c.lower() != score_col.lower()]
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0.5).alias(score_col))

    # Plain names inside: a name with a dot cannot pass through mapInArrow.
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    text = f"c{kept.index(text_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _Sizes(model.good, model.bad)
        mean, scale, w = np.array(model.mean), np.array(model.scale), np.array(model.weights)
        for batch in batches:
            for piece in pieces(batch, text):
                texts = piece.column(piece.schema.get_field_index(text)).fill_null("").cast(pa.binary()).to_pylist()
                x = (np.array([sizes.features(t) for t in texts]) - mean) / scale
                score = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(score)], [*piece.schema.names, "score"])

    return inner.mapInArrow(run, StructType([*inner.schema.fields, StructField("score", DoubleType())])).toDF(*kept, score_col)
