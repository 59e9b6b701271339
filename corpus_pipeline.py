"""From raw documents to packed training sequences.

``STAGES`` lists (name, function) in order; each function takes (spark, docs, sf_dir) and works on all that its
predecessor kept.  All but the last return rows with the columns of ``documents``; the last one returns the pieces of
the packed sequences.  Missing values, repeated rows and empty tables are handled as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import mixing, near, pack, quality, radix
from sigloom.llm.common import written
from sigloom.llm.registry import tokenizer_path, training_labels

KEEP_FROM = 0.3  # score from which a document stays


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labels of these documents, does not reject."""
    labels = training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "_quality_score"
    while score in docs.columns:
        score += "_"
    scored = quality.scored(docs, quality.fit(docs, labels), score_col=score)
    return scored.filter(F.col(score) >= KEEP_FROM).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return radix.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with the ids as little-endian unsigned 32-bit integers."""
    packed = pack.packed(docs, tokenizer_path())
    return packed.select(F.col("id").alias("doc_id"), "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near), ("mixing", mix), ("packing", pack_sequences)]

ORACLE_SQL = None  # signatures, compression and tokenizers have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
