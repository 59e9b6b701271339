"""Annotation round: hand out signals to pairs of annotators, then measure and settle what comes back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sigloom.operators import agreement as ag
from sigloom.operators import sampling
from sigloom.sources.writers import write_per_annotator


def hand_out(signals: DataFrame, originals: DataFrame, annotators: list[str], items_per_pair: int, path: str, restore: list[str],
             order: list[str], key: str = "item_id", rows_per_item: int = 5, seed: int = 42) -> DataFrame:
    """Items for every pair of annotators, with the original texts and empty answers, in one folder per annotator.

    ``signals`` holds cleaned rows with the original signal in ``signal_orig``.  Returns the written rows.
    """
    drawn = sampling.assign_pairs_by_item(signals, key, order, items_per_pair, annotators, rows_per_item, seed)
    restored = sampling.restore_originals(drawn, originals, restore, key=key)
    out = sampling.with_annotation_columns(restored, [*restored.columns, *sampling.ANNOTATION_COLUMNS])
    write_per_annotator(out, path)
    return returned(signals.sparkSession, path, out.schema)


def returned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What lies in the annotators' folders."""
    return spark.read.schema(schema).json(path)


@dataclass(frozen=True)
class Round:
    paired: DataFrame
    kappa: DataFrame
    disagreements: DataFrame
    final: DataFrame


def evaluate_round(annotations: DataFrame, pairs: DataFrame, decided: DataFrame, context: tuple[str, ...] = ()) -> Round:
    """Both annotators side by side, agreement per pair, kinds of disagreement, and the adjudicated answers."""
    numbered = annotations.withColumn("label", F.col("label").try_cast("int"))
    paired = ag.pair_annotations(numbered, pairs, context=context)
    return Round(paired, ag.cohen_kappa(paired), ag.disagreements(paired, by_pair=True), ag.adjudicate(paired, decided))
