"""Uplift training table: filters, labels, split and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.operators import filters as flt
from sigloom.operators import sampling, uplift


def training_table(df: DataFrame, qualified: list[str], fraction: float = 0.8, split_by: str = "time", time: str = "ts",
                   row_key: str = "event_id", drop_not_shown: bool = False, only_choiceable: bool = False, only_converted: bool = False,
                   negatives_per_positive: float | None = None, categorical: list[str] | None = None,
                   method: str = "per_qualification_set", positive_scale: float = 1.0, seed: int = 42) -> DataFrame:
    """All rows with label, role and weight; weights are computed inside the training part (NULL for test rows)."""
    if only_converted and negatives_per_positive is not None:
        raise ValueError("only_converted and negatives_per_positive exclude each other")
    if split_by == "time" and negatives_per_positive is not None:
        raise ValueError("dropping negatives after a time split leaks later rows")
    rows = flt.shown_rows(df) if drop_not_shown else df
    rows = flt.choiceable_rows(rows, qualified) if only_choiceable else rows
    rows = flt.fill_zero(rows, categorical or [])
    rows = rows.withColumn("label", uplift.composite_label())
    split = sampling.split_by_time(rows, time, [row_key], fraction) if split_by == "time" else \
        sampling.split_by_key(rows, split_by, fraction, seed)
    train = F.col("role") == "train"
    if only_converted:
        split = split.filter(~train | (F.col("conversion") == 1))
    elif negatives_per_positive is not None:
        kept = sampling.keep_positives(split.filter(train), [row_key], "conversion", negatives_per_positive, seed)
        split = kept.unionByName(split.filter(~train))
    # One frame for both parts: weights are counted among the training rows and joined to them.
    return uplift.sample_weights(split, method, qualified, positive_scale=positive_scale, among=train)
