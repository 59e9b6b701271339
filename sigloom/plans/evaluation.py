"""Evaluate and filter: clean, ground, flag, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions import text as tx
from sigloom.operators.filters import present_columns
from sigloom.operators.heuristics import apply_rules
from sigloom.operators.match import ground

TEXT_COLUMNS = ["signal", "title", "aspects", "desc"]


def clean_columns(df: DataFrame, columns: list[str], originals: dict[str, str] | None = None, signal: str = "signal") -> DataFrame:
    """Clean the listed columns (NULL becomes ''), keep originals under new names, drop rows without a signal."""
    kept = {new: F.coalesce(F.col(old).cast("string"), F.lit("")) for old, new in (originals or {}).items() if old in df.columns}
    cleaned = {c: tx.clean(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns if c in df.columns}
    out = df.withColumns({**kept, **cleaned})
    return out.filter(F.col(signal) != "") if signal in out.columns else out


def evaluate(df: DataFrame, columns: list[str] | None = None, originals: dict[str, str] | None = None,
             select: list[str] | None = None, how: list[str] | None = None, denied: list[str] | None = None) -> DataFrame:
    """All rows with match columns, flags and sums.  ``kept`` and ``excluded`` of the rules split them."""
    cleaned = clean_columns(df, columns or TEXT_COLUMNS, originals or {"signal": "signal_orig"})
    chosen = present_columns(cleaned, select) if select else cleaned
    return apply_rules(ground(chosen), fv.RULE_FLAGS if how is None else how, denied)
