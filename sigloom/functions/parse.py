"""Parsing of raw model output into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions.text import title_case

STRING_MAP = "map<string,string>"


def first_dict(text: Column) -> Column:
    """First flat dict literal in free text as a map; NULL when there is none or it cannot be read."""
    # The entry loop is possessive: an entry never parses two ways, so backtracking cannot help.
    pattern = fv.FLAT_DICT_PATTERN.replace(")*\\}", ")*+\\}")
    literal = F.regexp_extract(text, pattern, 0)
    return F.when(literal != "", F.from_json(F.regexp_replace(literal, r",\s*\}$", "}"), STRING_MAP))


def dict_text(text: Column) -> Column:
    """A whole string that is a dict literal, as a map."""
    return F.from_json(text, STRING_MAP)


def value_of(pairs: Column, key: str) -> Column:
    """Value of ``key``; a repeated key gives its last value."""
    found = F.filter(F.map_entries(pairs), lambda e: e["key"] == F.lit(key))
    return F.try_element_at(found, F.lit(-1))["value"]


def _text(pairs: Column, key: str) -> Column:
    return F.coalesce(value_of(pairs, key), F.lit(""))


def single_signal(pairs: Column) -> Column:
    return title_case(_text(pairs, "characteristic"))


def signal_list(pairs: Column, n: int = fv.SIGNALS_PER_ITEM) -> Column:
    """``n`` structs (rank, signal, explanation); missing keys give ''.  One signal uses bare key names."""
    names = [("characteristic", "explanation")] if n == 1 else \
        [(f"characteristic_{i}", f"explanation_{i}") for i in range(1, n + 1)]
    return F.array(*[
        F.struct(F.lit(i).alias("rank"), title_case(_text(pairs, s)).alias("signal"), _text(pairs, e).alias("explanation"))
        for i, (s, e) in enumerate(names, start=1)])


def wide_signals(df: DataFrame, signals: str, signal_prefix: str, explanation_prefix: str,
                 n: int = fv.SIGNALS_PER_ITEM) -> DataFrame:
    """One column per signal and explanation."""
    return df.select(
        "*",
        *[F.col(signals)[i]["signal"].alias(f"{signal_prefix}_{i + 1}") for i in range(n)],
        *[F.col(signals)[i]["explanation"].alias(f"{explanation_prefix}_{i + 1}") for i in range(n)])


def judge_json(text: Column) -> Column:
    """Judge answer without code fences as struct(signal_label, reason, explanation)."""
    body = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```(?:json)?", ""), r"```$", ""))
    parsed = F.from_json(body, "signal_label string, reason string, explanation string")
    return F.struct(parsed["signal_label"].alias("signal_label"),
                    F.coalesce(parsed["reason"], F.lit("")).alias("reason"),
                    F.coalesce(parsed["explanation"], F.lit("")).alias("explanation"))


def label_digit(text: Column) -> Column:
    """The single digit after 'Label:'; NULL when absent."""
    return F.regexp_extract(text, fv.LABEL_DIGIT_PATTERN, 1).try_cast("int")


def label_list(text: Column, last: bool = False) -> Column:
    """Integers after 'Label:'/'Labels:', from the first or the last match; [] when absent."""
    runs = F.regexp_extract_all(text, F.lit(fv.LABEL_LIST_PATTERN), F.lit(1))
    run = F.try_element_at(runs, F.lit(-1 if last else 1))
    parts = F.transform(F.split(run, ","), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    digits = F.filter(parts, lambda p: p.rlike(r"^[0-9]+$"))
    return F.coalesce(F.transform(digits, lambda d: d.cast("int")), F.array().cast("array<int>"))


def first_label(labels: Column) -> Column:
    return F.coalesce(F.try_element_at(labels, F.lit(1)), F.lit(-1))


def ungroup_lines(grouped: Column) -> Column:
    """Lines of numbered text without their numbers; empty lines dropped; NULL gives []."""
    lines = F.transform(F.split(grouped, "\n"), lambda s: F.trim(F.regexp_replace(F.trim(s), r"^\d+\.\s*", "")))
    return F.coalesce(F.filter(lines, lambda s: s != ""), F.array().cast("array<string>"))


def as_list(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<int>"))


def can_explode(grouped: Column, labels: Column) -> Column:
    return (F.size(ungroup_lines(grouped)) == F.size(as_list(labels))).cast("int")


def explode_predictions(df: DataFrame, grouped: str = "grouped_signals", labels: str = "pred_score",
                        flag: str = "can_explode") -> DataFrame:
    """One row per (signal, label) for the rows whose lists have the same length."""
    zipped = F.arrays_zip(ungroup_lines(F.col(grouped)).alias("signal"), as_list(F.col(labels)).alias("label"))
    rest = [c for c in df.columns if c not in (grouped, labels, flag)]
    return df.filter(F.col(flag) == 1).select(*rest, F.inline(zipped).alias("signal", "label"))


def keep_first_label_of_single(grouped: Column, labels: Column) -> Column:
    """One signal but several labels: keep the first label."""
    return F.when(~F.contains(grouped, F.lit("\n")) & (F.size(labels) > 1), F.slice(labels, 1, 1)).otherwise(labels)


def numbered_values(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(fv.NUMBERED_VALUE_PATTERN), F.lit(1))


def feature_value(text: Column) -> Column:
    found = F.regexp_extract(text, fv.FEATURE_VALUE_PATTERN, 1)
    return F.when(found != "", found)


def reparse_missing(df: DataFrame, models: list[str], drop_empty: bool = True) -> DataFrame:
    """Re-read the signal from the raw text where it is ''; drop rows where any model still has none."""
    fixed = df.withColumns({
        f"signal_{m}": F.when(F.col(f"signal_{m}") == "", single_signal(first_dict(F.col(f"text_{m}"))))
        .otherwise(F.col(f"signal_{m}")) for m in models})
    if not drop_empty:
        return fixed
    for m in models:
        fixed = fixed.filter(F.col(f"signal_{m}") != "")
    return fixed


def long_signals(df: DataFrame, id_col: str, text_cols: list[str], signal_prefix: str, explanation_prefix: str,
                 signal: str = "signal", explanation: str = "explanation") -> DataFrame:
    """Wide signal columns to rows; the number of signals is read from the schema."""
    ranks = sorted(int(c[len(signal_prefix) + 1:]) for c in df.columns
                   if c.startswith(f"{signal_prefix}_") and c[len(signal_prefix) + 1:].isdigit())
    rows = F.array(*[F.struct(F.lit(i).alias("rank"), F.col(f"{signal_prefix}_{i}").alias(signal),
                              F.col(f"{explanation_prefix}_{i}").alias(explanation)) for i in ranks])
    kept = F.filter(rows, lambda r: r[signal].isNotNull() & (r[signal] != ""))
    return df.select(id_col, *text_cols, F.inline(kept).alias("rank", signal, explanation))
