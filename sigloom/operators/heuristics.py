"""Quality rules: 0/1 flags per signal, as cascades of regular expressions inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions import text as tx
from sigloom.operators.match import NGRAM_COLUMNS
from sigloom.operators.ordering import evaluate_once


def _any_match(text: Column, patterns: list[str], flags: str = "") -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(flags + p) for p in patterns])


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def no_match() -> Column:
    return _flag(F.col("match_type") == "no_match")


def title_exact() -> Column:
    return _flag((F.col("match_column") == "title") & (F.col("match_type") == "exact"))


def repeated_words(text: Column) -> Column:
    """Accepted shape 0, rejected shape 1, otherwise 1 when more than two tokens belong to repeated words."""
    tokens = F.transform(F.filter(tx.words(text), lambda t: ~t.rlike("(?i)" + fv.REPEAT_IGNORED_TOKEN)), lambda t: F.lower(t))
    repeated = tx.let(tokens, lambda ts: F.size(F.filter(ts, lambda t: F.size(F.filter(ts, lambda u: u == t)) > 1)))
    return (F.when(_any_match(text, fv.REPEAT_ACCEPT, "(?i)"), 0).when(_any_match(text, fv.REPEAT_REJECT, "(?i)"), 1)
             .otherwise(_flag(repeated > 2)))


def forbidden_words(text: Column, denied: list[str] | None = None) -> Column:
    return _flag(tx.has_whole_word(text, fv.denied_signal_words() if denied is None else denied))


def has_number(text: Column) -> Column:
    return _flag(F.exists(tx.words(text), lambda t: t.rlike("^[0-9]+$")))


def join_thousands(text: Column) -> Column:
    """'10 000' counts as one number: zeros after a number are dropped."""
    return F.regexp_replace(tx.squeeze(text), fv.SPLIT_THOUSANDS, "$1")


def numerically_dominant(text: Column) -> Column:
    flat = join_thousands(text)
    tokens = tx.words(flat)
    total = F.size(tokens)
    numbers = F.size(F.filter(tokens, lambda t: t.rlike(fv.NUMERIC_TOKEN)))
    return (F.when(_any_match(flat, fv.NUMERIC_EXEMPT), 0).when(total <= 2, 0)
             .otherwise(_flag((numbers >= total / 2) | (numbers > 2))))


def numbers_to_exclude(text: Column) -> Column:
    flat = join_thousands(text)
    return F.when(_any_match(flat, fv.NUMBER_ACCEPT), 0).otherwise(_flag(_any_match(flat, fv.NUMBER_REJECT)))


def numbers_to_keep(text: Column) -> Column:
    return F.when(_any_match(text, fv.NUMBER_KEEP), 0).otherwise(1)


def apply_rules(df: DataFrame, how: list[str] | None = None, denied: list[str] | None = None, signal: str = "signal",
                keep_rules_sum: bool = False) -> DataFrame:
    """Add the chosen flags and their sums; an unknown name is an error; n-gram detail columns are dropped.

    The flags are evaluated once, so filtering on a sum afterwards does not run the rules a second time.
    """
    text = F.col(signal)
    rules = {"no_match": no_match, "title_exact": title_exact, "repeated_words": lambda: repeated_words(text),
             "forbidden_words": lambda: forbidden_words(text, denied), "has_number": lambda: has_number(text),
             "numerically_dominant": lambda: numerically_dominant(text),
             "numbers_to_exclude_by_pattern": lambda: numbers_to_exclude(text)}
    how = fv.STRICT_FLAGS if how is None else how
    unknown = [h for h in how if h not in rules]
    if unknown:
        raise ValueError(f"unknown rules: {', '.join(unknown)}")
    flagged = evaluate_once(df, **{h: rules[h]() for h in how}) if how else df
    total = lambda names: reduce(lambda a, b: a + b, [F.col(n) for n in names])
    sums = {"sum_exclusions_by_how": total(how)} if how else {}
    if set(fv.STRICT_FLAGS) <= set(flagged.columns):
        sums["sum_exclusions_strict"] = total(fv.STRICT_FLAGS)
    if keep_rules_sum and set(fv.RULE_FLAGS) <= set(flagged.columns):
        sums["sum_exclusions_rules"] = total(fv.RULE_FLAGS)
    return flagged.withColumns(sums).drop(*NGRAM_COLUMNS)


def kept(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("sum_exclusions_by_how") == 0)


def excluded(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("sum_exclusions_by_how") > 0)
