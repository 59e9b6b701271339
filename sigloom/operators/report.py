"""Counts, shares and text statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions import text as tx
from sigloom.operators.ordering import explode_once

WORD = r"([\p{L}\p{N}_]+)"


def _total(counts: DataFrame, column: str = "n") -> Column:
    """Sum over all groups as a scalar subquery: one small aggregate, no join and no global window."""
    return counts.agg(F.sum(column)).scalar()


def value_counts(df: DataFrame, column: str, total_row: bool = True, name: str = "value") -> DataFrame:
    """Count and percent (one decimal, half-even) per value; NULLs count only in the total."""
    counts = df.groupBy(F.col(column).cast("string").alias(name)).agg(F.count("*").alias("n"))
    shares = counts.filter(F.col(name).isNotNull()).select(
        name, "n", F.bround(F.col("n") / _total(counts) * 100, 1).alias("percent"))
    if not total_row:
        return shares
    return shares.unionByName(counts.agg(F.lit("Total Rows").alias(name), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                                         F.lit(100.0).alias("percent")))


def value_counts_by(df: DataFrame, group: str, column: str) -> DataFrame:
    """Counts per (group, value) with the share inside the group."""
    counts = df.groupBy(group, column).agg(F.count("*").alias("n"))
    totals = counts.groupBy(group).agg(F.sum("n").alias("group_n"))
    return counts.join(totals, group).withColumn("percent", F.bround(F.col("n") / F.col("group_n") * 100, 1))


def exclusion_summary(df: DataFrame, flags: list[str], total: str = "sum_exclusions_by_how") -> DataFrame:
    """Sum per flag, rows with any exclusion, and the share of those rows."""
    present = [f for f in flags if f in df.columns]
    sums = df.agg(*[F.coalesce(F.sum(f), F.lit(0)).cast("bigint").alias(f) for f in present],
                  F.count_if(F.col(total) >= 1).alias(total))
    rows = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("n")) for f in [*present, total]])
    return sums.select(total, F.inline(rows).alias("flag", "n")).select(
        "flag", "n", F.when(F.col(total) > 0, F.bround(F.col("n") / F.col(total) * 100, 1)).otherwise(F.lit(0.0)).alias("percent"))


def _percent(share: Column) -> Column:
    return F.floor(share * 10000) / 100


def word_frequency(df: DataFrame, column: str, stem: bool = False) -> DataFrame:
    """Document frequency of words: a word counts once per row.

    Rows: word, n, token_density(_pct) over all counts, row_density(_pct) over all rows; percents truncated.
    """
    text = tx.normalize(F.col(column)) if stem else F.lower(F.col(column))
    words = explode_once(df, [], F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(1))), "word")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    tokens, rows = F.col("n") / _total(counts), F.col("n") / df.agg(F.count("*")).scalar()
    return counts.select("word", "n", tokens.alias("token_density"), _percent(tokens).alias("token_density_pct"),
                         rows.alias("row_density"), _percent(rows).alias("row_density_pct"))


def top_words(df: DataFrame, column: str, k: int) -> DataFrame:
    return word_frequency(df, column).orderBy(F.col("n").desc(), "word").limit(k)


def denied_word_counts(df: DataFrame, column: str, denied: list[str] | None = None) -> DataFrame:
    """Rows whose lower-cased text contains each deny word, in one pass; words never found count 0.

    The words are compared as written, so an entry with capitals cannot match lower-cased text.
    """
    words = fv.DENIED_SOURCE_WORDS if denied is None else denied
    listed_words = F.array(*[F.lit(w) for w in dict.fromkeys(words)])
    hits = tx.let(F.lower(F.col(column)), lambda t: F.filter(listed_words, lambda w: F.contains(t, w)))
    found = explode_once(df, [], hits, "word")
    listed = df.sparkSession.createDataFrame([(w,) for w in dict.fromkeys(words)], "word string")
    counts = found.groupBy("word").agg(F.count("*").alias("n"))
    return listed.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def share_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.agg(F.avg(F.col(column).rlike(pattern).cast("int")).alias("share"))


def text_statistics(df: DataFrame, columns: list[str], token_count=tx.word_count) -> DataFrame:
    """Average characters and tokens per row over the given columns, one decimal (half-even)."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    chars = sum((F.length(t) for t in text), F.lit(0))
    tokens = sum((token_count(t) for t in text), F.lit(0))
    return df.agg(F.bround(F.avg(chars), 1).alias("avg_chars"), F.bround(F.avg(tokens), 1).alias("avg_tokens"))


def text_statistics_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    stats = df.agg(*[F.avg(F.length(F.col(c))).alias(f"{c}_chars") for c in columns],
                   *[F.avg(tx.word_count(F.col(c))).alias(f"{c}_tokens") for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.bround(F.col(f"{c}_chars"), 1).alias("avg_chars"),
                              F.bround(F.col(f"{c}_tokens"), 1).alias("avg_tokens")) for c in columns])
    return stats.select(F.inline(rows).alias("column", "avg_chars", "avg_tokens"))


def funnel_counts(steps: dict[str, Column]) -> list[Column]:
    """Aggregates: rows at the start and after each step (a row must pass all steps up to it)."""
    passed, counts = F.lit(True), [F.count("*").alias("start")]
    for name, condition in steps.items():
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    return counts


def observed(spark: SparkSession, metrics: Observation, names: list[str]) -> DataFrame:
    """One row with the metrics that an action took on its way; waits for that action."""
    got = metrics.get
    return spark.createDataFrame([tuple(got[n] for n in names)], ", ".join(f"`{n}` bigint" for n in names))


def funnel_on_write(df: DataFrame, steps: dict[str, Column], write: Callable[[DataFrame], None]) -> DataFrame:
    """The funnel of the rows that ``write`` writes, counted while it does so.  It must write all rows by one action."""
    metrics = Observation()
    write(df.observe(metrics, *funnel_counts(steps)))
    return _as_funnel(observed(df.sparkSession, metrics, ["start", *steps]), steps)


def funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows left after each step (a row must pass all steps up to it), with the percent of the start."""
    return _as_funnel(df.agg(*funnel_counts(steps)), steps)


def _as_funnel(one: DataFrame, steps: dict[str, Column]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(n).alias("n"))
                     for i, n in enumerate(["start", *steps])])
    return one.select(F.col("start").alias("_s"), F.inline(rows).alias("step", "name", "n")).select(
        "step", "name", "n", F.round(F.col("n") / F.col("_s") * 100, 2).alias("percent"))


def vocabulary(df: DataFrame, columns: list[str]) -> DataFrame:
    text = F.concat_ws(" ", *[F.col(c) for c in columns])
    return explode_once(df, [], tx.words(text), "word").distinct()


def set_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys in both, only left and only right; one shuffle for both sides."""
    tagged = left.select(key, F.lit(1).alias("side")).unionByName(right.select(key, F.lit(2).alias("side")))
    sides = tagged.filter(F.col(key).isNotNull()).groupBy(key).agg(F.bit_or("side").alias("s"))
    return sides.agg(F.count_if(F.col("s") == 3).alias("both"), F.count_if(F.col("s") == 1).alias("only_left"),
                     F.count_if(F.col("s") == 2).alias("only_right"))


def column_health(df: DataFrame, nullable: str, pair: tuple[str, str], flag: Column) -> DataFrame:
    """NULL share of a column, share of rows where a pair of columns agrees, mean of a boolean flag."""
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    return df.agg(share(F.col(nullable).isNull()).alias("null_share"),
                  share(F.col(pair[0]).eqNullSafe(F.col(pair[1]))).alias("agree_share"), share(flag).alias("flag_mean"))


# --- tokens by corpus frequency -------------------------------------------------------------------
def frequent_tokens(df: DataFrame, key: str, column: str, top: int = 3, stem: bool = True) -> DataFrame:
    """The first ``top`` tokens of each row by corpus frequency (ties by position, repeats kept).

    A common word can be in a third of all rows: the lookup is a plain join, which adaptive execution splits there, and
    the vocabulary is not assumed to fit a broadcast.  The row-number limit keeps ``top`` tokens per row before the shuffle.
    """
    text = tx.normalize(F.col(column)) if stem else F.lower(F.col(column))
    base = df.select(key, text.alias("_t"))
    found = F.regexp_extract_all("_t", F.lit(WORD), F.lit(1))
    tokens = explode_once(base, [key], found, "word", "pos")
    once = explode_once(base, [], F.array_distinct(found), "word")
    counts = once.groupBy("word").agg(F.count("*").alias("n"))
    best = Window.partitionBy(key).orderBy(F.col("n").desc(), "pos")
    first = tokens.join(counts, "word").withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= top)
    ranked = first.groupBy(key).agg(*[F.max(F.when(F.col("_rn") == i + 1, F.col("word"))).alias(f"token{i + 1}") for i in range(top)])
    return df.select(key).join(ranked, key, "left")
