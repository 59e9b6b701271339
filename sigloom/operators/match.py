"""Grounding: does a signal occur in the item's own text?

All tests are Column expressions over whole texts.  Text tokens are kept as one blank-padded string, so
"token-aligned occurrence" is a plain substring test, and nothing grows with the number of token pairs.  N-grams are held
as run lengths per signal word; how many of them match is arithmetic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions import text as tx
from sigloom.functions.parse import reparse_missing
from sigloom.operators.filters import drop_aspects_by_substring
from sigloom.operators.ordering import evaluate_once

SOURCES = ("title", "aspects", "desc")
NGRAM_COLUMNS = ["ngram_coverage", "non_ngram_match", "ngram_match_counts", "all_ngrams"]


def _long_words(text: Column) -> Column:
    return F.filter(tx.words(text), lambda w: F.length(w) > 1)


def _padded(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _has_token_run(padded: Column, run: Column) -> Column:
    return F.contains(padded, F.concat(F.lit(" "), run, F.lit(" ")))


def exact_match(signal: Column, text: Column) -> Column:
    """Whitespace-normalised lower-cased substring."""
    return F.contains(tx.squeeze(F.lower(text)), tx.squeeze(F.lower(signal)))


def _left_over(words: Column, taken: Column) -> Column:
    """Words of a sorted list that remain after taking another sorted list out of it; NULL if some were not there."""
    def step(state: Column, w: Column) -> Column:
        used = F.coalesce(F.get(taken, state["at"]) == w, F.lit(False))
        return F.struct((state["at"] + used.cast("int")).alias("at"), F.when(used, state["rest"]).otherwise(F.array_append(state["rest"], w)).alias("rest"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("rest"))
    return F.aggregate(words, begin, step, lambda state: F.when(state["at"] == F.size(taken), state["rest"]))


def permutation_match(signal_words: Column, text_words: Column) -> Column:
    """Some order of the signal words, joined by blanks, is a substring of the joined text words.

    Equivalent to trying all k! orders: a window of k text words fits if its first word ends with one signal
    word, its last starts with another, and the words between are exactly the remaining ones.
    """
    return tx.let(F.struct(signal_words.alias("s"), text_words.alias("t"), F.array_join(text_words, " ").alias("joined")), _permuted)


def _permuted(v: Column) -> Column:
    words, text = v["s"], v["t"]
    k, n = F.size(words), F.size(text)
    possible = F.forall(words, lambda w: F.contains(v["joined"], w))  # cheap and almost always false

    def fits(i: Column, ordered: Column) -> Column:
        first, last = F.get(text, i), F.get(text, i + k - 1)
        ends = lambda rest: F.coalesce((F.size(rest) == 2) & (
            (first.endswith(F.get(rest, F.lit(0))) & last.startswith(F.get(rest, F.lit(1))))
            | (first.endswith(F.get(rest, F.lit(1))) & last.startswith(F.get(rest, F.lit(0))))), F.lit(False))
        likely = F.exists(ordered, lambda w: first.endswith(w)) & F.exists(ordered, lambda w: last.startswith(w))
        inner = F.sort_array(F.slice(text, i + 2, k - 2))
        return F.when(likely, tx.let(_left_over(ordered, inner), ends)).otherwise(F.lit(False))

    some_window = tx.let(F.sort_array(words), lambda ordered: F.exists(F.sequence(F.lit(0), n - k), lambda i: fits(i, ordered)))
    return (F.when(k == 0, F.lit(True)).when(~possible, F.lit(False)).when(k == 1, F.lit(True))
             .when(n < k, F.lit(False)).otherwise(some_window))


def ngrams(words: Column) -> Column:
    """Runs of 2 .. k-1 consecutive words, distinct; none for fewer than three words."""
    k = F.size(words)
    runs = F.flatten(F.transform(F.sequence(F.lit(2), F.greatest(k - 1, F.lit(2))), lambda size: F.transform(
        F.sequence(F.lit(1), k - size + 1), lambda i: F.array_join(F.slice(words, i, size), " "))))
    return F.when(k >= 3, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _reach(words: Column, text: Column | None = None) -> Column:
    """For every word the length of the longest run of words beginning there that occurs in the padded ``text``.

    Without a text: that also begins at an earlier word.  Of a run that occurs every part occurs, so these lengths stand
    for all runs.  The run of the next word ends no earlier, hence both ends only move forward: at most two tests a word.
    """
    def scan(v: Column) -> Column:
        k = F.size(v["w"])

        def occurs(at: Column, size: Column) -> Column:
            where = v["t"] if text is not None else _padded(F.slice(v["w"], F.lit(1), at + size - 1))
            return _has_token_run(where, F.array_join(F.slice(v["w"], at + 1, size), " "))

        def state(at: Column, size: Column, out: Column) -> Column:
            return F.struct(at.alias("at"), size.alias("size"), out.alias("out"))

        def step(s: Column, _: Column) -> Column:
            longer = (s["at"] + s["size"] < k) & occurs(s["at"], s["size"] + 1)
            return (F.when(longer, state(s["at"], s["size"] + 1, s["out"]))
                     .when(s["at"] < k, state(s["at"] + 1, F.greatest(s["size"] - 1, F.lit(0)), F.array_append(s["out"], s["size"])))
                     .otherwise(s))

        begin = state(F.lit(0), F.lit(0), F.array().cast("array<int>"))
        return F.when(k > 0, F.aggregate(F.sequence(F.lit(1), 2 * k), begin, step, lambda s: s["out"])).otherwise(F.array().cast("array<int>"))

    held = [words.alias("w")] + ([text.alias("t")] if text is not None else [])
    return tx.let(F.struct(*held), scan)


def _repeats(words: Column) -> Column:
    """Per word the length of the longest run from it that began earlier too: its parts are n-grams already counted."""
    return F.when(F.size(F.array_distinct(words)) == F.size(words), F.array_repeat(F.lit(0), F.size(words))).otherwise(_reach(words))


def _new_ngrams(reach: Column, repeats: Column) -> Column:
    """Number of distinct n-grams (2 .. k-1 words) inside the runs, by arithmetic."""
    top = F.size(repeats) - 1
    per_word = F.zip_with(reach, repeats, lambda r, d: F.greatest(F.least(r, top) - F.greatest(d, F.lit(1)), F.lit(0)))
    return F.aggregate(per_word, F.lit(0), lambda a, x: a + x)


def _ngram_counts(words: Column, repeats: Column, reaches: list[Column]) -> Column:
    """Distinct matched n-gram -> number of texts that hold it."""
    top = F.size(words) - 1

    def from_word(i: Column) -> Column:
        lengths = [F.least(F.get(r, i), top) for r in reaches]
        low, high = F.greatest(F.get(repeats, i) + 1, F.lit(2)), F.greatest(*lengths)
        held = lambda size: reduce(lambda a, b: a + b, [(n >= size).cast("int") for n in lengths])
        entry = lambda size: F.struct(F.array_join(F.slice(words, i + 1, size), " ").alias("key"), held(size).alias("value"))
        return F.when(high >= low, F.transform(F.sequence(low, high), entry)).otherwise(F.array().cast("array<struct<key:string,value:int>>"))

    return F.flatten(F.transform(F.sequence(F.lit(0), top), from_word))


def _first_true(conditions: list[tuple[Column, str]]) -> Column:
    column = F.when(conditions[0][0], conditions[0][1])
    for condition, value in conditions[1:]:
        column = column.when(condition, value)
    return column


def ground(df: DataFrame, signal: str = "signal", sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Adds match_type, match_column, ngram_coverage, non_ngram_match, ngram_match_counts and all_ngrams.

    Exact match in any source wins over permutation, permutation over n-grams.  Later and costlier columns
    are only computed for rows the earlier steps left open.
    """
    sig = F.coalesce(F.col(signal), F.lit(""))
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in sources}
    keep = df.columns
    # Step 1: token arrays and the exact test.
    df = df.withColumns({
        "_exact": _first_true([(exact_match(sig, text[c]), c) for c in sources]),
        "_words": _long_words(sig), **{f"_tokens_{c}": _long_words(text[c]) for c in sources}})
    # Step 2: permutation, only where nothing was exact.
    df = df.withColumn("_perm", F.when(F.col("_exact").isNull(), _first_true(
        [(permutation_match(F.col("_words"), F.col(f"_tokens_{c}")), c) for c in sources])))
    # Step 3: n-grams, only where both failed: run lengths per word and text, no list of n-grams.
    is_open = F.col("_exact").isNull() & F.col("_perm").isNull() & (F.size("_words") >= 2)
    df = df.withColumn("_low", F.transform("_words", lambda w: F.lower(w)))
    df = df.withColumns({"_repeats": F.when(is_open, _repeats(F.col("_low"))),
                         **{f"_reach_{c}": F.when(is_open, _reach(F.col("_low"), F.lower(_padded(F.col(f"_tokens_{c}"))))) for c in sources}})
    words_left = F.transform("_low", lambda w, i: F.size("_low") - i)
    df = df.withColumns({"_total": _new_ngrams(words_left, F.col("_repeats")),
                         **{f"_found_{c}": _new_ngrams(F.col(f"_reach_{c}"), F.col("_repeats")) for c in sources},
                         # Words of a matched n-gram are tokens of the text, so "all others are" means that all are.
                         **{f"_rest_{c}": F.forall(f"_reach_{c}", lambda r: r > 0) for c in sources}})

    candidates = []
    for i, c in enumerate(sources):
        found = F.col(f"_found_{c}")
        longest = F.least(F.array_max(f"_reach_{c}"), F.size("_low") - 1)
        candidates.append(F.when(found > 0, F.struct(
            (F.when(F.col(f"_rest_{c}"), 1000).otherwise(0) + longest).alias("score"), (found / F.col("_total")).alias("coverage"),
            F.lit(-i).alias("order"), F.lit(c).alias("column"))))
    df = df.withColumns({
        "_best": F.array_max(F.array(*candidates)),
        "_hits": F.coalesce(reduce(lambda a, b: a + b, [F.col(f"_found_{c}") for c in sources]), F.lit(0)),
        "_others": F.coalesce(reduce(lambda a, b: a | b, [F.col(f"_rest_{c}") for c in sources]), F.lit(False))})

    any_hit = F.col("_hits") > 0
    # Without the one-time evaluation a later filter or explode would be pushed down and repeat all of the above.
    result = evaluate_once(
        df,
        match_type=F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_perm").isNotNull(), "permutation")
        .when(any_hit & F.col("_others"), "ngram+non ngram").when(any_hit, "ngram").otherwise("no_match"),
        match_column=F.coalesce("_exact", "_perm", F.col("_best.column")),
        ngram_coverage=F.when(any_hit, F.col("_hits") / F.col("_total")).otherwise(F.lit(0.0)),
        non_ngram_match=F.col("_others"),
        _runs=F.when(any_hit, F.struct(F.col("_low").alias("words"), F.col("_repeats").alias("repeats"), *[F.col(f"_reach_{c}") for c in sources])))
    # The n-grams themselves are written out only if somebody selects them.
    runs = F.col("_runs")
    entries = _ngram_counts(runs["words"], runs["repeats"], [runs[f"_reach_{c}"] for c in sources])
    return result.select(
        *keep, "match_type", "match_column", "ngram_coverage", "non_ngram_match",
        F.map_from_entries(F.when(runs.isNotNull(), entries).otherwise(F.array().cast("array<struct<key:string,value:int>>"))).alias("ngram_match_counts"),
        F.when(runs.isNotNull(), ngrams(runs["words"])).otherwise(F.array().cast("array<string>")).alias("all_ngrams"))


# --- sentence level -----------------------------------------------------------------------------
def in_one_sentence(signal: Column, text: Column) -> Column:
    """All signal words, without punctuation, are tokens of one sentence."""
    wanted = tx.words(tx.drop_punctuation(F.lower(signal)))
    padded = lambda s: F.concat(F.lit(" "), tx.squeeze(tx.drop_punctuation(F.lower(s))), F.lit(" "))
    return tx.let(wanted, lambda words: F.exists(tx.sentences(text), lambda s: tx.let(
        padded(s), lambda p: F.forall(words, lambda w: _has_token_run(p, w)))))


def in_text(signal: Column, text: Column) -> Column:
    """Substring test with punctuation and case removed on both sides."""
    return F.contains(tx.drop_punctuation(F.lower(text)), tx.drop_punctuation(F.lower(signal)))


def _per_model(models: list[str], mode: str, test) -> Column:
    if mode not in ("any", "all"):
        raise ValueError("mode is 'any' or 'all'")
    return reduce((lambda a, b: a | b) if mode == "any" else (lambda a, b: a & b), [test(m) for m in models])


def without_denied_words(df: DataFrame, models: list[str], mode: str = "any", denied: list[str] | None = None) -> DataFrame:
    """Flag ``valid``: the signal of any (or of all) models is free of deny words (substring test)."""
    words = fv.DENIED_SOURCE_WORDS if denied is None else denied
    return df.withColumn("valid", _per_model(models, mode, lambda m: ~tx.contains_any(F.coalesce(F.col(f"signal_{m}"), F.lit("")), words)))


def all_text(sources: tuple[str, ...] = SOURCES) -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in sources])


def within_sentences(df: DataFrame, models: list[str], mode: str = "any", sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Flag ``in_text``: the signal of any (or of all) models fits one sentence of the item."""
    return (df.withColumn("_all", all_text(sources))
              .withColumn("in_text", _per_model(models, mode, lambda m: in_one_sentence(F.col(f"signal_{m}"), F.col("_all")))).drop("_all"))


CURATION_STEPS = ("reparse", "aspects", "denied_words", "sentences")


def curate(df: DataFrame, models: list[str], mode: str = "any", steps: tuple[str, ...] = CURATION_STEPS,
           denied: list[str] | None = None) -> DataFrame:
    """One frame with ``reject_reason``: NULL (kept), 'unparsed', 'denied_words' or 'not_in_sentence'."""
    if "reparse" in steps:
        df = reparse_missing(df, models, drop_empty=False)
        unparsed = reduce(lambda a, b: a | b, [F.col(f"signal_{m}") == "" for m in models])
    else:
        unparsed = F.lit(False)
    if "aspects" in steps and dict(df.dtypes)["aspects"].startswith("map"):
        df = df.withColumn("aspects", drop_aspects_by_substring(F.col("aspects")))
    df = without_denied_words(df, models, mode, denied) if "denied_words" in steps else df.withColumn("valid", F.lit(True))
    text_df = df.withColumn("_aspects", F.to_json("aspects") if dict(df.dtypes)["aspects"].startswith("map") else F.col("aspects"))
    flagged = within_sentences(text_df, models, mode, ("title", "_aspects", "desc")) if "sentences" in steps else \
        text_df.withColumn("in_text", F.lit(True))
    reason = F.when(unparsed, "unparsed").when(~F.col("valid"), "denied_words").when(~F.col("in_text"), "not_in_sentence")
    return evaluate_once(flagged, reject_reason=reason).drop("valid", "in_text", "_aspects")


def align_models(first: DataFrame, second: DataFrame, columns: list[str], key: str = "item_id") -> DataFrame:
    """Add the second model's columns by id.  An id that only one side has fails the query."""
    right = second.select(key, *columns, F.lit(True).alias("_second"))
    both = first.withColumn("_first", F.lit(True)).join(right, key, "full")
    gap = F.raise_error(F.concat(F.lit("only one model has the id "), F.col(key).cast("string")))
    whole = F.coalesce(F.col("_first") & F.col("_second"), F.lit(False))
    return both.filter(F.when(whole, F.lit(True)).otherwise(gap.cast("boolean"))).drop("_first", "_second")


def alignment_gaps(first: DataFrame, second: DataFrame, key: str = "item_id") -> DataFrame:
    """Ids missing on either side, with the side."""
    left = first.join(second.select(key), key, "left_anti").select(key, F.lit("second").alias("missing_in"))
    right = second.join(first.select(key), key, "left_anti").select(key, F.lit("first").alias("missing_in"))
    return left.unionByName(right)
