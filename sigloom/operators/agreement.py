"""Annotator agreement, adjudication and judge metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.operators.ordering import running_total


def pair_annotations(annotations: DataFrame, pairs: DataFrame, keys: tuple[str, ...] = ("item_id", "signal"),
                     values: tuple[str, ...] = ("label", "reason", "comment"), context: tuple[str, ...] = ()) -> DataFrame:
    """Both annotators of a pair side by side for every (item, signal) that both have seen.

    One grouping pivots the long table instead of joining it with itself, so repeated annotations cannot
    multiply: of several rows by one annotator the first by source file, then by label, is taken.  ``context``
    names columns of the item (title, aspects, ...) that are kept; where the rows differ, the smallest set of values.
    """
    roles = (pairs.select(F.col("first_annotator").alias("annotator_name"), F.lit(1).alias("_role"), "first_annotator", "second_annotator")
             .unionByName(pairs.select(F.col("second_annotator").alias("annotator_name"), F.lit(2).alias("_role"),
                                       "first_annotator", "second_annotator")))
    tagged = annotations.join(roles, "annotator_name")
    order = F.struct("source_file", "label") if "source_file" in annotations.columns else F.struct("label")

    def side(role: int) -> Column:
        return F.min_by(F.when(F.col("_role") == role, F.struct(*values)), F.when(F.col("_role") == role, order))

    both = tagged.groupBy(*keys, "first_annotator", "second_annotator").agg(
        side(1).alias("_a"), side(2).alias("_b"), F.count_if(F.col("_role") == 1).alias("_na"), F.count_if(F.col("_role") == 2).alias("_nb"),
        *([F.min(F.struct(*context)).alias("_c")] if context else []))
    return both.filter((F.col("_na") > 0) & (F.col("_nb") > 0)).select(
        *keys, F.col("first_annotator").alias("annotator_name"), *[F.col(f"_a.{v}").alias(v) for v in values],
        F.col("second_annotator").alias("annotator_name_2"), *[F.col(f"_b.{v}").alias(f"{v}_2") for v in values],
        *[F.col(f"_c.{c}").alias(c) for c in context])


def _unordered(a: str, b: str) -> Column:
    return F.array_join(F.array_sort(F.array(F.col(a).cast("string"), F.col(b).cast("string"))), "|", "NULL")


def disagreements(paired: DataFrame, by_pair: bool = False) -> DataFrame:
    """Counts of unordered label pairs that differ, with their share (of the annotator pair when ``by_pair``)."""
    differ = paired.filter(F.col("label") != F.col("label_2")).withColumn("kind", _unordered("label", "label_2"))
    if not by_pair:
        counts = differ.groupBy("kind").agg(F.count("*").alias("n"))
        return counts.withColumn("percent", F.bround(F.col("n") / counts.agg(F.sum("n")).scalar() * 100, 0))
    counts = (differ.withColumn("pair", _unordered("annotator_name", "annotator_name_2"))
                    .groupBy("pair", "kind").agg(F.count("*").alias("n")))
    totals = counts.groupBy("pair").agg(F.sum("n").alias("pair_n"))
    return counts.join(totals, "pair").withColumn("percent", F.bround(F.col("n") / F.col("pair_n") * 100, 1))


def cohen_kappa(paired: DataFrame) -> DataFrame:
    """Kappa per unordered annotator pair from confusion counts; NULL when a pair has no complete labels."""
    keyed = paired.withColumn("pair", _unordered("annotator_name", "annotator_name_2"))
    cells = (keyed.filter(F.col("label").isNotNull() & F.col("label_2").isNotNull())
                  .groupBy("pair", "label", "label_2").agg(F.count("*").alias("n")))
    totals = cells.groupBy("pair").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("label") == F.col("label_2"), F.col("n")).otherwise(0)).alias("same"))
    # Expected agreement: product of both margins per class, from one grouping of the unpivoted cells.
    sides = F.array(F.struct(F.col("label").alias("cls"), F.col("n").alias("left"), F.lit(0).cast("bigint").alias("right")),
                    F.struct(F.col("label_2").alias("cls"), F.lit(0).cast("bigint").alias("left"), F.col("n").alias("right")))
    margins = (cells.select("pair", F.inline(sides).alias("cls", "left", "right")).groupBy("pair", "cls")
                    .agg(F.sum("left").alias("l"), F.sum("right").alias("r")).groupBy("pair")
                    .agg(F.sum(F.col("l").cast("double") * F.col("r")).alias("chance")))
    po, pe = F.col("same") / F.col("n"), F.col("chance") / (F.col("n").cast("double") * F.col("n"))
    scored = totals.join(margins, "pair").select("pair", "n", F.when(pe < 1, (po - pe) / (1 - pe)).alias("kappa"))
    return keyed.select("pair").distinct().join(scored, "pair", "left").select("pair", F.coalesce("n", F.lit(0)).alias("n"), "kappa")


def adjudicate(paired: DataFrame, decided: DataFrame, keys: tuple[str, ...] = ("item_id", "signal")) -> DataFrame:
    """Left join with the adjudication table; final values by priority.

    label: decided, then the first annotator's.  reason and comment: decided final, decided, first, second.
    """
    has = lambda c: c in decided.columns
    d = decided.select(*keys, *[F.col(c).alias(f"_d_{c}") for c in decided.columns if c not in keys])
    joined = paired.join(d, list(keys), "left")

    def final(name: str, *sources: str) -> Column:
        return F.coalesce(*[F.col(c) for c in sources if c in joined.columns]).alias(name)

    rest = [c for c in paired.columns if c not in keys]
    return joined.select(
        *keys, final("final_label", "_d_final_label", "label"),
        final("final_reason", "_d_final_reason", "_d_reason", "reason", "reason_2", "_d_reason_2"),
        final("final_comment", "_d_final_comment", "_d_comment", "comment", "comment_2", "_d_comment_2"), *rest)


def join_predictions(annotated: DataFrame, predictions: DataFrame) -> DataFrame:
    """Inner join on item and signal (lower case, trimmed, line breaks as blanks); the predicted label becomes pred_score.

    Of several predictions for one signal the smallest counts, so repeated signals cannot multiply.
    """
    plain = F.lower(F.trim(F.translate("signal", "\r\n", "  ")))
    right = predictions.groupBy("item_id", plain.alias("_s")).agg(F.min("label").alias("pred_score"))
    return annotated.withColumn("_s", plain).join(right, ["item_id", "_s"]).drop("_s")


def left_join_keep_all(left: DataFrame, right: DataFrame, on: list[str], unique: list[str]) -> DataFrame:
    """Left join, then one row per ``unique`` columns (the smallest of the others)."""
    joined = left.join(right, on, "left")
    others = [c for c in joined.columns if c not in unique]
    return joined.groupBy(*unique).agg(F.min(F.struct(*others)).alias("_o")).select(*unique, *[F.col(f"_o.{c}").alias(c) for c in others])


def compare_runs(first: DataFrame, second: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """1 where both columns are equal in both runs, compared as strings."""
    right = second.select(key, F.col(a).cast("string").alias("_a"), F.col(b).cast("string").alias("_b"))
    same = F.col(a).cast("string").eqNullSafe(F.col("_a")) & F.col(b).cast("string").eqNullSafe(F.col("_b"))
    return first.join(right, key).withColumn("same", same.cast("int")).drop("_a", "_b")


def side_by_side(first: DataFrame, second: DataFrame, key: str, columns: list[str], suffixes: tuple[str, str]) -> DataFrame:
    rename = lambda df, s: df.select(key, *[F.col(c).alias(f"{c}_{s}") for c in columns])
    return rename(first, suffixes[0]).join(rename(second, suffixes[1]), key)


# --- judge metrics -------------------------------------------------------------------------------
def binary_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Confusion counts, precision, recall and F1 with any non-zero label as positive."""
    a, p = F.col(actual) != 0, F.col(predicted) != 0
    counts = df.agg(F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"), F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn"))
    ratio = lambda x, y: F.when(y > 0, x / y)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select("*", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                         ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def roc_auc(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Area under the ROC curve; ties count half.  Works on counts per distinct score."""
    scored = df.filter(F.col(score).isNotNull() & F.col(actual).isNotNull())
    cells = scored.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(actual) != 0).alias("p"), F.count_if(F.col(actual) == 0).alias("q"))
    below = running_total(cells, "s", "q", "q_below")
    won = F.sum(F.col("p") * (F.col("q_below") + F.col("q") / 2))
    total = F.sum("p").cast("double") * F.sum("q")
    return below.agg(F.when(total > 0, won / total).alias("auc"))


def class_distribution(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Share of each class among actual and predicted values (classes present in both)."""
    sides = F.array(F.struct(F.col(actual).cast("string").alias("value"), F.lit(1).alias("a"), F.lit(0).alias("p")),
                    F.struct(F.col(predicted).cast("string").alias("value"), F.lit(0).alias("a"), F.lit(1).alias("p")))
    counts = df.select(F.inline(sides)).filter(F.col("value").isNotNull()).groupBy("value").agg(F.sum("a").alias("a"), F.sum("p").alias("p"))
    totals = counts.agg(F.struct(F.sum("a").alias("a"), F.sum("p").alias("p"))).scalar()
    return (counts.withColumn("_t", totals).filter((F.col("a") > 0) & (F.col("p") > 0))
                  .select("value", (F.col("a") / F.col("_t.a")).alias("actual"), (F.col("p") / F.col("_t.p")).alias("predicted")))

