"""Annotation, judge datasets and judge evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions import parse as ps
from sigloom.operators import agreement as ag
from sigloom.operators import infer, sampling
from sigloom.operators.chat import Prompt, chat_json, group_signals, inference_prompts, training_chats
from sigloom.operators.filters import labelled


def train_test(df: DataFrame, prompt: Prompt, fraction: float, label: str, row_keys: list[str], key: str = "item_id",
               seed: int = 42, grouping: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Training chats and test prompts; a grouped prompt splits by item, otherwise by row."""
    rows = labelled(df, label)
    split = sampling.split_by_key(rows, key, fraction, seed) if prompt.grouped else sampling.split_rows(rows, row_keys, fraction, seed)
    keep = [key, "grouped_signals"] if prompt.grouped else [key, "signal"]
    return (training_chats(split.filter("role = 'train'"), prompt, grouping=grouping),
            inference_prompts(split.filter("role = 'test'"), prompt, keep, grouping=grouping))


def fold_frame(df: DataFrame, prompt: Prompt, folds: int, label: str, key: str = "item_id", seed: int = 42,
               grouping: dict | None = None) -> DataFrame:
    """All folds in one frame: ``fold``, ``role``, the key, the signal or ``grouped_signals``, ``messages`` and ``judge_prompt``.

    A row, or an item of a grouped prompt, is rendered once and then copied to its folds: as a chat where it trains, as a
    prompt where it tests; the other column is NULL.  Rows without a label are left out.
    """
    options = {"key": key, **(grouping or {})}
    if prompt.grouped and options["key"] != key:
        raise ValueError("a grouped prompt is grouped by the key of its folds")
    rows = sampling.key_folds(labelled(df, label), key, folds, seed)
    if prompt.grouped:
        rows = group_signals(rows, **{**options, "keep": (*options.get("keep", ()), "test_fold")})
    rendered = rows.select(key, "grouped_signals" if prompt.grouped else "signal", "test_fold",
                           chat_json(prompt.user.fill(), prompt.assistant.fill()).alias("messages"), prompt.user.fill().alias("judge_prompt"))
    tests = F.col("role") == "test"
    return sampling.fold_roles(rendered, folds).withColumns({
        "messages": F.when(~tests, F.col("messages")), "judge_prompt": F.when(tests, F.col("judge_prompt"))})


def evaluate_judge(annotated: DataFrame, prompts: DataFrame, factory: Callable[[], infer.TextFunction], label: str = "label") -> DataFrame:
    """Judge grouped prompts, explode the answers, join the annotations and score them."""
    judged = infer.judge_groups(prompts, "judge_prompt", factory)
    judged = judged.withColumn("pred_score", ps.keep_first_label_of_single(F.col("grouped_signals"), F.col("pred_score")))
    judged = judged.withColumn("can_explode", ps.can_explode(F.col("grouped_signals"), F.col("pred_score")))
    return score(annotated, ps.explode_predictions(judged), label)


def train_and_evaluate(labelled_signals: DataFrame, prompt: Prompt, fraction: float, factory: Callable[[], infer.TextFunction], label: str = "label",
                       key: str = "item_id", seed: int = 42, grouping: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Training chats of one part of the items, and the judge's confusion counts, rates and AUC on the others."""
    split = sampling.split_by_key(labelled(labelled_signals, label), key, fraction, seed)
    held = split.filter("role = 'test'").drop("role")
    chats = training_chats(split.filter("role = 'train'"), prompt, grouping=grouping)
    prompts = inference_prompts(held, prompt, [key, "grouped_signals"], grouping=grouping)
    return chats, evaluate_judge(held, prompts, factory, label)


def score(annotated: DataFrame, predictions: DataFrame, label: str = "label") -> DataFrame:
    joined = ag.join_predictions(annotated, predictions)
    # A judge's labels are few, so the area under the curve follows from counts per label.
    return ag.binary_metrics(joined, label, "pred_score").withColumn("auc", ag.roc_auc(joined, label, "pred_score").scalar())


def agreement_report(annotations: DataFrame, pairs: DataFrame) -> DataFrame:
    return ag.cohen_kappa(ag.pair_annotations(annotations, pairs))
