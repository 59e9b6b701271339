"""Prompt filling and chat-format datasets.  Template text is data supplied by the caller."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABEL_MODES = (None, "number", "binary")


@dataclass(frozen=True)
class Template:
    """Text with {0}, {1} ... for the listed columns, trimmed; '{{' and '}}' are literal braces."""

    text: str
    columns: tuple[str, ...]
    label: str | None = None  # the column that holds the label

    def fill(self, mode: str | None = "number") -> Column:
        if mode not in LABEL_MODES:
            raise ValueError(f"mode is one of {LABEL_MODES}")
        parts: list[Column] = []
        used = 0
        for piece in re.split(r"(\{\{|\}\}|\{\d*\})", self.text):
            if piece in ("{{", "}}"):
                parts.append(F.lit(piece[0]))
            elif re.fullmatch(r"\{\d*\}", piece):
                parts.append(self._value(self.columns[int(piece[1:-1]) if piece != "{}" else used], mode))
                used += 1
            elif piece:
                parts.append(F.lit(piece))
        return F.concat(*parts)

    def _value(self, column: str, mode: str | None) -> Column:
        if column == self.label and mode is not None:
            return render_label(F.col(column), mode)
        return F.trim(F.coalesce(F.col(column).cast("string"), F.lit("")))


def render_label(label: Column, mode: str) -> Column:
    number = F.floor(label.cast("double")).cast("int")
    shown = F.when(number != 0, 1).otherwise(0) if mode == "binary" else number
    return F.coalesce(F.when(label.isNotNull(), shown).cast("string"), F.lit(""))


@dataclass(frozen=True)
class Prompt:
    user: Template
    assistant: Template | None = None
    grouped: bool = False


class PromptBook:
    """Named prompts; an unknown name is an error."""

    def __init__(self, prompts: dict[str, Prompt]):
        self.prompts = dict(prompts)

    def __getitem__(self, name: str) -> Prompt:
        if name not in self.prompts:
            raise ValueError(f"unknown prompt {name!r}; known: {', '.join(sorted(self.prompts))}")
        return self.prompts[name]


def numbered_template(n: int, line: str, separator: str = ",\n", start: int = 1) -> str:
    """``line`` repeated with {i} replaced by start .. n."""
    return separator.join(line.replace("{i}", str(i)) for i in range(start, n + 1))


def numbered_lines(values: Column, number_single: bool = True, first: Column | int = 1) -> Column:
    """'1. a\\n2. b'; a single value may stay without a number."""
    text = F.array_join(F.transform(values, lambda v, i: F.concat((i + first).cast("string"), F.lit(". "), v)), "\n")
    return text if number_single else F.when(F.size(values) == 1, F.get(values, F.lit(0))).otherwise(text)


def chat_json(user: Column, assistant: Column) -> Column:
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.to_json(F.array(message("user", user), message("assistant", assistant)))


def group_signals(df: DataFrame, position: str, key: str = "item_id", signal: str = "signal", label: str | None = None,
                  reason: str | None = None, keep: tuple[str, ...] = (), number_single: bool = True,
                  chunk: int | None = None) -> DataFrame:
    """One row per item: numbered signals, labels and reasons as lists in text, and the group size.

    ``position`` orders the signals of an item.  A line break inside a signal becomes a blank, as a line is a signal.
    With ``chunk`` an item with more signals than that continues in further rows (column ``part``) with running numbers.
    """
    part, first_number = [], F.lit(1)
    if chunk is not None:
        number = F.row_number().over(Window.partitionBy(key).orderBy(position))
        df = df.withColumn("part", F.floor((number - 1) / chunk).cast("bigint"))
        part, first_number = ["part"], F.col("part") * chunk + 1
    entry = F.struct(F.col(position).alias("p"), F.col(signal).alias("s"),
                     (F.col(label) if label else F.lit(None)).cast("double").alias("l"),
                     (F.col(reason) if reason else F.lit(None)).cast("string").alias("r"))
    first = [F.min_by(c, position).alias(c) for c in keep]
    grouped = df.groupBy(key, *part).agg(F.array_sort(F.collect_list(entry)).alias("_g"), *first)
    out = [numbered_lines(F.transform("_g", lambda e: F.translate(F.coalesce(e["s"], F.lit("")), "\r\n", "  ")), number_single, first_number).alias("grouped_signals")]
    if label:
        out.append(F.array_join(F.transform("_g", lambda e: F.floor(e["l"]).cast("string")), ", ", "").alias("grouped_labels"))
    if reason:
        out.append(F.array_join(F.transform("_g", lambda e: F.coalesce(e["r"], F.lit(""))), ", ").alias("grouped_reasons"))
    return grouped.select(key, *part, *keep, *out, F.size("_g").alias("num_signals"))


def training_chats(df: DataFrame, prompt: Prompt, mode: str | None = "number", grouping: dict | None = None) -> DataFrame:
    """Column ``messages``: one chat per row, or per item for a grouped prompt (``grouping`` goes to ``group_signals``)."""
    rows = group_signals(df, **(grouping or {})) if prompt.grouped else df
    return rows.select(chat_json(prompt.user.fill(mode), prompt.assistant.fill(mode)).alias("messages"))


def inference_prompts(df: DataFrame, prompt: Prompt, columns: list[str], mode: str | None = "number",
                      out: str = "judge_prompt", grouping: dict | None = None) -> DataFrame:
    rows = group_signals(df, **(grouping or {})) if prompt.grouped else df
    return rows.select(*columns, prompt.user.fill(mode).alias(out))
