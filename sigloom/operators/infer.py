"""Running an injected text function over a table.

``fn(list_of_prompts) -> list_of_texts`` is called with many prompts at once on the executors; ``factory`` builds it
once per task, so a client is opened per partition.  Parsing stays in Column expressions.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.functions import parse as ps
from sigloom.sources.folders import new_folder
from sigloom.sources.rounds import Work, append_by_piece, append_by_task, append_in_rounds, by_hash, open_run, table_or_empty, worker_path

TextFunction = Callable[[list[str]], list[str]]
TURN_BYTES = 128 << 20  # text that a task gets at most where their number is bounded


class _Pace:
    """At most ``per_minute`` starts a minute, evenly spaced, over all threads of a task."""

    def __init__(self, per_minute: float | None):
        self.gap, self.next, self.lock = 60 / per_minute if per_minute else 0.0, 0.0, threading.Lock()

    def wait(self) -> None:
        if self.gap:
            with self.lock:
                start = max(self.next, time.monotonic())
                self.next = start + self.gap
            time.sleep(max(0.0, start - time.monotonic()))


def _answers(fn: TextFunction, prompts: list[str], pace: _Pace, attempts: int) -> list[tuple[str, str]]:
    """(text, error) per prompt: one call for all, and where it fails one call for each, tried ``attempts`` times."""
    try:
        pace.wait()
        texts = list(fn(prompts))
        if len(texts) != len(prompts):
            raise ValueError(f"{len(texts)} texts for {len(prompts)} prompts")
        return [(t, "") for t in texts]
    except Exception:  # noqa: BLE001 - found out below, prompt by prompt
        out = []
        for p in prompts:
            answer = ("", "")
            for _ in range(attempts):
                try:
                    pace.wait()
                    answer = (fn([p])[0], "")
                    break
                except Exception as e:  # noqa: BLE001 - reported per row
                    answer = ("", str(e) or type(e).__name__)
            out.append(answer)
        return out


def run_text_function(df: DataFrame, prompt: str, factory: Callable[[], TextFunction], result: str = "result",
                      error: str = "error", concurrency: int | None = None, max_items: int | None = None,
                      order: str | None = None, batch: int = 32, parallel: int = 1, per_minute: float | None = None, attempts: int = 1,
                      sink: Callable[[DataFrame, Work], DataFrame] | None = None) -> DataFrame:
    """Adds ``result`` and ``error`` ('' rather than NULL).  A failing prompt does not fail its batch.

    ``fn`` gets up to ``batch`` prompts a call; a task has ``parallel`` calls in flight (``fn`` must then be thread-safe)
    and starts at most ``per_minute`` of them a minute; a prompt of a failed call is tried alone, ``attempts`` times.
    ``concurrency`` bounds the number of tasks at work.  Where so few would get more than ``TURN_BYTES`` of text each, they
    take turns: the table is then cut, every part is a job that is done at once, and the answers are read back.  ``max_items`` takes the first rows by ``order``, by prompt without one.
    ``sink`` (without ``concurrency``) gets the rows and what is to be done with their frames; its answer is then the result.
    """
    rows = df if max_items is None else df.orderBy(order or prompt).limit(max_items)
    schema = T.StructType([*df.schema.fields, T.StructField(result, T.StringType()), T.StructField(error, T.StringType())])

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn, pace = factory(), _Pace(per_minute)
        with ThreadPoolExecutor(parallel) as pool:
            for frame in frames:
                prompts = list(frame[prompt])
                calls = [prompts[i:i + batch] for i in range(0, len(prompts), batch)]
                answers = [a for group in pool.map(lambda ps: _answers(fn, ps, pace, attempts), calls) for a in group]
                yield frame.assign(**{result: [t for t, _ in answers], error: [e for _, e in answers]})

    if concurrency is None:
        return sink(rows, work) if sink else rows.mapInPandas(work, schema)
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("bigint") for f in df.schema.fields if f.dataType == T.StringType()]
    turns = -(-(rows.agg(F.sum(sum(texts, F.lit(64)))).first()[0] or 0) // (concurrency * TURN_BYTES))
    if turns <= 1:
        return rows.repartition(concurrency).mapInPandas(work, schema)
    path = new_folder(df.sparkSession, "turns")
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(turns)).cast("int")
    append_in_rounds(rows, turn, lambda part: part.repartition(concurrency).mapInPandas(work, schema), path)
    return df.sparkSession.read.schema(schema).parquet(path)


def resumed(df: DataFrame, prompt: str, factory: Callable[[], TextFunction], path: str, key: str = "item_id",
            per_round: int = 100_000, concurrency: int | None = None, **kw) -> DataFrame:
    """Raw answers of all rows, appended under ``path``; all tasks at work hold about ``per_round`` prompts whose answers are not committed.

    A run that dies loses only those: the next run asks what is missing and what had failed.  A task commits piece by piece
    where the workers can write under ``path``, else there are as many tasks as pieces.  ``concurrency`` bounds the tasks at
    work; then a job asks about ``per_round`` prompts and commits them together.
    """
    spark = df.sparkSession
    out = df.select(key, prompt)
    schema = T.StructType([*out.schema.fields, T.StructField("result", T.StringType()), T.StructField("error", T.StringType())])
    folder = worker_path(spark, path, schema) if concurrency is None else None
    with open_run(folder) as run:
        answered = table_or_empty(spark, path, schema).filter("error = ''")
        if folder:
            # Rows are streamed, so tasks need not be small, and nothing is counted before; the join finds its rows dealt by key.
            tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
            run_text_function(unfinished(out.repartition(tasks, key), answered, key), prompt, factory,
                              sink=lambda rows, work: append_by_piece(rows, per_round, work, folder, run, schema, key), **kw).collect()
        elif concurrency is None:
            append_by_task(unfinished(out, answered, key), per_round, lambda rows: run_text_function(rows, prompt, factory, **kw), path)
        else:
            todo = unfinished(out, answered, key)
            append_in_rounds(todo, by_hash(todo, [key], per_round), lambda rows: run_text_function(rows, prompt, factory, concurrency=concurrency, **kw), path)
    answers = table_or_empty(spark, path, schema)
    return answers.groupBy(key).agg(F.min_by(F.struct("result", "error"), F.struct(F.col("error") != "", "result")).alias("_a")).select(key, "_a.result", "_a.error")


def generate_signals(df: DataFrame, prompt: str, factory: Callable[[], TextFunction], model: str, n: int = 5, **kw) -> DataFrame:
    """Raw output beside parsed signals: text_{model}, signal_{model}[_i], explanation_{model}[_i]."""
    return parsed_signals(run_text_function(df, prompt, factory, result=f"text_{model}", error=f"error_{model}", **kw), model, n)


def parsed_signals(raw: DataFrame, model: str, n: int = 5) -> DataFrame:
    """Adds the signals and explanations found in text_{model}."""
    parsed = raw.withColumn("_s", ps.signal_list(ps.first_dict(F.col(f"text_{model}")), n))
    if n == 1:
        first = F.get(F.col("_s"), F.lit(0))
        return parsed.withColumns({f"signal_{model}": first["signal"], f"explanation_{model}": first["explanation"]}).drop("_s")
    return ps.wide_signals(parsed, "_s", f"signal_{model}", f"explanation_{model}", n).drop("_s")


def judge_rows(df: DataFrame, prompt: str, factory: Callable[[], TextFunction], model: str, **kw) -> DataFrame:
    """Judge answers in JSON: label_{model}, reason_{model}, explanation_{model}."""
    raw = run_text_function(df, prompt, factory, result="_text", error="_error", **kw).withColumn("_j", ps.judge_json(F.col("_text")))
    return raw.select(*df.columns, F.col("_text").alias("raw_answer"), F.col("_j.signal_label").alias(f"label_{model}"),
                      F.col("_j.reason").alias(f"reason_{model}"), F.col("_j.explanation").alias(f"explanation_{model}"))


def judge_groups(df: DataFrame, prompt: str, factory: Callable[[], TextFunction], grouped: bool = True, last: bool = False, **kw) -> DataFrame:
    """Judge answers as 'Labels: ...': pred_score and can_explode."""
    raw = run_text_function(df, prompt, factory, result="_text", error="_error", **kw)
    labels = ps.label_list(F.col("_text"), last)
    if not grouped:
        return raw.withColumns({"pred_score": ps.first_label(labels), "can_explode": F.lit(0)}).drop("_text", "_error")
    scored = raw.withColumn("pred_score", labels)
    return scored.withColumn("can_explode", ps.can_explode(F.col("grouped_signals"), F.col("pred_score"))).drop("_text", "_error")


def unfinished(df: DataFrame, done: DataFrame, key: str = "item_id") -> DataFrame:
    """Rows a crashed run still has to process."""
    return df.join(done.select(key), key, "left_anti")


def stitch_runs(runs: list[DataFrame], key: str) -> DataFrame:
    """Rows of several partial runs; of a repeated key the later run wins."""
    tagged = [r.withColumn("_run", F.lit(i)) for i, r in enumerate(runs)]
    both = tagged[0]
    for r in tagged[1:]:
        both = both.unionByName(r)
    columns = [c for c in runs[0].columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct("_run", *columns)).alias("_r")).select(
        key, *[F.col(f"_r.{c}").alias(c) for c in columns])


def missing_keys(expected: DataFrame, stitched: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(stitched.select(key), key, "left_anti")
