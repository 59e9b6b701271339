"""Export of items in batches to an injected sender."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.operators.ordering import ordered_position
from sigloom.sources.folders import new_folder
from sigloom.sources.rounds import ROUND, Work, commit_in_order, open_run, put_in_order, table_or_empty, worker_path


def features_text(df: DataFrame, column: str) -> Column:
    """Map, list of (name, value) pairs, or text -> one string; NULL stays NULL; other types are an error."""
    kind = dict(df.dtypes)[column]
    if kind.startswith("map"):
        return F.to_json(column)
    if kind.startswith("array<struct<"):
        return F.to_json(F.map_from_entries(column))
    if kind == "string":
        return F.col(column)
    raise ValueError(f"unsupported type for features: {kind}")


def payload(df: DataFrame, processor: str, force: bool = False) -> DataFrame:
    """itemId, title, features, rawDescription, processor and, if asked for, force."""
    columns = [F.col("item_id").cast("bigint").alias("itemId"), "title", features_text(df, "aspects").alias("features"),
               F.col("desc").alias("rawDescription"), F.lit(processor).alias("processor")]
    return df.select(*columns, *([F.lit(True).alias("force")] if force else []))


def batches(df: DataFrame, key: str = "itemId", size: int = fv.EXPORT_BATCH_SIZE) -> DataFrame:
    """batch_id and the JSON records of each batch, ``size`` rows in key order (the last one shorter)."""
    placed = ordered_position(df, key, [key], "_pos")
    record = F.to_json(F.struct(*df.columns))
    return (placed.select(F.floor(F.col("_pos") / size).alias("batch_id"), F.struct("_pos", record.alias("record")).alias("_r"))
                  .groupBy("batch_id").agg(F.array_sort(F.collect_list("_r")).alias("_rs"))
                  .select("batch_id", F.transform("_rs", lambda r: r["record"]).alias("records")))


@dataclass(frozen=True)
class Answer:
    status: int
    text: str = ""


class SendFailed(Exception):
    pass


Sender = Callable[[list[dict]], Answer]
T = TypeVar("T")


def _send(sender: Sender, records: list[dict], attempts: int, pause: Callable[[float], None]) -> tuple[int, int]:
    """Calls and halvings needed; connection errors are retried, a too large message is split in two."""
    for attempt in range(1, attempts + 1):
        try:
            answer = sender(records)
            break
        except ConnectionError:
            if attempt == attempts:
                raise
            pause(max(fv.EXPORT_BACKOFF_MIN_SECONDS, fv.EXPORT_BACKOFF_FACTOR * 2 ** (attempt - 1)))
    if answer.status == 500 and fv.EXPORT_TOO_LARGE_TEXT in answer.text.lower():
        if len(records) <= 1:
            raise SendFailed("a single record is too large")
        middle = len(records) // 2
        left = _send(sender, records[:middle], attempts, pause)
        right = _send(sender, records[middle:], attempts, pause)
        return attempt + left[0] + right[0], 1 + left[1] + right[1]
    if answer.status >= 400:
        raise SendFailed(f"status {answer.status}")
    return attempt, 0


RESULT = "batch_id bigint, rows int, attempts int, splits int, ok boolean, error string"


def _sending(factory: Callable[[], Sender], attempts: int, pause: Callable[[float], None], carry: str | None, parallel: int) -> Work:
    """Result rows of frames of batches; ``parallel`` batches are under way at once, each thread with a sender of its own."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = threading.local()

        def one(batch_id: int, records: list[str]) -> tuple:
            if not hasattr(own, "sender"):
                own.sender = factory()
            rows = [json.loads(r) for r in records]
            try:
                calls, splits = _send(own.sender, rows, attempts, pause)
                return batch_id, len(rows), calls, splits, True, ""
            except Exception as e:  # noqa: BLE001 - reported per batch
                return batch_id, len(rows), 0, 0, False, str(e) or type(e).__name__

        with ThreadPoolExecutor(parallel) as pool:
            for frame in frames:
                at_once = map if parallel == 1 or len(frame) == 1 else pool.map
                done = pd.DataFrame(list(at_once(one, frame["batch_id"], frame["records"])), columns=["batch_id", "rows", "attempts", "splits", "ok", "error"])
                if carry:
                    done.insert(0, carry, list(frame[carry]))
                yield done

    return work


def send(batched: DataFrame, factory: Callable[[], Sender], attempts: int = fv.EXPORT_MAX_ATTEMPTS,
         pause: Callable[[float], None] = time.sleep, tasks: int | None = None, carry: str | None = None,
         parallel: int = 1, sink: Callable[[DataFrame, Work], T] | None = None) -> DataFrame | T:
    """Send every batch; one result row per batch.  ``tasks`` bounds the tasks at work at once; None keeps the table's partitions.

    ``carry`` names a text column that comes back in front of the result.  A task has ``parallel`` batches under way.  ``sink``
    gets the rows and what is to be done with their frames; its answer is then the result.
    The batch id is stable, so a receiver can drop the repeat of a batch whose task ran twice.
    """
    rows = batched if tasks is None else batched.repartition(tasks, "batch_id")
    work = _sending(factory, attempts, pause, carry, parallel)
    return sink(rows, work) if sink else rows.mapInPandas(work, f"{carry} string, {RESULT}" if carry else RESULT)


LEDGER = "digest string, " + RESULT
SMALL_ROUND = 64  # batches that one task sends at once at most


def send_once(batched: DataFrame, factory: Callable[[], Sender], ledger: str, per_round: int = 1000, tasks: int | None = None, **kw) -> DataFrame:
    """Sends what the ledger does not hold as sent; one result row per batch of this table.

    The ledger is a Parquet table under ``ledger``: one row per send, with a digest of the batch's records, so a batch id that
    stands for other records now is sent again.  Batches go in order of their ids, ``per_round`` at a time, and every round
    commits its rows: a run that dies sends at most the batches of one round a second time, with 1 only the one in hand.
    ``tasks`` bounds the senders at work at once; None takes as many as there are cores.  Small rounds go one after another
    through one task whose threads send (each with a sender of its own) where the workers can write the ledger; a round of
    more than ``SMALL_ROUND`` batches is a job by itself.  The batches are computed once and stored.
    """
    spark = batched.sparkSession
    schema = spark.createDataFrame([], LEDGER).schema
    content = F.sha2(F.to_json("records"), 256)
    computed, stored = batched.select("batch_id", "records").withColumn("digest", content), new_folder(spark, "batches")
    computed.write.parquet(stored)
    stamped = spark.read.schema(computed.schema).parquet(stored)
    folder = worker_path(spark, ledger, schema) if per_round <= SMALL_ROUND else None
    number = F.floor(F.col("batch_id") / per_round).cast("bigint")
    at_once = min(per_round, tasks or spark.sparkContext.defaultParallelism)
    bytes_of = F.aggregate("records", F.lit(64).cast("bigint"), lambda n, r: n + F.octet_length(r))
    with open_run(folder) as run:
        known = table_or_empty(spark, ledger, schema).filter("ok").select("batch_id", "digest").distinct()
        todo = stamped.join(known, ["batch_id", "digest"], "left_anti")
        if folder:
            send(todo.withColumn(ROUND, number), factory, carry="digest", parallel=at_once,
                 sink=lambda rows, work: put_in_order(rows, ["batch_id"], work, folder, run, schema, bytes_of), **kw)
        else:
            commit_in_order(todo, number, lambda rows: send(rows.select("batch_id", "records", "digest"), factory, carry="digest", **kw), ledger, at_once)
    wanted = stamped.select("batch_id", "digest")
    names = [f.name for f in schema if f.name not in ("batch_id", "digest")]
    best = (table_or_empty(spark, ledger, schema).join(wanted, ["batch_id", "digest"], "left_semi")
            .groupBy("batch_id").agg(F.min_by(F.struct(*names), F.struct(~F.col("ok"), *names)).alias("_r")))
    return best.select("batch_id", *[F.col(f"_r.{c}").alias(c) for c in names])


def single_records(df: DataFrame, limit: int | None, key: str = "itemId") -> DataFrame:
    """Routing mode: batches of one record, up to a record limit."""
    rows = df if limit is None else df.orderBy(key).limit(limit)
    return batches(rows, key, 1)


def require_routing_for_limit(limit: int | None, routing: bool) -> None:
    if limit is not None and not routing:
        raise ValueError("a record limit needs routing mode")
