"""Runs that die half-way: what a later run asks or sends again."""

import json
import os
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigloom.functions import text as tx
from sigloom.operators import infer
from sigloom.plans.export import export_items
from sigloom.sources import export as ex
from sigloom.sources.rounds import Pieces, append_in_rounds, open_run, worker_path


def said(folder):
    """Lines that the workers have left in a folder."""
    return [line for name in sorted(os.listdir(folder)) for line in open(os.path.join(folder, name)).read().split()]


def speaker(folder):
    def say(line):
        with open(os.path.join(folder, f"{os.getpid()}"), "a") as f:
            f.write(line + "\n")
    return say


def test_a_dead_worker_loses_one_round_of_answers(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log, path, died = str(tmp_path / "log"), str(tmp_path / "raw"), str(tmp_path / "died")
    say = speaker(log)

    def factory():
        def fn(prompts):
            for p in prompts:
                if p == "p13" and not os.path.exists(died):
                    open(died, "w").close()
                    os._exit(3)
                say(p)
            return [p + "!" for p in prompts]
        return fn

    df = spark.createDataFrame([(i, f"p{i}") for i in range(60)], "item_id long, p string").repartition(4)
    with pytest.raises(Exception):
        infer.resumed(df, "p", factory, path, per_round=10, batch=1)
    kept = {f"p{r.item_id}" for r in spark.read.parquet(path).collect()} if os.path.exists(path) else set()
    first = said(log)
    done = infer.resumed(df, "p", factory, path, per_round=10, batch=1)
    assert sorted(r.item_id for r in done.collect()) == list(range(60)) and done.filter("error <> ''").isEmpty()
    again = said(log)[:]
    for line in first:
        again.remove(line)
    assert sorted(again) == sorted({f"p{i}" for i in range(60)} - kept)  # nothing that was committed is asked again
    lost = set(first) - kept
    assert len(lost) < 30  # a round holds about ten prompts


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_many_rounds_of_answers_are_one_job_whose_tasks_commit(spark, tmp_path):
    path, died = str(tmp_path / "raw"), str(tmp_path / "died")

    def factory():
        def fn(prompts):
            if "p" in prompts[0] and not os.path.exists(died):
                open(died, "w").close()
                os._exit(3)
            return [p + "!" for p in prompts]
        return fn

    ids = lambda low, high: spark.range(low, high, numPartitions=2).select(F.col("id").alias("item_id"), F.col("id").cast("string").alias("p"))
    assert jobs_of(spark, "answers", lambda: infer.resumed(ids(0, 300), "p", factory, path, per_round=4, batch=1)) < 20  # 75 rounds
    assert sorted(map(tuple, infer.resumed(ids(0, 300), "p", factory, path, per_round=4).collect())) == [(i, f"{i}!", "") for i in range(300)]
    # one prompt among 400 ends its worker: what other tasks have answered by then stays
    more = ids(0, 700).withColumn("p", F.when(F.col("item_id") == 650, "p").otherwise(F.col("p")))
    with pytest.raises(Exception):
        infer.resumed(more, "p", factory, path, per_round=4, batch=1)
    assert spark.read.parquet(path).count() > 300
    done = infer.resumed(more, "p", factory, path, per_round=4, batch=1)
    assert done.count() == 700 and done.filter("error <> '' or result is null").isEmpty()


def test_rounds_of_answers_need_no_task_and_file_each(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log, path = str(tmp_path / "log"), str(tmp_path / "raw")

    def factory():
        open(os.path.join(log, os.urandom(8).hex()), "w").close()  # one for each task

        def fn(prompts):
            if any(p.endswith("7") for p in prompts) and len(os.listdir(log)) < 100:
                raise ValueError("refused")
            return [p + "!" for p in prompts]
        return fn

    df = spark.range(2000).select(F.col("id").alias("item_id"), F.col("id").cast("string").alias("p"))
    first = infer.resumed(df, "p", factory, path, per_round=4, batch=2)
    assert sorted(map(tuple, first.collect())) == [(i, *(("", "refused") if i % 10 == 7 else (f"{i}!", ""))) for i in range(2000)]
    tasks = len(os.listdir(log))
    assert tasks <= 4 * 4 and len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= tasks  # 500 rounds in pieces of one row
    assert spark.read.parquet(path).count() == 2000 and [f for f in os.listdir(tmp_path) if f.startswith(".")] == []
    for i in range(100):
        open(os.path.join(log, f"{i}"), "w").close()
    again = infer.resumed(df, "p", factory, path, per_round=4, batch=2)
    assert sorted(map(tuple, again.collect())) == [(i, f"{i}!", "") for i in range(2000)] and spark.read.parquet(path).count() == 2200


def test_pieces_of_a_task(spark, tmp_path):
    folder, schema = str(tmp_path / "t"), pa.schema([("k", pa.int64()), ("v", pa.string())])
    with open_run(folder) as run:
        files = Pieces(folder, run, schema)
        for n in range(40):
            files.put(f"3-0-{n}", pd.DataFrame({"k": [n], "v": [None if n % 2 else "v"]}))
        Pieces(folder, run, schema).put("33-0-0", pd.DataFrame({"k": [99], "v": ["w"]}))
        assert sorted(files.rows("3-*", ["k"])["k"]) == list(range(40)) and files.rows("4-*", ["k"]).empty
        files.merge([f"3-0-{n}" for n in range(40)], "3-0")
        assert len(os.listdir(folder)) == 2 and sorted(files.rows("3-*", ["k"])["k"]) == list(range(40))
        assert files.has("3-0-7", "3-0") and not files.has("4-0-7", "4-0")  # known by the file of the task
        with open_run(folder):  # another run begins: a task that is left over puts nothing more
            with pytest.raises(RuntimeError, match="has ended"):
                files.put("3-0-41", pd.DataFrame({"k": [41], "v": ["v"]}))
    assert sorted(map(tuple, spark.read.parquet(folder).collect())) == [*((n, None if n % 2 else "v") for n in range(40)), (99, "w")]
    keyed = spark.createDataFrame([], "k long, v string").schema
    assert worker_path(spark, f"file://{folder}", keyed) == worker_path(spark, folder, keyed) == folder
    assert worker_path(spark, folder, spark.createDataFrame([], "k array<long>").schema) is None


def test_bounded_tasks_take_turns_over_long_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(infer, "TURN_BYTES", 20_000)
    (tmp_path / "log").mkdir()
    log = str(tmp_path / "log")

    def factory():
        from pyspark import TaskContext
        stage = f"{TaskContext.get().stageId()}-{TaskContext.get().partitionId()}"

        def fn(prompts):
            for p in prompts:
                with open(os.path.join(log, stage), "a") as f:
                    f.write(f"{len(p)}\n")
            return [str(len(p)) for p in prompts]
        return fn

    df = spark.range(2000).select("id", F.repeat(F.lit("x"), (F.col("id") % 200).cast("int")).alias("t"), F.create_map(F.lit("k"), "id").alias("m"))
    got = infer.run_text_function(df, "t", factory, concurrency=2, batch=8)
    assert [(r.id, r.t, r.m, r.result, r.error) for r in got.orderBy("id").collect()] == [(i, "x" * (i % 200), {"k": i}, str(i % 200), "") for i in range(2000)]
    tasks = {name: sum(map(int, open(os.path.join(log, name)))) for name in os.listdir(log)}
    assert sum(tasks.values()) == 10 * sum(range(200)) and max(tasks.values()) < 30_000  # two tasks alone would get 100,000 each
    stages = [name.split("-")[0] for name in tasks]
    assert max(map(stages.count, stages)) <= 2


def payload(spark, n):
    df = spark.range(n).select(F.col("id").alias("item_id"), F.lit("t").alias("title"), F.create_map(F.lit("k"), F.lit("v")).alias("aspects"), F.lit("d").alias("desc"))
    return ex.payload(df, "P")


def test_a_dead_sender_sends_no_earlier_batch_again(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log, died = str(tmp_path / "log"), str(tmp_path / "died")
    say = speaker(log)

    def factory():
        def sender(records):
            first = records[0]["itemId"]
            if first == 40 and not os.path.exists(died):
                open(died, "w").close()
                os._exit(3)
            say(str(first))
            return ex.Answer(200)
        return sender

    batched = ex.batches(payload(spark, 100), size=10)
    with pytest.raises(Exception):
        ex.send_once(batched, factory, str(tmp_path / "ledger"), per_round=1)
    assert said(log) and sorted(map(int, said(log))) == [0, 10, 20, 30]
    result = ex.send_once(batched, factory, str(tmp_path / "ledger"), per_round=1)
    assert sorted(map(int, said(log))) == list(range(0, 100, 10))  # each batch once over both runs
    assert sorted((r.batch_id, r.rows, r.ok) for r in result.collect()) == [(i, 10, True) for i in range(10)]


def test_a_round_of_sends_is_one_job(spark, tmp_path):
    def factory():
        return lambda records: ex.Answer(200 if records[0]["itemId"] % 20 else 503)

    batched, ledger = ex.batches(payload(spark, 400), size=10), str(tmp_path / "ledger")
    batched.write.parquet(str(tmp_path / "batches"))
    batched = spark.read.parquet(str(tmp_path / "batches"))
    sent = lambda: ex.send_once(batched, factory, ledger, per_round=2)
    assert jobs_of(spark, "sends", sent) < 20 + 16  # 20 rounds
    assert [(r.batch_id, r.rows, r.ok, r.error) for r in sent().orderBy("batch_id").collect()] == [
        (i, 10, i % 2 == 1, "" if i % 2 else "status 503") for i in range(40)]
    # two files at most for the two runs of a round: the ledger is a plain Parquet table
    assert len([f for f in os.listdir(ledger) if f.endswith(".parquet")]) == 40 and spark.read.parquet(ledger).count() == 60


def test_small_rounds_of_sends_share_a_job_and_keep_their_order(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log, ledger, died = str(tmp_path / "log"), str(tmp_path / "ledger"), str(tmp_path / "died")
    say = speaker(log)

    def factory():
        def sender(records):
            first = records[0]["itemId"]
            if first == 400 and not os.path.exists(died):
                open(died, "w").close()
                os._exit(3)
            say(str(first // 2))
            return ex.Answer(503 if first % 20 == 0 and not os.path.exists(died) else 200)
        return sender

    batched = ex.batches(payload(spark, 600), size=2)  # 300 batches in 100 rounds
    send = lambda: ex.send_once(batched, factory, ledger, per_round=3)

    def fails():
        with pytest.raises(Exception):
            send()

    assert jobs_of(spark, "small", fails) < 20 + 16
    held = {r.batch_id: r.ok for r in spark.read.parquet(ledger).collect()}
    asked = list(map(int, said(log)))
    assert sorted(held) == list(range(198)) and {i for i, ok in held.items() if not ok} == set(range(0, 198, 10))
    assert [i // 3 for i in asked] == sorted(i // 3 for i in asked) and set(asked) - set(held) <= {198, 199, 200}
    result = send()
    assert [tuple(r) for r in result.orderBy("batch_id").collect()] == [(i, 2, 1, 0, True, "") for i in range(300)]
    again = sorted(map(int, said(log)))
    for i in asked:
        again.remove(i)
    assert again == sorted([*range(0, 198, 10), *range(198, 300)])  # what had failed, and all that the ledger did not hold
    calls = len(said(log))
    assert send().count() == 300 and len(said(log)) == calls
    assert spark.read.parquet(ledger).count() == 198 + len(again)


def test_failed_and_changed_batches_are_sent_again(spark, tmp_path):
    items = lambda n, t: spark.range(n).select(F.col("id").alias("item_id"), F.lit(t).alias("title"), F.lit("{}").alias("aspects"), F.lit("d").alias("desc"))
    path, calls = str(tmp_path / "r"), spark.sparkContext.accumulator(0)

    def factory(status):
        def make():
            def sender(records):
                calls.add(1)
                return ex.Answer(status)
            return sender
        return make

    with pytest.raises(RuntimeError, match="3 batches failed"):
        export_items(items(700, "t"), "P", factory(503), path)
    assert export_items(items(700, "t"), "P", factory(200), path).count() == 3
    before = calls.value
    assert export_items(items(700, "t"), "P", factory(200), path).count() == 3 and calls.value == before
    export_items(items(700, "other"), "P", factory(200), path)
    assert calls.value == before + 3


def test_rounds_keep_every_row(spark, tmp_path):
    df = spark.range(1000).withColumn("text", F.when(F.col("id") % 2 == 0, F.col("id").cast("string")))
    n = append_in_rounds(df, (F.col("id") % 7).cast("int"), lambda rows: rows, str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert n == 7 and out.columns == df.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    assert append_in_rounds(df.filter("id < 0"), F.lit(0), lambda rows: rows, str(tmp_path / "none")) == 0


def test_sums_before(spark):
    rng = random.Random(3)
    lists = [[], [5], *[[rng.randrange(9) for _ in range(n)] for n in (63, 64, 65, 128, 1000)]]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<int>").select("i", tx.sums_before(F.col("v")).alias("s")).collect()
    for r in got:
        assert r.s == [sum(lists[r.i][:k]) for k in range(len(lists[r.i]))]


def test_many_hits_in_one_text(spark):
    n = 100_000
    df = spark.createDataFrame([("ab x" * n, "ab")], "t string, s string")
    spans = df.select(F.inline(tx.highlight_spans(F.col("t"), F.col("s"))))
    assert spans.count() == n and spans.agg(F.sum("start")).first()[0] == sum(4 * i for i in range(n))
    assert json.dumps(spans.orderBy("start").first().asDict()) == '{"start": 0, "token": "ab"}'
