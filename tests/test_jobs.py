"""Chats, text functions, sinks and export."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from sigloom.operators import chat, infer
from sigloom.plans.export import export_items
from sigloom.sources import export as ex
from sigloom.sources import readers, writers
from sigloom.sources.tables import ANNOTATION_SCHEMA
from tests.conftest import rows


# --- chats ------------------------------------------------------------------------------------
def test_template_and_label_modes(spark):
    df = spark.createDataFrame([(" red ", 2.0), (None, None)], "t string, label double")
    t = chat.Template("{{x}} {0}: {1}", ("t", "label"), label="label")
    assert [r[0] for r in df.select(t.fill("number")).collect()] == ["{x} red: 2", "{x} : "]
    assert [r[0] for r in df.select(t.fill("binary")).collect()] == ["{x} red: 1", "{x} : "]
    with pytest.raises(ValueError):
        t.fill("other")
    with pytest.raises(ValueError, match="unknown prompt"):
        chat.PromptBook({})["x"]


def test_big_group_continues_in_parts(spark):
    df = spark.range(1, 8).select(F.lit(1).alias("item_id"), F.col("id").alias("pos"), F.concat(F.lit("s"), "id").alias("signal"), F.lit(1).alias("label"))
    got = rows(chat.group_signals(df, "pos", label="label", chunk=3), "part", "grouped_signals", "grouped_labels", "num_signals")
    assert got == [(0, "1. s1\n2. s2\n3. s3", "1, 1, 1", 3), (1, "4. s4\n5. s5\n6. s6", "1, 1, 1", 3), (2, "7. s7", "1", 1)]
    single = rows(chat.group_signals(df.filter("pos = 1"), "pos", number_single=False), "grouped_signals")
    assert single == [("s1",)]


def test_one_chat_per_item(spark):
    df = spark.range(0, 1002).select(F.lit(1).alias("item_id"), F.col("id").alias("pos"), F.concat(F.lit("s\n"), "id").alias("signal"))
    row = chat.group_signals(df, "pos").collect()
    assert len(row) == 1 and row[0].num_signals == 1002
    lines = row[0].grouped_signals.split("\n")
    assert (lines[0], lines[-1], len(lines)) == ("1. s 0", "1002. s 1001", 1002)  # positions from 0; a line is a signal


def test_calls_in_batches(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def fn(prompts):
            calls.add(1)
            if "bad" in prompts:
                raise ValueError("no")
            return [p.upper() for p in prompts]
        return fn

    df = spark.createDataFrame([(i, "bad" if i == 7 else f"p{i}") for i in range(40)], "item_id long, p string").coalesce(1)
    got = {r.item_id: (r.result, r.error) for r in infer.run_text_function(df, "p", factory, batch=10, parallel=3, per_minute=60_000, attempts=2).collect()}
    assert got == {i: ("", "no") if i == 7 else (f"P{i}", "") for i in range(40)}
    assert calls.value == 4 + 9 + 2  # four batches, then the failed one prompt by prompt, the bad one twice


def test_resumed_run_asks_only_what_is_missing(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    def factory(broken):
        def make():
            def fn(prompts):
                asked.add(len(prompts))
                if broken and any(p.endswith("3") for p in prompts):
                    raise ValueError("down")
                return [p + "!" for p in prompts]
            return fn
        return make

    df = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "item_id long, p string")
    path = str(tmp_path / "raw")
    first = infer.resumed(df, "p", factory(True), path, batch=1).filter("error <> ''").count()
    before = asked.value
    second = infer.resumed(df, "p", factory(False), path, batch=1)
    assert first == 2 and rows(second, "item_id", "result", "error") == sorted([(i, f"p{i}!", "") for i in range(20)], key=repr)
    assert asked.value - before == 2


# --- text functions -----------------------------------------------------------------------------
def echo():
    def fn(prompts):
        if prompts[0] == "boom":
            raise RuntimeError("no answer")
        return ['{"characteristic": "' + prompts[0] + '", "explanation": "e"}']
    return fn


def test_generation_reports_errors_per_row(spark):
    df = spark.createDataFrame([(1, "soft cup"), (2, "boom"), (3, "red mug")], "item_id int, p string")
    got = infer.generate_signals(df, "p", echo, "m", n=1)
    assert rows(got, "item_id", "signal_m", "explanation_m", "error_m") == [(1, "Soft Cup", "e", ""), (2, "", "", "no answer"), (3, "Red Mug", "e", "")]
    assert infer.run_text_function(df, "p", echo, max_items=2, order="item_id").count() == 2


def test_resume(spark):
    df = spark.range(5).select(F.col("id").alias("item_id"))
    done = spark.createDataFrame([(1,), (3,)], "item_id long")
    left = infer.unfinished(df, done)
    assert rows(left) == [(0,), (2,), (4,)]
    stitched = infer.stitch_runs([done.withColumn("v", F.lit("old")), left.union(done.limit(1)).withColumn("v", F.lit("new"))], "item_id")
    assert stitched.count() == 5 and infer.missing_keys(df, stitched, "item_id").isEmpty()


def test_judge_groups(spark):
    df = spark.createDataFrame([(1, "1. a\n2. b", "p1"), (2, "1. a", "p2")], "item_id int, grouped_signals string, judge_prompt string")
    got = infer.judge_groups(df, "judge_prompt", lambda: lambda ps: ["Labels: 1, 0"])
    assert rows(got, "item_id", "pred_score", "can_explode") == [(1, [1, 0], 1), (2, [1, 0], 0)]
    flat = infer.judge_groups(df, "judge_prompt", lambda: lambda ps: ["?"], grouped=False)
    assert rows(flat, "item_id", "pred_score", "can_explode") == [(1, -1, 0), (2, -1, 0)]


# --- sinks ----------------------------------------------------------------------------------------
def test_require_empty(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.require_empty(spark, path)
    writers.write_items(spark.range(3), path)
    with pytest.raises(ValueError):
        writers.require_empty(spark, path)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):  # not taken for an empty path
        writers.require_empty(spark, str(tmp_path / "broken"))


def test_ledger_is_pruned_and_appended(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ids = spark.range(276374983729, 276374983731).select(F.col("id").alias("item_id"))
    writers.append_ledger(ids, path, "2024-01-01", True)
    writers.append_ledger(ids, path, "2024-01-02", True)
    writers.append_ledger(ids, path, "2024-01-03", False)
    read = readers.read_ledger(spark, path, "2024-01-02")
    assert rows(read, "item_id") == [(276374983729,), (276374983730,)]
    assert "PartitionFilters: [isnotnull(session_start_dt" in read._jdf.queryExecution().executedPlan().toString()


def test_csv_json_and_annotator_files(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b", c', "ann", 1, "r\nr", None)], ANNOTATION_SCHEMA)
    writers.write_csv(df, str(tmp_path / "csv"))
    back = readers.read_csv_with_source(spark, [str(tmp_path / "csv")], ANNOTATION_SCHEMA, multi_line=True)
    assert rows(back.drop("source_file")) == rows(df) and back.first()["source_file"].endswith(".csv")
    writers.write_per_annotator(df, str(tmp_path / "people"))
    assert (tmp_path / "people" / "annotator_name=ann").is_dir()
    with gzip.open(tmp_path / "x.json.gz", "wt") as f:
        f.write('{"id": 1}\n{"id": 2}\n')
    assert rows(readers.read_json_lines(spark, str(tmp_path / "x.json.gz"), "id int")) == [(1,), (2,)]
    (tmp_path / "raw.txt").write_text(json.dumps('a "q"\n{}') + "\n")
    assert rows(readers.read_raw_output(spark, str(tmp_path / "raw.txt"))) == [('a "q"\n{}',)]


# --- export ------------------------------------------------------------------------------------------
def payload(spark, n):
    df = spark.range(n).select(F.col("id").alias("item_id"), F.lit("t").alias("title"), F.create_map(F.lit("k"), F.lit("v")).alias("aspects"), F.lit("d").alias("desc"))
    return ex.payload(df, "P")


@pytest.mark.parametrize("n, sizes", [(600, [300, 300]), (601, [300, 300, 1]), (0, [])])
def test_batches_concatenate_to_the_input(spark, n, sizes):
    got = ex.batches(payload(spark, n)).orderBy("batch_id").collect()
    assert [len(r.records) for r in got] == sizes
    assert [json.loads(x)["itemId"] for r in got for x in r.records] == list(range(n))


def test_features_types(spark):
    df = payload(spark, 1)
    assert df.first()["features"] == '{"k":"v"}'
    with pytest.raises(ValueError, match="unsupported"):
        ex.features_text(spark.range(1), "id")


class Flaky:
    def __init__(self, failures, limit):
        self.failures, self.limit, self.calls = failures, limit, []

    def __call__(self, records):
        self.calls.append(len(records))
        if self.failures:
            self.failures -= 1
            raise ConnectionError("down")
        return ex.Answer(500, "Message Exceeds Maximum size") if len(records) > self.limit else ex.Answer(200)


def test_retry_and_halving():
    waits = []
    sender = Flaky(2, 4)
    assert ex._send(sender, list(range(10)), 10, waits.append) == (9, 3)
    assert sender.calls == [10, 10, 10, 5, 2, 3, 5, 2, 3]
    assert waits == [2.0, 3.0]
    with pytest.raises(ex.SendFailed, match="single record"):
        ex._send(Flaky(0, 0), [1], 10, waits.append)
    with pytest.raises(ConnectionError):
        ex._send(Flaky(99, 9), [1], 3, waits.append)
    with pytest.raises(ex.SendFailed, match="404"):
        ex._send(lambda r: ex.Answer(404), [1], 3, waits.append)


def test_export_job(spark, tmp_path):
    items = spark.range(5).select(F.col("id").alias("item_id"), F.lit("t").alias("title"), F.lit("{}").alias("aspects"), F.lit("d").alias("desc"))
    done = export_items(items, "P", lambda: lambda r: ex.Answer(200), str(tmp_path / "r1"), routing=True, limit=3)
    assert rows(done, "batch_id", "rows", "ok") == [(0, 1, True), (1, 1, True), (2, 1, True)]
    with pytest.raises(RuntimeError, match="1 batches failed"):
        export_items(items, "P", lambda: lambda r: ex.Answer(503), str(tmp_path / "r2"))
    with pytest.raises(ValueError, match="routing"):
        export_items(items, "P", lambda: None, str(tmp_path / "r3"), limit=3)
