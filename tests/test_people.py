"""Samples, splits, weights, agreement."""

import math

import pytest
from pyspark.sql import functions as F

from sigloom.operators import agreement as ag
from sigloom.operators import sampling as sm
from sigloom.operators.ordering import hash_part, hash_position
from sigloom.operators import uplift as up
from sigloom.plans import uplift as uplift_plan
from sigloom.operators import report
from tests.conftest import rows

PEOPLE = ["a", "b", "c", "d"]


def signals(spark, items, per_item):
    return spark.range(items).select(F.col("id").alias("item_id"), F.explode(F.sequence(F.lit(1), F.lit(per_item))).alias("pos"))


def test_partners_get_the_same_rows_and_pairs_are_disjoint(spark):
    got = sm.assign_pairs_by_item(signals(spark, 50, 8), "item_id", ["pos"], 10, PEOPLE).collect()
    of = {p: sorted((r.item_id, r.pos) for r in got if r.annotator_name == p) for p in PEOPLE}
    assert of["a"] == of["b"] and of["c"] == of["d"]
    assert not {i for i, _ in of["a"]} & {i for i, _ in of["c"]}
    assert len(of["a"]) == 50 and {p for _, p in of["a"]} == {1, 2, 3, 4, 5}


def test_too_few_items_shrink_the_parts(spark):
    got = sm.assign_pairs_by_item(signals(spark, 5, 1), "item_id", ["pos"], 10, PEOPLE)
    assert rows(got.groupBy("annotator_name").count()) == [("a", 3), ("b", 3), ("c", 2), ("d", 2)]
    with pytest.raises(ValueError):
        sm.assign_pairs_by_item(signals(spark, 5, 1), "item_id", ["pos"], 10, PEOPLE[:3])


def test_row_pairs(spark):
    got = sm.assign_pairs(signals(spark, 100, 1), ["item_id"], 20, PEOPLE).collect()
    of = {p: {r.item_id for r in got if r.annotator_name == p} for p in PEOPLE}
    assert of["a"] == of["b"] and of["c"] == of["d"] and len(of["a"]) == len(of["c"]) == 20 and not of["a"] & of["c"]


def test_blocks_of_a_short_sample(spark):
    got = sm.assign_blocks(signals(spark, 10, 1), ["item_id"], 16, PEOPLE, second=True)
    assert rows(got.groupBy("annotator_name").count()) == [("a", 4), ("b", 4), ("c", 2)]
    assert got.filter("annotator_name2 is null").count() == 0


def test_no_item_on_both_sides(spark):
    df = signals(spark, 40, 3)
    split = sm.split_by_key(df, "item_id", 0.7)
    assert rows(split.groupBy("role").agg(F.countDistinct("item_id"))) == [("test", 12), ("train", 28)]
    assert split.groupBy("item_id").agg(F.countDistinct("role").alias("n")).filter("n > 1").isEmpty()
    folds = sm.key_folds(df, "item_id", 3)
    assert sorted(r[1] for r in rows(folds.groupBy("test_fold").agg(F.countDistinct("item_id")))) == [13, 13, 14]
    assert folds.count() == 120 and sm.fold_roles(folds, 3).filter("role = 'test'").count() == 120


def test_time_split_with_one_hot_time(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 10).alias("t"))
    split = sm.split_by_time(df, "t", ["id"], 0.45)
    assert split.filter("role = 'train'").count() == 450
    assert split.filter("role = 'train'").agg(F.max("t")).first()[0] <= split.filter("role = 'test'").agg(F.min("t")).first()[0]


def test_weights_keep_null_groups(spark):
    df = spark.createDataFrame([(1, "x", 1), (None, "x", 0), (None, "y", 1), (None, "y", 1)], "q int, shown string, conversion int")
    got = rows(up.balanced_weight(df, ["q"], "shown"), "q", "shown", "weight")
    assert got == sorted([(1, "x", 1.0), (None, "x", 1.5), (None, "y", 0.75), (None, "y", 0.75)], key=repr)
    with pytest.raises(ValueError):
        up.sample_weights(df, "nonsense", ["q"])


def test_best_compliant(spark):
    df = spark.createDataFrame([(0.2, 0.2, 1, 1), (0.9, 0.3, 0, 1), (0.1, 0.2, 0, 0)], "pa double, pb double, qa int, qb int")
    best = up.best_compliant({"a": F.col("pa"), "b": F.col("pb"), "nsh": F.lit(0.01)}, up.qualified_map({"a": "qa", "b": "qb"}))
    assert [tuple(r[0]) for r in df.select(best).collect()] == [(0.2, "a"), (0.3, "b"), (0.01, "nsh")]


def test_uplift_arguments(spark):
    df = spark.createDataFrame([(1, 1, 0, "x", 0)], "event_id int, ts int, conversion int, shown string, q int")
    with pytest.raises(ValueError, match="leaks"):
        uplift_plan.training_table(df, ["q"], negatives_per_positive=0.5)
    with pytest.raises(ValueError, match="exclude"):
        uplift_plan.training_table(df, ["q"], only_converted=True, negatives_per_positive=0.5)


def test_kappa(spark):
    data = [("i", str(n), "a", la, None, None, "f") for n, la in enumerate([0, 1, 1, 2, None, 1])] + \
           [("i", str(n), "b", lb, None, None, "f") for n, lb in enumerate([0, 1, 2, 2, 1, 0])]
    df = spark.createDataFrame(data, "item_id string, signal string, annotator_name string, label int, reason string, comment string, source_file string")
    pairs = spark.createDataFrame([("a", "b"), ("c", "d")], "first_annotator string, second_annotator string")
    got = ag.cohen_kappa(ag.pair_annotations(df, pairs)).collect()
    x, y = [0, 1, 1, 2, 1], [0, 1, 2, 2, 0]
    po = sum(a == b for a, b in zip(x, y)) / 5
    pe = sum(x.count(c) * y.count(c) for c in (0, 1, 2)) / 25
    assert len(got) == 1 and got[0].n == 5 and math.isclose(got[0].kappa, (po - pe) / (1 - pe))


def test_kappa_without_labels_is_null(spark):
    data = [("i", "s", "a", None, None, None, "f"), ("i", "s", "b", 1, None, None, "f")]
    df = spark.createDataFrame(data, "item_id string, signal string, annotator_name string, label int, reason string, comment string, source_file string")
    pairs = spark.createDataFrame([("a", "b")], "first_annotator string, second_annotator string")
    assert rows(ag.cohen_kappa(ag.pair_annotations(df, pairs))) == [("a|b", 0, None)]


def test_auc(spark):
    data = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (1, 0.4), (0, 0.4)]
    wins = sum((p > n) + 0.5 * (p == n) for a, p in data if a for b, n in data if not b)
    got = ag.roc_auc(spark.createDataFrame(data, "y int, s double"), "y", "s").first().auc
    assert math.isclose(got, wins / 9)


def test_frequent_tokens_with_stems(spark):
    df = spark.createDataFrame([(1, "cats run far"), (2, "cat runs"), (3, "cat"), (4, "")], "id int, s string")
    assert rows(report.frequent_tokens(df, "id", "s")) == sorted([(1, "cat", "run", "far"), (2, "cat", "run", None), (3, "cat", None, None), (4, None, None, None)], key=repr)


def test_value_counts_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert rows(report.value_counts(df, "v")) == sorted([("a", 2, 50.0), ("b", 1, 25.0), ("Total Rows", 4, 100.0)], key=repr)


def test_originals_come_as_whole_rows(spark):
    cleaned = spark.createDataFrame([(1, "s", "S", "t", "d")], "item_id long, signal string, signal_orig string, title string, desc string")
    original = spark.createDataFrame([(1, "S", "a", "z"), (1, "S", "b", "y")], "item_id long, signal string, title string, desc string")
    assert rows(sm.restore_originals(cleaned, original, ["signal", "title", "desc"]), "signal", "title", "desc") == [("S", "a", "z")]
    empty = original.limit(1).withColumn("title", F.lit(None).cast("string"))
    assert rows(sm.restore_originals(cleaned, empty, ["signal", "title", "desc"]), "title") == [(None,)]


def test_rows_without_a_label_stay(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id long, label string")
    assert rows(up.encode_labels(df, "label"), "id", "code") == [(1, 1), (2, None), (3, 0)]


def test_predictions_do_not_multiply(spark):
    annotated = spark.createDataFrame([(1, "A b", 1), (1, "a\nb ", 0)], "item_id long, signal string, label int")
    predicted = spark.createDataFrame([(1, "a b", 1), (1, " A B", 0)], "item_id long, signal string, label int")
    assert rows(ag.join_predictions(annotated, predicted), "label", "pred_score") == [(0, 0), (1, 0)]


def test_models_must_have_the_same_ids(spark):
    from sigloom.operators import match
    one = spark.createDataFrame([(1, "x"), (2, "y")], "item_id long, a string")
    two = spark.createDataFrame([(1, "p"), (2, "q")], "item_id long, b string")
    assert rows(match.align_models(one, two, ["b"]), "item_id", "a", "b") == [(1, "x", "p"), (2, "y", "q")]
    with pytest.raises(Exception, match="only one model has the id 2"):
        match.align_models(one, two.filter("item_id = 1"), ["b"]).collect()


def test_annotation_round(spark, tmp_path):
    from sigloom.plans import annotation
    cleaned = signals(spark, 12, 3).select("item_id", F.concat(F.lit("s"), "pos").alias("signal"), F.concat(F.lit("S "), "pos").alias("signal_orig"),
                                           F.lit("t").alias("title"), "pos")
    originals = cleaned.select("item_id", F.col("signal_orig").alias("signal"), F.lit("Title!").alias("title"))
    handed = annotation.hand_out(cleaned, originals, PEOPLE, 3, str(tmp_path / "round"), ["signal", "title"], ["pos"])
    assert rows(handed.groupBy("annotator_name").count()) == [(p, 9) for p in PEOPLE]
    assert rows(handed.select("title", "label").distinct()) == [("Title!", "")]
    filled = handed.withColumn("label", F.when((F.col("annotator_name") == "d") & (F.col("pos") == 1), "0").otherwise("1"))
    pairs = spark.createDataFrame([("a", "b"), ("c", "d")], "first_annotator string, second_annotator string")
    decided = spark.createDataFrame([], "item_id long, signal string, final_label int")
    done = annotation.evaluate_round(filled, pairs, decided, context=("title",))
    assert rows(done.paired.groupBy("annotator_name", "title").count()) == [("a", "Title!", 9), ("c", "Title!", 9)]
    assert rows(done.disagreements, "pair", "kind", "n") == [("c|d", "0|1", 3)] and done.final.count() == 18
    assert {r.pair for r in done.kappa.collect()} == {"a|b", "c|d"}


# --- parts in hash order ----------------------------------------------------------------------
def test_hash_parts_equal_positions(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("text"))
    pos = hash_position(df, ["k"], 7, "pos", "n")
    for cuts in ([0], [1, 1500, 2999], [3000], [10, 20, 4000], []):
        parts = hash_part(df, ["k"], lambda n: F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), "part", 7)  # noqa: B023
        got = {r.k: r.part for r in parts.collect()}
        assert got == {r.k: sum(c <= r.pos for c in cuts) for r in pos.collect()}


def test_splits_move_no_rows_and_keep_repeats_together(spark):
    df = spark.range(0, 400).select((F.col("id") % 100).alias("k"), F.lit("long text").alias("text"))
    split = sm.split_rows(df, ["k"], 0.7)
    assert split.groupBy("k").agg(F.countDistinct("role").alias("n")).filter("n > 1").isEmpty()
    plan = split._jdf.queryExecution().executedPlan().treeString().split("Subquer")[0]
    assert "Exchange" not in plan and "Window" not in plan
    assert sm.split_rows(df, ["k"], 1.0).filter("role = 'test'").isEmpty() and sm.split_rows(df, ["k"], 0.0).filter("role = 'train'").isEmpty()
    assert sm.split_rows(df.limit(0), ["k"], 0.7).count() == 0
    few = sm.key_folds(df.filter("k < 2"), "k", 5)
    assert rows(few.select("k", "test_fold").distinct().select("test_fold")) == [(1,), (2,)]


def test_class_counts_of_hot_and_rare_classes(spark, monkeypatch):
    from collections import Counter

    from sigloom.operators import uplift as up
    monkeypatch.setattr(up, "HOT_CELLS", 20)
    # a third of the rows in one (group, class); NULL keys; classes of a single row; one class in ten is not counted
    df = spark.range(0, 30000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 11 == 0, None).when(F.col("id") % 1000 == 1, F.concat(F.lit("single"), F.col("id"))).otherwise("y").alias("c"))
    for among in (None, F.col("id") % 10 != 0):
        data = [tuple(r) for r in df.collect()]
        counted = [(g, c) for i, g, c in data if among is None or i % 10]
        cells, groups, classes = Counter(counted), Counter(g for g, _ in counted), Counter(g for g, _ in set(counted))
        got = up.balanced_weight(df, ["g"], "c", "w", among)
        want = [(i, groups[g] / (classes[g] * cells[g, c]) if cells[g, c] else None) for i, g, c in data]
        assert rows(got, "id", "w") == sorted(want, key=repr)
        share = rows(up.class_share(df, [], "c", "s", among), "id", "s")
        kinds = Counter(c for _, c in counted)
        assert share == sorted([(i, kinds[c] / len(counted) if kinds[c] else None) for i, _, c in data], key=repr)
    most = got.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
    assert most < 10000  # the hot rows stay in their eight tasks
    assert rows(up.class_share(df.limit(0), ["g"], "c"), "id") == []


def test_funnel_on_write_equals_funnel(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 7 > 0, F.col("id") % 5))
    steps = {"some": F.col("v").isNotNull(), "small": F.col("v") < 3}
    path = str(tmp_path / "kept")
    got = report.funnel_on_write(df, steps, lambda d: d.write.parquet(path))
    assert rows(got) == rows(report.funnel(df, steps)) and spark.read.parquet(path).count() == 1000
    empty = report.funnel_on_write(df.limit(0), steps, lambda d: d.write.mode("overwrite").parquet(path))
    assert rows(empty, "name", "n") == [("small", 0), ("some", 0), ("start", 0)]
