"""Item selection on small inline tables."""

import pytest
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.operators import items as it
from sigloom.operators.ordering import hash_position, ordered_position, running_total, top_by_rank
from sigloom.plans import selection
from sigloom.plans.selection import SelectionRequest
from sigloom.sources.tables import Tables, run_dates
from tests.conftest import rows

VIEW = "item_id long, soj string, site_id long, leaf_categ_id long, session_start_dt string, exclude long"
TWO = "viwtbidstr=937%2C939"


def views(spark, data):
    return spark.createDataFrame(data, VIEW).withColumn("session_start_dt", F.col("session_start_dt").cast("date"))


def test_vacant_slot_outranks_views(spark):
    day = "2024-05-02"
    df = views(spark, [
        (1, "a=1", 0, 10, day, 0), (1, "a=1", 0, 10, day, 0), (2, "viwtbidstr=", 0, 10, day, 0), (3, "viwtbidstr=937", 0, 10, day, 0),
        (4, TWO, 0, 10, day, 0), (5, TWO, 0, 10, day, 0), (5, TWO, 0, 10, day, 0), (6, TWO, 0, 10, "2024-05-01", 0),
        (7, TWO, 0, 10, "2024-05-03", 0), (8, TWO, 0, 10, day, 1), (9, TWO, 0, 10, day, None), (0, "a=1", 0, 10, day, 0)])
    tables = Tables(spark, {"views": df})
    got = selection.candidates(tables, SelectionRequest(day, day, limit=4, overfetch=1))
    assert rows(got, "item_id", "rank") == [(1, fv.VACANT_RANK), (2, fv.VACANT_RANK), (3, fv.VACANT_RANK), (5, 2)]


def test_two_key_semi_join_and_ledger(spark):
    items = spark.createDataFrame([(1, 10, 0), (2, 11, 0), (3, 10, 1), (4, 99, 0)], "item_id long, leaf_categ_id long, site_id long")
    cats = spark.createDataFrame([(10, 0), (11, 0), (12, 0)], "leaf_categ_id long, site_id long")
    assert rows(it.in_categories(items, cats), "item_id") == [(1,), (2,)]
    ledger = spark.createDataFrame([(1,), (3,)], "item_id long")
    assert rows(it.without_ids(items.limit(3), ledger), "item_id") == [(2,)]


def aspects(spark, data):
    return spark.createDataFrame(data, "item_id long, ns_type_cd string, aspct_src int, prdct_aspct_nm string, aspct_vlu_nm string, n int").select(
        "*", F.date_add(F.lit("2024-05-01").cast("date"), F.col("n")).alias("auct_end_dt")).drop("n")


def test_latest_valid_aspect_wins(spark):
    df = aspects(spark, [
        (1, "df", 0, "Aspect1", "Value0", 1), (1, "df", 0, "aspect1", "value1", 2), (1, "df", 0, "aspect2", "value2", 1),
        (1, "xx", 0, "aspect3", "v", 1), (1, "df", 42, "aspect4", "v", 1), (1, "df", 0, "aspect5", "N/A", 1),
        (1, "df", 0, "aspect6", None, 1), (1, "df", 0, "UPC", "12", 1), (2, "df", 0, "aspect1", "value1", 1)])
    got = {r.item_id: r.aspects for r in it.latest_aspects(df).collect()}
    assert got == {1: {"aspect1": "value1", "aspect2": "value2"}, 2: {"aspect1": "value1"}}


def end_to_end_tables(spark):
    day = "2024-05-02"
    v = views(spark, [(1, "a=1", 0, 10, day, 0), (2, TWO, 0, 10, day, 0), (3, "a=1", 0, 20, day, 0), (4, "a=1", 0, 10, day, 0), (5, "a=1", 0, 30, day, 0)])
    cats = spark.createDataFrame([(10, 10, 0, "Home", 1), (20, 20, 0, "Cars", 1), (30, 30, 0, "Home", 7)],
                                 "leaf_categ_id long, move_to long, site_id long, bsns_vrtcl_name string, categ_lvl3_id long")
    return Tables(spark, {
        "views": v, "categories": cats,
        "listings": spark.createDataFrame([(i, f"title{i}", 0) for i in range(1, 6)], "item_id long, auct_titl string, lstg_status_id int"),
        "descriptions": spark.createDataFrame([(1, "desc1")], "item_id long, item_desc string"),
        "aspects": aspects(spark, [(2, "df", 0, "Color", "Red", 1)]),
        "ledger": spark.createDataFrame([(4, "2024-01-01"), (2, "2022-01-01")], "item_id long, d string").select("item_id", F.col("d").cast("date").alias("session_start_dt"))})


def test_end_to_end_with_files(spark, tmp_path):
    tables = end_to_end_tables(spark)
    req = SelectionRequest("2024-05-02", "2024-05-02", limit=10, verticals=["Home"], excluded_level3=[7], use_ledger=True)
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    got = selection.run(tables, req, out, ledger)
    assert rows(got, "item_id", "title", "desc") == [(1, "title1", "desc1"), (2, "title2", None)]
    assert rows(spark.read.parquet(ledger), "item_id") == [(1,), (2,)]
    with pytest.raises(ValueError, match="not empty"):
        selection.run(tables, req, out)
    report = selection.slot_report(selection.select_items(tables, req)).first()
    assert (report.total, report.vacant, report.non_vacant) == (2, 1, 1)


@pytest.mark.parametrize("k", [1, 5, 37, 60, 500])
def test_large_top_k_equals_small(spark, k):
    df = spark.range(0, 300).select(F.col("id").alias("item_id"), F.when(F.col("id") % 3 == 0, 999).otherwise(F.col("id") % 7).cast("bigint").alias("rank"))
    assert rows(top_by_rank(df, "rank", "item_id", k), "item_id") == rows(df.orderBy(F.col("rank").desc(), "item_id").limit(k), "item_id")


def test_top_k_starts_no_job_while_it_is_built(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("item_id"), (F.col("id") % 5).alias("rank"))
    spark.sparkContext.setJobGroup("building", "")
    plan = top_by_rank(df, "rank", "item_id", 2_000_000_000)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count() == 1000


def test_positions_of_text_keys(spark):
    df = spark.range(0, 500).select("id", F.when(F.col("id") % 4 == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("k"))
    got = ordered_position(df, "k", ["id"], "pos", parts=16).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(500)) and [r.k for r in got] == sorted(r.k for r in got)
    assert ordered_position(df.filter("id < 0"), "k", ["id"]).collect() == []


def test_deny_lists_are_parameters(spark):
    df = aspects(spark, [(1, "df", 0, "UPC", "1", 1), (1, "df", 0, "Colour", "N/A", 1), (1, "df", 42, "Size", "L", 1), (1, "df", 0, "Shop product id (EPID)", "7", 1)])
    names = lambda **kw: {k for r in it.latest_aspects(df, **kw).collect() for k in r.aspects}
    assert names() == {"shop product id (epid)"} and names(marketplace="Shop") == set()
    assert names(denied_names=[], denied_values=[], denied_sources=[]) == {"upc", "colour", "size", "shop product id (epid)"}


def test_positions_with_hot_and_null_keys(spark):
    df = spark.range(0, 2000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"))
    got = [(r.k, r.id) for r in ordered_position(df, "k", ["id"], "pos", parts=16).orderBy("pos").collect()]
    pos = [r.pos for r in ordered_position(df, "k", ["id"], "pos", parts=16).orderBy("pos").collect()]
    assert pos == list(range(2000))
    keys = [(-1 if k is None else k) for k, _ in got]
    assert keys == sorted(keys)
    other = [(r.k, r.id) for r in ordered_position(df, "k", ["id"], "pos", parts=3).orderBy("pos").collect()]
    assert other == got  # the cuts do not change the order


def test_hash_positions_are_dense(spark):
    got = hash_position(spark.range(0, 5000), ["id"], 1, "pos", "n").collect()
    assert sorted(r.pos for r in got) == list(range(5000)) and {r.n for r in got} == {5000}


def test_running_total(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") % 4).alias("v"))
    got = {r.k: r.t for r in running_total(df, "k", "v", "t", parts=8).collect()}
    assert got == {k: sum(i % 4 for i in range(k)) for k in range(100)}


def test_run_dates():
    assert run_dates(run_date="2024-01-01") == ("2024-01-01", "2024-01-01")
    assert run_dates("2024-01-01", "2024-01-02") == ("2024-01-01", "2024-01-02")
    for bad in ({}, {"start": "2024-01-01"}, {"run_date": "x", "start": "y"}):
        with pytest.raises(ValueError):
            run_dates(**bad)


def test_types_from_table_equal_the_list(spark):
    import random

    from sigloom.functions import text as tx
    from sigloom.operators import items as it
    rnd = random.Random(2)
    parts = ["ring", "spring", "gear", "bolt", "s", "red", "nut", "walnuts", "a", "&", "Pipes", "pipe-x"]
    phrase = lambda n: " ".join(rnd.choice(parts) for _ in range(rnd.randint(1, n)))
    titles = [(i, phrase(6).title() if i % 3 else phrase(4)) for i in range(400)] + [(900, ""), (901, None), (902, titles_twice := "Bolts & rings"), (903, titles_twice)]
    df = spark.createDataFrame(titles, "item_id int, title string")
    types = [t for t in dict.fromkeys(phrase(3) for _ in range(60)) if any(w.strip("s") for w in t.split() if w != "&")]
    rnd.shuffle(types)
    table = spark.createDataFrame(list(enumerate(types)), "ord int, type string")
    want = rows(df.filter("title is not null").select("item_id", tx.first_type_in_title(F.col("title"), types).alias("type")))
    got = rows(it.types_from_table(df, table), "item_id", "type")
    assert [r for r in got if r[0] != 901] == want and (901, "unknown") in got
    # a type without words suits every title that no earlier type takes; NULL types none; an empty table none
    extra = table.unionByName(spark.createDataFrame([(10_000, "& s"), (-1, None)], "ord int, type string"))
    with_rest = dict(rows(it.types_from_table(df, extra), "item_id", "type"))
    assert with_rest == {**{i: "& s" if t == "unknown" else t for i, t in want}, 901: "unknown"}
    assert {t for _, t in rows(it.types_from_table(df, table.limit(0)), "item_id", "type")} == {"unknown"}


def test_expressions_do_not_grow_with_types(spark):
    from sigloom.operators import items as it
    df = spark.createDataFrame([(1, "w77x y9999y bolt"), (2, "none")], "item_id int, title string")
    types = spark.range(10_000).select(F.col("id").cast("int").alias("ord"), F.format_string("w%dx y%dys", 76 + F.col("id") % 3, F.col("id")).alias("type"))
    assert rows(it.types_from_table(df, types), "item_id", "type") == [(1, "unknown"), (2, "unknown")]
    more = spark.createDataFrame([(1, "w76x y9999y"), (2, "y9999y w76x"), (3, "w78x y2y w76x y0y")], "item_id int, title string")
    assert rows(it.types_from_table(more, types), "item_id", "type") == [(1, "w76x y9999ys"), (2, "w76x y9999ys"), (3, "w76x y0ys")]


def test_types_that_share_a_long_word_bring_no_title_up(spark, tmp_path):
    from sigloom.operators import items as it
    # stored tables: Spark takes the exploded titles for as small as their file, and must not broadcast them all the same
    spark.range(300).select("id", F.format_string("part%d label#%d", F.col("id") % 20, F.col("id")).alias("title")).write.parquet(str(tmp_path / "titles"))
    spark.range(200).select(F.col("id").alias("ord"), F.format_string("part%ds & Label#%d", F.col("id") % 20, F.col("id")).alias("type")).write.parquet(str(tmp_path / "types"))
    got = it.types_from_table(spark.read.parquet(str(tmp_path / "titles")), spark.read.parquet(str(tmp_path / "types")))
    assert "BuildLeft" not in got._jdf.queryExecution().executedPlan().toString()
    # a type's number may be the beginning of a title's, with equal first words only for the same remainder by 20
    suits = lambda i, t: f"label#{t}" in f"label#{i}" and f"part{t % 20}" in f"part{i % 20}"
    want = {i: next((t for t in range(200) if suits(i, t)), None) for i in range(300)}
    assert {i: t for i, _, t in rows(got, "id", "title", "type")} == {i: "unknown" if t is None else f"part{t % 20}s & Label#{t}" for i, t in want.items()}


def test_first_per_key_states_its_order(spark):
    from sigloom.operators import filters as flt
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, None, 9), (None, "x", 1), (None, "y", 2), (2, "z", None), (1, "a", 5)], "k int, v string, n int")
    assert rows(flt.first_per_key(df, ["k"], ["n"])) == rows(spark.createDataFrame([(1, "a", 5), (None, "x", 1), (2, "z", None)], df.schema))
    assert rows(flt.first_per_key(df, ["k"], [-F.col("n")]), "k", "v") == rows(spark.createDataFrame([(1, None), (None, "y"), (2, "z")], "k int, v string"))
    assert rows(flt.first_per_key(df.limit(0), ["k"], ["n"])) == []
