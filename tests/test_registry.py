"""Registered queries against their DuckDB SQL at the smallest scale.

ALL_QUERIES=1 runs every query; the default is one per family.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import duckdb  # noqa: E402
from check import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from sigloom.registry.views import TABLES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
CORE = ["plan_01_item_selection", "plan_02_item_extraction", "plan_04_evaluate", "plan_05_two_model_curation", "plan_06_annotate_and_agree",
        "plan_07_judge_and_score", "plan_08_export", "plan_09_uplift_table", "top_01_overfetch", "agg_11_word_frequency", "str_04_html_text",
        "prs_03_many_signals", "smp_06_pairs_by_item", "spl_04_split_by_time", "cht_05_train_test", "exp_03_batches", "set_03_except_all"]
NAMES = list(entry.queries()) if os.environ.get("ALL_QUERIES") else CORE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    text, good, _ = compare(spark, con, name, FOLDER)
    assert good, text


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    if os.path.isdir(FOLDER):
        assert set(entry.entry(spark).columns) == {"item_id", "title", "aspects", "desc", "rank"}
