"""Queries with check SQL beside DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import duckdb  # noqa: E402
from check import compare  # noqa: E402

from sigloom.llm.registry import CHECKS, QUERIES  # noqa: E402
from tests.llm.util import SF  # noqa: E402


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    _, good, _ = compare(spark, con, name, SF)
    assert good


def test_every_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
