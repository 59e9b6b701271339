"""Registration of queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sigloom.registry.views import Bed, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register ``fn(bed) -> DataFrame`` under ``name``, with DuckDB SQL that must give the same rows."""

    def register(fn: Callable[[Bed], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Bed(spark, sf_dir))
        if check:
            CHECKS[name] = with_views(check)
        return fn

    return register
