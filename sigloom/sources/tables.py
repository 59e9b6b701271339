"""Logical table names and explicit schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("session_start_dt", T.DateType())])
ANNOTATION_SCHEMA = T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("signal", T.StringType()),
    T.StructField("annotator_name", T.StringType()), T.StructField("label", T.IntegerType()),
    T.StructField("reason", T.StringType()), T.StructField("comment", T.StringType())])


class Tables:
    """Name -> DataFrame.  A name maps to a DataFrame, a path (parquet) or a catalog table."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame | str]):
        self.spark = spark
        self.sources = dict(sources)

    def __getitem__(self, name: str) -> DataFrame:
        source = self.sources.get(name, name)
        if isinstance(source, DataFrame):
            return source
        return self.spark.read.parquet(source) if "/" in source else self.spark.table(source)


def run_dates(start: str | None = None, end: str | None = None, run_date: str | None = None) -> tuple[str, str]:
    """A run date stands for both ends; otherwise both ends are required."""
    if run_date and start is None and end is None:
        return run_date, run_date
    if start and end:
        return start, end
    raise ValueError("give run_date, or both start and end")
