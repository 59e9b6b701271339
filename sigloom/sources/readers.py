"""Scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.sources.tables import LEDGER_SCHEMA


def read_ledger(spark: SparkSession, path: str, since: str) -> DataFrame:
    """Explicit schema and a bare filter on the partition column, so old partitions are not listed or read."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).filter(F.col("session_start_dt") >= F.lit(since).cast("date"))


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """``multi_line`` allows line breaks inside quotes, but then a file is one task."""
    return spark.read.csv(paths, schema=schema, header=True, multiLine=multi_line, escape='"')


def read_csv_with_source(spark: SparkSession, paths: list[str], schema: T.StructType, multi_line: bool = False, by_folder: bool = False) -> DataFrame:
    """Many files in one scan, each row tagged with its file name, or with the folder that holds it.

    A source that Spark has written is a folder of part files, whose names it makes up.
    """
    name = F.element_at(F.split("_metadata.file_path", "/"), -2) if by_folder else F.col("_metadata.file_name")
    return read_csv(spark, paths, schema, multi_line).withColumn("source_file", name)


def read_raw_output(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines file with one JSON string per line: the decoded model output."""
    return spark.read.text(path).select(F.from_json(F.concat(F.lit('{"t":'), F.col("value"), F.lit("}")), "t string")["t"].alias("gen_text"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines, plain or gzip (chosen by file extension)."""
    return spark.read.schema(schema).json(path)


def sql_scan(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(query, **frames)

