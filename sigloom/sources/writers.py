"""Sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def require_empty(spark: SparkSession, path: str) -> None:
    """Fail if the path already holds rows; a missing path is fine, any other read error is raised."""
    try:
        empty = spark.read.parquet(path).isEmpty()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        empty = True
    if not empty:
        raise ValueError(f"output path {path} is not empty")


def write_items(df: DataFrame, path: str | None, max_records_per_file: int = 1_000_000) -> None:
    """Overwrite as snappy parquet; nothing happens without a path."""
    if path:
        (df.write.mode("overwrite").option("compression", "snappy")
           .option("maxRecordsPerFile", max_records_per_file).parquet(path))


def append_ledger(ids: DataFrame, path: str, run_date: str, enabled: bool) -> None:
    """Append ids under their date partition."""
    if enabled:
        (ids.select("item_id", F.lit(run_date).cast("date").alias("session_start_dt"))
            .write.mode("append").option("compression", "snappy").partitionBy("session_start_dt").parquet(path))


def write_messages(messages: DataFrame, path: str) -> None:
    """One string column of chat JSON as parquet."""
    messages.select("messages").write.mode("overwrite").parquet(path)


def write_folds(folds: DataFrame, path: str) -> None:
    """One folder per fold and role, in one pass over the rows."""
    folds.write.mode("overwrite").partitionBy("fold", "role").option("maxRecordsPerFile", 1_000_000).parquet(path)


def write_per_annotator(df: DataFrame, path: str, column: str = "annotator_name") -> None:
    """One folder per annotator; rows stay spread over tasks, so a big annotator is not one file."""
    df.write.mode("overwrite").partitionBy(column).option("maxRecordsPerFile", 1_000_000).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def fewer_files(df: DataFrame, files: int) -> DataFrame:
    """At most ``files`` output files, without a shuffle."""
    return df.coalesce(files)
