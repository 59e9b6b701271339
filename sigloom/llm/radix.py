"""Exact duplicates by most-significant-digit radix partitioning.

A pass splits every open group by the next bytes of its texts: the group's name is its path, the bytes read so far, so
equality rests on the bytes themselves and no digest takes part.  A group is settled when one row is left in it or when
its texts have ended.  The digit grows from pass to pass (64 bytes, 4 KiB, 256 KiB, ...), so the number of passes is the
logarithm of the longest shared text.  Groups are counted by partial aggregation and the counts joined back, which
splits a hot group over tasks; no group is ever gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import new_path, written

FIRST_DIGIT = 64
GROWTH = 64


def _frame(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Fixed names inside, so that no column of the input can clash: the carried columns travel as one struct."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry if c != text_col]) if [c for c in carry if c != text_col] else F.lit(None).cast("string")
    return docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("body"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                 first: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """Every row with its class of equal texts: id, keep_id, group_size, kept, text_sha256, row (the ``carry`` columns), body.

    The row with the largest id stays.  A null text counts as empty.  A null id is smaller than any other; of rows that
    repeat both id and text exactly one is kept.  ``body`` holds the text if ``text_col`` is carried, else null.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    with_text = text_col in carry
    base = new_path(spark, "radix")
    rows = _frame(docs, id_col, text_col, carry).withColumn("text_sha256", F.sha2(F.coalesce("body", F.lit("")), 256))
    tables, path_bytes = [], first
    while True:
        content = F.coalesce(F.col("body"), F.lit("")).cast("binary")
        placed = (rows.withColumn("path", F.substring(content, 1, path_bytes))
                      .withColumn("ended", F.octet_length(content) <= path_bytes))
        # Written, so that the join deals out both sides itself and can split the rows of a hot group over tasks.
        cells = written(placed.groupBy("path", "ended").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
                              .filter(F.col("n") > 1), "cells")
        found = placed.join(cells.hint("merge"), ["path", "ended"], "left")  # the same plan at every size
        alone = F.col("n").isNull()
        open_ = ~alone & ~F.col("ended")
        body = F.col("body") if with_text else F.when(open_, F.col("body"))
        out = found.select("row", "id", "text_sha256", open_.alias("open"), body.alias("body"),
                           F.when(alone, F.col("id")).otherwise(F.col("top")).alias("keep_id"),
                           F.coalesce("n", F.lit(1)).alias("group_size"))
        path = f"{base}/{len(tables)}"
        out.write.parquet(path)
        table = spark.read.schema(out.schema).parquet(path)
        tables.append(table)
        rows = table.filter("open").select("row", "id", "body", "text_sha256")
        if rows.isEmpty():
            break
        path_bytes *= growth
    settled = reduce(DataFrame.unionByName, [t.filter(~F.col("open")).select(
        "row", "id", "text_sha256", "body", "keep_id", "group_size", _place(t).alias("place")) for t in tables])
    return _one_per_group(settled)


def _place(table: DataFrame) -> Column:
    """Where a row stands in the written table: the same whenever it is read."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def _one_per_group(settled: DataFrame) -> DataFrame:
    """``kept`` for one row of each group, also where id and text repeat."""
    top = F.col("id").eqNullSafe(F.col("keep_id"))
    rivals = settled.filter(top & (F.col("group_size") > 1))
    ties = (rivals.groupBy("keep_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
                  .filter("n > 1").select(F.col("keep_id").alias("k"), F.col("text_sha256").alias("t"), "first"))
    on = F.col("keep_id").eqNullSafe(F.col("k")) & (F.col("text_sha256") == F.col("t"))
    judged = rivals.join(ties, on, "left").withColumn("kept", F.col("first").isNull() | (F.col("place") == F.col("first")))
    rest = settled.filter(~(top & (F.col("group_size") > 1))).withColumn("kept", F.col("group_size") == 1)
    columns = ["id", "keep_id", "group_size", "kept", "text_sha256", "row", "body"]
    return rest.select(columns).unionByName(judged.select(columns))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were."""
    kept = exact_groups(docs, id_col, text_col).filter("kept")
    return kept.select(*[(F.col("body") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
