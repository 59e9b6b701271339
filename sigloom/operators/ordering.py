"""Row positions, large top-k and one-time evaluation, without a single-task sort.

A position over a whole table is an offset per bucket plus a row number inside the bucket.  Buckets follow
the order, so the result equals one global ``row_number`` while no task sees more than its bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.functions import text as tx

HASH_BUCKETS = 4096  # three hex digits: the slots that a hot value is cut into
SAMPLES_PER_PART = 20


def hash_order(keys: list[str], seed: int = 42) -> Column:
    """Reproducible pseudo-random order: md5 of the keys and a seed."""
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _bucket_of(hash_col: Column, digits: int = 3) -> Column:
    return F.conv(F.substring(hash_col, 1, digits), 16, 10).cast("int")


def _digits(df: DataFrame) -> int:
    """Hex digits of a bucket's prefix: three or more, so that every shuffle partition gets at least four buckets.

    The shuffle partitions are set for the data, so buckets do not grow with it; there are at most 64 a partition.
    """
    digits, wanted = 3, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while 16 ** digits < wanted:
        digits += 1
    return digits


def _offsets(counts: DataFrame, order: list[str]) -> DataFrame:
    """Rows before each bucket.  The window sees one row per bucket: thousands, whatever the data size."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0).cast("bigint")))


def hash_position(df: DataFrame, keys: list[str], seed: int = 42, position: str = "pos", total: str | None = None,
                  first: int | None = None) -> DataFrame:
    """0-based position of every row in hash order.  ``keys`` must identify a row, so no bucket is hot.

    With ``first`` only rows that may be among the first so many are returned.
    """
    hashed = df.withColumn("_h", hash_order(keys, seed)).withColumn("_b", _bucket_of(F.col("_h"), _digits(df)))
    counts = hashed.groupBy("_b").agg(F.count("*").alias("_cnt"))
    offsets = _offsets(counts, ["_b"])
    if total:
        offsets = offsets.withColumn(total, F.sum("_cnt").over(Window.partitionBy(F.lit(0))))
    if first is not None:
        offsets = offsets.filter(F.col("_before") < first)
    local = Window.partitionBy("_b").orderBy("_h", *keys)
    joined = hashed.join(F.broadcast(offsets.drop("_cnt")), "_b")  # one row per bucket, see _digits
    return joined.withColumn(position, F.col("_before") + F.row_number().over(local) - 1).drop("_h", "_b", "_before")


def hash_part(df: DataFrame, keys: list[str], cuts: Callable[[Column], Column], part: str, seed: int = 42, among: DataFrame | None = None) -> DataFrame:
    """Adds the part (from 0) of every row when ``among`` (or ``df``) in hash order is cut before the positions ``cuts(rows)``.

    Only keys are read to find the rows that begin a part, and only the buckets that hold one are ordered; every row is
    then compared with them where it lies.  Rows with equal keys fall into one part.  ``cuts`` gives an array of distinct
    positions; those beyond the last row cut nothing off.
    """
    hashed = (df if among is None else among).select(hash_order(keys, seed).alias("_h"), *keys).withColumn("_b", _bucket_of(F.col("_h"), _digits(df)))
    offsets = _offsets(hashed.groupBy("_b").agg(F.count("*").alias("_cnt")), ["_b"])
    placed = offsets.withColumn("_cuts", cuts(F.sum("_cnt").over(Window.partitionBy(F.lit(0)))))
    inside = F.filter("_cuts", lambda c: (c >= F.col("_before")) & (c < F.col("_before") + F.col("_cnt")))
    holders = placed.select("_b", F.transform(inside, lambda c: c - F.col("_before")).alias("_skip")).filter(F.size("_skip") > 0)
    local = Window.partitionBy("_b").orderBy("_h", *keys)
    numbered = hashed.join(F.broadcast(holders), "_b").withColumn("_at", (F.row_number().over(local) - 1).cast("bigint"))
    first = numbered.filter(F.array_contains("_skip", F.col("_at"))).select(F.struct("_h", *keys).alias("e"))
    edges = first.agg(F.sort_array(F.collect_list("e"))).scalar()
    here = F.struct(hash_order(keys, seed).alias("_h"), *[F.col(k) for k in keys])
    at = tx.let(F.struct(here.alias("here"), F.col("_edges").alias("edges")), lambda v: F.size(F.filter(v["edges"], lambda e: e <= v["here"])))
    return df.withColumn("_edges", edges).withColumn(part, at).drop("_edges")


def first_by_hash(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """The first ``n`` rows in hash order: a reproducible random sample of exactly min(n, rows) rows.

    Only buckets that begin before the cut reach the window: about n rows and one more bucket.
    """
    return hash_position(df, keys, seed, "_pos", first=n).filter(F.col("_pos") < n).drop("_pos")


def _parts(df: DataFrame) -> int:
    """Ranges to cut a table into: they follow the session's shuffle partitions, which are set for the data."""
    return max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _ranges(df: DataFrame, key: Column, ties: list[str], parts: int) -> tuple[Column, Column]:
    """(cuts, hot values): quantiles of a sample of the key as one array each, computed inside the query.

    The sample is the rows with the smallest hash of key and ties.  A value that fills more than one range is hot.
    """
    sample = (df.filter(key.isNotNull()).select(key.alias("k"), F.xxhash64(key, *ties).alias("r"))
                .orderBy("r").limit(SAMPLES_PER_PART * parts).agg(F.array_sort(F.collect_list("k")).alias("ks")))
    place = lambda i: F.element_at("ks", F.ceil(F.size("ks") * i / F.lit(parts)).cast("int"))
    quantiles = F.when(F.size("ks") > 0, F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), place))
    cut = sample.select(F.coalesce(quantiles, F.slice("ks", 1, 0)).alias("q"))
    hot = F.array_distinct(F.filter("q", lambda v, i: (i > 0) & (F.get(F.col("q"), i - 1) == v)))
    return cut.select(F.array_distinct("q")).scalar(), cut.select(hot).scalar()


def _range_of(key: Column, cuts: Column, most: int) -> Column:
    """Number of cuts at or below ``key``, by halving steps over the sorted array."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(cuts)) & (F.get(cuts, at + step - 1) <= key), at + step).otherwise(at))


def ordered_position(df: DataFrame, key: str | Column, ties: list[str], position: str = "pos", parts: int | None = None,
                     first: int | None = None) -> DataFrame:
    """0-based position by (key, md5 of ties, ties), NULL keys first; any orderable key.

    Quantiles of a sample cut the table into ranges; rows of a hot value are cut further by hash, so one value never ends
    in one task.  The result does not depend on where the cuts fall, and no job runs before the query does.  With
    ``first`` only rows that may be among the first so many are returned.
    """
    parts = parts or _parts(df)
    key = F.col(key) if isinstance(key, str) else key
    cuts, hot = _ranges(df, key, ties, parts)
    cut = df.withColumn("_k", key).withColumn("_h", hash_order(ties, 0)).withColumn("_cuts", cuts).withColumn("_hot", hot)
    at = F.when(F.col("_k").isNull(), F.lit(-1)).otherwise(_range_of(F.col("_k"), F.col("_cuts"), parts))
    placed = cut.withColumn("_at", at)
    # A cut is the lower end of its range: where it is hot, its rows come first and are spread by hash.
    is_hot = F.col("_k").isNull() | F.coalesce(F.array_contains("_hot", F.col("_k")), F.lit(False))
    slots = F.lit(parts)
    placed = placed.select(*df.columns, "_k", "_h", (F.col("_at") * 2 + F.when(is_hot, 0).otherwise(1)).alias("_b"),
                           F.when(is_hot, F.floor(_bucket_of(F.col("_h")) * slots / HASH_BUCKETS)).otherwise(F.lit(0)).cast("int").alias("_s"))
    counts = placed.groupBy("_b", "_s").agg(F.count("*").alias("_cnt"))
    offsets = _offsets(counts, ["_b", "_s"]).drop("_cnt")
    if first is not None:
        offsets = offsets.filter(F.col("_before") < first)
    local = Window.partitionBy("_b", "_s").orderBy(F.col("_k").asc_nulls_first(), "_h", *ties)
    # One row per range and slot: at most 2 * parts ranges and, as a hot value fills a range, parts / 2 hot values.
    return (placed.join(F.broadcast(offsets), ["_b", "_s"])
                  .withColumn(position, F.col("_before") + F.row_number().over(local) - 1)
                  .drop("_k", "_h", "_b", "_s", "_before"))


def top_by_rank(df: DataFrame, rank: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows with the highest rank, ties by ascending key, NULL ranks last; one path for every ``k``.

    Meant for narrow rows: join wide columns afterwards.
    """
    order = F.struct(F.col(rank).isNull().alias("none"), (-F.col(rank)).alias("rank"), F.col(key).alias("key"))
    return ordered_position(df, order, [key], "_pos", first=k).filter(F.col("_pos") < k).drop("_pos")


def running_total(df: DataFrame, key: str, value: str, out: str, parts: int | None = None) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller key (keys are distinct), range by range."""
    parts = parts or _parts(df)
    cuts, _ = _ranges(df, F.col(key), [], parts)
    placed = df.withColumn("_cuts", cuts).withColumn("_b", _range_of(F.col(key), F.col("_cuts"), parts)).drop("_cuts")
    sums = placed.groupBy("_b").agg(F.sum(value).alias("_cnt"))
    local = Window.partitionBy("_b").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(F.broadcast(_offsets(sums, ["_b"]).drop("_cnt")), "_b")
                  .withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(local), F.lit(0)))
                  .drop("_b", "_before"))


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a generator, so a later filter on them is not pushed down and run twice."""
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select(*[c for c in df.columns if c not in columns], F.inline(packed).alias(*columns))


def explode_once(df: DataFrame, keep: list[str], array: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per element.  The outer form keeps Spark from inferring a size filter that evaluates ``array`` twice."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(position or "_i", name)).filter(F.col(name).isNotNull())
    return rows if position else rows.drop("_i")


def stored(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    """``df`` written under ``folder`` and reread, so that it is computed once; unchanged without a folder."""
    if folder is None:
        return df
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
