"""Reproducible samples, annotator assignment and data splits.

Order comes from a hash of the row key and a seed, so every function is deterministic, and positions come
from ``hash_position``, so nothing is sorted in one task.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.operators.filters import arrange
from sigloom.operators.ordering import first_by_hash, hash_part, hash_position, ordered_position

ANNOTATION_COLUMNS = {"label": "", "reason": "", "comment": ""}


# --- samples --------------------------------------------------------------------------------
def sample_keys(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of ``n`` sampled distinct keys."""
    return df.join(first_by_hash(df.select(key).distinct(), [key], n, seed), key, "left_semi")


def _pick(names: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def _positions_of_sample(df: DataFrame, keys: list[str], n: int, seed: int) -> DataFrame:
    """The sampled rows with their 0-based position in hash order."""
    return hash_position(df, keys, seed, "_pos", first=n).filter(F.col("_pos") < n)


def assign_blocks(df: DataFrame, keys: list[str], sample_size: int, annotators: list[str], second: bool = False,
                  seed: int = 42) -> DataFrame:
    """Sample rows and give each annotator one block; the optional second annotator runs backwards.

    Blocks use the requested size: a short sample leaves the last annotators with fewer rows.
    """
    block = ceil(sample_size / len(annotators))
    drawn = _positions_of_sample(df, keys, sample_size, seed)
    out = drawn.withColumn("annotator_name", _pick(annotators, F.floor(F.col("_pos") / block)))
    if second:
        last = drawn.agg(F.max("_pos")).scalar()
        out = out.withColumn("annotator_name2", _pick(annotators, F.floor((last - F.col("_pos")) / block)))
    return out.drop("_pos")


def _pairs(annotators: list[str]) -> list[tuple[str, str]]:
    if len(annotators) % 2:
        raise ValueError("an even number of annotators is needed")
    return list(zip(annotators[::2], annotators[1::2]))


def _to_both(df: DataFrame, annotators: list[str], pair: Column) -> DataFrame:
    """Every row twice, once per partner of its pair."""
    pairs = F.array(*[F.array(F.lit(a), F.lit(c)) for a, c in _pairs(annotators)])
    return df.withColumn("annotator_name", F.explode(F.get(pairs, pair.cast("int"))))


def assign_pairs(df: DataFrame, keys: list[str], per_pair: int, annotators: list[str], seed: int = 42) -> DataFrame:
    """``per_pair`` rows per pair of annotators; both partners get the same rows."""
    drawn = _positions_of_sample(df, keys, per_pair * len(_pairs(annotators)), seed)
    return _to_both(drawn, annotators, F.floor(F.col("_pos") / per_pair)).drop("_pos")


def rows_per_key(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows of each key.  Spark keeps ``n`` per key before the shuffle, so a hot key stays small."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def part_of(position: Column, total: Column, parts: int) -> Column:
    """Index of the part when ``total`` rows are cut into ``parts``, the first parts one longer."""
    size, extra = F.floor(total / parts), total % parts
    long_rows = extra * (size + 1)
    return F.when(position < long_rows, F.floor(position / (size + 1))).otherwise(
        extra + F.floor((position - long_rows) / F.greatest(size, F.lit(1)))).cast("int")


def assign_pairs_by_item(df: DataFrame, key: str, order: list[str], items_per_pair: int, annotators: list[str],
                         rows_per_item: int = 5, seed: int = 42) -> DataFrame:
    """Disjoint items per pair, at most ``rows_per_item`` rows each, both partners alike; fewer items shrink the parts."""
    pairs = len(_pairs(annotators))
    ids = hash_position(first_by_hash(df.select(key).distinct(), [key], items_per_pair * pairs, seed), [key], seed, "_pos", "_n")
    placed = ids.select(key, part_of(F.col("_pos"), F.col("_n"), pairs).alias("_pair"))
    rows = rows_per_key(df.join(placed, key), key, order, rows_per_item)
    return _to_both(rows, annotators, F.col("_pair")).drop("_pair")


def with_annotation_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Empty label, reason and comment, in a fixed column order."""
    return arrange(df, columns, ANNOTATION_COLUMNS)


def restore_originals(sampled: DataFrame, original: DataFrame, columns: list[str], orig_signal: str = "signal_orig",
                      signal: str = "signal", key: str = "item_id") -> DataFrame:
    """Put the original text of the listed columns back; one original per (item, signal), so no row is repeated."""
    others = [c for c in columns if c != signal]
    # The smallest original as a whole row, so that values of different rows never mix; a match may hold NULLs.
    lookup = original.groupBy(key, F.col(signal).alias(orig_signal)).agg(F.min(F.struct(F.lit(1).alias("_hit"), *others)).alias("_o"))
    joined = sampled.join(lookup, [key, orig_signal], "left")
    restored = joined.withColumns({c: F.col(orig_signal) if c == signal else F.when(F.col("_o").isNotNull(), F.col(f"_o.{c}")).otherwise(F.col(c)) for c in columns})
    return restored.select([c for c in sampled.columns if c != orig_signal])


# --- splits ----------------------------------------------------------------------------------
def _role(part: Column) -> Column:
    return F.when(part == 0, "train").otherwise("test")


def split_rows(df: DataFrame, keys: list[str], fraction: float, seed: int = 42, role: str = "role") -> DataFrame:
    """'train' for the first floor(n * fraction) rows in hash order, 'test' for the rest; rows with equal keys stay together."""
    placed = hash_part(df, keys, lambda n: F.array(F.floor(n * fraction)), "_part", seed)
    return placed.withColumn(role, _role(F.col("_part"))).drop("_part")


def split_by_key(df: DataFrame, key: str, fraction: float, seed: int = 42, role: str = "role") -> DataFrame:
    """All rows of a key go to one side; rows without a key count as one key."""
    placed = hash_part(df, [key], lambda n: F.array(F.floor(n * fraction)), "_part", seed, df.select(key).distinct())
    return placed.withColumn(role, _role(F.col("_part"))).drop("_part")


def key_folds(df: DataFrame, key: str, folds: int, seed: int = 42) -> DataFrame:
    """Test fold (1-based) of every row, by key: fold sizes differ by at most one key; rows without a key count as one key."""
    # The first n % folds parts are one longer.
    cuts = lambda n: F.array(*[F.floor(n / folds) * i + F.least(F.lit(i), n % folds) for i in range(1, folds)]).cast("array<bigint>")
    placed = hash_part(df, [key], cuts, "_part", seed, df.select(key).distinct())
    return placed.withColumn("test_fold", F.col("_part") + 1).drop("_part")


def fold_roles(df: DataFrame, folds: int) -> DataFrame:
    """One row per (row, fold) with its role in that fold."""
    return (df.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
              .withColumn("role", F.when(F.col("fold") == F.col("test_fold"), "test").otherwise("train")).drop("test_fold"))


def split_by_time(df: DataFrame, time: str, ties: list[str], fraction: float, role: str = "role") -> DataFrame:
    """'train' for the first floor(n * fraction) rows in time order."""
    placed = ordered_position(df, time, ties, "_pos")
    cut = df.agg(F.floor(F.count("*") * F.lit(fraction))).scalar()
    return placed.withColumn(role, F.when(F.col("_pos") < cut, "train").otherwise("test")).drop("_pos")


def role_dates(df: DataFrame, time: str, role: str = "role") -> DataFrame:
    return df.groupBy(role).agg(F.count("*").alias("n"), F.min(F.to_date(time)).alias("first_day"), F.max(F.to_date(time)).alias("last_day"))


def keep_positives(df: DataFrame, keys: list[str], label: str, negatives_per_positive: float | None, seed: int = 42) -> DataFrame:
    """All positives and ``int(positives * share)`` negatives in hash order; None keeps positives only.

    Negatives with equal keys are kept or dropped together.
    """
    positives = df.filter(F.col(label) == 1)
    if negatives_per_positive is None:
        return positives
    wanted = positives.agg(F.floor(F.count("*") * F.lit(negatives_per_positive))).scalar()
    negatives = df.filter(F.col(label) == 0)
    placed = hash_part(negatives, keys, lambda n: F.array(wanted), "_part", seed)
    return positives.unionByName(placed.filter("_part = 0").drop("_part"))
