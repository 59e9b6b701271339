"""Sample weights and label encoding for the uplift table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.operators.filters import qualified_count
from sigloom.operators.ordering import ordered_position


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL equals NULL, so rows with a missing key are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], how).drop(*[f"_r_{k}" for k in keys])


HOT_CELLS = 10_000  # a (group, class) with more than one row in so many is hot; hence there are fewer hot ones than this


def _with_group_counts(df: DataFrame, group: list[str], cls: str, among: Column | None = None) -> DataFrame:
    """Adds rows per (group, class), rows per group and classes per group, counted ``among`` some rows if given.

    Counts are aggregated first (partial sums on every task).  Hot cells, whose number is bounded whatever the table holds,
    are broadcast to their rows, which stay where they are.  Only rows of the other cells are shuffled to their counts, and
    none of these cells holds more than one row in ``HOT_CELLS``.  No job runs while the plan is built.
    """
    keys = [*group, cls]
    counted = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    cells = df.groupBy(*keys).agg(F.count("*").alias("_rows"), F.nullif(F.count_if(counted), F.lit(0)).alias("_nc"))
    everything = cells.agg(F.struct(F.sum("_nc").alias("n"), F.count("_nc").alias("k"), F.sum("_rows").alias("rows"))).scalar()
    cells = cells.withColumn("_t", everything)
    if group:
        totals = cells.groupBy(*group).agg(F.sum("_nc").alias("_n"), F.count("_nc").alias("_k"))
        cells = _join_null_safe(cells, totals, group)
    else:
        cells = cells.withColumns({"_n": F.col("_t.n"), "_k": F.col("_t.k")})
    is_hot = F.col("_rows") * HOT_CELLS > F.col("_t.rows")
    counts = [*keys, "_nc", "_n", "_k"]
    hot = cells.filter(is_hot).select(*counts, F.lit(True).alias("_hot"))
    marked = _join_null_safe(df, F.broadcast(hot), keys, "left")
    cold_rows = marked.filter(F.col("_hot").isNull()).drop("_hot", "_nc", "_n", "_k")
    cold = _join_null_safe(cold_rows, cells.filter(~is_hot).select(*counts), keys)
    return marked.filter(F.col("_hot")).drop("_hot").unionByName(cold)


def class_share(df: DataFrame, group: list[str], cls: str, out: str = "share", among: Column | None = None) -> DataFrame:
    """p(class | group) on every row."""
    return _with_group_counts(df, group, cls, among).withColumn(out, F.col("_nc") / F.col("_n")).drop("_nc", "_n", "_k")


def balanced_weight(df: DataFrame, group: list[str], cls: str, out: str = "weight", among: Column | None = None) -> DataFrame:
    """n / (classes * rows of the class), inside each group."""
    w = F.col("_n") / (F.col("_k") * F.col("_nc"))
    return _with_group_counts(df, group, cls, among).withColumn(out, w).drop("_nc", "_n", "_k")


def sample_weights(df: DataFrame, method: str, qualified: list[str], shown: str = "shown", conversion: str = "conversion",
                   positive_scale: float = 1.0, not_shown_scale: float = 1.0, non_choiceable_scale: float = 1.0,
                   not_shown: str = fv.NOT_SHOWN, out: str = "weight", among: Column | None = None) -> DataFrame:
    """Methods: per_qualification_set, by_labels, none, only_pos, ivp.  With ``among`` other rows neither count nor get a weight."""
    is_positive = F.col(conversion) == 1
    positive = F.when(is_positive, positive_scale).otherwise(1.0)
    if method == "per_qualification_set":
        df = balanced_weight(df, qualified, shown, "_w", among)
        weight = F.col("_w") * positive * F.when(F.col(shown) == not_shown, not_shown_scale).otherwise(1.0)
    elif method == "by_labels":
        df = balanced_weight(df, [], conversion, "_w", among)
        weight = F.col("_w") * positive
    elif method == "ivp":
        df = class_share(df, qualified, shown, "_w", among)
        weight = 1 / F.col("_w") * positive
    elif method == "none":
        weight = F.lit(1.0)
    elif method == "only_pos":
        weight = F.when(is_positive, positive_scale).otherwise(0.0)
    else:
        raise ValueError(f"unknown weight method: {method}")
    scale = F.when(qualified_count(qualified) <= 1, non_choiceable_scale).otherwise(1.0)
    full = weight * scale
    return df.withColumn(out, full if among is None else F.when(among, full)).drop("_w")


# --- encoding --------------------------------------------------------------------------------
def label_codes(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Distinct labels, sorted, numbered from 0."""
    found = df.filter(F.col(label).isNotNull()).select(label).distinct()
    return ordered_position(found, label, [label], code).select(F.col(code).cast("int").alias(code), label)


def encode_labels(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Rows without a label keep a NULL code."""
    return df.join(label_codes(df, label, code), label, "left")


def decode_labels(df: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    return df.join(codes, code)


def composite_label(shown: str = "shown", conversion: str = "conversion") -> Column:
    return F.concat_ws(",", F.col(shown), F.col(conversion).cast("int").cast("string"))


def constant_conversion(df: DataFrame, name: str = "conversion_1") -> DataFrame:
    return df.withColumn(name, F.lit(True))


def qualified_map(columns: dict[str, str]) -> Column:
    """Signal id -> 0/1 from its indicator column."""
    return F.create_map(*[x for sig, c in columns.items() for x in (F.lit(sig), F.col(c).cast("int"))])


def best_compliant(probabilities: dict[str, Column], qualified: Column, not_shown: str = fv.NOT_SHOWN) -> Column:
    """struct(prob, class): highest probability among qualified classes; the first class wins ties.

    An unqualified class counts as -1000; showing nothing always qualifies.
    """
    options = []
    for i, (cls, p) in enumerate(probabilities.items()):
        allowed = F.lit(True) if cls == not_shown else F.coalesce(F.try_element_at(qualified, F.lit(cls)), F.lit(0)) != 0
        options.append(F.struct(F.when(allowed, p).otherwise(fv.NOT_QUALIFIED_PROBABILITY).alias("prob"),
                                F.lit(-i).alias("order"), F.lit(cls).alias("class")))
    best = F.array_max(F.array(*options))
    return F.struct(best["prob"].alias("prob"), best["class"].alias("class"))


def explode_qualified(df: DataFrame, qualified: Column, no_treatment: bool = False, not_shown: str = fv.NOT_SHOWN) -> DataFrame:
    """One row per qualified signal, optionally one more for showing nothing."""
    signals = F.map_keys(F.map_filter(qualified, lambda k, v: v == 1))
    if no_treatment:
        signals = F.concat(signals, F.array(F.lit(not_shown)))
    return df.withColumn("signal", F.explode(signals))


def epoch_ns_date(ns: Column) -> Column:
    return F.timestamp_micros(F.floor(ns / 1000).cast("bigint")).cast("date")
