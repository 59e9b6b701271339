"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv


def given(values: list | None, default: list) -> list:
    """The caller's list, also an empty one; the default only where none is given."""
    return default if values is None else values


# --- projections ----------------------------------------------------------------------------
def present_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select([c for c in columns if c in df.columns])


def lower_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(c)) for c in columns})


def lower_all_strings(df: DataFrame, keep: Iterable[str] = ("gallery_url",)) -> DataFrame:
    kept = {k.lower() for k in keep}
    text = [f.name for f in df.schema if f.dataType.typeName() == "string" and f.name.lower() not in kept]
    return lower_columns(df, text)


def arrange(df: DataFrame, columns: list[str], constants: dict[str, object] | None = None) -> DataFrame:
    """Add constant columns and force the final order; a missing column is an error."""
    full = df.withColumns({c: F.lit(v) for c, v in (constants or {}).items()})
    missing = [c for c in columns if c not in full.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return full.select(*columns)


def fill_zero(df: DataFrame, categorical: Iterable[str] = ()) -> DataFrame:
    """0 for a missing value in every numeric column that is not categorical."""
    skip = set(categorical)
    numeric = [f.name for f in df.schema if f.name not in skip and
               f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    return df.fillna(0, subset=numeric)


def first_present(*columns: str) -> Column:
    return F.coalesce(*[F.col(c) for c in columns])


# --- filters ----------------------------------------------------------------------------------
def in_date_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Inclusive; the bare column is compared with dates, so the predicate reaches the scan."""
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def countable_views(df: DataFrame) -> DataFrame:
    return df.filter((F.col("item_id") > 0) & F.col("exclude").eqNullSafe(0))


def pick_categories(df: DataFrame, leaf: str = "leaf_categ_id", site_ids: list[int] | None = None,
                    leaf_ids: list[int] | None = None, excluded_leaf_ids: list[int] | None = None,
                    excluded_level2: list[int] | None = None, excluded_level3: list[int] | None = None,
                    meta_ids: list[int] | None = None, verticals: list[str] | None = None) -> DataFrame:
    """Current leaf categories; every argument that is None leaves its rule out."""
    rules = [F.col(leaf) == F.col("move_to")]
    for column, values, wanted in [(leaf, leaf_ids, True), ("site_id", site_ids, True), (leaf, excluded_leaf_ids, False),
                                   ("categ_lvl2_id", excluded_level2, False), ("categ_lvl3_id", excluded_level3, False),
                                   ("meta_categ_id", meta_ids, True), ("bsns_vrtcl_name", verticals, True)]:
        if values is not None:
            rules.append(F.col(column).isin(values) if wanted else ~F.col(column).isin(values))
    return df.filter(reduce(lambda a, b: a & b, rules))


def pick_listings(df: DataFrame, leaf_ids: list[int] | None = None, site_ids: list[int] | None = None,
                  excluded_leaf_ids: list[int] | None = None) -> DataFrame:
    """The category rules that can be applied to listings before any join."""
    if leaf_ids is not None:
        df = df.filter(F.col("leaf_categ_id").isin(leaf_ids))
    if site_ids is not None:
        df = df.filter(F.col("item_site_id").isin(site_ids))
    if excluded_leaf_ids is not None:
        df = df.filter(~F.col("leaf_categ_id").isin(excluded_leaf_ids))
    return df


def live_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("lstg_status_id") == 0)


def valid_aspects(df: DataFrame, denied_names: list[str] | None = None, denied_values: list[str] | None = None,
                  denied_sources: list[int] | None = None, types: list[str] | None = None, marketplace: str | None = None) -> DataFrame:
    """Aspect rows of a wanted type with a usable name, source and value (SQL three-valued logic)."""
    name, value = F.lower(F.col("prdct_aspct_nm")), F.col("aspct_vlu_nm")
    return df.filter(
        F.col("ns_type_cd").isin(given(types, fv.VALID_ASPECT_TYPES))
        & ~name.isin(given(denied_names, fv.denied_aspect_names(marketplace)))
        & ~F.col("aspct_src").isin(given(denied_sources, fv.DENIED_ASPECT_SOURCES))
        & value.isNotNull() & ~F.lower(value).isin(given(denied_values, fv.DENIED_ASPECT_VALUES)))


def has_content(df: DataFrame) -> DataFrame:
    return df.filter(F.col("desc").isNotNull() | F.col("aspects").isNotNull())


def drop_aspects_by_substring(aspects: Column, denied: list[str] | None = None, marketplace: str | None = None) -> Column:
    """Remove entries with a NULL value or whose lower-cased key contains a deny name."""
    from sigloom.functions.text import contains_any
    names = given(denied, fv.denied_aspect_names(marketplace))
    return F.map_filter(aspects, lambda k, v: v.isNotNull() & ~contains_any(k, names))


def drop_aspects_exact(aspects: Column, denied_names: list[str] | None = None,
                       denied_values: list[str] | None = None) -> Column:
    """Remove entries with a NULL value, a denied key or a denied trimmed lower-cased value."""
    names, values = given(denied_names, fv.denied_aspect_names()), given(denied_values, fv.DENIED_ASPECT_VALUES)
    return F.map_filter(aspects, lambda k, v: v.isNotNull() & ~k.isin(names) & ~F.lower(F.trim(v)).isin(values))


def drop_null_aspects(aspects: Column) -> Column:
    return F.map_filter(aspects, lambda k, v: v.isNotNull())


def not_in_categories(df: DataFrame, column: str, excluded: list) -> DataFrame:
    return df.filter(~F.col(column).isin(excluded))


def labelled(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def shown_rows(df: DataFrame, shown: str = "shown", not_shown: str = fv.NOT_SHOWN) -> DataFrame:
    return df.filter(F.col(shown) != not_shown)


def qualified_count(qualified: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in qualified])


def choiceable_rows(df: DataFrame, qualified: list[str]) -> DataFrame:
    return df.filter(qualified_count(qualified) > 1)


def converted_rows(df: DataFrame, conversion: str = "conversion") -> DataFrame:
    return df.filter(F.col(conversion) == 1)


def containing_word(df: DataFrame, column: str, word: str) -> DataFrame:
    return df.filter(F.lower(F.col(column)).contains(word.lower()))


def any_flag(df: DataFrame, flags: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) == 1 for c in flags]))


def within_dates_of(df: DataFrame, column: str, other: DataFrame, other_column: str, inclusive: bool = True) -> DataFrame:
    """Rows inside the other table's date span; the two bounds are scalar subqueries, so nothing is joined."""
    low, high = other.agg(F.min(other_column)).scalar(), other.agg(F.max(other_column)).scalar()
    c = F.col(column)
    return df.filter((c >= low) & (c <= high)) if inclusive else df.filter((c > low) & (c < high))


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Of rows with equal keys the first in the stated order; of ties in it the smallest row.

    A partial aggregate, so a hot key is reduced before the shuffle.  NULL is a key like any other and comes first in an order.
    """
    columns = [c for c in df.columns if c not in keys]
    by = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)], *columns)
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), by).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}").alias(c) if c in columns else F.col(c) for c in df.columns])
