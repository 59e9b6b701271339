"""Item-level operators: viewed items, categories, ledger, aspects, descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions.text import blob_ids, words
from sigloom.operators.filters import countable_views, in_date_range, valid_aspects
from sigloom.operators.ordering import explode_once


# --- viewed items ---------------------------------------------------------------------------
def shown_count(blob: Column, key: str = fv.SHOWN_SIGNALS_KEY) -> Column:
    """Number of shown signals; -1 where the key is missing."""
    return F.coalesce(F.size(blob_ids(blob, key)), F.lit(-1))


def relevant_views(views: DataFrame, start: str, end: str) -> DataFrame:
    kept = countable_views(in_date_range(views, "session_start_dt", start, end))
    return kept.select("item_id", "site_id", "leaf_categ_id", "session_start_dt", shown_count(F.col("soj")).alias("shown"))


def views_per_item(views: DataFrame) -> DataFrame:
    """Per item: site and leaf of the latest view, smallest shown count, number of views.

    All four are partial aggregates, so a very popular item is reduced before the shuffle.
    """
    latest = F.max(F.struct("session_start_dt", "site_id", "leaf_categ_id"))
    return (views.groupBy("item_id").agg(latest.alias("_l"), F.min("shown").alias("min_shown"), F.count("*").alias("views"))
                 .select("item_id", F.col("_l.site_id").alias("site_id"), F.col("_l.leaf_categ_id").alias("leaf_categ_id"),
                         "min_shown", "views"))


def with_rank(items: DataFrame) -> DataFrame:
    """A vacant slot outranks every view count."""
    rank = F.when(F.col("min_shown") < 2, F.lit(fv.VACANT_RANK).cast("bigint")).otherwise(F.col("views"))
    return items.withColumn("rank", rank)


# --- semi and anti joins ------------------------------------------------------------------------
def in_categories(items: DataFrame, categories: DataFrame) -> DataFrame:
    """Left-semi on (leaf, site).  No hint: Spark broadcasts the categories only when their size allows it."""
    return items.join(categories.select("leaf_categ_id", "site_id"), ["leaf_categ_id", "site_id"], "left_semi")


def with_ids(df: DataFrame, ids: DataFrame, key: str = "item_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def without_ids(df: DataFrame, ids: DataFrame, key: str = "item_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def recent_ledger(ledger: DataFrame, start: str, days: int = fv.LEDGER_DAYS) -> DataFrame:
    """Ledger rows of the last ``days`` days before ``start``: a constant bound, so partitions are pruned."""
    return ledger.filter(F.col("session_start_dt") >= F.date_sub(F.lit(start).cast("date"), days))


# --- aspects --------------------------------------------------------------------------------------
def aspects_map(pairs: DataFrame, keys: list[str], name: str, value: str, out: str = "aspects") -> DataFrame:
    """One map per group from rows that are unique per (group, name)."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(name).alias("key"), F.col(value).alias("value"))))
    return pairs.groupBy(*keys).agg(F.map_from_entries(entries).alias(out))


def latest_aspects(aspects: DataFrame, order: tuple[str, ...] = ("auct_end_dt",), **denied) -> DataFrame:
    """Valid aspects per item, lower-cased; the last of duplicate names wins by ``order``, then by value.

    ``denied`` goes to ``valid_aspects``.
    """
    name, value = F.lower(F.col("prdct_aspct_nm")), F.lower(F.col("aspct_vlu_nm"))
    rows = valid_aspects(aspects, **denied).select("item_id", name.alias("name"), value.alias("value"), *order)
    unique = rows.groupBy("item_id", "name").agg(F.max_by("value", F.struct(*order, "value")).alias("value"))
    return aspects_map(unique, ["item_id"], "name", "value")


def shortest_aspects(aspects: DataFrame, keys: list[str]) -> DataFrame:
    """Per (item, name): the shortest value, ties by value."""
    value = F.col("aspct_vlu_nm")
    return aspects.groupBy(*keys, "prdct_aspct_nm").agg(F.min_by(value, F.struct(F.length(value), value)).alias("aspct_vlu_nm"))


def shortest_aspects_ranked(aspects: DataFrame, keys: list[str]) -> DataFrame:
    """As ``shortest_aspects`` but keeps whole rows: row number 1, which Spark limits before the shuffle too."""
    w = Window.partitionBy(*keys, "prdct_aspct_nm").orderBy(F.length("aspct_vlu_nm"), "aspct_vlu_nm")
    return aspects.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_aspects(aspects: DataFrame, keys: list[str], order: str = "auct_end_dt") -> DataFrame:
    """Per (item, name): the first value by ``order``, then by value."""
    return aspects.groupBy(*keys, "prdct_aspct_nm").agg(
        F.min_by("aspct_vlu_nm", F.struct(order, "aspct_vlu_nm")).alias("aspct_vlu_nm"))


def merge_maps(df: DataFrame, keys: list[str], maps: str, order: str, out: str) -> DataFrame:
    """Combine the maps of a group; a later map (by ``order``) wins on a shared key."""
    entries = df.select(*keys, order, F.explode(maps).alias("_k", "_v"))
    unique = entries.groupBy(*keys, "_k").agg(F.max_by("_v", F.struct(order, "_v")).alias("_v"))
    return aspects_map(unique, keys, "_k", "_v", out)


# --- assembling -----------------------------------------------------------------------------------
def assemble(items: DataFrame, aspects: DataFrame, descriptions: DataFrame) -> DataFrame:
    return items.join(aspects, "item_id", "left").join(descriptions, "item_id", "left")


def join_categories(listings: DataFrame, categories: DataFrame, restrict: bool) -> DataFrame:
    """Category columns for listings: inner when a category filter is given, left otherwise."""
    cats = categories.select(F.col("leaf_categ_id"), F.col("site_id").alias("item_site_id"),
                             *[c for c in ("bsns_vrtcl_name", "meta_categ_id", "categ_lvl2_id", "categ_lvl3_id")
                               if c in categories.columns])
    return listings.join(cats, ["leaf_categ_id", "item_site_id"], "inner" if restrict else "left")


def aspects_of_listings(aspects: DataFrame, listings: DataFrame) -> DataFrame:
    """Equi-join on (item, end date) against de-duplicated listings."""
    keys = ["item_id", "auct_end_dt"]
    return aspects.join(listings.dropDuplicates(keys), keys)


def attach(df: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of a few columns by id."""
    return df.join(other.select(key, *columns), key, "left")


def category_names(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Distinct (site, leaf) pairs with their current category names."""
    keys = ["site_id", "leaf_categ_id"]
    latest = categories.filter(F.col("leaf_categ_id") == F.col("move_to"))
    names = latest.groupBy(*keys).agg(F.min("bsns_vrtcl_name").alias("bsns_vrtcl_name"))
    return df.select(*keys).distinct().join(names, keys)


def items_with_tips(items: DataFrame, tips: DataFrame, descriptions: DataFrame, limit: int | None = 100) -> DataFrame:
    """Typed items with the tips of their type and their description ('' when absent)."""
    desc = descriptions.select("item_id", "desc")
    joined = (items.join(tips, "type").join(desc, "item_id", "left")
                   .withColumn("desc", F.coalesce(F.col("desc"), F.lit(""))))
    return joined if limit is None else joined.orderBy("tip_order", "item_id").limit(limit)


ANCHOR = 4  # letters of a type's word by which titles look it up


def types_from_table(df: DataFrame, types: DataFrame, title: str = "title", out: str = "type", name: str = "type", order: str = "ord",
                     default: str = "unknown") -> DataFrame:
    """First type of a table whose words, singularised and without '&', all occur in the title; ties go to the smaller name.

    Gives what ``text.first_type_in_title`` gives for a list, but no expression grows with the number of types.  Every type
    stands in an index under the letter group of its words that the fewest types share, so that a word common to all types
    brings none of them up.  A title is looked up by the letter groups it holds, the few types found are tested in full, and
    only titles and hits are shuffled.  A type without words suits every title, a NULL title none.
    """
    singular = lambda w: F.when(w.endswith("s"), F.substr(w, F.lit(1), F.length(w) - 1)).otherwise(w)
    parts = F.filter(F.transform(F.filter(words(F.lower(F.col(name))), lambda w: w != "&"), singular), lambda w: w != "")
    table = types.select(F.struct(F.col(order).alias("ord"), F.col(name).alias("type")).alias("_entry"), parts.alias("_parts"))
    starts = lambda text, n: F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    windows = lambda text, n: F.transform(starts(text, n), lambda i: F.substr(text, i, n))
    stems = explode_once(table, ["_entry", "_parts"], F.array_distinct(F.flatten(F.transform("_parts", lambda w: windows(w, F.lit(ANCHOR))))), "_group")
    shared = stems.groupBy("_group").agg(F.count("*").alias("_n"))
    rarest = F.min_by(F.struct("_group", "_parts"), F.struct("_n", -F.length("_group"), "_group"))
    index = stems.join(shared, "_group", "left").groupBy("_entry").agg(rarest.alias("_r")).select("_entry", "_r._group", "_r._parts")
    lengths = index.agg(F.collect_set(F.length("_group"))).scalar()  # at most ANCHOR numbers
    wordless = table.filter(F.size("_parts") == 0).agg(F.min("_entry")).scalar()

    low = F.lower("_title")
    groups = F.array_distinct(F.flatten(F.transform("_lengths", lambda n: windows(low, n))))
    # Each title once; the shuffle also deals a table that lies in a few files over all tasks.
    titles = df.select(F.col(title).alias("_title")).filter(F.col("_title").isNotNull()).distinct().withColumn("_lengths", lengths)
    # Spark takes the exploded titles for as small as the table they come from.  An outer join never broadcasts its own side,
    # so only an index that is small goes to every task; the filter drops what found nothing.
    found = explode_once(titles, ["_title"], groups, "_group").join(index, "_group", "left")
    hits = found.filter(F.coalesce(F.forall("_parts", lambda w: F.contains(low, w)), F.lit(False)))
    first = hits.groupBy("_title").agg(F.min("_entry").alias("_entry"))
    both = df.join(first, F.col(title) == F.col("_title"), "left")
    best = F.when(F.col(title).isNotNull(), F.least(F.col("_entry"), wordless))
    return both.withColumn(out, F.coalesce(best["type"], F.lit(default))).drop("_entry", "_title")
