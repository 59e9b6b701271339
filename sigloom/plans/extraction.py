"""Item data extraction for a date range and a set of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions import text as tx
from sigloom.operators import filters as flt
from sigloom.operators import items as it
from sigloom.operators.ordering import first_by_hash
from sigloom.sources.tables import Tables

ITEM_COLUMNS = ["item_id", "auct_titl", "subtitle", "auct_start_dt", "auct_end_dt", "leaf_categ_id", "item_site_id",
                "bsns_vrtcl_name", "meta_categ_id", "categ_lvl3_id", "gallery_url"]


def item_aspects(listings: DataFrame, aspects: DataFrame, shortest: bool = True, **denied) -> DataFrame:
    """Listings with an aspects map; listings without a valid aspect drop out.

    Aspects are reduced to one row per (item, end date, name) on their narrow keys; the wide listing columns
    join only once, afterwards.  ``denied`` goes to ``valid_aspects``.
    """
    keys = ["item_id", "auct_end_dt"]
    unique = listings.dropDuplicates(keys)
    wanted = flt.valid_aspects(aspects, **denied).join(unique.select(*keys), keys, "left_semi")
    reduced = it.shortest_aspects(wanted, keys) if shortest else it.first_aspects(wanted, keys)
    # Names that differ only in case share a key after lower-casing: the smaller original name wins.
    lowered = (reduced.groupBy(*keys, F.lower("prdct_aspct_nm").alias("name"))
                      .agg(F.lower(F.min_by("aspct_vlu_nm", "prdct_aspct_nm")).alias("value")))
    maps = it.aspects_map(lowered, keys, "name", "value")
    return flt.lower_all_strings(unique).join(maps, keys)


def extract(tables: Tables, start: str, end: str, *, verticals: list[str] | None = None, meta_ids: list[int] | None = None,
            leaf_ids: list[int] | None = None, site_ids: list[int] | None = None, n_items: int | None = None,
            shortest: bool = True, excluded_leaf_ids: list[int] | None = None, excluded_level2: list[int] | None = None,
            excluded_level3: list[int] | None = None, seed: int = 42, **denied) -> DataFrame:
    listings = flt.pick_listings(flt.in_date_range(tables["listings"], "auct_end_dt", start, end),
                                 leaf_ids, site_ids, excluded_leaf_ids)
    categories = flt.pick_categories(tables["categories"], leaf_ids=leaf_ids, site_ids=site_ids,
                                     excluded_leaf_ids=excluded_leaf_ids, excluded_level2=excluded_level2,
                                     excluded_level3=excluded_level3, meta_ids=meta_ids, verticals=verticals)
    joined = it.join_categories(listings, categories, restrict=verticals is not None or meta_ids is not None)
    if n_items is not None:
        joined = first_by_hash(joined, ["item_id", "auct_end_dt"], n_items, seed)
    aspects = flt.in_date_range(tables["aspects"], "auct_end_dt", start, end)
    with_aspects = item_aspects(flt.present_columns(joined, ITEM_COLUMNS), aspects, shortest, **denied)
    descriptions = flt.in_date_range(tables["descriptions"], "auct_end_dt", start, end).select("item_id", "item_desc")
    return (with_aspects.join(descriptions, "item_id", "left")
                        .withColumnRenamed("auct_titl", "title"))


def amend(df: DataFrame, denied: list[str] | None = None, from_base64: bool = False, drop_denied: bool = True,
          denied_names: list[str] | None = None, marketplace: str | None = None) -> DataFrame:
    """Plain-text description, aspects without denied names, and deny-free copies of the text columns."""
    desc = tx.base64_html_text(F.col("item_desc")) if from_base64 else F.col("item_desc")
    out = df.withColumn("desc", desc).withColumn("aspects", flt.drop_aspects_by_substring(F.col("aspects"), denied_names, marketplace))
    if not drop_denied:
        return out
    words = tx.fv.DENIED_SOURCE_WORDS if denied is None else denied
    return out.withColumns({
        "desc_no_forbidden": tx.drop_denied_sentences(F.col("desc"), words),
        "title_no_forbidden": tx.drop_denied_sentences(F.col("title"), words),
        "aspects_no_forbidden": drop_denied_in_map(F.col("aspects"), words)})


def drop_denied_in_map(aspects, denied: list[str]):
    """Apply the sentence rule to keys and values; drop emptied entries; of equal new keys the last wins."""
    cleaned = F.transform(F.map_entries(aspects), lambda e: F.struct(
        F.trim(tx.drop_denied_sentences_inline(e["key"], denied)).alias("key"),
        F.trim(tx.drop_denied_sentences_inline(e["value"], denied)).alias("value")))
    kept = F.filter(cleaned, lambda e: (e["key"] != "") & (e["value"] != ""))
    last = tx.let(kept, lambda m: F.filter(m, lambda e, i: ~F.exists(F.slice(m, i + 2, F.greatest(F.size(m) - i, F.lit(0))),
                                                                     lambda later: later["key"] == e["key"])))
    return F.coalesce(F.map_from_entries(last), F.from_json(F.lit("{}"), "map<string,string>"))
