"""Queries for item selection and extraction: scans, filters, joins, aggregates, top-k."""

from dataclasses import replace

from pyspark.sql import Observation
from pyspark.sql import functions as F

from sigloom.functions import text as tx
from sigloom.operators import filters as flt
from sigloom.operators import items as it
from sigloom.operators import report
from sigloom.operators.ordering import top_by_rank
from sigloom.plans import extraction, selection
from sigloom.plans.selection import SelectionRequest
from sigloom.registry.core import query
from sigloom.sources.folders import new_folder
from sigloom.sources.tables import Tables

REQUEST = SelectionRequest(start="1996-01-01", end="1996-12-31", limit=300, verticals=["ASIA", "EUROPE"],
                           excluded_level3=[3], use_ledger=True)


def bed_tables(b) -> Tables:
    # The ledger of the test bed has later dates than the views, so it is moved back to overlap.
    ledger = b.v_ledger.select("item_id", F.date_sub("session_start_dt", 730).alias("session_start_dt"))
    return Tables(b.spark, {"views": b.v_views, "categories": b.v_categories, "listings": b.v_listings,
                            "descriptions": b.v_desc, "aspects": b.v_aspects, "ledger": ledger})


def as_json(df, column="aspects"):
    """Map columns as sorted JSON text, so both engines print them alike."""
    entries = F.array_sort(F.transform(F.map_entries(column), lambda e: F.concat(F.to_json(F.struct(e["key"].alias("k"))), F.to_json(F.struct(e["value"].alias("v"))))))
    return df.withColumn(column, F.array_join(entries, ";"))


# Reusable DuckDB fragments, written against the view columns only.
NAMES_SQL = "(" + ", ".join("'" + n.replace("'", "''") + "'" for n in tx.fv.denied_aspect_names()) + ")"
VALUES_SQL = "(" + ", ".join(f"'{v}'" for v in tx.fv.DENIED_ASPECT_VALUES) + ")"
SOURCES_SQL = "(" + ", ".join(map(str, tx.fv.DENIED_ASPECT_SOURCES)) + ")"
SIZE_SQL = r"case when not regexp_matches(soj, '(^|&)viwtbidstr=') then -1 else len(regexp_split_to_array(replace(regexp_extract(soj, '(^|&)viwtbidstr=([^&]*)', 2), '%2C', ','), '[,|\[\]]')) end"
RANKED_SQL = f"""ranked as (
  select item_id, max(site_id) as site_id, max(leaf_categ_id) as leaf_categ_id,
         case when min({SIZE_SQL}) < 2 then 999999999 else count(*) end as rank
  from v_views where session_start_dt between date '1996-01-01' and date '1996-12-31' and item_id > 0 and exclude is not distinct from 0
  group by item_id)"""
VALID_SQL = f"""valid as (
  select * from v_aspects where ns_type_cd = 'df' and lower(prdct_aspct_nm) not in {NAMES_SQL} and aspct_src not in {SOURCES_SQL}
    and aspct_vlu_nm is not null and lower(aspct_vlu_nm) not in {VALUES_SQL})"""
NEW_SQL = f"""{RANKED_SQL},
top as (select * from ranked order by rank desc, item_id limit 1200),
cats as (select * from v_categories where leaf_categ_id = move_to and categ_lvl3_id not in (3) and bsns_vrtcl_name in ('ASIA','EUROPE')),
led as (select item_id from v_ledger where session_start_dt - 730 >= date '1996-01-01' - 365),
fresh as (select item_id, rank from top t where exists (select 1 from cats c where c.leaf_categ_id = t.leaf_categ_id and c.site_id = t.site_id)
          and item_id not in (select item_id from led))"""
LATEST_SQL = f"""{VALID_SQL},
latest as (select item_id, lower(prdct_aspct_nm) as name, lower(aspct_vlu_nm) as value from valid
           qualify row_number() over (partition by item_id, lower(prdct_aspct_nm) order by auct_end_dt desc, lower(aspct_vlu_nm) desc) = 1)"""
PAIR_SQL = "string_agg(concat('{\"k\":', to_json(name), '}{\"v\":', to_json(value), '}'), ';' order by concat('{\"k\":', to_json(name), '}{\"v\":', to_json(value), '}'))"
SELECTED_SQL = f"""with {NEW_SQL}, {LATEST_SQL},
maps as (select item_id, {PAIR_SQL} as aspects from latest group by item_id),
full_rows as (select l.item_id, l.auct_titl as title, m.aspects, d.item_desc as "desc", f.rank
  from v_listings l join fresh f using (item_id) left join maps m using (item_id) left join v_desc d using (item_id)
  where l.lstg_status_id = 0 and (m.aspects is not null or d.item_desc is not null)),
selected as (select * from full_rows order by rank desc, item_id limit 300)"""


@query("plan_01_item_selection", SELECTED_SQL + ' select item_id, title, aspects, "desc", rank from selected')
def _(b):
    return as_json(selection.select_items(bed_tables(b), replace(REQUEST, scratch=new_folder(b.spark, "selection"))))


@query("agg_21_selection_slots", SELECTED_SQL + """ select count(*) as total, count(*) filter (rank = 999999999) as vacant,
       count(*) filter (rank <> 999999999) as non_vacant from selected""")
def _(b):
    return selection.slot_report(selection.final_ids(bed_tables(b), REQUEST, selection.new_candidates(bed_tables(b), REQUEST, selection.candidates(bed_tables(b), REQUEST))))


@query("agg_21c_slots_on_write", SELECTED_SQL + """ select count(*) as total, count(*) filter (rank = 999999999) as vacant,
       count(*) filter (rank <> 999999999) as non_vacant from selected""")
def _(b):
    slots = Observation("slots")
    selection.run(bed_tables(b), replace(REQUEST, scratch=new_folder(b.spark, "selection")), new_folder(b.spark, "selected"), slots=slots)
    return report.observed(b.spark, slots, ["total", "vacant", "non_vacant"])


# --- scans and projections -------------------------------------------------------------------
@query("src_01_catalog_scan", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by all")
def _(b):
    b.lineitem.createOrReplaceTempView("catalog_lines")
    return Tables(b.spark, {"lines": "catalog_lines"})["lines"].groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("src_03_parquet_scan", "select event_type, count(*) as n, count(distinct user_id) as users from events group by all")
def _(b):
    path = f"{b.dir}/events.parquet"
    return Tables(b.spark, {"e": path})["e"].groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("src_08_sql_scan", "select item_id, auct_titl from v_listings where lstg_status_id = 0 and item_site_id = 1 order by item_id limit 500")
def _(b):
    from sigloom.sources.readers import sql_scan
    return sql_scan(b.spark, "select item_id, auct_titl from {l} where lstg_status_id = 0 and item_site_id = 1 order by item_id limit 500",
                    l=b.v_listings)


@query("prj_01_select_rename_drop", "select item_id, auct_titl as title, lstg_status_id from v_listings")
def _(b):
    return b.v_listings.select("item_id", "auct_titl", "lstg_status_id", "subtitle").withColumnRenamed("auct_titl", "title").drop("subtitle")


@query("prj_02_present_columns", "select aspects, item_id, title from v_signals")
def _(b):
    return flt.present_columns(b.v_signals, ["aspects", "no_such_column", "item_id", "title"])


@query("prj_03_lower_columns", "select item_id, lower(prdct_aspct_nm) as prdct_aspct_nm, lower(aspct_vlu_nm) as aspct_vlu_nm, ns_type_cd from v_aspects")
def _(b):
    return flt.lower_columns(b.v_aspects.select("item_id", "prdct_aspct_nm", "aspct_vlu_nm", "ns_type_cd"), ["prdct_aspct_nm", "aspct_vlu_nm"])


@query("prj_04_lower_all_strings", "select item_id, lower(auct_titl) as auct_titl, lower(subtitle) as subtitle, gallery_url from v_listings")
def _(b):
    return flt.lower_all_strings(b.v_listings.select("item_id", "auct_titl", "subtitle", "gallery_url"))


@query("prj_05_arrange", "select item_id, signal, '' as label, '' as reason, '' as comment, title from v_signals")
def _(b):
    return flt.arrange(b.v_signals, ["item_id", "signal", "label", "reason", "comment", "title"], {"label": "", "reason": "", "comment": ""})


@query("prj_06_fill_zero", "select event_id, shown, coalesce(feature, 0) as feature, qual_a from v_uplift")
def _(b):
    return flt.fill_zero(b.v_uplift.select("event_id", "shown", "feature", "qual_a"), categorical=["shown"])


@query("prj_08_numeric_id", """select raw, coalesce(try_cast(regexp_replace(raw, '\\.0$', '') as bigint), 0) as item_id
       from (select case doc_id % 4 when 0 then concat(doc_id, '.0') when 1 then 'nan' when 2 then null else cast(doc_id as varchar) end as raw from documents)""")
def _(b):
    raw = b.documents.select(F.when(F.col("doc_id") % 4 == 0, F.concat(F.col("doc_id").cast("string"), F.lit(".0")))
                             .when(F.col("doc_id") % 4 == 1, "nan").when(F.col("doc_id") % 4 == 3, F.col("doc_id").cast("string")).alias("raw"))
    return raw.select("raw", tx.numeric_id(F.col("raw")).alias("item_id"))


# --- filters ------------------------------------------------------------------------------------
@query("flt_01_date_range", "select item_id, session_start_dt from v_views where session_start_dt between date '1996-03-01' and date '1996-03-31'")
def _(b):
    return flt.in_date_range(b.v_views, "session_start_dt", "1996-03-01", "1996-03-31").select("item_id", "session_start_dt")


@query("flt_02_countable_views", "select item_id, exclude, count(*) as n from v_views where item_id > 0 and exclude = 0 group by all")
def _(b):
    return flt.countable_views(b.v_views).groupBy("item_id", "exclude").agg(F.count("*").alias("n"))


@query("flt_03_categories", """select leaf_categ_id, site_id, bsns_vrtcl_name from v_categories where leaf_categ_id = move_to and site_id in (0, 1)
       and categ_lvl3_id not in (3) and bsns_vrtcl_name in ('ASIA', 'EUROPE')""")
def _(b):
    return flt.pick_categories(b.v_categories, site_ids=[0, 1], excluded_level3=[3], verticals=["ASIA", "EUROPE"]) \
        .select("leaf_categ_id", "site_id", "bsns_vrtcl_name")


@query("flt_04_categories_wide", """select 'category' as kind, leaf_categ_id, site_id as site, count(*) as n from v_categories
  where leaf_categ_id = move_to and leaf_categ_id between 1 and 20 and site_id in (0, 2) and leaf_categ_id not in (4, 9)
    and categ_lvl2_id not in (1) and categ_lvl3_id not in (3) and meta_categ_id in (0, 1, 2) and bsns_vrtcl_name <> 'AFRICA' group by all
  union all select 'listing', leaf_categ_id, item_site_id, count(*) from v_listings
  where leaf_categ_id between 1 and 20 and item_site_id in (0, 2) and leaf_categ_id not in (4, 9) group by all""")
def _(b):
    leaves = list(range(1, 21))
    cats = flt.pick_categories(b.v_categories, leaf_ids=leaves, site_ids=[0, 2], excluded_leaf_ids=[4, 9], excluded_level2=[1],
                               excluded_level3=[3], meta_ids=[0, 1, 2], verticals=["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])
    lst = flt.pick_listings(b.v_listings, leaf_ids=leaves, site_ids=[0, 2], excluded_leaf_ids=[4, 9])
    count = lambda df, kind, site: df.groupBy("leaf_categ_id", F.col(site).alias("site")).agg(F.count("*").alias("n")) \
        .select(F.lit(kind).alias("kind"), "leaf_categ_id", "site", "n")
    return count(cats, "category", "site_id").unionByName(count(lst, "listing", "item_site_id"))


@query("flt_05_live_listings", "select item_id, auct_titl from v_listings where lstg_status_id = 0")
def _(b):
    return flt.live_only(b.v_listings).select("item_id", "auct_titl")


@query("flt_06_valid_aspects", f"with {VALID_SQL} select item_id, prdct_aspct_nm, aspct_vlu_nm from valid")
def _(b):
    return flt.valid_aspects(b.v_aspects).select("item_id", "prdct_aspct_nm", "aspct_vlu_nm")


@query("flt_07_has_content", 'select l.item_id from v_listings l left join v_desc d using (item_id) where d.item_desc is not null or l.item_site_id = 2')
def _(b):
    aspects = b.v_listings.select("item_id", F.when(F.col("item_site_id") == 2, F.create_map(F.lit("k"), F.lit("v"))).alias("aspects"))
    desc = b.v_desc.select("item_id", F.col("item_desc").alias("desc"))
    return flt.has_content(it.assemble(b.v_listings.select("item_id"), aspects, desc)).select("item_id")


def raw_maps(b):
    """All aspects of an item as an unfiltered map; NULL values stay."""
    unique = b.v_aspects.groupBy("item_id", "prdct_aspct_nm").agg(
        F.max_by("aspct_vlu_nm", F.struct("auct_end_dt", "aspct_vlu_nm")).alias("aspct_vlu_nm"))
    return it.aspects_map(unique, ["item_id"], "prdct_aspct_nm", "aspct_vlu_nm")


RAW_SQL = """raw as (select item_id, prdct_aspct_nm as name, aspct_vlu_nm as value from v_aspects
  qualify row_number() over (partition by item_id, prdct_aspct_nm order by auct_end_dt desc, aspct_vlu_nm desc nulls last) = 1)"""


@query("flt_08_aspects_by_substring", f"""with {RAW_SQL}, names as (select unnest({NAMES_SQL.replace('(', '[', 1)[:-1] + ']'}) as d)
  select item_id, name, value from raw where value is not null and not exists (select 1 from names where contains(lower(name), d))""")
def _(b):
    m = raw_maps(b).withColumn("aspects", flt.drop_aspects_by_substring(F.col("aspects")))
    return m.select("item_id", F.explode("aspects").alias("name", "value"))


@query("flt_09_aspects_exact", f"""with {RAW_SQL} select item_id, lower(name) as name, value from raw
  where value is not null and lower(name) not in {NAMES_SQL} and lower(trim(value)) not in {VALUES_SQL} and name not in ('TYPE')""")
def _(b):
    m = raw_maps(b).withColumn("aspects", F.map_filter("aspects", lambda k, v: k != "TYPE"))
    m = m.withColumn("aspects", F.transform_keys("aspects", lambda k, v: F.lower(k)))
    return m.select("item_id", F.explode(flt.drop_aspects_exact(F.col("aspects"))).alias("name", "value"))


@query("flt_10_excluded_category", """select s.item_id, l.leaf_categ_id from v_signals s left join v_listings l using (item_id) where l.leaf_categ_id not in (3, 5, 7)""")
def _(b):
    joined = it.attach(b.v_signals.select("item_id"), b.v_listings, "item_id", ["leaf_categ_id"])
    return flt.not_in_categories(joined, "leaf_categ_id", [3, 5, 7])


@query("flt_11_labelled", "select item_id, annotator_name, label from v_annotations where label is not null")
def _(b):
    return flt.labelled(b.v_annotations).select("item_id", "annotator_name", "label")


@query("flt_12_choiceable", "select event_id, shown from v_uplift where shown <> 'nsh' and qual_a + qual_b + qual_c > 1 and conversion = 1")
def _(b):
    return flt.converted_rows(flt.choiceable_rows(flt.shown_rows(b.v_uplift), ["qual_a", "qual_b", "qual_c"])).select("event_id", "shown")


@query("flt_13_containing_word", "select signal, count(*) as n from v_signals where contains(lower(signal), 'zz') group by all")
def _(b):
    return flt.containing_word(b.v_signals, "signal", "ZZ").groupBy("signal").agg(F.count("*").alias("n"))


@query("flt_14_any_flag", "select event_id from v_uplift where qual_a = 1 or qual_c = 1")
def _(b):
    return flt.any_flag(b.v_uplift, ["qual_a", "qual_c"]).select("event_id")


@query("flt_15_within_dates", """select item_id, session_start_dt from v_views where session_start_dt > (select min(cast(o_orderdate as date)) from orders)
  and session_start_dt < (select max(cast(o_orderdate as date)) from orders)""")
def _(b):
    days = b.orders.select(F.col("o_orderdate").cast("date").alias("d"))
    return flt.within_dates_of(b.v_views, "session_start_dt", days, "d", inclusive=False).select("item_id", "session_start_dt")


# --- joins -----------------------------------------------------------------------------------------
@query("jon_01_semi_two_keys", """select distinct v.item_id from v_views v where exists (select 1 from v_categories c
  where c.leaf_categ_id = v.leaf_categ_id and c.site_id = v.site_id and c.leaf_categ_id = c.move_to and c.bsns_vrtcl_name = 'ASIA')""")
def _(b):
    cats = flt.pick_categories(b.v_categories, verticals=["ASIA"])
    return it.in_categories(b.v_views, cats).select("item_id").distinct()


@query("jon_02_semi_ids", "select item_id, auct_titl from v_listings where item_id in (select item_id from v_ledger)")
def _(b):
    return it.with_ids(b.v_listings, b.v_ledger).select("item_id", "auct_titl")


@query("jon_03_anti_ledger", """select item_id, auct_titl from v_listings where item_id not in
  (select item_id from v_ledger where session_start_dt >= date '1998-01-01' - 365)""")
def _(b):
    return it.without_ids(b.v_listings, it.recent_ledger(b.v_ledger, "1998-01-01")).select("item_id", "auct_titl")


@query("jon_04_assemble", f"""with {LATEST_SQL}, maps as (select item_id, {PAIR_SQL} as aspects from latest group by item_id)
  select item_id, auct_titl as title, aspects, item_desc as "desc" from v_listings left join maps using (item_id) left join v_desc using (item_id)""")
def _(b):
    items = b.v_listings.select("item_id", F.col("auct_titl").alias("title"))
    return as_json(it.assemble(items, it.latest_aspects(b.v_aspects), b.v_desc.select("item_id", F.col("item_desc").alias("desc"))))


@query("jon_05_back_to_rank", f"""with {RANKED_SQL} select l.item_id, l.auct_titl, r.rank from v_listings l join ranked r using (item_id)
  order by r.rank desc, l.item_id limit 200""")
def _(b):
    joined = b.v_listings.select("item_id", "auct_titl").join(ranked(b).select("item_id", "rank"), "item_id")
    return top_by_rank(joined, "rank", "item_id", 200)


@query("jon_06_aspects_by_end_date", """select a.item_id, a.auct_end_dt, a.prdct_aspct_nm, count(*) as n from v_aspects a
  join (select distinct item_id, auct_end_dt from v_listings where item_site_id = 1) l on a.item_id = l.item_id and a.auct_end_dt = l.auct_end_dt group by all""")
def _(b):
    listings = b.v_listings.filter("item_site_id = 1").select("item_id", "auct_end_dt")
    return it.aspects_of_listings(b.v_aspects, listings).groupBy("item_id", "auct_end_dt", "prdct_aspct_nm").agg(F.count("*").alias("n"))


@query("jon_07_conditional_join", """with c as (select * from v_categories where leaf_categ_id = move_to)
  select 'restricted' as kind, item_id, bsns_vrtcl_name from v_listings l join c on l.leaf_categ_id = c.leaf_categ_id and l.item_site_id = c.site_id where bsns_vrtcl_name in ('ASIA')
  union all select 'open', item_id, bsns_vrtcl_name from v_listings l left join c on l.leaf_categ_id = c.leaf_categ_id and l.item_site_id = c.site_id""")
def _(b):
    def part(kind, verticals):
        cats = flt.pick_categories(b.v_categories, verticals=verticals)
        return it.join_categories(b.v_listings, cats, verticals is not None).select(F.lit(kind).alias("kind"), "item_id", "bsns_vrtcl_name")
    return part("restricted", ["ASIA"]).unionByName(part("open", None))


@query("jon_08_description_outer", "select l.item_id, l.auct_titl, d.item_desc from v_listings l left join v_desc d using (item_id)")
def _(b):
    return b.v_listings.select("item_id", "auct_titl").join(b.v_desc.select("item_id", "item_desc"), "item_id", "left")


@query("jon_09_attach_columns", "select s.item_id, s.signal, l.gallery_url, l.leaf_categ_id from v_signals s left join v_listings l using (item_id)")
def _(b):
    return it.attach(b.v_signals.select("item_id", "signal"), b.v_listings, "item_id", ["gallery_url", "leaf_categ_id"])


@query("jon_18_category_names", """select distinct l.item_site_id as site_id, l.leaf_categ_id, c.bsns_vrtcl_name from v_listings l
  join v_categories c on c.site_id = l.item_site_id and c.leaf_categ_id = l.leaf_categ_id where c.leaf_categ_id = c.move_to""")
def _(b):
    pairs = b.v_listings.select(F.col("item_site_id").alias("site_id"), "leaf_categ_id")
    return it.category_names(pairs, b.v_categories)


TYPES = ["bolts", "red widgets", "gears & rings", "rings", "valve"]


@query("jon_19_items_with_tips", """with tips(tip_order, type, tips) as (values (1,'bolts','tip bolts'), (2,'rings','tip rings'), (3,'red widgets','tip red')),
  typed as (select item_id, auct_titl as title, case when contains(lower(auct_titl),'bolt') then 'bolts'
     when contains(lower(auct_titl),'red') and contains(lower(auct_titl),'widget') then 'red widgets'
     when contains(lower(auct_titl),'gear') and contains(lower(auct_titl),'ring') then 'gears & rings'
     when contains(lower(auct_titl),'ring') then 'rings' when contains(lower(auct_titl),'valve') then 'valve' else 'unknown' end as type from v_listings)
  select type, item_id, title, tip_order, tips, coalesce(item_desc, '') as "desc" from typed join tips using (type) left join v_desc using (item_id)
  order by tip_order, item_id limit 100""")
def _(b):
    typed = b.v_listings.select("item_id", F.col("auct_titl").alias("title"), tx.first_type_in_title(F.col("auct_titl"), TYPES).alias("type"))
    tips = b.spark.createDataFrame([(1, "bolts", "tip bolts"), (2, "rings", "tip rings"), (3, "red widgets", "tip red")], "tip_order int, type string, tips string")
    return it.items_with_tips(typed, tips, b.v_desc.select("item_id", F.col("item_desc").alias("desc")), 100)


# --- aggregates and top-k -----------------------------------------------------------------------------
def ranked(b):
    return it.with_rank(it.views_per_item(it.relevant_views(b.v_views, "1996-01-01", "1996-12-31")))


@query("agg_01_views_per_item", f"""select item_id, max(site_id) as site_id, max(leaf_categ_id) as leaf_categ_id, min({SIZE_SQL}) as min_shown, count(*) as views
  from v_views where session_start_dt between date '1996-01-01' and date '1996-12-31' and item_id > 0 and exclude = 0 group by item_id""")
def _(b):
    return it.views_per_item(it.relevant_views(b.v_views, "1996-01-01", "1996-12-31"))


@query("agg_01b_latest_view", """select item_id, site_id, leaf_categ_id, min_shown, views from (
  select l_partkey as item_id, l_suppkey % 3 as site_id, l_orderkey % 25 as leaf_categ_id, min(l_linenumber % 5) over w as min_shown, count(*) over w as views,
    row_number() over (partition by l_partkey order by l_shipdate desc, l_suppkey % 3 desc, l_orderkey % 25 desc) as r
  from lineitem window w as (partition by l_partkey)) where r = 1""")
def _(b):
    # Site and leaf differ from view to view here, so only the latest view gives the right ones; of equal dates the larger pair.
    views = b.lineitem.select(F.col("l_partkey").alias("item_id"), (F.col("l_suppkey") % 3).alias("site_id"), (F.col("l_orderkey") % 25).alias("leaf_categ_id"),
                              F.col("l_shipdate").alias("session_start_dt"), (F.col("l_linenumber") % 5).alias("shown"))
    return it.views_per_item(views)


@query("agg_02_rank", f"with {RANKED_SQL} select item_id, rank from ranked")
def _(b):
    return ranked(b).select("item_id", "rank")


@query("agg_03_latest_aspects", f"with {LATEST_SQL} select item_id, name, value from latest")
def _(b):
    return it.latest_aspects(b.v_aspects).select("item_id", F.explode("aspects").alias("name", "value"))


@query("agg_04_shortest_aspects", f"""with {VALID_SQL} select item_id, prdct_aspct_nm, aspct_vlu_nm from valid
  qualify row_number() over (partition by item_id, prdct_aspct_nm order by length(aspct_vlu_nm), aspct_vlu_nm) = 1""")
def _(b):
    return it.shortest_aspects(flt.valid_aspects(b.v_aspects), ["item_id"])


@query("agg_05_first_aspects", f"""with {VALID_SQL} select item_id, prdct_aspct_nm, aspct_vlu_nm from valid
  qualify row_number() over (partition by item_id, prdct_aspct_nm order by auct_end_dt, aspct_vlu_nm) = 1""")
def _(b):
    return it.first_aspects(flt.valid_aspects(b.v_aspects), ["item_id"])


@query("agg_06_merge_maps", f"""with {VALID_SQL} select item_id, lower(prdct_aspct_nm) as name, arg_max(aspct_vlu_nm, row(auct_end_dt, aspct_vlu_nm)) as value from valid group by all""")
def _(b):
    one = flt.valid_aspects(b.v_aspects).select("item_id", "auct_end_dt", F.create_map(F.lower("prdct_aspct_nm"), "aspct_vlu_nm").alias("m"))
    return it.merge_maps(one, ["item_id"], "m", "auct_end_dt", "aspects").select("item_id", F.explode("aspects").alias("name", "value"))


@query("agg_07_distinct_ids", "select count(distinct item_id) as items, count(distinct session_start_dt) as days, count(distinct soj) as blobs from v_views")
def _(b):
    return b.v_views.agg(F.countDistinct("item_id").alias("items"), F.countDistinct("session_start_dt").alias("days"), F.countDistinct("soj").alias("blobs"))


@query("agg_08_date_span", "select min(session_start_dt) as first_day, max(session_start_dt) as last_day from v_views")
def _(b):
    return b.v_views.agg(F.min("session_start_dt").alias("first_day"), F.max("session_start_dt").alias("last_day"))


@query("win_01_row_number_shortest", f"""with {VALID_SQL} select item_id, prdct_aspct_nm, aspct_vlu_nm, auct_end_dt from valid
  qualify row_number() over (partition by item_id, prdct_aspct_nm order by length(aspct_vlu_nm), aspct_vlu_nm) = 1""")
def _(b):
    return it.shortest_aspects_ranked(flt.valid_aspects(b.v_aspects), ["item_id"]).select("item_id", "prdct_aspct_nm", "aspct_vlu_nm", "auct_end_dt")


@query("top_01_overfetch", f"with {RANKED_SQL} select item_id, rank from ranked order by rank desc, item_id limit 1200")
def _(b):
    return top_by_rank(ranked(b).select("item_id", "rank"), "rank", "item_id", 1200)


@query("top_02_final", f"with {RANKED_SQL} select item_id from ranked order by rank desc, item_id limit 300")
def _(b):
    return top_by_rank(ranked(b).select("item_id", "rank"), "rank", "item_id", 300).drop("rank")


@query("dat_01_ledger_bound", "select item_id, session_start_dt from v_ledger where session_start_dt >= date '1999-06-01' - 365")
def _(b):
    return it.recent_ledger(b.v_ledger, "1999-06-01").select("item_id", "session_start_dt")


# --- blobs -------------------------------------------------------------------------------------------
@query("str_14_blob_ids", f"""select item_id, {SIZE_SQL} as n, count(*) as views from v_views group by all""")
def _(b):
    return b.v_views.select("item_id", it.shown_count(F.col("soj")).alias("n")).groupBy("item_id", "n").agg(F.count("*").alias("views"))


@query("str_15_blob_value", r"""select distinct item_id, case when regexp_matches(soj, '(^|&)viwtbidstr=') then url_decode(regexp_extract(soj, '(^|&)viwtbidstr=([^&]*)', 2)) end as shown from v_views""")
def _(b):
    return b.v_views.select("item_id", tx.blob_value(F.col("soj"), "viwtbidstr").alias("shown")).distinct()


# --- extraction --------------------------------------------------------------------------------------------
EXTRACT_STEPS_SQL = f"""with {VALID_SQL}, cats as (select * from v_categories where leaf_categ_id = move_to and categ_lvl3_id not in (2) and bsns_vrtcl_name in ('ASIA','EUROPE')),
lst as (select l.*, c.bsns_vrtcl_name, c.meta_categ_id, c.categ_lvl3_id, md5(concat(item_id, '-', l.auct_end_dt, '-42')) as h from v_listings l
  join cats c on l.leaf_categ_id = c.leaf_categ_id and l.item_site_id = c.site_id
  where l.auct_end_dt between date '2024-01-05' and date '2024-01-25'),
sampled as (select * from lst order by h, item_id limit 150),
short as (select item_id, auct_end_dt, prdct_aspct_nm, aspct_vlu_nm from valid where auct_end_dt between date '2024-01-05' and date '2024-01-25'
  qualify row_number() over (partition by item_id, auct_end_dt, prdct_aspct_nm order by length(aspct_vlu_nm), aspct_vlu_nm) = 1),
low as (select item_id, auct_end_dt, lower(prdct_aspct_nm) as name, lower(aspct_vlu_nm) as value from short
  qualify row_number() over (partition by item_id, auct_end_dt, lower(prdct_aspct_nm) order by prdct_aspct_nm) = 1),
maps as (select item_id, auct_end_dt, {PAIR_SQL} as aspects from low group by all)"""
EXTRACT_SQL = EXTRACT_STEPS_SQL + """ select s.item_id, lower(s.auct_titl) as title, lower(s.subtitle) as subtitle, s.auct_start_dt, s.auct_end_dt, s.leaf_categ_id, s.item_site_id,
  lower(s.bsns_vrtcl_name) as bsns_vrtcl_name, s.meta_categ_id, s.categ_lvl3_id, s.gallery_url, m.aspects, d.item_desc
from sampled s join maps m on s.item_id = m.item_id and s.auct_end_dt = m.auct_end_dt
left join (select * from v_desc where auct_end_dt between date '2024-01-05' and date '2024-01-25') d on d.item_id = s.item_id"""


def extracted(b, n_items):
    tables = Tables(b.spark, {"listings": b.v_listings, "categories": b.v_categories, "aspects": b.v_aspects, "descriptions": b.v_desc})
    return extraction.extract(tables, "2024-01-05", "2024-01-25", verticals=["ASIA", "EUROPE"], excluded_level3=[2], n_items=n_items)


@query("plan_02_item_extraction", EXTRACT_SQL)
def _(b):
    return as_json(extracted(b, 150))
