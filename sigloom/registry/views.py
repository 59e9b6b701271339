"""Inputs for the registered queries, derived from the given tables.

One SQL text per view serves both engines.  ``{table}`` stands for a table, ``{at}`` for "list element or NULL".
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.operators.ordering import evaluate_once

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

VIEWS: dict[str, str] = {}
TEXT_VIEWS = ("v_signals", "v_raw_output", "v_wide")
LONG_TEXTS = ("documents", "pages", "conversations")  # one small file each here, costly per row

VIEWS["v_views"] = """
select l_partkey as item_id, l_partkey % 3 as site_id, l_partkey % 25 as leaf_categ_id,
       cast(l_shipdate as date) as session_start_dt,
       case when l_returnflag = 'R' then 1 else 0 end as exclude,
       case l_partkey % 4 when 0 then 'a=1' when 1 then 'a=1&viwtbidstr='
            when 2 then 'a=1&viwtbidstr=937%2C939' else 'viwtbidstr=937%2C939%2C941&b=2' end as soj
from {lineitem}"""

VIEWS["v_categories"] = " union all ".join(f"""
select cast(n_nationkey as bigint) as leaf_categ_id,
       cast(case when n_nationkey % 8 = 7 then -1 else n_nationkey end as bigint) as move_to,
       cast({site} as bigint) as site_id, r_name as bsns_vrtcl_name,
       cast(n_nationkey % 4 as bigint) as meta_categ_id, cast(n_nationkey % 6 as bigint) as categ_lvl2_id,
       cast(n_nationkey % 5 as bigint) as categ_lvl3_id
from {{nation}} join {{region}} on n_regionkey = r_regionkey""" for site in (0, 1, 2))

VIEWS["v_listings"] = """
select p_partkey as item_id, concat(p_name,' ',p_brand) as auct_titl, p_type as subtitle,
       case when p_size % 5 = 0 then 1 else 0 end as lstg_status_id,
       cast(date '2024-01-01' + (p_size % 31) as date) as auct_end_dt,
       cast(date '2023-12-25' + (p_size % 31) as date) as auct_start_dt,
       p_partkey % 25 as leaf_categ_id, p_partkey % 3 as item_site_id,
       concat('https://IMG.example/', p_name) as gallery_url
from {part}"""

VIEWS["v_desc"] = """
select doc_id as item_id, text as item_desc, cast(date '2024-01-01' + cast(doc_id % 31 as int) as date) as auct_end_dt
from {documents}"""

VIEWS["v_aspects"] = """
select p_partkey as item_id, 'Brand' as prdct_aspct_nm, p_brand as aspct_vlu_nm, 0 as aspct_src, 'df' as ns_type_cd,
       cast(date '2024-01-01' + (p_size % 31) as date) as auct_end_dt from {part}
union all select p_partkey, 'Type', p_type, 0, 'df', cast(date '2024-01-01' + (p_size % 31) as date) from {part}
union all select p_partkey, 'TYPE', concat(p_type,' x'), 0, 'df', cast(date '2024-01-01' + (p_size % 31) as date)
          from {part} where p_partkey % 3 = 0
union all select p_partkey, 'Brand', concat(p_brand,' & co'), 0, 'df', cast(date '2024-01-01' + (p_size % 31) as date)
          from {part} where p_partkey % 5 = 0
union all select p_partkey, 'UPC', '12345', 0, 'df', cast(date '2024-01-01' + (p_size % 31) as date) from {part}
union all select p_partkey, 'Colour', case when p_partkey % 2 = 0 then 'N/A' else 'Red' end, 0, 'df',
                 cast(date '2024-01-01' + (p_size % 31) as date) from {part}
union all select p_partkey, 'Size', case when p_size % 7 = 0 then null else cast(p_size as varchar(10)) end,
                 case when p_size % 6 = 0 then 42 else 0 end, 'df', cast(date '2024-01-01' + (p_size % 31) as date) from {part}
union all select p_partkey, 'Origin', p_name, 0, 'xx', cast(date '2024-01-01' + (p_size % 31) as date) from {part}"""

VIEWS["v_ledger"] = """
select o_custkey as item_id, max(cast(o_orderdate as date)) as session_start_dt from {orders} group by o_custkey"""

# One signal per document.  The words come from the whole text, the description is the whole text.
VIEWS["v_signals"] = """
select doc_id as item_id,
       case doc_id % 6
         when 0 then concat_ws(' ', {at}(w,1), {at}(w,2), {at}(w,3))
         when 1 then concat_ws(' ', {at}(w,3), {at}(w,1), {at}(w,2))
         when 2 then concat_ws(' ', {at}(w,1), {at}(w,2), {at}(w,9))
         when 3 then concat_ws(' ', {at}(w,1), {at}(w,2), 'zzz')
         when 4 then concat_ws(' ', 'qqq', case when doc_id % 12 = 4 then {at}(w,6) end, 'zzz')
         else concat_ws(' ', case when doc_id % 12 = 5 then {at}(w,1) end,
              case cast(floor(doc_id / 12.0) as bigint) % 16
                when 0 then 'very fine extra fine' when 1 then 'no fade no fingerprints' when 2 then 'soft soft cotton'
                when 3 then 'soft soft soft' when 4 then 'soft warm soft warm' when 5 then '18v lithium 2ah battery'
                when 6 then '12 34 56' when 7 then '50 x 60 in' when 8 then '10 000 hours lifespan'
                when 9 then '60 polyester 40 cotton' when 10 then '5 wins' when 11 then '12 month warranty'
                when 12 then 'free shipping today' when 13 then '4 5 6 7 pack' when 14 then 'lot 10'
                else '17520 lumens output' end)
       end as signal,
       concat('found in ', source) as explanation,
       concat_ws(' ', {at}(w,5), {at}(w,6), {at}(w,7), {at}(w,8)) as title,
       concat(lang, ' ', source) as aspects, text as "desc", lang, source
from (select doc_id, text, lang, source, regexp_extract_all(lower(text), '([abcdefghijklmnopqrstuvwxyz]{{2,}})', 1) as w from {documents}) t"""

# Raw model answers of six shapes; q is one double quote.
VIEWS["v_raw_output"] = """
select doc_id as item_id,
       case doc_id % 6
         when 0 then concat('Sure: {{', q, 'characteristic_1', q, ': ', q, coalesce({at}(w,1), ''), ' ', coalesce({at}(w,2), ''), q, ', ', q, 'explanation_1', q, ': ', q,
                            'from ', source, q, ', ', q, 'characteristic_2', q, ': ', q, lang, ' 3d', q, '}} done')
         when 1 then concat('{{''characteristic'': ''', coalesce({at}(w,1), ''), ' women', ''', ''explanation'': ''', source, '''}}')
         when 2 then concat('{{', q, 'characteristic', q, ': ', q, coalesce({at}(w,1), ''), q, ', ', q, 'feature', q, ': ', q, source, q, ',}}')
         when 3 then concat('a {{', q, 'characteristic', q, ': ', q, 'first', q, '}} b {{', q, 'characteristic', q, ': ', q, 'second', q, '}}')
         when 4 then concat('```json {{', q, 'signal_label', q, ': ', q, cast(doc_id % 4 as varchar(5)), q, ', ', q, 'reason', q, ': ', q,
                            source, q, '}} ```')
         else concat('no answer for ', source) end as gen_text,
       case doc_id % 4
         when 0 then concat('Label: ', cast(doc_id % 3 as varchar(5)), ', Reason for label: ', source)
         when 1 then concat('Labels: ', cast(doc_id % 3 as varchar(5)), ', 1, 2 then Labels: 0, x, ', cast(doc_id % 2 as varchar(5)))
         when 2 then concat('Label: 1') else 'none' end as judge_text,
       case doc_id % 4
         when 0 then concat('1. ', lang) when 1 then concat('1. ', lang, chr(10), '2. ', source, chr(10), chr(10), '3. end')
         when 2 then concat(lang, chr(10), '2. ', source) end as grouped_signals
from (select doc_id, lang, source, regexp_extract_all(lower(text), '([abcdefghijklmnopqrstuvwxyz]{{2,}})', 1) as w, chr(34) as q from {documents}) t"""

# Wide output: three signals and explanations per item.
VIEWS["v_wide"] = """
select doc_id as item_id, lang as title,
       coalesce({at}(w,1), '') as sig_1, case when doc_id % 3 = 0 then '' else {at}(w,2) end as sig_2,
       case when doc_id % 5 = 0 then null else {at}(w,3) end as sig_3,
       'e1' as exp_1, source as exp_2, lang as exp_3
from (select doc_id, lang, source, regexp_extract_all(lower(text), '([abcdefghijklmnopqrstuvwxyz]{{2,}})', 1) as w from {documents}) t"""

# Two annotators per row: quality and toxic; three pairs; some labels missing.
VIEWS["v_annotations"] = """
select doc_id as item_id, concat('Sig ', cast(doc_id % 5 as varchar(5))) as signal,
       concat('ann_', chr(cast(97 + 2 * (doc_id % 3) as int))) as annotator_name, quality as label,
       case when quality = 0 then 'bad' end as reason, 'c1' as comment, 'file_1' as source_file from {labels}
union all
select doc_id, concat('Sig ', cast(doc_id % 5 as varchar(5))),
       concat('ann_', chr(cast(98 + 2 * (doc_id % 3) as int))), case when doc_id % 17 = 0 then null else toxic end,
       case when toxic = 1 then 'toxic' end, 'c2', 'file_2' from {labels}"""

VIEWS["v_pairs"] = """
select 'ann_a' as first_annotator, 'ann_b' as second_annotator union all select 'ann_c', 'ann_d' union all select 'ann_e', 'ann_f'"""

VIEWS["v_adjudicated"] = """
select doc_id as item_id, concat('Sig ', cast(doc_id % 5 as varchar(5))) as signal,
       case when doc_id % 2 = 0 then 2 end as final_label, case when doc_id % 4 = 0 then 'judged' end as final_reason,
       case when doc_id % 3 = 0 then 'rd' end as reason, case when doc_id % 6 = 0 then 'fc' end as final_comment
from {labels} where quality <> toxic"""

# Conversation turns as the signals of an item.
VIEWS["v_chat"] = """
select conv_id as item_id, turn + 1 as pos, text as signal, role as title, cast(turn % 3 as int) as label, concat('r', role) as reason
from {conversations}"""

VIEWS["v_uplift"] = """
select event_id, user_id, event_id % 97 as item_id, ts,
       case event_type when 'click' then 'a' when 'view' then 'b' when 'error' then 'c' else 'nsh' end as shown,
       case when value > 12 then 1 else 0 end as conversion,
       k % 2 as qual_a, cast(floor(k / 2.0) as int) % 2 as qual_b, cast(floor(k / 4.0) as int) % 2 as qual_c, value,
       case when k % 10 = 0 then null else k end as feature
from (select event_id, user_id, ts, event_type, value, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {events}) t"""


class Bed:
    """The given tables and the views over them for one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        # Partitions for tables of long texts that lie in a single row group; a caller who knows the files may set it.
        self.spread = int(os.environ.get("SIGLOOM_SPREAD_TEXTS", "0"))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            table = self.table(name)
            return table.repartition(self.spread) if self.spread and name in LONG_TEXTS else table
        if name in VIEWS:
            sql = VIEWS[name].replace("{at}", "try_element_at").replace('"desc"', "`desc`")
            used = [t for t in TABLES if "{" + t + "}" in sql]
            view = self.spark.sql(sql, **{t: getattr(self, t) for t in used})
            # Text views stand for stored tables, so later filters must not be pushed into their expressions.
            return evaluate_once(view, **{c: F.col(c) for c in view.columns}) if name in TEXT_VIEWS else view
        raise AttributeError(name)


def with_views(sql: str) -> str:
    """Prefix DuckDB SQL with the views it names."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql.strip()
    ctes = [f"{v} as ({VIEWS[v].format(at='list_extract', **{t: t for t in TABLES})})" for v in used]
    body = sql.strip()
    head = re.match(r"(?i)with\s+(recursive\s+)?", body)
    recursive = "recursive " if head and head.group(1) else ""
    rest = ", " + body[head.end():] if head else " " + body
    return f"with {recursive}" + ", ".join(ctes) + rest
