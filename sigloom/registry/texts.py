"""Queries for string functions, HTML, and parsing of model output."""

from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions import parse as ps
from sigloom.functions import text as tx
from sigloom.operators import filters as flt
from sigloom.operators import items as it
from sigloom.plans import extraction
from sigloom.registry.core import query
from sigloom.registry.grounding import DENIED_LIST_SQL, SENTENCES_SQL, TITLE_SQL, WORDS_SQL
from sigloom.registry.selection import EXTRACT_STEPS_SQL, NAMES_SQL, PAIR_SQL, RAW_SQL, as_json, extracted, raw_maps


@query("str_03_strip_tags", "select page_id, regexp_replace(html, '<[^>]*>', '', 'g') as plain from pages")
def _(b):
    return b.pages.select("page_id", tx.strip_tags(F.col("html")).alias("plain"))


HTML_SQL = r"""trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c},
  '<!--.*?-->', ' ', 'gs'), '<script\b[^>]*>.*?</script\s*>', ' ', 'gis'), '<style\b[^>]*>.*?</style\s*>', ' ', 'gis'), '<[/!?a-zA-Z][^>]*>', ' ', 'g'),
  '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), chr(160), ' '), '\s+', ' ', 'g'))"""


@query("str_04_html_text", f"select page_id, {HTML_SQL.format(c='html')} as plain, {HTML_SQL.format(c='html')} as from_base64 from pages")
def _(b):
    encoded = F.base64(F.encode("html", "UTF-8"))
    return b.pages.select("page_id", tx.html_text(F.col("html")).alias("plain"), tx.base64_html_text(encoded).alias("from_base64"))


@query("str_04b_decode_if_html", f"""select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as plain from documents where not (contains(text, '<') and contains(text, '>'))
  union all select doc_id, {HTML_SQL.format(c='text')} from documents where contains(text, '<') and contains(text, '>')""")
def _(b):
    return b.documents.select("doc_id", tx.decode_if_html(F.base64(F.encode("text", "UTF-8"))).alias("plain"))


@query("str_05_sentences", f"select doc_id, len(list_filter({SENTENCES_SQL.format(c='text')}, lambda s: s <> '')) as n, {SENTENCES_SQL.format(c='text')}[1] as first_sentence from documents")
def _(b):
    s = tx.sentences(F.col("text"))
    return b.documents.select("doc_id", F.size(s).cast("bigint").alias("n"), F.get(s, F.lit(0)).alias("first_sentence"))


KEPT_SENTENCES = "array_to_string(list_filter({sent}, lambda s: s <> '' and len(list_filter(" + DENIED_LIST_SQL + ", lambda d: contains(s, d))) = 0), ' ')"


def without_denied(c):
    return KEPT_SENTENCES.format(sent=SENTENCES_SQL.format(c=f"lower({c})"))


@query("str_06_drop_denied_sentences", f"select doc_id, {without_denied('text')} as kept from documents")
def _(b):
    return b.documents.select("doc_id", tx.drop_denied_sentences(F.col("text")).alias("kept"))


@query("str_07_drop_denied_in_map", f"""with {RAW_SQL}, low as (select item_id, trim({without_denied('name')}) as k, trim({without_denied('value')}) as v, name from raw where value is not null)
  select item_id, k as name, v as value from low where k <> '' and v <> '' qualify row_number() over (partition by item_id, k order by name desc) = 1""")
def _(b):
    m = raw_maps(b).withColumn("aspects", flt.drop_null_aspects(F.col("aspects")))
    return m.select("item_id", F.explode(extraction.drop_denied_in_map(F.col("aspects"), fv.DENIED_SOURCE_WORDS)).alias("name", "value"))


AMEND_SQL = f"""with {RAW_SQL}, denied as (select unnest({NAMES_SQL.replace('(', '[', 1)[:-1] + ']'}) as d),
  good as (select item_id, name, value from raw where value is not null and not exists (select 1 from denied where contains(lower(name), d))),
  maps as (select item_id, {PAIR_SQL} as aspects from good group by item_id),
  low as (select item_id, trim({without_denied('name')}) as name, trim({without_denied('value')}) as value, name as orig from good),
  clean_maps as (select item_id, {PAIR_SQL} as aspects_no_forbidden from (select * from low where name <> '' and value <> ''
    qualify row_number() over (partition by item_id, name order by orig desc) = 1) group by item_id)
  select l.item_id, {without_denied('d.item_desc')} as desc_no_forbidden, {without_denied('l.auct_titl')} as title_no_forbidden, coalesce(m.aspects, '') as aspects,
    coalesce(c.aspects_no_forbidden, '') as aspects_no_forbidden
  from v_listings l join v_desc d using (item_id) left join maps m using (item_id) left join clean_maps c using (item_id)"""


@query("str_08_amend", AMEND_SQL)
def _(b):
    items = b.v_listings.select("item_id", F.col("auct_titl").alias("title")).join(b.v_desc.select("item_id", "item_desc"), "item_id").join(raw_maps(b), "item_id")
    out = extraction.amend(items)
    return as_json(as_json(out, "aspects"), "aspects_no_forbidden").select("item_id", "desc_no_forbidden", "title_no_forbidden", "aspects", "aspects_no_forbidden")


AMENDED_SQL = f"""{EXTRACT_STEPS_SQL.replace(' limit 150', '')}, denied as (select unnest({NAMES_SQL.replace('(', '[', 1)[:-1] + ']'}) as d),
  good as (select * from low where not exists (select 1 from denied where contains(lower(name), d))),
  good_maps as (select item_id, auct_end_dt, {PAIR_SQL} as aspects from good group by all),
  plain as (select item_id, auct_end_dt, trim({without_denied('name')}) as name, trim({without_denied('value')}) as value, name as orig from good),
  plain_maps as (select item_id, auct_end_dt, {PAIR_SQL} as aspects_no_forbidden from (select * from plain where name <> '' and value <> ''
    qualify row_number() over (partition by item_id, auct_end_dt, name order by orig desc) = 1) group by all)
  select s.item_id, d.item_desc as "desc", coalesce({without_denied('d.item_desc')}, '') as desc_no_forbidden, {without_denied('s.auct_titl')} as title_no_forbidden,
    coalesce(g.aspects, '') as aspects, coalesce(p.aspects_no_forbidden, '') as aspects_no_forbidden
  from sampled s join maps m on s.item_id = m.item_id and s.auct_end_dt = m.auct_end_dt
  left join good_maps g on s.item_id = g.item_id and s.auct_end_dt = g.auct_end_dt left join plain_maps p on s.item_id = p.item_id and s.auct_end_dt = p.auct_end_dt
  left join (select * from v_desc where auct_end_dt between date '2024-01-05' and date '2024-01-25') d on d.item_id = s.item_id"""


@query("plan_02b_amended_items", AMENDED_SQL)
def _(b):
    out = extraction.amend(extracted(b, None))
    return as_json(as_json(out, "aspects"), "aspects_no_forbidden").select(
        "item_id", "desc", "desc_no_forbidden", "title_no_forbidden", "aspects", "aspects_no_forbidden")


@query("str_11_normalize")
def _(b):
    return b.documents.select("doc_id", tx.normalize(F.col("text")).alias("normalized"))


NORMAL = r"trim(regexp_replace(regexp_replace(lower({c}), '[!-/:-@\[-`{{-~]', '', 'g'), '\s+', ' ', 'g'))"


@query("str_12_contains_phrase", f"""select item_id, contains(' ' || {NORMAL.format(c='"desc"')} || ' ', ' ' || {NORMAL.format(c='signal')} || ' ') as found from v_signals""")
def _(b):
    return b.v_signals.select("item_id", tx.contains_phrase(F.col("desc"), F.col("signal")).alias("found"))


@query("str_13_title_case", r"""select doc_id, array_to_string(list_transform(list_zip(c, list_prepend(' ', c[:-2])),
  lambda z: case when regexp_matches(z[2], '\p{L}') then z[1] when z[1] = 'ß' then 'Ss' else upper(z[1]) end), '') as titled from (select doc_id, string_split(lower(text), '') as c from documents)""")
def _(b):
    return b.documents.select("doc_id", tx.title_case(F.col("text")).alias("titled"))


SPANS_SQL = """with toks as (select distinct item_id, lower("desc") as d, t from (select item_id, "desc", unnest(regexp_split_to_array(lower(signal), '[ ,:{{}}'']')) as t from v_signals) where t <> ''),
  parts as (select item_id, t, string_split(d, t) as p from toks),
  hits as (select item_id, t, unnest(range(1, len(p))) as i, p from parts)
  select item_id, t as token, (list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * length(t))::int as start from hits""".replace("{{", "{").replace("}}", "}")


@query("str_16_highlight_spans", SPANS_SQL)
def _(b):
    spans = b.v_signals.select("item_id", F.inline(tx.highlight_spans(F.col("desc"), F.col("signal"))).alias("start", "token"))
    return spans.select("item_id", "token", "start")


@query("str_17_highlight_html", r"""select item_id, case when len(list_filter(regexp_split_to_array(signal, '[ ,:{}'']'), lambda t: t <> '')) = 0 then title else
  regexp_replace(title, '(' || array_to_string(list_transform(list_sort(list_distinct(list_transform(list_filter(regexp_split_to_array(signal, '[ ,:{}'']'), lambda t: t <> ''),
    lambda t: [lpad((1000 - length(t))::varchar, 5, '0'), t]))), lambda x: regexp_escape(x[2])), '|') || ')', '<b>\1</b>', 'gi') end as marked from v_signals""")
def _(b):
    return b.v_signals.select("item_id", tx.highlight_html(F.col("title"), F.col("signal")).alias("marked"))


@query("str_18_escape_quotes", r"""select doc_id, '{"a": "b", "explanation": "The \"' || source || '\" of ' || lang || '"}' as fixed from documents""")
def _(b):
    raw = F.concat(F.lit('{"a": "b", "explanation": "The "'), F.col("source"), F.lit('" of '), F.col("lang"), F.lit('"}'))
    return b.documents.select("doc_id", tx.escape_inner_quotes(raw).alias("fixed"))


@query("str_19_truncate_words", f"select doc_id, array_to_string(({WORDS_SQL.format(c='text')})[1:800], ' ') as short from documents")
def _(b):
    return b.documents.select("doc_id", tx.truncate_words(F.col("text"), 800).alias("short"))


@query("str_20_word_count", f"select doc_id, len({WORDS_SQL.format(c='text')}) as n from documents")
def _(b):
    return b.documents.select("doc_id", tx.word_count(F.col("text")).cast("bigint").alias("n"))


@query("str_21_type_in_title", """select item_id, case when contains(lower(auct_titl),'bolt') then 'bolts'
   when contains(lower(auct_titl),'red') and contains(lower(auct_titl),'widget') then 'red widgets' when contains(lower(auct_titl),'gear') and contains(lower(auct_titl),'ring') then 'gears & rings'
   when contains(lower(auct_titl),'ring') then 'rings' when contains(lower(auct_titl),'valve') then 'valve' else 'unknown' end as type from v_listings""")
def _(b):
    from sigloom.registry.selection import TYPES
    return b.v_listings.select("item_id", tx.first_type_in_title(F.col("auct_titl"), TYPES).alias("type"))


@query("str_21b_types_from_table", """with types as (select min(p_partkey) as ord, split_part(p_name, ' ', 2) || 's & ' || p_brand as type from part where p_size < 20 group by all),
   stems as (select ord, type, list_transform(list_filter(string_split(lower(type), ' '), lambda w: w <> '&'), lambda w: case when w like '%s' then w[:-2] else w end) as words from types)
   select item_id, coalesce((select arg_min(type, ord) from stems s where len(list_filter(s.words, lambda w: not contains(lower(l.auct_titl), w))) = 0), 'unknown') as type from v_listings l""")
def _(b):
    types = (b.part.filter("p_size < 20").groupBy(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit("s & "), F.col("p_brand")).alias("type"))
                   .agg(F.min("p_partkey").alias("ord")))
    return it.types_from_table(b.v_listings.select("item_id", "auct_titl"), types, "auct_titl").select("item_id", "type")


# --- parsing ------------------------------------------------------------------------------------
DICT_SQL = """dicts as (select item_id, gen_text, regexp_extract(gen_text, '\\{(?:\\s*''[^'']*''\\s*:\\s*''[^'']*''\\s*,?|\\s*"[^"]*"\\s*:\\s*"[^"]*"\\s*,?)*\\}') as d from v_raw_output),
pairs as (select item_id, case when k[1] in ('''', '"') then k[2:-2] end as name, v[2:-2] as value from (
  select item_id, unnest(regexp_extract_all(d, '(''[^'']*''|"[^"]*")\\s*:\\s*(''[^'']*''|"[^"]*")', 1)) as k, unnest(regexp_extract_all(d, '(''[^'']*''|"[^"]*")\\s*:\\s*(''[^'']*''|"[^"]*")', 2)) as v from dicts)),
one as (select item_id, max(value) filter (name = 'characteristic') as c, max(value) filter (name = 'explanation') as e,
  max(value) filter (name = 'characteristic_1') as c1, max(value) filter (name = 'characteristic_2') as c2, max(value) filter (name = 'explanation_1') as e1 from pairs group by item_id)"""


@query("prs_01_first_dict", f"with {DICT_SQL} select item_id, name, value from pairs")
def _(b):
    return b.v_raw_output.select("item_id", F.explode(ps.first_dict(F.col("gen_text"))).alias("name", "value"))


@query("prs_02_single_signal", f"with {DICT_SQL} select r.item_id, coalesce({TITLE_SQL.format(c='c')}, '') as signal from v_raw_output r left join one using (item_id)")
def _(b):
    return b.v_raw_output.select("item_id", ps.single_signal(ps.first_dict(F.col("gen_text"))).alias("signal"))


@query("prs_03_many_signals", f"""with {DICT_SQL} select r.item_id, coalesce({TITLE_SQL.format(c='c1')}, '') as sig_1, coalesce({TITLE_SQL.format(c='c2')}, '') as sig_2, '' as sig_3,
  coalesce(e1, '') as exp_1, '' as exp_2, '' as exp_3 from v_raw_output r left join one using (item_id)""")
def _(b):
    parsed = b.v_raw_output.select("item_id", ps.signal_list(ps.first_dict(F.col("gen_text")), 3).alias("s"))
    return ps.wide_signals(parsed, "s", "sig", "exp", 3).drop("s")


@query("prs_03b_one_signal", f"with {DICT_SQL} select r.item_id, 1 as rank, coalesce({TITLE_SQL.format(c='c')}, '') as signal, coalesce(e, '') as explanation from v_raw_output r left join one using (item_id)")
def _(b):
    return b.v_raw_output.select("item_id", F.inline(ps.signal_list(ps.first_dict(F.col("gen_text")), 1)).alias("rank", "signal", "explanation"))


@query("prs_04_judge_json", """select item_id, case when item_id % 6 = 4 then regexp_extract(gen_text, '"signal_label": "([^"]*)"', 1) end as signal_label,
  case when item_id % 6 = 4 then regexp_extract(gen_text, '"reason": "([^"]*)"', 1) else '' end as reason, '' as explanation from v_raw_output where item_id % 6 in (4, 5)
  union all select item_id, null, '', case when item_id % 6 = 1 then regexp_extract(gen_text, '''explanation'': ''([^'']*)''', 1) else '' end from v_raw_output where item_id % 6 in (0, 1, 2, 3)""")
def _(b):
    j = b.v_raw_output.select("item_id", ps.judge_json(F.col("gen_text")).alias("j"))
    return j.select("item_id", "j.signal_label", "j.reason", "j.explanation")


@query("prs_05_label_digit", r"select item_id, try_cast(nullif(regexp_extract(judge_text, 'Label:\s*(\d)', 1), '') as int) as label from v_raw_output")
def _(b):
    return b.v_raw_output.select("item_id", ps.label_digit(F.col("judge_text")).alias("label"))


def label_list_sql(index):
    return rf"""list_filter(list_transform(string_split(regexp_extract_all(judge_text, 'Label[s]*:\s*([0-9,\s]+)', 1)[{index}], ','), lambda x: trim(x)), lambda x: regexp_matches(x, '^[0-9]+$'))"""


@query("prs_06_label_list", f"""select item_id, coalesce(array_to_string({label_list_sql(1)}, '|'), '') as first_match, coalesce(array_to_string({label_list_sql(-1)}, '|'), '') as last_match,
  coalesce({label_list_sql(1)}[1]::int, -1) as single from v_raw_output""")
def _(b):
    t = F.col("judge_text")
    text = lambda a: F.array_join(a.cast("array<string>"), "|")
    return b.v_raw_output.select("item_id", text(ps.label_list(t)).alias("first_match"), text(ps.label_list(t, last=True)).alias("last_match"),
                                 ps.first_label(ps.label_list(t)).alias("single"))


UNGROUP_SQL = r"list_filter(list_transform(string_split(grouped_signals, chr(10)), lambda s: trim(regexp_replace(trim(s), '^\d+\.\s*', ''))), lambda s: s <> '')"


@query("prs_07_ungroup_lines", f"select item_id, signal from (select item_id, unnest({UNGROUP_SQL}) as signal from v_raw_output)")
def _(b):
    return b.v_raw_output.select("item_id", F.explode(ps.ungroup_lines(F.col("grouped_signals"))).alias("signal"))


@query("prs_08_as_list", "select doc_id, case when doc_id % 3 = 0 then 0 else 1 end as n from documents")
def _(b):
    arr = F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("array<int>")).otherwise(F.array(F.lit(7)))
    return b.documents.select("doc_id", F.size(ps.as_list(arr)).alias("n"))


JUDGED_SQL = f"""judged as (select item_id, {UNGROUP_SQL} as sigs, grouped_signals, case when not contains(grouped_signals, chr(10)) and len({label_list_sql(1)}) > 1 then {label_list_sql(1)}[1:1]
  else coalesce({label_list_sql(1)}, []) end as labels from v_raw_output)"""


def judged(b):
    t = b.v_raw_output.select("item_id", "grouped_signals", ps.label_list(F.col("judge_text")).alias("pred_score"))
    t = t.withColumn("pred_score", ps.keep_first_label_of_single(F.col("grouped_signals"), F.col("pred_score")))
    return t.withColumn("can_explode", ps.can_explode(F.col("grouped_signals"), F.col("pred_score")))


@query("prs_09_explode_predictions", f"with {JUDGED_SQL} select item_id, unnest(sigs) as signal, unnest(labels)::int as label from judged where len(sigs) = len(labels)")
def _(b):
    return ps.explode_predictions(judged(b))


@query("prs_10_first_label_of_single", f"with {JUDGED_SQL} select item_id, array_to_string(labels, '|') as labels, case when coalesce(len(sigs), 0) = len(labels) then 1 else 0 end as can_explode from judged")
def _(b):
    return judged(b).select("item_id", F.array_join(F.col("pred_score").cast("array<string>"), "|").alias("labels"), "can_explode")


@query("prs_11_numbered_values", """select item_id, unnest(regexp_extract_all(gen_text, '"characteristic_\\d+":\\s*"([^"]*)"', 1)) as signal from v_raw_output""")
def _(b):
    return b.v_raw_output.select("item_id", F.explode(ps.numbered_values(F.col("gen_text"))).alias("signal"))


@query("prs_12_reparse_missing", f"""with {DICT_SQL} select r.item_id, {TITLE_SQL.format(c='c')} as signal_m from v_raw_output r join one using (item_id) where c <> ''""")
def _(b):
    df = b.v_raw_output.select("item_id", F.col("gen_text").alias("text_m"), F.lit("").alias("signal_m"))
    return ps.reparse_missing(df, ["m"]).select("item_id", "signal_m")


@query("prs_13_long_signals", """select item_id, title, 1 as rank, sig_1 as signal, exp_1 as explanation from v_wide where sig_1 <> ''
  union all select item_id, title, 2, sig_2, exp_2 from v_wide where sig_2 <> '' union all select item_id, title, 3, sig_3, exp_3 from v_wide where sig_3 <> ''""")
def _(b):
    return ps.long_signals(b.v_wide, "item_id", ["title"], "sig", "exp")


@query("prs_14_dict_text", "select doc_id, 'lang' as name, lang as value from documents union all select doc_id, 'source', source from documents")
def _(b):
    raw = F.concat(F.lit("{'lang': '"), F.col("lang"), F.lit("', 'source': '"), F.col("source"), F.lit("'}"))
    return b.documents.select("doc_id", F.explode(ps.dict_text(raw)).alias("name", "value"))


@query("prs_15_feature_value", """select item_id, nullif(regexp_extract(gen_text, '"feature":\\s*"([^"]+)"', 1), '') as feature from v_raw_output""")
def _(b):
    return b.v_raw_output.select("item_id", ps.feature_value(F.col("gen_text")).alias("feature"))


@query("arr_01_array_functions", f"""with t as (select doc_id, {WORDS_SQL.format(c='lower(text)')} as w from documents)
  select doc_id, len(w) as n, len(list_distinct(w)) as distinct_n, array_to_string(w[2:4], ' ') as slice, len(list_filter(list_distinct(w), lambda x: x not in ('the', 'le', 'der'))) as others,
    len(list_filter(list_distinct(w), lambda x: x in ('the', 'le', 'der'))) as shared from t""")
def _(b):
    w = b.documents.select("doc_id", tx.words(F.lower("text")).alias("w"))
    stop = F.array(F.lit("the"), F.lit("le"), F.lit("der"))
    return w.select("doc_id", F.size("w").cast("bigint").alias("n"), F.size(F.array_distinct("w")).cast("bigint").alias("distinct_n"),
                    F.array_join(F.slice("w", 2, 3), " ").alias("slice"), F.size(F.array_except("w", stop)).cast("bigint").alias("others"),
                    F.size(F.array_intersect("w", stop)).cast("bigint").alias("shared"))


@query("map_01_map_functions", f"with {RAW_SQL} select item_id, count(*) as keys, count(*) filter (value is not null) as filled, max(upper(value)) filter (name = 'Brand') as brand from raw group by item_id")
def _(b):
    m = raw_maps(b)
    upper = F.transform_values("aspects", lambda k, v: F.upper(v))
    return m.select("item_id", F.size(F.map_keys("aspects")).cast("bigint").alias("keys"),
                    F.size(F.map_filter("aspects", lambda k, v: v.isNotNull())).cast("bigint").alias("filled"),
                    F.try_element_at(upper, F.lit("Brand")).alias("brand"))
