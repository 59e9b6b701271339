"""Queries for cleaning, matching, quality rules and reports."""

from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.functions import text as tx
from sigloom.operators import heuristics as heu
from sigloom.operators import match, report
from sigloom.operators.ordering import explode_once
from sigloom.plans import evaluation
from sigloom.registry.core import query
from sigloom.sources.folders import new_folder


def clean_sql(c):
    return f"trim(regexp_replace(lower(regexp_replace(coalesce({c}, ''), '[^a-zA-Z0-9 x./]', ' ', 'g')), '\\s+', ' ', 'g'))"


CLEANED_SQL = f"""cleaned as (select * from (select item_id, {clean_sql('signal')} as signal, {clean_sql('title')} as title,
  {clean_sql('aspects')} as aspects, {clean_sql('"desc"')} as "desc", signal as signal_orig from v_signals) where signal <> '')"""

MATCH_SQL = f"""{CLEANED_SQL},
base as (select *, list_filter(string_split(signal, ' '), lambda w: len(w) > 1) as gw from cleaned),
cols as (select item_id, gw, signal, unnest([0, 1, 2]) as ci, unnest(['title', 'aspects', 'desc']) as cn, unnest([title, aspects, "desc"]) as txt from base),
coltext as (select *, array_to_string(list_filter(string_split(txt, ' '), lambda w: len(w) > 1), ' ') as ct from cols),
perms as (select item_id, gw, []::bigint[] as used, '' as p from base
  union all select item_id, gw, list_append(used, i), case when p = '' then gw[i] else p || ' ' || gw[i] end
  from (select *, unnest(range(1, len(gw) + 1)) as i from perms) where not list_contains(used, i)),
orders as (select distinct item_id, p from perms where len(used) = len(gw)),
exact as (select item_id, ci, cn, contains(txt, signal) as hit from cols),
perm as (select c.item_id, c.ci, c.cn, bool_or(contains(c.ct, o.p)) as hit from coltext c join orders o using (item_id) group by all),
grams as (select distinct item_id, array_to_string(gw[i:i + s - 1], ' ') as g, s from
  (select *, unnest(range(1, len(gw) - s + 2)) as i from (select *, unnest(range(2, len(gw))) as s from base where len(gw) > 2))),
hits as (select c.item_id, c.ci, c.cn, g.g, g.s from coltext c join grams g using (item_id) where contains(' ' || c.ct || ' ', ' ' || g.g || ' ')),
other as (select c.item_id, c.ci, bool_and(contains(' ' || c.ct || ' ', ' ' || w.w || ' ')
    or exists (select 1 from hits h where h.item_id = c.item_id and h.ci = c.ci and list_contains(string_split(h.g, ' '), w.w))) as rest
  from coltext c join (select item_id, unnest(gw) as w from base where len(gw) > 1) w using (item_id) group by all),
per_col as (select h.item_id, h.ci, h.cn, count(*) as n, max(h.s) as longest from hits h group by all),
scored as (select p.*, case when o.rest then 1000 else 0 end + longest as score from per_col p join other o using (item_id, ci)),
best as (select item_id, cn from scored qualify row_number() over (partition by item_id order by score desc, n desc, ci) = 1),
first_exact as (select item_id, cn from exact where hit qualify row_number() over (partition by item_id order by ci) = 1),
first_perm as (select item_id, cn from perm where hit qualify row_number() over (partition by item_id order by ci) = 1),
matched as (select b.item_id, b.signal, b.signal_orig, b.title, b.aspects, b."desc",
  case when e.cn is not null then 'exact' when p.cn is not null then 'permutation'
       when t.cn is not null and o.any_rest then 'ngram+non ngram' when t.cn is not null then 'ngram' else 'no_match' end as match_type,
  coalesce(e.cn, p.cn, t.cn) as match_column,
  case when e.cn is null and p.cn is null and t.cn is not null then (select count(*) from hits h where h.item_id = b.item_id)
       / (select count(*) from grams g where g.item_id = b.item_id)::double else 0.0::double end as ngram_coverage,
  coalesce(e.cn is null and p.cn is null and o.any_rest, false) as non_ngram_match
  from base b left join first_exact e using (item_id) left join first_perm p using (item_id) left join best t using (item_id)
  left join (select item_id, bool_or(rest) as any_rest from other group by item_id) o using (item_id))"""
MATCH = "with recursive " + MATCH_SQL


def cleaned(b):
    return evaluation.clean_columns(b.v_signals.select("item_id", "signal", "title", "aspects", "desc"), evaluation.TEXT_COLUMNS,
                                    {"signal": "signal_orig"})


def matched(b):
    return match.ground(cleaned(b))


def flagged(b, how=None):
    return heu.apply_rules(matched(b), how)


# --- cleaning ----------------------------------------------------------------------------------
@query("str_01_clean", f'select item_id, {clean_sql(chr(34) + "desc" + chr(34))} as cleaned from v_signals')
def _(b):
    return b.v_signals.select("item_id", tx.clean(F.col("desc")).alias("cleaned"))


@query("str_02_clean_columns", f'with {CLEANED_SQL} select * from cleaned')
def _(b):
    return cleaned(b)


# --- matching ------------------------------------------------------------------------------------
@query("mat_01_exact", MATCH + "select item_id, cn as source from exact where hit")
def _(b):
    rows = F.array(*[F.when(match.exact_match(F.col("signal"), F.col(c)), F.lit(c)) for c in match.SOURCES])
    return cleaned(b).select("item_id", F.explode(F.array_compact(rows)).alias("source"))


@query("mat_02_permutation", MATCH + "select item_id, cn as source from perm where hit")
def _(b):
    tokens = lambda c: F.filter(tx.words(F.col(c)), lambda w: F.length(w) > 1)
    rows = F.array(*[F.when(match.permutation_match(tokens("signal"), tokens(c)), F.lit(c)) for c in match.SOURCES])
    return cleaned(b).select("item_id", F.explode(F.array_compact(rows)).alias("source"))


@query("mat_03_ngrams", MATCH + """select h.item_id, h.g as gram, count(*) as columns_hit from hits h join matched m using (item_id)
  where m.match_type like 'ngram%' group by all""")
def _(b):
    pairs = explode_once(matched(b), ["item_id"], F.map_entries("ngram_match_counts"), "pair")
    return pairs.select("item_id", F.col("pair.key").alias("gram"), F.col("pair.value").alias("columns_hit"))


@query("mat_04_other_words", MATCH + "select item_id, non_ngram_match from matched")
def _(b):
    return matched(b).select("item_id", "non_ngram_match")


@query("mat_05_best_column", MATCH + "select item_id, match_column from matched where match_type like 'ngram%'")
def _(b):
    return matched(b).filter(F.col("match_type").startswith("ngram")).select("item_id", "match_column")


@query("mat_06_coverage", MATCH + "select item_id, round(ngram_coverage, 6) as ngram_coverage from matched")
def _(b):
    return matched(b).select("item_id", F.round("ngram_coverage", 6).alias("ngram_coverage"))


@query("mat_07_match_type", MATCH + "select item_id, signal, match_type, match_column, non_ngram_match from matched")
def _(b):
    return matched(b).select("item_id", "signal", "match_type", "match_column", "non_ngram_match")


NO_PUNCT = r"regexp_replace(lower({c}), '[!-/:-@\[-`{{-~]', '', 'g')"
SENTENCES_SQL = r"string_split(regexp_replace(trim({c}), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"
ALL_TEXT_SQL = """concat_ws(' ', title, aspects, "desc")"""
IN_SENTENCE_SQL = f"""in_sentence as (select s.item_id, bool_or(coalesce(len(list_filter(s.sw, lambda w: not contains(' ' || trim(regexp_replace(
    {NO_PUNCT.format(c='t.sent')}, '\\s+', ' ', 'g')) || ' ', ' ' || w || ' '))) = 0, false)) as in_text
  from (select item_id, list_filter(regexp_split_to_array({NO_PUNCT.format(c='signal')}, '\\s+'), lambda w: w <> '') as sw, {ALL_TEXT_SQL} as txt from v_signals) s,
  lateral (select unnest({SENTENCES_SQL.format(c='s.txt')}) as sent) t where t.sent <> '' group by s.item_id)"""


@query("mat_08_in_one_sentence", f"with {IN_SENTENCE_SQL} select item_id, in_text from in_sentence")
def _(b):
    return b.v_signals.select("item_id", match.in_one_sentence(F.col("signal"), match.all_text()).alias("in_text"))


@query("mat_09_in_text", f"""select item_id, contains({NO_PUNCT.format(c=ALL_TEXT_SQL)}, {NO_PUNCT.format(c='signal')}) as in_text from v_signals""")
def _(b):
    return b.v_signals.select("item_id", match.in_text(F.col("signal"), match.all_text()).alias("in_text"))


def two_models(b):
    first = b.v_signals.select("item_id", "title", "aspects", "desc", F.col("signal").alias("signal_a"), F.lit("").alias("text_a"))
    second = b.v_raw_output.select("item_id", F.lit("").alias("signal_b"), F.col("gen_text").alias("text_b"))
    return match.align_models(first, second, ["signal_b", "text_b"])


DENIED_LIST_SQL = "[" + ", ".join("'" + w.lower() + "'" for w in fv.DENIED_SOURCE_WORDS) + "]"
TITLE_SQL = r"""array_to_string(list_transform(range(1, len({c}) + 1), lambda i: case when i = 1 or not regexp_matches(substr({c}, i - 1, 1), '\p{{L}}')
  then upper(substr({c}, i, 1)) else lower(substr({c}, i, 1)) end), '')"""
SIGNAL_B_SQL = f"""sb as (select item_id, coalesce({TITLE_SQL.format(c='raw')}, '') as signal_b from (select item_id, case item_id % 6
  when 1 then regexp_extract(gen_text, '''characteristic'': ''([^'']*)''', 1) when 2 then regexp_extract(gen_text, '"characteristic": "([^"]*)"', 1)
  when 3 then 'first' else '' end as raw from v_raw_output))"""
CURATED_SQL = f"""{IN_SENTENCE_SQL}, {SIGNAL_B_SQL},
denied as (select unnest({DENIED_LIST_SQL}) as d),
sb_sent as (select s.item_id, bool_or(coalesce(len(list_filter(s.sw, lambda w: not contains(' ' || trim(regexp_replace(
    {NO_PUNCT.format(c='t.sent')}, '\\s+', ' ', 'g')) || ' ', ' ' || w || ' '))) = 0, false)) as in_text
  from (select item_id, list_filter(regexp_split_to_array({NO_PUNCT.format(c='signal_b')}, '\\s+'), lambda w: w <> '') as sw, {ALL_TEXT_SQL} as txt
        from v_signals join sb using (item_id)) s,
  lateral (select unnest({SENTENCES_SQL.format(c='s.txt')}) as sent) t where t.sent <> '' group by s.item_id),
curated as (select v.item_id, v.signal as signal_a, sb.signal_b, case when v.signal = '' or sb.signal_b = '' then 'unparsed'
   when exists (select 1 from denied where contains(lower(v.signal), d)) and exists (select 1 from denied where contains(lower(sb.signal_b), d)) then 'denied_words'
   when not (i.in_text or j.in_text) then 'not_in_sentence' end as reject_reason
  from v_signals v join sb using (item_id) join in_sentence i using (item_id) join sb_sent j using (item_id))"""


@query("mat_10_curate", f"with {CURATED_SQL} select item_id, signal_a, signal_b, reject_reason from curated")
def _(b):
    return match.curate(two_models(b), ["a", "b"]).select("item_id", "signal_a", "signal_b", "reject_reason")


@query("plan_05_two_model_curation", f"with {CURATED_SQL} select coalesce(reject_reason, 'kept') as outcome, count(*) as n from curated group by all")
def _(b):
    done = match.curate(two_models(b), ["a", "b"])
    return done.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


@query("str_10_denied_substring", f"""with {SIGNAL_B_SQL}, denied as (select unnest({DENIED_LIST_SQL}) as d)
  select v.item_id, not exists (select 1 from denied where contains(lower(v.signal), d)) and not exists (select 1 from denied where contains(lower(sb.signal_b), d)) as valid
  from v_signals v join sb using (item_id)""")
def _(b):
    from sigloom.functions.parse import reparse_missing
    both = reparse_missing(two_models(b).withColumn("text_a", F.lit("")), ["a", "b"], drop_empty=False)
    return match.without_denied_words(both, ["a", "b"], "all").select("item_id", "valid")


@query("jon_10_align_models", f"select v.item_id, v.signal, r.gen_text from v_signals v join v_raw_output r using (item_id)")
def _(b):
    return match.align_models(b.v_signals.select("item_id", "signal"), b.v_raw_output, ["gen_text"])


@query("jon_10b_alignment_gaps", """select item_id, 'second' as missing_in from v_signals where item_id not in (select doc_id from labels)
  union all select doc_id, 'first' from labels where doc_id not in (select item_id from v_signals)""")
def _(b):
    return match.alignment_gaps(b.v_signals.select("item_id"), b.labels.select(F.col("doc_id").alias("item_id")))


# --- rules --------------------------------------------------------------------------------------------
def rx(p):
    return p.replace("'", "''")


def any_sql(c, patterns, prefix=""):
    return "(" + " or ".join(f"regexp_matches({c}, '{prefix}{rx(p)}')" for p in patterns) + ")"


WORDS_SQL = r"list_filter(regexp_split_to_array(trim({c}), '\s+'), lambda w: w <> '')"
FLAT_SQL = r"regexp_replace(trim(regexp_replace(signal, '\s+', ' ', 'g')), '\b(\d+)\s0+\b', '\1', 'g')"
DENIED_SIGNAL_SQL = "[" + ", ".join("'" + w.lower() + "'" for w in fv.denied_signal_words()) + "]"
REPEATED_SQL = f"""case when {any_sql('signal', fv.REPEAT_ACCEPT, '(?i)')} then 0 when {any_sql('signal', fv.REPEAT_REJECT, '(?i)')} then 1
  when (select count(*) from (select t, count(*) over (partition by t) as n from (select unnest(list_filter({WORDS_SQL.format(c='lower(signal)')},
     lambda w: not regexp_matches(w, '{rx(fv.REPEAT_IGNORED_TOKEN)}'))) as t)) where n > 1) > 2 then 1 else 0 end"""
FORBIDDEN_SQL = f"""case when exists (select 1 from (select unnest({DENIED_SIGNAL_SQL}) as d) where regexp_matches(lower(signal), '\\b' || d || '\\b')) then 1 else 0 end"""
HAS_NUMBER_SQL = f"case when len(list_filter({WORDS_SQL.format(c='signal')}, lambda w: regexp_matches(w, '^[0-9]+$'))) > 0 then 1 else 0 end"
NUM_TOKENS_SQL = WORDS_SQL.format(c=FLAT_SQL)
DOMINANT_SQL = f"""case when {any_sql(FLAT_SQL, fv.NUMERIC_EXEMPT)} then 0 when len({NUM_TOKENS_SQL}) <= 2 then 0
  when len(list_filter({NUM_TOKENS_SQL}, lambda w: regexp_matches(w, '{fv.NUMERIC_TOKEN}'))) >= len({NUM_TOKENS_SQL}) / 2.0
    or len(list_filter({NUM_TOKENS_SQL}, lambda w: regexp_matches(w, '{fv.NUMERIC_TOKEN}'))) > 2 then 1 else 0 end"""
# RE2 has no look-ahead and no back-reference: those four shapes are written out as SQL.
_PLAIN_REJECT = [p for i, p in enumerate(fv.NUMBER_REJECT) if i not in (0, 4, 8, 12)]
_TOK = f"regexp_extract_all({FLAT_SQL}, '\\w+')"
_REPEAT_CHAR = r"\b(?:" + "|".join(f"{c}\\s(?:{c}\\s){{1,3}}" for c in "abcdefghijklmnopqrstuvwxyz0123456789_") + r")\w{2,}\b"
EXCLUDE_SQL = f"""case when {any_sql(FLAT_SQL, fv.NUMBER_ACCEPT)} then 0
  when {any_sql(FLAT_SQL, _PLAIN_REJECT)} or regexp_matches({FLAT_SQL}, '(\\b\\d+\\b.*){{4,}}')
    or len(list_filter({_TOK}, lambda w, i: regexp_matches(w, '^\\d{{5,}}$') and not (i = len({_TOK}) and regexp_matches(w, '^\\d{{1,2}}0{{3,}}$') and ends_with({FLAT_SQL}, w))
         and len(list_intersect({_TOK}[i + 1:], ['hours', 'watts', 'capacity', 'volts'])) = 0)) > 0
    or regexp_matches({FLAT_SQL}, '{_REPEAT_CHAR}')
    or (regexp_matches({FLAT_SQL}, '\\d+\\s*x\\s*\\d+\\s*(?:in|inches|x)\\b') and not regexp_matches(regexp_extract({FLAT_SQL}, '^.*\\d+\\s*x\\s*\\d+\\s*(?:in|inches|x)\\b(.*)$', 1),
         '\\b(?:size|photo|frame|poster|mat|bench|door|print|warranty|set|colors|lighter|faster|stronger)\\b'))
  then 1 else 0 end"""
FLAG_SQL = {
    "no_match": "case when match_type = 'no_match' then 1 else 0 end",
    "title_exact": "case when match_column = 'title' and match_type = 'exact' then 1 else 0 end",
    "repeated_words": REPEATED_SQL, "forbidden_words": FORBIDDEN_SQL, "has_number": HAS_NUMBER_SQL,
    "numerically_dominant": DOMINANT_SQL, "numbers_to_exclude_by_pattern": EXCLUDE_SQL}
FLAGGED_SQL = MATCH_SQL + ", flagged as (select *, " + ", ".join(f"{sql} as {n}" for n, sql in FLAG_SQL.items()) + " from matched)"
FLAGGED = "with recursive " + FLAGGED_SQL


def rule_query(name, flag, fn):
    base = "matched" if flag in ("no_match", "title_exact") else "cleaned"
    head = MATCH if base == "matched" else f"with {CLEANED_SQL} "

    @query(name, f"{head}select item_id, signal, {FLAG_SQL[flag]} as {flag} from {base}")
    def _(b):
        df = matched(b) if base == "matched" else cleaned(b)
        return df.select("item_id", "signal", fn().alias(flag))


rule_query("heu_01_no_match", "no_match", heu.no_match)
rule_query("heu_02_title_exact", "title_exact", heu.title_exact)
rule_query("heu_03_repeated_words", "repeated_words", lambda: heu.repeated_words(F.col("signal")))
rule_query("heu_04_forbidden_words", "forbidden_words", lambda: heu.forbidden_words(F.col("signal")))
rule_query("heu_05_has_number", "has_number", lambda: heu.has_number(F.col("signal")))
rule_query("heu_06_numerically_dominant", "numerically_dominant", lambda: heu.numerically_dominant(F.col("signal")))
rule_query("heu_07_numbers_to_exclude", "numbers_to_exclude_by_pattern", lambda: heu.numbers_to_exclude(F.col("signal")))


@query("heu_08_numbers_to_keep", f"with {CLEANED_SQL} select item_id, case when {any_sql('signal', fv.NUMBER_KEEP)} then 0 else 1 end as numbers_to_keep from cleaned")
def _(b):
    return cleaned(b).select("item_id", heu.numbers_to_keep(F.col("signal")).alias("numbers_to_keep"))


@query("str_09_whole_word_denied", f"""select item_id, case when exists (select 1 from (select unnest({DENIED_SIGNAL_SQL}) as d)
  where regexp_matches(lower("desc"), '\\b' || d || '\\b')) then 1 else 0 end as forbidden_words from v_signals""")
def _(b):
    return b.v_signals.select("item_id", heu.forbidden_words(F.col("desc")).alias("forbidden_words"))


@query("heu_09_apply_rules", FLAGGED + "select item_id, " + ", ".join(FLAG_SQL) + ", " + " + ".join(FLAG_SQL) + " as sum_exclusions_by_how, "
       + " + ".join(FLAG_SQL) + " as sum_exclusions_strict from flagged")
def _(b):
    return flagged(b).select("item_id", *FLAG_SQL, "sum_exclusions_by_how", "sum_exclusions_strict")


RULES_SUM = " + ".join(fv.RULE_FLAGS)


@query("heu_10_split", FLAGGED + f"select case when {RULES_SUM} = 0 then 'kept' else 'excluded' end as part, item_id from flagged")
def _(b):
    df = flagged(b, fv.RULE_FLAGS)
    return heu.kept(df).select(F.lit("kept").alias("part"), "item_id").unionByName(heu.excluded(df).select(F.lit("excluded").alias("part"), "item_id"))


@query("plan_04_evaluate", FLAGGED + f"""select item_id, signal, signal_orig, match_type, match_column, {', '.join(fv.RULE_FLAGS)}, {RULES_SUM} as sum_exclusions_by_how
  from flagged where {RULES_SUM} = 0""")
def _(b):
    src = b.v_signals.select("item_id", "signal", "title", "aspects", "desc")
    return heu.kept(evaluation.evaluate(src)).select("item_id", "signal", "signal_orig", "match_type", "match_column", *fv.RULE_FLAGS, "sum_exclusions_by_how")


# --- reports ------------------------------------------------------------------------------------------------
@query("agg_09_match_summary", MATCH + """select match_type as value, count(*) as n, round_even(count(*) / sum(count(*)) over ()::double * 100, 1) as percent from matched group by 1
  union all select 'Total Rows', count(*), 100.0 from matched""")
def _(b):
    return report.value_counts(matched(b), "match_type")


@query("agg_09b_counts_by_group", "select lang, source, count(*) as n, sum(count(*)) over (partition by lang)::bigint as group_n, round_even(count(*) / (sum(count(*)) over (partition by lang))::double * 100, 1) as percent from v_signals group by 1, 2")
def _(b):
    return report.value_counts_by(b.v_signals, "lang", "source")


@query("agg_10_exclusion_summary", FLAGGED + f""", one as (select {', '.join(f'sum({f})::bigint as {f}' for f in fv.RULE_FLAGS)}, count(*) filter ({RULES_SUM} >= 1) as sum_exclusions_by_how from flagged)
  select flag, n, round_even(n / (select sum_exclusions_by_how from one)::double * 100, 1) as percent from (unpivot one on columns(*) into name flag value n)""")
def _(b):
    return report.exclusion_summary(flagged(b, fv.RULE_FLAGS), fv.RULE_FLAGS)


WORDS_FREQ_SQL = r"""wf as (select word, count(*) as n from (select unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))) as word from documents) group by word)"""


@query("agg_11_word_frequency", f"""with {WORDS_FREQ_SQL} select word, n, round(n / (select sum(n) from wf)::double, 9) as token_density,
  floor(n / (select sum(n) from wf)::double * 10000) / 100 as token_density_pct, round(n / (select count(*) from documents)::double, 9) as row_density,
  floor(n / (select count(*) from documents)::double * 10000) / 100 as row_density_pct from wf""")
def _(b):
    wf = report.word_frequency(b.documents, "text")
    return wf.withColumns({c: F.round(c, 9) for c in ("token_density", "row_density")})


@query("top_03_frequent_words", f"with {WORDS_FREQ_SQL} select word, n from wf order by n desc, word limit 50")
def _(b):
    return report.top_words(b.documents, "text", 50).select("word", "n")


@query("mth_01_percent_truncated", f"""with {WORDS_FREQ_SQL} select word, floor(n / (select sum(n) from wf)::double * 10000) / 100 as pct from wf""")
def _(b):
    return report.word_frequency(b.documents, "text").select("word", F.col("token_density_pct").alias("pct"))


@query("agg_12_denied_word_counts", "with w as (select distinct unnest([" + ", ".join(f"'{x}'" for x in fv.DENIED_SOURCE_WORDS) + """]) as word)
  select word, (select count(*) from documents where contains(lower(text), word)) as n from w""")
def _(b):
    return report.denied_word_counts(b.documents, "text")


@query("agg_13_share_matching", r"select avg(case when regexp_matches(text, '(^|[^\p{L}])(the|le|der)([^\p{L}]|$)') then 1 else 0 end) as share from documents")
def _(b):
    return report.share_matching(b.documents, "text", r"(^|[^\p{L}])(the|le|der)([^\p{L}]|$)")


@query("agg_14_text_statistics", r"""select round_even(avg(length(title) + length(aspects) + length("desc")), 1) as avg_chars,
  round_even(avg(len(list_filter(regexp_split_to_array(trim(title), '\s+'), lambda w: w <> '')) + len(list_filter(regexp_split_to_array(trim(aspects), '\s+'), lambda w: w <> ''))
     + len(list_filter(regexp_split_to_array(trim("desc"), '\s+'), lambda w: w <> ''))), 1) as avg_tokens from v_signals""")
def _(b):
    return report.text_statistics(b.v_signals, ["title", "aspects", "desc"])


@query("agg_14b_statistics_by_column", r"""select 'text' as "column", round_even(avg(length(text)), 1) as avg_chars,
  round_even(avg(len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda w: w <> ''))), 1) as avg_tokens from documents
  union all select 'source', round_even(avg(length(source)), 1), round_even(avg(len(list_filter(regexp_split_to_array(trim(source), '\s+'), lambda w: w <> ''))), 1) from documents""")
def _(b):
    return report.text_statistics_by_column(b.documents, ["text", "source"])


FUNNEL_SQL = """with s as (select lang = 'en' as a, length(text) > 500 as b, doc_id % 2 = 0 as c from documents)
  select 0 as step, 'start' as name, count(*) as n, 100.0::double as percent from s
  union all select 1, 'english', count(*) filter (a), round(count(*) filter (a) / count(*)::double * 100, 2) from s
  union all select 2, 'long', count(*) filter (a and b), round(count(*) filter (a and b) / count(*)::double * 100, 2) from s
  union all select 3, 'even', count(*) filter (a and b and c), round(count(*) filter (a and b and c) / count(*)::double * 100, 2) from s"""


def funnel_steps():
    return {"english": F.col("lang") == "en", "long": F.length("text") > 500, "even": F.col("doc_id") % 2 == 0}


@query("agg_21b_funnel", FUNNEL_SQL)
def _(b):
    return report.funnel(b.documents, funnel_steps())


@query("agg_21d_funnel_on_write", FUNNEL_SQL)
def _(b):
    folder = new_folder(b.spark, "funnel")
    return report.funnel_on_write(b.documents, funnel_steps(), lambda df: df.write.parquet(folder))


@query("agg_22_vocabulary", r"""select distinct word from (select unnest(list_filter(regexp_split_to_array(trim(concat_ws(' ', text, source)), '\s+'), lambda w: w <> '')) as word from documents)""")
def _(b):
    return report.vocabulary(b.documents, ["text", "source"])


@query("agg_23_set_overlap", """select (select count(distinct item_id) from v_views where item_id in (select item_id from v_ledger)) as both,
  (select count(distinct item_id) from v_views where item_id not in (select item_id from v_ledger)) as only_left,
  (select count(distinct item_id) from v_ledger where item_id not in (select item_id from v_views)) as only_right""")
def _(b):
    return report.set_overlap(b.v_views, b.v_ledger, "item_id")


@query("agg_24_column_health", """select avg(case when sig_3 is null then 1 else 0 end) as null_share, avg(case when sig_1 is not distinct from sig_2 then 1 else 0 end) as agree_share,
  avg(case when sig_2 = '' then 1 else 0 end) as flag_mean from v_wide""")
def _(b):
    return report.column_health(b.v_wide, "sig_3", ("sig_1", "sig_2"), F.col("sig_2") == "")


@query("srt_01_sorted_counts", "select source, count(*) as n from documents group by source order by n desc, source")
def _(b):
    return b.documents.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "source")


@query("top_04_frequent_tokens", r"""with toks as (select item_id, unnest(regexp_extract_all(lower(signal), '[\p{L}\p{N}_]+')) as word, unnest(range(1, len(regexp_extract_all(lower(signal), '[\p{L}\p{N}_]+')) + 1)) as pos from v_signals),
  freq as (select word, count(distinct item_id) as n from toks group by word),
  ranked as (select item_id, word, row_number() over (partition by item_id order by n desc, pos) as r from toks join freq using (word))
  select v.item_id, max(word) filter (r = 1) as token1, max(word) filter (r = 2) as token2, max(word) filter (r = 3) as token3
  from v_signals v left join ranked using (item_id) group by v.item_id""")
def _(b):
    return report.frequent_tokens(b.v_signals, "item_id", "signal", stem=False)
