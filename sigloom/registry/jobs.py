"""Queries for unions, chats, text functions, sinks and export."""

import json

from pyspark.sql import functions as F

from sigloom.operators import chat, filters
from sigloom.operators import infer
from sigloom.operators import items as it
from sigloom.operators import report
from sigloom.operators.ordering import stored
from sigloom.plans import judging
from sigloom.plans.generation import generate
from sigloom.registry.core import query
from sigloom.registry.people import h
from sigloom.registry.grounding import TITLE_SQL
from sigloom.registry.selection import LATEST_SQL
from sigloom.sources import export as ex
from sigloom.sources import readers, writers
from sigloom.sources.folders import new_folder
from sigloom.sources.tables import ANNOTATION_SCHEMA


def scratch(b, name):
    return new_folder(b.spark, name)


# --- unions ---------------------------------------------------------------------------------
@query("set_01_union", "select item_id, sig_1 as signal from v_wide union all select item_id, sig_2 from v_wide")
def _(b):
    return b.v_wide.select("item_id", F.col("sig_1").alias("signal")).unionByName(b.v_wide.select(F.col("sig_2").alias("signal"), "item_id"))


@query("set_02_stitch_runs", "select doc_id, text, case when lang <> 'en' then 'late' else 'early' end as run from documents where lang in ('en', 'fr') or lang <> 'en'")
def _(b):
    early = b.documents.filter("lang in ('en', 'fr')").select("doc_id", "text", F.lit("early").alias("run"))
    late = b.documents.filter("lang <> 'en'").select("doc_id", "text", F.lit("late").alias("run"))
    return infer.stitch_runs([early, late], "doc_id")


@query("set_03_except_all", """(select event_type, user_id % 5 as u from events except all select event_type, user_id % 7 from events)
  union all (select event_type, user_id % 7 from events except all select event_type, user_id % 5 from events)""")
def _(b):
    x = b.events.select("event_type", (F.col("user_id") % 5).alias("u"))
    y = b.events.select("event_type", (F.col("user_id") % 7).alias("u"))
    return x.exceptAll(y).unionByName(y.exceptAll(x))


@query("set_04_dedupe", "select user_id, event_type, min(event_id) as event_id from events group by 1, 2")
def _(b):
    return b.events.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))


@query("set_04b_first_in_order", """select user_id, event_type, event_id, ts, value from events
  qualify row_number() over (partition by user_id, event_type order by value desc nulls last, ts, event_id) = 1""")
def _(b):
    events = b.events.select("user_id", "event_type", "event_id", "ts", "value")
    return filters.first_per_key(events, ["user_id", "event_type"], [F.col("value").isNull(), -F.col("value"), "ts", "event_id"])


# --- prompts and chats ---------------------------------------------------------------------------
BOOK = chat.PromptBook({
    "single": chat.Prompt(chat.Template("Title: {0}, aspects: {1}, description: {2}. Signal: {3} {{json}}", ("title", "aspects", "desc", "signal")),
                          chat.Template("Label: {0}", ("label",), label="label")),
    "grouped": chat.Prompt(chat.Template("Title: {0}\nSignals:\n{1}", ("title", "grouped_signals")),
                           chat.Template("Labels: {0}; reasons: {1}", ("grouped_labels", "grouped_reasons")), grouped=True)})
GROUPING = {"position": "pos", "label": "label", "reason": "reason", "keep": ("title",)}
T = lambda c: f"trim(coalesce(cast({c} as varchar), ''))"
SINGLE_USER = "'Title: ' || " + T("title") + " || ', aspects: ' || " + T("aspects") + " || ', description: ' || " + T('"desc"') + " || '. Signal: ' || " + T("signal") + " || ' {json}'"
GROUP_SQL = """g as (select item_id, arg_min(title, pos) as title, string_agg(n || '. ' || translate(signal, chr(13) || chr(10), '  '), chr(10) order by pos) as grouped_signals, string_agg(label, ', ' order by pos) as grouped_labels,
  string_agg(reason, ', ' order by pos) as grouped_reasons, count(*) as num_signals from (select *, row_number() over (partition by item_id order by pos) as n from {src}) group by item_id)"""


def labelled_signals(b):
    return b.v_signals.withColumn("label", (F.col("item_id") % 3).cast("int"))


@query("pmt_01_fill_template", f"select item_id, {SINGLE_USER} as prompt from v_signals")
def _(b):
    return b.v_signals.select("item_id", BOOK["single"].user.fill().alias("prompt"))


@query("pmt_02_label_modes", """select item_id, annotator_name, 'Label: ' || coalesce(cast(label as varchar), '') as plain, 'Label: ' || coalesce(cast(label as varchar), '') as number,
  'Label: ' || coalesce(cast(case when label <> 0 then 1 else label end as varchar), '') as flag from v_annotations""")
def _(b):
    t = BOOK["single"].assistant
    return b.v_annotations.select("item_id", "annotator_name", t.fill(None).alias("plain"), t.fill("number").alias("number"), t.fill("binary").alias("flag"))


@query("pmt_03_numbered_fields", """select doc_id, 'k_1: ' || source || ', k_2: ' || source || ', k_3: ' || source as text from documents""")
def _(b):
    template = chat.Template(chat.numbered_template(3, "k_{i}: {0}", ", "), ("source",))
    return b.documents.select("doc_id", template.fill(None).alias("text"))


def chat_sql(user, assistant):
    return f"to_json([{{role: 'user', content: {user}}}, {{role: 'assistant', content: {assistant}}}])::varchar"


@query("cht_01_training_chats", f"select {chat_sql(SINGLE_USER, chr(39) + 'Label: ' + chr(39) + ' || (item_id % 3)')} as messages from v_signals")
def _(b):
    return chat.training_chats(labelled_signals(b), BOOK["single"])


@query("agg_15_group_signals", f"with {GROUP_SQL.format(src='v_chat')} select * from g")
def _(b):
    return chat.group_signals(b.v_chat, **GROUPING)


GROUP_USER = "'Title: ' || trim(title) || chr(10) || 'Signals:' || chr(10) || trim(grouped_signals)"
GROUP_ASSISTANT = "'Labels: ' || trim(grouped_labels) || '; reasons: ' || trim(grouped_reasons)"


@query("cht_02_grouped_chats", f"with {GROUP_SQL.format(src='v_chat')} select {chat_sql(GROUP_USER, GROUP_ASSISTANT)} as messages from g")
def _(b):
    return chat.training_chats(b.v_chat, BOOK["grouped"], grouping=GROUPING)


@query("cht_03_inference_prompts", f"select item_id, signal, {SINGLE_USER} as judge_prompt from v_signals")
def _(b):
    return chat.inference_prompts(b.v_signals, BOOK["single"], ["item_id", "signal"])


@query("cht_04_grouped_prompts", f"""with src as (select * from v_chat union all select 1000000 + item_id, 1, signal, lang, 1, 'r' from v_signals), {GROUP_SQL.format(src='src')}
  select item_id, case when num_signals = 1 then substr(grouped_signals, 4) else grouped_signals end as grouped_signals,
  'Title: ' || trim(title) || chr(10) || 'Signals:' || chr(10) || trim(case when num_signals = 1 then substr(grouped_signals, 4) else grouped_signals end) as judge_prompt from g""")
def _(b):
    single = b.v_signals.select((F.col("item_id") + 1000000).alias("item_id"), F.lit(1).cast("bigint").alias("pos"), "signal",
                                F.col("lang").alias("title"), F.lit(1).alias("label"), F.lit("r").alias("reason"))
    rows = b.v_chat.unionByName(single)
    return chat.inference_prompts(rows, BOOK["grouped"], ["item_id", "grouped_signals"], grouping={**GROUPING, "number_single": False})


@query("cht_05_train_test", f"""with k as (select item_id, row_number() over (order by {h('item_id')}, item_id) - 1 as p, count(*) over () as n from (select distinct item_id from v_chat)),
  {GROUP_SQL.format(src='v_chat')} select case when p < floor(n * 0.7::double) then 'train' else 'test' end as role,
  case when p < floor(n * 0.7::double) then {chat_sql(GROUP_USER, GROUP_ASSISTANT)} else {GROUP_USER} end as text from g join k using (item_id)""")
def _(b):
    train, test = judging.train_test(b.v_chat, BOOK["grouped"], 0.7, "label", ["item_id", "pos"], grouping=GROUPING)
    return train.select(F.lit("train").alias("role"), F.col("messages").alias("text")).unionByName(
        test.select(F.lit("test").alias("role"), F.col("judge_prompt").alias("text")))


@query("cht_05b_fold_sets", f"""with k as (select item_id, ntile(3) over (order by {h('item_id')}, item_id) as f from (select distinct item_id from v_chat)), {GROUP_SQL.format(src='v_chat')}
  select fold::int as fold, case when f = fold then 'test' else 'train' end as role, count(*) as n from g join k using (item_id), (select unnest([1, 2, 3]) as fold) group by all""")
def _(b):
    return judging.fold_frame(b.v_chat, BOOK["grouped"], 3, "label", grouping=GROUPING).groupBy("fold", "role").agg(F.count("*").alias("n"))


FOLDS_SQL = f"""with k as (select item_id, ntile(3) over (order by {h('item_id')}, item_id) as f from (select distinct item_id from v_chat)), {GROUP_SQL.format(src='v_chat')}
  select item_id, grouped_signals, fold::int as fold, case when f = fold then 'test' else 'train' end as role,
  case when f <> fold then {chat_sql(GROUP_USER, GROUP_ASSISTANT)} end as messages, case when f = fold then {GROUP_USER} end as judge_prompt
  from g join k using (item_id), (select unnest([1, 2, 3]) as fold)"""


@query("cht_05c_fold_frame", FOLDS_SQL)
def _(b):
    return judging.fold_frame(b.v_chat, BOOK["grouped"], 3, "label", grouping=GROUPING)


@query("cht_05d_fold_frame_rows", f"""with k as (select item_id, ntile(5) over (order by {h('item_id')}, item_id) as f from (select distinct item_id from v_signals))
  select item_id, signal, fold::int as fold, case when f = fold then 'test' else 'train' end as role,
  case when f <> fold then {chat_sql(SINGLE_USER, chr(39) + 'Label: ' + chr(39) + ' || (item_id % 3)')} end as messages, case when f = fold then {SINGLE_USER} end as judge_prompt
  from v_signals join k using (item_id), (select unnest([1, 2, 3, 4, 5]) as fold)""")
def _(b):
    return judging.fold_frame(labelled_signals(b), BOOK["single"], 5, "label")


@query("snk_05b_write_folds", FOLDS_SQL)
def _(b):
    path = scratch(b, "folds")
    writers.write_folds(judging.fold_frame(b.v_chat, BOOK["grouped"], 3, "label", grouping=GROUPING), path)
    return b.spark.read.parquet(path).withColumn("fold", F.col("fold").cast("int"))


# --- text functions over tables -----------------------------------------------------------------------
def first_word_model():
    """A stand-in for a model client: answers with the first two words of the prompt."""
    def fn(prompts):
        return [json.dumps({"characteristic_1": " ".join(p.split()[:2]), "explanation_1": str(len(p))}, ensure_ascii=False) for p in prompts]
    return fn


def label_model():
    """A stand-in judge: one label per numbered line, 1 for lines of even length."""
    def fn(prompts):
        lines = [[s for s in p.split("Signals:\n")[1].split("\n") if s] for p in prompts]
        return ["Labels: " + ", ".join(str(1 - len(s) % 2) for s in rows) for rows in lines]
    return fn


INF_01_SQL = f"""with a as (select item_id, length(title) as n, array_to_string(list_filter(string_split(title, ' '), lambda x: x <> '')[1:2], ' ') as c from v_signals)
  select item_id, coalesce({TITLE_SQL.format(c='c')}, '') as signal_m_1, n::varchar as explanation_m_1, '' as signal_m_2, '' as error_m from a"""


@query("inf_01_generate_signals", INF_01_SQL)
def _(b):
    done = infer.generate_signals(b.v_signals.select("item_id", F.regexp_replace("title", '"', "").alias("title")), "title", first_word_model, "m", n=3)
    return done.select("item_id", "signal_m_1", "explanation_m_1", "signal_m_2", "error_m")


@query("inf_02_bounded_concurrency", "select doc_id, length(text)::varchar as result, '' as error from documents where length(text) % 7 <> 0 union all select doc_id, '', 'refused' from documents where length(text) % 7 = 0")
def _(b):
    def factory():
        def fn(prompts):
            if any(len(p) % 7 == 0 for p in prompts):
                raise ValueError("refused")
            return [str(len(p)) for p in prompts]
        return fn
    return infer.run_text_function(b.documents.select("doc_id", "text"), "text", factory, concurrency=4, batch=8, parallel=4).select("doc_id", "result", "error")


@query("inf_03_judge_rows", """select doc_id, (doc_id % 4)::varchar as label_j, source as reason_j, '' as explanation_j from documents""")
def _(b):
    def factory():
        def fn(prompts):
            parts = [p.split("|") for p in prompts]
            return [f'```json\n{{"signal_label": "{int(number) % 4}", "reason": "{source}"}}\n```' for number, source in parts]
        return fn
    rows = b.documents.select("doc_id", F.concat_ws("|", "doc_id", "source").alias("p"))
    return infer.judge_rows(rows, "p", factory, "j").select("doc_id", "label_j", "reason_j", "explanation_j")


@query("inf_04_token_count", r"""select round_even(avg(length(text)), 1) as avg_chars, round_even(avg(len(regexp_extract_all(text, '[\p{L}]+'))), 1) as avg_tokens from documents""")
def _(b):
    def tokens(text):
        return F.size(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0)))
    return report.text_statistics(b.documents, ["text"], token_count=tokens)


@query("inf_05_unfinished", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def _(b):
    return infer.unfinished(b.documents.select("doc_id"), b.labels, "doc_id")


@query("inf_05b_resumed_run", """select doc_id, case when lang = 'en' and length(text) % 7 <> 0 then 'first ' else 'second ' end || length(text) as result, '' as error from documents""")
def _(b):
    def factory(name, picky):
        def make():
            def fn(prompts):
                if picky and any(len(p) % 7 == 0 for p in prompts):
                    raise ValueError("refused")
                return [f"{name} {len(p)}" for p in prompts]
            return fn
        return make
    rows, path = b.documents.select("doc_id", "text", "lang"), scratch(b, "answers")
    # The first run breaks off with the English documents, and some prompts fail; the second asks what is missing.
    infer.resumed(rows.filter("lang = 'en'"), "text", factory("first", True), path, "doc_id", per_round=200, batch=8)
    return infer.resumed(rows, "text", factory("second", False), path, "doc_id", per_round=400, batch=64)


@query("plan_03_generate_and_parse", """select doc_id as item_id, lang, 'Source ' || upper(source[1:1]) || source[2:] as signal,
  length('Source ' || trim(source) || ' says ' || trim(text))::varchar as explanation from documents""")
def _(b):
    prompt = chat.Template("Source {0} says {1}", ("source", "text"))
    items = b.documents.select(F.col("doc_id").alias("item_id"), "source", "text", "lang")
    return generate(items, prompt, first_word_model, scratch(b, "raw"), scratch(b, "signals"), n=3, keep=("lang",)).drop("rank")


@query("plan_07_judge_and_score", f"""with k as (select item_id, row_number() over (order by {h('item_id')}, item_id) - 1 as p, count(*) over () as n from (select distinct item_id from v_chat)),
  held as (select v.item_id, pos, label, translate(signal, chr(13) || chr(10), '  ') as text, row_number() over (partition by v.item_id order by pos) as i,
           count(*) over (partition by v.item_id) as c from v_chat v join k using (item_id) where p >= floor(n * 0.5::double)),
  whole as (select item_id from held group by item_id having bool_and(trim(text) <> '')),
  pred as (select item_id, lower(trim(text)) as s, min(1 - length(i || '. ' || text) % 2) as pred from held where item_id in (select item_id from whole) group by all),
  j as (select a.label, b.pred from held a join pred b on a.item_id = b.item_id and lower(trim(a.text)) = b.s),
  c as (select count(*) filter (label <> 0 and pred <> 0) as tp, count(*) filter (label = 0 and pred <> 0) as fp, count(*) filter (label <> 0 and pred = 0) as fn, count(*) filter (label = 0 and pred = 0) as tn from j)
  select tp, fp, fn, tn, tp / (tp + fp)::double as precision, tp / (tp + fn)::double as recall, 2 * tp / (2 * tp + fp + fn)::double as f1,
  ((tp * tn) + (tp * fp + fn * tn) / 2) / ((tp + fn)::double * (fp + tn)) as auc from c""")
def _(b):
    return judging.train_and_evaluate(b.v_chat, BOOK["grouped"], 0.5, label_model, grouping=GROUPING)[1]


# --- export --------------------------------------------------------------------------------------------
def export_rows(b):
    return b.v_listings.select("item_id", F.col("auct_titl").alias("title")).join(it.latest_aspects(b.v_aspects), "item_id").withColumn("desc", F.col("title"))


PAYLOAD_SQL = f"""with {LATEST_SQL}, m as (select item_id, '{{' || string_agg(to_json(name) || ':' || to_json(value), ',' order by name) || '}}' as features from latest group by item_id),
  payload as (select item_id as "itemId", auct_titl as title, features, auct_titl as "rawDescription", 'P1' as processor, true as force from v_listings join m using (item_id))"""


@query("exp_01_payload", PAYLOAD_SQL + " select * from payload")
def _(b):
    return ex.payload(export_rows(b), "P1", force=True)


@query("exp_02_features_text", PAYLOAD_SQL + """ select "itemId", features as from_map, features as from_pairs, features as from_text from payload""")
def _(b):
    df = export_rows(b)
    pairs = df.withColumn("aspects", F.map_entries("aspects"))
    text = df.withColumn("aspects", F.to_json("aspects"))
    pick = lambda d, n: d.select(F.col("item_id").alias("itemId"), ex.features_text(d, "aspects").alias(n))
    return pick(df, "from_map").join(pick(pairs, "from_pairs"), "itemId").join(pick(text, "from_text"), "itemId")


@query("exp_03_batches", PAYLOAD_SQL + """, n as (select "itemId", row_number() over (order by "itemId") - 1 as pos from payload)
  select pos // 300 as batch_id, count(*) as rows, min("itemId") as first_id, max("itemId") as last_id from n group by 1""")
def _(b):
    records = ex.batches(ex.payload(export_rows(b), "P1")).select("batch_id", F.posexplode("records").alias("i", "r"))
    ids = records.withColumn("id", F.get_json_object("r", "$.itemId").cast("bigint"))
    return ids.groupBy("batch_id").agg(F.count("*").alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("exp_04_send", PAYLOAD_SQL + """, n as (select "itemId", row_number() over (order by "itemId") - 1 as pos from payload), c as (select pos // 300 as batch_id, count(*)::int as rows from n group by 1)
  select batch_id, rows, case when rows > 150 then 3 else 1 end as attempts, case when rows > 150 then 1 else 0 end as splits, true as ok, '' as error from c""")
def _(b):
    def factory():
        def sender(records):
            return ex.Answer(500, "Message exceeds maximum size") if len(records) > 150 else ex.Answer(200)
        return sender
    return ex.send(ex.batches(ex.payload(export_rows(b), "P1")), factory, tasks=2)


@query("exp_06_send_ledger", PAYLOAD_SQL + """, n as (select "itemId", row_number() over (order by "itemId") - 1 as pos from payload), c as (select pos // 100 as batch_id, count(*)::int as rows from n group by 1)
  select batch_id, rows, case when batch_id % 3 = 0 and rows > 50 then 3 else 1 end as attempts, case when batch_id % 3 = 0 and rows > 50 then 1 else 0 end as splits, true as ok, '' as error from c""")
def _(b):
    def factory(first):
        def make():
            def sender(records):
                if first:  # a batch is known by its records: refuse every third one
                    return ex.Answer(200 if records[0]["features"] != "refuse" else 503)
                return ex.Answer(500, "Message exceeds maximum size") if len(records) > 50 else ex.Answer(200)
            return sender
        return make
    # Both runs get the same batches: they are computed once.
    batched, ledger = stored(ex.batches(ex.payload(export_rows(b), "P1"), size=100), scratch(b, "input"), "batches"), scratch(b, "ledger")
    refuse = F.transform("records", lambda r: F.lit('{"features":"refuse"}'))
    # In the first run every third batch is refused (under other records); the second sends those and no other.
    ex.send_once(batched.withColumn("records", F.when(F.col("batch_id") % 3 == 0, refuse).otherwise(F.col("records"))), factory(True), ledger, per_round=4)
    return ex.send_once(batched, factory(False), ledger, per_round=2)


@query("exp_05_single_records", PAYLOAD_SQL + """ select row_number() over (order by "itemId") - 1 as batch_id, "itemId" as id from payload order by "itemId" limit 450""")
def _(b):
    one = ex.single_records(ex.payload(export_rows(b), "P1"), 450)
    return one.select("batch_id", F.get_json_object(F.get("records", F.lit(0)), "$.itemId").cast("bigint").alias("id"))


@query("plan_08_export", PAYLOAD_SQL + """, n as (select "itemId", row_number() over (order by "itemId") - 1 as pos from payload) select pos // 300 as batch_id, count(*)::int as rows, 1 as attempts, 0 as splits, true as ok, '' as error from n group by 1""")
def _(b):
    from sigloom.plans.export import export_items

    def factory():
        return lambda records: ex.Answer(200)
    return export_items(export_rows(b), "P1", factory, scratch(b, "results"))


# --- files -------------------------------------------------------------------------------------------------
@query("src_02_partitioned_ledger", "select item_id, date_trunc('month', session_start_dt)::date as session_start_dt from v_ledger where session_start_dt >= date '1998-01-01'")
def _(b):
    path = scratch(b, "ledger")
    monthly = b.v_ledger.withColumn("session_start_dt", F.trunc("session_start_dt", "month"))
    monthly.repartition("session_start_dt").write.partitionBy("session_start_dt").parquet(path)
    return readers.read_ledger(b.spark, path, "1998-01-01")


@query("src_04_csv", "select item_id::varchar as item_id, signal, annotator_name, label, reason, comment from v_annotations")
def _(b):
    path = scratch(b, "csv")
    writers.write_csv(b.v_annotations.select(*ANNOTATION_SCHEMA.names), path)
    return readers.read_csv(b.spark, path, ANNOTATION_SCHEMA)


@query("src_05_raw_output_lines", "select gen_text from v_raw_output")
def _(b):
    path = scratch(b, "raw")
    quoted = F.regexp_extract(F.to_json(F.struct(F.col("gen_text").alias("t"))), r'^\{"t":(.*)\}$', 1)
    b.v_raw_output.select(quoted.alias("value")).write.text(path)
    return readers.read_raw_output(b.spark, path)


@query("src_06_gzip_json", "select item_id, signal, title from v_signals")
def _(b):
    path = scratch(b, "gz")
    b.v_signals.select("item_id", "signal", "title").write.option("compression", "gzip").json(path)
    return readers.read_json_lines(b.spark, path, "item_id bigint, signal string, title string")


@query("src_07_files_with_source", "select source_file as who, count(*) as n from v_annotations group by 1")
def _(b):
    paths = []
    for name in ("file_1", "file_2"):
        paths.append(scratch(b, name))
        writers.write_csv(b.v_annotations.filter(F.col("source_file") == name).select(*ANNOTATION_SCHEMA.names), paths[-1])
    merged = readers.read_csv_with_source(b.spark, paths, ANNOTATION_SCHEMA, by_folder=True)
    return merged.groupBy(F.col("source_file").alias("who")).agg(F.count("*").alias("n"))


@query("snk_01_write_items", "select item_id, signal from v_signals")
def _(b):
    path = scratch(b, "items")
    writers.write_items(b.v_signals.select("item_id", "signal"), path)
    return b.spark.read.parquet(path)


@query("snk_02_append_ledger", "select item_id, d::date as session_start_dt from (select distinct item_id from v_views), (select unnest(['2024-01-01', '2024-01-02']) as d)")
def _(b):
    path = scratch(b, "ledger")
    ids = b.v_views.select("item_id").distinct()
    for day in ("2024-01-01", "2024-01-02"):
        writers.append_ledger(ids, path, day, enabled=True)
    return readers.read_ledger(b.spark, path, "2024-01-01")


@query("snk_04_json_lines", "select doc_id, text from documents")
def _(b):
    path = scratch(b, "lines")
    writers.write_json_lines(b.documents.select("doc_id", "text"), path)
    return readers.read_json_lines(b.spark, path, "doc_id bigint, text string")


@query("snk_05_write_messages", f"select {chat_sql(SINGLE_USER, chr(39) + 'Label: ' + chr(39) + ' || (item_id % 3)')} as messages from v_signals")
def _(b):
    path = scratch(b, "messages")
    writers.write_messages(chat.training_chats(labelled_signals(b), BOOK["single"]), path)
    return b.spark.read.parquet(path)


@query("snk_06_fewer_files", "select 1 as within_bound, count(*) as rows from lineitem")
def _(b):
    path = scratch(b, "few")
    writers.fewer_files(b.lineitem.select("l_orderkey").repartition(16), 3).write.parquet(path)
    read = b.spark.read.parquet(path)
    files = F.countDistinct(F.col("_metadata.file_path"))
    return read.select("l_orderkey", "_metadata").agg((files <= 3).cast("int").alias("within_bound"), F.count("*").alias("rows"))


@query("snk_07_per_annotator", "select annotator_name, count(*) as n from v_annotations group by 1")
def _(b):
    path = scratch(b, "annotators")
    writers.write_per_annotator(b.v_annotations, path)
    return b.spark.read.json(path).groupBy("annotator_name").agg(F.count("*").alias("n"))
