"""Queries for samples, splits, annotators, agreement, weights and encodings."""

from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.operators import agreement as ag
from sigloom.operators import filters as flt
from sigloom.operators import sampling as sm
from sigloom.operators import uplift as up
from sigloom.registry.core import query

NAMES = ["ann_a", "ann_b", "ann_c", "ann_d"]
NAMES_LIST = "['ann_a', 'ann_b', 'ann_c', 'ann_d']"
QUALS = ["qual_a", "qual_b", "qual_c"]


def h(*keys):
    return "md5(concat(" + ", '-', ".join(keys) + ", '-42'))"


# --- samples ----------------------------------------------------------------------------------
@query("smp_01_fraction_limit", f"select item_id, auct_titl from v_listings order by {h('item_id')}, item_id limit 250")
def _(b):
    from sigloom.operators.ordering import first_by_hash
    return first_by_hash(b.v_listings, ["item_id"], 250).select("item_id", "auct_titl")


@query("smp_02_seeded_rows", f"select item_id, signal from v_signals order by {h('item_id')}, item_id limit 300")
def _(b):
    # The form for large samples: exact positions per hash bucket.
    from sigloom.operators.ordering import hash_position
    return hash_position(b.v_signals.select("item_id", "signal"), ["item_id"]).filter("pos < 300").drop("pos")


@query("smp_03_sample_items", f"select conv_id, turn, role from conversations where conv_id in (select conv_id from (select distinct conv_id from conversations) order by {h('conv_id')} limit 30)")
def _(b):
    return sm.sample_keys(b.conversations, "conv_id", 30).select("conv_id", "turn", "role")


@query("smp_04_annotator_blocks", f"""with s as (select item_id, signal, row_number() over (order by {h('item_id')}, item_id) - 1 as pos from v_signals qualify pos < 302)
  select item_id, signal, {NAMES_LIST}[pos // 76 + 1] as annotator_name, {NAMES_LIST}[((select max(pos) from s) - pos) // 76 + 1] as annotator_name2 from s""")
def _(b):
    return sm.assign_blocks(b.v_signals.select("item_id", "signal"), ["item_id"], 302, NAMES, second=True)


@query("smp_05_annotator_pairs", f"""with s as (select item_id, signal, row_number() over (order by {h('item_id')}, item_id) - 1 as pos from v_signals qualify pos < 120)
  select item_id, signal, {NAMES_LIST}[2 * (pos // 60) + unnest([1, 2])] as annotator_name from s""")
def _(b):
    return sm.assign_pairs(b.v_signals.select("item_id", "signal"), ["item_id"], 60, NAMES)


@query("smp_06_pairs_by_item", f"""with ids as (select conv_id, ntile(2) over (order by hh, conv_id) as pair from
    (select conv_id, {h('conv_id')} as hh from (select distinct conv_id from conversations) order by hh, conv_id limit 62)),
  r as (select c.conv_id, c.turn, pair, row_number() over (partition by c.conv_id order by turn) as rn from conversations c join ids using (conv_id))
  select conv_id, turn, {NAMES_LIST}[2 * (pair - 1) + unnest([1, 2])] as annotator_name from r where rn <= 5""")
def _(b):
    return sm.assign_pairs_by_item(b.conversations.select("conv_id", "turn"), "conv_id", ["turn"], 31, NAMES)


@query("win_02_first_rows", "select conv_id, turn, role from conversations qualify row_number() over (partition by conv_id order by turn) <= 3")
def _(b):
    return sm.rows_per_key(b.conversations.select("conv_id", "turn", "role"), "conv_id", ["turn"], 3)


@query("spl_01_split_rows", f"""select doc_id, case when row_number() over (order by {h('doc_id')}, doc_id) - 1 < floor((select count(*) from documents) * 0.7::double) then 'train' else 'test' end as role from documents""")
def _(b):
    return sm.split_rows(b.documents.select("doc_id"), ["doc_id"], 0.7)


@query("spl_02_split_by_item", f"""with k as (select conv_id, row_number() over (order by {h('conv_id')}, conv_id) - 1 as pos, count(*) over () as n from (select distinct conv_id from conversations))
  select conv_id, turn, case when pos < floor(n * 0.7::double) then 'train' else 'test' end as role from conversations join k using (conv_id)""")
def _(b):
    return sm.split_by_key(b.conversations.select("conv_id", "turn"), "conv_id", 0.7)


@query("spl_03_item_folds", f"""with k as (select conv_id, ntile(3) over (order by {h('conv_id')}, conv_id) as f from (select distinct conv_id from conversations))
  select conv_id, turn, fold::int as fold, case when fold = f then 'test' else 'train' end as role from conversations join k using (conv_id), (select unnest([1, 2, 3]) as fold)""")
def _(b):
    return sm.fold_roles(sm.key_folds(b.conversations.select("conv_id", "turn"), "conv_id", 3), 3)


@query("spl_04_split_by_time", """with p as (select event_id, ts, row_number() over (order by ts, md5(concat(event_id, '-0')), event_id) - 1 as pos, count(*) over () as n from events)
  select case when pos < floor(n * 0.8::double) then 'train' else 'test' end as role, count(*) as n, min(ts)::date as first_day, max(ts)::date as last_day, sum(event_id)::bigint as ids from p group by 1""")
def _(b):
    split = sm.split_by_time(b.events.select("event_id", "ts"), "ts", ["event_id"], 0.8)
    return sm.role_dates(split, "ts").join(split.groupBy("role").agg(F.sum("event_id").alias("ids")), "role")


@query("spl_05_keep_positives", f"""with p as (select event_id, conversion from v_uplift where conversion = 1)
  select * from p union all (select event_id, conversion from v_uplift where conversion = 0 order by {h('event_id')}, event_id
    limit (select floor(count(*) * 0.1::double)::bigint from p))""")
def _(b):
    return sm.keep_positives(b.v_uplift.select("event_id", "conversion"), ["event_id"], "conversion", 0.1)


# --- weights and encodings ------------------------------------------------------------------------
@query("win_03_class_share", """select event_id, shown, round(count(*) over (partition by qual_a, qual_b, qual_c, shown) / (count(*) over (partition by qual_a, qual_b, qual_c))::double, 9) as share from v_uplift""")
def _(b):
    return up.class_share(b.v_uplift.select("event_id", "shown", *QUALS), QUALS, "shown").select("event_id", "shown", F.round("share", 9).alias("share"))


@query("wgt_01_balanced", """select event_id, shown, round((select count(*) from v_uplift) / ((select count(distinct shown) from v_uplift) * (count(*) over (partition by shown)))::double, 9) as weight from v_uplift""")
def _(b):
    return up.balanced_weight(b.v_uplift.select("event_id", "shown"), [], "shown").select("event_id", "shown", F.round("weight", 9).alias("weight"))


WEIGHT_CELLS = """cells as (select event_id, shown, conversion, qual_a + qual_b + qual_c as q, count(*) over (partition by qual_a, qual_b, qual_c, shown) as nc,
  count(*) over (partition by qual_a, qual_b, qual_c) as n, (select count(distinct shown) from v_uplift u where u.qual_a = v.qual_a and u.qual_b = v.qual_b and u.qual_c = v.qual_c) as k,
  count(*) over (partition by conversion) as ny, count(*) over () as total from v_uplift v)"""
SCALED = " * case when q <= 1 then 0.25::double else 1 end, 9) as weight from cells"


def weights(b, method):
    w = up.sample_weights(b.v_uplift, method, QUALS, positive_scale=3.0, not_shown_scale=0.5, non_choiceable_scale=0.25)
    return w.select("event_id", F.round("weight", 9).alias("weight"))


@query("wgt_02_per_qualification_set", f"""with {WEIGHT_CELLS} select event_id, round(n / (k * nc)::double * case when conversion = 1 then 3.0::double else 1 end
  * case when shown = 'nsh' then 0.5::double else 1 end{SCALED}""")
def _(b):
    return weights(b, "per_qualification_set")


@query("wgt_02b_by_labels", f"with {WEIGHT_CELLS} select event_id, round(total / (2 * ny)::double * case when conversion = 1 then 3.0::double else 1 end{SCALED}")
def _(b):
    return weights(b, "by_labels")


@query("wgt_03_inverse_propensity", f"with {WEIGHT_CELLS} select event_id, round(n / nc::double * case when conversion = 1 then 3.0::double else 1 end{SCALED}")
def _(b):
    return weights(b, "ivp")


@query("wgt_04_only_positives", f"with {WEIGHT_CELLS} select event_id, round(case when conversion = 1 then 3.0::double else 0 end{SCALED}")
def _(b):
    return weights(b, "only_pos")


@query("wgt_04b_none", f"with {WEIGHT_CELLS} select event_id, round(1.0::double{SCALED}")
def _(b):
    return weights(b, "none")


@query("enc_01_label_codes", "select event_id, label, (dense_rank() over (order by label) - 1)::int as code, label as decoded from (select event_id, shown || ',' || conversion as label from v_uplift)")
def _(b):
    labelled = b.v_uplift.select("event_id", up.composite_label().alias("label"))
    codes = up.label_codes(labelled, "label")
    coded = up.encode_labels(labelled, "label")
    return up.decode_labels(coded, codes.withColumnRenamed("label", "decoded")).select("event_id", "label", "code", "decoded")


@query("enc_02_composite_label", "select event_id, shown || ',' || conversion as label, true as conversion_1 from v_uplift")
def _(b):
    return up.constant_conversion(b.v_uplift.select("event_id", up.composite_label().alias("label")))


@query("enc_03_best_compliant", """select event_id, t.p as prob, t.c as class from (select event_id, unnest(list_filter(list_sort([{p: -case when qual_a = 1 then pa else -1000 end, o: 1, c: 'a'},
    {p: -case when qual_b = 1 then pb else -1000 end, o: 2, c: 'b'}, {p: -0.05::double, o: 3, c: 'nsh'}]), lambda x, i: i = 1)) as u from
    (select *, (feature_0 % 7) / 10.0::double as pa, (feature_0 % 5) / 10.0::double as pb from (select *, coalesce(feature, 0) as feature_0 from v_uplift))), lateral (select -u.p as p, u.c as c) t""")
def _(b):
    u = b.v_uplift.withColumn("f", F.coalesce("feature", F.lit(0)))
    probs = {"a": (F.col("f") % 7) / 10, "b": (F.col("f") % 5) / 10, fv.NOT_SHOWN: F.lit(0.05)}
    best = up.best_compliant(probs, up.qualified_map({"a": "qual_a", "b": "qual_b"}))
    return u.select("event_id", best.alias("_b")).select("event_id", "_b.prob", "_b.class")


@query("enc_04_explode_qualified", """select event_id, 'a' as signal from v_uplift where qual_a = 1 union all select event_id, 'b' from v_uplift where qual_b = 1
  union all select event_id, 'c' from v_uplift where qual_c = 1 union all select event_id, 'nsh' from v_uplift""")
def _(b):
    q = up.qualified_map({"a": "qual_a", "b": "qual_b", "c": "qual_c"})
    return up.explode_qualified(b.v_uplift, q, no_treatment=True).select("event_id", "signal")


@query("dat_02_epoch_date", "select event_id, ts::date as day from events")
def _(b):
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return b.events.select("event_id", up.epoch_ns_date(ns).alias("day"))


@query("plan_09_uplift_table", f"""with kept as (select * from v_uplift where shown <> 'nsh' and qual_a + qual_b + qual_c > 1),
  t as (select *, row_number() over (order by ts, md5(concat(event_id, '-0')), event_id) - 1 as pos, count(*) over () as total from kept),
  tr as (select * from t where pos < floor(total * 0.8::double))
  select event_id, coalesce(feature, 0) as feature, shown || ',' || conversion as label, 'test' as role, null::double as weight from t where pos >= floor(total * 0.8::double)
  union all select event_id, coalesce(feature, 0) as feature, shown || ',' || conversion as label, 'train' as role, round(count(*) over (partition by qual_a, qual_b, qual_c)
    / ((select count(distinct shown) from tr u where u.qual_a = tr.qual_a and u.qual_b = tr.qual_b and u.qual_c = tr.qual_c) * count(*) over (partition by qual_a, qual_b, qual_c, shown))::double
    * case when conversion = 1 then 2.0::double else 1 end, 9) as weight from tr""")
def _(b):
    from sigloom.plans.uplift import training_table
    out = training_table(b.v_uplift, QUALS, fraction=0.8, drop_not_shown=True, only_choiceable=True, categorical=["shown"], positive_scale=2.0)
    return out.select("event_id", "feature", "label", "role", F.round("weight", 9).alias("weight"))


# --- annotators -------------------------------------------------------------------------------------
PAIRED_SQL = """paired as (select a.item_id, a.signal, a.annotator_name, a.label, a.reason, a.comment, c.annotator_name as annotator_name_2, c.label as label_2, c.reason as reason_2, c.comment as comment_2
  from v_annotations a join v_pairs p on a.annotator_name = p.first_annotator join v_annotations c on c.annotator_name = p.second_annotator and c.item_id = a.item_id and c.signal = a.signal)"""


def paired(b):
    return ag.pair_annotations(b.v_annotations, b.v_pairs)


@query("jon_11_pair_annotations", f"with {PAIRED_SQL} select * from paired")
def _(b):
    return paired(b)


ADJUDICATED_SQL = f"""{PAIRED_SQL}, done as (select p.item_id, p.signal, coalesce(d.final_label, p.label) as final_label, coalesce(d.final_reason, d.reason, p.reason, p.reason_2) as final_reason,
  coalesce(d.final_comment, p.comment, p.comment_2) as final_comment, p.label, p.label_2 from paired p left join v_adjudicated d using (item_id, signal))"""


@query("jon_12_adjudicate", f"with {ADJUDICATED_SQL} select * from done")
def _(b):
    return ag.adjudicate(paired(b), b.v_adjudicated).select("item_id", "signal", "final_label", "final_reason", "final_comment", "label", "label_2")


@query("prj_07_first_present", "select item_id, coalesce(feature, nullif(qual_a, 0), nullif(qual_b, 0), -1) as v from v_uplift")
def _(b):
    u = b.v_uplift.select("item_id", "feature", F.nullif("qual_a", F.lit(0)).alias("x"), F.nullif("qual_b", F.lit(0)).alias("y"), F.lit(-1).alias("z"))
    return u.select("item_id", flt.first_present("feature", "x", "y", "z").alias("v"))


@query("jon_13_restore_originals", """select item_id, signal, title, "desc" from v_signals where trim(regexp_replace(signal, '[^a-zA-Z0-9./]+', ' ', 'g')) <> ''""")
def _(b):
    from sigloom.plans.evaluation import clean_columns
    original = b.v_signals.select("item_id", "signal", "title", "desc")
    cleaned = clean_columns(original, ["signal", "title", "desc"], {"signal": "signal_orig"})
    return sm.restore_originals(cleaned, original, ["signal", "title", "desc"]).select("item_id", "signal", "title", "desc")


@query("jon_14_join_predictions", """select a.item_id, a.signal, a.annotator_name, a.label, b.toxic as pred_score from v_annotations a join labels b on b.doc_id = a.item_id where a.signal <> 'Sig 4'""")
def _(b):
    number = F.when(F.col("doc_id") % 5 == 4, "none").otherwise((F.col("doc_id") % 5).cast("string"))
    pred = b.labels.select(F.col("doc_id").alias("item_id"), F.concat(F.lit(" SIG "), number, F.lit(" ")).alias("signal"),
                                                     F.col("toxic").alias("label"))
    return ag.join_predictions(b.v_annotations, pred).select("item_id", "signal", "annotator_name", "label", "pred_score")


@query("jon_15_left_keep_all", """select l.item_id, l.leaf_categ_id, min(v.bsns_vrtcl_name) as bsns_vrtcl_name from v_listings l left join (select distinct leaf_categ_id, bsns_vrtcl_name from v_categories
  where leaf_categ_id < 12) v using (leaf_categ_id) group by 1, 2""")
def _(b):
    cats = b.v_categories.filter("leaf_categ_id < 12").select("leaf_categ_id", "bsns_vrtcl_name")
    return ag.left_join_keep_all(b.v_listings.select("item_id", "leaf_categ_id"), cats, ["leaf_categ_id"], ["item_id", "leaf_categ_id"])


@query("jon_16_compare_runs", """select a.item_id, case when a.sig_1 is not distinct from b.sig_1 and a.sig_3 is not distinct from b.sig_3 then 1 else 0 end as same from v_wide a join
  (select item_id, case when item_id % 4 = 0 then upper(sig_1) else sig_1 end as sig_1, case when item_id % 7 = 0 then null else sig_3 end as sig_3 from v_wide) b using (item_id)""")
def _(b):
    w = b.v_wide.select("item_id", "sig_1", "sig_3")
    other = w.select("item_id", F.when(F.col("item_id") % 4 == 0, F.upper("sig_1")).otherwise(F.col("sig_1")).alias("sig_1"),
                     F.when(F.col("item_id") % 7 != 0, F.col("sig_3")).alias("sig_3"))
    return ag.compare_runs(w, other, "item_id", "sig_1", "sig_3").select("item_id", "same")


@query("jon_17_side_by_side", "select a.item_id, a.sig_1 as sig_1_all, b.sig_1 as sig_1_filtered from v_wide a join v_wide b using (item_id) where b.sig_2 <> ''")
def _(b):
    return ag.side_by_side(b.v_wide, b.v_wide.filter("sig_2 <> ''"), "item_id", ["sig_1"], ("all", "filtered"))


@query("agg_16_disagreements", f"""with {PAIRED_SQL}, d as (select least(label, label_2) || '|' || greatest(label, label_2) as kind from paired where label <> label_2)
  select kind, count(*) as n, round_even(count(*) / (select count(*) from d)::double * 100, 0) as percent from d group by kind""")
def _(b):
    return ag.disagreements(paired(b))


@query("agg_16b_disagreements_by_pair", f"""with {PAIRED_SQL}, d as (select annotator_name || '|' || annotator_name_2 as pair, least(label, label_2) || '|' || greatest(label, label_2) as kind from paired where label <> label_2)
  select pair, kind, count(*) as n, sum(count(*)) over (partition by pair)::bigint as pair_n, round_even(count(*) / (sum(count(*)) over (partition by pair))::double * 100, 1) as percent from d group by 1, 2""")
def _(b):
    return ag.disagreements(paired(b), by_pair=True)


KAPPA_SQL = f"""{PAIRED_SQL}, ok as (select annotator_name || '|' || annotator_name_2 as pair, label, label_2 from paired where label is not null and label_2 is not null),
  t as (select pair, count(*) as n, avg((label = label_2)::int) as po from ok group by pair),
  e as (select pair, sum(a * c) as pe from (select pair, v, avg((label = v)::int) as a, avg((label_2 = v)::int) as c from ok, (select unnest([0, 1]) as v) group by pair, v) group by pair)
  select pair, n, round((po - pe) / (1 - pe), 9) as kappa from t join e using (pair)"""


@query("agg_17_cohen_kappa", f"with {KAPPA_SQL}")
def _(b):
    return ag.cohen_kappa(paired(b)).withColumn("kappa", F.round("kappa", 9))


@query("plan_06_annotate_and_agree", f"""with {PAIRED_SQL}, ids as (select item_id from (select distinct item_id, md5(concat(item_id, '-42')) as hh from v_annotations) order by hh, item_id limit 300),
  ok as (select annotator_name || '|' || annotator_name_2 as pair, label, label_2 from paired where item_id in (select item_id from ids) and label is not null and label_2 is not null),
  t as (select pair, count(*) as n, avg((label = label_2)::int) as po from ok group by pair),
  e as (select pair, sum(a * c) as pe from (select pair, v, avg((label = v)::int) as a, avg((label_2 = v)::int) as c from ok, (select unnest([0, 1]) as v) group by pair, v) group by pair)
  select pair, n, round((po - pe) / (1 - pe), 9) as kappa from t join e using (pair)""")
def _(b):
    from sigloom.plans.judging import agreement_report
    sampled = sm.sample_keys(b.v_annotations, "item_id", 300)
    return agreement_report(sampled, b.v_pairs).withColumn("kappa", F.round("kappa", 9))


# Kappa's CTE without its final select.
KAPPA_CTE = KAPPA_SQL.rsplit("select pair, n, round", 1)[0].rstrip()


@query("plan_06b_annotation_round", f"""with {KAPPA_CTE}, kap as (select pair, n, round((po - pe) / (1 - pe), 9) as kappa from t join e using (pair)),
  kinds as (select annotator_name || '|' || annotator_name_2 as pair, least(label, label_2) || '|' || greatest(label, label_2) as kind, count(*) as kind_n from paired where label <> label_2 group by all)
  select p.item_id, p.signal, p.annotator_name || '|' || p.annotator_name_2 as pair, p.label, p.label_2, coalesce(d.final_label, p.label) as final_label,
    coalesce(d.final_reason, d.reason, p.reason, p.reason_2) as final_reason, coalesce(d.final_comment, p.comment, p.comment_2) as final_comment,
    s.title, s.aspects, kap.n as pair_n, kap.kappa, kinds.kind_n
  from paired p left join v_adjudicated d on d.item_id = p.item_id and d.signal = p.signal left join v_signals s on s.item_id = p.item_id
  left join kap on kap.pair = p.annotator_name || '|' || p.annotator_name_2
  left join kinds on kinds.pair = p.annotator_name || '|' || p.annotator_name_2 and kinds.kind = least(p.label, p.label_2) || '|' || greatest(p.label, p.label_2)""")
def _(b):
    from sigloom.plans.annotation import evaluate_round, returned
    from sigloom.sources.folders import new_folder
    from sigloom.sources.writers import write_per_annotator
    # All annotations, with what the annotators saw beside them, go out as one folder per annotator and come back.
    seen = b.v_annotations.join(b.v_signals.select("item_id", "title", "aspects"), "item_id", "left")
    path = new_folder(b.spark, "annotators")
    write_per_annotator(seen, path)
    result = evaluate_round(returned(b.spark, path, seen.schema), b.v_pairs, b.v_adjudicated, context=("title", "aspects"))
    kappa = result.kappa.select(F.col("pair").alias("kp"), F.col("n").alias("pair_n"), F.round("kappa", 9).alias("kappa"))
    kinds = result.disagreements.select(F.col("pair").alias("dp"), "kind", F.col("n").alias("kind_n"))
    final = result.final.withColumn("pair", F.concat_ws("|", "annotator_name", "annotator_name_2")).withColumn(
        "unlike", F.concat_ws("|", F.least("label", "label_2"), F.greatest("label", "label_2")))
    rows = final.join(kappa, F.col("pair") == F.col("kp"), "left").join(kinds, (F.col("pair") == F.col("dp")) & (F.col("unlike") == F.col("kind")), "left")
    return rows.select("item_id", "signal", "pair", "label", "label_2", "final_label", "final_reason", "final_comment", "title", "aspects", "pair_n", "kappa", "kind_n")


@query("jon_11b_pairs_with_context", f"with {PAIRED_SQL} select p.*, s.title, s.aspects, s.desc from paired p join v_signals s using (item_id)")
def _(b):
    seen = b.v_annotations.join(b.v_signals.select("item_id", "title", "aspects", "desc"), "item_id")
    return ag.pair_annotations(seen, b.v_pairs, context=("title", "aspects", "desc"))


@query("agg_18_binary_metrics", """with c as (select count(*) filter (quality <> 0 and toxic <> 0) as tp, count(*) filter (quality = 0 and toxic <> 0) as fp, count(*) filter (quality <> 0 and toxic = 0) as fn,
  count(*) filter (quality = 0 and toxic = 0) as tn from labels) select tp, fp, fn, tn, tp / (tp + fp)::double as precision, tp / (tp + fn)::double as recall, 2 * tp / (2 * tp + fp + fn)::double as f1 from c""")
def _(b):
    return ag.binary_metrics(b.labels, "quality", "toxic")


@query("agg_19_roc_auc", """with r as (select conversion, rank() over (order by feature) + (count(*) over (partition by feature) - 1) / 2.0::double as rk from v_uplift where feature is not null),
  c as (select sum(rk) filter (conversion = 1) as rs, (count(*) filter (conversion = 1))::double as p, (count(*) filter (conversion = 0))::double as q from r) select round((rs - p * (p + 1) / 2) / (p * q), 9) as auc from c""")
def _(b):
    return ag.roc_auc(b.v_uplift, "conversion", "feature").withColumn("auc", F.round("auc", 9))


@query("agg_20_class_distribution", """with a as (select role as value, count(*) / (select count(*) from conversations)::double as actual from conversations group by 1),
  p as (select case when turn % 2 = 0 then 'user' else 'assistant' end as value, count(*) / (select count(*) from conversations)::double as predicted from conversations group by 1)
  select value, round(actual, 9) as actual, round(predicted, 9) as predicted from a join p using (value)""")
def _(b):
    c = b.conversations.select("role", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("guess"))
    return ag.class_distribution(c, "role", "guess").select("value", F.round("actual", 9).alias("actual"), F.round("predicted", 9).alias("predicted"))
