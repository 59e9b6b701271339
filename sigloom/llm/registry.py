"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sigloom
from sigloom.llm import crosstoken, fingerprint, licenses, mixing, near, pack, phrases, privacy, quality, radix, sharding, tools, warc
from sigloom.llm.common import new_path

cloudpickle.register_pickle_by_value(sigloom)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_exact_dedup", """
  select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
  from (select doc_id, t, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size
        from (select doc_id, coalesce(text, '') as t from documents))""")
def _(spark, sf_dir):
    found = radix.exact_groups(table(spark, sf_dir, "documents"), carry=[])
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op10_packing")
def _(spark, sf_dir):
    packed = pack.packed(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that a fit may see: a fifth of the ids, by checksum, is held out."""
    return labels.filter(~held_out())


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query("op8_quality_classifier")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, training_labels(table(spark, sf_dir, "labels")))
    scored = quality.scored(docs, model).drop("text")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op7_license_scan")
def _(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("detections")


@query("op1_mix_sources")
def _(spark, sf_dir):
    found = mixing.mixed(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "cut_words")


@query("op9_personal_data")
def _(spark, sf_dir):
    spanned = privacy.protected(table(spark, sf_dir, "documents"))
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in privacy.KINDS]
    return spanned.select(F.col("id").alias("doc_id"), *counts, F.sha2(privacy.as_text(*privacy.KINDS), 256).alias("base_sha256"),
                          privacy.as_text(*privacy.KINDS, "term").alias("spans"))


@query("op3_fingerprint")
def _(spark, sf_dir):
    return fingerprint.compared(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op4_warc", """
  select page_id, strlen(h) as payload_bytes,
         case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to,
         d as payload_digest
  from (select page_id, h, min(page_id) over (partition by h) as first, (
    select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + value, 1), '' order by i)
    from (select i, sum(((instr('0123456789abcdef', substr(s, (5 * i + b) // 4 + 1, 1)) - 1) >> (3 - (5 * i + b) % 4)) % 2 << (4 - b))::int as value
          from range(32) t(i), range(5) u(b) group by i)) as d
    from (select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as s from pages))""")
def _(spark, sf_dir):
    path = new_path(spark, "archives")
    warc.write_archives(warc.with_types(table(spark, sf_dir, "pages")), path)
    records = warc.read_records(warc.index(spark, path))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ASK = {"type": "object", "required": ["query", "step", "chars"], "additionalProperties": False, "properties": {
    "query": {"type": "string", "minLength": 1}, "step": {"type": "integer", "minimum": 0}, "chars": {"type": "integer", "maximum": 300}}}


def turns_as_tools(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """User turns read as calls and assistant turns as the results of the turn before; a call comes after the user turn two before."""
    turns = table(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    name = lambda back: F.concat_ws("-", F.col("conv_id"), F.col("turn") - back)
    calls = turns.filter("role = 'user'").select(
        F.col("conv_id").alias("conv"), name(0).alias("call_id"), "turn", F.lit("ask").alias("name"),
        F.to_json(F.struct(F.col("turn").alias("step"), text.alias("query"), F.length(text).alias("chars"))).alias("arguments"), name(2).alias("after"))
    results = turns.filter("role = 'assistant'").select(F.col("conv_id").alias("conv"), name(1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


@query("op2_tool_calls", """
  with u as (select *, row_number() over (partition by conv_id, turn % 2 order by turn) as k from conversations where role = 'user'),
       c as (select *, row_number() over (partition by conv_id, turn % 2, turn // 2 - k order by turn) - 1 as level from u)
  select c.conv_id, c.turn, c.conv_id || '-' || c.turn as call_id, c.level, a.conv_id is not null as answered,
         length(coalesce(c.text, '')) between 1 and 300 as valid,
         '{"arguments":{"chars":' || length(coalesce(c.text, '')) || ',"query":' || to_json(coalesce(c.text, '')) || ',"step":' || c.turn || '},"id":"'
           || c.conv_id || '-' || c.turn || '","name":"ask","result":' || coalesce(to_json(a.text), 'null') || '}' as canonical
  from c left join conversations a on a.conv_id = c.conv_id and a.turn = c.turn + 1 and a.role = 'assistant'""")
def _(spark, sf_dir):
    calls, results = turns_as_tools(spark, sf_dir)
    return tools.linked(calls, results, {"ask": ASK}).withColumnRenamed("conv", "conv_id").drop("problems")


@query("op5_near_dedup")
def _(spark, sf_dir):
    return near.near_classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


SHARDS = sharding.even_tree(16)


@query("op11_hash_tree")
def _(spark, sf_dir):
    more = sharding.with_shard(SHARDS, 16, "region0", "rack1")
    placed = sharding.sharded(table(spark, sf_dir, "documents"), SHARDS, more)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", F.col("later_shard").alias("grown_shard"))


@query("op12_collocations", """
  with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
  worded as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
  grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
            from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k)),
  counted as (select lang, phrase, k as m, count(*) as f from grams group by all),
  totals as (select lang, sum(f)::bigint as n from counted where m = 1 group by lang),
  candidates as (select * from counted where m > 1 and f >= 30),
  inside as (select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, max(f) as longer
             from (select lang, string_split(phrase, ' ') as w, f, m, k, unnest(range(1, m - k + 2)) as i from candidates, (select unnest([2, 3]) as k) where m > k) group by all),
  kept as (select c.* from candidates c left join inside i on c.lang = i.lang and c.phrase = i.phrase where i.longer is null or i.longer::hugeint * 100 < c.f::hugeint * 80),
  cuts as (select lang, phrase, f as a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') as head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') as tail
           from (select *, unnest(range(1, m)) as k from kept)),
  rated as (select c.lang, c.phrase, c.a, c.k, h.f as l, t.f as r, ((c.a::hugeint * 2000000) // (h.f + t.f))::bigint as score
            from cuts c join counted h on h.lang = c.lang and h.phrase = c.head join counted t on t.lang = c.lang and t.phrase = c.tail),
  best as (select * from rated qualify row_number() over (partition by lang, phrase order by score, k) = 1)
  select b.lang, row_number() over (partition by b.lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, score
  from best b join totals t on t.lang = b.lang qualify rank <= 2000""")
def _(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_token_links")
def _(spark, sf_dir):
    found = crosstoken.counted_links(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")
