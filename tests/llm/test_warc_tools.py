import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sigloom.llm import tools, warc
from sigloom.llm.common import new_path

PAGES = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://a/4\r\nX: y", ""), (5, "http://b/é", "é😀\r\n\r\nWARC/1.1\r\n" * 50),
         (0, "http://a/0", "<p>x</p>"), (None, "http://n", "<p>x</p>"), (7, "u", "same"), (7, "u", "same"), (8, "big", "z" * 300_000), (9, "", "z" * 300_000)]


def round_trip(spark, pages, **options):
    path = new_path(spark, "warc-test")
    warc.write_archives(warc.with_types(pages, **options), path)
    return warc.index(spark, path)


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("digest", F.lit("x")).withColumn("first", F.lit(1)).repartition(3)
    index = round_trip(spark, pages)
    got = sorted(warc.read_records(index).collect(), key=lambda r: (r.page_id is not None, r.page_id or 0))
    assert len(got) == len(PAGES)
    first = {}
    for key, _, html in PAGES:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    texts = {(k): h or "" for k, _, h in PAGES}
    for r in got:
        body = texts[r.page_id].encode()
        assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        if r.page_id == first[body.decode()]:
            assert (r.record_type, r.refers_to, r.payload) == ("response", None, body)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", first[body.decode()], None)
    assert {r.url for r in got} >= {None, "http://a/4%0D%0AX: y", "http://b/é"}


def test_warc_selected_and_small(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").coalesce(1)
    index = round_trip(spark, pages, least_bytes=100)
    assert index.filter("record_type = 'revisit'").count() == 1  # only the long payload is shared
    some = warc.read_records(index.filter("page_id in (1, 8)")).collect()
    assert sorted((r.page_id, bytes(r.payload)[:4]) for r in some) == [(1, b"<p>x"), (8, b"zzzz")]
    assert warc.read_records(index.filter("page_id = -1")).collect() == []


def test_warc_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_records(round_trip(spark, pages)).collect() == []


CALLS = "conv bigint, call_id string, turn bigint, name string, arguments string, after string"
RESULTS = "conv bigint, call_id string, turn bigint, content string"
SCHEMA = {"find": {"type": "object", "required": ["q"], "additionalProperties": False, "properties": {
    "q": {"type": "string", "minLength": 2}, "n": {"type": "integer", "minimum": 1, "maximum": 9}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}}}}}


def test_tool_calls(spark):
    calls = [(1, "a", 0, "find", '{"q": "xy", "n": 2.0}', None), (1, "b", 1, "find", '{"tags": ["b", "c"], "q": "é"}', "a"), (1, "c", 2, "other", '{"z": 1, "a": {"y": 1e2, "b": null}}', "b"),
             (1, "d", 3, "find", "[1]", "e"), (1, "e", 4, "find", None, "d"), (1, "f", 5, "find", '{"q": NaN}', "gone"), (2, "a", 0, "find", '{"q": "other chat", "n": 10}', None),
             (1, "a", 9, "find", "{}", "c"), (1, None, 1, "find", "{}", None), (None, "k", 0, "find", '{"q": "no conversation"}', None), (1, "g", 6, None, "{}", "e")]
    results = [(1, "a", 1, "first"), (1, "a", 0, "zero"), (1, "c", 3, None), (2, "zzz", 0, "lost"), (None, "k", 1, "yes"), (1, None, 1, "x")]
    links = tools.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMA)
    got = {(r.conv, r.call_id): r for r in links.collect()}
    assert len(got) == 9
    assert {k[1]: v.level for k, v in got.items() if k[0] == 1} == {"a": 0, "b": 1, "c": 2, "d": None, "e": None, "f": 0, "g": None}
    assert got[1, "a"].canonical == '{"arguments":{"n":2,"q":"xy"},"id":"a","name":"find","result":"zero"}' and got[1, "a"].problems == ["$.n: not of type integer"]
    assert got[1, "b"].problems == ["$.q: too short", "$.tags[1]: not one of the allowed values"] and not got[1, "b"].answered
    assert got[1, "c"].valid and json.loads(got[1, "c"].canonical)["arguments"] == {"a": {"b": None, "y": 100}, "z": 1}
    assert got[1, "d"].problems == ["$: not of type object"] and got[1, "e"].problems == ["$: not JSON"] == got[1, "f"].problems
    assert got[2, "a"].problems == ["$.n: too large"] and got[None, "k"].answered and got[1, "g"].valid
    order = {r.call_id: r.position for r in tools.transcripts(links).filter("conv = 1").collect()}
    assert order == {"a": 0, "f": 1, "b": 2, "c": 3, "d": 4, "e": 5, "g": 6}


def test_tool_call_levels_long_chain(spark):
    n = 70
    calls = spark.createDataFrame([(1, f"c{i}", i, "x", "{}", f"c{i - 1}" if i else None) for i in range(n)], CALLS)
    assert {r.call_id: r.level for r in tools.levels(calls).collect()} == {f"c{i}": i for i in range(n)}
    none = calls.filter("conv = 9")
    assert tools.linked(none, spark.createDataFrame([], RESULTS), {}).collect() == []


@pytest.mark.parametrize("raw", ['{"z": 1e400}', '{"q": "\\ud800"}', '{"a": ' + "[" * 3000 + "]" * 3000 + "}", '{"x": NaN}', "[1]", None])
def test_arguments_that_cannot_be_written_are_invalid(spark, raw):
    calls = spark.createDataFrame([("c", "1", 1, "f", raw, None)], "conv string, call_id string, turn int, name string, arguments string, after string")
    results = spark.createDataFrame([("c", "1", 2, "x"), ("c", "9", 3, "lost"), ("c", None, 4, "lost")], "conv string, call_id string, turn int, content string")
    row = tools.linked(calls, results, {}).first()
    assert not row.valid and row.answered and '"id":"1"' in row.canonical
    assert tools.orphans(calls, results).count() == 2


def test_unknown_schema_keywords_are_an_error(spark):
    calls = spark.createDataFrame([], "conv string, call_id string, turn int, name string, arguments string, after string")
    results = spark.createDataFrame([], "conv string, call_id string, turn int, content string")
    for schema in ({"pattern": "x"}, {"properties": {"a": {"anyOf": []}}}, {"items": {"$ref": "#"}}, {"type": ["string", "null"]}):
        with pytest.raises(ValueError):
            tools.linked(calls, results, {"f": schema})
