import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.llm import mixing, pack
from sigloom.llm.registry import QUERIES, tokenizer_path
from tests.llm.util import SCHEMA, SF, awkward, clashing, empty, words

HARD = ["", None, "<|endoftext|> x <|STARTOFTEXT|>", "a<|endoftext|>b", "it's I'LL we've ’s 'd", "naïve İstanbul ΣΑΣ straße ÀÉ×÷", "12345 3.14 a1b2",
        "\x1cab\x85cd\xa0ef", "é ́x", "😀😀 hello,world!! ###$$$", "日本語テキスト", "ﬁ Å Ω", "a​b", "_under_score_ -- \"q\"'s", "x" * 3000, "Thed,&&& (it.)"]


def reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [pack.END_ID] for x in texts]


def check_packing(rows, texts, window):
    """Exact round trip: pieces of a document join to its ids, and every sequence is gapless."""
    want = collections.Counter((k, tuple(i)) for (k, i) in zip([t[0] for t in texts], reference_ids([t[1] for t in texts])))
    by_doc = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    got, open_ = collections.Counter(), None
    for r in by_doc:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        if r["start"] == 0:
            assert open_ is None
            open_ = []
        assert len(open_) == r["start"]
        open_ += ids
        if len(open_) == r["doc_tokens"]:
            got[(r["id"], tuple(open_))] += 1
            open_ = None
    assert got == want and open_ is None
    at = 0
    for r in by_doc:
        assert r["sequence_id"] * window + r["offset"] == at and r["offset"] + r["length"] <= window
        at += r["length"]


@pytest.mark.parametrize("window", [64, 4096])
def test_packing_round_trip(spark, monkeypatch, window):
    monkeypatch.setattr(pack, "TEXT_BYTES", 50 if window == 64 else 8 << 20)  # batches in many parts, or in one
    df = awkward(spark, [(100 + i, t, "x", "y", 0) for i, t in enumerate(HARD)]).repartition(5)
    rows = pack.packed(clashing(df), tokenizer_path(), window=window).collect()
    check_packing([r.asDict() for r in rows], [(r.doc_id, r.text) for r in df.collect()], window)


def test_packing_query_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = {r.doc_id: i for r, i in zip(docs, reference_ids([r.text for r in docs]))}
    got = QUERIES["op10_packing"](spark, SF).collect()
    for r in got:
        part = np.asarray(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    assert pack.packed(empty(spark), tokenizer_path()).collect() == []


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    """Shares by weight; what is above the limit goes to the others by weight, again and again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, active = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and active:
        total = sum(weight[s] for s in active)
        for s in list(active):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(active):
            if target[s] > limit * sizes[s]:
                left += target[s] - limit * sizes[s]
                target[s] = limit * sizes[s]
                active.discard(s)
    return target


def check_mix(rows, docs):
    sizes = collections.Counter()
    for d in docs:
        sizes[d.source] += len(words(d.text))
    target = brute_targets(dict(sizes))
    source = {}
    for d in docs:
        source.setdefault(d.doc_id, d.source)
    taken = collections.Counter()
    for r in rows:
        s = source[r.id]
        assert r.source_size == sizes[s] and math.isclose(r.target, target[s], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size + r.cut_words
        taken[s] += r.taken
    assert collections.Counter(r.size for r in rows) == collections.Counter(len(words(d.text)) for d in docs)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1.5


def test_mixing(spark):
    df = awkward(spark, [(1000 + i, "w " * (1 + i * i % 97), "x", f"s{i % 9}", 0) for i in range(700)])
    first, second = mixing.mixed(clashing(df)).collect(), mixing.mixed(df.repartition(3)).collect()
    check_mix(first, df.collect())
    key = lambda r: (str(r.id), r.size, r.taken)
    assert sorted(map(key, first)) == sorted(map(key, second))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_mix(mixing.mixed(docs).collect(), docs.collect())
    assert mixing.mixed(empty(spark)).collect() == []


def test_mix_expectation(spark):
    """Over many seeds every document is taken about as often as its share says."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), "x", "a" if i % 3 else "b", 0) for i in range(40)], SCHEMA)
    runs = 24
    taken = collections.Counter()
    for seed in range(runs):
        rows = mixing.mixed(docs, seed=seed).collect()
        for r in rows:
            taken[r.id] += r.taken / r.size
    share = {r.id: r.target / r.source_size for r in rows}
    errors = [taken[i] / runs - share[i] for i in share]
    assert abs(sum(errors)) / len(errors) < 0.05 and max(map(abs, errors)) < 0.45


def test_mix_documents(spark):
    df = clashing(awkward(spark))
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    counts = collections.Counter(r.doc_id for r in out.collect())
    assert max(counts.values()) <= 4  # the repeated row may come twice for either copy
    assert mixing.mix_documents(empty(spark)).collect() == []


def test_word_count(spark):
    df = awkward(spark)
    got = df.select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    assert all(r.n == len(words(r.text)) for r in got)
