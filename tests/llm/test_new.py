"""Hash tree, collocations and cross-tokenizer links against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from sigloom.llm import crosstoken, phrases, sharding
from sigloom.llm.registry import QUERIES, SHARDS, tokenizer_path
from tests.llm.util import SCHEMA, SF, awkward, clashing, empty

# ---- hash tree


def plain_shard(key, tree):
    import xxhash
    text, since, path = "" if key is None else str(key), None, []
    for depth in range(3):
        weights = collections.defaultdict(float)
        for s in tree:
            name = "|".join([f"{s.since}", s.region, s.rack, str(s.shard)][:depth + 2])
            if not path or name.startswith(path[-1] + "|"):
                weights[name] += s.weight
        arrival = lambda n: -math.log(((xxhash.xxh64_intdigest(f"{text}/{n}".encode(), seed=42) >> 11) + 0.5) / (1 << 53)) / weights[n]
        path.append(min(weights, key=lambda n: (arrival(n), n)))
    return int(path[-1].rsplit("|", 1)[1])


def shards(spark, keys, tree):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", sharding.shard_of(F.col("k"), tree).alias("s"))
    return {r.k: r.s for r in rows.collect()}


def test_tree_draws(spark):
    tree = sharding.with_shard(sharding.with_weight(sharding.even_tree(6, 2, 2), 1, 2.5), 9, "region0", "rack1", 0.5)
    got = shards(spark, [*range(400), None], tree)
    assert got == {k: plain_shard(k, tree) for k in got}


@pytest.mark.parametrize("region,rack", [("region0", "rack0"), ("region1", "rack9"), ("region7", "rack0")])
def test_one_more_shard_takes_only_into_itself(spark, region, rack):
    keys = range(6000)
    trees = [sharding.even_tree(16)]
    for i in range(3):
        trees.append(sharding.with_shard(trees[-1], 16 + i, region, rack))
    placed = [shards(spark, keys, t) for t in trees]
    for i, (a, b) in enumerate(zip(placed, placed[1:])):
        moved = {b[k] for k in keys if a[k] != b[k]}
        assert moved == {16 + i}
    sizes = collections.Counter(placed[-1].values())
    assert len(sizes) == 19 and all(abs(n - 6000 / 19) < 100 for n in sizes.values())


def test_weights_move_only_their_own(spark):
    keys = range(4000)
    tree = sharding.even_tree(8, 2, 2)
    more, less = sharding.with_weight(tree, 3, 3.0), sharding.with_weight(tree, 3, 0.25)
    a, b, c = (shards(spark, keys, t) for t in (tree, more, less))
    assert {b[k] for k in keys if a[k] != b[k]} == {3}
    assert {a[k] for k in keys if a[k] != c[k]} >= {3}
    # A lower weight sends documents only out of the subtrees above the shard.
    assert all(a[k] in (0, 1, 2, 3) for k in keys if a[k] != c[k])
    assert abs(sum(s == 3 for s in b.values()) - 1200) < 120
    assert sharding.with_weight(more, 3, 1.0) == tree
    with pytest.raises(ValueError):
        sharding.with_weight(tree, 99, 1.0)
    with pytest.raises(ValueError):
        sharding.with_shard(tree, 3, "r", "k")
    with pytest.raises(ValueError):
        shards(spark, [1], ())


def test_sharded_rows(spark):
    later = sharding.with_shard(SHARDS, 16, "region0", "rack1")
    df = clashing(awkward(spark))
    out = sharding.sharded(df, SHARDS, later).collect()
    assert len(out) == df.count()
    expected = sorted(((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect()), key=repr)
    assert sorted(((r.id, r.size, r.text_crc32) for r in out), key=repr) == expected
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.shard == plain_shard(r.id, SHARDS) and r.later_shard in (r.shard, 16)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.sharded(empty(spark), SHARDS).count() == 0
    moved = sharding.moves(sharding.sharded(df, SHARDS, later)).collect()
    assert sum(m.rows for m in moved) == sum(r.shard != r.later_shard for r in out)


def test_tree_query(spark):
    out = QUERIES["op11_hash_tree"](spark, SF).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.law == "key" and (r.grown_shard == r.shard or r.grown_shard == 16)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())

# ---- collocations


def plain_collocations(rows, least, top=2000, share=80):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(4, len(w) - i) + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    dropped = set()
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inner = lang, p[i:i + k]
                if 100 * a >= share * candidates[inner]:
                    dropped.add(inner)
    out = collections.defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) not in dropped:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def noisy(seed, n, many=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(many)] + ["É", "😀x", "a\x01b", "New", "york", "new", "it's", "of", "the"]
    common = ["new york city of the", "of the", "a\x01b New york"]
    texts = []
    for i in range(n):
        parts = [rng.choice(common) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(0, 60))]
        texts.append("".join(p + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", " "]) for p in parts))
    return [(t, rng.choice(["en", "de", None])) for t in texts]


@pytest.mark.parametrize("entries,burst,batch", [(1_200_000, 4096, 8 << 20), (60, 5, 200), (300, 20, 3000)])
def test_collocations(spark, monkeypatch, entries, burst, batch):
    monkeypatch.setattr(phrases, "BURST", burst)
    monkeypatch.setattr(phrases, "RUN_BYTES", batch)
    monkeypatch.setattr(phrases, "STEP", 1 << 18 if entries > 1000 else 64)
    rows = noisy(entries, 150)
    df = spark.createDataFrame([(i, t, lang, None, None) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=4, top=50, trie_entries=entries).collect())
    assert got == plain_collocations(rows, 4, 50) and len(got) > 60


def test_collocations_awkward(spark):
    df = clashing(awkward(spark))
    got = sorted(tuple(r) for r in phrases.collocations(df, least=2).collect())
    assert got == plain_collocations([(r.text, r.lang) for r in df.collect()], 2)
    assert phrases.collocations(empty(spark)).count() == 0
    one_word = spark.createDataFrame([(1, "x" * 3_000_000 + " y" * 70_000, None, None, 1)], SCHEMA)
    assert [tuple(r) for r in phrases.collocations(one_word).collect()] == plain_collocations([("x" * 3_000_000 + " y" * 70_000, None)], 30)


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    row = spark.range(1).select(F.lit(9 * 10 ** 17).alias("a"), F.lit(9 * 10 ** 17 + 1).alias("l"), F.lit(9 * 10 ** 17 + 3).alias("r"))
    assert row.select(F.expr(phrases.SCORE)).first()[0] == 2_000_000 * 9 * 10 ** 17 // (18 * 10 ** 17 + 4)


def test_places():
    import pyarrow as pa
    p = phrases.Places(pa.array(["A b,C", "", "d\te", "ÄB"], pa.large_string()))
    assert [p.words[i].as_py().decode() for i in p.word] == ["a", "b", "c", "d", "e", "Äb"]
    assert p.text.tolist() == [0, 0, 0, 2, 2, 3]
    assert [a == b for a, b in zip(p.piece, p.piece[1:])] == [True, False, False, True, False]

# ---- cross-tokenizer links


A_PATH, B_PATH = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def plain_links(rows):
    a_tool, b_tool = crosstoken.ByteLevel(A_PATH), crosstoken.Pieces(B_PATH)
    docs, total = [], collections.Counter()
    for key, text in rows:
        a = b = []
        if text:
            a, b = a_tool.tool.encode(" " + text, add_special_tokens=False).ids, b_tool.tool.encode(text)
            whole = b" " + text.encode()
            if b"".join(a_tool.bytes[i] for i in a) != whole or b"".join(b_tool.bytes[i] for i in b) != whole:
                a = b = []
        i = j = x = y = 0
        links, groups, ga, gb = [], [], [], []
        while i < len(a):
            links.append((a[i], b[j]))
            ea, eb = x + len(a_tool.bytes[a[i]]), y + len(b_tool.bytes[b[j]])
            if ea <= eb:
                ga.append(a[i])
            if eb <= ea:
                gb.append(b[j])
            if ea == eb:
                groups.append((ga, gb))
                ga, gb = [], []
            if ea <= eb:
                i, x = i + 1, ea
            if eb <= ea:
                j, y = j + 1, eb
        total.update(links)
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        docs.append((key, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    best = collections.defaultdict(int)
    for (_, y), n in total.items():
        best[y] = max(best[y], n)
    return sorted([(key, na, nb, ng, len(links), sum(total[p] == best[p[1]] for p in links), sum(total[p] for p in links), sha) for key, na, nb, ng, links, sha in docs], key=repr)


HARD = ["  two  blanks ", " ", "\n", "a b c", "tab\there", "<|endoftext|> <s></s> <unk> <0x41>", "▁ under ▁x", "naïve Ünder ÿ ×÷", "x 　 y", "é ﬁ ﾊﾟ",
        "\x00\x01 ctrl \x1c x", "日本語 text 漢字", "don't we'll I'D 12345 3.14", "end ", " start", "many     blanks\r\n\r\nlines \n x", "\u0085 nel", "a " * 50, "é è"]


def links(df, **options):
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted([tuple(r) for r in crosstoken.counted_links(df, A_PATH, B_PATH, **options).select(*columns).collect()], key=repr)


@pytest.mark.parametrize("segment,block", [(1 << 16, 64), (50, 3)])
def test_links(spark, monkeypatch, segment, block):
    monkeypatch.setattr(crosstoken, "SEGMENT", segment)
    monkeypatch.setattr(crosstoken, "BLOCK", block)
    monkeypatch.setattr(crosstoken, "FAN", 2)
    more = [(100 + i, t, "x", "y", 1) for i, t in enumerate(HARD)]
    if block < 64:
        monkeypatch.setattr(crosstoken, "SLICE", 7)
        df = spark.createDataFrame(more, SCHEMA).repartition(3)
    else:
        df = clashing(awkward(spark, more))
    assert links(df) == plain_links([(r.doc_id, r.text) for r in df.collect()])


def test_links_of_whole_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op13_token_links"](spark, SF).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain_links([(r.doc_id, r.text) for r in df.collect()])


def test_links_empty(spark):
    assert links(empty(spark)) == []
    only = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], SCHEMA)
    assert links(only) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash():
    import numpy as np
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 5000).astype(np.uint64))
    segments = 7
    parts = [crosstoken.perfect(keys[crosstoken.segment_of(keys, segments) == s]) for s in range(segments)]
    table = crosstoken.Perfect(segments, 0, [p[0] for p in parts], [p[1] for p in parts], np.concatenate([p[2] for p in parts]))
    assert sorted(table(keys).tolist()) == list(range(len(keys)))
    strangers = keys + np.uint64(1 << 50)
    assert (table(strangers) == -1).all()
    some = crosstoken.Perfect(segments, 2, [p[0] for p in parts[2:5]], [p[1] for p in parts[2:5]], np.concatenate([p[2] for p in parts[2:5]]))
    inside = np.isin(crosstoken.segment_of(keys, segments), [2, 3, 4])
    assert ((some(keys) >= 0) == inside).all()


def test_every_name_passes_its_own_keyword(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from sigloom.llm import licenses
    for label, keyword, name in licenses.NAMES:
        @settings(derandomize=True, max_examples=40, database=None, deadline=None, suppress_health_check=list(HealthCheck))
        @given(st.from_regex(name, fullmatch=True))
        def inside(example):
            assert keyword in f" {example} ", (label, keyword, example)
        inside()
    docs = spark.createDataFrame([(1, "This is under the FreeBSD License."), (2, "This is under the Simplified BSD License.")], "doc_id long, text string")
    assert [r.labels for r in licenses.scanned(docs).orderBy("doc_id").select("labels").collect()] == ["bsd-2-clause", "bsd-2-clause"]
