import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sigloom.llm import near, radix
from tests.llm.util import SCHEMA, awkward, clashing, empty, probability_jaccard, shingles


def exact(df, **options):
    return [tuple(r) for r in radix.exact_groups(df, carry=[], **options).select("id", "keep_id", "group_size", "kept", "text_sha256").collect()]


def brute_exact(rows):
    out = []
    groups = {}
    for key, text, *_ in rows:
        groups.setdefault(text or "", []).append(key)
    for key, text, *_ in rows:
        ids = groups[text or ""]
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        out.append((key, top, len(ids), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("first,growth", [(64, 64), (3, 2)])
def test_exact_groups(spark, first, growth):
    df = awkward(spark, [(20, "abc", "x", "y", 1), (21, "abcd", "x", "y", 1), (22, "abc", "x", "y", 1), (23, "a" * 64, "", "", 0), (24, "a" * 65, "", "", 0), (25, "a" * 64, "", "", 0)])
    got = exact(df, first=first, growth=growth if first == 64 else 4)
    assert sorted([g[:3] + g[4:] for g in got], key=repr) == sorted(brute_exact(df.collect()), key=repr)
    kept = [g for g in got if g[3]]
    assert len(kept) == len({r.text or "" for r in df.collect()})  # one row of each text, also where id and text repeat
    assert all(g[0] == g[1] for g in kept)


def test_exact_columns_and_empty(spark):
    df = clashing(awkward(spark))
    kept = radix.drop_exact_copies(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    assert {r.doc_id for r in kept.collect()} == {2, 4, 5, None, 7, 8, 9, 10, 11}
    assert radix.drop_exact_copies(empty(spark)).collect() == []
    assert exact(empty(spark)) == []


def family(n, seed, changes):
    rng = random.Random(seed)
    base = [f"v{rng.randrange(9999)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(changes + 1)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
        out.append(" ".join(w))
    return out


def brute_classes(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and probability_jaccard(sets[i], sets[j]) >= 0.8 - 1e-9:
                root[find(i)] = find(j)
    return {frozenset(k for k in range(len(rows)) if find(k) == r) for r in {find(i) for i in range(len(rows))}}


@pytest.mark.parametrize("block", [256, 12])
def test_near_classes(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK_TEXTS", block)  # small blocks: a family is compared in several tasks and two phases
    texts = family(50, 1, 6) + family(30, 2, 1) + ["word " * 40, "word " * 41, "Word " * 40, "unique text of its own, quite short"]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    got = near.near_classes(df).collect()
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, set()).add(r.id)
    assert {frozenset(c) for c in classes.values()} == brute_classes(df.collect())
    assert all(r.class_size == len(classes[r.class_id]) and r.class_id == min(classes[r.class_id]) for r in got)


def test_main_class_is_the_same_in_all_tasks(spark):
    import numpy as np
    rows = []
    for cluster in range(12):  # two neighbouring families of texts that repeat their lines, in three blocks
        rng = random.Random(cluster)
        for node in range(36):
            first = 2 * (node % 2)
            base = random.Random(100 * cluster + node % 2)
            weights = [max(1, base.randrange(2, 6) + (rng.choice((-1, 1)) if rng.random() < 0.3 else 0)) for _ in range(20)]
            block = rng.randrange(3)
            text = [np.arange(first, first + 20, dtype=np.uint32).tobytes(), np.array(weights, np.uint32).tobytes()]
            rows += [(cluster, task, node, *map(bytearray, text), block == 0) for task in (range(3) if block == 0 else [block])]
    tasks = spark.createDataFrame(rows, "cluster bigint, task bigint, node bigint, shingles binary, weights binary, first boolean")
    centres = near._compare(tasks, 0.8).filter("main").groupBy("cluster").agg(F.count_distinct("b").alias("n")).collect()
    assert [r.n for r in centres] == [1] * 12


def test_near_awkward(spark):
    df = awkward(spark)
    got = sorted(((r.id, r.class_id, r.class_size) for r in near.near_classes(clashing(df)).collect()), key=repr)
    assert got == sorted([(1, 1, 2), (2, 1, 2), (3, 3, 3), (4, 3, 3), (5, 3, 3), (None, None, 1), (7, 7, 2), (8, 7, 2), (9, 9, 2), (9, 9, 2), (10, 10, 1), (11, 11, 1)], key=repr)
    kept = near.drop_near_copies(clashing(df))
    assert kept.columns == clashing(df).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, None, 7, 9, 10, 11], key=repr)
    assert near.near_classes(empty(spark)).collect() == [] and near.drop_near_copies(empty(spark)).collect() == []


def test_signature_estimates_similarity():
    import numpy as np
    import pyarrow as pa

    from sigloom.llm.common import Words
    texts = ["a b c d e f g h " * 3 + "tail", "a b c d e f g h " * 2 + "tail other words here", *family(2, 5, 4)]
    sets = near.weighted_shingles(Words(pa.array(texts)), len(texts))
    sign = near.signatures(*sets, len(texts), registers=4000)
    for i, j in ((0, 1), (2, 3)):
        exactly = probability_jaccard(shingles(texts[i]), shingles(texts[j]))
        assert abs((sign[i] == sign[j]).mean() - exactly) < 0.04
    assert abs(near.probability_jaccard(*[x for k in (0, 1) for x in (sets[1][sets[0] == k], sets[2][sets[0] == k])]) - probability_jaccard(shingles(texts[0]), shingles(texts[1]))) < 1e-9
    assert np.array_equal(sign, near.signatures(*sets, len(texts), registers=4000))


def test_components(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100), (103, 101), (103, 102)], "a bigint, b bigint")
    got = {r.node: r.root for r in near.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)}
    assert near.components(links.filter(F.lit(False))).collect() == []
