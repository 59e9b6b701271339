import collections

import corpus_pipeline as cp
from sigloom.llm import quality
from sigloom.llm.common import written
from sigloom.llm.registry import tokenizer_path, training_labels
from tests.llm.test_dedup import brute_classes
from tests.llm.test_pack_mix import check_mix, check_packing
from tests.llm.util import SF, awkward, clashing, empty


def test_stages(spark):
    """Every stage against a plain version over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"] and cp.ORACLE_SQL is None
    frames = [docs]
    for name, stage in cp.STAGES:
        out = written(stage(spark, frames[-1], SF), f"test-{name}")
        assert name == "packing" or out.columns == docs.columns
        frames.append(out)
    rows = [f.collect() for f in frames]
    model = quality.fit(docs, training_labels(spark.read.parquet(f"{SF}/labels.parquet")))
    good = [r.doc_id for r in quality.scored(docs, model).collect() if r.score >= cp.KEEP_FROM]
    assert sorted(r.doc_id for r in rows[1]) == sorted(good)
    last = {}
    for r in rows[1]:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(last.values())
    ids = [r.doc_id for r in rows[2]]
    assert sorted(r.doc_id for r in rows[3]) == sorted(min(ids[i] for i in c) for c in brute_classes([(r.doc_id, r.text) for r in rows[2]]))
    by_id = {r.doc_id: r for r in rows[3]}
    assert all(by_id[r.doc_id] == r for r in rows[4])
    pieces = [r.asDict() | {"id": r.doc_id} for r in rows[5]]
    check_packing(pieces, [(r.doc_id, r.text) for r in rows[4]], 4096)


def test_mix_stage_is_near_its_targets(spark):
    from sigloom.llm import mixing
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = mixing.mixed(docs, carry=docs.columns).collect()
    check_mix(found, docs.collect())
    times = collections.Counter(r.doc_id for r in cp.mix(spark, docs, SF).collect())
    assert all(times[r.id] == r.copies + (0 < r.size <= 2 * r.cut_words) for r in found)


def test_awkward_input(spark):
    df = written(clashing(awkward(spark)), "awkward")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns and out.dtypes == df.dtypes, name
        out.collect()
        assert stage(spark, empty(spark), SF).collect() == []
    assert cp.pack_sequences(spark, df, SF).count() >= df.count() and cp.pack_sequences(spark, empty(spark), SF).collect() == []
    assert tokenizer_path()
