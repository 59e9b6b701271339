"""Grounding against brute force, and golden phrases for the quality rules."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.operators import heuristics as heu
from sigloom.operators import match
from sigloom.plans import evaluation
from tests.conftest import rows


def test_permutation_equals_brute_force(spark):
    rnd = random.Random(7)
    vocabulary = ["ab", "abc", "bc", "ca", "cab", "bca"]
    data = []
    for i in range(3000):
        text = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 7)))
        signal = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 4)))
        data.append((i, signal, text))
    df = spark.createDataFrame(data, "i int, s string, t string")
    got = dict(rows(df.select("i", match.permutation_match(match._long_words(F.col("s")), match._long_words(F.col("t"))))))
    want = {i: any(" ".join(p) in t for p in itertools.permutations(s.split())) for i, s, t in data}
    assert got == want and sum(want.values()) > 300


def brute_ground(signal, texts):
    words = [w for w in signal.split() if len(w) > 1]
    for kind in ("exact", "permutation"):
        for name, t in texts.items():
            tokens = " ".join(w for w in t.split() if len(w) > 1)
            if kind == "exact" and " ".join(signal.split()) in " ".join(t.split()):
                return kind, name, 0.0, False
            if kind == "permutation" and any(" ".join(p) in tokens for p in itertools.permutations(words)):
                return kind, name, 0.0, False
    grams = list(dict.fromkeys(" ".join(words[i:i + s]) for s in range(2, len(words)) for i in range(len(words) - s + 1)))
    best, hits_total, others = None, 0, False
    for name, t in texts.items():
        tokens = [w for w in t.split() if len(w) > 1]
        hits = [g for g in grams if any(tokens[i:i + len(g.split())] == g.split() for i in range(len(tokens)))]
        rest = len(words) >= 2 and all(w in tokens for w in set(words) - {w for g in hits for w in g.split()})
        others = others or rest
        hits_total += len(hits)
        if hits:
            score = ((1000 if rest else 0) + max(len(g.split()) for g in hits), len(hits) / len(grams))
            if best is None or score > best[0]:
                best = (score, name)
    kind = "no_match" if not hits_total else "ngram+non ngram" if others else "ngram"
    return kind, best[1] if best else None, round(hits_total / len(grams), 6) if hits_total else 0.0, others


def test_ground_equals_brute_force(spark):
    rnd = random.Random(11)
    vocabulary = ["red", "cup", "tea", "blue", "big", "x", "mug"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, n)))
    data = [(i, text(5), text(5), text(5), text(12)) for i in range(1500)]
    df = spark.createDataFrame(data, "item_id int, signal string, title string, aspects string, desc string")
    got = {r.item_id: (r.match_type, r.match_column, round(r.ngram_coverage, 6), r.non_ngram_match) for r in match.ground(df).collect()}
    want = {i: brute_ground(s, {"title": t, "aspects": a, "desc": d}) for i, s, t, a, d in data}
    assert got == want
    assert {k for k, *_ in want.values()} == {"exact", "permutation", "ngram", "ngram+non ngram", "no_match"}


def test_ngram_lists_equal_brute_force(spark):
    rnd = random.Random(5)
    vocabulary = ["red", "cup", "tea", "redcup", "ed", "x"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, n)))
    data = [(i, text(9), text(6), text(12), text(20)) for i in range(800)]
    df = spark.createDataFrame(data, "item_id int, signal string, title string, aspects string, desc string")
    shown = 0
    for r in match.ground(df).collect():
        words = [w for w in r.signal.split() if len(w) > 1]
        grams = {" ".join(words[i:i + s]) for s in range(2, len(words)) for i in range(len(words) - s + 1)}
        held = [" " + " ".join(w for w in t.split() if len(w) > 1) + " " for t in (r.title, r.aspects, r.desc)]
        counts = {g: n for g in grams if (n := sum(f" {g} " in t for t in held))}
        if not r.match_type.startswith("ngram"):
            counts, grams = {}, set()
        assert r.ngram_match_counts == counts and set(r.all_ngrams) == grams and len(r.all_ngrams) == len(grams)
        shown += bool(counts)
    assert shown > 150


def test_long_signal_needs_no_list_of_ngrams(spark):
    words = [f"w{i}" for i in range(2000)]
    desc = " ".join([*words[:1200], "zz", *words[1200:]])
    df = spark.createDataFrame([(1, " ".join(words), "t", None, desc), (2, "ab " * 1999 + "cd", "ab ab", "", "ab " * 5)],
                               "item_id int, signal string, title string, aspects string, desc string")
    got = rows(match.ground(df), "item_id", "match_type", "match_column", "ngram_coverage", "non_ngram_match")
    pairs = lambda n: n * (n - 1) // 2
    assert got[0] == (1, "ngram+non ngram", "desc", (pairs(1200) + pairs(800)) / (pairs(2000) - 1), True)
    # n-grams of "ab ... ab cd" are runs of "ab" (2 .. 1,999 words) and those that end in "cd" (2 .. 1,999)
    assert got[1] == (2, "ngram", "desc", (1 + 4) / (1998 + 1998), False)


GOLDEN = [  # phrase, repeated_words, numerically_dominant, numbers_to_exclude
    ("very fine extra fine", 1, 0, 0), ("no fade no fingerprints", 0, 0, 0), ("soft soft cotton", 0, 0, 0), ("soft soft soft", 1, 0, 0),
    ("soft warm soft warm", 1, 0, 0), ("18v lithium 2ah battery", 0, 0, 1), ("12 34 56", 0, 1, 1), ("50 x 60 in", 0, 0, 1),
    ("10 000 hours lifespan", 0, 0, 0), ("60 polyester 40 cotton", 0, 0, 0), ("5 wins", 0, 0, 1), ("12 month warranty", 0, 0, 0),
    ("a a a word", 1, 0, 1), ("1 2 3 4", 0, 1, 1), ("part 123456 hours", 0, 0, 0), ("code 123456", 0, 0, 1), ("24 x 18 in wall print", 0, 0, 0)]


def test_golden_phrases(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "s string")
    got = {r[0]: tuple(r)[1:] for r in df.select("s", heu.repeated_words(F.col("s")), heu.numerically_dominant(F.col("s")), heu.numbers_to_exclude(F.col("s"))).collect()}
    assert got == {g[0]: g[1:] for g in GOLDEN}


def test_number_rule_equals_python_regex(spark):
    rnd = random.Random(3)
    parts = ["12", "3", "x", "in", "4.5", "100000", "hours", "word", "a", "size", "10", "000", "lot", "set", "watts", "ft", "print", "17520", "y", "12v"]
    texts = sorted({" ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 7))) for _ in range(4000)})

    def plain(text):
        flat = re.sub(fv.SPLIT_THOUSANDS, lambda m: m.group(1), text)
        if any(re.search(p, flat) for p in fv.NUMBER_ACCEPT):
            return 0
        return int(any(re.search(p, flat) for p in fv.NUMBER_REJECT))

    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert dict(rows(df.select("s", heu.numbers_to_exclude(F.col("s"))))) == {t: plain(t) for t in texts}


def test_rules_split_and_errors(spark):
    df = spark.createDataFrame([(1, "soft warm", "soft warm cup", "", ""), (2, "free shipping", "cup", "", "free shipping today"), (3, "quiet motor", "cup", "", "very quiet motor")],
                               "item_id int, signal string, title string, aspects string, desc string")
    done = evaluation.evaluate(df)
    assert rows(heu.kept(done), "item_id") == [(3,)] and rows(heu.excluded(done), "item_id") == [(1,), (2,)]
    assert not set(match.NGRAM_COLUMNS) & set(done.columns)
    with pytest.raises(ValueError, match="unknown rules"):
        heu.apply_rules(match.ground(df), ["nonsense"])


def test_rules_run_once_when_filtered(spark):
    df = spark.createDataFrame([(1, "a b", "t", "", "d")], "item_id int, signal string, title string, aspects string, desc string")
    plan = heu.kept(evaluation.evaluate(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\b\d+\s+in\s+\d+\s+\w{3,}\b") == 1


def test_curation_reasons(spark):
    df = spark.createDataFrame([(1, "red cup", "", "Nice red cup. Big.", "", ""), (2, "free cup", "", "A free cup.", "", ""), (3, "big red", "", "Nice red cup. Big.", "", ""), (4, "", "junk", "t", "", "")],
                               "item_id int, signal_m string, text_m string, title string, aspects string, desc string")
    assert rows(match.curate(df, ["m"]), "item_id", "reject_reason") == [(1, None), (2, "denied_words"), (3, "not_in_sentence"), (4, "unparsed")]
