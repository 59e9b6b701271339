import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.llm import fingerprint, licenses, privacy, quality
from sigloom.llm.registry import QUERIES
from tests.llm.util import SCHEMA, SF, awkward, clashing, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LICENSE_TEXTS = ["MIT License. mit  license, Mit-License", "Released under the MIT License.", "GNU Lesser General Public License version 2",
                 "mit license mit license", "licensed under CC BY-NC 4.0", "submit license", "THE APACHE  LICENSE, Version 2.0 (the license)", "été mit licenseé",
                 "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: Apache-2.0", "all rights reserved", "K mit license"]


def brute_license(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    places = [(k, label) for phrase, label in licenses.BASE_PHRASES.items() for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
    return len(w), len(places), min(places)[0] if places else None, max(p for p, _ in places) if places else None, ",".join(sorted({x for _, x in places}))


def test_licenses(spark):
    df = awkward(spark, [(100 + i, t, "x", "y", 0) for i, t in enumerate(LICENSE_TEXTS)])
    texts = [r.text for r in df.collect()]
    got = licenses.scanned(clashing(df)).collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got] == [brute_license(t) for t in texts]
    labels = {t: r.labels for t, r in zip(texts, got)}
    assert labels["Released under the MIT License."] == "mit" and labels["licensed under CC BY-NC 4.0"] == "cc-by-nc"
    assert labels["GNU Lesser General Public License version 2"] == "gpl,lgpl"  # the base label stays
    assert labels["submit license"] == "" and labels["SPDX-License-Identifier: Apache-2.0"] == "apache" and labels["all rights reserved"] == "proprietary"
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got)
    assert licenses.scanned(empty(spark)).collect() == []


def test_license_suppression(spark):
    df = spark.createDataFrame([(1, "licensed under the gnu lesser general public license version 3", "", "", 0)], SCHEMA)
    row = licenses.scanned(df).select("detections").first()[0]
    assert {d.label for d in row} == {"gpl", "lgpl"}  # both rules fire
    assert len(licenses.rules()) > 200 and len({r[3] for r in licenses.rules()}) > 30


def test_license_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op7_license_scan"](spark, SF).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_license(docs[r.doc_id])


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
PII_TEXTS = ["a@b.com_x@y.org, q@w..de a@b", "1.2.3.4.5.6.7.8 999.1.1.1 0000255.1.1.1 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111-2 4111111111111111", "é😀 4111111111111111",
             "+1 (743) 555-3824 +49-1 +123456789012345678 ++1 222 333 444.", "9" * 40_000, "a" * 40_000 + "@", "1." * 5_000, "x@y.z" * 300, "4111 1111 1111 1111 " * 200]


def brute_pii(text):
    def valid(kind, value):
        d = [int(c) for c in value if c.isdigit()]
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and sum((x * 2 - 9 if x > 4 else x * 2) if i % 2 else x for i, x in enumerate(d[::-1])) % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if valid(k, m.group())] for k, p in PATTERNS.items()}


def test_personal_data(spark):
    df = awkward(spark, [(100 + i, t, "x", "y", 0) for i, t in enumerate(PII_TEXTS)])
    texts = {r.doc_id: r.text for r in df.collect()}
    quick = {k: v for k, v in texts.items() if k is None or k != 106}  # the plain e-mail pattern is quadratic in the long run of letters
    for r in privacy.protected(clashing(df)).collect():
        if r.id in quick:
            assert {k: [(s.start, s.end) for s in r[k]] for k in privacy.KINDS} == brute_pii(texts[r.id])
        else:
            assert r.email == []
    assert privacy.protected(empty(spark)).collect() == []


def test_disclosing_terms(spark):
    secret = [(i, f"filler{i} words here zorbanix writes from jo@corp.example about topic{i} and the weather number{i}", "en", "s", 0) for i in range(5)]
    noise = [(100 + i, f"the weather and words about filler{i} here from topic{i} writes number{i}", "en", "s", 0) for i in range(60)]
    spanned = {r.id: r for r in privacy.protected(spark.createDataFrame(secret + noise, SCHEMA)).collect()}
    assert all([s.value for s in spanned[i].term] == ["zorbanix"] for i in range(5)) and not any(spanned[100 + i].term for i in range(60))
    clean = {r.id: r.text for r in privacy.sanitised(spark.createDataFrame(secret + noise, SCHEMA)).collect()}
    assert clean[0] == "filler0 words here  writes from [email] about topic0 and the weather number0" and clean[100] is None


def test_disclosing_terms_with_copies(spark):
    secret = [(i, f"filler{i} words here zorbanix writes from jo@corp.example about topic{i} and the weather number{i}", "en", "s", 0) for i in range(3)] * 20
    noise = [(100 + i, f"the weather and words about filler{i} here from topic{i} writes number{i}", "en", "s", 0) for i in range(300)]
    spanned = privacy.protected(spark.createDataFrame(secret + noise, SCHEMA)).collect()
    assert all([s.value for s in r.term] == (["zorbanix"] if r.id < 3 else []) for r in spanned) and len(spanned) == 360


def test_disclosing_terms_far_from_the_value(spark):
    fill = lambda i: " ".join(f"common{j}" for j in range(i, i + 30))
    secret = [(i, f"Zorbanix and Xu with ticket AB12345. {fill(i)} mail{i} to jo@corp.example", "en", "s", 0) for i in range(5)]
    noise = [(100 + i, f"and with ticket to mail{i}. {fill(i % 7)}", "en", "s", 0) for i in range(60)]
    spanned = {r.id: [s.value for s in r.term] for r in privacy.protected(spark.createDataFrame(secret + noise, SCHEMA)).collect()}
    assert all(spanned[i] == (["Zorbanix", "Xu", "AB12345"] if i < 5 else []) for i in spanned)


def test_personal_data_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op9_personal_data"](spark, SF).collect():
        spans = [f"{k}:{a}:{b}" for k, ab in brute_pii(docs[r.doc_id]).items() for a, b in ab]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest() and r.spans.split(",")[:len(spans)] == (spans or [""])[:len(spans)]


def test_fingerprints(spark):
    df = awkward(spark)
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = []
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        want.append((key, len(text), hashlib.sha256((text[:len(text) - n] + following[:n]).encode()).hexdigest()))
    got = fingerprint.compared(clashing(df)).collect()
    assert sorted([(r.id, r.n_chars, r.edited_sha256) for r in got], key=repr) == sorted(want, key=repr)
    by_text = {}
    whole = {r.id: r.fingerprint for r in fingerprint.fingerprints(df).collect()}
    for r in got:
        assert whole[r.id] == r.fingerprint and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault({k: t for k, t in rows}[r.id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprint.compared(empty(spark)).collect() == []
    one = fingerprint.compared(df.filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_fingerprint_is_homomorphic():
    sums = fingerprint.Sums.of
    a, b, c = sums(["first line\nsecond line of words"]), sums(["second line of words\nfirst line"]), sums(["first line"])
    assert a.hex() == b.hex() and (a - c).hex() == sums(["second line of words"]).hex() and (a - c + c).hex() == a.hex()
    text = "\n".join(f"line {i} has some words {i * i} in it" for i in range(50))
    new, out, put = fingerprint.edited(text, "other text\nof two lines with more words " * 20)
    assert (sums([text]) - sums([out]) + sums([put])).hex() == sums([new]).hex()
    assert 0.5 < sums([text]).likeness(sums([new]))[0] < 0.95 and sums([text]).likeness(sums([" ".join(f"other{i}" for i in range(200))]))[0] < 0.3
    assert sums([""]).likeness(sums([""]))[0] == 1.0 and sums([""]).likeness(sums(["x"]))[0] == 0.0


def test_fingerprint_query(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    want = [(k, hashlib.sha256((t[:len(t) - len(t) // 4] + f[:len(t) // 4]).encode()).hexdigest()) for (k, t), (_, f) in zip(rows, rows[1:] + rows[:1])]
    got = QUERIES["op3_fingerprint"](spark, SF).orderBy("doc_id").collect()
    assert [(r.doc_id, r.edited_sha256) for r in got] == want
    assert np.mean([r.near_edited for r in got]) > 0.6 > 0.2 > np.mean([r.near_next for r in got])


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_quality_classifier"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) > 0.93
    assert np.mean([p for p, q in held if q == 1]) > 0.97  # clean documents stay


def test_quality_awkward(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (7, 0), (8, 0), (8, 1), (None, 1), (3, None), (10, 1)], "doc_id bigint, quality int")
    model = quality.fit(df, labels)
    out = quality.scored(clashing(df), model)
    assert set(out.columns) == set(clashing(df).columns) and len(out.collect()) == df.count()
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert quality.fit(df, labels.filter("quality = 1")) is None
    assert {r.score for r in quality.scored(df, None).collect()} == {0.5}
    assert quality.scored(empty(spark), model).collect() == [] and quality.fit(empty(spark), labels) is None


@pytest.mark.parametrize("text,count", [("", 0), ("a b", 1), ("x" * 10, 0)])
def test_term_pattern(spark, text, count):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.size(privacy.spans(F.col("t"), "a b"))).first()[0] == count


def test_fingerprint_of_one_word_repeated(spark):
    text = "again " * 65_536
    df = spark.createDataFrame([(1, text, None, None, 1), (2, "something else entirely here " * 30_000, None, None, 1)], SCHEMA)
    first = fingerprint.compared(df).filter("id = 1").first()
    assert 0.5 < first.near_edited < 1


def test_quality_sample_passes_long_texts_over(spark):
    rows = [(i, "good words stand here in order " * 20, "en", "a", 1) for i in range(8)] + [(i, "zzz qqq ### " * 20, "en", "a", 1) for i in range(8, 16)]
    rows += [(99, "x" * (quality.LONGEST_SAMPLED + 1), "en", "a", 1)]
    labels = spark.createDataFrame([(i, int(i < 8)) for i in range(16)] + [(99, 1), (500, 1)], "doc_id bigint, quality int")
    sample = quality.labelled(spark.createDataFrame(rows, SCHEMA), labels)
    assert len(sample[1]) == 8 and len(sample[0]) == 8
