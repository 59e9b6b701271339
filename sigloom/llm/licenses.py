"""License scan with ordered signature rules.

A text is lower-cased and reduced to words with one blank between them.  Each rule has a priority, a label, a keyword and
a regular expression over that form; a rule runs only where its keyword occurs.  Detections are swept from left to
right: one that lies inside a detection of the same or a higher priority is suppressed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.spans import listed, spans

# Phrases that count in any case, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Names of licenses as they read after reduction to words: label, keyword that a text must contain, expression.
NAMES = [
    ("mit", "licen", r"(?:mit|expat|x11) licen[sc]e"),
    ("mit-0", "licen", r"mit no attribution licen[sc]e"),
    ("apache", "licen", r"apache (?:software )?licen[sc]e(?: version)?(?: [12] [01])?"),
    ("apache", "licen", r"apache 2(?: 0)? licen[sc]e"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e(?: version [123]| v[123])?"),
    ("gpl", " gpl", r"(?:gnu )?gpl(?: ?v?[123](?: 0)?)?"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e(?: version [23]| v[23])?"),
    ("lgpl", " lgpl", r"(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?"),
    ("agpl", "general public", r"(?:gnu )?affero general public licen[sc]e(?: version 3| v3)?"),
    ("agpl", " agpl", r"(?:gnu )?agpl(?: ?v?3(?: 0)?)?"),
    ("gfdl", "documentation", r"gnu free documentation licen[sc]e"),
    ("bsd-2-clause", " bsd ", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[sc]e)?"),
    ("bsd-2-clause", "freebsd", r"freebsd(?: licen[sc]e)?"),
    ("bsd-3-clause", " bsd ", r"(?:modified bsd|new bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", " bsd ", r"(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?"),
    ("bsd", " bsd ", r"bsd(?: style)? licen[sc]e"),
    ("isc", " isc ", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("boost", "boost", r"boost software licen[sc]e(?: version 1 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e(?: version)?(?: [12] [01])?"),
    ("epl", "eclipse", r"eclipse public licen[sc]e(?: version)?(?: v?[12](?: 0)?)?"),
    ("cpl", "common public", r"common public licen[sc]e"),
    ("cddl", "common development", r"common development and distribution licen[sc]e"),
    ("eupl", "european union", r"european union public licen[sc]e"),
    ("artistic", "artistic", r"artistic licen[sc]e(?: [12](?: 0)?)?"),
    ("python", "python", r"python software foundation licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("php", " php ", r"php licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("vim", " vim ", r"vim licen[sc]e"),
    ("curl", " curl ", r"curl licen[sc]e"),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e(?: version 1 1)?"),
    ("odbl", "open database", r"open database licen[sc]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "fuck", r"do what the fuck you want to public licen[sc]e"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("cc0", " cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-sa", " cc ", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", " cc ", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc", " cc ", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", " cc ", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", " cc ", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", " cc ", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s?"),
    ("cc-by", "creative commons", r"creative commons attribution"),
    ("bsl", "business source", r"business source licen[sc]e(?: 1 1)?"),
    ("sspl", "server side", r"server side public licen[sc]e"),
    ("elastic", "elastic", r"elastic licen[sc]e(?: 2 0)?"),
]

# Ways to put a name into a sentence, with the priority of the detection and its weight in the score.
FRAMES = [
    (90, 0.95, r"licen[sc]ed under (?:the |an? )?{0}"),
    (90, 0.95, r"released under (?:the |an? )?{0}"),
    (90, 0.95, r"(?:re)?distribut(?:ed|able) under (?:the )?(?:terms of )?(?:the |an? )?{0}"),
    (90, 0.9, r"(?:available|provided|published|covered|governed) (?:under|by) (?:the )?(?:terms of )?(?:the |an? )?{0}"),
    (80, 0.85, r"subject to (?:the )?(?:terms|conditions) of (?:the )?{0}"),
    (100, 1.0, r"spdx licen[sc]e identifier {0}"),
    (50, 0.5, r"{0}"),
]

# Sentences without a name.
SENTENCES = [
    (85, 0.9, "mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    (85, 0.9, "isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    (85, 0.9, "bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification"),
    (85, 0.9, "gpl", "free software", r"this program is free software you can redistribute it and or modify it"),
    (85, 0.9, "zlib", "altered source", r"altered source versions must be plainly marked as such"),
    (85, 0.9, "boost", "machine executable", r"machine executable object code generated by a source language processor"),
    (85, 0.9, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    (70, 0.7, "public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|in ?to) the public domain"),
    (60, 0.6, "proprietary", "rights reserved", r"all rights reserved"),
    (70, 0.7, "proprietary", "proprietary", r"proprietary and confidential"),
    (100, 1.0, "mit", "identifier mit", r"spdx licen[sc]e identifier mit"),
    (100, 1.0, "apache", "identifier apache", r"spdx licen[sc]e identifier apache 2 0"),
    (100, 1.0, "bsd-3-clause", "identifier bsd 3", r"spdx licen[sc]e identifier bsd 3 clause"),
    (100, 1.0, "bsd-2-clause", "identifier bsd 2", r"spdx licen[sc]e identifier bsd 2 clause"),
    (100, 1.0, "mpl", "identifier mpl", r"spdx licen[sc]e identifier mpl [12] [01]"),
    (100, 1.0, "isc", "identifier isc", r"spdx licen[sc]e identifier isc"),
]

PRIORITIES = sorted({f[0] for f in FRAMES} | {s[0] for s in SENTENCES}, reverse=True)


def rules() -> list[tuple[int, float, str, str, str]]:
    """(priority, weight, label, keyword, expression): every name in every frame, then the sentences."""
    made = [(p, w, label, keyword, frame.format(name)) for label, keyword, name in NAMES for p, w, frame in FRAMES]
    return made + SENTENCES


def _rule_table() -> Column:
    return F.array(*[F.struct(F.lit(p).alias("priority"), F.lit(w).alias("weight"), F.lit(label).alias("label"),
                              F.lit(keyword).alias("keyword"), F.lit(f"(?<= ){regex}(?= )").alias("regex"))
                     for p, w, label, keyword, regex in rules()])


def _any_keyword(norm: Column) -> Column:
    out = F.lit(False)
    for keyword in sorted({r[3] for r in rules()}):
        out = out | F.contains(norm, F.lit(keyword))
    return out


def detections(norm: Column) -> Column:
    """Detections of all rules whose keyword occurs, sorted by start, then longest, then highest priority, then label."""
    hits = F.filter(_rule_table(), lambda r: F.contains(norm, r["keyword"]))

    def of_rule(r: Column) -> Column:
        return F.transform(spans(norm, r["regex"]), lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("minus_end"), (-r["priority"]).alias("minus_priority"),
            r["label"].alias("label"), r["weight"].alias("weight")))

    return F.sort_array(F.flatten(F.transform(hits, of_rule)))


def surviving(found: Column) -> Column:
    """Labels and the best weight after suppression, as a struct.

    In this order everything that contains a detection comes before it, so one sweep with the furthest end seen so far
    per priority decides whether an earlier detection of the same or a higher priority contains it.
    """
    def step(state: Column, x: Column) -> Column:
        end, priority = -x["minus_end"], -x["minus_priority"]
        inside = F.lit(False)
        for p in PRIORITIES:
            inside = inside | ((priority <= p) & (state[f"e{p}"] >= end))
        reach = [F.when(priority == p, F.greatest(state[f"e{p}"], end)).otherwise(state[f"e{p}"]).alias(f"e{p}") for p in PRIORITIES]
        labels = F.when(inside, state["labels"]).otherwise(F.array_union(state["labels"], F.array(x["label"])))
        weight = F.when(inside, state["weight"]).otherwise(F.greatest(state["weight"], x["weight"]))
        return F.struct(*reach, labels.alias("labels"), weight.alias("weight"))

    begin = F.struct(*[F.lit(-1).alias(f"e{p}") for p in PRIORITIES], F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("weight"))
    return F.aggregate(found, begin, step)


def _words_before(norm: Column, at: Column) -> Column:
    """Words before the blank at 1-based position ``at``: blanks up to there, less the leading one."""
    head = F.substring(norm, F.lit(1), at)
    return (F.octet_length(head) - F.octet_length(F.replace(head, F.lit(" "), F.lit(""))) - 1).cast("bigint")


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    A null text counts as empty: no words, null positions, empty labels, score 0.  Upper case follows Unicode, which for
    the phrases and word boundaries equals lower-casing A to Z.  Repeated rows give repeated results; an empty table none.
    """
    separators = "[" + listed("\x00-\x2f", "\x3a-\x60", "\x7b-\x7f") + "]+"
    body = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), separators, " "))
    norm = F.col("norm")
    blanks = F.octet_length(norm) - F.octet_length(F.replace(norm, F.lit(" "), F.lit("")))
    reduced = docs.select(F.col(f"`{id_col}`").alias("id"), F.concat(F.lit(" "), body, F.lit(" ")).alias("norm"))

    has = F.contains(norm, F.lit(" license "))
    count, first, last, base = F.lit(0).cast("bigint"), [], [], []
    for phrase, label in BASE_PHRASES.items():
        there = F.when(has, F.contains(norm, F.lit(f" {phrase} "))).otherwise(F.lit(False))
        count = count + F.when(there, F.regexp_count(norm, F.lit(f" {phrase}(?= )"))).otherwise(F.lit(0))
        first.append(F.when(there, _words_before(norm, F.instr(norm, f" {phrase} "))))
        behind = F.length(norm) - F.instr(F.reverse(norm), f" {phrase} "[::-1]) + 1  # of the blank after the last place
        last.append(F.when(there, _words_before(norm, behind) - len(phrase.split())))
        base.append(F.when(there, F.lit(label)))
    base_labels = F.array_sort(F.array_compact(F.array(*base)))
    none = F.array().cast("array<struct<start:int,minus_end:int,minus_priority:int,label:string,weight:double>>")
    found = reduced.select(
        "id", F.when(norm == "  ", F.lit(0)).otherwise(blanks - 1).cast("bigint").alias("n_words"), count.alias("n_base"),
        F.array_min(F.array(*first)).alias("first_word"), F.array_max(F.array(*last)).alias("last_word"), base_labels.alias("base"),
        F.when(_any_keyword(norm), detections(norm)).otherwise(none).alias("found"))
    judged = found.withColumn("best", F.when(F.size("found") > 0, surviving(F.col("found"))))
    labels = F.array_sort(F.array_distinct(F.concat(F.col("base"), F.coalesce(F.col("best.labels"), F.array().cast("array<string>")))))
    score = F.greatest(F.coalesce(F.col("best.weight"), F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    spans_out = F.transform("found", lambda d: F.struct(d["start"].alias("start"), (-d["minus_end"]).alias("end"), (-d["minus_priority"]).alias("priority"), d["label"].alias("label")))
    return judged.select("id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                         F.array_join(labels, ",").alias("labels"), score.alias("score"), spans_out.alias("detections"))
