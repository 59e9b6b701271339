"""String functions.  Everything but the stemmer and the sentence rule for whole columns is a JVM-side Column expression."""

from __future__ import annotations

import html as _html
import json
import re
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sigloom.functions import fixed_values as fv


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``; a plain reference may be inlined into every lambda call."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# --- deny lists ------------------------------------------------------------------------------
def shortest_substrings(words: Iterable[str]) -> list[str]:
    """Lower-cased words without those that contain another one.

    For a test "does the text contain any of the words" the result is the same, with fewer words.
    """
    low = sorted({w.lower() for w in words}, key=lambda w: (len(w), w))
    kept: list[str] = []
    for w in low:
        if not any(k in w for k in kept):
            kept.append(w)
    return kept


def alternation(words: Iterable[str]) -> str:
    """A regex matching any of the words, grouped by first character so a scan fails fast."""
    by_first: dict[str, list[str]] = {}
    if not words:
        return "(?!)"  # no words: matches nothing
    for w in sorted({w.lower() for w in words}, key=lambda w: (-len(w), w)):
        by_first.setdefault(w[:1], []).append(w)
    parts = []
    for first in sorted(by_first):
        tails = "|".join(re.escape(w[1:]) for w in by_first[first])
        parts.append(f"{re.escape(first)}(?:{tails})" if first else "")
    return "(?:" + "|".join(parts) + ")"


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Case-insensitive substring test against a deny list ('us' hits 'plus')."""
    return F.lower(text).rlike(alternation(shortest_substrings(words)))


def has_whole_word(text: Column, words: Iterable[str]) -> Column:
    """Case-insensitive whole-word test against a deny list."""
    return F.lower(text).rlike(r"\b" + alternation(words) + r"\b")


# --- cleaning --------------------------------------------------------------------------------
def squeeze(text: Column) -> Column:
    """Collapse runs of whitespace and trim."""
    return F.trim(F.regexp_replace(text, fv.SPACES, " "))


def clean(text: Column) -> Column:
    """Keep ASCII letters, digits, '.' and '/' in tokens joined by single blanks; lower-case.

    The same as blanking every other character, lower-casing and collapsing blanks, in one regex pass: a split
    is several times faster than a replace with many matches.
    """
    return F.lower(F.trim(F.array_join(F.split(text, fv.CLEAN_SEPARATORS), " ")))


def words(text: Column) -> Column:
    """Whitespace tokens; an empty text has none."""
    return F.filter(F.split(F.trim(text), fv.SPACES), lambda w: w != "")


def drop_punctuation(text: Column) -> Column:
    return F.translate(text, fv.ASCII_PUNCTUATION, "")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]*>", "")


def title_case(text: Column) -> Column:
    """Upper-case every letter that does not follow a letter ("women's 3d" -> "Women'S 3D", "ß" -> "Ss")."""

    def capital(run: Column) -> Column:
        first = F.upper(F.substring(run, 1, 1))  # one letter may give two
        return F.concat(F.substring(first, 1, 1), F.lower(F.substr(first, F.lit(2))), F.substr(run, F.lit(2)))

    return F.array_join(F.transform(F.split(F.lower(text), r"(?<=[^\p{L}])"), capital), "")


def numeric_id(value: Column) -> Column:
    """Text id to bigint: a trailing '.0' is dropped, anything that is not a number becomes 0."""
    return F.coalesce(F.regexp_replace(value.cast("string"), r"\.0$", "").try_cast("bigint"), F.lit(0).cast("bigint"))


# --- HTML -------------------------------------------------------------------------------------
def unescape_entities(text: Column) -> Column:
    """Replace HTML character references in one left-to-right pass."""
    # The table is derived from the standard library; a JSON literal is folded to a constant map.
    named = {k[:-1]: v for k, v in _html.entities.html5.items() if k.endswith(";")}
    table = F.from_json(F.lit(json.dumps(named)), "map<string,string>")
    # The names that the standard also accepts without a semicolon; the longest comes first.
    old = "|".join(sorted((k for k in _html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k)))

    def code_point(ref: Column) -> Column:
        # Leading zeros do not count; more than 7 digits are beyond the last code point in either base.
        digits = F.regexp_replace(F.substr(ref, F.when(ref.rlike("^#[xX]"), F.lit(3)).otherwise(F.lit(2))), "^0+(?=.)", "")
        number = F.when(F.length(digits) > 7, F.lit(-1)).when(ref.rlike("^#[xX]"), F.conv(digits, 16, 10).try_cast("bigint")).otherwise(digits.try_cast("bigint"))
        usable = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(usable, number).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")

    def piece(p: Column, i: Column) -> Column:
        def replaced(pattern: str, closing: int) -> Column:
            ref = F.regexp_extract(p, pattern, 1)
            value = F.when(ref == "", None).when(ref.startswith("#"), code_point(ref)).otherwise(F.try_element_at(table, ref))
            return F.concat(value, F.substr(p, F.length(ref) + 1 + closing))

        numeric = "#[0-9]+|#[xX][0-9a-fA-F]+"
        return F.when(i == 0, p).otherwise(F.coalesce(
            replaced(rf"^({numeric}|[A-Za-z][A-Za-z0-9]*);", 1), replaced(rf"^({numeric}|{old})", 0), F.concat(F.lit("&"), p)))

    return F.when(F.contains(text, F.lit("&")),
                  F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def html_text(html: Column) -> Column:
    """Readable text of an HTML fragment: no script, style or comment, one blank between runs."""
    no_comments = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    no_blocks = F.regexp_replace(no_comments, r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>", " ")
    no_tags = F.regexp_replace(no_blocks, r"<[/!?a-zA-Z][^>]*>", " ")
    return F.coalesce(squeeze(F.regexp_replace(unescape_entities(no_tags), "\u00a0", " ")), F.lit(""))


def _base64_text(encoded: Column) -> Column:
    """Decoded text; NULL where the input is no Base64 or its bytes are no UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(encoded, F.lit("base64")).cast("string"))


def base64_html_text(encoded: Column) -> Column:
    """Base64 HTML to plain text; '' for NULL, empty or undecodable input."""
    return html_text(_base64_text(encoded))


def decode_if_html(encoded: Column) -> Column:
    """Base64 to text, with tag removal only where the decoded text holds both '<' and '>'."""
    raw = _base64_text(encoded)
    return F.coalesce(F.when(raw.contains("<") & raw.contains(">"), html_text(raw)).otherwise(squeeze(raw)), F.lit(""))


# --- sentences --------------------------------------------------------------------------------
def sentences(text: Column) -> Column:
    """Split after '.', '!' or '?' followed by whitespace."""
    # The blank comes first: a search that begins with a look-behind tries it at every character.
    blank = fv.SPACES.removesuffix("+")
    return F.filter(F.split(F.trim(text), f"{blank}(?<=[.!?]{blank}){blank}*"), lambda s: s != "")


def drop_denied_sentences_inline(text: Column, denied: Iterable[str] = tuple(fv.DENIED_SOURCE_WORDS)) -> Column:
    """``drop_denied_sentences`` as a plain expression, for short texts inside a lambda, where no Python function can stand."""
    pattern = alternation(shortest_substrings(denied))
    kept = F.filter(sentences(F.lower(text)), lambda s: ~s.rlike(pattern))
    return F.coalesce(F.array_join(kept, " "), F.lit(""))


def drop_denied_sentences(text: Column, denied: Iterable[str] = tuple(fv.DENIED_SOURCE_WORDS)) -> Column:
    """Lower-case the text and remove every sentence that contains a deny word as a substring.

    Arrow's regular expressions test all words in one pass over a sentence; Java's try word after word at every character.
    """
    shortest = shortest_substrings(denied)
    found = F.coalesce(sentences(F.lower(text)), F.array().cast("array<string>"))
    if not shortest:
        return F.array_join(found, " ")
    pattern = alternation(shortest)

    @F.arrow_udf(StringType())
    def without_denied(lists: pa.Array) -> pa.Array:
        each, ends = lists.flatten(), np.asarray(lists.offsets)
        stays = pc.invert(pc.match_substring_regex(each, pattern))
        before = np.concatenate([[0], np.cumsum(stays.to_numpy(zero_copy_only=False))])  # sentences kept before each
        kept = pa.ListArray.from_arrays(pa.array(before[ends - ends[0]], pa.int32()), each.filter(stays))
        return pc.binary_join(kept, pa.scalar(" ", each.type))

    return without_denied(found)


# --- normalisation and phrases ----------------------------------------------------------------
def contains_phrase(text: Column, phrase: Column) -> Column:
    """Is the normalised phrase in the normalised text, at word boundaries?"""
    pad = lambda c: F.concat(F.lit(" "), squeeze(drop_punctuation(F.lower(c))), F.lit(" "))
    return F.contains(pad(text), pad(phrase))


_VOWELS = "aeiou"


def _is_consonant(word: str, i: int) -> bool:
    if word[i] in _VOWELS:
        return False
    return word[i] != "y" or i == 0 or not _is_consonant(word, i - 1)


def _shape(stem: str) -> str:
    return "".join("c" if _is_consonant(stem, i) else "v" for i in range(len(stem)))


def _measure(stem: str) -> int:
    return len(re.findall("v+c", _shape(stem)))


def _short_end(word: str) -> bool:
    return (len(word) >= 3 and _shape(word)[-3:] == "cvc" and word[-1] not in "wxy") or \
        (len(word) == 2 and _shape(word) == "vc")


# Porter's published suffix tables (with the two common later additions 'fulli' and 'logi').
_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
          "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
          "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
          "biliti": "ble", "fulli": "ful"}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
          "iti", "ous", "ive", "ize"]
_IRREGULAR = {"sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
              "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
              "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
              "exceed": "exceed", "succeed": "succeed"}


def _replace_longest(word: str, table: dict[str, str], least: int) -> str:
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + table[suffix] if _measure(stem) >= least else word
    return word


def porter_stem(word: str) -> str:
    """Porter's stemmer with the usual extensions for short words and irregular forms."""
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    # plurals
    if word.endswith("ies") and len(word) == 4:
        word = word[:-1]
    elif word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past tense and gerund
    cut = None
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        cut = next((word[: -len(s)] for s in ("ed", "ing") if word.endswith(s) and "v" in _shape(word[: -len(s)])), None)
    if cut is not None:
        if cut.endswith(("at", "bl", "iz")):
            word = cut + "e"
        elif len(cut) >= 2 and cut[-1] == cut[-2] and _is_consonant(cut, len(cut) - 1):
            word = cut if cut[-1] in "lsz" else cut[:-1]
        elif _measure(cut) == 1 and _short_end(cut):
            word = cut + "e"
        else:
            word = cut
    if word.endswith("y") and len(word) > 2 and _is_consonant(word[:-1], len(word) - 2):
        word = word[:-1] + "i"
    # derivational suffixes
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    if word.endswith("logi"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        word = _replace_longest(word, _STEP2, 1)
    word = _replace_longest(word, _STEP3, 1)
    suffix = next((s for s in sorted(_STEP4, key=len, reverse=True) if word.endswith(s)), None)
    if suffix:
        stem = word[: -len(suffix)]
        if _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t")):
            word = stem
    # final e and double l
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@F.pandas_udf(StringType())
def _stem_tokens(text: pd.Series) -> pd.Series:
    stems: dict[str, str] = {}  # words repeat within a batch

    def stem(word: str) -> str:
        if word not in stems:
            stems[word] = porter_stem(word)
        return stems[word]

    return text.map(lambda t: None if t is None else " ".join(stem(w) for w in t.split()))


def normalize(text: Column, stem: bool = True) -> Column:
    """Lower-case, drop ASCII punctuation, tokenise on blanks, stem every token."""
    flat = drop_punctuation(F.lower(text))
    for joined, apart in fv.SPLIT_CONTRACTIONS.items():
        flat = F.regexp_replace(flat, rf"\b{joined}\b", apart)
    return _stem_tokens(squeeze(flat)) if stem else squeeze(flat)


# --- url-encoded key=value blobs --------------------------------------------------------------
def _blob_value(blob: Column, key: str) -> Column:
    pattern = rf"(?:^|&){re.escape(key)}=([^&]*)"
    return F.when(blob.rlike(pattern), F.regexp_extract(blob, pattern, 1))


MOST_DECODES = 16  # rounds of url-decoding; a value still encoded after them is left as it is


def _url_decode(value: Column, times: int) -> Column:
    """Decoded again and again until nothing changes, at most ``times`` rounds; a round that fails leaves the value."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(times)), value, lambda v, _: F.coalesce(F.try_url_decode(v), v))


def blob_ids(blob: Column, key: str = fv.SHOWN_SIGNALS_KEY, depth: int = MOST_DECODES) -> Column:
    """Ids stored under ``key``: url-decoded until unchanged (at most ``depth`` times), split on ',', '|', '[' and ']'."""
    return F.split(_url_decode(_blob_value(blob, key), depth), r"[,|\[\]]")


def blob_value(blob: Column, key: str, depth: int = MOST_DECODES) -> Column:
    """One field, decoded as ``blob_ids`` does."""
    return _url_decode(_blob_value(blob, key), depth)


# --- tokens -----------------------------------------------------------------------------------
def truncate_words(text: Column, keep: int = 800, tokenizer: Callable[[Column], Column] | None = None) -> Column:
    """First ``keep`` tokens; whitespace tokens unless a tokenizer (Column -> array) is given."""
    tokens = tokenizer(text) if tokenizer else words(text)
    return F.array_join(F.slice(tokens, 1, keep), " ")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0))


def first_type_in_title(title: Column, types: list[str], default: str = "unknown") -> Column:
    """First type whose words, singularised and without '&', all occur in the title."""
    branch = None
    low = F.lower(title)
    for t in types:
        stems = [w[:-1] if w.endswith("s") else w for w in t.lower().split() if w != "&"]
        hit = F.lit(True)
        for s in stems:
            hit = hit & low.contains(s)
        branch = F.when(hit, F.lit(t)) if branch is None else branch.when(hit, F.lit(t))
    return F.lit(default) if branch is None else branch.otherwise(F.lit(default))


# --- highlighting -----------------------------------------------------------------------------
STRIDE = 64


def sums_before(values: Column) -> Column:
    """For every element of an integer array the sum of those before it.

    An array cannot grow in place, so adding to one at every element costs the square of its length.  Here only one sum per
    ``STRIDE`` elements is added to an array, and inside a stretch of that length the sums are taken directly.
    """
    stretches = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STRIDE).cast("int")),
                                      lambda i: F.slice(v, i * STRIDE + 1, F.lit(STRIDE)))
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def bases(parts: Column) -> Column:
        step = lambda acc, c: F.struct((acc["at"] + total(c)).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
        return F.aggregate(parts, begin, step, lambda acc: acc["out"])

    inside = lambda c, base: F.transform(c, lambda x, j: base + total(F.slice(c, F.lit(1), j)))
    summed = let(values, lambda v: let(stretches(v), lambda parts: F.flatten(F.zip_with(parts, bases(parts), inside))))
    return F.when(F.size(values) > 0, summed).otherwise(F.array().cast("array<int>"))


def highlight_spans(text: Column, signal: Column) -> Column:
    """Start (0-based) and token of every case-insensitive, non-overlapping hit of each signal token."""
    tokens = F.array_distinct(F.filter(F.split(F.lower(signal), fv.HIGHLIGHT_SPLIT), lambda t: t != ""))

    def hits(low: Column, token: Column) -> Column:
        # Splitting on the literal token gives the gaps between hits; a running sum gives the starts.
        gaps = F.transform(F.split(low, F.concat(F.lit("\\Q"), token, F.lit("\\E")), -1), lambda g: F.length(g))
        step = F.length(token)

        def starts(g: Column) -> Column:
            before = sums_before(F.transform(g, lambda x: x + step))
            return F.zip_with(g, before, lambda x, b: F.struct((x + b).alias("start"), token.alias("token")))

        return let(gaps, lambda g: F.slice(starts(g), F.lit(1), F.size(g) - 1))

    found = let(F.lower(text), lambda low: F.flatten(F.transform(tokens, lambda t: hits(low, t))))
    return F.coalesce(F.array_sort(found),
                      F.array().cast("array<struct<start:int,token:string>>"))


def highlight_html(text: Column, signal: Column, before: str = "<b>", after: str = "</b>") -> Column:
    """Mark whole-token hits in one pass, so inserted markup is never matched again."""
    tokens = F.filter(F.split(signal, fv.HIGHLIGHT_SPLIT), lambda t: t != "")
    quoted = F.transform(F.array_sort(F.array_distinct(tokens), lambda a, b: F.length(b) - F.length(a)),
                         lambda t: F.concat(F.lit("\\Q"), t, F.lit("\\E")))
    pattern = F.concat(F.lit("(?i)("), F.array_join(quoted, "|"), F.lit(")"))
    return F.when(F.size(tokens) > 0, F.regexp_replace(text, pattern, F.lit(f"{before}$1{after}"))).otherwise(text)


# --- repairing model JSON ---------------------------------------------------------------------
def escape_inner_quotes(text: Column, key: str = "explanation") -> Column:
    """Escape bare double quotes inside the last value of a flat JSON object."""
    head = f'"{key}": "'
    pattern = rf'(?s)^(.*?{re.escape(head)})(.*?)("\}}.*)$'
    body = F.regexp_extract(text, pattern, 2)
    fixed = F.regexp_replace(body, r'(?<!\\)"', r'\\"')
    return F.when(text.rlike(pattern),
                  F.concat(F.regexp_extract(text, pattern, 1), fixed, F.regexp_extract(text, pattern, 3))).otherwise(text)
