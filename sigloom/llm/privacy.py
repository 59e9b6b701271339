"""Personal data: patterns first, then terms that give a protected value away.

Patterns find e-mail addresses, IP addresses, card and phone numbers.  For every found value the words of the
texts that hold it are counted over the whole corpus.  By pointwise mutual information a word tells as many bits about a value as knowing the
word makes the value likelier; measured against the information content of the value itself (the bits needed to name
it), that is the share of the secret that the word discloses.  Words that disclose at least ``DISCLOSED`` of a value in
at least ``SUPPORT`` different contexts of the value are marked in the documents that hold the value.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import written
from sigloom.llm.spans import SPAN, listed, spans

KINDS = ("email", "ip", "card", "phone")
CONTEXT_CHARS = 60  # on either side of a value: tells its contexts apart; terms come from the whole text
SUPPORT = 3
DISCLOSED = 0.8
MIN_TERM = 2

_DIGIT = listed("0-9")
_WORD = listed("A-Z", "a-z", "0-9")
_LOCAL, _HOST = f"[{_WORD}{listed('._%+-')}]", f"[{_WORD}{listed('-')}]"

# The patterns, with listed characters and possessive repeats: the same matches, and no backtracking over long runs.
# A match may begin where the last one ended or where no character of its first class stands before it.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"
IP = rf"(?<![{_DIGIT}])[{_DIGIT}]++\.[{_DIGIT}]++\.[{_DIGIT}]++\.[{_DIGIT}]++"
CARD = rf"[{_DIGIT}](?:[{listed(' -')}]?[{_DIGIT}]){{15,}}+"
PHONE = rf"\+[{_DIGIT}][{listed(' ().-', '0-9')}]+[{_DIGIT}]"
TERM = rf"[\p{{L}}\p{{N}}]{{{MIN_TERM},}}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, f"[^{_DIGIT}]+", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid_ip(value: Column) -> Column:
    return F.forall(F.split(value, "\\."), lambda p: p.cast("double") <= 255)


def _if_any(text: Column, quick: Column, found: Column) -> Column:
    return F.when(quick, found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans per kind: leftmost matches that do not overlap; matches that fail their test are dropped without retries."""
    card_digits = lambda s: F.length(_digits(s["value"]))
    return {
        "email": _if_any(text, F.contains(text, F.lit("@")), spans(text, EMAIL)),
        "ip": _if_any(text, F.rlike(text, F.lit(IP)), F.filter(spans(text, IP), lambda s: _valid_ip(s["value"]))),
        "card": _if_any(text, F.rlike(text, F.lit(CARD)),
                        F.filter(spans(text, CARD), lambda s: F.when(card_digits(s).between(16, 19), _luhn(s["value"])).otherwise(F.lit(False)))),
        "phone": _if_any(text, F.contains(text, F.lit("+")), F.filter(spans(text, PHONE), lambda s: card_digits(s).between(8, 15))),
    }


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of all documents: uid, id, one array of spans per kind, and the text and its digest where there is any span."""
    body = F.coalesce(F.col("body"), F.lit(""))
    kinds = base_spans(body)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("body"))
    boxed = rows.select("id", "body", F.array(F.struct(*[c.alias(k) for k, c in kinds.items()])).alias("box"))
    marked = boxed.select("id", "body", F.inline("box"))  # behind a generator, so that the patterns run once
    some = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    digest = F.unhex(F.substring(F.sha2("body", 256), 1, 32))
    return written(marked.select(F.monotonically_increasing_id().alias("uid"), "id", *KINDS, F.when(some, F.col("body")).alias("body"), F.when(some, digest).alias("digest")), "spans")


def _entities(marked: DataFrame) -> DataFrame:
    """One row per found value: uid, digest, entity (kind and value), context (the text on either side)."""
    def named(kind: str) -> Column:
        value = F.lower if kind in ("email", "ip") else _digits
        return F.transform(kind, lambda s: F.struct(F.concat(F.lit(f"{kind}:"), value(s["value"])).alias("entity"), s["start"].alias("start"), s["end"].alias("end")))

    values = F.concat(*map(named, KINDS))
    rows = marked.filter("body is not null").select("uid", "digest", "body", F.explode(values).alias("e"))
    first = F.greatest(F.col("e.start") - CONTEXT_CHARS, F.lit(0))
    left = F.substring("body", first + 1, F.col("e.start") - first)
    right = F.substring("body", F.col("e.end") + 1, F.lit(CONTEXT_CHARS))
    # The outermost word on a side may be cut, so it does not count.
    left = F.when(first > 0, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
    right = F.when(F.length(right) == CONTEXT_CHARS, F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right)
    return rows.select("uid", "digest", F.col("e.entity").alias("entity"), F.lower(F.concat(left, F.lit(" | "), right)).alias("context"))


def _share(of_term: Column) -> Column:
    """Bits that a term tells about an entity, as a share of the bits that name it; null if the entity is everywhere."""
    secret = F.log2(F.col("total") / F.col("of_entity"))
    told = F.log2(F.col("both") * F.col("total") / (F.col("of_entity") * F.greatest(of_term, "both")))
    return F.when(secret > 0, told / secret)


def _told_apart(entities: DataFrame, support: int) -> DataFrame:
    """(entity, of_entity) with the number of distinct texts, of values in at least ``support`` different contexts: no other one can have a term."""
    distinct = entities.select("entity", "digest", "context").distinct()
    contexts = distinct.select("entity", "context").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("contexts")).filter(F.col("contexts") >= support)
    texts = distinct.select("entity", "digest").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("of_entity"))
    return contexts.join(texts, "entity").select("entity", "of_entity")


def disclosing(docs: DataFrame, marked: DataFrame, entities: DataFrame, text_col: str = "text", support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """(entity, term, share) of all terms that disclose at least ``disclosed`` of an entity.

    Terms are taken from the whole texts that hold a value, outside the values themselves.  Copies of a context count
    once.  Everything a share is made of is counted in distinct texts: copies of a text count once, for the value as for
    the term and the corpus.
    """
    listed_terms = lambda text: F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))
    terms_of = lambda text: F.explode(listed_terms(text)).alias("term")
    per_entity = written(_told_apart(entities, support), "entities")
    held = written(entities.join(per_entity, "entity").select("digest", "entity", "context", "of_entity").distinct().withColumn("near", listed_terms("context")), "held")
    values = F.array_distinct(F.flatten(F.array(*[F.transform(k, lambda s: s["value"]) for k in KINDS])))
    apart = F.regexp_replace("body", F.concat(F.lit("\\Q"), F.array_join(values, "\\E|\\Q"), F.lit("\\E")), F.lit(" | "))
    texts = marked.filter("body is not null").join(held.select("digest").distinct(), "digest", "left_semi")
    words = written(texts.select("digest", terms_of(apart)).distinct(), "words")
    # Frequencies first, one row per distinct text: a text's terms are distinct, so they are counted where they are read.
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digest = F.unhex(F.substring(F.sha2(body, 256), 1, 32))
    distinct = docs.select(digest.alias("digest"), body.alias("body")).dropDuplicates(["digest"])
    per_term = distinct.select(terms_of(F.col("body"))).groupBy("term").agg(F.count(F.lit(1)).alias("of_term"))
    total = docs.select(digest.alias("digest")).distinct().agg(F.count(F.lit(1)).alias("total"))  # one row
    # A term tells most if it stands in every text of an entity: what is too common even for the most frequent entity is
    # ruled out before terms meet entities.
    most = per_entity.agg(F.max("of_entity").alias("of_entity"))
    bound = per_term.withColumns({"total": total.scalar(), "of_entity": most.scalar()}).withColumn("both", F.least("of_entity", "of_term"))
    rare = written(bound.filter(F.coalesce(_share(F.col("of_term")), F.lit(1.0)) >= disclosed).select("term", "of_term", "total"), "rare")
    texts = marked.filter("body is not null").join(held.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])
    words = texts.select("digest", terms_of(apart)).join(rare, "term")
    places = words.join(held, "digest").withColumn("beside", F.when(F.array_contains("near", F.col("term")), F.col("context"))).drop("near")
    # Support: contexts that hold the term, or else contexts in as many texts that hold it anywhere.
    whole = places.groupBy("entity", "term").agg(F.count_distinct("context").alias("contexts"), F.count_distinct("beside").alias("beside"), F.count_distinct("digest").alias("both"),
                                              F.min("of_term").alias("of_term"), F.min("total").alias("total"), F.min("of_entity").alias("of_entity"))
    enough = (F.col("beside") >= support) | (F.least("contexts", "both") >= support)
    return whole.filter(enough).select("entity", "term", _share(F.col("of_term")).alias("share")).filter(F.col("share") >= disclosed)


def term_spans(marked: DataFrame, entities: DataFrame, terms: DataFrame) -> DataFrame:
    """(uid, term) spans of disclosing terms in the documents that hold the entity, outside the spans of patterns."""
    per_doc = (entities.select("uid", "entity").distinct().join(terms, "entity")
                       .groupBy("uid").agg(F.array_sort(F.collect_set("term")).alias("terms")))
    rows = per_doc.join(marked.filter("body is not null"), "uid")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("terms", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    apart = lambda s: ~F.exists(F.concat(*KINDS), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return rows.select("uid", F.filter(spans(F.col("body"), pattern), apart).alias("term"))


def protected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """All spans of every document: id, email, ip, card, phone, term (arrays of start, end, value), body (null without spans).

    A null text counts as empty.  Offsets are code points.  Repeated rows are separate documents; their contexts count
    once.  An empty table gives no rows.
    """
    marked = found(docs, id_col, text_col)
    entities = _entities(marked)
    terms = written(disclosing(docs, marked, entities, text_col, support, disclosed), "disclosing")
    extra = term_spans(marked, entities, terms)
    return marked.join(extra, "uid", "left").withColumn("term", F.coalesce("term", F.array().cast(SPAN))).drop("uid", "digest")


def as_text(*kinds: str) -> Column:
    """kind:start:end of all spans, kind by kind, comma-joined."""
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*map(named, kinds)), ",")


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, text): spans of patterns are generalised to their kind, disclosing terms removed; null where nothing was found."""
    spanned = protected(docs, id_col, text_col, **options)
    def replaced(kind: str) -> Column:
        by = F.lit("" if kind == "term" else f"[{kind}]")
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), by.alias("by")))

    every = F.concat(*map(replaced, (*KINDS, "term")))

    def step(state: Column, s: Column) -> Column:
        keep = F.substring(F.col("body"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        # A span that begins inside the one before (of another kind) only extends it.
        by = F.when(s["start"] >= state["at"], s["by"]).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], keep, by).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.aggregate(F.sort_array(every), begin, step, lambda s: F.concat(s["out"], F.substring(F.col("body"), s["at"] + 1, F.length("body"))))
    return spanned.select("id", F.when(F.col("body").isNotNull(), text).alias("text"))
