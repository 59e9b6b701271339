"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Every document has a fractional number of copies, the same share for all documents of a source.  Its whole part is
taken at once.  Two documents with a fractional rest play: words move from one to the other until one of them is taken
whole or not at all.  The direction is drawn so that every document keeps its expected share, and the source keeps its
total of words exactly.  Documents of a source are dealt to groups of about ``FAN`` by hash; each group plays its
documents one after the other and hands on at most one open document, and those play again in groups, level by level:
a reduction tree of logarithmic depth.  The single document left open at the root is taken in part (its first words).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
FAN = 64
UNITS = 1_000_000  # of a word: transfers are whole numbers, so totals stay exact
SPACES = "[ \\t\\n\\x0B\\f\\r]+"


def word_count(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, n, target) from rows (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times all words.  A target stops
    at ``limit`` times its source; what is too much goes to the others by weight.  In order of limit per weight the stopped
    sources come first, so the level of the others follows from running sums.  Windows run on one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (per_source.withColumn("weight", F.element_at(turn, ((place - 1) % len(weights) + 1).cast("int")))
                        .withColumn("cap", F.col("source_size") * F.lit(limit)))
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    stopped = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * F.lit(share)
    level = (total - stopped) / open_weight
    fits = level * F.col("weight") <= F.col("cap") * (1 + 1e-12)
    levelled = ranked.withColumn("level", F.when(fits, level))
    best = F.max("level").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (levelled.withColumn("best", best)
                    .select("source", "source_size", "n", F.least("cap", F.coalesce(F.col("best") * F.col("weight"), F.col("cap"))).alias("target")))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _integral(x: Column) -> Column:
    return (x["mass"] == 0) | (x["mass"] == x["cap"])


def _play(items: Column) -> Column:
    """Plays the documents of a group one after the other: struct(done, open)."""

    def step(state: Column, x: Column) -> Column:
        a = state["open"]
        gain = F.least(a["cap"] - a["mass"], x["mass"])
        loss = F.least(a["mass"], x["cap"] - x["mass"])
        draw = F.shiftrightunsigned(F.xxhash64(a["h"], x["h"]), 11).cast("double") / float(1 << 53)
        moved = F.when(draw * (gain + loss) < loss, gain).otherwise(-loss)

        def after(d: Column) -> Column:
            pair = F.array(a.withField("mass", a["mass"] + d), x.withField("mass", x["mass"] - d))
            return F.struct(F.concat(state["done"], F.filter(pair, _integral)).alias("done"),
                            F.get(F.filter(pair, lambda p: ~_integral(p)), F.lit(0)).alias("open"))

        return F.when(a.isNull(), F.struct(state["done"].alias("done"), x.alias("open"))).otherwise(_bind(moved, after))

    nothing = F.get(F.slice(items, 1, 0), F.lit(0))
    return F.aggregate(items, F.struct(F.slice(items, 1, 0).alias("done"), nothing.alias("open")), step)


def _by_hash(a: Column, b: Column) -> Column:
    return F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1).otherwise(0)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] | None = None,
          weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = 7) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, cut_words, taken, row (the ``carry`` columns).

    ``copies`` whole copies are taken, and ``cut_words`` first words of one more (of one document per source at most);
    ``taken`` is the words of both.  A null text has size 0 and is never taken in part.  A null source is a source of its
    own.  Rows that repeat are separate documents.  Draws come from hashes of id and text, so reruns agree.  An empty
    table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("string")
    sized = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                        word_count(F.col(f"`{text_col}`")).alias("size"),
                        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(seed)).alias("h"))
    base = written(sized, "sizes")
    goals = written(source_targets(base.select("source", "size"), weights, share, limit), "targets")
    most = goals.agg(F.max("n")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(F.col("ratio")).cast("int")
    item = F.struct("h", "id", "size", "source_size", "target", "copies", "cap", "mass", "row")
    shared = (base.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
                  .withColumn("ratio", ratio).withColumn("copies", whole).withColumn("cap", F.col("size") * UNITS)
                  .withColumn("mass", F.floor((F.col("ratio") - F.col("copies")) * F.col("cap")).cast("bigint"))
                  .select("source", "n", item.alias("item")))
    # Whole shares go straight through: they form groups of one that have nothing to play.
    playing = shared.filter(~_integral(F.col("item")))
    parts = [shared.filter(_integral(F.col("item"))).select("item")]
    levels = max(1, math.ceil(math.log(max(most, 2), FAN)))
    for k in range(levels):
        groups = F.ceil(F.col("n") / float(FAN ** (k + 1)))
        dealt = playing.withColumn("g", F.pmod(F.xxhash64("item.h", F.lit(k)), groups))
        played = (dealt.groupBy("source", "n", "g").agg(F.collect_list("item").alias("items"))
                       .select("source", "n", _play(F.array_sort("items", _by_hash)).alias("out")))
        level = written(played.select("source", "n", "out.done", "out.open"), f"level{k}")
        parts.append(level.select(F.explode("done").alias("item")))
        playing = level.filter("open is not null").select("source", "n", F.col("open").alias("item"))
    parts.append(playing.select("item"))
    out = reduce(DataFrame.unionByName, parts).select("item.*")
    full = (F.col("mass") == F.col("cap")) & (F.col("cap") > 0)
    out = (out.withColumn("copies", F.col("copies") + full.cast("int"))
              .withColumn("cut_words", F.when(_integral_columns(), F.lit(0)).otherwise(F.round(F.col("mass") / UNITS)).cast("bigint")))
    return out.select("id", "size", "source_size", "target", "copies", "cut_words",
                      (F.col("copies") * F.col("size") + F.col("cut_words")).alias("taken"), "row")


def _integral_columns() -> Column:
    return (F.col("mass") == 0) | (F.col("mass") == F.col("cap"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a document comes as often as it is copied.

    Rows stay whole: a document taken in part comes once more if at least half of its words are taken.
    """
    key = "mix_row"
    while key.lower() in [c.lower() for c in docs.columns]:
        key += "_"
    numbered = written(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    found = mixed(numbered, id_col, text_col, source_col, carry=[key], **options)
    times = F.col("copies") + ((F.col("cut_words") * 2 >= F.col("size")) & (F.col("cut_words") > 0)).cast("int")
    # Only numbers go through the tree; the rows themselves come back by them.
    copies = written(found.filter(times > 0).select(F.col(f"row.{key}").alias(key), times.alias("mix_times")), "copies")
    whole = numbered.alias("d").join(copies.alias("c"), F.col(f"d.{key}") == F.col(f"c.{key}"))
    own = [F.col(f"d.`{c}`").alias(c) for c in docs.columns]
    return whole.select(*own, F.explode(F.array_repeat(F.lit(1), F.col("c.mix_times"))).alias(f"{key}_copy")).drop(f"{key}_copy")
