"""Positions of regular expression matches as columns: no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


def listed(*parts: str) -> str:
    """A character class that lists single ASCII characters; ``a-z`` style parts are ranges of two ends.

    Listed characters become a bit set in the regex engine, which is much faster than ranges.
    """
    codes = []
    for p in parts:
        codes += range(ord(p[0]), ord(p[2]) + 1) if len(p) == 3 and p[1] == "-" else map(ord, p)
    return "".join(f"\\x{c:02x}" for c in sorted(set(codes)))


def spans(text: Column, pattern: str | Column) -> Column:
    """All matches of ``pattern``, left to right, with code point offsets (end exclusive).

    The pieces between the matches and the matches themselves alternate; their lengths add up to the offsets.
    """
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["part"])
        end = start + F.coalesce(F.length(x["found"]), F.lit(0))
        item = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["found"].isNull(), state["out"]).otherwise(F.array_append(state["out"], item)).alias("out"))

    zipped = F.arrays_zip(parts.alias("part"), found.alias("found"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(zipped, begin, step, lambda s: s["out"])
