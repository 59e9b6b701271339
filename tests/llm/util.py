"""Small tables with the awkward cases that every operator must stand."""

import collections
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def awkward(spark, more=()):
    """Nulls in every column, empty and white-space texts, ties, repeated rows, a long text."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(20_000))
    rows = [(1, "one two three four five six seven", "en", "a", 33), (2, "one two three four five six seven", "en", "a", 33),
            (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 4), (None, "no id here at all today", "en", "b", 5),
            (7, long, "en", "a", len(long)), (8, long + " tail", "en", "a", 1), (9, "twice", "en", "c", 5), (9, "twice", "en", "c", 5),
            (10, "é 😀 ß ÀÉ\nsecond line\n\nsecond line", "fr", "c", 9), (11, "l'été it's 12 34", "fr", None, 3), *more]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    """The same table with extra columns named like those that operators make or use inside."""
    from pyspark.sql import functions as F
    names = ["id", "row", "body", "path", "n", "kept", "score", "copies", "size", "task", "digest", "uid", "term", "norm", "part", "h", "class", "page.x"]
    return df.withColumns({n: F.lit(1) for n in names if n not in df.columns})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k=5):
    words = (text or "").lower().encode().split()
    return collections.Counter([tuple(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [tuple(words)])


def probability_jaccard(x, y):
    pairs = collections.Counter((x[d], y[d]) for d in set(x) | set(y))
    return sum(n / sum(max(u / a, v / b) * m for (u, v), m in pairs.items()) for (a, b), n in pairs.items() if a and b)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
