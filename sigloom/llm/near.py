"""Near duplicates with ProbMinHash signatures, banding and exact verification.

A text is a set of weighted shingles (five lower-cased words, weight: how often).  Every shingle is a Poisson process
whose rate is its weight; its arrivals fall on random registers, and a register keeps the shingle that arrives first.  A
shingle stops as soon as its next arrival is later than the latest first arrival of all registers.  Two texts agree in a
register with probability J_P, their probability Jaccard similarity, which for weights of one is the Jaccard similarity.

Equal texts are counted once.  Bands of registers put texts in buckets; texts of a bucket are linked to its smallest
member only, so a bucket of n texts costs n rows.  The connected parts of these unverified links are the clusters in which
all similar pairs lie.  Inside a cluster texts are compared exactly, in blocks of bounded size: first every block with
block 0; then, in clusters of several blocks, the texts outside the main class found so far with every other block.
Pairs inside one class need no further look, so no link between classes is lost; tasks give back spanning trees, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import SHINGLE, U64, Words, mix, pieces, written

BANDS, ROWS = 24, 5
SIMILARITY = 0.8
BLOCK_TEXTS = 256
BLOCK_BYTES = 4 << 20  # of shingles; the comparison takes about 25 times as much
_STEP = 0xD1342543DE82EF95


def weighted_shingles(words: Words, texts: int, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) sorted by text and shingle; a text without words has one shingle, the same for all such texts."""
    text, h = words.shingles(k)
    bare = np.setdiff1d(np.arange(texts), text, assume_unique=False)
    text, h = np.concatenate((text, bare)), np.concatenate((h, np.zeros(len(bare), U64)))
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signatures (texts x registers): the shingle that arrives first in each register."""
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, U64)
    clock = np.zeros(len(text))
    state = shingle.copy()
    while len(text):
        with np.errstate(over="ignore"):
            state = state + U64(_STEP)
            draw = mix(state)
        clock = clock - np.log(((draw >> U64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / weight
        cell = text * registers + (mix(draw) % U64(registers)).astype(np.int64)
        np.minimum.at(first, cell, clock)
        won = first[cell] == clock
        winner[cell[won]] = shingle[won]
        open_ = clock < first.reshape(texts, registers).max(1)[text]
        text, shingle, weight, clock, state = (x[open_] for x in (text, shingle, weight, clock, state))
    return winner.reshape(texts, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per text and band."""
    parts = signature.reshape(len(signature), bands, -1)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * U64(_STEP), parts.shape[:2])
        for j in range(parts.shape[2]):
            key = mix(key * U64(31) + parts[:, :, j])
    return key.view(np.int64)


def digest(text: Column) -> Column:
    """128 bits of SHA-256 that stand for a whole text."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), digest(text).alias("digest"), F.coalesce(text, F.lit("")).alias("text"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of the distinct texts: node, digest, id (the smallest), copies, bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                n = piece.num_rows
                keys = band_keys(signatures(*weighted_shingles(Words(piece.column(2)), n), n))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), bands], ["id", "digest", "bands"])

    signed = _texts(docs, id_col, text_col).mapInArrow(sign, "id bigint, digest binary, bands array<bigint>")
    grouped = signed.groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    return written(grouped.select(F.monotonically_increasing_id().alias("node"), "digest", "id", "copies", "bands"), "texts")


def candidate_links(texts: DataFrame) -> DataFrame:
    """Written (a, b), a > b: every text of a bucket with the bucket's smallest."""
    entries = texts.select("node", F.explode("bands").alias("bucket"))
    hubs = written(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("b")).filter("n > 1").drop("n"), "hubs")
    links = entries.join(hubs, "bucket").filter("node <> b")
    return written(links.select(F.col("node").alias("a"), "b").distinct(), "candidates")


def _stars(links: DataFrame) -> bool:
    """Whether every node either points to one centre or is a centre itself: then the stars are the components."""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("out")).unionByName(links.select(F.col("b").alias("x"), F.lit(0).alias("out")))
    seen = ends.groupBy("x").agg(F.sum("out").alias("out"), F.count(F.lit(1)).alias("n"))
    return seen.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("n") > 1))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all linked nodes from distinct links (a, b): large and small stars in turn until only stars are left."""
    links = links.select("a", "b")
    while not _stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(root, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = written(small.unionByName(root.select("a", F.col("low").alias("b"))).distinct(), "stars")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """J_P of two weighted sets (elements sorted): sum over common d of 1 / sum over d' of max(x_d'/x_d, y_d'/y_d)."""
    every = np.union1d(a, b)
    u, v = np.zeros(len(every)), np.zeros(len(every))
    u[np.searchsorted(every, a)], v[np.searchsorted(every, b)] = x, y
    pairs, count = np.unique(np.stack((u, v), 1), axis=0, return_counts=True)  # few distinct weights
    common = pairs.min(1) > 0
    total = 0.0
    for (p, q), n in zip(pairs[common], count[common]):
        total += n / (np.maximum(pairs[:, 0] / p, pairs[:, 1] / q) * count).sum()
    return float(total)


def _similar(sets: list[tuple[np.ndarray, np.ndarray]], least: float, lead: np.ndarray | None = None) -> np.ndarray:
    """Pairs of the given texts as a boolean matrix: its connected parts are those of all pairs that reach the similarity.

    A common shingle with weight one on both sides adds exactly 1 / (sum of the larger weights) to J_P; any other one adds
    at most its share of either text's weight.  That gives a lower and an upper bound, equal where all weights are one.
    Only pairs whose bounds leave it open, and whose texts are not connected yet, are summed term by term.  Pairs inside
    ``lead`` (flags) come first and are settled among themselves, so the parts of ``lead`` alone do not depend on the others.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(h) for h, _ in sets])
    weight = np.concatenate([w for _, w in sets])
    _, column, df = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    total = np.bincount(owner, weights=weight, minlength=n)
    heavy = np.zeros(len(df), bool)
    heavy[column[weight > 1]] = True
    both = np.zeros((n, n))  # sums of the smaller weights over common shingles
    light = (df > 1) & ~heavy
    place = np.cumsum(light) - 1
    keep = light[column]
    rows, columns = owner[keep], place[column[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    width = 2048
    for start in range(0, int(light.sum()), width):
        a, b = np.searchsorted(columns, (start, start + width))
        one = np.zeros((n, width), np.float32)
        one[rows[a:b], columns[a:b] - start] = 1
        both += one @ one.T
    ones, others = both.copy(), np.zeros((n, n))
    keep = (heavy & (df > 1))[column]
    order = np.argsort(column[keep], kind="stable")
    rows, weights, columns = owner[keep][order], weight[keep][order], column[keep][order]
    for a, b in zip(cuts := np.flatnonzero(np.diff(columns, prepend=-1)), [*cuts[1:], len(columns)]):
        r, w = rows[a:b], weights[a:b].astype(float)
        cell = np.ix_(r, r)
        plain = np.logical_and.outer(w == 1, w == 1)
        both[cell] += np.minimum.outer(w, w)
        ones[cell] += plain
        others[cell] += np.where(plain, 0, (w / total[r])[:, None])
    low = ones / (total[:, None] + total[None, :] - both)
    out = low >= least - 1e-9
    open_ = ~out & (low + np.minimum(others, others.T) >= least - 1e-9)
    open_ = np.triu(open_, 1)
    among = np.zeros((n, n), bool) if lead is None else np.logical_and.outer(lead, lead)
    for part, within in ((open_ & among, among), (open_ & ~among, True)):
        if part.any():
            root = _forest(out & within)
            for i, j in zip(*np.nonzero(part)):
                if root[i] != root[j] and probability_jaccard(*sets[i], *sets[j]) >= least - 1e-9:
                    out[i, j] = out[j, i] = True
                    root[root == root[j]] = root[i]
    return out


def _forest(similar: np.ndarray) -> np.ndarray:
    """For every text of a block the smallest index it is connected with."""
    root = np.full(len(similar), -1)
    for i in range(len(similar)):
        if root[i] < 0:
            front = np.zeros(len(similar), bool)
            front[i] = True
            while front.any():
                root[front] = i
                front = similar[front].any(0) & (root < 0)
    return root


def _compare(tasks: DataFrame, least: float) -> DataFrame:
    """Written (cluster, a, b, main): links that connect what is similar inside each (cluster, task).

    Where a task holds rows of the ``first`` block, the smallest text of the largest part of these rows alone is its centre,
    the same in all tasks of the cluster; what is connected with it links to it directly, marked ``main``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, lead = None, {}, set()

        def links() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            nodes = np.array(sorted(held))
            of_first = np.array([x in lead for x in nodes.tolist()])
            similar = _similar([held[x] for x in nodes.tolist()], least, of_first)
            root = _forest(similar)
            centre = -1
            if lead:
                alone = _forest(similar[np.ix_(of_first, of_first)])
                centre = int(np.flatnonzero(of_first)[np.bincount(alone).argmax()])
                root = np.where(root == root[centre], centre, root)
            linked = root != np.arange(len(nodes))
            if linked.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(int(linked.sum()), key[0])), pa.array(nodes[linked]), pa.array(nodes[root[linked]]),
                                                  pa.array(root[linked] == centre)], ["cluster", "a", "b", "main"])

        for batch in batches:
            for cluster, task, node, shingles, weights, first in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (cluster, task):
                    yield from links()
                    key, held, lead = (cluster, task), {}, set()
                h = np.frombuffer(shingles, np.uint32)
                held[node] = (h, np.frombuffer(weights, np.uint32) if weights else np.ones(len(h), np.uint32))
                if first:
                    lead.add(node)
        yield from links()

    dealt = tasks.select("cluster", "task", "node", "shingles", "weights", "first").repartition("cluster", "task").sortWithinPartitions("cluster", "task")
    return written(dealt.mapInArrow(run, "cluster bigint, a bigint, b bigint, main boolean"), "links")


def _shingle_table(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written (cluster, node, shingles, weights) of the texts in clusters, read from the row with the smallest id of each text.

    Shingles are 32-bit hashes, distinct and sorted; weights are empty where all are one.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                n = piece.num_rows
                text, h, w = weighted_shingles(Words(piece.column(2)), n)
                ends = np.searchsorted(text, np.arange(n + 1))
                rows = []
                for a, b in zip(ends, ends[1:]):
                    small, at = np.unique((h[a:b] >> U64(32)).astype(np.uint32), return_inverse=True)
                    weight = np.bincount(at, weights=w[a:b]).astype(np.uint32)
                    rows.append((small.tobytes(), b"" if (weight == 1).all() else weight.tobytes()))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), *[pa.array(c, pa.binary()) for c in zip(*rows)]], ["cluster", "node", "shingles", "weights"])

    named = members.select("cluster", "node", F.col("digest").alias("d"), F.col("id").alias("i"))
    found = _texts(docs, id_col, text_col).join(named, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("i")))
    return written(found.select("cluster", "node", "text").mapInArrow(cut, "cluster bigint, node bigint, shingles binary, weights binary"), "shingles")


def near_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(digest, class, class_id, class_size) of every distinct text.

    ``class_id`` is the smallest id of all documents in the class (null ids are passed over), ``class_size`` their number.
    """
    texts = representatives(docs, id_col, text_col)
    members = components(candidate_links(texts)).select("node", F.col("root").alias("cluster")).join(texts.select("node", "digest", "id"), "node")
    shingles = _shingle_table(docs, members, id_col, text_col)
    sizes = shingles.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    blocks = sizes.select("cluster", F.ceil(F.greatest(F.col("n") / BLOCK_TEXTS, F.col("bytes") / BLOCK_BYTES)).cast("bigint").alias("blocks"))
    large = written(blocks.filter("blocks > 1"), "large")
    split = (shingles.join(large, "cluster", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("bigint")))
                     .withColumn("block", F.pmod(F.xxhash64("node"), "blocks")))
    tasks = F.when(F.col("block") == 0, F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).otherwise(F.array("block"))
    links = _compare(split.withColumn("first", (F.col("blocks") > 1) & (F.col("block") == 0)).withColumn("task", F.explode(tasks)), least)
    if not large.isEmpty():
        # A cluster of one block is done: its links are stars already.
        second = _compare(_rest(shingles, large, links).withColumn("first", F.lit(False)), least)
        begun = links.join(large, "cluster", "left_semi").unionByName(second).select("a", "b").distinct()
        later = components(begun).filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        links = links.join(large, "cluster", "left_anti").select("a", "b").unionByName(later)
    roots = links.groupBy("a").agg(F.min("b").alias("root"))
    classed = texts.join(roots, F.col("node") == F.col("a"), "left").select("digest", "id", "copies", F.coalesce("root", "node").alias("class"))
    per_class = classed.groupBy("class").agg(F.min("id").alias("class_id"), F.sum("copies").alias("class_size"),
                                             F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("keep"))
    return classed.join(per_class, "class").select("digest", "class", "class_id", "class_size", (F.col("digest") == F.col("keep.digest")).alias("keeps"), "id")


def _rest(shingles: DataFrame, large: DataFrame, links: DataFrame) -> DataFrame:
    """Tasks that compare the texts outside the main class of a large cluster with each other and with that class."""
    main = links.filter("main").select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("out", F.lit(False))
    placed = (shingles.join(large, "cluster").join(main, "node", "left")
                      .select("cluster", "node", "shingles", "weights", F.coalesce("out", F.lit(True)).alias("out")))
    size = lambda side: F.ceil(F.greatest(F.count_if(side) / BLOCK_TEXTS, F.sum(F.when(side, F.octet_length("shingles")).otherwise(0)) / BLOCK_BYTES)).cast("bigint")
    shares = placed.groupBy("cluster").agg(size(F.col("out")).alias("outer"), size(~F.col("out")).alias("inner")).filter(F.col("outer") > 0)
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("out"), F.col("outer")).otherwise(F.col("inner")))
    upto = lambda n: F.filter(F.sequence(F.lit(0).cast("bigint"), n), lambda j: j < n)
    width = F.col("outer") + F.col("inner")
    with_outer = F.transform(upto(F.col("outer")), lambda j: F.least(j, F.col("block")) * width + F.greatest(j, F.col("block")))
    with_inner = F.transform(upto(F.col("inner")), lambda j: F.col("block") * width + F.col("outer") + j)
    of_inner = F.transform(upto(F.col("outer")), lambda i: i * width + F.col("outer") + F.col("block"))
    tasks = F.when(F.col("out"), F.concat(with_outer, with_inner)).otherwise(of_inner)
    return placed.join(shares, "cluster").withColumn("block", block).withColumn("task", F.explode(tasks))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per document: id, class_id, class_size.

    Documents are in one class if a chain of pairs with a probability Jaccard similarity of ``least`` or more connects them.
    A null text counts as empty; texts without words are alike; a text of fewer than five words is one shingle.  Null ids
    keep their rows, a class of null ids only has a null class_id.  An empty table gives no rows.
    """
    classes = near_texts(docs, id_col, text_col, least).select(F.col("digest").alias("d"), "class_id", "class_size")
    rows = _texts(docs, id_col, text_col).select("id", "digest")
    return rows.join(classes, F.col("digest") == F.col("d")).select("id", "class_id", "class_size")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest id, of rows that repeat it any one; columns as they were."""
    keep = near_texts(docs, id_col, text_col, least).filter("keeps").select(F.col("digest").alias("_near_d"), F.col("id").alias("_near_i"))
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("id"), digest(F.col(f"`{text_col}`")).alias("digest"))
    joined = boxed.join(keep, (F.col("digest") == F.col("_near_d")) & F.col("id").eqNullSafe(F.col("_near_i")))
    return joined.dropDuplicates(["digest", "id"]).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
