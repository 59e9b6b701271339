"""Phrase collocations, counted in tries of word ids with hash containers.

A task reads each place in a text as the window of the words that begin there.  Windows go into a trie of word ids that
begins as one hash container; a container bursts between first words and, where a first word is too common, between
its next words.  A full trie spills its largest subtrees whole, as sorted runs of (window, count).  Runs of all tasks meet by range of the window, so all windows that share a prefix lie together; a
prefix that is too common for one range is cut by its next words.  Each range is merged in one sweep: the count of a
phrase is the sum over the windows that it begins.  The phrases open at either end of a range are summed once more.

Pass one takes windows of two words.  A longer phrase can only be frequent if every pair of words in it is, so pass two
lets a window grow over frequent pairs only.  Which pairs those are is told by a Bloom filter of bounded size: it lets
some others through, which costs time, and never holds a frequent one back, so the counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import U64, Words, mix, pieces, written

LEAST = 30  # occurrences of a candidate
WORDS = 4  # of a phrase at most
TOP = 2000  # phrases reported per language
SHARE = 80  # per cent of a phrase's places inside one longer phrase from which it is dropped
TRIE_ENTRIES = 2_000_000  # entries at which a trie spills: about 100 MB
TRIE_BYTES = 96 << 20  # bytes of its distinct words at which it spills as a whole
BURST = 1 << 17  # entries at which a container bursts
TEXT_BYTES = 4 << 20  # text handled at once
STEP = 1 << 18  # words that go into a trie at once
RUN_BYTES = 8 << 20  # of windows in one output batch
FILTER_BITS = (1 << 16, 1 << 27)  # least and most bits of the filter: 16 MiB at most
FILTER_BITS_PER_PAIR = 16
FILTER_HASHES = 3

SCORE = "cast(a as decimal(19,0)) * 2000000 div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"  # products may pass 64 bits
_CHUNK = 1 << 20  # ids of a trie stay below this, so that two of them fit a key of 40 bits
RUNS = "window binary, n bigint"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Places:
    """Words of many texts in order: index of the distinct word, and the piece (between punctuation) each stands in."""

    ENDS = np.zeros(256, bool)
    ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
    BLANK = np.zeros(256, bool)
    BLANK[[9, 32]] = True

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]].copy() if texts.buffers()[2] else np.zeros(0, np.uint8)
        begins = ends - ends[0]
        data[(data >= 65) & (data <= 90)] += 32
        n = len(data)
        stop = self.ENDS[data]
        inside = ~(stop | self.BLANK[data])
        edge = np.zeros(n + 1, bool)
        edge[begins] = True
        before = np.concatenate(([False], inside[:-1])) if n else inside
        start = np.flatnonzero(inside & (~before | edge[:n]))
        after = np.concatenate((inside[1:], [False])) if n else inside
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        breaks = np.cumsum(stop | edge[:n]) if n else np.zeros(0, np.int64)
        self.piece = breaks[start]
        self.text = np.searchsorted(begins, start, side="right") - 1
        # Words end to end, without what stands between them.
        size = end - start
        offsets = np.concatenate(([0], np.cumsum(size)))
        body = data[np.repeat(start - offsets[:-1], size) + np.arange(int(offsets[-1]))]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)]).dictionary_encode()
        self.words, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A hash per word; words hold no blank, so each is one word to ``Words`` too."""
    return Words(words.cast(pa.large_string()), lower=False).hash


def _pair_hash(first: np.ndarray, second: np.ndarray, lang: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(first + lang * U64(3)) * U64(5) + second)


def _lang_hashes(langs: list[str]) -> np.ndarray:
    import hashlib
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], U64)


def _positions(pair: np.ndarray, bits: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [(mix(pair + U64(0x9E3779B97F4A7C15) * U64(i + 1)) & U64(bits - 1)).astype(np.int64) for i in range(FILTER_HASHES)]


class _Container:
    """Hash table of windows in a range of the trie: open addressing over arrays, filled many windows at a time."""

    def __init__(self, low: tuple[int, int], size: int = 1 << 10):
        self.low, self.count = low, 0
        self.root, self.rest, self.n = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)

    def add(self, root: np.ndarray, rest: np.ndarray, n: np.ndarray) -> int:
        """Adds distinct windows; the number of new ones."""
        before, size = self.count, len(self.root)
        if 2 * (before + len(root)) > size:
            old = self.items()
            while 2 * (before + len(root)) > size:
                size *= 2
            self.__init__(self.low, size)
            self.add(*old)
        with np.errstate(over="ignore"):
            slot = (mix(root.astype(U64) * U64(0x9E3779B97F4A7C15) + rest.astype(U64)) & U64(size - 1)).astype(np.int64)
        left = np.arange(len(root))
        while len(left):
            at = slot[left]
            free = self.root[at] < 0
            if free.any():  # of the windows that want a free slot the last one gets it
                self.root[at[free]] = -2 - left[free]
                won = np.flatnonzero(self.root[at] == -2 - left)
                self.root[at[won]], self.rest[at[won]] = root[left[won]], rest[left[won]]
                self.count += len(won)
            same = (self.root[at] == root[left]) & (self.rest[at] == rest[left])
            self.n[at[same]] += n[left[same]]
            left = left[~same]
            slot[left] = (slot[left] + 1) & (size - 1)
        return self.count - before

    def items(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = self.root >= 0
        return self.root[held], self.rest[held], self.n[held]


class HatTrie:
    """Counts of windows of word ids, kept as (language and first word, remaining words).

    The trie starts as one hash container.  A container that holds more than ``BURST`` windows bursts: one over several first
    words is split between two of them, one over a single first word by its next words.  Id 0 stands for no word.
    """

    def __init__(self, words: int):
        self.words_of_window = words
        self.ids: dict[bytes, int] = {}
        self.words: list[bytes] = [b""]
        self.langs: dict[str, int] = {}
        self.totals: list[int] = []
        self.leaves = [_Container((-1, -1))]
        self.entries = self.bytes = 0

    def number(self, words: list[bytes]) -> np.ndarray:
        ids, known = np.empty(len(words), np.int64), self.ids
        for i, w in enumerate(words):
            k = known.get(w)
            if k is None:
                k = known[w] = len(self.words)
                self.words.append(w)
                self.bytes += len(w) + 150
            ids[i] = k
        return ids

    def languages(self, names: list[str], counts: np.ndarray) -> np.ndarray:
        """Numbers of languages; ``counts`` are their words."""
        out = np.empty(len(names), np.int64)
        for i, (name, n) in enumerate(zip(names, counts.tolist())):
            out[i] = self.langs.setdefault(name, len(self.langs))
            if out[i] == len(self.totals):
                self.totals.append(0)
            self.totals[out[i]] += n
        return out

    def add(self, root: np.ndarray, rest: np.ndarray) -> None:
        """Windows in any order, repeated or not."""
        if self.words_of_window == 2:
            key = np.sort(root << 20 | rest >> 40)
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            root, rest, n = key[new] >> 20, (key[new] & (_CHUNK - 1)) << 40, np.diff(np.append(new, len(key)))
        else:
            order = np.lexsort((rest, root))
            root, rest = root[order], rest[order]
            new = np.flatnonzero(np.concatenate(([True], (root[1:] != root[:-1]) | (rest[1:] != rest[:-1]))))
            root, rest, n = root[new], rest[new], np.diff(np.append(new, len(order)))
        cuts = []
        for leaf in self.leaves:
            a, b = np.searchsorted(root, leaf.low[0]), np.searchsorted(root, leaf.low[0], "right")
            cuts.append(a + np.searchsorted(rest[a:b], leaf.low[1]))
        cuts.append(len(root))
        grown = []
        for leaf, a, b in zip(self.leaves, cuts, cuts[1:]):
            if b > a:
                self.entries += leaf.add(root[a:b], rest[a:b], n[a:b])
            grown += self._burst(leaf) if leaf.count > BURST else [leaf]
        self.leaves = grown

    def _burst(self, leaf: _Container) -> list[_Container]:
        root, rest, n = leaf.items()
        order = np.lexsort((rest, root))
        root, rest, n = root[order], rest[order], n[order]
        half = len(root) // 2
        cut = np.searchsorted(root, root[half]) or np.searchsorted(root, root[half], "right")
        low = (int(root[min(cut, len(root) - 1)]), -1)
        if cut == len(root):  # one first word: the next words decide
            cut, low = half, (int(root[half]), int(rest[half]))
        parts = [_Container(leaf.low), _Container(low)]
        parts[0].add(root[:cut], rest[:cut], n[:cut])
        parts[1].add(root[cut:], rest[cut:], n[cut:])
        return parts

    def full(self) -> bool:
        """Whether another ``STEP`` of words might not fit."""
        return self.bytes > TRIE_BYTES or len(self.words) > _CHUNK - 2 * STEP or len(self.langs) > _CHUNK

    def spill(self, least: int) -> Iterator[pa.RecordBatch]:
        """Takes out whole subtrees, largest first, until ``least`` entries are gone, as sorted runs.

        With them go the words of each language counted so far, as windows of an empty word.
        """
        names = [x.encode().hex().encode() + b" " for x in self.langs]
        if self.words_of_window == 2 and any(self.totals):
            yield pa.RecordBatch.from_arrays([pa.array([b" " + x for x in names]), pa.array(self.totals, pa.int64())], ["window", "n"])
            self.totals = [0] * len(self.totals)
        taken = 0
        for i in sorted(range(len(self.leaves)), key=lambda i: -self.leaves[i].count):
            leaf = self.leaves[i]
            if taken >= least or not leaf.count:
                break
            taken += leaf.count
            self.entries -= leaf.count
            self.leaves[i] = _Container(leaf.low)
            yield from self._run(*leaf.items(), names)

    def _run(self, root: np.ndarray, rest: np.ndarray, n: np.ndarray, names: list[bytes]) -> Iterator[pa.RecordBatch]:
        mask = _CHUNK - 1
        ids = [root & mask, *[(rest >> (20 * (3 - j))) & mask for j in range(1, self.words_of_window)]]
        used = np.zeros(len(self.words), bool)
        for i in ids:
            used[i] = True
        chosen = np.flatnonzero(used)
        vocabulary = pa.array([self.words[i] + b" " if i else b"" for i in chosen.tolist()], pa.large_binary())
        rank = np.empty(len(chosen), np.int64)
        rank[pc.sort_indices(vocabulary).to_numpy()] = np.arange(len(chosen))
        place = np.cumsum(used) - 1
        ids = [place[i] for i in ids]
        lang = root >> 20
        # In the order of a window's bytes: first word, language, other words.
        order = np.lexsort((*[rank[i] for i in ids[:0:-1]], lang, rank[ids[0]]))
        lengths = pc.binary_length(vocabulary).to_numpy().astype(np.int64)
        volume = np.cumsum(sum(lengths[i] for i in ids)[order]) // RUN_BYTES
        cuts = np.flatnonzero(np.concatenate(([True], volume[1:] != volume[:-1], [True])))
        spoken = pa.array(names, pa.large_binary())
        for a, b in zip(cuts, cuts[1:]):
            at = order[a:b]
            words = [vocabulary.take(pa.array(i[at])) for i in ids]
            window = pc.binary_join_element_wise(words[0], spoken.take(pa.array(lang[at])), *words[1:], pa.scalar(b"", pa.large_binary()))
            yield pa.RecordBatch.from_arrays([window.cast(pa.binary()), pa.array(n[at])], ["window", "n"])


def runs(docs: DataFrame, name: str, words: int, gate=None, lang_col: str = "lang", text_col: str = "text", trie_entries: int = TRIE_ENTRIES) -> DataFrame:
    """Written runs of windows of up to ``words`` words: first word, language in hexadecimal, other words, each with a blank after it.

    So whatever begins with the same words of a language lies together in byte order.

    With a ``gate`` (broadcast bits of frequent pairs) a window grows over pairs in it only, and short ones are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if gate is None else np.frombuffer(gate.value, np.uint8)
        trie = HatTrie(words)
        for batch in batches:
            for piece in pieces(batch, "text", TEXT_BYTES):
                places = Places(pc.fill_null(piece.column(1), ""))
                if not len(places.word):
                    continue
                langs = pc.fill_null(piece.column(0), "und").dictionary_encode()
                names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()[places.text]
                near = np.append(places.piece[1:] == places.piece[:-1], False)  # the next word stands in the same piece
                if bits is not None:
                    h = _word_hashes(places.words)[places.word]
                    at = np.flatnonzero(near)
                    pair = _pair_hash(h[at], h[at + 1], _lang_hashes(names)[lang[at]])
                    for p in _positions(pair, 8 * len(bits)):
                        near[at[(bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 0]] = False
                for s in range(0, len(near), STEP):
                    window = slice(s, s + STEP + WORDS)
                    used = np.zeros(len(places.words), bool)
                    used[places.word[window]] = True
                    ids = trie.number(places.words.take(pa.array(np.flatnonzero(used))).to_pylist())[(np.cumsum(used) - 1)[places.word[window]]]
                    spoken = trie.languages(names, np.bincount(lang[s:s + STEP], minlength=len(names)))
                    linked, rest = near[window], np.zeros(len(ids), np.int64)
                    follow = linked
                    for j in range(1, words):
                        there = np.flatnonzero(follow)
                        there = there[there + j < len(ids)]
                        rest[there] |= ids[there + j] << (20 * (3 - j))
                        follow = follow & np.concatenate((linked[j:], np.zeros(min(j, len(ids)), bool)))
                    root, rest = (spoken[lang[window]] << 20 | ids)[:STEP], rest[:STEP]
                    if bits is not None:
                        long_ = np.flatnonzero((rest >> 20) & (_CHUNK - 1))  # at least three words
                        root, rest = root[long_], rest[long_]
                    if len(root):
                        trie.add(root, rest)
                    if trie.full():
                        yield from trie.spill(trie.entries + 1)
                        trie = HatTrie(words)
                    elif trie.entries > trie_entries:
                        yield from trie.spill(trie.entries * 3 // 4)
        yield from trie.spill(trie.entries + 1)

    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    return written(rows.mapInArrow(run, RUNS), name)


class _Sweep:
    """One range of sorted windows: counts per phrase of every length, with what stays open between batches."""

    def __init__(self, shortest: int, longest: int, least: int):
        self.depths, self.least = range(shortest, longest + 1), least
        self.open: dict[int, tuple[bytes, int, bool]] = {}  # depth: phrase with language, count, whether it opens the range

    def batch(self, batch: pa.RecordBatch) -> tuple[list[bytes], list[int]]:
        windows = batch.column(0).cast(pa.large_binary())
        n = batch.column(1).to_numpy()
        rows = len(n)
        ends = np.frombuffer(windows.buffers()[1], np.int64)[windows.offset:windows.offset + rows + 1]
        data = np.frombuffer(windows.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        stops = np.flatnonzero(data == 32)
        first = np.searchsorted(stops, ends[:-1])
        size = np.diff(np.append(first, len(stops)))
        # Words as numbers, so that neighbours are compared exactly and all at once.
        begins = np.concatenate(([0], stops + 1)).astype(np.int64)
        word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(begins), pa.py_buffer(data.copy())]).dictionary_encode().indices.to_numpy()
        changed = np.concatenate(([True], word[first[1:]] != word[first[:-1]]))
        begins_range = not self.open
        out: tuple[list[bytes], list[int]] = ([], [])
        for d in range(1, self.depths[-1] + 1):
            at = np.full(rows, -1, np.int64)
            deep = size > d  # the language comes between
            at[deep] = word[first[deep] + d]
            changed = changed | np.concatenate(([True], at[1:] != at[:-1]))
            if d not in self.depths:
                continue
            heads = np.flatnonzero(changed)
            sums = np.add.reduceat(n, heads)
            kept = deep[heads]
            if not kept.any():
                continue
            heads, sums = heads[kept], sums[kept]
            phrase = lambda i: data[ends[heads[i]]:stops[first[heads[i]] + d]].tobytes()
            start = 0
            opens = begins_range
            if d in self.open:
                p, c, o = self.open[d]
                if p == phrase(0):
                    sums[0] += c
                    opens = o
                elif c >= self.least or o:
                    out[0].append(p)
                    out[1].append(c)
            last = len(heads) - 1
            closed = np.flatnonzero(sums[start:last] >= self.least).tolist()
            if opens and last > 0 and closed[:1] != [0]:
                closed = [0, *closed]
            for i in closed:
                out[0].append(phrase(i))
                out[1].append(int(sums[i]))
            self.open[d] = (phrase(last), int(sums[last]), opens and last == 0)
        return out

    def rest(self) -> tuple[list[bytes], list[int]]:
        return [p for p, _, _ in self.open.values()], [c for _, c, _ in self.open.values()]


def _named(found: tuple[list[bytes], list[int]]) -> pa.RecordBatch:
    langs, phrases = [], []
    for p in found[0]:
        first, lang, *others = p.decode().split(" ")
        langs.append(bytes.fromhex(lang).decode())
        phrases.append(" ".join([first, *others]))
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(found[1], pa.int64())], ["lang", "phrase", "f"])


def merged(written_runs: DataFrame, shortest: int, longest: int, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f) of all phrases of ``shortest`` to ``longest`` words that occur ``least`` times; '' counts all words."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Sweep(shortest, longest, least)
        for batch in batches:
            for piece in pieces(batch, "window", RUN_BYTES):
                yield _named(state.batch(piece))
        yield _named(state.rest())

    ranged = written_runs.repartitionByRange("window").sortWithinPartitions("window")
    swept = ranged.mapInArrow(sweep, "lang string, phrase string, f bigint")
    return swept.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter((F.col("f") >= least) | (F.col("phrase") == ""))


def frequent_pairs(counted: DataFrame) -> bytes:
    """Bloom filter of all pairs of words in ``counted``: its size follows their number up to a fixed bound."""
    pairs = counted.filter(F.contains("phrase", F.lit(" "))).select("lang", "phrase")
    bits = FILTER_BITS[0]
    while bits < min(FILTER_BITS[1], FILTER_BITS_PER_PAIR * pairs.count()):
        bits *= 2

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs = batch.column(0).dictionary_encode()
            both = pc.split_pattern(batch.column(1), " ").flatten().dictionary_encode()
            h = _word_hashes(both.dictionary)[both.indices.to_numpy()].reshape(-1, 2)
            at = np.concatenate(_positions(_pair_hash(h[:, 0], h[:, 1], _lang_hashes(langs.dictionary.to_pylist())[langs.indices.to_numpy()]), bits))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["cell", "bit"])

    cells = pairs.mapInArrow(positions, "cell bigint, bit bigint").groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(bits // 32, "<u4")
    for batch in [cells.toArrow()]:  # bounded: one row per 32 bits of the filter
        out[batch.column("cell").to_numpy()] = batch.column("bits").to_numpy().astype("<u4")
    return out.tobytes()


def phrase_counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", trie_entries: int = TRIE_ENTRIES) -> tuple[DataFrame, DataFrame]:
    """(written lang, phrase, f of all frequent phrases of 1 to ``WORDS`` words; lang, n of all words).

    A null lang is ``und``, a null text empty.  Rows that repeat count as often.  An empty table gives no rows.
    """
    short = runs(docs, "pairs", 2, None, lang_col, text_col, trie_entries)
    both = written(merged(short, 1, 2, least), "counts2")
    totals = both.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    counted = both.filter("phrase <> ''")
    gate = docs.sparkSession.sparkContext.broadcast(frequent_pairs(counted))
    long_ = runs(docs, "windows", WORDS, gate, lang_col, text_col, trie_entries)
    return written(counted.unionByName(merged(long_, 3, WORDS, least)), "counts"), totals


def _words(phrase: Column, first: Column | int, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, lang_col: str = "lang", text_col: str = "text",
                 trie_entries: int = TRIE_ENTRIES) -> DataFrame:
    """The first ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Every cut of a phrase in two rates it by 2,000,000 a / (l + r), rounded down; its lowest cut counts, the first of equal
    ones.  A phrase that stands in ``share`` per cent of its places inside one longer phrase is dropped.  Ties go by a,
    then by phrase in byte order.
    """
    counted, totals = phrase_counts(docs, least, lang_col, text_col, trie_entries)
    sized = counted.withColumn("m", F.size(F.split("phrase", " ")))
    candidates = sized.filter("m > 1")
    # The longer phrase's count, at each shorter phrase inside it: partial maxima, so a common phrase stays small.
    starts = F.explode(F.sequence(F.lit(1), F.col("m") - F.col("k") + 1))
    inside = (candidates.filter("m > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("m") - 1))).withColumn("i", starts)
                        .select("lang", _words(F.col("phrase"), F.col("i"), F.col("k")).alias("phrase"), "f")
                        .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    left = candidates.join(inside, ["lang", "phrase"], "left")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    left = left.filter("longer is null").unionByName(left.filter("longer is not null").filter(exact("longer") * 100 < exact("f") * share)).drop("longer")
    cut = (left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
               .select("lang", "phrase", F.col("f").alias("a"), "k", _words(F.col("phrase"), 1, F.col("k")).alias("head"),
                       _words(F.col("phrase"), F.col("k") + 1, F.col("m") - F.col("k")).alias("tail")))
    heads = counted.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counted.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    rated = (both.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
                 .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First per part of a language, then per language: no task orders more than ``top`` rows of each part.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = rated.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
