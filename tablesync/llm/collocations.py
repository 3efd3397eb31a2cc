"""Phrases of two to five words that occur together more than their parts would, counted in HAT-tries.

Counting goes by length: a phrase that occurs ``MIN_COUNT`` times has only parts that do, so words are counted
first, then pairs of frequent words, then triples of frequent pairs, then what is longer of frequent triples. The
frequent phrases of the level before reach the tasks as a Bloom filter of bounded size; what it lets pass in error
is counted and then found too rare, so no count is changed by it.

A task counts in one trie for each language. Its inner levels go by word id; below them are hash containers of
what follows. A container with more than ``BURST`` phrases bursts into one for each next word. When a trie holds
``HELD`` phrases, the largest subtrees below its root are written out whole as sorted runs, until it
is half empty. The runs' phrases meet by prefix (the first ``PREFIX`` words, so no common word makes a large partition)
and are added up there. Word ids are a task's own; runs carry the words.

A phrase's score is the least, over its cuts in two, of floor(1000 a n / (l r)): a occurrences of the phrase, l and r
of its parts, among n words of the language; all in whole numbers of 38 digits. A phrase with a longer one around it
that is as frequent is dropped. It is enough to look one word further: what lies between is as frequent as either.

Defined results: a NULL lang is ``und``; a NULL or empty text has no words; equal rows count each; equal scores of cuts
go to the shortest first part; a language has ``TOP`` phrases at most, equal scores ordered by occurrences and phrase;
an empty table gives an empty result; texts are counted whole whatever their length. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.storage import conf

from .common import named, staged
from .shingles import mixed

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
PREFIX = 3
#: Phrases of a container, phrases of all tries of a task and of a run, words known to a task, words counted at once,
#: documents read at once.
BURST = 4096
HELD = 1_200_000
RUN = 20_000
KNOWN = 600_000
READ = 2_000_000
BATCH = 1000
#: The smallest and the largest Bloom filter, as powers of two of bits; the largest takes 32 MB.
BLOOM_BITS = (20, 28)
#: Stands between pieces; no UTF-8 text has this byte.
EDGE = b"\xff"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + 10 * EDGE)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of the texts in order, with ``EDGE`` wherever a piece ends."""
    return EDGE.join(texts).translate(_FOLD).replace(EDGE, b" \xff ").split()


def word_hash(lang: bytes, word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang + b"\xff" + word)


def phrase_hash(hashes: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from those of their words, one array for each place."""
    out = hashes[0]
    for h in hashes[1:]:
        out = mixed(out * _STEP + h)
    return out


class Inner(dict):
    """A level of the trie: the next word id to what is behind it."""


class HatTrie:
    """Counts of phrases of word ids. Keys are the ids as bytes, four each."""

    def __init__(self, burst: int):
        self.burst = burst
        self.root = Inner()
        self.size = 0

    def add(self, keys: list[bytes], counts: list[int]) -> None:
        root, burst, before = self.root, self.burst, self.size
        for key, n in zip(keys, counts):
            at = 4
            parent, step = root, key[:4]
            node = root.get(step)
            if node is None:
                root[step] = {key[4:]: n}
                self.size += 1
                continue
            while node.__class__ is Inner:
                parent, step = node, key[at : at + 4]
                at += 4
                node = node.get(step)
                if node is None:
                    node = parent[step] = {}
            rest = key[at:]
            if rest in node:
                node[rest] += n
            else:
                node[rest] = n
                self.size += 1
                if len(node) > burst and rest:
                    parent[step] = self._burst(node)

    @staticmethod
    def _burst(container: dict[bytes, int]) -> dict:
        """The container as a level of smaller ones; a phrase that ends here lies behind an empty step."""
        level = Inner()
        for rest, n in container.items():
            level.setdefault(rest[:4], {})[rest[4:]] = n
        return level

    def _take(self, node: dict, path: bytes, keys: list[bytes], counts: list[int]) -> None:
        if node.__class__ is Inner:
            for step, child in node.items():
                self._take(child, path + step, keys, counts)
        else:
            keys += [path + rest for rest in node]
            counts += node.values()

    def weight(self, node: dict) -> int:
        return sum(map(self.weight, node.values())) if node.__class__ is Inner else len(node)

    def spill(self, down_to: int) -> Iterator[tuple[list[bytes], list[int]]]:
        """Takes whole subtrees out, the largest first, until no more than down_to phrases are left."""
        for weight, step in sorted(((self.weight(c), s) for s, c in self.root.items()), reverse=True):
            if self.size <= down_to:
                break
            keys: list[bytes] = []
            counts: list[int] = []
            self._take(self.root.pop(step), step, keys, counts)
            self.size -= weight
            yield keys, counts


class Lexicon:
    """Word ids of one language within a task; id 0 is the edge of a piece."""

    def __init__(self, lang: bytes):
        self.lang = lang
        self.ids: dict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[EDGE]
        self.words = [EDGE]
        self.hashes = np.zeros(1, dtype=np.uint64)
        self._names: pa.Array | None = None

    def encode(self, words: list[bytes]) -> np.ndarray:
        """The ids of the words; unknown ones become known."""
        ids = np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words))
        new = len(self.ids) - len(self.words)
        if new:
            fresh = list(islice(reversed(self.ids), new))[::-1]
            self.words += fresh
            self.hashes = np.append(self.hashes, np.array([word_hash(self.lang, w) for w in fresh], dtype=np.uint64))
        return ids

    def names(self) -> pa.Array:
        """The words in order of their ids."""
        if self._names is None or len(self._names) < len(self.words):
            self._names = pa.array([b"", *self.words[1:]], pa.large_binary()).cast(pa.large_string())
        return self._names


class Bloom:
    """A set of hashes, with members in error but none missing."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = np.uint64(64 * len(table) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & self.mask
        return (self.table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def bloom_of(phrases: DataFrame) -> Bloom:
    """The filter of (lang, phrase) rows; its size follows their number, up to the largest."""
    low, high = BLOOM_BITS
    bits = min(high, max(low, (16 * phrases.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
            words = [[word_hash(lang, w) for w in phrase.split(b" ")] for lang, phrase in rows]
            found = np.zeros(len(words), dtype=np.uint64)
            for k in {len(w) for w in words}:
                own = [i for i, w in enumerate(words) if len(w) == k]
                found[own] = phrase_hash(list(np.array([words[i] for i in own], dtype=np.uint64).T))
            slot = found & np.uint64((1 << bits) - 1)
            bit = np.uint64(1) << (slot & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bit.view(np.int64))], names=["w", "m"])

    words = phrases.select("lang", "phrase").mapInArrow(run, "w long, m long").groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[words["w"].to_numpy(dtype=np.int64)] = words["m"].to_numpy(dtype=np.int64)
    return Bloom(table.view(np.uint64))


def phrases_in(ids: np.ndarray, hashes: np.ndarray, known: Bloom | None, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of word ids, counts) of the distinct phrases of each size, whose parts of the size that known holds are in it."""
    if known is None:
        found, n = np.unique(ids[ids > 0], return_counts=True)
        yield found[:, None], n
        return
    base = sizes[0] - 1
    count = len(ids) - base + 1
    if count < 1:
        return
    inside = np.ones(count, dtype=bool)
    for k in range(base):
        inside &= ids[k : k + count] > 0
    at = np.flatnonzero(inside)
    at = at[known.has(phrase_hash([hashes[ids[at + k]] for k in range(base)]))]
    frequent = np.zeros(len(ids) + MAX_WORDS + 1, dtype=bool)
    frequent[at] = True
    for size in range(base + 1, sizes[-1] + 1):
        at = at[frequent[at + size - base]]  # every part of size base is frequent
        if size not in sizes or not len(at):
            continue
        key = ids[at]
        for k in range(1, size):  # numbers for the phrases so far, then with one word more
            _, key = np.unique(key, return_inverse=True)
            key = (key << 32) | ids[at + k]
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        yield np.stack([ids[at[first] + k] for k in range(size)], axis=1), n


def _counted(texts: DataFrame, known, sizes: tuple[int, ...]) -> DataFrame:
    """(lang, prefix, phrase, n) of sorted runs; a phrase may be in several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = known.value if known is not None else None
        lexicons: dict[bytes, Lexicon] = {}
        tries: dict[bytes, HatTrie] = {}
        read: dict[bytes, list[np.ndarray]] = defaultdict(list)  # word ids that are not counted yet

        def count(lang: bytes) -> None:
            own = read.pop(lang)
            for found, n in phrases_in(np.concatenate(own), lexicons[lang].hashes, bloom, sizes):
                width, flat = 4 * found.shape[1], found.astype(">u4").tobytes()
                tries[lang].add([flat[i : i + width] for i in range(0, len(flat), width)], n.tolist())

        def run_of(lang: bytes, keys: list[bytes], counts: list[int]) -> Iterator[pa.RecordBatch]:
            """A sorted run for the phrases of each length."""
            names, widths, counts = lexicons[lang].names(), np.array([len(k) for k in keys]), np.array(counts)
            for width in np.unique(widths).tolist():
                own = np.flatnonzero(widths == width)
                ids = np.frombuffer(b"".join([keys[i] for i in own.tolist()]), dtype=">u4").reshape(len(own), -1)
                phrases = names.take(pa.array(ids[:, 0].astype(np.int64)))
                if width > 4:
                    rest = [names.take(pa.array(ids[:, k].astype(np.int64))) for k in range(1, ids.shape[1])]
                    phrases = pc.binary_join_element_wise(phrases, *rest, pa.scalar(" ", pa.large_string()))
                phrases = phrases.cast(pa.string())
                order = pc.sort_indices(phrases)
                shown = pa.array(counts[own].astype(np.int64)).take(order)
                yield pa.RecordBatch.from_arrays([pa.array([lang.decode()] * len(own), pa.string()), phrases.take(order), shown], names=["lang", "phrase", "n"])

        def spill(total: int) -> Iterator[pa.RecordBatch]:
            """Runs of the largest tries, until all hold no more than total phrases."""
            left = sum(t.size for t in tries.values()) - total
            for lang, trie in sorted(tries.items(), key=lambda x: -x[1].size):
                before, keys, counts = trie.size, [], []
                for own, n in trie.spill(max(0, before - left)):
                    keys += own
                    counts += n
                    if len(keys) > RUN:
                        yield from run_of(lang, keys, counts)
                        keys, counts = [], []
                if keys:
                    yield from run_of(lang, keys, counts)
                left -= before - trie.size
                if left <= 0:
                    break

        for batch in batches:
            by_lang: dict[bytes, list[bytes]] = defaultdict(list)
            for lang, text in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    by_lang[lang].append(text)
            for lang, own in by_lang.items():
                if lang not in lexicons:
                    lexicons[lang], tries[lang] = Lexicon(lang), HatTrie(BURST)
                read[lang].append(lexicons[lang].encode(tokens(own)))
            if sum(len(ids) for own in read.values() for ids in own) > READ:
                for lang in list(read):
                    count(lang)
            full = sum(len(x.words) for x in lexicons.values()) > KNOWN
            if full or sum(t.size for t in tries.values()) > HELD:
                for lang in list(read):
                    count(lang)
                yield from spill(0 if full else HELD // 2)
                if full:
                    lexicons, tries = {}, {}
        for lang in list(read):
            count(lang)
        yield from spill(0)

    runs = texts.mapInArrow(run, "lang string, phrase string, n long")
    if sizes[-1] <= PREFIX:  # the prefix is the phrase
        return runs.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    runs = runs.withColumn("prefix", F.substring_index("phrase", " ", PREFIX)).repartition("lang", "prefix")
    return runs.groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("n")).drop("prefix")


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, a) of the frequent phrases of up to max_words words, and (lang, n) of all words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(named(docs, lang).cast("string"), F.lit("und")).alias("lang"), named(docs, text).alias("text"))
    plan = [(1,), (2,), (3,), tuple(range(4, max_words + 1))]
    known, levels, totals = None, [], None
    with conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH):
        for sizes in [p for p in plan if p and p[0] <= max_words]:
            counted = _counted(texts, known, sizes)
            if totals is None:
                counted = staged(counted, "word-counts")
                totals = staged(counted.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
            often = staged(counted.filter(F.col("n") >= min_count).select("lang", "phrase", F.col("n").alias("a")), "phrase-counts")
            levels.append(often.select("lang", F.size(F.split("phrase", " ")).alias("k"), "phrase", "a"))
            known = spark.sparkContext.broadcast(bloom_of(often))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language."""
    counts, totals = phrase_counts(docs, text, lang, max_words, min_count)
    found = counts.filter("k > 1")
    words = F.split("phrase", " ")
    part = lambda start, size: F.concat_ws(" ", F.slice(words, start, size))
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"first": part(F.lit(1), F.col("cut")), "rest": part(F.col("cut") + 1, F.col("k") - F.col("cut"))})
    side = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    number = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumns({"up": F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(16,0)") * F.col("n").cast("decimal(18,0)"), "down": number("l") * number("r")})
    cuts = cuts.withColumn("score", F.expr("up div down"))
    least = F.min(F.struct("score", "cut", "l", "r")).alias("m")
    scored = cuts.groupBy("lang", "phrase").agg(least, F.first("k").alias("k"), F.first("a").alias("a"), F.first("n").alias("n"))
    inner = F.explode(F.array(part(F.lit(1), F.col("k") - 1), part(F.lit(2), F.col("k") - 1))).alias("phrase")
    around = found.filter("k > 2").select("lang", inner, "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter("around IS NULL OR around < a")
    from pyspark.sql import Window

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
