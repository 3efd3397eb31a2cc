"""Spelling variants of words, by blocked Gram matrices of letter counts.

Words are the runs of Latin letters of all texts. Before they are counted, some runs lose one letter, chosen by a
checksum of document and run: misspellings whose right form is known. Two words are near if one inserted, deleted
or replaced letter makes one of the other. A word's form is the most frequent near word, if that is ``ratio`` times
as frequent; following forms leads to its root.

Near words have letter counts at a squared distance of 1 (one letter more) or 2 (one replaced). Squared distances
come out of one matrix product: D = |x|^2 + |y|^2 - 2 x.y. Blocks for it are found by letter counts too, in
``CLASSES`` classes of letters: a word stands in the block of its own class counts, with the words that are one letter
longer, each of which stands in the block of its counts less one letter of each of its classes. So a block
holds words of two adjacent lengths, near words meet in exactly the block of what they share, and whatever else it
holds is sorted out by the product and then by comparing letters from both ends. Blocks larger than ``BLOCK`` words
are cut into parts that meet in pairs. Small blocks share one product. No block is capped.

Defined results: a NULL or empty text has no words; a NULL doc_id counts as empty text in the checksum; equal rows
count each; of near words equally frequent the smallest in code-point order is the form; an empty table gives an
empty result; a run is taken whole whatever its length. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, staged

#: Words: letters, code points, occurrences; every MISSPELT-th (document, run) loses a letter.
LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
MISSPELT = 199
RATIO = 5
#: Classes of letters (code point modulo CLASSES).
CLASSES = 16
#: Words of a part of a block, and letters of one; words of one product of small blocks.
BLOCK = 1024
BLOCK_LETTERS = 1 << 22
TILE = 512
#: Distinct words counted by one task before they are passed on; rows of one output batch.
COUNTED = 300_000
ROWS = 10_000


def runs_of(text: str, find) -> Counter[str]:
    """Runs of letters, A-Z as a-z, with their counts."""
    return Counter(find(text.encode().lower().decode()))  # bytes lower A-Z alone


def misspelt(runs: Counter[str], prefix: bytes, every: int, min_length: int) -> Counter[str]:
    """The runs with a letter less where the checksum says so; the others as they are."""
    crc32, start = zlib.crc32, zlib.crc32(prefix)
    moved = []
    for run in runs:
        h = crc32(run.encode(), start)
        if h % every == 0:
            moved.append((run, h % len(run)))
    words = runs
    counts = [(run, place, words.pop(run)) for run, place in moved]
    for run, place, n in counts:
        word = run[:place] + run[place + 1 :]
        if len(word) >= min_length:
            words[word] += n
    return words


def vocabulary(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = MISSPELT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough. Each task counts before the shuffle."""

    def batch_of(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A shorter run cannot become a word, nor can part of one be a match.
        find = re.compile(f"[{LETTERS}]{{{min_length},}}").findall
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if body:
                    counts.update(misspelt(runs_of(body, find), f"{doc_id}:".encode(), every, min_length))
                    if len(counts) >= COUNTED:
                        yield batch_of(counts)
                        counts = Counter()
        yield batch_of(counts)

    doc_id = F.coalesce(named(docs, "doc_id").cast("string"), F.lit(""))
    counted = docs.select(doc_id.alias("doc_id"), named(docs, text).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (the public splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A block's number is the sum of these over the letters: equal for equal class counts.
_CLASS = _mixed(np.arange(1, CLASSES + 1, dtype=np.uint64))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of all words as bytes, first letter of each word and the end)."""
    ends = np.cumsum([0] + [len(w) for w in words])
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8), ends


def _blocks(vocab: DataFrame) -> DataFrame:
    """(block, gone, word, n): each word in its own block (gone -1) and in that of one letter less of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                letters, ends = _letters(part.column(0).to_pylist())
                kind = (letters % CLASSES).astype(np.int64)
                owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
                own = np.add.reduceat(_CLASS[kind], ends[:-1])
                word, gone = np.divmod(np.unique(owner * CLASSES + kind), CLASSES)
                blocks = np.concatenate([own, own[word] - _CLASS[gone]]).view(np.int64)
                rows = pa.array(np.concatenate([np.arange(part.num_rows), word]))
                gones = np.concatenate([np.full(part.num_rows, -1), gone]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(gones), part.column(0).take(rows), part.column(1).take(rows)], names=["block", "gone", "word", "n"])

    return vocab.select("word", "n").mapInArrow(run, "block long, gone int, word string, n long")


def near_in(words: list[str], group: np.ndarray, gone: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i < j, of near words of one group, by one Gram matrix.

    gone is the class of the letter that a word lacks in this block; a pair counts in the block of the letter it
    differs by, so in one only. With apart, only pairs whose marks differ are compared.
    """
    letters, ends = _letters(words)
    sizes = np.diff(ends)
    kinds, column = np.unique(letters, return_inverse=True)
    owner = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(owner * len(kinds) + column, minlength=len(words) * len(kinds)).reshape(len(words), -1)
    exact = np.float32 if len(words) and sizes.max() < 2000 else np.float64  # squares stay below 2 ** 23
    x = counts.astype(exact)
    square = (x * x).sum(axis=1)
    distance = square[:, None] + square[None, :] - 2 * (x @ x.T)
    keep = (distance > 0) & (distance <= 2) & (group[:, None] == group[None, :])
    if apart is not None:
        keep &= apart[:, None] != apart[None, :]
    i, j = np.nonzero(np.triu(keep, 1))
    # The longer of two words lacks a letter here, of equally long ones each; others meet in another block.
    most = np.maximum(sizes[i], sizes[j])
    here = ((sizes[i] == most) == (gone[i] >= 0)) & ((sizes[j] == most) == (gone[j] >= 0))
    i, j = i[here], j[here]
    longest = int(sizes.max()) + 1 if len(words) else 1
    out = []
    step = max(1, (1 << 22) // longest)
    place = np.arange(longest)
    padded = np.append(letters, np.uint8(0))
    for at in range(0, len(i), step):
        a, b = i[at : at + step], j[at : at + step]
        la, lb = sizes[a][:, None], sizes[b][:, None]
        fore = lambda k, n: padded[np.where(place < n, ends[k][:, None] + place, -1)]
        back = lambda k, n: padded[np.where(place < n, ends[k + 1][:, None] - 1 - place, -1)]
        head = (fore(a, la) != fore(b, lb)).argmax(axis=1)
        tail = (back(a, la) != back(b, lb)).argmax(axis=1)
        good = head + tail >= np.maximum(la, lb)[:, 0] - 1
        # The letter they differ by must be the one that each lacks in this block.
        for k, n in ((a, la), (b, lb)):
            differs = padded[np.minimum(ends[k] + head, len(letters))] % CLASSES
            good &= (gone[k] < 0) | (differs == gone[k])
        out.append(np.flatnonzero(good) + at)
    found = np.concatenate(out) if out else np.zeros(0, np.int64)
    return i[found], j[found]


def _near(vocab: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words, and the best of them as (-n, word)."""
    blocks = _blocks(vocab)
    sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("g"), F.max(F.length("word")).alias("l"), F.max("gone").alias("longer")).filter("g > 1 AND longer >= 0")
    held = blocks.join(sizes.select("block", "g", "l"), "block")
    parts = F.greatest(F.ceil(F.col("g") / BLOCK), F.ceil(F.col("g") * F.col("l") / BLOCK_LETTERS)).cast("int")
    dealt = held.withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select("block", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "word", "gone", "n", "part")
    where = ["block", "lo", "hi"]
    rows = dealt.repartition(*where).sortWithinPartitions(*where, "word")

    def best(part: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        lo, hi, own = (part.column(c).to_numpy() for c in ("lo", "hi", "part"))
        words, n = part.column("word"), part.column("n").to_numpy()
        i, j = near_in(words.to_pylist(), group, part.column("gone").to_numpy(), np.where(lo == hi, np.arange(len(lo)), own))
        # Both ways; words of a group are in order, so the smaller place is the smaller word.
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
        order = np.lexsort((j, -n[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
        near = np.diff(np.append(first, len(i)))
        flat = words.combine_chunks()
        return pa.RecordBatch.from_arrays([flat.take(pa.array(i[first])), pa.array(near), pa.array(-n[j[first]]), flat.take(pa.array(j[first]))], names=["word", "near", "m", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            group = _groups(table, where)
            edges = np.flatnonzero(group[1:] != group[:-1]) + 1  # the last group may go on
            if not len(edges):
                continue
            yield from tiles(table, group, edges)
            held = table.slice(int(edges[-1])).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            group = _groups(table, where)
            yield from tiles(table, group, np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)))

    def tiles(table: pa.Table, group: np.ndarray, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole groups up to the last edge, as many at once as ``TILE`` words and ``BLOCK_LETTERS`` letters hold."""
        sizes = [len(w) for w in table.column("word").to_pylist()]
        letters = np.append(0, np.cumsum(sizes)).tolist()
        start = end = 0
        for edge in edges.tolist():
            if end > start and (edge - start > TILE or letters[edge] - letters[start] > BLOCK_LETTERS):
                yield best(table.slice(start, end - start).combine_chunks(), group[start:end])
                start = end
            end = edge
        yield best(table.slice(start, end - start).combine_chunks(), group[start:end])

    near = rows.mapInArrow(run, "word string, near long, m long, other string")
    return near.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("m", "other")).alias("best"))


def _groups(table: pa.Table, where: list[str]) -> np.ndarray:
    keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in where])
    return np.cumsum(np.append(False, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))


def variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each (word, n) of a vocabulary without repeated words."""
    near = _near(vocab)
    best_n = -F.col("best.m")
    has = best_n >= ratio * F.col("n")
    forms = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.other")).alias("form"), F.when(has, best_n).alias("form_n"),
    )
    forms = staged(forms, "spelling-forms")
    roots = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # twice as far in every round; a step multiplies n by the ratio, so a chain has few
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """The variants of all words of the documents."""
    return variants(staged(vocabulary(docs, text), "vocabulary"))
