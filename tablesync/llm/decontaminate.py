"""Benchmark passages in documents, with edits, by the q-gram lemma and banded alignment.

Texts are compared in lower case with each run of white space as one space. A benchmark item is cut into
overlapping segments: one of no more than ``short`` characters is searched whole, a longer one in segments of
``segment`` characters (whole, if it has no more) and in short ones, so that a verbatim excerpt of ``Search.surely``
characters (59) is found wherever it starts, whatever the item's length. A segment of m characters found with at most k edits
shares at least m + 1 - q - kq of its q-grams with the text, on diagonals that differ by at most 2k. Shared
q-grams are counted in overlapping bands of diagonals, the bands that reach the bound are kept, and an
alignment within each band decides. What is found is drawn out as far as text and item go on alike, and joined along
the diagonal; the longest passage is reported, with its edits if the item is whole, else with the least edits of a segment in it. The benchmark is the stated query set: it is taken in blocks of
``block_chars`` characters, each matched with all documents in one pass without a shuffle.

Defined results: NULL and empty texts hold nothing, nor do items that are NULL or shorter than q characters once
white space is folded; budgets of short segments are lowered until the bound is at least one q-gram; repeated
documents are each reported; empty tables give empty results; a text is searched whole, whatever its length, in
windows that overlap. Other columns pass through ``clean_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import named


@dataclass(frozen=True)
class Search:
    """q-gram length, edits allowed per character, segment length and stride, length and stride of the short segments,
    characters of benchmark in a block."""

    q: int = 8
    edits: float = 0.08
    segment: int = 120
    stride: int = 60
    short: int = 50
    short_stride: int = 10
    block_chars: int = 1_000_000

    @property
    def surely(self) -> int:
        """Characters of the least verbatim excerpt that is found at any offset, in an item of any length beyond it."""
        return self.short + self.short_stride - 1

    def segments(self, size: int) -> list[tuple[int, int]]:
        """(start, length) of the segments of an item of so many characters."""
        if size <= self.short:
            return [(0, size)]
        out = {}
        for length, stride in ((min(self.segment, size), self.stride), (min(self.short, self.segment), self.short_stride)):
            out |= dict.fromkeys((at, length) for at in [*range(0, size - length, stride), size - length])
        return list(out)


_BASE = 0x9E3779B97F4A7C15 | 1
_BITS = 22
#: Code points hashed at once.
WINDOW = 1 << 20
#: Code points of documents joined for one pass.
JOINED = 1 << 21
#: Alignments made at once.
ALIGNED = 2048
_SPACES = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029, 0x3000], dtype=np.uint32)


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with white space folded, and the place of each in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(d := c.lower()) != 1 else d for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = (codes <= 32) & (codes >= 9) & ((codes <= 13) | (codes == 32))
    if len(codes) and codes.max() >= 0x85:
        space |= np.isin(codes, _SPACES[6:])
    keep = ~space
    keep[1:] |= ~space[:-1]
    places = np.flatnonzero(keep)
    return np.where(space, np.uint32(32), codes)[places], places


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of each run of q code points."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    out, done, power = None, 0, 1
    h, size = codes.astype(np.uint64) + np.uint64(0x51ED270B), 1
    weight = _BASE
    while size <= q:  # powers of two of the run length, joined by the bits of q
        if q & size:
            if out is None:
                out, done, power = h, size, weight
            else:
                n = len(codes) - done - size + 1
                out = out[:n] + h[done : done + n] * np.uint64(power)
                done, power = done + size, power * weight % (1 << 64)
        n = len(h) - size
        if n <= 0:
            break
        h = h[:n] + h[size:] * np.uint64(weight)
        weight, size = weight * weight % (1 << 64), size * 2
    return out


class Index:
    """q-grams of the segments of one block of benchmark items."""

    def __init__(self, items: list[tuple[object, str]], how: Search = Search()):
        self.q, self.items, self.how = how.q, [i for i, _ in items], how
        self.texts = [folded(text.strip())[0] for _, text in items]
        cuts = [[c for c in how.segments(len(own)) if c[1] >= how.q] for own in self.texts]
        self.owner = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
        self.start, self.length = np.array([x for c in cuts for x in c], dtype=np.int64).reshape(-1, 2).T
        self.codes = [self.texts[i][at : at + n] for i, c in enumerate(cuts) for at, n in c]
        self.budget = np.minimum((how.edits * self.length).astype(np.int64), np.maximum(0, self.length - how.q) // how.q)
        self.least = self.length + 1 - how.q - self.budget * how.q
        # Of each item the loosest of its segments.
        self.item_width, self.item_least = np.ones(len(items), np.int64), np.full(len(items), np.iinfo(np.int64).max)
        np.maximum.at(self.item_width, self.owner, 2 * self.budget + 1)
        np.minimum.at(self.item_least, self.owner, self.least)
        hashes = [gram_hashes(own, how.q) for own in self.texts]
        sizes = np.array([len(h) for h in hashes], dtype=np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), sizes)
        self.before = np.cumsum(sizes) - sizes  # q-grams of the items before
        place = np.arange(len(flat)) - self.before[owner] if len(flat) else np.zeros(0, np.int64)
        # The segments that hold a q-gram, by its number.
        held = np.maximum(0, self.length - how.q + 1)
        gram = np.repeat(self.before[self.owner] + self.start, held) + np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        self.covers = np.repeat(np.arange(len(held)), held)[np.argsort(gram, kind="stable")].astype(np.int32)
        self.covered = np.bincount(gram, minlength=len(flat))
        self.cover = np.cumsum(self.covered) - self.covered
        order = np.argsort(flat, kind="stable")
        self.item, self.place = owner[order], place[order]
        self.hashes, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(flat)))
        self.table = np.zeros(1 << _BITS, dtype=bool)
        self.table[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _BITS)).astype(np.int64)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in codes, item, place in item) of every shared q-gram."""
        found = []
        for at in range(0, max(1, len(codes) - self.q + 1), WINDOW):
            h = gram_hashes(codes[at : at + WINDOW + self.q - 1], self.q)
            i = np.flatnonzero(self.table[self._slot(h)])
            j = np.searchsorted(self.hashes, h[i])
            j[j == len(self.hashes)] = 0
            same = self.hashes[j] == h[i] if len(self.hashes) else np.zeros(0, bool)
            i, j = i[same], j[same]
            n = self.count[j]
            entry = np.repeat(self.first[j] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append((np.repeat(i + at, n), self.item[entry], self.place[entry]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def search(self, texts: list[str], once: bool = False) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) for every item found in each text, or with ``once`` for one item of each
        text with any; start and end in code points."""
        group, size = [], 0
        for number, text in enumerate(texts):
            group.append((number, text))
            size += len(text)
            if size >= JOINED:
                yield from self._search(group, once)
                group, size = [], 0
        if group:
            yield from self._search(group, once)

    def _dense(self, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Which shared q-grams lie in two neighbouring bands of an item with as many as any of its segments needs."""
        order = np.lexsort((band := diagonal // self.item_width[item], item, text))
        key = np.stack([text, item, band])[:, order]
        edge = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        counts = np.diff(np.append(edge, key.shape[1]))
        both, follows = _with_next(key[:, edge], counts)
        good = both >= self.item_least[key[1, edge]]
        good[1:] |= good[:-1] & follows[:-1]
        return np.sort(order[np.repeat(good, counts)])

    def _search(self, group: list[tuple[int, str]], once: bool) -> Iterator[tuple[int, int, int, int, int]]:
        parts = [folded(text) for _, text in group]
        gap = np.zeros(self.q, dtype=np.uint32)  # no q-gram of the benchmark spans two texts
        starts = np.cumsum([0] + [len(c) + self.q for c, _ in parts])
        blob = np.concatenate([x for c, _ in parts for x in (c, gap)])
        place, item, at = self.hits(blob)
        if not len(place):
            return
        text = np.searchsorted(starts, place, side="right") - 1
        dense = self._dense(text, item, place - starts[text] - at + len(blob))
        place, item, at, text = place[dense], item[dense], at[dense], text[dense]
        gram = self.before[item] + at
        n = self.covered[gram]
        segment = self.covers[np.repeat(self.cover[gram] - np.cumsum(n) + n, n) + np.arange(n.sum())].astype(np.int64)
        place, at, text = np.repeat(place, n), np.repeat(at, n) - self.start[segment], np.repeat(text, n)
        if not len(place):
            return
        width = 2 * self.budget[segment] + 1
        diagonal = place - starts[text] - at + self.length[segment]  # positive
        # A q-gram of the segment counts once in a band, however often the text repeats it there.
        key = np.stack([text, segment, diagonal // width, at])
        key = key[:, np.lexsort(key[::-1])]
        key = key[:3, np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))]
        edge = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        counts = np.diff(np.append(edge, key.shape[1]))
        key = key[:, edge]
        both, _ = _with_next(key, counts)
        matches: dict[tuple[int, int], list[tuple[int, int, int, int, tuple[bool, int]]]] = {}

        def add(t: int, s: int, start: int, end: int, edits: int) -> None:
            whole, codes, first, last = self.texts[self.owner[s]], parts[t][0], int(self.start[s]), int(self.start[s] + self.length[s])
            back, on = alike(whole[:first][::-1], codes[:start][::-1]), alike(whole[last:], codes[end:])
            matches.setdefault((t, int(self.owner[s])), []).append((start - back, end + on, first - back, last + on, (last - first < len(whole), edits)))

        hit: set[int] = set()
        edited: dict[int, list[tuple[int, int, int]]] = {}  # by segment length, as the budget goes with it
        for i in np.flatnonzero(both >= self.least[key[1]]):
            t, s, band = (int(x) for x in key[:, i])
            if once and t in hit:
                continue
            k, m, first = int(self.budget[s]), int(self.length[s]), int(self.start[s])
            low = band * (2 * k + 1) - m - k
            high = low + 2 * (2 * k + 1) + 2 * k
            # What lies in a passage already found without an edit is found.
            own = matches.get((t, int(self.owner[s])), ())
            if any(x[2] <= first and first + m <= x[3] and low <= x[0] - x[2] + first <= high for x in own):
                continue
            found = exact(self.codes[s], parts[t][0], low, high)
            if found is None:
                edited.setdefault(m, []).append((t, s, low))
            else:
                hit.add(t)
                add(t, s, *found)
        for m, own in edited.items():
            own = [x for x in own if x[0] not in hit] if once else own
            for at in range(0, len(own), ALIGNED):
                some = own[at : at + ALIGNED]
                k = int(self.budget[some[0][1]])
                found = banded(np.stack([self.codes[s] for _, s, _ in some]), [parts[t][0] for t, _, _ in some], np.array([low for *_, low in some]), 6 * k + 3, k)
                for (t, s, _), best in zip(some, found):
                    if best:
                        add(t, s, *best)
        for (t, item), own in sorted(matches.items()):
            places = parts[t][1]
            start, end, edits = self._longest(own)
            yield group[t][0], item, int(places[start]), int(places[end - 1]) + 1, edits

    def _longest(self, matches: list[tuple[int, int, int, int, tuple[bool, int]]]) -> tuple[int, int, int]:
        """(start, end, edits) of the longest passage, the first of several, of (start, end, start and end in the item,
        (False for the whole item, edits)): matches that follow one another in text and item, at most a short segment apart, are one passage."""
        passages: list[list] = []
        slack = 2 * int(self.how.edits * self.how.segment)
        for start, end, first, last, edits in sorted(matches):
            for own in passages[:-9:-1]:
                on = start - own[1], first - own[3]
                if max(on) <= self.how.short and first >= own[2] and abs(on[0] - on[1]) <= slack:
                    own[1], own[3], own[4] = max(own[1], end), max(own[3], last), min(own[4], edits)
                    break
            else:
                passages.append([start, end, first, last, edits])
        start, end, _, _, (_, edits) = max(passages, key=lambda p: (p[1] - p[0], -p[0]))
        return start, end, edits


def _with_next(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts of sorted bands (.., .., band) with those of the next band, and where it follows: a match lies in two
    neighbouring bands at most."""
    both, follows = counts.copy(), np.zeros(len(counts), bool)
    if len(counts) > 1:
        follows[:-1] = (key[:2, 1:] == key[:2, :-1]).all(axis=0) & (key[2, 1:] == key[2, :-1] + 1)
        both[:-1] += np.where(follows[:-1], counts[1:], 0)
    return both, follows


def alike(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def exact(segment: np.ndarray, codes: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
    """(start, end, 0) of the first unchanged copy of the segment that starts on the diagonals low..high."""
    start = max(0, low)
    region, wanted, at = codes[start : max(0, high + len(segment))].tobytes(), segment.tobytes(), 0
    while (at := region.find(wanted, at)) >= 0:
        if at % 4 == 0:
            return start + at // 4, start + at // 4 + len(segment), 0
        at += 1
    return None


def banded(segments: np.ndarray, texts: list[np.ndarray], low: np.ndarray, diagonals: int, k: int) -> list[tuple[int, int, int] | None]:
    """(start, end, edits) of the best place of each segment in its text on so many diagonals from its lowest, if within k edits.

    Row by row over segments of one length; a cell on diagonal d of row i stands before text[i + d]. Ends are free.
    """
    m, far = segments.shape[1], segments.shape[1] + k + 1
    places = low[:, None] + np.arange(m + diagonals)
    valid = (places >= 0) & (places <= np.array([len(t) for t in texts])[:, None])
    chars = np.full(places.shape, 0xFFFFFFFF, np.uint32)
    for own, text, at in zip(chars, texts, low):
        own[max(0, -at) : max(0, len(text) - at)] = text[max(0, at) : max(0, at + len(own))]
    steps = np.arange(diagonals)
    row = np.where(valid[:, :diagonals], 0, far)
    start = places[:, :diagonals].copy()
    for i in range(1, m + 1):
        inside = valid[:, i : i + diagonals]
        new = row + (chars[:, i - 1 : i - 1 + diagonals] != segments[:, i - 1 : i])
        origin = start.copy()
        better = row[:, 1:] + 1 < new[:, :-1]  # a character of the segment left out
        new[:, :-1] = np.where(better, row[:, 1:] + 1, new[:, :-1])
        origin[:, :-1] = np.where(better, start[:, 1:], origin[:, :-1])
        new[~inside] = far
        run = new - steps  # characters of the text left out, one after another
        least = np.minimum.accumulate(run, axis=1)
        source = np.maximum.accumulate(np.where(run == least, steps, 0), axis=1)
        row, start = np.minimum(least + steps, far), np.take_along_axis(origin, source, axis=1)
        row[~inside] = far
    best = row.argmin(axis=1)
    return [(int(start[b, i]), int(low[b] + i) + m, int(row[b, i])) if row[b, i] <= k else None for b, i in enumerate(best)]


def blocks(benchmark: DataFrame, item: str, text: str, how: Search) -> Iterator[Index]:
    """The query set in indexes of bounded size."""
    rows, size = [], 0
    for number, body in benchmark.select(named(benchmark, item), named(benchmark, text)).toLocalIterator():
        if body is None:
            continue
        rows.append((number, body))
        size += len(body)
        if size >= how.block_chars:
            yield Index(rows, how)
            rows, size = [], 0
    if rows:
        yield Index(rows, how)


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", how: Search = Search()) -> DataFrame:
    """One row (doc_id, item_id, start, end, edits) for each document and item found in it."""
    pairs = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, text).alias("text"))
    kinds = (pairs.schema["doc_id"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString())
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start long, end long, edits long"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in blocks(benchmark, item, "text", how):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found = list(index.search([t or "" for t in batch.column(1).to_pylist()]))
                rows, items, starts, ends, edits = zip(*found) if found else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array([index.items[i] for i in items], types[1]),
                        *(pa.array(x, pa.int64()) for x in (starts, ends, edits)),
                    ],
                    names=["doc_id", "item_id", "start", "end", "edits"],
                )

        from pyspark.sql.pandas.types import to_arrow_schema

        types = [f.type for f in to_arrow_schema(out.schema)]
        out = out.unionByName(pairs.mapInArrow(find, schema))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", how: Search = Search()) -> DataFrame:
    """The documents in which no item is found, with their own columns."""
    at, names = docs.columns.index(text), docs.columns
    docs = docs.toDF(*(f"c{i}" for i in range(len(names))))
    for index in blocks(benchmark, item, "text", how):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[row for row, *_ in shared.value.search([t or "" for t in batch.column(at).to_pylist()], once=True)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs.toDF(*names)
