"""Distinct word shingles of texts as 64-bit hashes, computed over whole Arrow batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a word that is longer is hashed whole.
WINDOW = 1 << 18


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (the public splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of data; a word ends at white space and at the edges."""
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    begins[inner] = word[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    values = _BYTE[data]
    values *= _powers(_BASE, len(data))
    values[~word] = 0
    sums = np.add.reduceat(values, starts)
    return mixed(sums * _powers(_INVERSE, len(data))[starts]), starts


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, first word of each text and the end) of a string column; NULL has none."""
    if pa.types.is_large_string(column.type):
        kind, column = np.int64, column
    else:
        kind = np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    hashes, places = [], []
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(end, at + WINDOW)
        while stop < end:  # not inside a word
            block = np.flatnonzero(_SPACE[data[stop : stop + 4096]])
            if len(block):
                stop += int(block[0])
                break
            stop = min(end, stop + 4096)
        low, high = np.searchsorted(offsets, [at, stop])
        h, s = _word_hashes(data[at:stop], offsets[low:high] - at)
        hashes.append(h)
        places.append(s + at)
        at = stop
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    starts = np.concatenate(places) if places else np.zeros(0, np.int64)
    return words, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; the whole sequence where it has fewer words."""
    words, first = word_hashes(column)
    n = len(words) - size + 1
    runs = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size):
        runs += words[k : k + len(runs)] * _PLACE[k]
    runs = mixed(runs)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            own = np.sort(runs[a : b - size + 1])
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
            yield own
        elif b > a:
            short = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) ^ _PLACE[40 + b - a]
            yield mixed(np.array([short], dtype=np.uint64))
        else:
            yield words[:0]
