"""Collocations against brute force in exact integers, and the tries against plain counters."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablesync.llm import collocations
from tablesync.llm.collocations import HatTrie


def plain(docs, most=5, least=100, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= least}
        around = [p for p in often if len(p) > 1]
        rows = []
        for p in around:
            a, n = often[p], totals[lang]
            if any(len(o) > len(p) and often[o] >= a and any(o[i : i + len(p)] == p for i in range(len(o))) for o in around):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        rows.sort()
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r, n) in enumerate(rows[:top], 1)]
    return sorted(out)


def some_docs(rng, n=250):
    words = ["New", "york", "city", "Hall", "of", "the", "a", "é", "x-y", "100%", "\x00", "naïve", "▁"]
    fixed = ["new york city hall", "of the", "the A of the", "é é é é", "x-y 100%"]
    docs = []
    for _ in range(n):
        parts = [rng.choice(words) if rng.random() < 0.6 else rng.choice(fixed) for _ in range(rng.randrange(40))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"]) for p in parts)
        docs.append((rng.choice(["en", "en", "en", "fr", None]), text))
    return docs


@pytest.mark.parametrize("held, known, burst, bits", [(600_000, 600_000, 4096, (20, 28)), (50, 600_000, 3, (20, 28)), (20, 12, 1, (7, 7))])
def test_brute_force(spark, monkeypatch, held, known, burst, bits):
    for name, value in {"HELD": held, "KNOWN": known, "BURST": burst, "BLOOM_BITS": bits, "BATCH": 20, "READ": held // 2, "RUN": 30}.items():
        monkeypatch.setattr(collocations, name, value)
    docs = some_docs(random.Random(burst))
    docs += docs[:20] + [("en", None), (None, None), ("en", ""), ("fr", " \t.\n"), ("de", "of the " * 5000), ("de", "y" * 100_000)]
    frame = spark.createDataFrame([(i, t, g, "p") for i, (g, t) in enumerate(docs)], "a long, text string, lang string, phrase string").repartition(5)
    found = collocations.collocations(frame, min_count=12, top=9)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == plain(docs, least=12, top=9)


def test_default_limits_and_longest_phrases(spark):
    docs = [("en", "one two three four five six.") for _ in range(120)] + [("en", "five six seven one two") for _ in range(99)]
    frame = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(frame).collect()) == plain(docs)
    assert collocations.collocations(frame.limit(0)).collect() == []


def test_products_beyond_64_bits():
    """The score expression holds 38 digits."""
    a, n, l, r = 10**13, 10**15, 3 * 10**13, 7 * 10**13
    assert 1000 * a * n > 2**64 and 1000 * a * n < 10**38 and l * r < 10**38


@pytest.mark.parametrize("burst", [1, 2, 16, 1000])
def test_tries_count_like_counters(burst):
    rng = random.Random(burst)
    trie, wanted, spilled = HatTrie(burst), Counter(), Counter()
    for _ in range(40):
        keys = [np.array([rng.randrange(1, 9) for _ in range(rng.randrange(1, 6))], dtype=">u4").tobytes() for _ in range(60)]
        counts = [rng.randrange(1, 5) for _ in keys]
        for k, n in zip(keys, counts):
            wanted[k] += n
        trie.add(keys, counts)
        assert trie.size == sum(trie.weight(c) for c in trie.root.values())
        if rng.random() < 0.3:
            target = rng.randrange(trie.size + 1)
            for run in trie.spill(target):
                assert len({k[:4] for k in run[0]}) == 1  # a whole subtree
                for k, n in zip(*run):
                    spilled[k] += n
            assert trie.size <= target
    for run in trie.spill(0):
        for k, n in zip(*run):
            spilled[k] += n
    assert spilled == wanted and trie.size == 0 and not trie.root


def test_filter_keeps_all_members():
    rng = np.random.default_rng(1)
    own = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    table = np.zeros(1 << 6, dtype=np.uint64)
    for h in own.tolist():
        table[h % 4096 >> 6] |= np.uint64(1 << (h & 63))
    assert collocations.Bloom(table).has(own).all()
