"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablesync.llm import spelling

LETTERS = "ab" + "cq" + "éÿ×"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(vocab, ratio=5):
    near = {w: [o for o in vocab if one_edit(w, o)] for w in vocab}
    best = {w: min(os, key=lambda o: (-vocab[o], o)) for w, os in near.items() if os}
    form = {w: o for w, o in best.items() if vocab[o] >= ratio * vocab[w]}
    out = []
    for w in vocab:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, vocab[w], len(near[w]), vocab.get(form.get(w))))
    return sorted(out)


def plain_vocabulary(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def some_words(rng, n, low=1, high=9):
    words = set()
    while len(words) < n:
        word = "".join(rng.choice(LETTERS) for _ in range(rng.randrange(low, high)))
        words.add(word)
        k = rng.randrange(len(word))
        words.add(word[:k] + rng.choice(LETTERS) + word[k + rng.randrange(2) :])
    return {w: rng.choice((1, 2, 5, 10, 30, 170, 900)) for w in words}


@pytest.mark.parametrize("block, tile", [(1024, 512), (7, 16), (2, 1)])
def test_variants_are_brute_force(spark, monkeypatch, block, tile):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TILE", tile)
    vocab = some_words(random.Random(block), 260) | {"x" * 5000 + c: 7 for c in "abc"} | {"x" * 5000: 100, "x" * 4999: 900}
    frame = spark.createDataFrame(list(vocab.items()), "word string, n long")
    found = spelling.variants(frame)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[0]) == plain_variants(vocab)


def test_a_pair_is_found_in_one_block():
    """Every near pair has exactly one block, whatever the classes of its letters."""
    rng = random.Random(6)
    vocab = sorted(some_words(rng, 150, 2, 6))
    blocks = {}
    for w in vocab:
        kinds = [ord(c) % spelling.CLASSES for c in w]
        blocks.setdefault(tuple(sorted(kinds)), []).append((w, -1))
        for k in set(kinds):
            rest = list(kinds)
            rest.remove(k)
            blocks.setdefault(tuple(sorted(rest)), []).append((w, k))
    found = Counter()
    for rows in blocks.values():
        rows.sort()
        i, j = spelling.near_in([w for w, _ in rows], np.zeros(len(rows), int), np.array([g for _, g in rows]))
        found.update((rows[a][0], rows[b][0]) for a, b in zip(i.tolist(), j.tolist()))
    assert found == Counter((a, b) for a in vocab for b in vocab if a < b and one_edit(a, b))


def test_chains_lead_to_the_root(spark):
    vocab = {"a" * 6 + "b" * k: 2 * 5**k for k in range(20)}
    vocab |= {"zzzzzz": 5, "zzzzzy": 25, "zzzzzx": 25, "zzzzz": 24}
    frame = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert sorted((tuple(r) for r in spelling.variants(frame).collect()), key=lambda r: r[0]) == plain_variants(vocab)


def test_odd_rows(spark):
    rng = random.Random(8)
    words = ["Kitten", "kittens", "mitten", "smitten", "ÀÉÎÕÜß", "àÉÎÕÜß", "÷×÷×÷×", "naïveté", "ab", "q" * 70_000]
    docs = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(60)]
    docs += docs[:5] + [(None, "kitten " * 9), (None, None), (61, None), (62, ""), (63, "1234 -- ."), (64, "mittens;Mittens\x00mittens_mittens-MITTENS")]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, word string, n int")
    expected = plain_variants(plain_vocabulary(docs))
    assert any(r[1] for r in expected) and any(len(r[0]) == 70_000 for r in expected)
    assert sorted((tuple(r) for r in spelling.spelling_variants(frame).collect()), key=lambda r: r[0]) == expected
    assert spelling.spelling_variants(frame.limit(0)).collect() == []
