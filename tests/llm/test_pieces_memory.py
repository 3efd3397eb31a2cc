"""What a worker's lattice keeps: bounded in bytes, one entry for a word whatever stands beside it, and no matter for results."""

import random
import sys

import pytest

from tablesync.llm import pieces


def held(x) -> int:
    """Bytes of an object with all that it holds."""
    inner = [y for pair in x.items() for y in pair] if isinstance(x, dict) else x if isinstance(x, (list, tuple)) else []
    return sys.getsizeof(x) + sum(map(held, inner))


def letters(rng, n):
    return "".join(rng.choices("aeinorst", k=n))


def test_kept_entries_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 1 << 20)
    lattice, rng = pieces.Pieces(pieces.default_model()), random.Random(1)
    for n in (8, 30, 2000):
        for _ in range(24_000 // n):
            lattice.encode(" ".join(letters(rng, n) for _ in range(9)))
    assert 1 << 19 < held(lattice.kept) < 3 << 19


def test_a_word_is_kept_once_whatever_stands_behind_it():
    lattice = pieces.Pieces(pieces.default_model())
    lattice.encode("nation nation")
    before = len(lattice.kept)
    marks = [a + b for a in ",.;:!?" for b in "\n)]}%"]
    for mark in marks:
        assert lattice.decode(lattice.encode(f"nation nation{mark}nation")[0]) == f"nation nation{mark}nation"
    assert len(lattice.kept) - before <= 2 * len(marks)
    assert " nation" in lattice.kept and not any("nation" in key and key.strip() != "nation" for key in lattice.kept)


@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_results_do_not_depend_on_what_is_kept(monkeypatch, n):
    rng = random.Random(n)
    some = ["the ", "thand", " ", "  ", "--", "é", ".\n", "nation, ", "▁", "a.a", "木", "вода ", "\0", "🙂 "]
    texts = ["".join(rng.choices(some, k=rng.randrange(1, 60))) for _ in range(150)]
    usual = pieces.Pieces(pieces.default_model(), n)
    found = [usual.segmentations(text) for text in texts * 2]
    monkeypatch.setattr(pieces, "KEPT", 0)
    monkeypatch.setattr(pieces, "KEPT_ELSE", 0, raising=False)
    none = pieces.Pieces(pieces.default_model(), n)
    assert found == [none.segmentations(text) for text in texts * 2]
    assert len(none.kept) <= 1 and found[:150] == found[150:]
