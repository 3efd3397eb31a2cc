"""Benchmark excerpts are found whatever the item's length."""

import random

import pytest

from tablesync.llm import decontaminate


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.mark.parametrize("length", [*range(59, 64), 80, 100, 118, 119, 120, 121, 122, 140, 179, 180, 181, 200, 240])
def test_excerpts_at_every_offset(length):
    rng = random.Random(length)
    item = words(rng, 60)[:length].strip()
    item += "q" * (length - len(item))
    index = decontaminate.Index([("i", item)])
    size = decontaminate.Search().surely
    before, behind = words(rng, 30) + " #", "# " + words(rng, 30)
    for n in {size, min(100, length)}:
        for at in range(0, length - n + 1):
            excerpt = item[at : at + n]
            (row,) = index.search([before + excerpt + behind])
            # An excerpt a little shorter than a longer segment is that segment with edits.
            assert row[4] <= (0 if n == length else 9) and len(before) - 19 <= row[2] <= len(before) + 1
            assert -1 <= row[3] - len(before) - n <= 19
    assert not list(index.search([before + behind, words(rng, 400)]))


def test_segments_reach_over_every_length():
    how = decontaminate.Search()
    for size in range(1, 400):
        cuts = how.segments(size)
        assert all(at >= 0 and at + n <= size for at, n in cuts) and len(set(cuts)) == len(cuts)
        for at in range(0, size - how.surely + 1):
            assert any(at <= a and a + n <= at + how.surely for a, n in cuts)
