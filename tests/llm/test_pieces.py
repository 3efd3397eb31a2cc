"""N-best segmentation against a plain dynamic programme, on runs of equal characters above all."""

import heapq
import random
import time
import zlib

import numpy as np
import pytest

from tablesync.llm import pieces
from tablesync.llm.queries import QUERIES


@pytest.fixture(scope="module")
def lattice():
    return pieces.Pieces(pieces.default_model())


def n_best_scores(lattice, chunk, n):
    """Scores of the n best segmentations, kept for each place; no heuristic and no search."""
    best = [[0.0]] + [[] for _ in chunk]
    longest = max(map(len, lattice.pieces))
    for j in range(1, len(chunk) + 1):
        ways = []
        for i in range(max(0, j - longest), j):
            found = lattice.pieces.get(chunk[i:j])
            score = found[1] if found else lattice.unknown if i == j - 1 else None
            if score is not None:
                ways += [s + score for s in best[i]]
        best[j] = heapq.nlargest(n, ways)
    return best[-1]


@pytest.mark.parametrize("char", [" ", "-", ".", "=", "a", "é", "木"])
@pytest.mark.parametrize("length", [1, 2, 180, 400, 2000])
def test_runs_of_one_character(lattice, char, length):
    chunk = (char * length).replace(" ", pieces.SPACE)
    start = time.perf_counter()
    found = lattice.search(chunk, 3)
    assert time.perf_counter() - start < 1
    assert [s for s, _ in found] == n_best_scores(lattice, chunk, 3)
    assert len({ids for _, ids in found}) == len(found)
    text = char * length
    ids, scores = lattice.encode(text)
    assert lattice.decode(ids) == text and scores[0] == max(scores)


def test_time_grows_in_proportion(lattice):
    def took(length):
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            lattice.search(pieces.SPACE * length, 3)
            best = min(best, time.perf_counter() - start)
        return best

    assert took(20_000) < 30 * took(2000)  # in proportion it is 10 times


def test_ties_and_odd_chunks(lattice):
    rng = random.Random(3)
    for _ in range(600):
        chunk = "".join(rng.choice("ab-.te n\té木🙂") for _ in range(rng.choice((1, 2, 5, 9, 30, 90)))).replace(" ", pieces.SPACE)
        for n in (1, 2, 3, 7):
            found = lattice.search(chunk, n)
            assert [s for s, _ in found] == n_best_scores(lattice, chunk, n)
            assert len({ids for _, ids in found}) == len(found)


def test_best_of_whole_texts(lattice):
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice(["the ", "thand", " ", "  ", "--", "é", ".", "nation ", "▁"]) for _ in range(rng.randrange(1, 40)))
        chunk = pieces.SPACE + text.replace("▁", "\x00").replace(" ", pieces.SPACE)
        wanted = n_best_scores(lattice, chunk, 3) if "▁" not in text else None
        found = lattice.segmentations(text)
        if wanted:
            assert [s for s, _ in found] == wanted
        assert len({tuple(ids) for _, ids in found}) == len(found)


def test_the_query_returns_every_segmentation(spark, lattice, tmp_path):
    texts = ["the nations", "", None, "a" * 400, "thand\n-- é▁ 木 " * 30, "x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op8_sentencepiece"](spark, str(tmp_path)).collect()}
    plain = {r.doc_id: r for r in pieces.encode(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()}
    for k, text in enumerate(texts):
        row, wanted = rows[k], lattice.segmentations(text)
        assert [list(x) for x in row.segmentations] == [ids for _, ids in wanted] and list(row.scores) == [s for s, _ in wanted]
        packed = [np.array(x, "<u4").tobytes() for x in row.segmentations]
        assert zlib.crc32(packed[0]) == row.ids_crc32 and len(packed[0]) == 4 * row.n_tokens
        assert all(lattice.decode(x) == (text or "") for x in packed) and len(set(packed)) == len(packed)
        assert list(plain[k].ids) == list(row.segmentations[0]) and plain[k].scores == row.scores
    assert len(rows[0].segmentations) == 3
