"""SimHash components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from tablesync.llm import simhash
from tablesync.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """(doc_id, fingerprint) to component names; rows without doc_id link nothing."""
    docs = [(d, f) for d, f in prints if d is not None]
    name = {f: f for _, f in docs}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    kinds = list(name)
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                name[x] = y
    least = {}
    for d, f in docs:
        root = find(f)
        least[root] = min(d, least.get(root, d))
    return {f: least[find(f)] for f in kinds}


def plain_rows(docs):
    prints = [(d, plain_fingerprint(t)) for d, t in docs]
    names = plain_components(prints)
    return sorted(((d, f"{f:016x}", names.get(f)) for d, f in prints), key=repr)


def test_query_is_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_simhash_near_dedup"](spark, DIR)
    assert found.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_rows(docs)


def near(rng, n, kinds=6, most=5):
    base, out = [rng.getrandbits(64) for _ in range(kinds)], set()
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randrange(most)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return out


@pytest.mark.parametrize("shard", [2, 7, 40, 4096])
def test_shards_lose_no_link(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng = random.Random(shard)
    prints = sorted(near(rng, 300) | {0, 1, 3, 2**64 - 1, 2**64 - 2, 2**63, 2**63 + 2**62, rng.getrandbits(64)})
    signed = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "fp long, id long")
    links = [(r.a, r.b) for r in simhash._links(simhash._shards(nodes, 2), 2).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 2 for a, b in links)
    name = list(range(len(prints)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        name[max(x, y)] = min(x, y)
    wanted = plain_components(list(enumerate(prints)))
    assert {f: find(i) for i, f in enumerate(prints)} == wanted
    assert len(links) < 12 * len(prints)


def test_trees_find_what_brute_force_finds():
    rng = np.random.default_rng(2)
    for _ in range(20):
        prints = np.array(sorted(near(random.Random(int(rng.integers(1 << 30))), 150)), dtype=np.uint64)
        rng.shuffle(prints)
        root = np.zeros(len(prints), dtype=np.int64)
        marks, nodes = simhash.plant(root, prints)
        assert sorted(nodes.tolist()) == list(range(1, len(prints)))
        parent = dict(zip(nodes.tolist(), (marks // 65).tolist()))
        assert all(int(prints[c] ^ prints[p]).bit_count() == m % 65 for (c, p), m in zip(parent.items(), marks.tolist()))
        query = np.arange(len(prints))
        for radius in (0, 1, 2, 5):
            q, v = simhash.walk(marks, nodes, prints, query, root, radius)
            apart = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
            assert sorted(zip(q.tolist(), v.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(apart))))


def test_odd_rows(spark):
    words = [f"w{i}" for i in range(60)]
    text = " ".join(words)
    docs = [
        (5, text), (3, text.upper()), (9, text.replace(" ", "\n\t ")), (7, text + " more"), (4, None), (2, ""), (8, " \n"), (1, "one"),
        (11, "One"), (12, "one two"), (13, "x" * 300_000), (14, "ab " * 100_000), (14, "ab " * 100_000), (None, "alone here now"), (None, text), (None, None),
    ]
    frame = spark.createDataFrame([(d, t, "a", "b") for d, t in docs], "doc_id long, text string, fp string, component_id string")
    found = simhash.near_copies(frame)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    rows = sorted((tuple(r) for r in found.collect()), key=repr)
    assert rows == plain_rows(docs)
    by_id = {d: c for d, _, c in rows if d is not None}
    assert by_id[5] == by_id[9] == 3 and by_id[4] == by_id[8] == 2 and by_id[11] == 1
    assert simhash.near_copies(frame.limit(0)).collect() == []


def test_half_the_hashes_is_no_bit():
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in (b"a b c", b"b c d")]
    assert simhash.fingerprint(b"A b c d") == hashes[0] & hashes[1]
