"""Checksum trees and reconciliation by cells against plain multisets."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablesync.operators import drilldown, iblt

SCHEMA = "k bigint, day timestamp_ntz, v string, x double"


def some_rows(rng, n=400):
    start = datetime(2023, 12, 20)
    return [
        (None if rng.random() < 0.02 else rng.randrange(-50, 500), None if rng.random() < 0.03 else start + timedelta(hours=rng.randrange(1500)), rng.choice("abc"), rng.choice((0.5, None)))
        for _ in range(n)
    ]


def changed(rng, rows, most):
    rows = list(rows)
    for _ in range(rng.randrange(most)):
        i = rng.randrange(len(rows))
        kind = rng.randrange(4)
        if kind == 0:
            rows.pop(i)
        elif kind == 1:
            rows.append(rows[i])
        elif kind == 2:
            rows[i] = (*rows[i][:2], rows[i][2] + "!", rows[i][3])
        else:
            rows[i] = (rows[i][0], rows[i][1] and rows[i][1] + timedelta(days=40), *rows[i][2:])
    return rows


def leaf(row, width):
    k, day = row[:2]
    return (*((day.year, day.month, day.day) if day else (None,) * 3), None if k is None else k // width)


@pytest.mark.parametrize("seed", range(3))
def test_leaves_are_where_multisets_differ(spark, seed):
    rng = random.Random(seed)
    left = some_rows(rng)
    right = changed(rng, left, 25)
    source, target = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).select("x", "v", "day", "k", F.lit(1).alias("own"))
    tree = drilldown.checksum_tree(source, target, "day", "k", 100).cache()
    found = sorted((tuple(r) for r in drilldown.differing_leaves(tree).collect()), key=repr)
    a, b = Counter(left), Counter(right)
    wrong = {leaf(r, 100) for r in (a - b) + (b - a)}
    n = [Counter(leaf(r, 100) for r in side) for side in (left, right)]
    assert found == sorted(((*x, n[0][x], n[1][x]) for x in wrong), key=repr)
    leaves = drilldown.differing_leaves(tree)
    read = drilldown.rows_in_leaves(source, leaves, "day", "k", 100)
    assert Counter(tuple(r) for r in read.collect()) == Counter(r for r in left if leaf(r, 100) in wrong)
    for r in tree.where("level < 4 AND differs").collect():
        place = [r.year, r.month, r.day][: r.level]
        assert any(list(x[: len(place)]) == place for x in wrong)
    tree.unpersist()


def test_equal_and_empty_tables(spark):
    rows = spark.createDataFrame(some_rows(random.Random(9)), SCHEMA)
    tree = drilldown.checksum_tree(rows, rows.orderBy("v"), "day", "k", 10)
    assert drilldown.differing_leaves(tree).collect() == [] and tree.where("differs").count() == 0
    nothing = drilldown.checksum_tree(rows.limit(0), rows.limit(0), "day", "k", 10)
    assert drilldown.differing_leaves(nothing).collect() == []
    assert drilldown.differing_leaves(drilldown.checksum_tree(rows, rows.limit(0), "day", "k", 10)).count() > 10
    assert iblt.differing_keys(rows, rows, ["k"]).collect() == [] and iblt.differing_keys(rows.limit(0), rows.limit(0), ["k"]).collect() == []


def test_driver_hashes_like_spark(spark):
    values = [0, 1, -1, 42, (1 << 63) - 1, -(1 << 63)]
    frame = spark.createDataFrame([(v,) for v in values], "h bigint")
    for salt in (0, 1, 3):
        assert [r[0] for r in frame.select(iblt._hash(F.col("h"), salt)).collect()] == [iblt._plain_hash(v, salt) for v in values]
    parts = frame.select(F.array(*[F.pmod(iblt._hash(F.col("h"), p + 1), F.lit(97)) + p * 97 for p in range(3)])).collect()
    assert [r[0] for r in parts] == [[iblt._cell(v, p, 97) for p in range(3)] for v in values]


@pytest.mark.parametrize("cells, told", [(1 << 10, True), (8, False), (1, False)])
def test_cells_list_what_multisets_list(spark, cells, told):
    rng = random.Random(cells)
    left = some_rows(rng, 600)
    right = changed(rng, left, 60)
    left = left + [left[0]] * 3  # copies
    source, target = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    a, b = Counter(left), Counter(right)
    assert sum(((a - b) + (b - a)).values()) > 8
    hashes, whole = iblt.differing_hashes(source, target, cells)
    assert whole == told
    assert sorted(r.n for r in hashes.collect()) == sorted([*(a - b).values(), *(-n for n in (b - a).values())])
    found = {tuple(r) for r in iblt.differing_keys(source, target, ["k"], cells).collect()}
    assert found == {(r[0], "source") for r in a - b} | {(r[0], "target") for r in b - a}


def test_a_cell_that_only_looks_pure_is_left():
    cells = 64
    values = [5, -9, 1 << 40]
    rows = {}
    for v in values:
        for part in range(iblt.TABLES):
            held = rows.setdefault(iblt._cell(v, part, cells), [0, 0, 0])
            held[0], held[1], held[2] = held[0] + 1, held[1] + v, held[2] + iblt._plain_hash(v, 0)
    packed = [(c, *v) for c, v in rows.items()]
    assert iblt.peel(packed, cells) == ({v: 1 for v in values}, True)
    broken = [(c, n, t + 1, k) for c, n, t, k in packed]
    assert iblt.peel(broken, cells) == ({}, False)
