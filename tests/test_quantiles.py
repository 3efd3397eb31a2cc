"""Split bounds with even row counts."""

import sqlite3
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablesync.operators.quantiles import RANK_ERROR, Bounds, bounds_of, even_bounds, quantile_sketch, split_sizes, whole_number


def test_even_parts_of_a_key_with_gaps(spark):
    rows = spark.range(200_000).select((F.col("id") * F.col("id") % 999_983 * F.col("id")).alias("k"))
    bounds = even_bounds(rows, "k", 20)
    sizes = {r.part_id: r for r in split_sizes(rows, bounds).collect()}
    assert sum(r.n for r in sizes.values()) == 200_000 and len(sizes) == 20
    assert max(r.n for r in sizes.values()) <= 1.1 * 10_000
    keys = sorted(r.k for r in rows.collect())
    for i, b in enumerate(bounds.inner, 1):
        below = sum(k < b for k in keys)
        assert abs(below / len(keys) - i / 20) <= 2 * RANK_ERROR
    for p, r in sizes.items():
        assert p == 0 or r.lo >= bounds.inner[p - 1]
        assert p == 19 or r.hi < bounds.inner[p]


def test_a_key_that_fills_several_parts_is_one(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    bounds = even_bounds(rows, "k", 12)
    sizes = [r.n for r in split_sizes(rows, bounds).collect()]
    assert bounds.parts < 12 and sum(sizes) == 30_000 and sorted(sizes)[-1] >= 10_000 and sorted(sizes)[-2] <= 1.15 * 2500


def test_sketches_of_portions_merge(spark):
    rows = spark.range(50_000).select((F.col("id") * 3).alias("k"))
    parts = [quantile_sketch(rows.where(F.col("k") % 4 == i), "k") for i in range(4)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionAll(p)
    bounds = bounds_of(merged, "k", 8)
    assert all(abs(b - 150_000 * i / 8) <= 2 * RANK_ERROR * 150_000 + 3 for i, b in enumerate(bounds.inner, 1))


def test_empty_null_and_one(spark):
    rows = spark.createDataFrame([(None,), (None,)], "k bigint")
    assert even_bounds(rows, "k", 8) == Bounds("k", ()) == even_bounds(rows.limit(0), "k", 8)
    assert [tuple(r) for r in split_sizes(rows, Bounds("k", ())).collect()] == [(0, 2, None, None)]
    assert even_bounds(spark.createDataFrame([(5,)], "k bigint"), "k", 1).parts == 1
    most = spark.createDataFrame([((1 << 63) - 1,)] * 5 + [(-(1 << 63),)] * 5, "k bigint")
    assert sum(r.n for r in split_sizes(most, even_bounds(most, "k", 4)).collect()) == 10
    with pytest.raises(ValueError):
        even_bounds(rows, "k", 0)
    with pytest.raises(ValueError, match="order of whole numbers"):
        even_bounds(spark.createDataFrame([("a",)], "k string"), "k", 2)


def test_dates_and_times(spark):
    rows = spark.createDataFrame([(date(2024, 1, 1 + i % 28), datetime(2024, 1, 1, i % 24)) for i in range(280)], "d date, t timestamp_ntz")
    for column in ("d", "t"):
        sizes = [r.n for r in split_sizes(rows, even_bounds(rows, column, 4)).collect()]
        assert sum(sizes) == 280 and max(sizes) <= 90
    assert rows.select(whole_number(rows, "d").alias("x")).first().x == 19723


@pytest.mark.parametrize("inner", [(), (5,), (-3, 0, 9, 12)])
def test_predicates_hold_once_for_every_row(spark, inner):
    bounds = Bounds("k", inner)
    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE t (k INTEGER)")
    values = [None, *range(-10, 20)]
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    found = [sorted(r[0] for r in con.execute(f"SELECT k FROM t WHERE {p}") if r[0] is not None) for p in bounds.predicates('"k"')]
    nulls = [con.execute(f"SELECT count(*) FROM t WHERE ({p}) AND k IS NULL").fetchone()[0] for p in bounds.predicates('"k"')]
    assert sum(found, []) == values[1:] and sum(nulls) == 1 and nulls[0] == 1
    frame = spark.createDataFrame([(v,) for v in values], "k int")
    for r in frame.select("k", bounds.part(F.col("k")).alias("p")).collect():
        assert (r.k in found[r.p]) or (r.k is None and r.p == 0)
