"""Rows along a curve, profiles kept by partition, changes settled in state."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablesync.operators import clustering, profile
from tablesync.sinks import PartitionedDir, VersionedDir, publish
from tablesync.streaming import newest_changes, settled_upsert_stream


def test_curve_takes_turns(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    keys = {(r.a, r.b): r.k for r in rows.withColumn("k", clustering.curve_key(rows, ["a", "b"], bits=2)).collect()}
    for (a, b), k in keys.items():
        assert k == sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(2))
    with pytest.raises(ValueError):
        clustering.curve_key(rows, [])
    with pytest.raises(ValueError):
        clustering.curve_key(rows, ["a", "b"], bits=40)


def test_compaction_keeps_all_rows_and_skips_files(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") * 7919 % 10_007).alias("a"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 31 % 1000).cast("int")).alias("d"), F.col("id"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, -1), (None, date(2021, 1, 1), -2)], "a bigint, d date, id bigint"))
    table = VersionedDir(spark, f"{tmp_path}/t")
    table.write(rows.repartition(9))
    version = publish.compact_clustered(table, ["a", "d"], files=64, bits=4)
    found = table.read()
    assert table.current() == version == 2
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, rows.collect()))
    files = found.groupBy(F.input_file_name()).agg(F.min("a").alias("la"), F.max("a").alias("ha"), F.min("d").alias("ld"), F.max("d").alias("hd"), F.count(F.lit(1)).alias("n")).collect()
    assert len(files) == 64 and max(f.n for f in files) < 3 * 40_000 / 64
    assert sum(f.la <= 5000 <= f.ha for f in files) <= 32
    assert sum(f.ld <= date(2021, 5, 1) <= f.hd for f in files) <= 32
    publish.compact_clustered(table, ["a", "d"])
    assert table.read().count() == 40_002 and len(table.read().inputFiles()) == 1


def test_profiles_by_partition_are_the_whole_profile(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.randrange(900) if rng.random() < 0.9 else None, rng.choice(["a", "bbb", None]), date(2024, 1, 1) + timedelta(days=rng.randrange(90)), 0.5) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "p int, n bigint, s string, d date, x double")
    store = PartitionedDir(spark, f"{tmp_path}/profiles", ["partition"])
    columns = ["n", "s", "d", "x"]
    store.write(profile.partition_profiles(frame.where("p < 3"), "p", columns))
    before = set(store.read().inputFiles())
    store.write(profile.partition_profiles(frame.where("p >= 3"), "p", columns))
    assert before <= set(store.read().inputFiles())  # what is there is not touched
    found = {r.column: r for r in profile.merged_profile(store.read()).collect()}
    for i, c in enumerate(columns, 1):
        values = [r[i] for r in rows if r[i] is not None]
        r = found[c]
        assert (r.n, r.nulls, r.width) == (5000, 5000 - len(values), max(len(str(v)) for v in values))
        assert abs(r.distinct_values - len(set(values))) <= max(1, profile.DISTINCT_ERROR * len(set(values)))
    values = sorted(r[1] for r in rows if r[1] is not None)
    assert abs(sum(v <= found["n"].median for v in values) / len(values) - 0.5) < 0.01
    assert found["s"].median is None and found["x"].median is None and found["d"].median is not None
    # A partition again replaces its own profile only.
    store.write(profile.partition_profiles(frame.where("p = 4"), "p", columns))
    assert {r.column: r.n for r in profile.merged_profile(store.read()).collect()} == dict.fromkeys(columns, 5000)
    empty = profile.partition_profiles(spark.createDataFrame([(1, None)], "p int, v bigint"), "p", ["v"])
    assert [tuple(r) for r in profile.merged_profile(empty).collect()] == [("v", 1, 1, None, 0, None)]
    assert profile.merged_profile(profile.partition_profiles(frame.limit(0), "p", columns)).count() == 0


START = datetime(2024, 1, 1)
SCHEMA = "k int, at timestamp, n bigint, v string"


def arrive(spark, base, *rows):
    frame = spark.createDataFrame([(k, None if m is None else START + timedelta(minutes=m), n, f"{k}-{m}-{n}") for k, m, n in rows], SCHEMA)
    frame.repartition(2).write.mode("append").parquet(f"{base}/in")


def drain(spark, base, target, delay, **more):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    query = settled_upsert_stream(stream, target, ["k"], f"{base}/checkpoint", time="at", order_by=["at", "n"], delay=delay, **more)
    assert query.awaitTermination(300)
    return query


def test_state_settles_late_and_repeated_changes(spark, tmp_path):
    target = VersionedDir(spark, f"{tmp_path}/out")
    rng = random.Random(2)
    rows = [(rng.randrange(20), rng.randrange(500), rng.randrange(1 << 60) | 1) for _ in range(300)]
    versions = []
    for at in range(0, 300, 100):
        arrive(spark, tmp_path, *rows[at : at + 100], *rows[at : at + 5])
        drain(spark, tmp_path, target, "2 days", keep_versions=9)
        versions.append(target.current())
        newest = {}
        for k, m, n in rows[: at + 100]:
            newest[k] = max(newest.get(k, (m, n)), (m, n))
        assert {r.k: r.v for r in target.read().collect()} == {k: f"{k}-{m}-{n}" for k, (m, n) in newest.items()}
    version = target.current()
    arrive(spark, tmp_path, *[(k, m - 1, n) for k, m, n in rows[:50]], *rows[:3])
    drain(spark, tmp_path, target, "2 days", keep_versions=9)
    assert target.current() == version  # nothing of it reached the target


def test_state_shrinks_behind_the_watermark(spark, tmp_path):
    target = VersionedDir(spark, f"{tmp_path}/out")
    arrive(spark, tmp_path, *[(k, 0, k) for k in range(50)])
    first = drain(spark, tmp_path, target, "1 hour")
    arrive(spark, tmp_path, (99, 60 * 24, 1))
    second = drain(spark, tmp_path, target, "1 hour")
    held = lambda q: q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert held(first) >= 50 and held(second) < 10
    assert target.read().count() == 51


def test_time_must_lead_the_order(spark):
    stream = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="first of order_by"):
        newest_changes(stream, ["k"], "at", ["n", "at"], "1 day")
