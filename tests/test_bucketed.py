"""Tables in hash buckets: what a merge rewrites, and when readers see it."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablesync import storage
from tablesync.plans import SyncSettings, SyncTask, merge_into, stage
from tablesync.plans.sync import LAKE, LakeTarget
from tablesync.sinks.bucketed import BucketedDir
from tablesync.streaming import upsert_stream


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    table = BucketedDir(spark, f"{tmp_path}/t", ["id"], 16)
    table.write(spark.range(200).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("v")))
    return table


def merge(spark, table, batch, **options):
    staged = stage(spark, batch, None)
    try:
        return merge_into(table, staged, table.keys, **options)
    finally:
        staged.drop()


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_only_touched_buckets_are_rewritten(spark, table, limit):
    before = set(table.read().inputFiles())
    batch = spark.createDataFrame([(3, "b"), (1000, "n"), (None, "null")], "id bigint, v string")
    stats = merge(spark, table, batch, broadcast_limit=limit)
    assert (stats["inserted"], stats["updated"]) == (2, 1) and stats["kept"] < 100
    after = set(table.read().inputFiles())
    assert 13 <= len(before & after) < len(before) and len(after - before) <= 3
    expected = Counter([(i, "a") for i in range(200) if i != 3] + [(3, "b"), (1000, "n"), (None, "null")])
    assert rows(table.read()) == expected
    assert rows(BucketedDir(spark, table.path, ["id"], 99).read()) == expected


def test_null_keys_and_zeros_stay_in_their_buckets(spark, tmp_path):
    table = BucketedDir(spark, f"{tmp_path}/n", ["x", "y"], 8)
    held = [(0.0, "a", 1), (-0.0, "b", 2), (None, "a", 3), (None, None, 4), (1.5, None, 5)]
    table.write(spark.createDataFrame(held, "x double, y string, v int"))
    stats = merge(spark, table, spark.createDataFrame([("a", -0.0, 10), ("b", 0.0, 20), (None, None, 40), ("a", None, 30)], "y string, x float, v int"))
    assert (stats["inserted"], stats["updated"]) == (2, 2)
    found = Counter((abs(x) if x is not None else None, y, v) for x, y, v in rows(table.read()).elements())
    assert found == Counter([(0.0, "a", 10), (0.0, "b", 20), (None, "a", 3), (None, None, 4), (1.5, None, 5), (None, None, 40), (None, "a", 30)])


def test_a_batch_again_changes_nothing(spark, table):
    batch = spark.createDataFrame([(i, "b") for i in range(50)], "id int, v string")
    merge(spark, table, batch)
    expected = rows(table.read())
    merge(spark, table, batch)
    assert rows(table.read()) == expected and table.read().where("v = 'b'").count() == 50
    assert table.read().columns == ["id", "v"] and len(storage.glob_names(spark, f"{table.path}/__bucket=*")) == 16


def test_new_columns_and_other_keys(spark, table):
    merge(spark, table, spark.createDataFrame([(1, "b", 9)], "ID int, v string, w int"), evolve=True)
    assert rows(table.read().where("id < 3")) == Counter([(0, "a", None), (1, "b", 9), (2, "a", None)])
    with pytest.raises(ValueError, match="merge keys"):
        table.rows_to_merge(table.read(), ["v"])
    table.replace(table.read().limit(0).select("id", "v"))
    assert table.read().columns == ["id", "v"] and table.read().count() == 0
    merge(spark, table, spark.createDataFrame([(1, "x")], "id int, v string"))
    assert rows(table.read()) == Counter([(1, "x")])


def test_as_the_target_of_runs_and_streams(spark, tmp_path):
    settings = SyncSettings(registry="", log="", audit_col="at", paths={"out": f"{tmp_path}"}, buckets=8)
    target = LakeTarget(spark, SyncTask("k", "lake", "src", LAKE, "out", "copy", ("id",)), settings)
    source = spark.range(100).select("id", F.timestamp_micros("id").alias("at"), F.lit("a").alias("v"))
    assert target.load(source).rows == 100
    kept = set(target.table.read().inputFiles())
    assert target.load(source.where("id = 5").withColumn("v", F.lit("b"))).stats["updated"] == 1
    assert len(kept & set(target.table.read().inputFiles())) == len(kept) - 1
    repair = LakeTarget(spark, target.task, replace(settings, load_type="VALIDATE_AND_SYNC"))
    assert repair.load(source.where("id <> 7")).rows == 99
    assert rows(target.table.read()) == rows(source.where("id <> 7"))
    spark.createDataFrame([(1, "late", 1), (200, "n", 1)], "id bigint, v string, t int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id bigint, v string, t int").parquet(f"{tmp_path}/in")
    streamed = BucketedDir(spark, f"{tmp_path}/s", ["id"], 4)
    streamed.write(spark.createDataFrame([(1, "newer", 2), (2, "x", 1)], "id bigint, v string, t int"))
    assert upsert_stream(stream, streamed, ["id"], f"{tmp_path}/c", order_by=["t"]).awaitTermination(120)
    assert rows(streamed.read()) == Counter([(1, "newer", 2), (2, "x", 1), (200, "n", 1)])
