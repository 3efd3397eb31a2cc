"""The physical plans we want: what reaches the scan, what is shuffled, how skew is spread."""

import re

import pytest
from pyspark.sql import functions as F

from tablesync import storage
from tablesync.operators import merge
from tablesync.operators.reconcile import compare_periods
from tablesync.plans import queries
from tablesync.plans.staging import shuffle_parts, stage
from tablesync.sinks import PartitionedDir, VersionedDir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plan_after(df):
    """The plan as it ran, with what was decided on the way."""
    df.write.format("noop").mode("overwrite").save()
    frame = df.where("true")
    frame.collect()
    return plan(frame)


def details(df):
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scans(df):
    return re.findall(r"FileScan .*", plan(df))


@pytest.fixture
def sides(spark, tmp_path):
    spark.range(2000).select("id", F.lit("a").alias("v"), F.lit(1.0).alias("w")).write.parquet(f"{tmp_path}/t")
    spark.range(1000, 3000).select("id", F.lit("b").alias("v")).write.parquet(f"{tmp_path}/s")
    return spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")


def test_watermark_and_range_filters_reach_the_scan(spark, sf_dir):
    assert "GreaterThan(o_orderdate,2001-01-01T00:00)" in details(queries.incremental_filter(spark, sf_dir))
    ranged = details(queries.range_extract(spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate" in ranged and "LessThanOrEqual(l_shipdate" in ranged


def test_columns_are_pruned(spark, sf_dir):
    (scan,) = scans(queries.pk_violations(spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in scan
    for scan in scans(queries.merge_upsert(spark, sf_dir)):
        assert "o_orderpriority" not in scan


def test_small_batch_never_shuffles_the_target(sides):
    target, batch = sides
    text = plan(merge.apply_batch(target, batch, ["id"], small_batch=True))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("w#" in line or "t2#" in line for line in shuffled)


def test_large_batch_shuffles_each_side_once(spark, sides):
    target, batch = sides
    df = merge.apply_batch(target, batch, ["id"])
    text = plan(df)
    # rows of the target go through one shuffle; a second one holds its keys alone
    whole = [scan for scan in scans(df) if "IsNotNull(id)" in scan and "w:double" in scan]
    assert len(whole) == 1
    assert "LeftOuter" in text and "LeftAnti" in text and "FullOuter" not in text
    assert "SortAggregate" not in text


def test_change_feed_reads_the_target_rows_once(sides):
    target, batch = sides
    df = merge.change_feed(target, batch, ["id"])
    assert len([scan for scan in scans(df) if "IsNotNull(id)" in scan and "w:double" in scan]) == 1
    assert "SortAggregate" not in plan(df)


def test_a_hot_target_key_is_split(spark, tmp_path):
    """A key with half a percent of a larger target, far below what a sample singles out."""
    wide = F.concat(F.col("id").cast("string"), F.repeat(F.md5(F.col("id").cast("string")), 8))
    key = F.when(F.col("id") % 200 == 0, -1).otherwise(F.col("id"))
    spark.range(0, 400_000, 1, 8).select(key.alias("k"), wide.alias("v")).write.parquet(f"{tmp_path}/t")
    batch = spark.range(-1, 50).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    settings = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
        "spark__sql__shuffle__partitions": "200",
        "spark__sql__autoBroadcastJoinThreshold": "-1",
    }
    with storage.conf(spark, **settings):
        merged = merge.apply_batch(spark.read.parquet(f"{tmp_path}/t"), batch, ["k"])
        counts = merged.groupBy("v").count().where("v = 'new'").collect()
        assert counts[0]["count"] == 2000 + 50 and "skew=true" in plan_after(merged)


def test_reconcile_is_one_aggregate_without_a_join(sides, spark):
    day = F.expr("DATE'2024-01-01' + CAST(id % 90 AS INT)").alias("d")
    target, batch = (df.select(day) for df in sides)
    text = plan(compare_periods(batch, target, "d"))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_no_query_plans_a_cross_join(spark, sf_dir):
    for name in ("merge_upsert", "merge_heavy_keys", "delete_insert", "change_feed", "resync_rows", "job_of_step"):
        text = plan(queries.QUERIES[name](spark, sf_dir))
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_rows_with_null_keys_are_not_shuffled(sides):
    target, batch = sides
    for df in (merge.apply_batch(target, batch, ["id"]), merge.delete_insert(target, batch, ["id"])):
        text = plan(df)
        assert text.count("Exchange hashpartitioning") <= 2
        loose = [scan for scan in scans(df) if "IsNull(id)" in scan]
        assert any("w#" in scan for scan in loose)


def test_hot_batch_key_is_cut_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    df = spark.range(0, 99_999, 1, 8).select(key.alias("k"), F.col("id").alias("t"))
    latest = merge.latest_by_key(df, ["k"], ["t"])
    assert latest.where("k = 1").first()["t"] == 99_996
    assert re.search(r"WindowGroupLimit .*, 1, Partial", plan(latest))
    merged = merge.apply_batch(df.limit(0), df, ["k"], on_duplicate="latest", order_by=["t"])
    assert re.search(r"WindowGroupLimit .*, 1, Partial", plan(merged))


def test_touched_partitions_are_pruned_by_a_static_filter(spark, tmp_path):
    table = PartitionedDir(spark, f"{tmp_path}/p", ["code"])
    rows = spark.range(100).select("id", F.format_string("%03d", F.col("id") % 10).alias("code"))
    table.write(rows)
    assert table.read().schema["code"].dataType.simpleString() == "string"
    found = table.rows_to_merge(rows.where("id in (3, 14)"), ["code", "id"])
    assert {re.search("code=(...)", f)[1] for f in found.inputFiles()} == {"003", "004"}
    assert {r["code"] for r in found.collect()} == {"003", "004"}


def test_wrong_periods_are_broadcast(spark, sf_dir):
    text = plan(queries.resync_rows(spark, sf_dir))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_a_selective_batch_is_staged_in_few_files(spark):
    scattered = spark.range(0, 100_000, 1, 64).where("id % 5000 = 0")
    staged = stage(spark, scattered, None)
    assert staged.rows == 20
    assert len(staged.df.inputFiles()) < 8
    staged.drop()


def test_many_touched_partitions_are_read_alone(spark, tmp_path):
    table = PartitionedDir(spark, f"{tmp_path}/p", ["p"])
    rows = spark.range(0, 2400, 1, 2).select("id", (F.col("id") % 1200).alias("p"))
    with storage.conf(spark, spark__sql__shuffle__partitions=4):
        table.write(rows)
        found = table.rows_to_merge(rows.where("p < 1001 OR p = 5000"), ["p", "id"])
    assert "Join" not in plan(found) and len(found.inputFiles()) >= 1001
    assert not any(f"p={p}/" in f for f in found.inputFiles() for p in (1001, 1100, 1199))
    assert found.agg(F.countDistinct("p"), F.count("id")).first()[:] == (1001, 2002)


def test_null_and_odd_partition_values(spark, tmp_path):
    table = PartitionedDir(spark, f"{tmp_path}/p", ["p", "d"])
    schema = "id int, p string, d date"
    values = [(1, None, None), (2, "x/y=z %", "2024-01-02"), (3, "y", "2024-01-02"), (4, "é", None)]
    rows = spark.createDataFrame([(i, p, d) for i, p, d in values], "id int, p string, d string").selectExpr("id", "p", "CAST(d AS DATE) AS d")
    table.write(rows)
    found = table.rows_to_merge(rows.where("id <> 3"), ["id", "p", "d"])
    assert sorted(r["id"] for r in found.collect()) == [1, 2, 4]
    assert table.rows_to_merge(spark.createDataFrame([], schema), ["id", "p", "d"]).isEmpty()


def test_partition_types_survive_a_version(spark, tmp_path):
    table = VersionedDir(spark, f"{tmp_path}/v")
    table.write(spark.sql("SELECT 1 AS id, '007' AS code"), ["code"])
    assert table.read().first()["code"] == "007"


def test_shuffle_partitions_grow_with_the_table(spark, tmp_path, monkeypatch):
    table = VersionedDir(spark, f"{tmp_path}/v")
    table.write(spark.range(10))
    assert shuffle_parts(spark, table) == 8
    monkeypatch.setattr("tablesync.storage.size_bytes", lambda *_: 100 << 40)
    assert shuffle_parts(spark, table) == (100 << 40) // (64 << 20)
