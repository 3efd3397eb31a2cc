import uuid
from collections import Counter
from dataclasses import replace

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tablesync.plans import SyncSettings, SyncTask, run_all, run_one
from tablesync.plans.staging import stage
from tablesync.plans.sync import LAKE, LakeTarget, safe_message
from tablesync.sinks import PartitionedDir, VersionedDir
from tablesync.sources import control, lake

SCHEMA = "id int, v string, updated_at timestamp"


class Site:
    """A registry, a log, one source and one target below a new folder."""

    def __init__(self, spark, tmp_path):
        self.spark, self.base = spark, f"{tmp_path}/{uuid.uuid4().hex}"
        self.register("k1", "src", "copy")
        self.settings = SyncSettings(
            registry=f"{self.base}/registry",
            log=f"{self.base}/log",
            audit_col="updated_at",
            paths={"lake": self.base, "out": self.base},
        )
        self.task = SyncTask("k1", "lake", "src", LAKE, "out", "copy", ("id",))
        self.target = VersionedDir(spark, f"{self.base}/copy")

    def register(self, key, source, target, keys="id"):
        row = (key, "lake", source, LAKE, "out", target, keys)
        self.spark.createDataFrame([row], control.REGISTRY_SCHEMA).write.mode("append").parquet(f"{self.base}/registry")

    def source(self, *rows, mode="append", table="src"):
        df = self.spark.createDataFrame([(i, v, t) for i, v, t in rows], "id int, v string, t string")
        df = df.select("id", "v", F.col("t").cast("timestamp").alias("updated_at"))
        df.write.mode(mode).parquet(f"{self.base}/{table}")

    def run(self, **changes):
        return run_one(self.spark, self.task, replace(self.settings, **changes))

    def rows(self):
        return {r["id"]: r["v"] for r in self.target.read().collect()}

    def log(self):
        log = control.read_log(self.spark, self.settings.log)
        return log.orderBy("created_dt").select("sync_key", "current_status", F.col("watermark_value").cast("string"), "msg")


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def test_two_batches_through_registry_log_and_target(spark, site):
    site.source((1, "a", "2024-01-01"), (2, "b", "2024-01-02 00:00:00.000001"))
    first = run_all(spark, site.settings, "lake", "src", LAKE)[0]
    assert (first.status, first.rows, dict(first.stats)["inserted"]) == ("success", 2, 2)
    site.source((2, "B", "2024-01-03"), (3, "c", "2024-01-03"))
    second = run_all(spark, site.settings, "lake", "src", LAKE)[0]
    assert (second.rows, dict(second.stats)) == (2, {"inserted": 1, "updated": 1, "unchanged": 0, "kept": 1})
    assert site.rows() == {1: "a", 2: "B", 3: "c"}
    assert [tuple(r) for r in site.log().collect()] == [
        ("k1", "success", "2024-01-02 00:00:00.000001", "ok"),
        ("k1", "success", "2024-01-03 00:00:00", "ok"),
    ]


def test_empty_batch_keeps_the_watermark(site):
    site.source((1, "a", "2024-01-01"))
    site.run()
    version = site.target.current()
    result = site.run()
    assert (result.rows, result.watermark_us) == (0, None)
    assert site.target.current() == version
    site.source((2, "b", "2024-01-02"))
    assert site.run().rows == 1


def test_all_null_audit_values_load_once_and_log_no_watermark(site):
    site.source((1, "a", None))
    assert site.run().watermark_us is None
    assert site.log().first()["watermark_value"] is None
    assert site.rows() == {1: "a"}


def test_equal_watermark_is_skipped_unless_overlapping(site):
    site.source((1, "a", "2024-01-01"))
    site.run()
    site.source((2, "late", "2024-01-01"))
    assert site.run().rows == 0
    assert site.run(overlap="1 second").rows == 2
    assert site.rows() == {1: "a", 2: "late"}


def test_failed_runs_do_not_move_the_watermark(site):
    site.source((1, "a", "2024-01-01"), (1, "b", "2024-01-02"))
    with pytest.raises(Exception):
        site.run()
    row = site.log().first()
    assert (row["current_status"], row["watermark_value"]) == ("fail", None)
    assert "duplicate merge key" in row["msg"]
    assert site.target.current() is None
    assert site.run(on_duplicate="latest").rows == 1
    assert site.rows() == {1: "b"}


def test_first_load_of_an_empty_source_makes_an_empty_table(site):
    site.source()
    assert site.run().rows == 0
    assert site.rows() == {}
    assert site.target.read().columns == ["id", "v", "updated_at"]
    site.source((1, "a", "2024-01-01"))
    assert site.run().rows == 1


def test_partitioned_target(spark, site):
    settings = {"partition_by": ["id"], "broadcast_limit": 0}
    site.source((1, "a", "2024-01-01"), (2, "b", "2024-01-02"))
    site.run(**settings)
    table = PartitionedDir(spark, site.target.path, ["id"])
    kept = [f for f in table.read().inputFiles() if "id=1" in f]
    site.source((2, "B", "2024-01-03"), (3, "c", "2024-01-03"))
    assert dict(site.run(**settings).stats) == {"inserted": 1, "updated": 1, "unchanged": 0, "kept": 0}
    assert {r["id"]: r["v"] for r in table.read().collect()} == {1: "a", 2: "B", 3: "c"}
    assert [f for f in table.read().inputFiles() if "id=1" in f] == kept
    site.source((9, "z", "2023-01-01"), mode="overwrite")
    site.run(load_type="TRUNC_AND_LOAD", **settings)
    assert {r["id"]: r["v"] for r in table.read().collect()} == {9: "z"}


def test_one_failing_table_does_not_stop_the_others(spark, site):
    site.source((1, "a", "2024-01-01"))
    site.register("k0", "src", "other", keys="")
    site.register("k2", "src", "third")
    results = {r.sync_key: r.status for r in run_all(spark, site.settings, "lake", "src", LAKE)}
    assert results == {"k1": "success", "k0": "fail", "k2": "success"}
    logged = {(r["sync_key"], r["current_status"]): r["msg"] for r in site.log().collect()}
    assert "no merge keys" in logged["k0", "fail"] and len(logged) == 3
    with pytest.raises(ValueError):
        run_all(spark, replace(site.settings, fail_fast=True), "lake", "src", LAKE)
    with pytest.raises(LookupError):
        run_all(spark, site.settings, "lake", "unknown", LAKE)
    assert site.log().where("sync_key IS NULL AND current_status = 'fail' AND msg LIKE 'no registry rows%'").count() == 1
    with pytest.raises(ValueError):
        site.run(load_type="OTHER")
    assert "load_type" in site.log().collect()[-1]["msg"]


def test_truncate_and_load(site):
    site.source((1, "a", "2024-01-01"), (2, "b", "2024-01-02"))
    site.run()
    site.source((3, "c", "2023-01-01"), mode="overwrite")
    site.run(load_type="TRUNC_AND_LOAD")
    assert site.rows() == {3: "c"}


def test_validate_and_sync_loads_only_periods_that_differ(site):
    site.source((1, "a", "2024-01-01"), (2, "b", "2024-02-01"))
    site.run()
    site.source((3, "late", "2024-01-05"))
    result = site.run(load_type="VALIDATE_AND_SYNC")
    assert (result.rows, result.stats["inserted"]) == (2, 2)
    assert site.rows() == {1: "a", 2: "b", 3: "late"}
    version = site.target.current()
    assert site.run(load_type="VALIDATE_AND_SYNC").rows == 0
    assert site.target.current() == version


def test_validate_and_sync_removes_surplus_and_mends_stale_rows(spark, site):
    site.source((1, "a", "2024-01-01"), (2, "b", "2024-02-01"), (3, "c", "2024-12-31 23:59:59"), (4, "d", None), (5, "e", "2023-01-01"))
    site.run()
    site.source(
        (1, "stale no more", "2024-01-01"), (3, "c", "2024-12-31 23:59:59"), (4, "D", None), (2, "b", "2025-01-01"), (6, "f", "2023-01-01"),
        mode="overwrite",
    )  # one changed, one moved, one gone, one new, one without a time
    assert site.run(load_type="VALIDATE_AND_SYNC").rows == 4
    assert site.rows() == {1: "stale no more", 2: "b", 3: "c", 4: "D", 6: "f"}
    partitioned = replace(site.settings, partition_by=["id"], load_type="VALIDATE_AND_SYNC")
    task = replace(site.task, tgt_tbl="parts")
    run_one(spark, task, partitioned)
    site.source((1, "again", "2024-01-01"), (7, "g", "2024-01-02"), mode="overwrite")
    run_one(spark, task, partitioned)
    table = PartitionedDir(spark, f"{site.base}/parts", ["id"])
    assert {r["id"]: r["v"] for r in table.read().collect()} == {1: "again", 7: "g"}


def test_delete_and_insert_as_the_method(site):
    site.source((1, "a", "2024-01-01"), (2, "b", "2024-01-01"))
    site.run()
    site.source((2, "x", "2024-01-02"), (2, "y", "2024-01-02"))
    site.run(load_method="delete_insert")
    assert sorted(r["v"] for r in site.target.read().collect()) == ["a", "x", "y"]
    with pytest.raises(ValueError, match="load_method"):
        site.run(load_method="other")


def test_window_from_the_target_is_inclusive_and_ends_now(site):
    site.source((1, "a", "2024-01-01 00:00:00.000001"), (9, "future", "2999-01-01"))
    assert site.run(window="target").rows == 1
    site.source((2, "late", "2024-01-01"), (3, "c", "2024-01-02"))
    result = site.run(window="target")
    assert (result.rows, site.rows()) == (2, {1: "a", 3: "c"})


@pytest.mark.parametrize(
    "partial", [{"window": "user", "start": "2024-03-01"}, {"window": "target"}, {"load_type": "VALIDATE_AND_SYNC"}]
)
def test_partial_loads_do_not_move_the_watermark(site, partial):
    site.source((1, "a", "2024-01-01"))
    site.run()
    site.source((2, "b", "2024-02-01"), (3, "c", "2024-03-01"))
    site.run(**partial)
    assert site.log().collect()[-1]["watermark_value"] is None
    assert site.run().rows == 2
    assert site.rows() == {1: "a", 2: "b", 3: "c"}


def test_a_lost_target_is_loaded_whole(spark, site):
    site.source((1, "a", "2024-01-01"))
    site.run()
    other = replace(site.task, tgt_tbl="rebuilt")
    site.source((2, "b", "2024-01-02"))
    assert run_one(spark, other, site.settings).rows == 2


def test_source_from_a_reader(spark, site):
    site.source((1, "a", "2024-01-01"))
    calls = []

    def reader(session, table):
        calls.append(table)
        return lake.from_sql(session, "SELECT 7 AS id, 'sql' AS v, TIMESTAMP'2024-01-01' AS updated_at")

    assert site.run(readers={"lake": reader}).rows == 1
    assert (calls, site.rows()) == (["src"], {7: "sql"})


def test_window_by_user(site):
    site.source((1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-03"), (4, "d", None))
    assert site.run(window="user", start="2024-01-02", end="2024-01-02").rows == 1
    assert site.run(window="user", start="2024-01-02").rows == 2
    assert site.rows() == {2: "b", 3: "c"}
    with pytest.raises(ValueError, match="start"):
        site.run(window="user")
    with pytest.raises(ValueError, match="window"):
        site.run(window="other")


def test_new_source_columns_are_dropped_or_evolved(spark, site):
    site.source((1, "a", "2024-01-01"))
    site.run()
    extra = spark.sql("SELECT 2 AS id, 'b' AS v, TIMESTAMP'2024-01-02' AS updated_at, 7 AS extra")
    extra.write.mode("overwrite").parquet(f"{site.base}/src")
    site.run()
    assert "extra" not in site.target.read().columns
    extra.withColumn("updated_at", F.expr("TIMESTAMP'2024-01-03'")).write.mode("overwrite").parquet(f"{site.base}/src")
    site.run(evolve=True)
    assert {r["id"]: r["extra"] for r in site.target.read().collect()} == {1: None, 2: 7}


def test_shuffle_plan_in_a_run(site):
    site.source(*[(i, "a", "2024-01-01") for i in range(50)])
    site.run()
    site.source(*[(i, "b", "2024-01-02") for i in range(25, 75)])
    stats = site.run(broadcast_limit=0).stats
    assert dict(stats) == {"inserted": 25, "updated": 25, "unchanged": 0, "kept": 25}


def test_source_is_evaluated_once(spark, site):
    site.source(*[(i, "a", "2024-01-01") for i in range(20)])
    site.run()
    evaluated = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    batch = site.target.read().withColumn("v", F.lit("b"))
    LakeTarget(spark, site.task, site.settings).load(batch.mapInArrow(count, batch.schema))
    assert evaluated.value == 20
    assert set(site.rows().values()) == {"b"}


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_lost_tasks_change_neither_rows_nor_counts(spark, site, partition_by):
    def fails_at_first(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    def source(value):
        df = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 3).alias("p"), F.lit(value).alias("v"))
        df = df.withColumn("updated_at", F.timestamp_micros("id"))
        return df.mapInArrow(fails_at_first, df.schema)

    task = replace(site.task, merge_keys=("id", "p"))
    target = LakeTarget(spark, task, replace(site.settings, partition_by=partition_by, broadcast_limit=0))
    assert target.load(source("a")).rows == 1000
    result = target.load(source("b"))
    assert (result.rows, result.watermark_us) == (1000, 999)
    assert dict(result.stats) == {"inserted": 0, "updated": 1000, "unchanged": 0, "kept": 0}
    assert target.table.read().where("v = 'b'").select("id").distinct().count() == 1000


def test_stage_is_removed_after_a_run(spark, site):
    from tablesync import storage

    before = set(storage.glob_names(spark, f"{storage.shared_dir(spark)}/stage-*"))
    site.source((1, "a", "2024-01-01"))
    site.run()
    assert set(storage.glob_names(spark, f"{storage.shared_dir(spark)}/stage-*")) == before


def test_stage_measures(spark):
    staged = stage(spark, spark.sql("SELECT 1 AS id, TIMESTAMP'2024-01-01 00:00:00.000007' AS t"), "t")
    assert (staged.rows, staged.watermark_us % 1_000_000) == (1, 7)
    staged.drop()


def test_stage_size_is_that_of_the_values(spark):
    wide = spark.range(1000).select("id", F.repeat(F.lit("x"), 10_000).alias("v"), F.array(F.lit(1)).alias("a"))
    staged = stage(spark, wide, None)
    assert 10_000_000 < staged.bytes < 10_200_000
    staged.drop()
    assert stage(spark, wide.where("id < 0"), None).bytes == 0


def test_log_under_physical_names_and_in_a_catalog_table(spark):
    names = {"sync_key": "job", "watermark_value": "mark"}
    table = f"log_{uuid.uuid4().hex}"
    control.append_log(spark, table, "k", "success", 1_700_000_000_000_001, names=names)
    control.append_log(spark, table, None, "fail", None, "x\n" * 2500, names=names)
    assert {"job", "mark"} <= set(spark.table(table).columns)
    log = control.read_log(spark, table, names=names)
    assert control.last_watermark_us(log, "k") == 1_700_000_000_000_001
    failed = log.where("current_status = 'fail'").first()
    assert failed["log_key"] is None and failed["msg"] == "x\n" * 2500
    assert spark.table(table).where("job = 'k'").first()["log_key"]


def test_registry_under_physical_names(spark, site):
    renamed = lake.read(spark, site.settings.registry).withColumnRenamed("sync_key", "their_key")
    found = control.registry_rows(renamed, "lake", "src", LAKE, {"sync_key": "their_key"})
    assert found.first()["sync_key"] == "k1"


def test_registry_keys_are_trimmed(spark):
    row = spark.createDataFrame([("k", "d", "t", LAKE, "o", "x", " a , b ")], control.REGISTRY_SCHEMA).first()
    assert SyncTask.from_row(row).merge_keys == ("a", "b")


def test_messages_hold_no_secrets():
    text = "failed: jdbc:mysql://h/db?user=u&password=hunter2&x=1 token: abc\nstack"
    assert safe_message(ValueError(text)) == "failed: jdbc:mysql://h/db?user=u&password=***&x=1 token: ***\nstack"
    long = "line\n" * 1200 + "pwd=secret1"
    assert safe_message(ValueError(long)) == "line\n" * 1200 + "pwd=***"


def test_unmarked_versions_are_skipped_and_replaced(spark, site):
    site.source((1, "a", "2024-01-01"))
    site.run()
    broken = site.target.path_of(2)
    spark.range(5).write.parquet(broken)
    from tablesync import storage

    storage.delete(spark, f"{broken}/_SUCCESS")
    assert site.target.current() == 1
    site.source((2, "b", "2024-01-02"))
    site.run()
    assert site.target.current() == 2
    assert site.rows() == {1: "a", 2: "b"}


def test_vacuum_keeps_the_newest(spark, tmp_path):
    table = VersionedDir(spark, f"{tmp_path}/t")
    for i in range(4):
        table.write(spark.range(i))
    assert table.vacuum(2) == [1, 2]
    assert table.versions() == [3, 4]
    with pytest.raises(ValueError):
        table.vacuum(0)


def test_shared_dir_follows_the_session(spark):
    from tablesync import storage

    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.new_dir(spark, "x") != storage.new_dir(spark, "x")


def test_log_rows_counter(site):
    site.source((1, "a", "2024-01-01"))
    site.run()
    assert Counter(r["current_status"] for r in site.log().collect()) == {"success": 1}
