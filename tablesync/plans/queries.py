"""Registered queries: every operator over the whole shared tables.

The stand-ins follow the product's own situation. The *target* is ``orders`` as loaded up to one
watermark; the *batch* is ``orders`` read again from an earlier watermark (an overlapping window), with
finished orders repriced. So some rows are new, some changed, some equal, and some only in the target.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import storage
from tablesync.functions import (
    audit_key,
    json_field,
    key_values,
    period,
    split_list,
    ts_text,
    user_config,
)
from tablesync.operators import asof, drilldown, feeds, iblt, merge, profile, quality, quantiles, reconcile, splits, watermark
from tablesync.operators.skew import heavy_key_hashes
from tablesync.plans.staging import merge_into, stage
from tablesync.plans.sync import LAKE, SyncSettings, run_all
from tablesync.sinks import delimited, publish
from tablesync.sinks.bucketed import BucketedDir
from tablesync.sinks.ddl import add_missing_columns, missing_fields
from tablesync.sinks.partitioned import PartitionedDir
from tablesync.sinks.versioned import VersionedDir
from tablesync.sources import control, lake
from tablesync.streaming import settled_upsert_stream, upsert_stream

BATCH_FROM = "1998-01-01 00:00:00"
TARGET_UNTIL = "2000-06-30 00:00:00"
EVENTS_FROM = "2024-01-10 00:00:00"
EVENTS_UNTIL = "2024-01-20 00:00:00"
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def _table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return lake.read(spark, f"{sf_dir}/{table}.parquet")


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _micros(spark: SparkSession, text: str) -> int:
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    return int(datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=zone).timestamp()) * 1_000_000


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").where(F.col("o_orderdate") <= _ntz(TARGET_UNTIL)).select(*ORDER_COLUMNS)


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source window with one column the target does not have (o_orderpriority)."""
    repriced = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
    window = _table(spark, sf_dir, "orders").where(F.col("o_orderdate") > _ntz(BATCH_FROM))
    return window.withColumn("o_totalprice", repriced)


def _sync_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").alias("sync_key"),
        F.when(F.col("event_type") == "error", control.FAIL).otherwise(control.SUCCESS).alias("current_status"),
        F.when(F.col("event_type") != "view", F.col("ts")).alias("watermark_value"),
    )


def _temp_table(spark: SparkSession, df: DataFrame, purpose: str) -> str:
    """A new external table below the shared folder, from the frame's rows."""
    path = storage.new_dir(spark, purpose)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.option("path", path).saveAsTable(table, format="parquet")
    return table


# A, B: sources, filters, projections


def incremental_filter(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return lake.newer_than(orders, "o_orderdate", _micros(spark, "2001-01-01 00:00:00"))


def range_extract(spark, sf_dir):
    return lake.extract(
        spark,
        f"{sf_dir}/lineitem.parquet",
        date_col="l_shipdate",
        start="1997-01-01 00:00:00",
        end="1997-03-31 00:00:00",
    )


def full_load(spark, sf_dir):
    return lake.extract(spark, f"{sf_dir}/orders.parquet", full_load=True, date_col="o_orderdate", start="2001-01-01")


def sql_passthrough(spark, sf_dir):
    views = {t: _table(spark, sf_dir, t) for t in ("customer", "nation", "orders")}
    text = """
        SELECT n_name, o_orderstatus, count(*) AS cnt, count(DISTINCT c_custkey) AS customers
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ)
        GROUP BY GROUPING SETS ((n_name, o_orderstatus), (n_name), ())
    """
    return lake.from_sql(spark, text, views, {"since": "1996-01-01 00:00:00"})


def filter_in_list(spark, sf_dir):
    found = lake.where_equal(
        _table(spark, sf_dir, "orders"), o_orderstatus="F", o_orderpriority=["1-URGENT", "2-HIGH"]
    )
    return found.select("o_orderkey", "o_orderstatus", "o_orderpriority")


def regex_filter(spark, sf_dir):
    return _table(spark, sf_dir, "part").where(F.col("p_name").rlike("_pk|ring")).select("p_partkey", "p_name")


def key_first_projection(spark, sf_dir):
    return publish.key_first(_table(spark, sf_dir, "events"), ["event_id", "user_id"])


def stride_counts(spark, sf_dir):
    return splits.key_histogram(_table(spark, sf_dir, "orders"), "o_orderkey", 8)


def split_quantiles(spark, sf_dir):
    """Sixteen splits of a key with wide gaps: even row counts, and bounds whose true ranks are near their share."""
    key = F.col("l_orderkey").cast("bigint")
    # A gap of 2**56 wherever keys get one binary digit more; no whole number overflows.
    gap = F.shiftleft(F.length(F.bin(key)).cast("bigint"), 56)
    lines = _table(spark, sf_dir, "lineitem").select(key.bitwiseXOR(gap).alias("k"))
    bounds = quantiles.even_bounds(lines, "k", 16)
    sizes = quantiles.split_sizes(lines, bounds)
    total = sizes.agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max("n").alias("most"))
    below = [F.sum(F.when(F.col("part_id") < p, F.col("n")).otherwise(0)) / F.sum("n") - p / 16 for p in range(1, bounds.parts)]
    near = sizes.agg(F.greatest(*[F.abs(b) for b in below]).alias("off"))
    shown = total.crossJoin(near)  # one row each
    return shown.select("parts", "n", (F.col("most") <= 1.1 * F.col("n") / F.col("parts")).alias("even"), (F.col("off") <= 0.01).alias("near"))


def partition_bounds(spark, sf_dir):
    year = lake.between(_table(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01", "1996-12-31")
    return splits.split_bounds(year, "o_orderkey")


def partition_plan_rows(spark, sf_dir):
    tables = {t: _table(spark, sf_dir, t) for t in ("orders", "lineitem", "events")}
    none = lake.newer_than(tables["orders"], "o_orderdate", _micros(spark, "2100-01-01 00:00:00"))
    return splits.splits_by_rows({**tables, "empty": none}, per_split=5000)


def partition_plan_size(spark, sf_dir):
    # p_retailprice stands in for a table's size in MB
    return _table(spark, sf_dir, "part").select("p_partkey", splits.splits_by_size("p_retailprice").alias("parts"))


def repartition_up(spark, sf_dir):
    """Partitions with rows and rows in all, after raising the number of partitions."""
    raised = lake.at_least_partitions(_table(spark, sf_dir, "lineitem"), 16)
    sizes = raised.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    return sizes.agg(F.count_if(F.col("n") > 0).alias("parts"), F.sum("n").alias("n"), F.sum("q").alias("quantity"))


# C: control look-ups, merges, reconciliation


def last_success_watermark(spark, sf_dir):
    return control.last_success_watermarks(_sync_log(spark, sf_dir))


def job_of_step(spark, sf_dir):
    return control.lookup_through(
        _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "c_custkey",
        _table(spark, sf_dir, "orders"),
        "o_custkey",
        o_orderkey=42,
    )


def single_row_lookup(spark, sf_dir):
    found = lake.where_equal(_table(spark, sf_dir, "customer"), c_name="Customer#000000042")
    control.fetch(found, "one")
    return found.select("c_custkey", "c_name", "c_acctbal")


def steps_ordered_topk(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10)


def merge_upsert(spark, sf_dir):
    return merge.apply_batch(_target(spark, sf_dir), _batch(spark, sf_dir), ["o_orderkey"])


def merge_heavy_keys(spark, sf_dir):
    """Target with many rows per key (events by user): every match is set; heavy users leave the shuffle."""
    target = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    batch = (
        _table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))
    )
    heavy = heavy_key_hashes(target, ["user_id"], share=0.001, fraction=1.0)
    return merge.apply_batch(target, batch, ["user_id"], heavy=heavy)


def merge_bloom(spark, sf_dir):
    """The upsert with a filter of the batch's keys: target rows that cannot match are not shuffled."""
    batch = _batch(spark, sf_dir)
    return merge.apply_batch(_target(spark, sf_dir), batch, ["o_orderkey"], bloom=batch.count())


def merge_target_only_cols(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    target = customer.where(F.col("c_mktsegment") != "BUILDING").select("c_custkey", "c_acctbal", "c_name")
    aside = (F.col("c_acctbal") < 5000) | (F.col("c_mktsegment") == "BUILDING")
    batch = customer.where(aside).select("c_custkey", (F.col("c_acctbal") + 5.0).alias("c_acctbal"))
    return merge.apply_batch(target, batch, ["c_custkey"])


def merge_null_keys(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    key = F.when(F.col("event_type") != "error", F.col("event_id"))
    target = events.where(F.col("ts") <= _ntz(EVENTS_UNTIL)).select(key.alias("k"), F.col("value").alias("v"))
    batch = events.where(F.col("ts") > _ntz(EVENTS_FROM)).select(key.alias("k"), (F.col("value") + 1.0).alias("v"))
    return merge.apply_batch(target, batch, ["k"])


def delete_insert(spark, sf_dir):
    """Batch with repeated keys: a customer's orders in the window replace all the customer's orders."""
    target = _target(spark, sf_dir)
    heavy = heavy_key_hashes(target, ["o_custkey"])
    return merge.delete_insert(target, _batch(spark, sf_dir), ["o_custkey"], heavy=heavy)


def merge_stats(spark, sf_dir):
    merged = merge.merge_with_actions(_target(spark, sf_dir), _batch(spark, sf_dir), ["o_orderkey"])
    return merge.merge_stats(merged)


def change_feed(spark, sf_dir):
    feed = merge.change_feed(_target(spark, sf_dir), _batch(spark, sf_dir), ["o_orderkey"])
    return feed.select("o_orderkey", "_change_type", "o_totalprice")


def change_feed_replace(spark, sf_dir):
    feed = merge.change_feed(_target(spark, sf_dir), _batch(spark, sf_dir), ["o_orderkey"], replace=True)
    return feed.select("o_orderkey", "_change_type", "o_totalprice")


def dedup_latest(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return merge.latest_by_key(events, ["user_id", "event_type"], ["ts", "event_id"])


def merge_latest(spark, sf_dir):
    """Upsert of a late batch that repeats keys: the newest event of each user wins, whichever side has it."""
    columns = ["user_id", "ts", "event_id", "event_type", "value"]
    events = _table(spark, sf_dir, "events").select(*columns)
    newer = (F.col("ts") > _ntz(EVENTS_FROM)) & (F.col("event_type") != "view")
    target = merge.latest_by_key(events.where(newer), ["user_id"], ["ts", "event_id"])
    return merge.apply_batch(target, events.where(~newer), ["user_id"], on_duplicate="latest", order_by=["ts", "event_id"])


def reconcile_monthly(spark, sf_dir):
    return reconcile.compare_periods(_table(spark, sf_dir, "orders"), _target(spark, sf_dir), "o_orderdate", "monthly")


def reconcile_daily(spark, sf_dir):
    return reconcile.period_counts(_table(spark, sf_dir, "events"), "ts", "daily")


def resync_rows(spark, sf_dir):
    return reconcile.rows_to_resync(_table(spark, sf_dir, "orders"), _target(spark, sf_dir), "o_orderdate", "monthly")


def _wrong_copy(spark, sf_dir):
    """The orders with some missing, some stale and some that the source has not."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    key = F.col("o_orderkey")
    stale = F.when(key % 89 == 0, F.col("o_totalprice") - 1.0).otherwise(F.col("o_totalprice"))
    copy = orders.where(F.col("o_custkey") % 101 != 5).withColumn("o_totalprice", stale)
    surplus = orders.where(key % 997 == 0).withColumn("o_orderkey", -1 - key)
    return copy.unionByName(surplus)


def validate_drilldown(spark, sf_dir):
    """Days and ranges of a hundred thousand keys in which source and copy differ, by one tree of checksums."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    path = storage.new_dir(spark, "checksum-tree")
    drilldown.checksum_tree(orders, _wrong_copy(spark, sf_dir), "o_orderdate", "o_orderkey", 100_000).write.parquet(path)
    return drilldown.differing_leaves(spark.read.parquet(path))


def reconcile_sketch(spark, sf_dir):
    """Keys whose rows differ between source and copy, by cells of sums that cancel."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    return iblt.differing_keys(orders, _wrong_copy(spark, sf_dir), ["o_orderkey"])


def watermark_as_of(spark, sf_dir):
    """For every event the last successful log entry of its table at that time; one table has a third of all."""
    log = _sync_log(spark, sf_dir).select("log_id", "current_status", "watermark_value")
    events = _table(spark, sf_dir, "events")
    table = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("sync_key")
    rows = events.select("event_id", table, "ts")
    done = events.join(log, F.col("event_id") == F.col("log_id")).where((F.col("current_status") == control.SUCCESS) & F.col("watermark_value").isNotNull())
    return asof.as_of(rows, done.select(table, "ts", "log_id"), ["sync_key"], "ts", "log_id", "last_log")


# D: aggregates


def batch_watermark(spark, sf_dir):
    return watermark.batch_watermark(_table(spark, sf_dir, "events"), "ts")


def target_watermark(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    future = F.when(F.col("o_orderdate") > _ntz("2100-01-01 00:00:00"), F.col("o_orderdate"))
    return orders.agg(
        watermark.newest_text("o_orderdate").alias("start_dt"),
        watermark.newest_text(future).alias("empty_start_dt"),
        watermark.newest_text(future, watermark.DEFAULT_END).alias("empty_end_dt"),
    )


def table_counts(spark, sf_dir):
    return _table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"))


def dq_fail_flag(spark, sf_dir):
    balance = F.col("c_acctbal")
    checked = _table(spark, sf_dir, "customer").withColumn(
        "Status", F.when(balance < -990, "failed").when(balance >= 0, "PASS")
    )
    return quality.fail_flag(checked, "status", by=["c_nationkey", "c_mktsegment"])


def pk_violations(spark, sf_dir):
    return quality.pk_violations(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def string_width(spark, sf_dir):
    return quality.width_report(_table(spark, sf_dir, "documents"), ["text", "source"], limit=4000)


def latest_version(spark, sf_dir):
    versions = _table(spark, sf_dir, "events").select("user_id", F.col("event_id").cast("string").alias("version"))
    return quality.latest_version(versions, "user_id", "version")


# F: expressions


def period_bucket(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        period("l_shipdate", "monthly").alias("ym"),
        period("l_shipdate", "daily").alias("d"),
    )


def audit_keys(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", audit_key("user_id", ts_text("ts")).alias("log_key"))


def kv_parse(spark, sf_dir):
    text = F.concat(F.lit("uid=0;junk;uid="), F.col("user_id"), F.lit(";typ="), F.col("event_type"))
    parsed = _table(spark, sf_dir, "events").select("event_id", key_values(text).alias("m"))
    return parsed.select("event_id", F.col("m")["uid"].alias("uid"), F.col("m")["typ"].alias("typ"))


def json_extract(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        "event_id", json_field("props", "$.k", "int").alias("k"), json_field("props", "$.none", "int", -1).alias("missing")
    )


def config_parse(spark, sf_dir):
    """Table configurations as JSON text, one per order, read to typed columns."""
    config = F.to_json(
        F.struct(
            F.lit("o_orderdate").alias("USER_DT_COL"),
            F.when(F.col("o_orderstatus") == "O", "Y").otherwise("N").alias("USER_DT_FLG"),
            *[F.lit("x").alias(c) for c in ("SRC_DB_TYPE", "SRC_DB", "SRC_PORT", "SRC_TABLE", "SRC_SCHEMA")],
            F.lit("MySQL").alias("TGT_DB_TYPE"),
            *[F.lit("x").alias(c) for c in ("TGT_DB", "TGT_PORT", "STG_SCHEMA", "TGT_SCHEMA", "TGT_TABLE")],
            F.lit("APPEND").alias("LOAD_TYPE"),
            F.concat(F.lit("id , "), F.col("o_orderpriority")).alias("KEY_COLS"),
            F.when(F.col("o_custkey") > 100, F.col("o_custkey")).alias("SPARK_PARTITION_SIZE_MB"),
            ts_text("o_orderdate").alias("START_DT"),
        )
    )
    parsed = _table(spark, sf_dir, "orders").select("o_orderkey", user_config(config).alias("c"))
    return parsed.select(
        "o_orderkey",
        F.col("c.user_dt_flg").alias("by_user"),
        F.col("c.tgt_db_type").alias("tgt_db_type"),
        F.col("c.key_cols")[1].alias("second_key"),
        F.col("c.split_mb").alias("split_mb"),
        F.col("c.part_rec_cnt").alias("part_rec_cnt"),
        F.col("c.start_dt").alias("start_dt"),
    )


def split_keys(spark, sf_dir):
    text = F.concat(F.col("o_orderstatus"), F.lit(" , "), F.col("o_orderpriority"))
    parts = _table(spark, sf_dir, "orders").select("o_orderkey", split_list(text).alias("k"))
    return parts.select("o_orderkey", F.col("k")[0].alias("k1"), F.col("k")[1].alias("k2"))


# G: sinks; each writes below the shared folder and returns what it reads back


def empty_clone(spark, sf_dir):
    """Stage set-up: clone the target's columns without rows, then stage the whole table in the clone."""
    target = _temp_table(spark, _target(spark, sf_dir), "clone-source")
    stage_table = f"{target}_stg"
    publish.empty_clone(spark, target, stage_table, location=storage.new_dir(spark, "clone"))
    publish.publish_table(
        _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS), stage_table, mode="append"
    )
    return spark.table(stage_table)


def publish_merge_schema(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    old = customer.where(F.col("c_mktsegment") != "BUILDING").select("c_custkey", "c_acctbal")
    table = _temp_table(spark, old, "published")
    new = customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_acctbal", "c_mktsegment")
    publish.publish_table(new, table, mode="append", schema_option="mergeSchema", primary_keys="c_custkey")
    return spark.table(table)


def schema_diff(spark, sf_dir):
    """Columns the batch has and the target lacks are added to the target, then filled by the merge."""
    table = _temp_table(spark, _target(spark, sf_dir), "evolving")
    batch = _batch(spark, sf_dir)
    add_missing_columns(spark, table, batch)
    assert not missing_fields(spark.table(table).schema, batch.schema)
    return merge.apply_batch(spark.table(table), batch, ["o_orderkey"])


def feature_upsert(spark, sf_dir):
    keyed = VersionedDir(spark, storage.new_dir(spark, "keyed"))
    publish.upsert_keyed(_target(spark, sf_dir), keyed, "o_orderkey", partition_by=["o_orderstatus"])
    batch = _batch(spark, sf_dir).select(*ORDER_COLUMNS)
    publish.upsert_keyed(batch, keyed, "o_orderkey", partition_by=["o_orderstatus"])
    return keyed.read()


def change_feed_published(spark, sf_dir):
    """Row changes kept with each version of a keyed table: those of its second load."""
    keyed = VersionedDir(spark, storage.new_dir(spark, "fed"))
    publish.upsert_keyed(_target(spark, sf_dir), keyed, "o_orderkey")
    batch = _batch(spark, sf_dir).select(*ORDER_COLUMNS)
    publish.upsert_keyed(batch, keyed, "o_orderkey", feed=True)
    return keyed.read_changes(after=1).select("o_orderkey", "_change_type", "o_totalprice")


def feed_replay(spark, sf_dir):
    """A replica of the first version that applies the net changes of two more, with deleted and inserted again rows."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    key = F.col("o_orderkey")
    repriced = F.when(key % 3 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
    table = VersionedDir(spark, storage.new_dir(spark, "replayed"))
    table.write(_target(spark, sf_dir))
    for new in (orders.where(key % 7 != 0).withColumn("o_totalprice", repriced), orders.where(key % 5 != 0)):
        table.write_changes(merge.change_feed(table.read(), new, ["o_orderkey"], replace=True))
        table.write(new)
    return feeds.apply_feed(table.read(1), table.read_changes(after=1), ["o_orderkey"])


def touched_partitions(spark, sf_dir):
    """Only the event types present in the batch are rewritten: two were loaded up to a time, the others whole."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    table = PartitionedDir(spark, storage.new_dir(spark, "partitioned"), ["event_type"])
    moving = F.col("event_type").isin("view", "click")
    table.write(events.where((F.col("ts") <= _ntz(EVENTS_UNTIL)) | ~moving))
    window = events.where((F.col("ts") > _ntz(EVENTS_FROM)) & moving)
    batch = stage(spark, window.withColumn("value", F.col("value") + 1.0), None)
    merge_into(table, batch, ["event_type", "event_id"])
    return table.read()


def bucketed_upsert(spark, sf_dir):
    """The merge into a table partitioned by a hash of its keys: only the buckets of the batch are rewritten."""
    table = BucketedDir(spark, storage.new_dir(spark, "bucketed"), ["o_orderkey"], 16)
    table.write(_target(spark, sf_dir))
    batch = stage(spark, _batch(spark, sf_dir), None)
    merge_into(table, batch, ["o_orderkey"])
    batch.drop()
    return table.read()


def compact(spark, sf_dir):
    table = VersionedDir(spark, storage.new_dir(spark, "compacted"))
    table.write(_table(spark, sf_dir, "documents").repartition(16))
    files = F.countDistinct("file").alias("files")
    pieces = table.read().select(F.input_file_name().alias("file")).agg(files).first()[0]
    publish.compact(table, file_mb=64)
    after = table.read().select(F.input_file_name().alias("file"), F.length("text").alias("chars"))
    rows = after.agg(files, F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    return rows.select(((F.col("files") < pieces) & (F.col("files") >= 1)).alias("fewer"), "n", "chars")


def compact_clustered(spark, sf_dir):
    """Orders rewritten along a curve over customer and date: a filter on either meets at most half of the files that all met before."""
    table = VersionedDir(spark, storage.new_dir(spark, "clustered"))
    table.write(_table(spark, sf_dir, "orders").repartition(16))

    def met():
        rows = table.read().select(F.input_file_name().alias("file"), "o_custkey", "o_orderdate")
        files = rows.groupBy("file").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("o_custkey", "o_orderdate")], F.max(F.lit(1)).alias("one"))
        spans = rows.agg(F.min("o_custkey").alias("a"), F.max("o_custkey").alias("z"))
        low = F.col("a") + (F.col("z") - F.col("a")) * 0.4
        by_customer = (F.col("min_o_custkey") <= low + (F.col("z") - F.col("a")) * 0.05) & (F.col("max_o_custkey") >= low)
        by_date = (F.col("min_o_orderdate") <= _ntz("1996-03-31")) & (F.col("max_o_orderdate") >= _ntz("1996-03-01"))
        return files.crossJoin(spans).agg(*[(F.count_if(c) / F.count(F.lit(1))).alias(n) for c, n in ((by_customer, "c"), (by_date, "d"))]).first()  # spans is one row

    before = met()
    publish.compact_clustered(table, ["o_custkey", "o_orderdate"], files=64)
    after = met()
    rows = table.read().agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    fewer = F.lit(before["c"] == before["d"] == 1.0 and after["c"] <= 0.5 and after["d"] <= 0.5)
    return rows.select(fewer.alias("fewer"), "n", "keys")


def profile_incremental(spark, sf_dir):
    """A profile kept by day: the first days', then only the later ones', merged; sketches beside exact values."""
    columns = ["event_id", "user_id", "event_type", "ts", "props"]
    events = _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    store = PartitionedDir(spark, storage.new_dir(spark, "profiles"), ["partition"])
    first = F.col("ts") < _ntz(EVENTS_UNTIL)
    store.write(profile.partition_profiles(events.where(first), "day", columns))
    store.write(profile.partition_profiles(events.where(~first), "day", columns))
    found = profile.merged_profile(store.read())
    exact = events.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.countDistinct(c).alias("exact")) for c in columns]).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    off = F.abs(F.col("distinct_values") - F.col("exact")) / F.col("exact")
    return found.join(exact, "column").select("column", "n", "nulls", "width", (off <= profile.DISTINCT_ERROR).alias("near"))


def dsv_normalize(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    holed = events.select(
        F.col("event_id").alias("EVENT_ID"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("Event_Type")
    )
    return delimited.normalize(holed)


def dsv_export(spark, sf_dir):
    """Whole documents through delimited files and back."""
    path = storage.new_dir(spark, "export")
    lang = F.when(F.col("lang") != "en", F.col("lang")).alias("lang")
    documents = _table(spark, sf_dir, "documents").select("doc_id", lang, "source", "text")
    delimited.export_delimited(documents, path, delimiter="|")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in documents.columns])
    options = {"sep": "|", "header": True, "quote": '"', "escape": '"', "multiLine": True, "emptyValue": "", "nullValue": "\0"}
    return spark.read.schema(schema).options(**options).csv(path).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", F.sha2("text", 256).alias("text_hash")
    )


# whole runs


def _run_sync(spark, sf_dir, target=None, broken=False, **changes):
    base = storage.new_dir(spark, "sync")
    VersionedDir(spark, f"{base}/orders_copy").write(_target(spark, sf_dir) if target is None else target)
    entry = ("orders", "sales", "orders.parquet", LAKE, "copy", "orders_copy", " o_orderkey ")
    without_keys = ("broken", *entry[1:6], " , ")
    entries = [entry, without_keys] if broken else [entry]
    spark.createDataFrame(entries, control.REGISTRY_SCHEMA).write.parquet(f"{base}/registry")
    control.append_log(spark, f"{base}/log", "orders", control.SUCCESS, _micros(spark, BATCH_FROM))
    settings = SyncSettings(
        registry=f"{base}/registry",
        log=f"{base}/log",
        audit_col="o_orderdate",
        paths={"sales": sf_dir, "copy": base},
        fail_fast=not broken,
        **changes,
    )
    run_all(spark, settings, "sales", "orders.parquet", LAKE)
    return VersionedDir(spark, f"{base}/orders_copy").read(), control.read_log(spark, f"{base}/log")


def sync_run(spark, sf_dir):
    """Registry row to log row: the target was loaded up to TARGET_UNTIL, the log says BATCH_FROM.

    The run reads rows after the logged watermark, merges them, and logs the new watermark.
    """
    return _run_sync(spark, sf_dir)[0]


def sync_log(spark, sf_dir):
    """The log after such a run, and after one of a registry entry without merge keys, which fails."""
    runs = _run_sync(spark, sf_dir, broken=True, broadcast_limit=0)[1]
    return runs.select("sync_key", "current_status", "watermark_value", "msg")


def sync_from_target(spark, sf_dir):
    """Rows from the target's own newest row on."""
    return _run_sync(spark, sf_dir, window="target")[0]


def validate_and_sync(spark, sf_dir):
    """Months in which source and target differ are replaced: the target lacks the rows after TARGET_UNTIL, has
    stale prices in finished orders before BATCH_FROM, and every pending order twice, once under a key of no source row."""
    target = _target(spark, sf_dir)
    stale = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") <= _ntz(BATCH_FROM))
    surplus = target.where(F.col("o_orderstatus") == "P").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    price = F.when(stale, F.col("o_totalprice") - 1.0).otherwise(F.col("o_totalprice"))
    wrong = target.withColumn("o_totalprice", price).unionByName(surplus)
    return _run_sync(spark, sf_dir, target=wrong, load_type="VALIDATE_AND_SYNC")[0]


def stream_upsert(spark, sf_dir):
    """Three time ranges of the events arrive as a stream, out of time order, each as one micro-batch of many files;
    the target keeps each user's newest event."""
    base = storage.new_dir(spark, "stream")
    events = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    early, late = F.col("ts") <= _ntz(EVENTS_FROM), F.col("ts") > _ntz(EVENTS_UNTIL)
    target = VersionedDir(spark, f"{base}/out")
    for part in (late, early, ~(early | late)):
        events.where(part).write.mode("append").parquet(f"{base}/in")
        # From the checkpoint on: the files that have come since.
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        upsert_stream(stream, target, ["user_id"], f"{base}/checkpoint", order_by=["ts", "event_id"]).awaitTermination()
    return target.read()


def stream_state_latest(spark, sf_dir):
    """The same ranges, out of time order, settled in the stream's state: only changes newer than all seen are merged."""
    base = storage.new_dir(spark, "settled")
    events = _table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", "value")
    early, late = F.col("ts") <= _ntz(EVENTS_FROM), F.col("ts") > _ntz(EVENTS_UNTIL)
    target = VersionedDir(spark, f"{base}/out")
    for part in (late, early, ~(early | late)):
        events.where(part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        settled_upsert_stream(
            stream, target, ["user_id"], f"{base}/checkpoint", time="ts", order_by=["ts", "event_id"], delay="400 days"
        ).awaitTermination()
    return target.read().withColumn("ts", F.col("ts").cast("timestamp_ntz"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        incremental_filter, range_extract, full_load, sql_passthrough, filter_in_list, regex_filter,
        key_first_projection, stride_counts, split_quantiles, partition_bounds, partition_plan_rows, partition_plan_size,
        repartition_up, last_success_watermark, job_of_step, single_row_lookup, steps_ordered_topk,
        merge_upsert, merge_heavy_keys, merge_bloom, merge_target_only_cols, merge_null_keys, delete_insert, merge_stats,
        change_feed, change_feed_replace, dedup_latest, merge_latest, reconcile_monthly, reconcile_daily,
        resync_rows, validate_drilldown, reconcile_sketch, watermark_as_of, batch_watermark, target_watermark, table_counts, dq_fail_flag, pk_violations, string_width,
        latest_version, period_bucket, kv_parse, json_extract, config_parse, split_keys, empty_clone,
        publish_merge_schema, schema_diff, feature_upsert, change_feed_published, feed_replay, touched_partitions, bucketed_upsert, compact, compact_clustered, profile_incremental,
        dsv_normalize, dsv_export,
        sync_run, sync_log, sync_from_target, validate_and_sync, stream_upsert, stream_state_latest,
    )
}
QUERIES["audit_key"] = audit_keys
