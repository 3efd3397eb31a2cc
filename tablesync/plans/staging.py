"""Merge staged batches into tables of files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesync import storage
from tablesync.operators.merge import (
    ACTION,
    action_counts,
    delete_insert,
    merge_with_actions,
    unique_by_key,
)
from tablesync.sinks.bucketed import BucketedDir
from tablesync.sinks.ddl import with_missing
from tablesync.sinks.partitioned import PartitionedDir
from tablesync.sinks.staged import BROADCAST_LIMIT_BYTES, Staged, merge_options, stage, watch
from tablesync.sinks.versioned import VersionedDir

Table = VersionedDir | PartitionedDir | BucketedDir
SHUFFLE_PART_BYTES = 64 << 20  # of files at rest; a shuffled partition is a few times that

__all__ = ["BROADCAST_LIMIT_BYTES", "Staged", "merge_into", "merge_options", "replace_keys", "replace_rows", "shuffle_parts", "stage", "watch"]


def shuffle_parts(spark: SparkSession, table: Table) -> int:
    """Shuffle partitions for rewriting a table: never fewer than configured, more for a large table."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, math.ceil(table.rewrite_bytes() / SHUFFLE_PART_BYTES))


def merge_into(
    table: Table,
    batch: Staged,
    keys: Sequence[str],
    *,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    evolve: bool = False,
) -> dict[str, int]:
    """Upsert a staged batch into a table; statistics are observed during the write.

    ``kept`` counts rows rewritten unchanged: the whole rest of a versioned table, the rest of the
    touched partitions of a partitioned one.
    """
    seen = Observation()
    if not table.exists():
        first = unique_by_key(batch.df, keys, on_duplicate, order_by)
        table.replace(first, finish=lambda df: df.observe(seen, F.count(F.lit(1)).alias("inserted")))
        return {"inserted": seen.get["inserted"], "updated": 0, "unchanged": 0, "kept": 0}
    target = table.rows_to_merge(batch.df, keys)
    if evolve:
        target = with_missing(target, batch.df)
    merged = merge_with_actions(
        target,
        batch.df,
        keys,
        on_duplicate=on_duplicate,
        order_by=order_by,
        **merge_options(target, batch, keys, broadcast_limit, table.rewrite_bytes()),
    )
    parts = shuffle_parts(table.spark, table)
    with storage.conf(table.spark, spark__sql__adaptive__coalescePartitions__initialPartitionNum=parts):
        table.write(merged, finish=lambda df: df.observe(seen, *action_counts()).drop(ACTION))
    return dict(seen.get)


def replace_keys(
    table: Table, batch: Staged, keys: Sequence[str], broadcast_limit: int = BROADCAST_LIMIT_BYTES, evolve: bool = False
) -> dict[str, int]:
    """Delete the rows whose keys are in a staged batch and insert the batch, repeated keys and all."""
    target = table.rows_to_merge(batch.df, keys)
    if evolve:
        target = with_missing(target, batch.df)
    changed = delete_insert(target, batch.df, keys, **merge_options(target, batch, keys, broadcast_limit))
    parts = shuffle_parts(table.spark, table)
    with storage.conf(table.spark, spark__sql__adaptive__coalescePartitions__initialPartitionNum=parts):
        table.write(changed)
    return {"inserted": batch.rows}


def replace_rows(table: Table, keep: DataFrame, rows: DataFrame) -> None:
    """Make the table some of its own rows and others. A table replaced in place is staged first, so that nothing is read
    while it is replaced; a new version is written at once."""
    if isinstance(table, VersionedDir):
        table.write(keep.unionByName(rows))
        return
    changed = stage(table.spark, keep.unionByName(rows), None, gather=False)
    try:
        table.replace(changed.df)
    finally:
        changed.drop()
