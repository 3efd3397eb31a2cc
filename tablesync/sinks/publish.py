"""Publish frames as managed or keyed tables: modes, schema evolution, keys, compaction."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import storage
from tablesync.operators.clustering import BITS, clustered
from tablesync.operators.merge import CHANGE_TYPE, apply_batch, change_feed, merge_images, resolve, unique_by_key
from tablesync.operators.skew import any_null, name
from tablesync.sinks.ddl import add_missing_columns, with_missing
from tablesync.sinks.staged import merge_options, stage
from tablesync.sinks.versioned import VersionedDir

KEY_PROPERTY = "tablesync.primary_key"
TIME_KEY_PROPERTY = "tablesync.timestamp_keys"
MODES = ("overwrite", "append", "ignore", "error")


def _as_list(columns: str | Sequence[str] | None) -> list[str]:
    if not columns:
        return []
    return [columns] if isinstance(columns, str) else list(columns)


def _quoted(table: str) -> str:
    return ".".join(name(p) for p in table.split("."))


def key_first(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    keys = resolve(df, _as_list(keys))
    return df.select(*[F.col(name(c)) for c in [*keys, *[c for c in df.columns if c not in keys]]])


def empty_clone(
    spark: SparkSession,
    table: str,
    new_table: str,
    columns: Sequence[str] = (),
    replace: bool = True,
    location: str | None = None,
) -> None:
    """A table of the same columns (or some of them) and no rows; ``replace=False`` keeps an existing one.

    ``location`` makes it an external table, for sessions whose warehouse folder is not shared.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(new_table)}")
    elif spark.catalog.tableExists(new_table):
        return
    if columns:
        writer = spark.table(table).select(*[name(c) for c in columns]).limit(0).write
        (writer.option("path", location) if location else writer).saveAsTable(new_table, format="parquet")
    else:
        place = "" if location is None else " LOCATION '{}'".format(location.replace("'", "\\'"))
        spark.sql(f"CREATE TABLE {_quoted(new_table)} LIKE {_quoted(table)} USING parquet{place}")


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key is NULL or repeated: one aggregate over the key columns."""
    columns = [F.col(name(k)) for k in keys]
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    bad = counts.agg(F.sum(F.when(any_null(keys), F.col("n"))).alias("nulls"), F.count_if(~any_null(keys) & (F.col("n") > 1)).alias("again")).first()
    if bad["nulls"]:
        raise ValueError(f"{bad['nulls']} rows have a NULL in key {list(keys)}")
    if bad["again"]:
        raise ValueError(f"key {list(keys)} is not unique")


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, failing while it is evaluated if a key part is NULL."""
    message = F.lit(f"NULL in key ({', '.join(keys)})")
    return df.where(F.when(any_null(keys), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def publish_table(
    df: DataFrame,
    table: str,
    *,
    mode: str = "overwrite",
    schema_option: str = "overwriteSchema",
    primary_keys: str | Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Write a catalog table.

    ``mergeSchema`` keeps the columns of both sides: appending alters the table and adds files, so the
    existing data is not rewritten. ``overwriteSchema`` lets an overwrite replace the schema. Keys
    come first and are kept in the table properties; rows that would break them, also against the rows an
    append adds to, are found in a staged copy, before any becomes visible.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if schema_option not in ("overwriteSchema", "mergeSchema"):
        raise ValueError("schema_option must be 'overwriteSchema' or 'mergeSchema'")
    spark = df.sparkSession
    keys = _as_list(primary_keys)
    if keys:
        df = key_first(df, keys)
    present = spark.catalog.tableExists(table)
    if present and mode == "ignore":
        return
    staged = None
    if keys:
        keys = resolve(df, keys)
        staged = storage.new_dir(spark, "publish")
        df.write.parquet(staged)
        df = spark.read.schema(df.schema).parquet(staged)
    try:
        if keys:
            check_keys(df, keys)
            if present and mode == "append":
                _check_new_keys(df, spark.table(table), keys)
        _write_table(spark, df, table, present, mode, schema_option, partition_by, fmt)
    finally:
        if staged:
            storage.delete(spark, staged)
    if comment:
        escaped = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {_quoted(table)} IS '{escaped}'")
    if keys:
        spark.sql(f"ALTER TABLE {_quoted(table)} SET TBLPROPERTIES ('{KEY_PROPERTY}' = '{','.join(keys)}')")


def _check_new_keys(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> None:
    old = table.select(*[F.col(name(c)).alias(k) for c, k in zip(resolve(table, keys), keys)])
    if not df.select(*[name(k) for k in keys]).join(old, list(keys), "left_semi").isEmpty():
        raise ValueError(f"key {list(keys)} is not unique: the table has some of the new keys")


def _write_table(
    spark: SparkSession, df: DataFrame, table: str, present: bool, mode: str, schema_option: str, partition_by: Sequence[str], fmt: str
) -> None:
    if present and mode == "append":
        if schema_option == "mergeSchema":
            add_missing_columns(spark, table, df)
            df = with_missing(df, spark.table(table))
        target_columns = spark.table(table).columns
        surplus = {c.lower() for c in df.columns} ^ {c.lower() for c in target_columns}
        if surplus:
            raise ValueError(f"columns differ from {table}: {sorted(surplus)}; append with mergeSchema")
        df.select(*[name(c) for c in target_columns]).write.insertInto(table)
    else:
        if present and mode == "overwrite" and schema_option == "mergeSchema":
            existing = spark.table(table)
            df = with_missing(df, existing)
        writer = df.write.format(fmt).mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(table)


def upsert_keyed(
    df: DataFrame,
    directory: VersionedDir,
    primary_keys: str | Sequence[str],
    *,
    timestamp_keys: str | Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
    mode: str = "merge",
    table: str | None = None,
    feed: bool = False,
    **options,
) -> int:
    """Create or upsert a keyed table and return its new version.

    Rows are identified by primary and timestamp keys together. Columns new to the table are added.
    ``overwrite`` replaces all rows. With ``table`` the catalog entry is pointed at the new version.
    ``feed`` also writes the row changes, for ``VersionedDir.read_changes``. ``df`` is staged, so it is evaluated
    once, and its measured size picks the join. Partitions stay as they are unless others are given.
    """
    keys = [*_as_list(primary_keys), *_as_list(timestamp_keys)]
    if not _as_list(primary_keys):
        raise ValueError("a keyed table needs primary keys")
    if mode not in ("merge", "overwrite"):
        raise ValueError("mode must be 'merge' or 'overwrite'")
    spark = df.sparkSession
    batch = stage(spark, require_keys(key_first(df, keys), keys), None)
    try:
        existing = None if directory.current() is None else with_missing(key_first(directory.read(), keys), batch.df)
        duplicates = {k: v for k, v in options.items() if k in ("on_duplicate", "order_by")}
        if existing is not None:
            options = {**merge_options(existing, batch, keys), **options}
        if feed and mode == "merge" and existing is not None:
            version = _write_with_changes(directory, merge_images(existing, batch.df, keys, **options), partition_by)
        else:
            if mode == "overwrite" or existing is None:
                result = unique_by_key(batch.df, keys, **duplicates)
            else:
                result = apply_batch(existing, batch.df, keys, **options)
            if feed:
                before = batch.df.limit(0) if existing is None else existing
                directory.write_changes(change_feed(before, batch.df, keys, replace=mode == "overwrite", **options))
            version = directory.write(result, partition_by)
    finally:
        batch.drop()
    if table:
        properties = {KEY_PROPERTY: ",".join(_as_list(primary_keys)), TIME_KEY_PROPERTY: ",".join(_as_list(timestamp_keys))}
        register(directory, table, properties)
    return version


def _write_with_changes(directory: VersionedDir, images: DataFrame, partition_by: Sequence[str] | None) -> int:
    """Table and feed from one joined result: it is staged by kind of change, and either reads the kinds it needs."""
    spark = directory.spark
    path = storage.new_dir(spark, "images")
    images.write.partitionBy(CHANGE_TYPE).parquet(path)
    try:
        held = spark.read.schema(images.schema).parquet(path).select(*[name(c) for c in images.columns])
        directory.write_changes(held.where(F.col(CHANGE_TYPE) != "keep"))
        rows = held.where(F.col(CHANGE_TYPE).isin("keep", "insert", "update_postimage")).drop(CHANGE_TYPE)
        return directory.write(rows, partition_by)
    finally:
        storage.delete(spark, path)


def register(directory: VersionedDir, table: str, properties: dict[str, str] | None = None) -> None:
    """Point an external catalog table at the current version; a changed schema re-creates the entry."""
    spark = directory.spark
    path = directory.path_of(directory.current()).replace("'", "\\'")
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == directory.read().schema:
            spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION '{path}'")
            if listed:
                spark.sql(f"ALTER TABLE {_quoted(table)} SET TBLPROPERTIES ({listed})")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {_quoted(table)}")
    clause = f" TBLPROPERTIES ({listed})" if listed else ""
    spark.sql(f"CREATE TABLE {_quoted(table)} USING {directory.fmt} LOCATION '{path}'{clause}")


def compact_clustered(directory: VersionedDir, columns: Sequence[str], file_mb: int = 128, files: int | None = None, bits: int = BITS) -> int:
    """Rewrite the current version along a space-filling curve of the columns, in files of about ``file_mb`` or in
    so many files, and return the new version. A filter on any of the columns then meets few files and row groups.
    Partitions are given up."""
    if files is None:
        size = storage.size_bytes(directory.spark, directory.path_of(directory.current()))
        files = max(1, math.ceil(size / (file_mb << 20)))
    return directory.write(clustered(directory.read(), columns, files, bits), ())


def compact(directory: VersionedDir, file_mb: int = 128, partition_by: Sequence[str] | None = None) -> int:
    """Rewrite the current version in files of about ``file_mb`` and return the new version.

    The partitions stay as they are unless others are given. Without any, tasks are only merged, with no
    shuffle. With them, rows are gathered by partition, and a partition larger than a file is split over
    several tasks.
    """
    spark = directory.spark
    df = directory.read()
    columns = directory.layout() if partition_by is None else list(partition_by)
    if columns:
        with storage.conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=f"{file_mb}m"):
            return directory.write(df, columns)
    size = storage.size_bytes(spark, directory.path_of(directory.current()))
    return directory.write(df.coalesce(max(1, math.ceil(size / (file_mb << 20)))), ())
