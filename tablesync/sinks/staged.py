"""Evaluate a batch once: write it to the shared folder and measure it on the way."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import storage
from tablesync.operators.bloom import fits
from tablesync.operators.skew import heavy_key_hashes, name
from tablesync.sources.lake import micros

BROADCAST_LIMIT_BYTES = 64 << 20  # of values as they lie in memory, see row_bytes


@dataclass(frozen=True)
class Staged:
    """A batch at rest with its row count, newest audit value (microseconds) and size in memory."""

    df: DataFrame
    path: str
    rows: int
    watermark_us: int | None
    bytes: int

    def drop(self) -> None:
        storage.delete(self.df.sparkSession, self.path)


def row_bytes(schema: T.StructType) -> Column:
    """Size of a row's values in memory. Files on disk say little: they may be compressed a hundredfold."""
    size = F.lit(16 * (len(schema.fields) + 1))
    for f in schema.fields:
        c = F.col(name(f.name))
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            c = F.to_json(F.struct(c))
        elif not isinstance(f.dataType, (T.StringType, T.BinaryType)):
            continue
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return size.cast("bigint")


def watch(audit_col: str | None) -> tuple[Callable[[DataFrame], DataFrame], Observation]:
    """Something that observes row count and newest audit value of a frame as it is written."""
    seen = Observation()
    newest = F.lit(None).cast("bigint") if audit_col is None else micros(F.col(name(audit_col)))
    metrics = [F.count(F.lit(1)).alias("rows"), F.max(newest).alias("watermark_us")]
    return lambda df: df.observe(seen, *metrics), seen


def stage(spark: SparkSession, df: DataFrame, audit_col: str | None, gather: bool = True) -> Staged:
    """Write the batch once; everything after reads the staged copy and never the source again.

    ``gather`` brings the few rows a filter leaves in each input split together, so that a small batch
    out of a huge table is not staged as one tiny file per split. Skewed pieces are split again.
    """
    path = storage.new_dir(spark, "stage")
    watched, seen = watch(audit_col)
    measured = Observation()
    gathered = watched(df.hint("rebalance") if gather else df)
    gathered.observe(measured, F.sum(row_bytes(df.schema)).alias("bytes")).write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    return Staged(staged, path, seen.get["rows"], seen.get["watermark_us"], measured.get["bytes"] or 0)


def merge_options(
    target: DataFrame, batch: Staged, keys: Sequence[str], limit: int = BROADCAST_LIMIT_BYTES, target_bytes: int = 0
) -> dict:
    """Join plan by measured size: broadcast a small batch, else shuffle around the target's heavy keys. Where the
    target's files are larger than the batch and a filter of its keys is small enough, only rows that may match are shuffled."""
    if batch.bytes <= limit:
        return {"small_batch": True}
    options = {"heavy": heavy_key_hashes(target, keys)}
    if target_bytes > batch.bytes and fits(batch.rows, limit):
        options["bloom"] = batch.rows
    return options
