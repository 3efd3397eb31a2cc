"""A partitioned table whose merges rewrite only the partitions a batch touches."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import storage
from tablesync.operators.skew import name

Finish = Callable[[DataFrame], DataFrame] | None
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how Spark names the partition of NULL


def glob_text(column: str) -> str:
    """A column name as Spark writes it in directories, for a glob pattern."""
    return column if re.fullmatch(r"[A-Za-z0-9_ .$-]+", column) else "*"


class PartitionedDir:
    """A directory of partitions, replaced one by one in place.

    The partition columns must belong to the merge keys. Then no key can move between partitions, so
    untouched ones stay right, no partition becomes empty, and running the same batch again after a
    crash between two replacements gives the same table. Readers may see a merge half done; where that
    matters, or where keys do move, use a ``VersionedDir``.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str], fmt: str = "parquet"):
        if not partition_by:
            raise ValueError("partition columns are required")
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.partition_by = list(partition_by)

    @property
    def _schema_path(self) -> str:
        """Empty copy of the table: directory names alone do not tell the partition columns' types."""
        return f"{self.path}/_schema"

    def exists(self) -> bool:
        return storage.exists(self.spark, self._schema_path)

    def adopt(self, schema: T.StructType) -> None:
        """Take over a directory that something else wrote, with the types its columns should have."""
        self._write_schema(schema)

    def _write_schema(self, schema: T.StructType) -> None:
        empty = self.spark.createDataFrame([], schema)
        empty.write.format(self.fmt).mode("overwrite").save(self._schema_path)

    @property
    def _pending_path(self) -> str:
        """There while the table is being replaced: what lies in it then is ours, complete or not."""
        return f"{self.path}.pending"

    def _check_ours(self) -> None:
        """Never overwrite a directory of unknown origin."""
        if not self.exists() and not storage.exists(self.spark, self._pending_path) and storage.glob_names(self.spark, f"{self.path}/[!_.]*"):
            raise FileExistsError(f"{self.path} holds files of unknown origin: adopt the directory or empty it")

    def read(self) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        return reader.schema(reader.load(self._schema_path).schema).load(self.path)

    def rows_to_merge(self, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        missing = [c for c in self.partition_by if c.lower() not in {k.lower() for k in keys}]
        if missing:
            raise ValueError(f"partition columns {missing} are not merge keys; use a VersionedDir")
        found = self.touched(batch)
        reader = self.spark.read.format(self.fmt)
        schema = reader.load(self._schema_path).schema
        if not found:
            return self.spark.createDataFrame([], schema)
        return reader.schema(schema).option("basePath", self.path).load(found)

    def touched(self, batch: DataFrame) -> list[str]:
        """Directories of the table's partitions that the batch has rows in.

        The driver holds the table's directory names, as any listing of the table does, and gets back those that
        are also in the batch; only these are read, however many there are.
        """
        listed = storage.glob_names(self.spark, "/".join([self.path, *[f"{glob_text(c)}=*" for c in self.partition_by]]))
        if not listed:
            return []
        depth = len(self.partition_by)
        names = [f"p{i}" for i in range(depth)]
        rows = [(*[unquote(part.split("=", 1)[1]) for part in path.split("/")[-depth:]], path) for path in listed]
        there = self.spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*names, "path")))
        text = [F.coalesce(F.nullif(F.col(name(c)).cast("string"), F.lit("")), F.lit(NULL_PARTITION)) for c in self.partition_by]
        wanted = batch.select(*[t.alias(n) for t, n in zip(text, names)]).distinct()
        return [r["path"] for r in there.join(wanted, names, "left_semi").select("path").collect()]

    def rewrite_bytes(self) -> int:
        return storage.size_bytes(self.spark, self.path)

    def _save(self, df: DataFrame, overwrite: str, finish: Finish) -> None:
        self._check_ours()
        gathered = df.hint("rebalance", *[F.col(name(c)) for c in self.partition_by])
        finished = finish(gathered) if finish else gathered
        replaces = overwrite == "static" or not self.exists()
        if replaces:
            self.spark.createDataFrame([], finished.schema).write.format(self.fmt).mode("overwrite").save(self._pending_path)
        (
            finished.write.format(self.fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(*self.partition_by)
            .save(self.path)
        )
        self._write_schema(finished.schema)
        if replaces:
            storage.delete(self.spark, self._pending_path)

    def write(self, df: DataFrame, finish: Finish = None) -> None:
        """Replace the partitions that have rows in ``df``. A large partition is split over several files.

        ``finish`` is applied after the last shuffle. Metrics observed there count every row once, even
        when a lost executor makes Spark repeat earlier stages.
        """
        self._save(df, "dynamic", finish)

    def replace(self, df: DataFrame, finish: Finish = None) -> None:
        """Replace the whole table by rows that do not come from it."""
        self._save(df, "static", finish)

    def vacuum(self, keep: int = 0) -> None:
        """Nothing is kept beside the current partitions."""
