"""A table as a directory of complete versions.

Overwriting a path that the same plan reads loses the data, so each write goes to a new
``version-<n>`` directory. Spark writes ``_SUCCESS`` last; that marker is the commit. A crash leaves
an unmarked directory that readers skip and the next write replaces. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import storage
from tablesync.operators.skew import name
from tablesync.sinks.partitioned import Finish

DONE = "_SUCCESS"
PARTITION = "partition"  # metadata: place among the partition columns


class VersionedDir:
    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def path_of(self, version: int) -> str:
        return f"{self.path}/version-{version:08d}"

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        marks = storage.glob_names(self.spark, f"{self.path}/version-*/{DONE}")
        return sorted(int(m.rsplit("/", 2)[1].removeprefix("version-")) for m in marks)

    def current(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def read(self, version: int | None = None) -> DataFrame:
        number = self.current() if version is None else version
        if number is None:
            raise FileNotFoundError(f"no committed version below {self.path}")
        reader = self.spark.read.format(self.fmt)
        if storage.exists(self.spark, self._schema_path(number)):
            plain = [T.StructField(f.name, f.dataType, f.nullable) for f in reader.load(self._schema_path(number)).schema.fields]
            reader = reader.schema(T.StructType(plain))
        return reader.load(self.path_of(number))

    def _schema_path(self, version: int) -> str:
        """Empty copy of a partitioned version: directory names alone do not tell the columns' types."""
        return f"{self.path}/schema-{version:08d}"

    def exists(self) -> bool:
        return self.current() is not None

    def rows_to_merge(self, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        """A merge makes a whole new version."""
        return self.read()

    def rewrite_bytes(self) -> int:
        return storage.size_bytes(self.spark, self.path_of(self.current()))

    def replace(self, df: DataFrame, finish: Finish = None) -> None:
        self.write(df, finish=finish)

    def layout(self) -> list[str]:
        """Partition columns of the current version."""
        number = self.current()
        if number is None or not storage.exists(self.spark, self._schema_path(number)):
            return []
        fields = self.spark.read.format(self.fmt).load(self._schema_path(number)).schema.fields
        marked = [f for f in fields if PARTITION in f.metadata]
        return [f.name for f in sorted(marked, key=lambda f: f.metadata[PARTITION])]

    def write(
        self, df: DataFrame, partition_by: Sequence[str] | None = None, finish: Finish = None, check: Callable[[DataFrame], None] | None = None
    ) -> int:
        """Write the next version, in the current one's partitions unless others (or none, ``()``) are given. Rows are
        gathered by partition, a large one in several files. ``finish`` as for ``PartitionedDir.write``. ``check`` gets the
        written rows before readers do; if it raises, the version does not count."""
        columns = self.layout() if partition_by is None else list(partition_by)
        number = (self.current() or 0) + 1
        if columns:
            df = df.hint("rebalance", *[F.col(name(c)) for c in columns])
        finished = finish(df) if finish else df
        writer = finished.write.format(self.fmt).mode("overwrite")
        if columns:
            place = {c.lower(): i for i, c in enumerate(columns)}
            marked = [
                F.col(name(f.name)).alias(f.name, metadata={**f.metadata, PARTITION: place[f.name.lower()]})
                if f.name.lower() in place
                else F.col(name(f.name))
                for f in finished.schema.fields
            ]
            empty = self.spark.createDataFrame([], finished.schema).select(*marked)
            empty.write.format(self.fmt).mode("overwrite").save(self._schema_path(number))
            writer = writer.partitionBy(*columns)
        if check is None:
            writer.save(self.path_of(number))
        else:  # the marker comes after the check
            writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").save(self.path_of(number))
            check(self.spark.read.format(self.fmt).schema(finished.schema).load(self.path_of(number)))
            storage.touch(self.spark, f"{self.path_of(number)}/{DONE}")
        return number

    def changes_path(self, version: int) -> str:
        return f"{self.path}/changes-{version:08d}"

    def write_changes(self, feed: DataFrame) -> None:
        """Row changes of the version about to be written; they count once that version is committed."""
        feed.write.format(self.fmt).mode("overwrite").save(self.changes_path((self.current() or 0) + 1))

    def read_changes(self, after: int = 0) -> DataFrame | None:
        """Changes of the committed versions after ``after``, with ``_commit_version``; None without any.

        An error when versions after ``after`` have been deleted: what is left would not be all changes.
        """
        found = self.versions()
        if found and after + 1 < found[0]:
            raise LookupError(f"the changes of versions {after + 1} to {found[0] - 1} are gone; read the whole table again")
        feeds = [
            self.spark.read.format(self.fmt).load(self.changes_path(v)).withColumn("_commit_version", F.lit(v))
            for v in found
            if v > after and storage.exists(self.spark, self.changes_path(v))
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds) if feeds else None

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed versions, with their changes."""
        if keep < 1:
            raise ValueError("keep at least the current version")
        old = self.versions()[:-keep]
        for number in old:
            storage.delete(self.spark, self.path_of(number))
            storage.delete(self.spark, self._schema_path(number))
            storage.delete(self.spark, self.changes_path(number))
        return old
