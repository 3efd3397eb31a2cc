"""A keyed table partitioned by a hash of its keys, so that merges rewrite only the buckets a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.bloom import key_values
from tablesync.operators.merge import resolve
from tablesync.operators.skew import name
from tablesync.sinks.partitioned import Finish, PartitionedDir

BUCKET = "__bucket"
COUNT = "buckets"  # metadata of the bucket column: how many there are


class BucketedDir(PartitionedDir):
    """A ``PartitionedDir`` with a bucket column of its own, which readers do not see.

    ``buckets`` counts for the first write; a table keeps its number. Choose it so that a bucket is some 256 MB. A
    row's bucket follows from its keys, so no row can change it, and Spark's dynamic overwrite replaces the buckets a
    merge has read. Rows with NULL in all keys share a bucket, in several files.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64, fmt: str = "parquet"):
        if not keys or buckets < 1:
            raise ValueError("keys and a positive number of buckets are required")
        super().__init__(spark, path, [BUCKET], fmt)
        self.keys, self.buckets = list(keys), buckets

    def _stored(self) -> T.StructType | None:
        """The table's schema with its bucket column; the number of buckets comes with it."""
        if not self.exists():
            return None
        schema = self.spark.read.format(self.fmt).load(self._schema_path).schema
        self.buckets = schema[BUCKET].metadata.get(COUNT, self.buckets)
        return schema

    def _write_schema(self, schema: T.StructType) -> None:
        marked = [T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, COUNT: self.buckets} if f.name == BUCKET else f.metadata) for f in schema.fields]
        super()._write_schema(T.StructType(marked))

    def _placed(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows with their buckets, by the keys in the table's types."""
        types = {f.name.lower(): f.dataType for f in schema.fields}
        spelled = resolve(df, self.keys)
        typed = df.select(*[F.col(name(k)).cast(types[k.lower()]).alias(k) if k in spelled else F.col(name(k)) for k in df.columns])
        return typed.withColumn(BUCKET, F.pmod(F.xxhash64(*key_values(typed, spelled)), F.lit(self.buckets)).cast("int"))

    def read(self) -> DataFrame:
        self._stored()
        return super().read().drop(BUCKET)

    def rows_to_merge(self, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows of the buckets that the batch has keys in; the write that follows replaces these."""
        if {k.lower() for k in keys} != {k.lower() for k in self.keys}:
            raise ValueError(f"merge keys {list(keys)} are not those of the buckets, {self.keys}")
        return super().rows_to_merge(self._placed(batch, self._stored()), [*keys, BUCKET]).drop(BUCKET)

    def _save(self, df: DataFrame, overwrite: str, finish: Finish) -> None:
        stored = self._stored()
        types = stored if stored is not None and overwrite == "dynamic" else df.schema
        super()._save(self._placed(df, types), overwrite, finish)
