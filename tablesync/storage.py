"""Small helpers around the Hadoop file system that Spark itself uses."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, p = file_system(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, p = file_system(spark, path)
    fs.create(p, True).close()


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = file_system(spark, pattern)
    found = fs.globStatus(p) or []
    return [status.getPath().toString() for status in found]


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or one in the warehouse where that is not set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tablesync-scratch"


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder. Nothing is created until something is written."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def is_path(ref: str) -> bool:
    return "/" in ref


@contextmanager
def conf(spark: SparkSession, **values):
    """Session settings (dots written as ``__``) for the jobs started inside the block."""
    settings = {key.replace("__", "."): str(value) for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
