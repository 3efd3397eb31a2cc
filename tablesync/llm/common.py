"""Column expressions and staging shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.storage import conf, new_dir

#: Java pattern of white space between words.
GAP = r"[\x20\x09-\x0D]+"
#: Java and RE2 pattern of one word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; NULL gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(df: DataFrame, column: str) -> Column:
    """A column by its exact name, also when it holds dots."""
    return df[f"`{column}`"]


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written once to the shared folder and read back: work is done once and survives lost executors.
    The shuffle files of the write go with its end and not whenever the driver collects its garbage."""
    path = new_dir(df.sparkSession, purpose)
    with conf(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows (all, if there are no more), chosen by a hash of the key columns: the same rows in
    every run, spread over all partitions."""
    total = df.count()
    if total <= rows:
        return df
    part = F.pmod(F.xxhash64(*(named(df, k) for k in keys)), F.lit(1 << 30))
    return df.filter(part < int((1 << 30) * rows / total))
