"""Column profiles of a table that are kept by partition and merged when read.

A partition's profile is one row for each column: counts, widths, and two sketches that merge, of distinct values and of
quantiles. So a new profile of a table reads its new partitions only, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.quantiles import K, whole_number
from tablesync.operators.skew import name

#: Size of the sketch of distinct values, a power of two; its estimate is within ``DISTINCT_ERROR`` in 99 of 100 cases.
LG_K = 14
DISTINCT_ERROR = 0.025


def _ordered(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _facts(df: DataFrame, column: str) -> Column:
    c, dtype = F.col(name(column)), df.schema[column].dataType
    text = c.cast("string")
    none = F.lit(None).cast("binary")
    return F.struct(
        F.lit(column).alias("column"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(c.isNull()).alias("nulls"),
        F.max(F.length(text)).cast("bigint").alias("width"),
        F.hll_sketch_agg(text, F.lit(LG_K)).alias("distinct_sketch"),
        (F.kll_sketch_agg_bigint(whole_number(df, column), F.lit(K)) if _ordered(dtype) else none).alias("rank_sketch"),
    )


def partition_profiles(df: DataFrame, partition: str, columns: Sequence[str]) -> DataFrame:
    """(partition, column, n, nulls, width, sketches) for each partition of the frame: one aggregate, combined in each
    task before its shuffle. ``width`` is that of the value as text."""
    facts = F.array(*[_facts(df, c) for c in columns])
    found = df.groupBy(F.col(name(partition)).alias("partition")).agg(facts.alias("f"))
    return found.select("partition", F.explode("f").alias("f")).select("partition", "f.*")


def merged_profile(profiles: DataFrame) -> DataFrame:
    """(column, n, nulls, width, distinct_values, median) of the whole table from its partitions' profiles. ``median`` is a
    whole number (days or microseconds for dates and times) and NULL for columns without one."""
    parts = profiles.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.max("width").alias("width"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.kll_merge_agg_bigint("rank_sketch").alias("ranks"),
    )
    known = F.kll_sketch_get_n_bigint("ranks") > 0
    median = F.when(known, F.kll_sketch_get_quantile_bigint(F.when(known, F.col("ranks")), F.lit(0.5)))
    return parts.select("column", "n", "nulls", "width", "distinct_values", median.alias("median"))
