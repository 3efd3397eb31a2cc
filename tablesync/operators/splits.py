"""Choose how many parallel reads or writes a table needs, and look at how a key is spread."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import DEFAULT_ROWS_PER_PART, DEFAULT_SPLIT_MB
from tablesync.operators.skew import name

MIN_SIZE_SPLITS = 8


def split_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and greatest split key and the row count of an extraction."""
    k = F.col(name(key))
    return df.agg(F.min(k).alias("lower_limit"), F.max(k).alias("upper_limit"), F.count(F.lit(1)).alias("tbl_cnt"))


def splits_by_size(size_mb: Column | str, split_mb: int = DEFAULT_SPLIT_MB) -> Column:
    """``p = size / split``; ``round(p) + round(p % 8)``, at least 8."""
    p = (F.col(size_mb) if isinstance(size_mb, str) else size_mb) / F.lit(split_mb)
    return F.greatest((F.round(p) + F.round(p % 8)).cast("int"), F.lit(MIN_SIZE_SPLITS))


def row_splits(rows: Column, per_split: int = DEFAULT_ROWS_PER_PART) -> Column:
    return F.greatest(F.ceil(rows / F.lit(per_split)).cast("int"), F.lit(1))


def splits_by_rows(tables: Mapping[str, DataFrame], per_split: int = DEFAULT_ROWS_PER_PART) -> DataFrame:
    """Row count and number of splits of each named table; an empty one has 1 split."""
    plans = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("t"), "n", row_splits(F.col("n"), per_split).alias("parts"))
        for t, df in tables.items()
    ]
    result = plans[0]
    for plan in plans[1:]:
        result = result.unionAll(plan)
    return result


def key_histogram(df: DataFrame, key: str, splits: int) -> DataFrame:
    """Rows and key range of each of ``splits`` equal-width ranges of a whole-number key.

    A histogram to judge a split key by, not the ranges of any reader. A NULL key counts in the first range.
    The bounds are one row of a first, column-pruned scan; the counts are combined before their shuffle.
    """
    k = F.col(name(key))
    bounds = split_bounds(df, key).first()
    lo, hi = bounds["lower_limit"], bounds["upper_limit"]
    if lo is None or lo == hi:
        part = F.lit(0)
    else:
        exact = "decimal(38,0)"  # key differences may need more than 53 bits
        at = F.call_function("div", F.lit(splits).cast(exact) * (k.cast(exact) - F.lit(lo)), F.lit(hi - lo).cast(exact))
        part = F.when(k.isNull(), 0).otherwise(F.least(at, F.lit(splits - 1)).cast("int"))
    return (
        df.select(k)
        .groupBy(part.alias("part_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(k).alias("lo"), F.max(k).alias("hi"))
    )
