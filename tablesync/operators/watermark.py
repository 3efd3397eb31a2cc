"""High-water marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import ts_text

DEFAULT_START = "1900-01-01"
DEFAULT_END = "9999-12-31"


def batch_watermark(df: DataFrame, audit_col: str) -> DataFrame:
    """Newest audit value (NULL when there is none) and row count, in one pass."""
    return df.agg(F.max(audit_col).alias("watermark"), F.count(F.lit(1)).alias("n"))


def newest_text(audit_col: str, default: str = DEFAULT_START) -> Column:
    """Aggregate: newest audit value as text, or the default."""
    return F.coalesce(ts_text(F.max(audit_col)), F.lit(default))


def newest_or_default(df: DataFrame, audit_col: str, default: str = DEFAULT_START, alias: str = "start_dt") -> DataFrame:
    return df.agg(newest_text(audit_col, default).alias(alias))
