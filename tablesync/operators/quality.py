"""Checks on data: status columns, key constraints, text widths, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.skew import any_null, name


def _find_column(df: DataFrame, wanted: str) -> str | None:
    return next((c for c in df.columns if c.upper() == wanted.upper()), None)


def has_fail(column: str) -> Column:
    """Aggregate: does any value contain FAIL in any case? NULLs pass, no rows is false."""
    return F.coalesce(F.bool_or(F.upper(F.col(name(column)).cast("string")).contains("FAIL")), F.lit(False))


def fail_flag(df: DataFrame, column: str = "status", by: Sequence[str] = ()) -> DataFrame:
    """``has_fail`` per group. The column is found in any case; NULL everywhere when it is missing."""
    found = _find_column(df, column)
    flag = F.lit(None).cast("boolean") if found is None else has_fail(found)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), flag.alias("has_fail")).drop("n")


def check_status(df: DataFrame, column: str = "status") -> bool | None:
    """Driver-side answer for one result: True, False, or None without such a column."""
    if _find_column(df, column) is None:
        return None
    return fail_flag(df, column).first()["has_fail"]


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys that occur more than once, with their count."""
    rows = df.select(*[name(k) for k in keys]).where(~any_null(keys))
    return rows.groupBy(*[name(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of NULLs per key column and of rows with an incomplete key."""
    counts = [F.count_if(F.col(name(k)).isNull()).alias(k) for k in keys]
    return df.agg(*counts, F.count_if(any_null(keys)).alias("incomplete"))


def width_report(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """Longest text and number of rows over the limit, per column, in one pass."""
    aggs: list[Column] = []
    for c in columns:
        length = F.length(F.col(name(c)))
        aggs.append(F.max(length).cast("bigint").alias(f"w_{c}"))
        aggs.append(F.count_if(length > limit).alias(f"over_{c}"))
    return df.agg(*aggs)


def latest_version(df: DataFrame, by: str, version: str) -> DataFrame:
    """Greatest text version by number ("10" after "9"); text that is no number is an error."""
    text = F.col(name(version))
    number = text.try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit("version is no number: "), text.cast("string"))).cast("bigint")
    return df.groupBy(by).agg(F.max(F.when(text.isNotNull() & number.isNull(), bad).otherwise(number)).alias("latest"))
