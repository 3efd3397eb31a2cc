"""Reads from lake paths, catalog tables and user SQL, with watermark and range filters.

Filters compare the bare column with a literal of the column's own type, so they reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import DEFAULT_ROWS_PER_PART
from tablesync.operators.skew import name
from tablesync.operators.splits import row_splits
from tablesync.operators.watermark import DEFAULT_END, DEFAULT_START
from tablesync.storage import is_path

DEFAULT_PARTITIONS = 200


def read(spark: SparkSession, ref: str, fmt: str = "parquet") -> DataFrame:
    """A directory when ``ref`` holds a slash, else a catalog table."""
    return spark.read.format(fmt).load(ref) if is_path(ref) else spark.table(ref)


def source_path(paths: Mapping[str, str], database: str, table: str) -> str:
    """Directory of a table. ``paths`` maps logical database names to storage paths."""
    base = paths.get(database, database)
    if not is_path(base):
        raise ValueError(f"no storage path configured for database {database!r}")
    return f"{base.rstrip('/')}/{table}"


def from_sql(
    spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None, args: Mapping | None = None
) -> DataFrame:
    """User SQL as a source. Values are bound as named ``args``, never formatted into the text."""
    for view, df in (views or {}).items():
        df.createOrReplaceTempView(view)
    return spark.sql(text, args=dict(args) if args else None)


def _typed(df: DataFrame, column: str, value: Column) -> tuple[Column, Column]:
    """(column, timestamp value) made comparable without a cast on the column where possible."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name(column)), value.cast(dtype)
    return F.col(name(column)).cast("timestamp"), value


def micros(c: Column) -> Column:
    """Timestamp of any kind as microseconds, the exact form in which watermarks pass the driver."""
    return F.unix_micros(c.cast("timestamp"))


def newer_than(df: DataFrame, audit_col: str, watermark_us: int | None, overlap: str | None = None) -> DataFrame:
    """Rows whose audit value is strictly after the watermark; all rows without a watermark.

    ``overlap`` (an interval such as ``"1 hour"``) reads that much again, for rows that arrive late;
    a keyed merge makes the second reading harmless.
    """
    if watermark_us is None:
        return df
    mark = _instant(int(watermark_us))
    if overlap:
        mark = mark - F.expr(f"INTERVAL {overlap}")
    column, mark = _typed(df, audit_col, mark)
    return df.where(column > mark)


def _instant(value: str | datetime | int) -> Column:
    """A literal timestamp from text, a datetime, or microseconds."""
    return F.timestamp_micros(F.lit(value)) if isinstance(value, int) else F.lit(value).cast("timestamp")


def between(df: DataFrame, date_col: str, start: str | datetime | int, end: str | datetime | int) -> DataFrame:
    """Inclusive range filter."""
    column, low = _typed(df, date_col, _instant(start))
    _, high = _typed(df, date_col, _instant(end))
    return df.where(column.between(low, high))


def where_equal(df: DataFrame, **values) -> DataFrame:
    """Equality filters joined by AND; a list or tuple value is an IN filter."""
    for column, value in values.items():
        c = F.col(name(column))
        df = df.where(c.isin(list(value)) if isinstance(value, (list, tuple)) else c == F.lit(value))
    return df


def resolve_range(
    user_range: bool,
    start: str | None,
    end: str | None,
    target_newest: str | int | None,
    now: datetime | None = None,
) -> tuple[str | int, str | datetime]:
    """The user's range when it is switched on, else target high-water mark (or the default) to now.

    An open user range ends at the default end. A mark in microseconds stays exact.
    """
    if user_range:
        if start is None:
            raise ValueError("a user range needs a start")
        return start, end or DEFAULT_END
    return DEFAULT_START if target_newest is None else target_newest, now or datetime.now()


def extract(
    spark: SparkSession,
    ref: str | None = None,
    *,
    fmt: str = "parquet",
    sql: str | None = None,
    full_load: bool = False,
    date_col: str | None = None,
    start: str | None = None,
    end: str | None = None,
    row_limit: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Table or user SQL. User SQL replaces the generated extraction: no range, no limit applies.

    ``row_limit`` takes the first rows by ``order_by`` and cannot go without it.
    """
    if sql:
        return from_sql(spark, sql)
    if ref is None:
        raise ValueError("give a table reference or SQL")
    df = read(spark, ref, fmt)
    if not full_load and date_col is not None and start is not None:
        df = between(df, date_col, start, end or DEFAULT_END)
    if row_limit is None:
        return df
    if not order_by:
        raise ValueError("a row limit needs an order")
    return df.orderBy(*[name(c) for c in order_by]).limit(row_limit)


def at_least_partitions(df: DataFrame, wanted: int = DEFAULT_PARTITIONS) -> DataFrame:
    """Repartition only upwards; enough partitions means no shuffle. Meant for plain scans."""
    current = df.rdd.getNumPartitions()
    if current < 1:
        return df.repartition(1)
    return df.repartition(wanted) if current < wanted else df


def spread(df: DataFrame, rows_per_part: int = DEFAULT_ROWS_PER_PART) -> DataFrame:
    """At least one partition per ``rows_per_part`` rows. Counts the rows first, so the frame should be cheap
    to read twice, such as a scan."""
    wanted = df.agg(row_splits(F.count(F.lit(1)), rows_per_part)).first()[0]
    return at_least_partitions(df, wanted)
