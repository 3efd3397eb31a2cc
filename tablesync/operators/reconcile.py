"""Compare source and target by row counts per period, and find what to load again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import period
from tablesync.operators.merge import fingerprint
from tablesync.operators.skew import name


def period_counts(df: DataFrame, date_col: str, frequency: str = "monthly") -> DataFrame:
    return df.groupBy(period(date_col, frequency).alias("period")).agg(F.count(F.lit(1)).alias("cnt"))


def _difference(sides: DataFrame) -> DataFrame:
    """A sum over both sides instead of a join of two: a NULL period is compared like any other."""
    counts = sides.groupBy("period").agg(F.sum("s").alias("src_cnt"), F.sum("t").alias("tgt_cnt"))
    return counts.withColumn("diff", F.col("src_cnt") - F.col("tgt_cnt"))


def compare_counts(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Both sides' counts per period and their difference, from frames of ``period`` and ``cnt``."""
    zero, count = F.lit(0).cast("bigint"), F.col("cnt").cast("bigint")
    source = source_counts.select("period", count.alias("s"), zero.alias("t"))
    return _difference(source.unionAll(target_counts.select("period", zero.alias("s"), count.alias("t"))))


def compare_periods(source: DataFrame, target: DataFrame, date_col: str, frequency: str = "monthly") -> DataFrame:
    """The same from the rows themselves: one aggregate, combined to a row per period before its shuffle."""
    bucket = period(date_col, frequency).alias("period")
    rows = source.select(bucket, F.lit(1).alias("s"), F.lit(0).alias("t"))
    return _difference(rows.unionAll(target.select(bucket, F.lit(0).alias("s"), F.lit(1).alias("t"))))


def rows_in_wrong_periods(source: DataFrame, compared: DataFrame, date_col: str, frequency: str = "monthly") -> DataFrame:
    """Source rows of the periods whose counts differ.

    Periods are bounded by the calendar, not by the data (at most 12 per year, or 366), so the list is
    broadcast and the source is never shuffled on its few period values.
    """
    wrong = F.broadcast(compared.where("diff <> 0").select(F.col("period").alias("p")))
    return source.join(wrong, period(date_col, frequency).eqNullSafe(F.col("p")), "left_semi")


def rows_to_resync(source: DataFrame, target: DataFrame, date_col: str, frequency: str = "monthly") -> DataFrame:
    return rows_in_wrong_periods(source, compare_periods(source, target, date_col, frequency), date_col, frequency)


def differing_periods(source: DataFrame, target: DataFrame, date_col: str, frequency: str = "monthly") -> list:
    """Periods whose rows differ, by number or by a checksum over all columns the two frames share (they are those
    of ``source``). One aggregate over both sides; as many values as the calendar has periods come back."""
    bucket = period(date_col, frequency).alias("period")

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*[name(c) for c in source.columns])
        return rows.select(bucket, F.lit(sign).alias("n"), (F.lit(sign) * fingerprint(rows).cast("decimal(20,0)")).alias("h"))

    sums = side(source, 1).unionAll(side(target, -1)).groupBy("period").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    return [r["period"] for r in sums.where("n <> 0 OR h <> 0").select("period").collect()]


def wrong_periods(source: DataFrame, target: DataFrame) -> list:
    """Periods in which two frames of (period, cnt, chk) differ; as many values as the calendar has periods come back."""
    zero = F.lit(0).cast("decimal(38,0)")

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select("period", *[(F.lit(sign) * F.coalesce(F.col(c).cast("decimal(38,0)"), zero)).cast("decimal(38,0)").alias(c) for c in ("cnt", "chk")])

    sums = side(source, 1).unionAll(side(target, -1)).groupBy("period").agg(F.sum("cnt").alias("n"), F.sum("chk").alias("h"))
    return [r["period"] for r in sums.where("n <> 0 OR h <> 0").select("period").collect()]


def period_ranges(periods: list) -> list[tuple[str, str]]:
    """(first day, day behind the last) of the periods that are not NULL, neighbours joined."""
    ranges: list[list[str]] = []
    for low, high in sorted(_bounds(p) for p in periods if p is not None):
        if ranges and ranges[-1][1] == low:
            ranges[-1][1] = high
        else:
            ranges.append([low, high])
    return [tuple(r) for r in ranges]


def _bounds(value: str | date) -> tuple[str, str]:
    """First day of a period and of the next one."""
    if isinstance(value, date):
        return value.isoformat(), date.fromordinal(value.toordinal() + 1).isoformat()
    year, month = int(value[:-2]), int(value[-2:])
    return f"{year:04d}-{month:02d}-01", f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"


def in_periods(df: DataFrame, date_col: str, periods: list, frequency: str = "monthly") -> Column:
    """Is a row in one of the periods? Ranges on the bare column, neighbours joined, so a scan can skip files; never NULL."""
    ranges = period_ranges(periods)
    dtype = df.schema[date_col].dataType
    c = F.col(name(date_col))
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        c, dtype = c.cast("timestamp"), T.TimestampType()
    found = c.isNull() if None in periods else F.lit(False)
    for low, high in ranges:
        found |= (c >= F.lit(low).cast(dtype)) & (c < F.lit(high).cast(dtype))
    return F.coalesce(found, F.lit(False))
