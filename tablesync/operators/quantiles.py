"""Split bounds with even row counts, from mergeable quantile sketches.

Equal strides of a key make uneven splits wherever the key has gaps or crowds. A KLL sketch of the key, made by one
aggregate whose parts merge in any order, gives bounds at even ranks instead, within the sketch's error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.skew import name

#: Size parameter of the sketch, and the error of a rank it gives at most in 99 of 100 cases, as a share of all rows.
K = 1600
RANK_ERROR = 0.0025


@dataclass(frozen=True)
class Bounds:
    """Ranges of a key: row i is in part p where inner[p - 1] <= key < inner[p]; NULL keys are in part 0.

    ``inner`` are whole numbers in order; for a date or timestamp key they count days or microseconds.
    """

    column: str
    inner: tuple[int, ...]

    @property
    def parts(self) -> int:
        return len(self.inner) + 1

    def part(self, key: Column) -> Column:
        """The part of a row, by halving: a handful of comparisons of whole numbers, all in generated code."""

        def pick(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(key < F.lit(self.inner[middle]), pick(low, middle)).otherwise(pick(middle + 1, high))

        return F.when(key.isNull(), 0).otherwise(pick(0, len(self.inner)))

    def predicates(self, quoted: str | None = None) -> list[str]:
        """One SQL condition for each part; together they hold for every row once."""
        c = quoted or self.column
        if not self.inner:
            return ["1 = 1"]
        first = f"{c} < {self.inner[0]} OR {c} IS NULL"
        between = [f"{c} >= {a} AND {c} < {b}" for a, b in zip(self.inner, self.inner[1:])]
        return [first, *between, f"{c} >= {self.inner[-1]}"]


def whole_number(df: DataFrame, key: str) -> Column:
    """A split key as a long: dates by days, timestamps by microseconds, whole numbers as they are."""
    dtype, c = df.schema[key].dataType, F.col(name(key))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    raise ValueError(f"no order of whole numbers in {key}: {dtype.simpleString()}")


def quantile_sketch(df: DataFrame, key: str, k: int = K) -> DataFrame:
    """One row: the sketch of a key, which merges with those of other rows (``kll_merge_agg_bigint``)."""
    return df.agg(F.kll_sketch_agg_bigint(whole_number(df, key), F.lit(k)).alias("sketch"))


def bounds_of(sketches: DataFrame, column: str, parts: int) -> Bounds:
    """Bounds of so many parts with even row counts, from rows of sketches; equal bounds count once, so a key that
    fills several parts is one part. The driver gets the bounds."""
    if parts < 1:
        raise ValueError("at least one part")
    ranks = [i / parts for i in range(1, parts)]
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch").alias("s")).where("s IS NOT NULL AND kll_sketch_get_n_bigint(s) > 0")
    row = merged.select(F.array(*[F.kll_sketch_get_quantile_bigint("s", F.lit(r)) for r in ranks]).alias("q") if ranks else F.array().cast("array<bigint>").alias("q")).first()
    # A quantile is the last value of its part; the next part begins behind it.
    return Bounds(column, tuple(sorted({v + 1 for v in row["q"] if v < (1 << 63) - 1})) if row else ())


def even_bounds(df: DataFrame, key: str, parts: int, k: int = K) -> Bounds:
    """Bounds of parts with even row counts: one scan of the key column."""
    return bounds_of(quantile_sketch(df, key, k), key, parts)


def split_sizes(df: DataFrame, bounds: Bounds) -> DataFrame:
    """(part_id, n, lo, hi) of each part that has rows."""
    key = whole_number(df, bounds.column)
    return df.select(key.alias("k")).groupBy(bounds.part(F.col("k")).alias("part_id")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
