"""Order rows along a space-filling curve, so that filters on any of several columns skip files and row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.quantiles import even_bounds, whole_number
from tablesync.operators.skew import name

#: Bits of a column's rank in the curve.
BITS = 6
KEY = "__curve"


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A row's place on the Z-order curve of its columns' ranks: each column is cut into ``2 ** bits`` ranges of even row
    counts by a quantile sketch, so crowded values get as many ranges as rows; the ranks' bits take turns."""
    if not columns:
        raise ValueError("columns are required")
    if bits * len(columns) > 62:
        raise ValueError("too many bits for one key")
    key = F.lit(0).cast("bigint")
    for place, column in enumerate(columns):
        rank = even_bounds(df.select(name(column)), column, 1 << bits).part(whole_number(df, column)).cast("bigint")
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - place))
    return key


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows in so many ranges of the curve, each in order. Ranges come from a sample, so none is large; rows at one
    place of the curve are told apart by a hash of their columns."""
    marked = df.withColumn(KEY, curve_key(df, columns, bits))
    spread = F.xxhash64(*[F.col(name(c)) for c in columns])
    return marked.repartitionByRange(files, F.col(KEY), spread).sortWithinPartitions(KEY, *[name(c) for c in columns]).drop(KEY)
