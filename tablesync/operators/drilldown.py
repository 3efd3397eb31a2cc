"""Find where two tables differ by a tree of order-free checksums: year, month, day, key range.

One aggregate over both sides gives each leaf its row counts and the sum of its rows' hashes, signed by side; it is combined
to a row a leaf before its shuffle. A rollup of the leaves gives the nodes above. From the root only nodes that differ
are entered. A row's place in the tree is given by its own values, so a node whose rows are equal has equal leaves.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.merge import fingerprint
from tablesync.operators.skew import name

LEVELS = ("year", "month", "day", "key_range")


def _place(df: DataFrame, date_col: str, key: str, width: int) -> list[Column]:
    day, number = F.col(name(date_col)).cast("timestamp"), F.col(name(key))
    return [
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.floor(number / F.lit(width)).cast("bigint").alias("key_range"),
    ]


def checksum_tree(source: DataFrame, target: DataFrame, date_col: str, key: str, width: int) -> DataFrame:
    """(level, year, month, day, key_range, src_n, tgt_n, differs) of every node; level 0 is the root and columns below a
    node's level are NULL. Compared are the columns of ``source``; keys of a range are width apart at most."""
    if width < 1:
        raise ValueError("width must be positive")

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*[name(c) for c in source.columns])
        count = F.lit(1).cast("bigint")
        counts = (count, F.lit(0).cast("bigint")) if sign > 0 else (F.lit(0).cast("bigint"), count)
        return rows.select(*_place(rows, date_col, key, width), counts[0].alias("s"), counts[1].alias("t"), (F.lit(sign) * fingerprint(rows).cast("decimal(20,0)")).alias("h"))

    sums = [F.sum("s").alias("s"), F.sum("t").alias("t"), F.sum("h").alias("h")]
    leaves = side(source, 1).unionAll(side(target, -1)).groupBy(*LEVELS).agg(*sums)
    level = sum((F.lit(1) - F.grouping(c).cast("int") for c in LEVELS[1:]), F.lit(1) - F.grouping(LEVELS[0]).cast("int"))
    nodes = leaves.rollup(*LEVELS).agg(*sums, level.alias("level"))
    return nodes.select("level", *LEVELS, F.col("s").alias("src_n"), F.col("t").alias("tgt_n"), ((F.col("s") != F.col("t")) | (F.col("h") != 0)).alias("differs"))


def differing_leaves(tree: DataFrame) -> DataFrame:
    """(year, month, day, key_range, src_n, tgt_n) of the leaves that differ, entered from the root through nodes that do.

    The tree is walked once for each level, so it should lie on disk or be cached.
    """
    entered = tree.where("level = 0 AND differs").select(F.lit(True).alias("in"))
    for depth in range(1, len(LEVELS) + 1):
        above = list(LEVELS[: depth - 1])
        below = tree.where(f"level = {depth} AND differs")
        parents = entered.select(*[F.col(c).alias(f"p_{c}") for c in above])
        on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in above], F.lit(True))
        entered = below.join(parents, on, "left_semi")
    return entered.select(*LEVELS, "src_n", "tgt_n")


def rows_in_leaves(df: DataFrame, leaves: DataFrame, date_col: str, key: str, width: int) -> DataFrame:
    """The rows of a table that lie in given leaves: what a repair reads."""
    place = dict(zip(LEVELS, _place(df, date_col, key, width)))
    wanted = leaves.select(*[F.col(c).alias(f"__{c}") for c in LEVELS])
    return df.join(wanted, reduce(and_, [place[c].eqNullSafe(F.col(f"__{c}")) for c in LEVELS]), "left_semi")
