"""Set reconciliation by an invertible Bloom lookup table: two tables' differing rows without a join.

Each side's rows go, as 64-bit hashes, into a fixed number of cells; a cell holds the signed sum of how many, of the
hashes and of a check of each. Rows that both sides have cancel out. A cell with one hash left gives it away, it is
taken out of its other cells, and so on. What cannot be taken out is noticed, and then one exact aggregate by hash
answers instead. The driver holds the cells, whose number is a parameter, never rows.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.merge import fingerprint, resolve
from tablesync.operators.skew import name

#: Cells of each of the ``TABLES`` parts. All together they resolve about 0.8 times as many differing rows.
CELLS = 1 << 14
TABLES = 3


def _hash(value: Column, salt: int) -> Column:
    return F.xxhash64(value, F.lit(salt).cast("int"))


def _plain_hash(value: int, salt: int) -> int:
    """The same hash on the driver."""
    import xxhash

    seed = xxhash.xxh64_intdigest(struct.pack("<q", value), 42)
    found = xxhash.xxh64_intdigest(struct.pack("<i", salt), seed)
    return found - (1 << 64) if found >> 63 else found


def _cell(value: int, part: int, cells: int) -> int:
    return part * cells + _plain_hash(value, part + 1) % cells


def difference_cells(source: DataFrame, target: DataFrame, cells: int = CELLS) -> DataFrame:
    """(cell, n, total, checks) of source minus target, for the cells that are not empty. Compared are the columns of
    ``source``. Each task combines its rows to cells before the shuffle."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*[name(c) for c in source.columns])
        return rows.select(fingerprint(rows).alias("h"), F.lit(sign).alias("sign"))

    rows = side(source, 1).unionAll(side(target, -1))
    places = [F.pmod(_hash(F.col("h"), part + 1), F.lit(cells)) + part * cells for part in range(TABLES)]
    signed = lambda c: F.col("sign") * c.cast("decimal(20,0)")
    dealt = rows.select(F.explode(F.array(*places)).alias("cell"), "sign", signed(F.col("h")).alias("h"), signed(_hash(F.col("h"), 0)).alias("check"))
    found = dealt.groupBy("cell").agg(F.sum("sign").alias("n"), F.sum("h").alias("total"), F.sum("check").alias("checks"))
    return found.where("n <> 0 OR total <> 0 OR checks <> 0")


def peel(rows: Sequence[tuple[int, int, int, int]], cells: int = CELLS) -> tuple[dict[int, int], bool]:
    """({hash: copies that source has more}, whether nothing is left) of cells (cell, n, total, checks)."""
    table = {c: [int(n), int(t), int(k)] for c, n, t, k in rows}
    found: dict[int, int] = {}
    todo = list(table)
    while todo:
        cell = todo.pop()
        n, total, checks = table.get(cell, (0, 0, 0))
        if not n or total % n:
            continue
        value = total // n
        if not -(1 << 63) <= value < 1 << 63:
            continue
        check = _plain_hash(value, 0)
        if check * n != checks:
            continue
        found[value] = found.get(value, 0) + n
        for part in range(TABLES):
            other = _cell(value, part, cells)
            held = table.setdefault(other, [0, 0, 0])
            held[0] -= n
            held[1] -= n * value
            held[2] -= n * check
            todo.append(other)
    return {h: n for h, n in found.items() if n}, not any(any(v) for v in table.values())


def differing_hashes(source: DataFrame, target: DataFrame, cells: int = CELLS) -> tuple[DataFrame, bool]:
    """(h, n) of the row hashes that one side has more of (source where n is positive), and whether the cells told."""
    found, whole = peel([tuple(r) for r in difference_cells(source, target, cells).collect()], cells)
    if whole:
        return source.sparkSession.createDataFrame(list(found.items()), "h bigint, n bigint"), True

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*[name(c) for c in source.columns])
        return rows.select(fingerprint(rows).alias("h"), F.lit(sign).cast("bigint").alias("n"))

    sums = side(source, 1).unionAll(side(target, -1)).groupBy("h").agg(F.sum("n").alias("n"))
    return sums.where("n <> 0"), False


def differing_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], cells: int = CELLS) -> DataFrame:
    """(keys, side) of rows that only one side has, or has more often; ``side`` is source or target.

    With the cells' answer, which is bounded by their number, each side is scanned once more beside a broadcast list;
    without it the hashes of both sides are joined in a shuffle.
    """
    keys = resolve(source, keys)
    hashes, told = differing_hashes(source, target, cells)

    def side(df: DataFrame, sign: str, label: str) -> DataFrame:
        rows = df.select(*[name(c) for c in source.columns])
        wanted = hashes.where(f"n {sign} 0").select(F.col("h").alias("__h"))
        found = rows.join(F.broadcast(wanted) if told else wanted, fingerprint(rows) == F.col("__h"), "left_semi")
        return found.select(*[name(k) for k in keys], F.lit(label).alias("side")).distinct()

    return side(source, ">", "source").unionAll(side(target, "<", "target"))
