"""Hot keys: frequent ones are found by a bounded sample."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MIN_SAMPLED_ROWS = 32


def name(column: str) -> str:
    """Quote a column name for ``F.col`` (names may hold dots)."""
    return "`" + column.replace("`", "``") + "`"


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(name(c)).isNull() for c in columns])


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(name(k)) for k in keys])


def is_heavy(keys: Sequence[str], hashes: Sequence[int]) -> Column:
    """True for a complete key with one of the hashes; never NULL."""
    return ~any_null(keys) & key_hash(keys).isin([int(h) for h in hashes])


def heavy_key_hashes(
    df: DataFrame, keys: Sequence[str], share: float = 0.01, fraction: float = 0.01, seed: int = 7
) -> list[int]:
    """Hashes of keys that hold at least ``share`` of the sampled rows.

    At most ``1 / share`` keys can reach that share, so the answer is bounded whatever the data.
    It only chooses between two exact join plans: a key missed by the sample is still joined.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    sampled = df.select(*[name(k) for k in keys]).where(~any_null(keys))
    if fraction < 1:
        sampled = sampled.sample(fraction=fraction, seed=seed)
    seen = Observation()
    top = (
        sampled.observe(seen, F.count(F.lit(1)).alias("rows"))
        .groupBy(key_hash(keys).alias("h"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= MIN_SAMPLED_ROWS)
        .orderBy(F.desc("n"), "h")
        .limit(int(1 / share) + 1)
        .collect()
    )
    if not top:  # also when nothing was sampled, where there is nothing to observe
        return []
    floor = seen.get["rows"] * share
    return [row["h"] for row in top if row["n"] >= floor]
