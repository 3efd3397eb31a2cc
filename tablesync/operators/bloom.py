"""Split a table by a Bloom filter of a batch's keys, so that only rows that may match are shuffled.

The filter is blocked: a key sets ``BITS`` bits of one 64-bit word, so it is a table (block, word) that one aggregate
over the batch makes and one broadcast join looks up. Its size follows from the batch's row count and the wanted
rate of false positives. A false positive is shuffled for nothing; no row that matches is ever passed by.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.skew import any_null, name

#: Bits a key sets in its word.
BITS = 4
#: What a broadcast row of the filter takes in memory.
WORD_BYTES = 48
FALSE_POSITIVES = 0.02
_BLOCK, _WORD, _MAYBE = "__bloom_block", "__bloom_word", "__bloom_maybe"


def words_for(rows: int, rate: float = FALSE_POSITIVES) -> int:
    """Words of a filter of so many keys: half as many bits again as an unblocked one takes, for unevenly filled words."""
    if not 0 < rate < 1:
        raise ValueError("rate must be between 0 and 1")
    bits = max(rows, 1) * -math.log(rate) / math.log(2) ** 2
    return max(1, math.ceil(1.5 * bits / 64))


def fits(rows: int, limit_bytes: int, rate: float = FALSE_POSITIVES) -> bool:
    """May the filter of so many keys be broadcast?"""
    return words_for(rows, rate) * WORD_BYTES <= limit_bytes


def key_values(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Keys whose equal values have equal hashes: 0.0 and -0.0 are one value."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [F.col(name(k)) + F.lit(0.0).cast(kinds[k]) if isinstance(kinds[k], (T.FloatType, T.DoubleType)) else F.col(name(k)) for k in keys]


def _place(df: DataFrame, keys: Sequence[str], words: int) -> tuple[Column, Column]:
    values = key_values(df, keys)
    bits = F.xxhash64(F.lit("bits"), *values)
    mask = reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(bits, 6 * k).bitwiseAND(63).cast("int")) for k in range(BITS)])
    return F.pmod(F.xxhash64(*values), F.lit(words)), mask


def key_filter(batch: DataFrame, keys: Sequence[str], rows: int, rate: float = FALSE_POSITIVES) -> DataFrame:
    """The filter of the batch's complete keys. Each task combines its keys before the shuffle."""
    block, mask = _place(batch, keys, words_for(rows, rate))
    found = batch.where(~any_null(keys)).select(block.alias(_BLOCK), mask.alias("m"))
    return found.groupBy(_BLOCK).agg(F.bit_or("m").alias(_WORD))


def split_by_filter(target: DataFrame, keys: Sequence[str], found: DataFrame, rows: int, rate: float = FALSE_POSITIVES) -> tuple[DataFrame, DataFrame]:
    """(rows that may match, rows that cannot) of a target, without a shuffle; a NULL key part matches nothing."""
    block, mask = _place(target, keys, words_for(rows, rate))
    joined = target.join(F.broadcast(found), block == F.col(_BLOCK), "left")
    maybe = F.coalesce(F.col(_WORD).bitwiseAND(mask) == mask, F.lit(False)) & ~any_null(keys)
    marked = joined.select(*[F.col(name(c)) for c in target.columns], maybe.alias(_MAYBE))
    return marked.where(F.col(_MAYBE)).drop(_MAYBE), marked.where(~F.col(_MAYBE)).drop(_MAYBE)
