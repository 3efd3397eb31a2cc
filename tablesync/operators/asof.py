"""As-of look-up: for each row the last value of its key at or before its time.

Rows and values are put together, cut into time ranges with even row counts (a quantile sketch of the time), and
shuffled once by key and range. Within a range a running last value does; what a range begins with is the last value
of the ranges before, from one short row for each key and range. So a hot key is spread over the ranges and never
sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.operators.merge import resolve
from tablesync.operators.quantiles import even_bounds, whole_number
from tablesync.operators.skew import any_null, name

#: Time ranges a key is cut into.
RANGES = 64


def as_of(rows: DataFrame, values: DataFrame, keys: Sequence[str], time: str, value: str, alias: str, ranges: int = RANGES) -> DataFrame:
    """The rows with a further column ``alias``: the value of the row of ``values`` with the same keys and the
    greatest ``time`` that is not later. Both frames have the key and time columns under the same names.

    Of values at one time the greatest counts, NULL least; rows with a NULL key part or time get NULL, as do rows before
    their key's first value. Values with a NULL time are no one's.
    """
    keys = resolve(rows, keys)
    value_keys = resolve(values, keys)
    columns = [F.col(name(c)) for c in rows.columns]
    at = whole_number(rows, time)
    aside = any_null(keys) | F.col(name(time)).isNull()  # found nothing, and need no shuffle
    mine = rows.where(~aside).select(F.struct(*columns).alias("row"), *[F.col(name(k)).alias(f"k{i}") for i, k in enumerate(keys)], at.alias("at"), F.lit(None).alias("found"))
    dated = values.where(F.col(name(time)).isNotNull() & ~any_null(value_keys))
    found = F.struct(F.col(name(value)).alias("v"))
    theirs = dated.select(*[F.col(name(k)).alias(f"k{i}") for i, k in enumerate(value_keys)], whole_number(values, time).alias("at"), found.alias("found"))
    both = mine.unionByName(theirs, allowMissingColumns=True)
    bounds = even_bounds(both.select("at"), "at", ranges)
    both = both.withColumn("part", bounds.part(F.col("at")))
    group = [f"k{i}" for i in range(len(keys))]
    # Values come before rows of the same time, the greatest last.
    order: list[Column] = [F.col("at"), F.col("row").isNotNull(), F.col("found")]
    running = F.last("found", ignorenulls=True).over(Window.partitionBy(*group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = both.groupBy(*group, "part").agg(F.max(F.when(F.col("found").isNotNull(), F.struct("at", "found"))).alias("last"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*group, "part", F.last("last.found", ignorenulls=True).over(before).alias("carried")).where("carried IS NOT NULL")
    inside = both.withColumn("running", running).where("row IS NOT NULL")
    joined = inside.join(carried, [*group, "part"], "left")
    done = joined.select("row.*", F.coalesce("running", "carried")["v"].alias(alias))
    return done.unionByName(rows.where(aside).withColumn(alias, F.lit(None).cast(done.schema[alias].dataType)))
