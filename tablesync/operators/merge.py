"""Keyed merges of a batch into a target as distributed DataFrame plans.

Plans, from the batch's size and the target's keys:

* a batch of checked small size is broadcast: the target is never shuffled;
* otherwise target and batch are shuffled once each on the keys and joined left outer, a join whose target
  side Spark can split where keys are hot; rows to insert come from an anti join with the target's keys;
* rows with a NULL key part match nothing and are passed on without a shuffle, however many they are;
* keys found heavy in the target (``skew.heavy_key_hashes``) leave the shuffle too: their few batch
  rows, at most one per heavy key, are broadcast to the target rows where they lie;
* with ``bloom`` (the batch's row count) a filter of the batch's keys splits the target first: rows that cannot match
  are passed on without a shuffle, so that the shuffle is of the batch's size and not of the target's.

The parts are split by filters on the keys, so each is deterministic when a lost task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import bloom as bloom_filter
from tablesync.operators.skew import any_null, is_heavy, name

ACTION = "_action"
CHANGE_TYPE = "_change_type"
_COPIES = "__copies"
_RANK = "__rank"


def common_columns(target: DataFrame, batch: DataFrame) -> list[tuple[str, str]]:
    """(target name, batch name) of the columns both have, in target order, ignoring case."""
    by_lower = {c.lower(): c for c in batch.columns}
    return [(c, by_lower[c.lower()]) for c in target.columns if c.lower() in by_lower]


def resolve(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Names in the frame's own spelling; unknown ones are an error and never ignored."""
    spelling = {c.lower(): c for c in df.columns}
    unknown = [c for c in wanted if c.lower() not in spelling]
    if unknown:
        raise ValueError(f"no column {unknown} in {df.columns}")
    return [spelling[c.lower()] for c in wanted]


def _check_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys in the target's spelling; each must be on both sides."""
    if not keys:
        raise ValueError("merge keys are required")
    shared = {t.lower(): t for t, _ in common_columns(target, batch)}
    missing = [k for k in keys if k.lower() not in shared]
    if missing:
        raise ValueError(f"merge keys not in both target and batch: {missing}")
    return [shared[k.lower()] for k in keys]


def aligned(batch: DataFrame, target: DataFrame, fill: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Batch columns under the target's names, types and order; ``fill`` adds target-only ones as NULL."""
    source = {t: b for t, b in common_columns(target, batch)}
    types = {f.name: f.dataType for f in target.schema.fields}
    picked = [
        (F.col(name(source[c])) if c in source else F.lit(None)).cast(types[c]).alias(c)
        for c in target.columns
        if fill or c in source
    ]
    return batch.select(*picked, *[F.col(name(c)) for c in extra])


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _comparable(c: Column, dtype: T.DataType) -> Column:
    """A value that has equality and order: maps as sorted entries, variants as text."""
    if not _has_map(dtype):
        return c
    if isinstance(dtype, T.StructType):
        fields = [_comparable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _comparable(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        def entry(e: Column) -> Column:
            return F.struct(e["key"].alias("key"), _comparable(e["value"], dtype.valueType).alias("value"))

        return F.array_sort(F.transform(F.map_entries(c), entry))
    return F.to_json(c)


def fingerprint(df: DataFrame) -> Column:
    """64-bit hash of a row's values; equal rows of frames with the same columns have equal ones."""
    return F.xxhash64(*[_comparable(F.col(name(f.name)), f.dataType) for f in df.schema.fields])


def _differs(left: Column, right: Column, dtype: T.DataType) -> Column:
    return ~_comparable(left, dtype).eqNullSafe(_comparable(right, dtype))


def unique_by_key(
    df: DataFrame, keys: Sequence[str], on_duplicate: str = "error", order_by: Sequence[str] = ()
) -> DataFrame:
    """At most one row per complete key. Rows with a NULL key part are all kept.

    ``error`` raises when the frame is evaluated and a key repeats. ``latest`` keeps the row that is
    greatest by ``order_by``, then by its other columns, so the answer does not depend on row order.
    Copies of a hot key are combined before the shuffle.
    """
    keys = resolve(df, keys)
    complete = _unique(df.where(~any_null(keys)), keys, on_duplicate, order_by)
    return complete.unionByName(df.where(any_null(keys)))


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Newest row per key; NULL is a key value of its own here.

    Spark cuts each map task's rows to the first per key before the shuffle, so a hot key is no burden.
    """
    if not order_by:
        raise ValueError("'latest' needs order_by columns")
    keys, order = resolve(df, keys), resolve(df, order_by)
    fields = {f.name: f.dataType for f in df.schema.fields}
    ranked = order + [c for c in df.columns if c not in order and c not in keys]
    terms = [_comparable(F.col(name(c)), fields[c]) for c in ranked]
    newest_first = Window.partitionBy(*[name(c) for c in keys]).orderBy(*[t.desc_nulls_last() for t in terms])
    return df.withColumn(_RANK, F.row_number().over(newest_first)).where(F.col(_RANK) == 1).drop(_RANK)


def _unique(df: DataFrame, keys: Sequence[str], on_duplicate: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key of a frame of complete keys."""
    if on_duplicate == "latest":
        return latest_by_key(df, keys, order_by)
    if on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    message = F.concat(
        F.lit(f"duplicate merge key in the batch ({', '.join(keys)}): "),
        F.to_json(F.struct(*[F.col(name(k)) for k in keys])),
    )
    # A look at the row before, in the order a merge join sorts by anyway.
    columns = [F.col(name(k)) for k in keys]
    again = F.lag(F.lit(True)).over(Window.partitionBy(*columns).orderBy(*columns))
    return (
        df.withColumn(_COPIES, again)
        .where(F.when(F.col(_COPIES), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        .drop(_COPIES)
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a complete key repeats: one aggregate of the key columns, combined in each task before its shuffle."""
    keys = resolve(df, keys)
    columns = [F.col(name(k)) for k in keys]
    again = df.where(~any_null(keys)).groupBy(*columns).agg(F.count(F.lit(1)).alias(_COPIES)).where(F.col(_COPIES) > 1)
    found = again.select(F.to_json(F.struct(*columns)).alias("key")).first()
    if found:
        raise ValueError(f"duplicate merge key in the batch ({', '.join(keys)}): {found['key']}")


class _Joined:
    """Target and batch side by side: columns ``t<i>`` and ``s<i>``, presence flags ``in_t``/``in_s``.

    ``order`` are columns of both sides: where the batch's row is older by them, the target's row stays.
    """

    def __init__(self, df: DataFrame, schema: T.StructType, common: set[str], keys: set[str], order: Sequence[int] = ()):
        self.df, self.schema, self.common, self.keys = df, schema, common, keys
        self.in_target = F.col("in_t").isNotNull()
        self.in_batch = F.col("in_s").isNotNull()
        self.wins = self.in_batch
        if order:
            old, new = (
                F.struct(*[_comparable(F.col(f"{side}{i}"), schema.fields[i].dataType) for i in order]) for side in "ts"
            )
            self.wins = self.in_batch & ~(self.in_target & (new < old))  # NULL is the lowest value

    def old(self, i: int) -> Column:
        return F.col(f"t{i}")

    def new(self, i: int) -> Column:
        """Value after the merge: from the batch where it has the row and the column."""
        if self.schema.names[i] not in self.common:
            return self.old(i)
        return F.when(self.wins, F.col(f"s{i}")).otherwise(self.old(i))

    def changed(self) -> Column:
        tests = [
            _differs(F.col(f"t{i}"), F.col(f"s{i}"), f.dataType)
            for i, f in enumerate(self.schema.fields)
            if f.name in self.common and f.name not in self.keys
        ]
        return self.wins & reduce(or_, tests, F.lit(False))

    def action(self) -> Column:
        return (
            F.when(~self.in_target, "insert")
            .when(~self.in_batch, "keep")
            .when(self.changed(), "update")
            .otherwise("unchanged")
        )


def _join(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str,
    order_by: Sequence[str],
    small_batch: bool,
    heavy: Sequence[int],
    keep_newer: bool,
    bloom: int = 0,
) -> _Joined:
    keys = _check_keys(target, batch, keys)
    common = {t for t, _ in common_columns(target, batch)}
    extra = [c for c in order_by if c.lower() not in {t.lower() for t in common}]
    batch_rows = aligned(batch, target, extra=extra)
    complete = batch_rows.where(~any_null(keys))
    unique = _unique(complete, keys, on_duplicate, order_by)
    # Repeated keys fail where rows are inserted; beside that the batch is joined as it is, straight from
    # its shuffle, so that Spark may split the target's side.
    plain = complete if on_duplicate == "error" else unique
    index = {c: i for i, c in enumerate(target.columns)}
    types = {f"t{i}": f.dataType for i, f in enumerate(target.schema.fields)}
    types |= {f"s{i}": target.schema[c].dataType for c, i in index.items() if c in common}
    types |= {"in_t": T.BooleanType(), "in_s": T.BooleanType()}

    def target_side(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(name(c)).alias(f"t{i}") for c, i in index.items()], F.lit(True).alias("in_t"))

    def batch_side(df: DataFrame) -> DataFrame:
        columns = [F.col(name(c)).alias(f"s{i}") for c, i in index.items() if c in common]
        return df.select(*columns, F.lit(True).alias("in_s"))

    def one_side(df: DataFrame) -> DataFrame:
        present = set(df.columns)
        return df.select(*[F.col(c) if c in present else F.lit(None).cast(t).alias(c) for c, t in types.items()])

    on = reduce(and_, [F.col(f"t{index[k]}") == F.col(f"s{index[k]}") for k in keys])

    def keys_of(t: DataFrame) -> DataFrame:
        return t.select(*[F.col(name(k)).alias(f"t{index[k]}") for k in keys])

    def shuffled(t: DataFrame, s: DataFrame, checked: DataFrame) -> DataFrame:
        touched = target_side(t).join(batch_side(s), on, "left_outer").select(*types)
        return touched.unionByName(one_side(batch_side(checked).join(keys_of(t).distinct(), on, "left_anti")))

    def broadcasted(t: DataFrame, s: DataFrame, checked: DataFrame) -> DataFrame:
        new = batch_side(s)
        touched = target_side(t).join(F.broadcast(new), on, "left_outer").select(*types)
        new_keys = new.select(*[f"s{index[k]}" for k in keys])
        present = keys_of(t).join(F.broadcast(new_keys), on, "left_semi").distinct()
        return touched.unionByName(one_side(batch_side(checked).join(present, on, "left_anti")))

    beside = None
    if bloom and not small_batch:
        target, beside = bloom_filter.split_by_filter(target, keys, bloom_filter.key_filter(complete, keys, bloom), bloom)
    if small_batch:
        df = broadcasted(target, plain, unique)
    elif heavy:
        hot = is_heavy(keys, heavy)
        aside = any_null(keys) | hot
        df = shuffled(target.where(~aside), plain.where(~hot), unique.where(~hot))
        df = df.unionByName(broadcasted(target.where(aside), plain.where(hot), unique.where(hot)))
    else:
        df = shuffled(target.where(~any_null(keys)), plain, unique)
        df = df.unionByName(one_side(target_side(target.where(any_null(keys)))))
    if beside is not None:
        df = df.unionByName(one_side(target_side(beside)))
    df = df.unionByName(one_side(batch_side(batch_rows.where(any_null(keys)))))
    names = {c.lower(): c for c in common}
    order = [index[names[c.lower()]] for c in order_by if c.lower() in names] if keep_newer else []
    return _Joined(df, target.schema, common, set(keys), order)


def merge_with_actions(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    *,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    small_batch: bool = False,
    heavy: Sequence[int] = (),
    bloom: int = 0,
) -> DataFrame:
    """Upsert with an ``_action`` column: ``insert``, ``update``, ``unchanged`` or ``keep``.

    Rows match when all keys are equal; a NULL key never matches, so such batch rows are inserted.
    A match sets every common column from the batch; target-only columns stay (NULL on insert) and
    batch-only columns are dropped. Nothing is deleted. With ``latest`` a target row that is newer than
    the batch's by the order columns both sides have stays as it is (``unchanged``), so batches may come
    in any order; on equal order values the batch wins, and NULL is oldest. ``small_batch`` broadcasts the
    batch: set it only after measuring its size. ``bloom`` is the batch's row count, or about that: a filter of that
    size is broadcast (see ``bloom.fits``), any other count costs time only.
    """
    j = _join(target, batch, keys, on_duplicate, order_by, small_batch, heavy, on_duplicate == "latest", bloom)
    columns = [j.new(i).alias(c) for i, c in enumerate(target.columns)]
    return j.df.select(*columns, j.action().alias(ACTION))


def apply_batch(target: DataFrame, batch: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Target after the upsert. Options as for :func:`merge_with_actions`."""
    return merge_with_actions(target, batch, keys, **options).drop(ACTION)


def action_counts() -> list[Column]:
    """Aggregates over an ``_action`` column, for ``agg`` or ``observe``."""
    counts = {"inserted": "insert", "updated": "update", "unchanged": "unchanged", "kept": "keep"}
    return [F.count_if(F.col(ACTION) == value).alias(label) for label, value in counts.items()]


def merge_stats(merged: DataFrame) -> DataFrame:
    """One row of counts from a frame made by :func:`merge_with_actions`."""
    counts = merged.agg(*action_counts())
    batch_rows = F.col("inserted") + F.col("updated") + F.col("unchanged")
    return counts.select(batch_rows.alias("stg_rows"), "inserted", "updated", "unchanged", "kept")


def change_feed(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    *,
    replace: bool = False,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    small_batch: bool = False,
    heavy: Sequence[int] = (),
    bloom: int = 0,
) -> DataFrame:
    """Row changes a merge makes, typed by ``_change_type``.

    ``insert``, ``update_preimage`` and ``update_postimage``; with ``replace`` (the batch is the whole
    new table) also ``delete``. One join; both images of an update come from the same joined row.
    """
    if replace:  # columns the batch lacks are lost
        lower = {c.lower() for c in target.columns}
        batch = aligned(batch, target, fill=True, extra=[c for c in order_by if c.lower() not in lower])
    j = _join(target, batch, keys, on_duplicate, order_by, small_batch, heavy, on_duplicate == "latest" and not replace, bloom)
    before = [j.old(i).alias(c) for i, c in enumerate(target.columns)]
    after = [j.new(i).alias(c) for i, c in enumerate(target.columns)]

    def image(kind: str, columns: list[Column]) -> Column:
        return F.struct(*columns, F.lit(kind).alias(CHANGE_TYPE))

    images = F.when(~j.in_target, F.array(image("insert", after)))
    if replace:
        images = images.when(~j.in_batch, F.array(image("delete", before)))
    images = images.when(
        j.in_target & j.in_batch & j.changed(),
        F.array(image("update_preimage", before), image("update_postimage", after)),
    )
    return j.df.select(F.explode(images).alias("row")).select("row.*")


def merge_images(target: DataFrame, batch: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """All rows of an upsert and all its row changes from one join, told apart by ``_change_type``: ``keep`` for what stays
    as it is, and the types of :func:`change_feed`. Options as for :func:`merge_with_actions`."""
    on_duplicate = options.get("on_duplicate", "error")
    order_by, small, heavy = options.get("order_by", ()), options.get("small_batch", False), options.get("heavy", ())
    j = _join(target, batch, keys, on_duplicate, order_by, small, heavy, on_duplicate == "latest", options.get("bloom", 0))
    before = [j.old(i).alias(c) for i, c in enumerate(target.columns)]
    after = [j.new(i).alias(c) for i, c in enumerate(target.columns)]

    def image(kind: str, columns: list[Column]) -> Column:
        return F.struct(*columns, F.lit(kind).alias(CHANGE_TYPE))

    changed = F.array(image("update_preimage", before), image("update_postimage", after))
    images = F.when(~j.in_target, F.array(image("insert", after))).when(j.in_target & j.in_batch & j.changed(), changed)
    return j.df.select(F.explode(images.otherwise(F.array(image("keep", after)))).alias("row")).select("row.*")


def delete_insert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    *,
    small_batch: bool = False,
    heavy: Sequence[int] = (),
) -> DataFrame:
    """Delete the target rows whose keys are in the batch, then insert every batch row.

    Unlike the upsert, repeated batch keys are all kept and target-only columns become NULL.
    """
    keys = _check_keys(target, batch, keys)
    filled = aligned(batch, target, fill=True)
    gone = filled.select(*[F.col(name(k)).alias(f"d{i}") for i, k in enumerate(keys)]).dropna().distinct()
    match = reduce(and_, [F.col(name(k)) == F.col(f"d{i}") for i, k in enumerate(keys)])
    if small_batch:
        kept = target.join(F.broadcast(gone), match, "left_anti")
    else:
        hot = is_heavy(keys, heavy) if heavy else F.lit(False)
        gone_hot = is_heavy([f"d{i}" for i in range(len(keys))], heavy) if heavy else F.lit(False)
        aside = any_null(keys) | hot
        kept = target.where(~aside).join(gone.where(~gone_hot), match, "left_anti")
        beside = target.where(aside)
        if heavy:
            beside = beside.join(F.broadcast(gone.where(gone_hot)), match, "left_anti")
        kept = kept.unionByName(beside)
    return kept.unionByName(filled)
