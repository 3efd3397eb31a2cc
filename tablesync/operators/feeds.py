"""Net changes of a feed over several versions, and their replay on a replica.

A key's chain of changes collapses to at most one: what it began as and what it ended as decide. Both ends are plain
aggregates, so chains are combined in each task before the shuffle, however hot a key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.merge import CHANGE_TYPE, resolve
from tablesync.operators.skew import any_null, name

VERSION = "_commit_version"


def net_changes(feed: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    """One row for each changed key: its last values and the net ``_change_type``, insert, update or delete.

    A key that was inserted and deleted again within the feed has none; one that was deleted and inserted again is an
    update. Within a version a key has one change, its images before and after an update apart. NULL key parts
    cannot be told apart and are an error.
    """
    keys = resolve(feed, keys)
    fields = [c for c in feed.columns if c not in (CHANGE_TYPE, version)]
    message = F.lit(f"a NULL key part in a change feed ({', '.join(keys)})")
    sound = F.when(any_null(keys), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    ends = feed.where(F.col(CHANGE_TYPE) != "update_preimage").where(sound)
    at = F.col(version)
    chains = ends.groupBy(*[name(k) for k in keys]).agg(
        F.min_by(F.col(CHANGE_TYPE), at).alias("__first"),
        F.max_by(F.struct(F.col(CHANGE_TYPE).alias("kind"), F.struct(*[F.col(name(c)) for c in fields]).alias("row")), at).alias("__last"),
    )
    created, gone = F.col("__first") == "insert", F.col("__last.kind") == "delete"
    kind = F.when(created & gone, None).when(created, "insert").when(gone, "delete").otherwise("update")
    net = chains.select(F.col("__last.row").alias("row"), kind.alias(CHANGE_TYPE)).where(F.col(CHANGE_TYPE).isNotNull())
    return net.select("row.*", CHANGE_TYPE)


def apply_feed(replica: DataFrame, feed: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    """The replica after the feed's versions. Applying a feed again changes nothing. Rows with a NULL key part stay."""
    keys = resolve(replica, keys)
    net = net_changes(feed, keys, version)
    touched = net.select(*[F.col(name(k)).alias(f"__k{i}") for i, k in enumerate(keys)])
    on = [F.col(name(k)) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    kept = replica.join(touched, on, "left_anti")
    return kept.unionByName(net.where(F.col(CHANGE_TYPE) != "delete").drop(CHANGE_TYPE), allowMissingColumns=True)
