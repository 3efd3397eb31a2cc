"""The keyed merge driven by Structured Streaming micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablesync.plans.staging import Table, merge_into, stage


def upsert_stream(
    stream: DataFrame,
    target: Table,
    keys: Sequence[str],
    checkpoint: str,
    *,
    order_by: Sequence[str],
    keep_versions: int = 2,
    output_mode: str = "append",
    **trigger,
) -> StreamingQuery:
    """Start a query that merges each micro-batch into the target.

    Several changes of one key in a micro-batch collapse to the newest by ``order_by``, and rows older than
    the target's are left out, so micro-batches may come in any order. The source
    offsets are committed after the target's new version, so a restart may merge a micro-batch again,
    which changes nothing. A partitioned or bucketed target rewrites only what the micro-batch touches. The
    trigger defaults to ``availableNow=True``.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        staged = stage(batch.sparkSession, batch, None)
        try:
            if staged.rows:
                merge_into(target, staged, keys, on_duplicate="latest", order_by=order_by)
                target.vacuum(keep_versions)
        finally:
            staged.drop()

    return (
        stream.writeStream.foreachBatch(merge)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
