"""Changes settled in a stream's state before they are merged.

Each key's newest change is held in state. A micro-batch passes on at most one row for a key, and only if that is newer
than all seen before, so late and repeated changes never reach the target. A key's state is dropped once the
watermark has passed its newest change: what may still come for it is then older than the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tablesync.operators.merge import resolve
from tablesync.operators.skew import name
from tablesync.storage import conf
from tablesync.streaming.upsert_stream import Table, upsert_stream

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Newest(StatefulProcessor):
    """The state of a key: the order values of its newest change, times as microseconds."""

    def __init__(self, columns: list[str], order: list[str], state: T.StructType):
        self.columns, self.order, self.state = columns, order, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best, new = None, None
        for row in rows:
            own = tuple(row[c] for c in self.order)
            if best is None or self._later(own, new):
                best, new = row, own
        if best is None or (self.newest.exists() and not self._later(new, tuple(self.newest.get()))):
            return
        self.newest.update(new)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if new[0] is not None:
            self.handle.registerTimer(new[0] // 1000 + 1)
        yield Row(*self.columns)(*(best[c] for c in self.columns))

    @staticmethod
    def _later(new: Sequence, old: Sequence) -> bool:
        """Is the change newer, column by column? NULL is oldest."""
        for a, b in zip(new, old):
            if a is None or b is None:
                if (a is None) != (b is None):
                    return b is None
            elif a != b:
                return a > b
        return False

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_changes(stream: DataFrame, keys: Sequence[str], time: str, order_by: Sequence[str], delay: str) -> DataFrame:
    """The stream's changes that are newer, by ``order_by``, than all before of the same key.

    ``time`` is a timestamp column (with a zone) and the first of ``order_by``. ``delay`` says how late a change may come after a
    newer one of any key; what comes later is dropped, as by any watermark.
    """
    order = resolve(stream, order_by)
    if order[:1] != resolve(stream, [time]):
        raise ValueError("the time column must be the first of order_by")
    times = {c for c in order if isinstance(stream.schema[c].dataType, T.TimestampType)}
    held = {f"__order{i}": F.unix_micros(name(c)) if c in times else F.col(name(c)) for i, c in enumerate(order)}
    state = T.StructType([T.StructField(h, T.LongType() if c in times else stream.schema[c].dataType) for h, c in zip(held, order)])
    marked = stream.withColumns(held).withWatermark(order[0], delay)
    return marked.groupBy(*[name(k) for k in resolve(stream, keys)]).transformWithState(
        _Newest(stream.columns, list(held), state), outputStructType=stream.schema, outputMode="Update", timeMode="EventTime"
    )


def settled_upsert_stream(
    stream: DataFrame, target: Table, keys: Sequence[str], checkpoint: str, *, time: str, order_by: Sequence[str], delay: str, **options
) -> StreamingQuery:
    """``upsert_stream`` of the changes that state has settled."""
    with conf(stream.sparkSession, spark__sql__streaming__stateStore__providerClass=ROCKS):
        return upsert_stream(newest_changes(stream, keys, time, order_by, delay), target, keys, checkpoint, order_by=order_by, output_mode="update", **options)
