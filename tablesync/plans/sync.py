"""One sync run from registry row to log row, and the loop over a registry."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.columns import period, user_config
from tablesync.operators import reconcile
from tablesync.operators.merge import aligned, require_unique, unique_by_key
from tablesync.operators.skew import name
from tablesync.plans.staging import BROADCAST_LIMIT_BYTES, merge_into, replace_keys, replace_rows, stage, watch
from tablesync.sinks.bucketed import BucketedDir
from tablesync.sinks.jdbc import METHODS, Warehouse, in_periods_sql
from tablesync.sinks.partitioned import PartitionedDir
from tablesync.sinks.versioned import VersionedDir
from tablesync.sources import control, jdbc
from tablesync.sources.lake import between, micros, newer_than, read, resolve_range, source_path

log = logging.getLogger(__name__)

LAKE = "lake"
LOAD_TYPES = ("APPEND", "TRUNC_AND_LOAD", "VALIDATE_AND_SYNC")
WINDOWS = ("log", "target", "user")
Reader = Callable[[SparkSession, str], DataFrame]  # from a table name, for JDBC or SQL sources
_SECRET = re.compile(r"(?i)(password|passwd|pwd|secret|token)(\s*[=:]\s*)[^&;,\s]+")


@dataclass(frozen=True)
class SyncSettings:
    """What all runs of a registry share. ``registry`` and ``log`` are paths or catalog tables."""

    registry: str
    log: str
    audit_col: str
    paths: Mapping[str, str] = field(default_factory=dict)
    warehouses: Mapping[str, Warehouse] = field(default_factory=dict)
    readers: Mapping[str, Reader] = field(default_factory=dict)  # by source database, instead of a path
    source_format: str = "parquet"
    control_format: str = "parquet"
    registry_names: Mapping[str, str] = field(default_factory=dict)
    log_names: Mapping[str, str] = field(default_factory=dict)
    load_type: str = "APPEND"
    window: str = "log"  # rows after the logged watermark; or from the "target"'s newest row, or by "user"
    start: str | None = None
    end: str | None = None
    frequency: str = "monthly"
    overlap: str | None = None
    on_duplicate: str = "error"
    tie_break: Sequence[str] = ()
    evolve: bool = False
    broadcast_limit: int = BROADCAST_LIMIT_BYTES
    fail_fast: bool = False
    keep_versions: int = 2
    load_method: str = "upsert"  # or "delete_insert"; "unique_index" on MySQL; a full load always replaces
    partition_by: Sequence[str] = ()  # lake targets: partitioned in place, see PartitionedDir
    configs: str | None = None  # path or table of (sync_key, config): JSON settings of single tables, see user_config
    buckets: int = 0  # lake targets: partitioned by a hash of the merge keys, in so many buckets


@dataclass(frozen=True)
class SyncTask:
    """One registry row."""

    sync_key: str
    src_db: str
    src_tbl: str
    tgt_db_typ: str
    tgt_db: str
    tgt_tbl: str
    merge_keys: tuple[str, ...]

    @classmethod
    def from_row(cls, row: Row) -> SyncTask:
        values = row.asDict()
        keys = tuple(k.strip() for k in (values["merge_keys"] or "").split(",") if k.strip())
        if not keys:
            raise ValueError(f"registry row {values['sync_key']} has no merge keys")
        return cls(**{**values, "merge_keys": keys})


@dataclass(frozen=True)
class SyncResult:
    """Outcome of a run. ``rows`` is the batch; on a full load, the rows left after duplicates."""

    sync_key: str | None
    status: str
    rows: int = 0
    watermark_us: int | None = None
    stats: Mapping[str, int] = field(default_factory=dict)
    message: str = "ok"


def _causes(error: BaseException) -> list[str]:
    """Texts of the innermost causes; Spark wraps what failed in the JVM, and several failures in one."""
    inner = getattr(error, "java_exception", None)
    if inner is None:
        return [str(error)]
    found: list[str] = []
    todo = [inner]
    while todo:
        each = todo.pop(0)
        below = [x for x in (each.getCause(), *each.getSuppressed()) if x is not None]
        todo += below
        if not below:
            found.append(each.getMessage() or each.getClass().getName())
    return list(dict.fromkeys(found))


def safe_message(error: BaseException) -> str:
    """The whole text of an error and of all failures in it, with anything that looks like a secret masked."""
    text = "\n".join(_causes(error)).strip() or type(error).__name__
    return _SECRET.sub(r"\1\2***", text)


class LakeTarget:
    """A table of files. The source is evaluated once: into the stage, or straight into a full load."""

    def __init__(self, spark: SparkSession, task: SyncTask, settings: SyncSettings):
        self.spark, self.task, self.settings = spark, task, settings
        path = source_path(settings.paths, task.tgt_db, task.tgt_tbl)
        if settings.partition_by:
            self.table = PartitionedDir(spark, path, settings.partition_by)
        elif settings.buckets:
            self.table = BucketedDir(spark, path, task.merge_keys, settings.buckets)
        else:
            self.table = VersionedDir(spark, path)

    def exists(self) -> bool:
        return self.table.exists()

    def newest_us(self) -> int | None:
        if not self.table.exists():
            return None
        return self.table.read().agg(F.max(micros(F.col(self.settings.audit_col)))).first()[0]

    def period_counts(self) -> DataFrame | None:
        if not self.table.exists():
            return None
        return reconcile.period_counts(self.table.read(), self.settings.audit_col, self.settings.frequency)

    def load(self, source: DataFrame) -> SyncResult:
        if self.settings.load_type == "VALIDATE_AND_SYNC" and self.table.exists():
            result = self._repair(source)
        else:
            result = self._load_all(source) if self._is_full() else self._merge(source)
        self.table.vacuum(self.settings.keep_versions)
        return result

    def _repair(self, source: DataFrame) -> SyncResult:
        """Replace the periods in which source and target differ, by their number of rows or a checksum of
        them; compare again, and fail if anything is still different."""
        audit, frequency = self.settings.audit_col, self.settings.frequency

        def different() -> list:
            target = self.table.read()
            return reconcile.differing_periods(aligned(unique, target), target, audit, frequency)

        whole = stage(self.spark, unique_by_key(source, self.task.merge_keys, **self._duplicates()), audit)
        try:
            unique = whole.df
            periods = different()
            if not periods:
                return SyncResult(self.task.sync_key, control.SUCCESS, 0, None, {})
            target = self.table.read()
            kept = target.where(~reconcile.in_periods(target, audit, periods, frequency))
            rows = unique.where(reconcile.in_periods(unique, audit, periods, frequency))
            replace_rows(self.table, kept, aligned(rows, target, fill=True))
            left = different()
            if left:
                raise RuntimeError(f"periods still differ after loading them again: {left}")
            found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(micros(F.col(name(audit)))).alias("us")).first()
            return SyncResult(self.task.sync_key, control.SUCCESS, found["n"], found["us"], {"inserted": found["n"]})
        finally:
            whole.drop()

    def _is_full(self) -> bool:
        return self.settings.load_type == "TRUNC_AND_LOAD" or not self.table.exists()

    def _duplicates(self) -> dict:
        order_by = (self.settings.audit_col, *self.settings.tie_break)
        return {"on_duplicate": self.settings.on_duplicate, "order_by": order_by}

    def _load_all(self, source: DataFrame) -> SyncResult:
        watched, seen = watch(self.settings.audit_col)
        keys = self.task.merge_keys
        if isinstance(self.table, VersionedDir) and self.settings.on_duplicate == "error":
            # Written as it is; the keys alone are counted before readers see it.
            self.table.write(source, finish=watched, check=lambda written: require_unique(written, keys))
        else:
            self.table.replace(unique_by_key(source, keys, **self._duplicates()), finish=watched)
        rows, newest = seen.get["rows"], seen.get["watermark_us"]
        return SyncResult(self.task.sync_key, control.SUCCESS, rows, newest, {"inserted": rows})

    def _merge(self, source: DataFrame) -> SyncResult:
        settings = self.settings
        batch = stage(self.spark, source, settings.audit_col)
        try:
            stats: dict[str, int] = {}
            if batch.rows and settings.load_method == "delete_insert":
                stats = replace_keys(self.table, batch, self.task.merge_keys, settings.broadcast_limit, settings.evolve)
            elif batch.rows:
                stats = merge_into(
                    self.table,
                    batch,
                    self.task.merge_keys,
                    **self._duplicates(),
                    broadcast_limit=settings.broadcast_limit,
                    evolve=settings.evolve,
                )
            return SyncResult(self.task.sync_key, control.SUCCESS, batch.rows, batch.watermark_us, stats)
        finally:
            batch.drop()


class WarehouseTarget:
    """A database table. Its stage table is the only evaluation of the source."""

    def __init__(self, spark: SparkSession, task: SyncTask, settings: SyncSettings):
        self.spark, self.task, self.settings = spark, task, settings
        self.warehouse = settings.warehouses[task.tgt_db_typ]
        self.table = f"{task.tgt_db}.{task.tgt_tbl}"

    def exists(self) -> bool:
        return True  # the stage is cloned from it; a missing table fails there

    def newest_us(self) -> int | None:
        return self.warehouse.newest_us(self.spark, self.table, self.settings.audit_col)

    def period_counts(self) -> DataFrame | None:
        conn, settings = self.warehouse.conn, self.settings
        return jdbc.period_counts(self.spark, conn, self.table, settings.audit_col, settings.frequency)

    def load(self, source: DataFrame) -> SyncResult:
        settings, keys = self.settings, self.task.merge_keys
        unique = unique_by_key(source, keys, settings.on_duplicate, (settings.audit_col, *settings.tie_break))
        if settings.load_type == "VALIDATE_AND_SYNC":
            return self._repair(unique)
        watched, seen = watch(settings.audit_col)
        method = "replace" if settings.load_type == "TRUNC_AND_LOAD" else settings.load_method
        stats = self.warehouse.load(watched(unique), self.table, keys, lambda: seen.get["rows"], method, settings.evolve)
        return SyncResult(self.task.sync_key, control.SUCCESS, seen.get["rows"], seen.get["watermark_us"], stats)

    def _repair(self, unique: DataFrame) -> SyncResult:
        """Replace the periods in which source and target differ, by rows or by checksums that either side computes of
        its own; compare again, and fail if anything is still different. The message names columns of types that the
        database writes in its own way, which no checksum covers."""
        settings, audit = self.settings, self.settings.audit_col
        whole = stage(self.spark, unique, audit)
        try:
            target = self.warehouse.columns(self.spark, self.table)
            rows = aligned(whole.df, target)
            sound, left_out = jdbc.portable_columns(rows.schema)
            bucket = period(F.col(name(audit)), settings.frequency).alias("period")
            number = jdbc.row_number(rows.schema, sound)
            ours = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("cnt"), F.sum(number).alias("chk"))
            fields = [rows.schema[c] for c in sound]

            def different() -> list:
                theirs = jdbc.period_checksums(self.spark, self.warehouse.conn, self.table, audit, settings.frequency, fields)
                return reconcile.wrong_periods(ours, theirs)

            message = f"ok; not compared: {', '.join(left_out)}" if left_out else "ok"
            periods = different()
            if not periods:
                return SyncResult(self.task.sync_key, control.SUCCESS, 0, None, {}, message)
            wrong = whole.df.where(reconcile.in_periods(whole.df, audit, periods, settings.frequency))
            watched, seen = watch(audit)
            within = in_periods_sql(self.warehouse.conn.dialect, audit, periods)
            stats = self.warehouse.load(watched(wrong), self.table, self.task.merge_keys, lambda: seen.get["rows"], "replace_periods", settings.evolve, within)
            left = different()
            if left:
                raise RuntimeError(f"periods still differ after loading them again: {left}")
            return SyncResult(self.task.sync_key, control.SUCCESS, seen.get["rows"], seen.get["watermark_us"], stats, message)
        finally:
            whole.drop()


def _target(spark: SparkSession, task: SyncTask, settings: SyncSettings) -> LakeTarget | WarehouseTarget:
    if task.tgt_db_typ == LAKE:
        return LakeTarget(spark, task, settings)
    if task.tgt_db_typ in settings.warehouses:
        return WarehouseTarget(spark, task, settings)
    raise ValueError(f"no target configured for kind {task.tgt_db_typ!r}")


def _source(spark: SparkSession, task: SyncTask, settings: SyncSettings) -> DataFrame:
    if task.src_db in settings.readers:
        return settings.readers[task.src_db](spark, task.src_tbl)
    return read(spark, source_path(settings.paths, task.src_db, task.src_tbl), settings.source_format)


def _batch(
    source: DataFrame, target: LakeTarget | WarehouseTarget, settings: SyncSettings, last_mark: Callable[[], int | None]
) -> DataFrame:
    """The source rows this run is to load."""
    if settings.load_type == "TRUNC_AND_LOAD":
        return source
    if settings.load_type == "VALIDATE_AND_SYNC":
        return source  # the target finds what differs
    if settings.window == "log":  # a watermark says nothing about a target that is not there
        mark = last_mark() if target.exists() else None
        return newer_than(source, settings.audit_col, mark, settings.overlap)
    by_user = settings.window == "user"
    newest = None if by_user else target.newest_us()
    return between(source, settings.audit_col, *resolve_range(by_user, settings.start, settings.end, newest))


def _advances(settings: SyncSettings) -> bool:
    """May this run move the logged watermark? Only when nothing between the old and the new one is left out.

    Chosen ranges and single periods log no watermark, or the next run would skip the rows before them.
    """
    return settings.load_type == "TRUNC_AND_LOAD" or (settings.load_type == "APPEND" and settings.window == "log")


def _check(settings: SyncSettings) -> None:
    if settings.load_type not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {LOAD_TYPES}")
    if settings.window not in WINDOWS:
        raise ValueError(f"window must be one of {WINDOWS}")
    if settings.load_method not in METHODS:
        raise ValueError(f"load_method must be one of {METHODS}")


def _log_failure(spark: SparkSession, settings: SyncSettings, sync_key: str | None, error: BaseException) -> None:
    options = {"fmt": settings.control_format, "names": settings.log_names}
    control.append_log(spark, settings.log, sync_key, control.FAIL, None, safe_message(error), **options)


def run_one(
    spark: SparkSession, task: SyncTask, settings: SyncSettings, marks: Mapping[str, int | None] | None = None
) -> SyncResult:
    """Sync one table and log the outcome; an error is logged and raised again.

    ``marks`` are last watermarks already looked up. Success is logged after the target has switched:
    a crash in between repeats the batch, which a keyed merge absorbs.
    """
    log_options = {"fmt": settings.control_format, "names": settings.log_names}

    def last_mark() -> int | None:
        if marks is not None:
            return marks.get(task.sync_key)
        return control.last_watermark_us(control.read_log(spark, settings.log, **log_options), task.sync_key)

    try:
        _check(settings)
        target = _target(spark, task, settings)
        source = _source(spark, task, settings)
        result = target.load(_batch(source, target, settings, last_mark))
    except Exception as error:
        _log_failure(spark, settings, task.sync_key, error)
        raise
    mark = result.watermark_us if _advances(settings) else None
    control.append_log(spark, settings.log, task.sync_key, control.SUCCESS, mark, result.message, **log_options)
    return result


def run_all(
    spark: SparkSession, settings: SyncSettings, src_db: str, src_tbl: str, tgt_db_typ: str
) -> list[SyncResult]:
    """Run every registry row of a source table and target kind.

    The log is read once for all of them. One failing table does not stop the others unless
    ``fail_fast`` is set. Every failure is logged: of a run, of a registry row that makes no task, and, without
    a key, of what comes before the first row.
    """
    try:
        registry = read(spark, settings.registry, settings.control_format)
        rows = control.registry_rows(registry, src_db, src_tbl, tgt_db_typ, settings.registry_names)
        runs = control.read_log(spark, settings.log, settings.control_format, settings.log_names)
        marks = control.watermarks_us(runs, rows)
        if rows.isEmpty():
            raise LookupError(f"no registry rows for {src_db}.{src_tbl} to {tgt_db_typ}")
    except Exception as error:
        _log_failure(spark, settings, None, error)
        raise
    results: list[SyncResult] = []
    for row in rows.toLocalIterator():
        try:
            task, own = _own_settings(spark, _task(spark, settings, row), settings)
            results.append(run_one(spark, task, own, marks))
        except Exception as error:
            if settings.fail_fast:
                raise
            log.error("sync %s failed: %s", row["sync_key"], safe_message(error))
            results.append(SyncResult(row["sync_key"], control.FAIL, message=safe_message(error)))
    return results


def _task(spark: SparkSession, settings: SyncSettings, row: Row) -> SyncTask:
    try:
        return SyncTask.from_row(row)
    except Exception as error:
        _log_failure(spark, settings, row["sync_key"], error)
        raise


def _own_settings(spark: SparkSession, task: SyncTask, settings: SyncSettings) -> tuple[SyncTask, SyncSettings]:
    """Task and settings under the table's own configuration, where it has one: load type, key and date columns, and the
    range of dates if the user sets it. A configuration that is not whole is logged and raised."""
    if settings.configs is None:
        return task, settings
    try:
        held = read(spark, settings.configs, settings.control_format).where(F.col("sync_key") == task.sync_key)
        found = held.select(user_config("config").alias("c")).limit(2).collect()
        if len(found) > 1:
            raise ValueError(f"registry row {task.sync_key} has more than one configuration")
        if not found:
            return task, settings
        c = found[0]["c"]
        keys = tuple(k for k in c["key_cols"] if k)
        own = replace(settings, load_type=c["load_type"].upper(), audit_col=c["user_dt_col"])
        if c["user_dt_flg"]:
            own = replace(own, window="user", start=c["start_dt"], end=c["end_dt"])
        return replace(task, merge_keys=keys or task.merge_keys), own
    except Exception as error:
        _log_failure(spark, settings, task.sync_key, error)
        raise
