"""Control tables: the sync registry, the sync log, workflow steps and jobs.

The engine uses the names below. Where the physical tables use others, pass ``names`` (engine name
to physical name) and the readers and the log writer translate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import audit_key
from tablesync.operators.skew import name
from tablesync.sources.lake import micros, read, where_equal
from tablesync.storage import exists, is_path

SUCCESS, FAIL = "success", "fail"
ACTOR = "tablesync"

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("sync_key", "src_db", "src_tbl", "tgt_db_typ", "tgt_db", "tgt_tbl", "merge_keys")
    ]
)
LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_key", T.StringType()),
        T.StructField("sync_key", T.StringType()),
        T.StructField("current_status", T.StringType()),
        T.StructField("watermark_value", T.TimestampType()),
        T.StructField("created_dt", T.TimestampType()),
        T.StructField("updated_dt", T.TimestampType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("updated_by", T.StringType()),
        T.StructField("msg", T.StringType()),
    ]
)

# Columns of the workflow tables.
STEP_COLUMNS = (
    "step_seq_no", "job_id", "job_name", "step_id", "step_name", "step_desc", "is_active_flg",
    "src_db_type", "src_db", "src_port", "src_schema", "src_dir", "src_qry", "src_qry_add_clause",
    "tgt_db_type", "tgt_db", "tgt_port", "tgt_schema", "tgt_tbl_nm",
    "tgt_dml_type", "tgt_idx", "hist_tbl_nm", "tgt_dir",
)
JOB_COLUMNS = (
    "job_id", "job_name", "frequency", "is_active_flg", "created_at", "created_by", "updated_at", "updated_by",
)
EMAIL_COLUMNS = (
    "email_config_id", "email_config_name", "description", "is_active_flg", "job_id", "job_name", "step_id",
    "step_name", "email_from", "email_to", "email_cc", "email_bcc", "email_sub", "test_flag", "test_email_to",
    "table_title", "text_content", "signature", "trans_flag", "trans_col",
    "created_at", "created_by", "updated_at", "updated_by",
)


def _engine_names(df: DataFrame, names: Mapping[str, str] | None) -> DataFrame:
    return df.withColumnsRenamed({physical: engine for engine, physical in (names or {}).items()})


def registry_rows(
    registry: DataFrame, src_db: str, src_tbl: str, tgt_db_typ: str, names: Mapping[str, str] | None = None
) -> DataFrame:
    """Registry entries of one source table and target kind."""
    df = where_equal(_engine_names(registry, names), src_db=src_db, src_tbl=src_tbl, tgt_db_typ=tgt_db_typ)
    return df.select(*REGISTRY_SCHEMA.names)


def read_log(spark: SparkSession, ref: str, fmt: str = "parquet", names: Mapping[str, str] | None = None) -> DataFrame:
    """The log under engine names; an empty frame before the first run."""
    if is_path(ref) and not exists(spark, ref):
        return spark.createDataFrame([], LOG_SCHEMA)
    return _engine_names(read(spark, ref, fmt), names)


def last_success_watermarks(log: DataFrame) -> DataFrame:
    """Newest watermark among successful runs, for every sync key at once.

    A successful run over an empty batch has a NULL watermark, which max ignores.
    """
    return (
        log.where(F.col("current_status") == SUCCESS)
        .groupBy("sync_key")
        .agg(F.max("watermark_value").alias("watermark"))
    )


def last_watermark_us(log: DataFrame, sync_key: str) -> int | None:
    """Last successful watermark of one sync key, in microseconds."""
    marks = last_success_watermarks(where_equal(log, sync_key=sync_key))
    row = fetch(marks.select(micros(F.col("watermark")).alias("us")), "zero_or_one")
    return row["us"] if row else None


def watermarks_us(log: DataFrame, registry: DataFrame) -> dict[str, int | None]:
    """Last successful watermark of each given registry row; as many values as there are tables to run."""
    wanted = last_success_watermarks(log).join(registry.select("sync_key").distinct(), "sync_key", "left_semi")
    found = wanted.select("sync_key", micros(F.col("watermark")).alias("us"))
    return {row["sync_key"]: row["us"] for row in found.toLocalIterator()}


def append_log(
    spark: SparkSession,
    ref: str,
    sync_key: str | None,
    status: str,
    watermark_us: int | None = None,
    message: str = "ok",
    *,
    fmt: str = "parquet",
    names: Mapping[str, str] | None = None,
) -> None:
    """Append one run to the log. The row is built in Spark, so timestamps keep microseconds."""
    if status not in (SUCCESS, FAIL):
        raise ValueError(f"status must be {SUCCESS!r} or {FAIL!r}, not {status!r}")
    now = F.current_timestamp()
    key = F.lit(sync_key).cast("string")
    mark = F.lit(watermark_us).cast("bigint")
    row = {
        "log_key": audit_key(key, now),
        "sync_key": key,
        "current_status": F.lit(status),
        "watermark_value": F.timestamp_micros(mark),
        "created_dt": now,
        "updated_dt": now,
        "created_by": F.lit(ACTOR),
        "updated_by": F.lit(ACTOR),
        "msg": F.lit(message),
    }
    physical = names or {}
    df = spark.range(1, numPartitions=1).select(*[c.alias(physical.get(n, n)) for n, c in row.items()])
    writer = df.write.format(fmt).mode("append")
    writer.save(ref) if is_path(ref) else writer.saveAsTable(ref)


def fetch(df: DataFrame, policy: str = "one") -> Row | None:
    """A single driver-side row: ``one`` or ``zero_or_one`` rows allowed, or ``any`` (the first)."""
    if policy not in ("one", "zero_or_one", "any"):
        raise ValueError(f"unknown policy {policy!r}")
    rows = df.limit(2).collect()
    if len(rows) > 1 and policy != "any":
        raise LookupError("expected one row, found more")
    if not rows and policy == "one":
        raise LookupError("expected one row, found none")
    return rows[0] if rows else None


def steps(meta_step: DataFrame, step_id) -> DataFrame:
    """Records of a workflow step in sequence."""
    return where_equal(meta_step, step_id=step_id).select(*STEP_COLUMNS).orderBy("step_seq_no")


def step_emails(meta_step_email: DataFrame, step_id) -> DataFrame:
    return where_equal(meta_step_email, step_id=step_id).select(*EMAIL_COLUMNS).orderBy("email_config_id")


def lookup_through(
    outer: DataFrame, outer_key: str, inner: DataFrame, inner_key: str, **inner_filter
) -> DataFrame:
    """Rows of ``outer`` whose key equals the one distinct key of the filtered ``inner``.

    More than one distinct key is an error, as in a scalar subquery.
    """
    wanted = where_equal(inner, **inner_filter).select(F.col(name(inner_key)).alias("k")).distinct()
    scalar = wanted.scalar()
    return outer.where(F.col(name(outer_key)) == scalar).orderBy(name(outer_key))


def job_of_step(meta_job: DataFrame, meta_step: DataFrame, step_id) -> DataFrame:
    return lookup_through(meta_job.select(*JOB_COLUMNS), "job_id", meta_step, "job_id", step_id=step_id)


def step_config(meta_step: DataFrame, meta_job: DataFrame, meta_step_email: DataFrame, step_id) -> dict[str, Row | None]:
    """Step, job and optional e-mail record of a step, each checked for its number of rows."""
    return {
        "step": fetch(steps(meta_step, step_id), "one"),
        "job": fetch(job_of_step(meta_job, meta_step, step_id), "one"),
        "email": fetch(step_emails(meta_step_email, step_id), "zero_or_one"),
    }
