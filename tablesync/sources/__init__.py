from tablesync.sources.control import (
    LOG_SCHEMA,
    REGISTRY_SCHEMA,
    fetch,
    job_of_step,
    last_success_watermarks,
    registry_rows,
    steps,
)
from tablesync.sources.jdbc import Connection, Dialect, Split
from tablesync.sources.lake import (
    at_least_partitions,
    between,
    extract,
    from_sql,
    newer_than,
    read,
    resolve_range,
    where_equal,
)

__all__ = [
    "LOG_SCHEMA",
    "REGISTRY_SCHEMA",
    "Connection",
    "Dialect",
    "Split",
    "at_least_partitions",
    "between",
    "extract",
    "fetch",
    "from_sql",
    "job_of_step",
    "last_success_watermarks",
    "newer_than",
    "read",
    "registry_rows",
    "resolve_range",
    "steps",
    "where_equal",
]
