"""Column expressions, of built-in Spark expressions only."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DSV_NULL = "\\n\\n"  # fixed value: a backslash and an n, twice

# Names and defaults of the JSON table configuration.
CONFIG_REQUIRED = (
    "USER_DT_COL",
    "USER_DT_FLG",
    "SRC_DB_TYPE",
    "SRC_DB",
    "SRC_PORT",
    "SRC_TABLE",
    "SRC_SCHEMA",
    "TGT_DB_TYPE",
    "TGT_DB",
    "TGT_PORT",
    "STG_SCHEMA",
    "TGT_SCHEMA",
    "TGT_TABLE",
    "LOAD_TYPE",
    "KEY_COLS",
)
CONFIG_OPTIONAL = ("SRC_PK_COL", "STG_TABLE", "SRC_SQL", "START_DT", "END_DT")
DEFAULT_SPLIT_MB = 130
DEFAULT_ROWS_PER_PART = 50_000


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a costly expression several times but evaluate it once per row."""
    return F.transform(F.array(value), use)[0]


def period(c: ColumnLike, frequency: str | None = "monthly") -> Column:
    """Bucket a timestamp: ``yyyyMM`` text for monthly (or no) frequency, a date otherwise."""
    name = (frequency or "").lower()
    if name in ("", "monthly"):
        return F.date_format(as_column(c), "yyyyMM")
    if name != "daily":
        warnings.warn(f"unknown frequency {frequency!r}, using daily", stacklevel=2)
    return F.to_date(as_column(c))


def ts_text(c: ColumnLike) -> Column:
    """Timestamp as text, cut to the second. For reports only: a watermark keeps full precision."""
    return F.date_format(as_column(c), TS_TEXT_FORMAT)


def audit_key(*parts: ColumnLike) -> Column:
    """sha256 hex of the parts joined with ``~``; NULL when any part is NULL."""
    joined: list[Column] = []
    for part in parts:
        if joined:
            joined.append(F.lit("~"))
        joined.append(as_column(part).cast("string"))
    return F.sha2(F.concat(*joined), 256)


def split_list(c: ColumnLike, separator: str = ",") -> Column:
    """Separated text to an array of trimmed items."""
    return F.transform(F.split(as_column(c), rf"\Q{separator}\E"), lambda item: F.trim(item))


def key_values(c: ColumnLike, separator: str = ";", on_extra: str = "error") -> Column:
    """``k=v`` items to a map. Items without ``=`` are skipped, the last duplicate wins, NULL is empty.

    ``on_extra`` says what an item with a second ``=`` does: ``error`` or ``skip``.
    """
    if on_extra not in ("error", "skip"):
        raise ValueError(f"on_extra must be 'error' or 'skip', not {on_extra!r}")
    if len(separator) != 1 or separator == "=":
        raise ValueError("the separator must be one character other than '='")
    text = F.coalesce(as_column(c), F.lit(""))
    mark = rf"\x{{{ord(separator):x}}}"
    item = rf"(?:\A|{mark})([^={mark}]*)=([^={mark}]*)(?={mark}|\z)"
    keys, values = (F.regexp_extract_all(text, F.lit(item), F.lit(group)) for group in (1, 2))
    # Of a repeated key, the last entry: the first of the list turned round.
    turned = F.reverse(keys)
    entries = F.filter(F.arrays_zip(keys.alias("key"), values.alias("value")), lambda e, i: F.array_position(turned, e["key"]) == F.size(turned) - i)
    distinct = F.size(F.array_distinct(keys)) == F.size(keys)
    found = F.when(distinct, F.map_from_arrays(keys, values)).otherwise(F.map_from_entries(entries))
    if on_extra == "skip":
        return found
    message = F.concat(F.lit("an item has more than one '=' in "), text)
    return F.when(text.rlike(rf"=[^{mark}]*="), F.raise_error(message).cast("map<string,string>")).otherwise(found)


def json_field(c: ColumnLike, path: str, dtype: str = "string", default=None) -> Column:
    """One field of JSON text, cast, with a default when it is missing."""
    value = F.get_json_object(as_column(c), path).cast(dtype)
    return value if default is None else F.coalesce(value, F.lit(default).cast(dtype))


def user_config(c: ColumnLike) -> Column:
    """JSON table configuration to a typed struct; a missing (or null) required field raises."""
    names = (*CONFIG_REQUIRED, *CONFIG_OPTIONAL, "SPARK_PARTITION_SIZE_MB", "PART_REC_CNT")
    parsed = F.from_json(as_column(c), T.StructType([T.StructField(n, T.StringType()) for n in names]))

    def typed(fields: Column) -> Column:
        by_user = fields["USER_DT_FLG"] == "Y"
        needed = [(n, fields[n].isNull()) for n in CONFIG_REQUIRED] + [("START_DT", by_user & fields["START_DT"].isNull())]
        missing = F.coalesce(*[F.when(absent, F.lit(n)) for n, absent in needed])
        columns = {n.lower(): fields[n] for n in (*CONFIG_REQUIRED, *CONFIG_OPTIONAL)}
        columns |= {
            "user_dt_flg": by_user,
            "tgt_db_type": F.lower(fields["TGT_DB_TYPE"]),
            "key_cols": split_list(fields["KEY_COLS"]),
            "split_mb": F.greatest(fields["SPARK_PARTITION_SIZE_MB"].cast("int"), F.lit(DEFAULT_SPLIT_MB)),
            "part_rec_cnt": F.coalesce(fields["PART_REC_CNT"].cast("bigint"), F.lit(DEFAULT_ROWS_PER_PART)),
            "start_dt": F.when(by_user, fields["START_DT"]),
            "end_dt": F.when(by_user, fields["END_DT"]),
        }
        good = F.struct(*[column.alias(n) for n, column in columns.items()])
        bad = F.raise_error(F.concat(F.lit("missing configuration field "), missing))
        return F.when(missing.isNull(), good).otherwise(bad)

    return bind(parsed, typed)


def text_or_sentinel(c: ColumnLike, sentinel: str = DSV_NULL) -> Column:
    """Value as text with NULL replaced by the export sentinel."""
    return F.coalesce(as_column(c).cast("string"), F.lit(sentinel))
