"""Reads from JDBC databases: pushed-down queries and reads split over a numeric key."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import DEFAULT_SPLIT_MB
from tablesync.operators.quantiles import Bounds, even_bounds
from tablesync.operators.skew import name
from tablesync.operators.splits import MIN_SIZE_SPLITS, splits_by_size


class Dialect(Enum):
    MYSQL = "mysql"
    REDSHIFT = "redshift"

    def quote(self, identifier: str) -> str:
        """Quote a possibly schema-qualified name part by part."""
        mark = "`" if self is Dialect.MYSQL else '"'
        return ".".join(mark + p.replace(mark, mark * 2) + mark for p in identifier.split("."))


@dataclass(frozen=True)
class Connection:
    """Where a database is and how Spark talks to it. Secrets live in ``options`` and never in text."""

    url: str
    dialect: Dialect
    options: dict[str, str] = field(default_factory=dict, repr=False)
    fmt: str = "jdbc"  # an external bulk connector takes the same url/query/dbtable options

    def reader_options(self) -> dict[str, str]:
        return {"url": self.url, **self.options}


@dataclass(frozen=True)
class Split:
    """Key range read in ``parts`` parallel pieces. Rows outside the bounds, and NULL keys, are read
    by the outer pieces, so the bounds shape the load and never the result."""

    column: str
    lower: int
    upper: int
    parts: int = MIN_SIZE_SPLITS

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def query(spark: SparkSession, conn: Connection, sql: str) -> DataFrame:
    """Let the database run ``sql``; Spark sees its result."""
    return spark.read.format(conn.fmt).options(**conn.reader_options(), query=sql).load()


def table_options(conn: Connection, table_or_sql: str, split: Split | None = None) -> dict[str, str]:
    """Reader options. ``query`` cannot be split, so SQL is wrapped as a derived table."""
    is_sql = table_or_sql.lstrip().lower().startswith(("select ", "with "))
    dbtable = f"({table_or_sql}) src" if is_sql else conn.dialect.quote(table_or_sql)
    return {**conn.reader_options(), "dbtable": dbtable, **(split.options() if split else {})}


def read_table(spark: SparkSession, conn: Connection, table_or_sql: str, split: Split | None = None) -> DataFrame:
    return spark.read.format(conn.fmt).options(**table_options(conn, table_or_sql, split)).load()


def bounds_sql(conn: Connection, key: str, table_or_sql: str) -> str:
    inner = table_options(conn, table_or_sql)["dbtable"]
    k = conn.dialect.quote(key)
    return f"SELECT MIN({k}) AS lower_limit, MAX({k}) AS upper_limit, COUNT(*) AS tbl_cnt FROM {inner}"


def find_split(spark: SparkSession, conn: Connection, table_or_sql: str, key: str, parts: int) -> Split | None:
    """Bounds from one aggregate that the database computes; None for an empty extraction."""
    row = query(spark, conn, bounds_sql(conn, key, table_or_sql)).first()
    if row["lower_limit"] is None:
        return None
    return Split(key, int(row["lower_limit"]), int(row["upper_limit"]), parts)


# Where each database keeps a table's size.
SIZE_SQL = {
    Dialect.MYSQL: "SELECT ROUND(data_length / 1024 / 1024) AS size_mb FROM information_schema.tables "
    "WHERE table_schema = {schema} AND table_name = {table}",
    Dialect.REDSHIFT: 'SELECT size AS size_mb FROM svv_table_info WHERE "schema" = {schema} AND "table" = {table}',
}


def _text(value: str) -> str:
    if "\\" in value:  # means different things to different databases
        raise ValueError(f"backslash in a table name: {value!r}")
    return "'" + value.replace("'", "''") + "'"


def size_sql(dialect: Dialect, table: str) -> str:
    schema, _, short = table.rpartition(".")
    return SIZE_SQL[dialect].format(schema=_text(schema), table=_text(short))


def plan_split(
    spark: SparkSession, conn: Connection, table: str, key: str, split_mb: int = DEFAULT_SPLIT_MB, sql: str | None = None
) -> Split | None:
    """Split for reading a table, or ``sql`` over it: pieces by the table's size, bounds by the extraction."""
    sizes = query(spark, conn, size_sql(conn.dialect, table))
    found = sizes.select(splits_by_size(F.col("size_mb").cast("double"), max(split_mb, DEFAULT_SPLIT_MB)).alias("parts")).first()
    return find_split(spark, conn, sql or table, key, found["parts"] if found else MIN_SIZE_SPLITS)


# How each database formats a month.
MONTH_TEXT = {Dialect.MYSQL: "DATE_FORMAT({c}, '%Y%m')", Dialect.REDSHIFT: "TO_CHAR({c}, 'YYYYMM')"}


def period_sql(dialect: Dialect, column: str, frequency: str | None = "monthly") -> str:
    """The database's own expression for ``functions.period``."""
    c = dialect.quote(column)
    monthly = (frequency or "").lower() in ("", "monthly")
    return MONTH_TEXT[dialect].format(c=c) if monthly else f"DATE({c})"


def period_counts(
    spark: SparkSession, conn: Connection, table: str, date_col: str, frequency: str | None = "monthly"
) -> DataFrame:
    """Rows per period, counted by the database: one row per period crosses the network."""
    bucket = period_sql(conn.dialect, date_col, frequency)
    sql = f"SELECT {bucket} AS period, COUNT(*) AS cnt FROM {conn.dialect.quote(table)} GROUP BY {bucket}"
    return query(spark, conn, sql)


# How each database writes values as text, and reads a hexadecimal number.
DATE_TEXT = {Dialect.MYSQL: "DATE_FORMAT({c}, '%Y-%m-%d')", Dialect.REDSHIFT: "TO_CHAR({c}, 'YYYY-MM-DD')"}
TIME_TEXT = {Dialect.MYSQL: "DATE_FORMAT({c}, '%Y-%m-%d %H:%i:%s')", Dialect.REDSHIFT: "TO_CHAR({c}, 'YYYY-MM-DD HH24:MI:SS')"}
PLAIN_TEXT = {Dialect.MYSQL: "CAST({c} AS CHAR)", Dialect.REDSHIFT: "CAST({c} AS VARCHAR(64))"}
HEX_NUMBER = {Dialect.MYSQL: "CAST(CONV({h}, 16, 10) AS UNSIGNED)", Dialect.REDSHIFT: "STRTOL({h}, 16)"}
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def portable_columns(schema: T.StructType) -> tuple[list[str], list[str]]:
    """Columns whose values Spark and the databases write as the same text, and the others."""
    kinds = (*_WHOLE, *_TIMES, T.DateType, T.DecimalType, T.StringType)
    sound = [f.name for f in schema.fields if isinstance(f.dataType, kinds)]
    return sound, [f.name for f in schema.fields if f.name not in sound]


def _text_sql(dialect: Dialect, f: T.StructField) -> str:
    c = dialect.quote(f.name)
    if isinstance(f.dataType, T.StringType):
        return c
    forms = DATE_TEXT if isinstance(f.dataType, T.DateType) else TIME_TEXT if isinstance(f.dataType, _TIMES) else PLAIN_TEXT
    return forms[dialect].format(c=c)


def row_number_sql(dialect: Dialect, fields: list[T.StructField]) -> str:
    """A number from the MD5 of a row's values as text, each behind its length; the same as ``row_number``."""
    parts = []
    for f in fields:
        t = _text_sql(dialect, f)
        pieces = (f"CHAR_LENGTH({t})", "':'", t)
        joined = f"CONCAT({', '.join(pieces)})" if dialect is Dialect.MYSQL else " || ".join(pieces)
        parts.append(f"COALESCE({joined}, '~')")
    text = f"CONCAT({', '.join(parts)})" if dialect is Dialect.MYSQL else " || ".join(parts)
    return HEX_NUMBER[dialect].format(h=f"SUBSTRING(MD5({text}), 1, 8)")


def row_number(schema: T.StructType, columns: list[str]) -> Column:
    """What ``row_number_sql`` has the database compute."""
    parts = []
    for column in columns:
        c, dtype = F.col(name(column)), schema[column].dataType
        form = "yyyy-MM-dd" if isinstance(dtype, T.DateType) else "yyyy-MM-dd HH:mm:ss" if isinstance(dtype, _TIMES) else None
        t = F.date_format(c, form) if form else c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")))
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("bigint")


def checksums_sql(dialect: Dialect, table: str, date_col: str, frequency: str | None, fields: list[T.StructField]) -> str:
    bucket = period_sql(dialect, date_col, frequency)
    number = row_number_sql(dialect, fields)
    return f"SELECT {bucket} AS period, COUNT(*) AS cnt, SUM({number}) AS chk FROM {dialect.quote(table)} GROUP BY {bucket}"


def period_checksums(
    spark: SparkSession, conn: Connection, table: str, date_col: str, frequency: str | None, fields: list[T.StructField]
) -> DataFrame:
    """Rows and the sum of their numbers per period, computed by the database."""
    return query(spark, conn, checksums_sql(conn.dialect, table, date_col, frequency, fields))


def read_parts(spark: SparkSession, conn: Connection, table: str, bounds: Bounds) -> DataFrame:
    """A table read in parts with even row counts: one statement for each range of a whole-number key."""
    predicates = bounds.predicates(conn.dialect.quote(bounds.column))
    return spark.read.jdbc(conn.url, conn.dialect.quote(table), predicates=predicates, properties=dict(conn.options))


def even_split(spark: SparkSession, conn: Connection, table: str, key: str, parts: int) -> Bounds:
    """Bounds for ``read_parts`` from the key column alone, read in equal strides."""
    keys = f"SELECT {conn.dialect.quote(key)} FROM {conn.dialect.quote(table)}"
    return even_bounds(read_table(spark, conn, keys, find_split(spark, conn, table, key, parts)), key, parts)


def newest_sql(dialect: Dialect, table: str, audit_col: str) -> str:
    return f"SELECT MAX({dialect.quote(audit_col)}) AS newest FROM {dialect.quote(table)}"
