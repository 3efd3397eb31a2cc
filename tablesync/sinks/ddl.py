"""Schema differences and the statements that close them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.skew import name
from tablesync.sources.jdbc import Dialect

TEXT_WIDTH = 4000

# Column types of the warehouses.
_WAREHOUSE_TYPES: dict[type[T.DataType], dict[Dialect, str]] = {
    T.ByteType: {Dialect.MYSQL: "SMALLINT", Dialect.REDSHIFT: "SMALLINT"},
    T.ShortType: {Dialect.MYSQL: "SMALLINT", Dialect.REDSHIFT: "SMALLINT"},
    T.IntegerType: {Dialect.MYSQL: "INTEGER", Dialect.REDSHIFT: "INTEGER"},
    T.LongType: {Dialect.MYSQL: "BIGINT", Dialect.REDSHIFT: "BIGINT"},
    T.FloatType: {Dialect.MYSQL: "FLOAT", Dialect.REDSHIFT: "REAL"},
    T.DoubleType: {Dialect.MYSQL: "DOUBLE", Dialect.REDSHIFT: "DOUBLE PRECISION"},
    T.BooleanType: {Dialect.MYSQL: "BOOLEAN", Dialect.REDSHIFT: "BOOLEAN"},
    T.DateType: {Dialect.MYSQL: "DATE", Dialect.REDSHIFT: "DATE"},
    T.TimestampType: {Dialect.MYSQL: "DATETIME(6)", Dialect.REDSHIFT: "TIMESTAMP"},
    T.TimestampNTZType: {Dialect.MYSQL: "DATETIME(6)", Dialect.REDSHIFT: "TIMESTAMP"},
}


def column_type(dtype: T.DataType, dialect: Dialect | None = None, text_width: int = TEXT_WIDTH) -> str:
    """Type with its length or precision suffix; ``dialect`` None is Spark's own."""
    if dialect is None:
        return dtype.simpleString()
    if isinstance(dtype, (T.CharType, T.VarcharType)):
        return dtype.simpleString().upper()
    if isinstance(dtype, T.StringType):
        return f"VARCHAR({text_width})"
    if isinstance(dtype, T.DecimalType):
        return f"NUMERIC({dtype.precision},{dtype.scale})"
    known = _WAREHOUSE_TYPES.get(type(dtype))
    if known is None:
        raise TypeError(f"{dtype.simpleString()} has no {dialect.value} column type; convert it first")
    return known[dialect]


def missing_fields(current: T.StructType, wanted: T.StructType) -> list[T.StructField]:
    """Fields of ``wanted`` that ``current`` lacks, ignoring case."""
    have = {n.lower() for n in current.names}
    return [f for f in wanted.fields if f.name.lower() not in have]


def add_column_ddl(
    table: str, current: T.StructType, wanted: T.StructType, dialect: Dialect | None = None, text_width: int = TEXT_WIDTH
) -> list[str]:
    """One ``ALTER TABLE … ADD`` statement per missing column."""
    statements = []
    for f in missing_fields(current, wanted):
        dtype = column_type(f.dataType, dialect, text_width)
        if dialect is None:
            quoted = ".".join(name(p) for p in table.split("."))
            statements.append(f"ALTER TABLE {quoted} ADD COLUMNS ({name(f.name)} {dtype})")
        else:
            statements.append(f"ALTER TABLE {dialect.quote(table)} ADD COLUMN {dialect.quote(f.name)} {dtype}")
    return statements


def add_missing_columns(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """Add the frame's new columns to a catalog table; its old rows read them as NULL."""
    schema = spark.table(table).schema
    for statement in add_column_ddl(table, schema, df.schema):
        spark.sql(statement)
    return [f.name for f in missing_fields(schema, df.schema)]


def with_missing(df: DataFrame, other: DataFrame) -> DataFrame:
    """The frame with the other frame's extra columns added as NULL."""
    extra = missing_fields(df.schema, other.schema)
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
