"""Writes to JDBC databases: a stage table filled by Spark, then one transaction in the database."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.merge import common_columns
from tablesync.operators.reconcile import period_ranges
from tablesync.operators.skew import name
from tablesync.sinks.ddl import TEXT_WIDTH, add_column_ddl
from tablesync.sources.jdbc import Connection, Dialect, newest_sql, query

STAGE_SUFFIX = "_sync_stg"
BATCH_ROWS = 10_000
METHODS = ("upsert", "delete_insert", "replace", "unique_index", "replace_periods")


def text_column_types(df: DataFrame, width: int = TEXT_WIDTH) -> str:
    """``createTableColumnTypes`` value giving every text column a bounded type."""
    texts = [f.name for f in df.schema.fields if type(f.dataType) is T.StringType]
    return ", ".join(f"{name(c)} VARCHAR({width})" for c in texts)


def nested_as_text(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON text; a row store has no column type for them."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            (F.to_json(F.col(name(f.name))).alias(f.name) if isinstance(f.dataType, nested) else F.col(name(f.name)))
            for f in df.schema.fields
        ]
    )


def observe_wide(df: DataFrame, width: int = TEXT_WIDTH) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame, and what tells, once it has been written, the text columns with rows wider than the column type
    and how many."""
    texts = [f.name for f in df.schema.fields if type(f.dataType) is T.StringType]
    if not texts:
        return df, dict
    seen = Observation()
    counts = [F.count_if(F.length(F.col(name(c))) > width).alias(f"c{i}") for i, c in enumerate(texts)]
    return df.observe(seen, *counts), lambda: {c: n for i, c in enumerate(texts) if (n := seen.get[f"c{i}"])}


def write_options(conn: Connection, table: str, df: DataFrame, text_width: int) -> dict[str, str]:
    options = {
        **conn.reader_options(),
        "dbtable": conn.dialect.quote(table),
        "truncate": "true",  # keep the typed stage table on overwrite
        "batchsize": str(BATCH_ROWS),
    }
    types = text_column_types(df, text_width)
    if types:
        options["createTableColumnTypes"] = types
    if conn.dialect is Dialect.MYSQL:
        options.setdefault("rewriteBatchedStatements", "true")
    return options


def writer(
    df: DataFrame, conn: Connection, table: str, mode: str = "append", partitions: int | None = None, text_width: int = TEXT_WIDTH
) -> DataFrameWriter:
    """Configured writer; ``partitions`` bounds the connections open at once.

    The bound is a coalesce here and not the ``numPartitions`` option: to apply that, Spark first asks
    the plan for its partition count, which runs an adaptive plan's shuffles one more time.
    """
    flat = nested_as_text(df)
    bounded = flat.coalesce(partitions) if partitions else flat
    return bounded.write.format(conn.fmt).mode(mode).options(**write_options(conn, table, flat, text_width))


def clone_statements(
    dialect: Dialect, table: str, new_table: str, columns: Sequence[str] = (), replace: bool = True
) -> list[str]:
    """Empty copy of a table's columns, or of some of them."""
    q = dialect.quote
    listed = ", ".join(q(c) for c in columns) or "*"
    create = f"CREATE TABLE {'' if replace else 'IF NOT EXISTS '}{q(new_table)} AS SELECT {listed} FROM {q(table)} WHERE 1 = 0"
    return [f"DROP TABLE IF EXISTS {q(new_table)}", create] if replace else [create]


def _on(dialect: Dialect, keys: Sequence[str]) -> str:
    return " AND ".join(f"t.{dialect.quote(k)} = s.{dialect.quote(k)}" for k in keys)


def upsert_statements(dialect: Dialect, target: str, stage: str, keys: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Update matches and insert the rest, matching on the merge keys and not on the target's indexes."""
    if not keys:
        raise ValueError("merge keys are required")
    q = dialect.quote
    listed = ", ".join(q(c) for c in columns)
    staged = ", ".join(f"s.{q(c)}" for c in columns)
    if dialect is Dialect.REDSHIFT:
        on = " AND ".join(f"{q(target)}.{q(k)} = s.{q(k)}" for k in keys)
        sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in columns)
        return [
            f"MERGE INTO {q(target)} USING {q(stage)} AS s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({staged})"
        ]
    sets = ", ".join(f"t.{q(c)} = s.{q(c)}" for c in columns)
    return [
        f"UPDATE {q(target)} AS t JOIN {q(stage)} AS s ON {_on(dialect, keys)} SET {sets}",
        f"INSERT INTO {q(target)} ({listed}) SELECT {staged} FROM {q(stage)} AS s "
        f"LEFT JOIN {q(target)} AS t ON {_on(dialect, keys)} WHERE t.{q(keys[0])} IS NULL",
    ]


def unique_index_upsert_statement(target: str, stage: str, columns: Sequence[str]) -> str:
    """MySQL upsert on the target's own unique indexes; without one it appends every row."""
    q = Dialect.MYSQL.quote
    listed = ", ".join(q(c) for c in columns)
    sets = ", ".join(f"{q(c)} = VALUES({q(c)})" for c in columns)
    return f"INSERT INTO {q(target)} ({listed}) SELECT {listed} FROM {q(stage)} ON DUPLICATE KEY UPDATE {sets}"


def delete_insert_statements(dialect: Dialect, target: str, stage: str, keys: Sequence[str], columns: Sequence[str]) -> list[str]:
    q = dialect.quote
    listed = ", ".join(q(c) for c in columns)
    match = " AND ".join(f"s.{q(k)} = {q(target)}.{q(k)}" for k in keys)
    return [
        f"DELETE FROM {q(target)} WHERE EXISTS (SELECT 1 FROM {q(stage)} AS s WHERE {match})",
        f"INSERT INTO {q(target)} ({listed}) SELECT {listed} FROM {q(stage)}",
    ]


def in_periods_sql(dialect: Dialect, date_col: str, periods: Sequence) -> str:
    """Is a row in one of the periods? Ranges on the bare column, so an index can serve them."""
    c = dialect.quote(date_col)
    found = [f"({c} >= '{low}' AND {c} < '{high}')" for low, high in period_ranges(list(periods))]
    return " OR ".join([*found, *([f"{c} IS NULL"] if None in periods else [])]) or "1 = 0"


def load_statements(
    dialect: Dialect, target: str, stage: str, keys: Sequence[str], columns: Sequence[str], method: str, within: str = ""
) -> list[str]:
    """``upsert``, ``delete_insert``, ``replace`` (delete all rows, insert the stage), ``replace_periods`` (delete the rows
    ``within`` a condition, insert the stage), or MySQL's ``unique_index``."""
    if method == "replace_periods" and not within:
        raise ValueError("replace_periods needs the condition of the rows to replace")
    if method == "upsert":
        return upsert_statements(dialect, target, stage, keys, columns)
    if method == "delete_insert":
        return delete_insert_statements(dialect, target, stage, keys, columns)
    if method == "unique_index":
        if dialect is not Dialect.MYSQL:
            raise ValueError("only MySQL matches on the target's unique indexes")
        return [unique_index_upsert_statement(target, stage, columns)]
    listed = ", ".join(dialect.quote(c) for c in columns)
    return [
        f"DELETE FROM {dialect.quote(target)}" + (f" WHERE {within}" if method == "replace_periods" else ""),
        f"INSERT INTO {dialect.quote(target)} ({listed}) SELECT {listed} FROM {dialect.quote(stage)}",
    ]


def run_in_transaction(connect: Callable[[], object], statements: Sequence[str]) -> list[int]:
    """Run statements over one DB-API connection: all are committed or none. Returns row counts.

    As DB-API has it, a connection opens its transaction by itself; it must not be in autocommit mode.
    """
    connection = connect()
    try:
        cursor = connection.cursor()
        try:
            counts = []
            for statement in statements:
                cursor.execute(statement)
                counts.append(cursor.rowcount)
            connection.commit()
            return counts
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()


def upsert_counts(rows_before: int, rows_after: int, affected: int) -> dict[str, int]:
    """Inserted and updated rows where an update counts as two affected rows."""
    inserted = rows_after - rows_before
    return {"inserted": inserted, "updated": (affected - inserted) // 2}


@dataclass(frozen=True)
class Warehouse:
    """A target database: Spark's connection plus a DB-API ``connect`` for the closing statements."""

    conn: Connection
    connect: Callable[[], object]
    partitions: int  # connections open at once
    text_width: int = TEXT_WIDTH

    def columns(self, spark, table: str) -> DataFrame:
        return query(spark, self.conn, f"SELECT * FROM {self.conn.dialect.quote(table)} WHERE 1 = 0")

    def count(self, spark, table: str) -> int:
        return query(spark, self.conn, f"SELECT COUNT(*) AS cnt FROM {self.conn.dialect.quote(table)}").first()["cnt"]

    def newest_us(self, spark, table: str, audit_col: str) -> int | None:
        found = query(spark, self.conn, newest_sql(self.conn.dialect, table, audit_col))
        return found.select(F.unix_micros(F.col("newest").cast("timestamp")).alias("us")).first()["us"]

    def add_columns(self, table: str, current: T.StructType, wanted: T.StructType) -> None:
        statements = add_column_ddl(table, current, wanted, self.conn.dialect, self.text_width)
        if statements:
            run_in_transaction(self.connect, statements)

    def load(
        self,
        batch: DataFrame,
        target: str,
        keys: Sequence[str],
        expected_rows: Callable[[], int],
        method: str = "upsert",
        evolve: bool = False,
        within: str = "",
    ) -> dict[str, int]:
        """Stage the common columns, check that the stage holds the batch exactly, then change the target.

        A task that is retried after its commit would leave rows twice in the stage; the count finds
        that before the target is touched. ``expected_rows`` is read after the batch has been written.
        """
        if method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        spark, dialect = batch.sparkSession, self.conn.dialect
        stage = target + STAGE_SUFFIX
        flat = nested_as_text(batch)
        if evolve:
            self.add_columns(target, self.columns(spark, target).schema, flat.schema)
        shared = common_columns(self.columns(spark, target), flat)
        names = [t for t, _ in shared]
        run_in_transaction(self.connect, clone_statements(dialect, target, stage, names))
        staged_rows = flat.select(*[F.col(name(b)).alias(t) for t, b in shared])
        checked, wide = observe_wide(staged_rows, self.text_width)
        writer(checked, self.conn, stage, "append", self.partitions, self.text_width).save()
        staged, expected = self.count(spark, stage), expected_rows()
        if staged != expected:
            raise RuntimeError(f"stage {stage} holds {staged} rows, the batch has {expected}")
        if wide():  # a lenient database has cut them
            raise ValueError(f"rows with text over {self.text_width} characters, by column: {wide()}")
        before = self.count(spark, target)
        counts = run_in_transaction(self.connect, load_statements(dialect, target, stage, keys, names, method, within))
        if method == "replace":
            return {"stg_rows": staged, "deleted": before, "inserted": staged}
        if method == "replace_periods":
            return {"stg_rows": staged, "deleted": before + staged - self.count(spark, target), "inserted": staged}
        if method == "unique_index":
            return {"stg_rows": staged, **upsert_counts(before, self.count(spark, target), counts[0])}
        inserted = self.count(spark, target) - before
        return {"stg_rows": staged, "inserted": inserted, "matched": staged - inserted}
