"""A Spark data source over any DB-API connection: split reads with pushed filters, and writes that commit in two steps.

    options = dbapi_options("sqlite3:connect", ["/lake/app.db"], table="orders", split=even_bounds(keys, "id", 32))
    read(spark, "id bigint, name string", options)

Reading: each part of ``split`` is a query of its own, in a task of its own; filters go into it as parameters (where
``spark.sql.python.filterPushdown.enabled`` is on). A database may compare texts by rules of its own, so only filters that
it can widen but not narrow are sent, and Spark applies all of them again.

Writing: a task puts its rows into a stage table under a token of its own and commits them; its message carries the
token. When all tasks are done the driver's closing step moves the rows of the reported tokens to the target, in one
transaction, after counting them. Rows of an attempt that failed, whenever it did, have a token that nobody
reports; they go with the stage table, as do all rows of a write that is aborted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from importlib import import_module

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablesync.operators.quantiles import Bounds

#: Rows fetched or sent at once.
ROWS = 5000
TOKEN = "write_token"


def dbapi_options(connect: str, arguments: Sequence | dict = (), *, table: str, split: Bounds | None = None, quote: str = '"') -> dict[str, str]:
    """Options of a read or write: ``connect`` is module:function, called with the arguments in every task."""
    held = {"connect": connect, "arguments": json.dumps(list(arguments) if not isinstance(arguments, dict) else arguments), "table": table, "quote": quote}
    if split is not None:
        held["split"] = json.dumps([split.column, list(split.inner)])
    return held


@dataclass(frozen=True)
class _Database:
    """How a task reaches the database."""

    connect: str
    arguments: str
    quote: str

    @property
    def module(self):
        return import_module(self.connect.partition(":")[0])

    def open(self):
        call, arguments = getattr(self.module, self.connect.partition(":")[2]), json.loads(self.arguments)
        return call(**arguments) if isinstance(arguments, dict) else call(*arguments)

    def name(self, identifier: str) -> str:
        return ".".join(self.quote + p.replace(self.quote, 2 * self.quote) + self.quote for p in identifier.split("."))

    def mark(self) -> str:
        """A parameter's place in a statement."""
        style = getattr(self.module, "paramstyle", "qmark")
        if style not in ("qmark", "format", "pyformat"):
            raise ValueError(f"parameter style {style} is not supported")
        return "?" if style == "qmark" else "%s"


def _condition(f: ds.Filter, db: _Database) -> tuple[str, list] | None:
    """SQL of a filter that keeps at least the rows that Spark keeps; None where the database might keep fewer."""
    column = db.name(".".join(f.attribute)) if hasattr(f, "attribute") and len(f.attribute) == 1 else None
    if column is None:
        return None
    if isinstance(f, ds.IsNull):
        return f"{column} IS NULL", []
    if isinstance(f, ds.IsNotNull):
        return f"{column} IS NOT NULL", []
    number = lambda v: isinstance(v, int) and not isinstance(v, bool)
    text = lambda v: isinstance(v, str)
    if isinstance(f, ds.EqualTo) and (number(f.value) or text(f.value)):
        return f"{column} = {db.mark()}", [f.value]
    if isinstance(f, ds.In) and f.value and all(number(v) or text(v) for v in f.value):
        return f"{column} IN ({', '.join([db.mark()] * len(f.value))})", list(f.value)
    signs = {ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<", ds.LessThanOrEqual: "<="}
    sign = signs.get(type(f))
    return (f"{column} {sign} {db.mark()}", [f.value]) if sign and number(f.value) else None


@dataclass
class _Part(ds.InputPartition):
    predicate: str


class _Reader(ds.DataSourceReader):
    def __init__(self, db: _Database, table: str, split: Bounds | None, schema: T.StructType):
        self.db, self.table, self.split, self.schema = db, table, split, schema
        self.conditions: list[str] = []
        self.values: list = []

    def partitions(self):
        if self.split is None:
            return [_Part("1 = 1")]
        return [_Part(p) for p in self.split.predicates(self.db.name(self.split.column))]

    def statement(self, part: _Part) -> str:
        columns = ", ".join(self.db.name(f.name) for f in self.schema.fields)
        where = " AND ".join(f"({c})" for c in (part.predicate, *self.conditions))
        return f"SELECT {columns} FROM {self.db.name(self.table)} WHERE {where}"

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        connection = self.db.open()
        try:
            cursor = connection.cursor()
            cursor.arraysize = ROWS
            cursor.execute(self.statement(partition), self.values)
            while rows := cursor.fetchmany(ROWS):
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        finally:
            connection.close()


class _FilteringReader(_Reader):
    """Spark refuses a reader with this method while its push-down is off."""

    def pushFilters(self, filters):
        for f in filters:
            found = _condition(f, self.db)
            if found:
                self.conditions.append(found[0])
                self.values += found[1]
            yield f  # Spark applies it as well


@dataclass
class _Written(ds.WriterCommitMessage):
    token: str
    rows: int


class _Writer(ds.DataSourceWriter):
    def __init__(self, db: _Database, table: str, schema: T.StructType, overwrite: bool):
        self.db, self.table, self.columns, self.overwrite = db, table, schema.names, overwrite
        self.stage = f"{table}_stage_{uuid.uuid4().hex}"
        self._run([f"CREATE TABLE {db.name(self.stage)} AS SELECT {self._names()}, CAST('' AS CHAR(32)) AS {db.name(TOKEN)} FROM {db.name(table)} WHERE 1 = 0"])

    def _names(self) -> str:
        return ", ".join(self.db.name(c) for c in self.columns)

    def _run(self, statements: Sequence[str]) -> None:
        connection = self.db.open()
        try:
            for s in statements:
                connection.cursor().execute(s)
            connection.commit()
        finally:
            connection.close()

    def write(self, iterator: Iterator) -> _Written:
        token, count = uuid.uuid4().hex, 0
        marks = ", ".join([self.db.mark()] * (len(self.columns) + 1))
        statement = f"INSERT INTO {self.db.name(self.stage)} ({self._names()}, {self.db.name(TOKEN)}) VALUES ({marks})"
        connection = self.db.open()
        try:
            cursor, held = connection.cursor(), []
            for row in iterator:
                held.append((*row, token))
                if len(held) == ROWS:
                    cursor.executemany(statement, held)
                    count, held = count + len(held), []
            if held:
                cursor.executemany(statement, held)
            connection.commit()
        finally:
            connection.close()
        return _Written(token, count + len(held))

    def commit(self, messages: list[_Written | None]) -> None:
        stage, target = self.db.name(self.stage), self.db.name(self.table)
        reported = {m.token: m.rows for m in messages if m is not None}
        connection = self.db.open()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT {self.db.name(TOKEN)}, count(*) FROM {stage} GROUP BY {self.db.name(TOKEN)}")
            staged = dict(cursor.fetchall())
            short = {t: n for t, n in reported.items() if staged.get(t, 0) != n}
            if short:
                raise RuntimeError(f"the stage table lacks rows of {len(short)} tasks")
            if self.overwrite:
                cursor.execute(f"DELETE FROM {target}")
            for token in reported:
                cursor.execute(f"INSERT INTO {target} ({self._names()}) SELECT {self._names()} FROM {stage} WHERE {self.db.name(TOKEN)} = {self.db.mark()}", [token])
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()
        self._run([f"DROP TABLE {stage}"])

    def abort(self, messages: list[_Written | None]) -> None:
        self._run([f"DROP TABLE IF EXISTS {self.db.name(self.stage)}"])


class DbApiSource(ds.DataSource):
    """The data source ``dbapi``; see :func:`dbapi_options`."""

    @classmethod
    def name(cls) -> str:
        return "dbapi"

    def _database(self) -> _Database:
        return _Database(self.options["connect"], self.options.get("arguments", "[]"), self.options.get("quote", '"'))

    def schema(self):
        raise ValueError("give the columns to read: spark.read.format('dbapi').schema(...)")

    def reader(self, schema: T.StructType) -> _Reader:
        held = self.options.get("split")
        column, inner = json.loads(held) if held else (None, ())
        kind = _FilteringReader if self.options.get("filters") == "true" else _Reader
        return kind(self._database(), self.options["table"], Bounds(column, tuple(inner)) if held else None, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> _Writer:
        return _Writer(self._database(), self.options["table"], schema, overwrite)


def read(spark: SparkSession, schema: str | T.StructType, options: dict[str, str]) -> DataFrame:
    """The table's columns named in the schema; filters are sent where the session's push-down is on."""
    spark.dataSource.register(DbApiSource)
    sends = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("dbapi").schema(schema).options(**options, filters=sends).load()


def write(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    """Append the rows to the table, or put them in place of its rows (``overwrite``), all or none."""
    df.sparkSession.dataSource.register(DbApiSource)
    df.write.format("dbapi").mode(mode).options(**options).save()
