"""The data source over a database of the standard library, which is a file: no server."""

import sqlite3
from collections import Counter

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.quantiles import Bounds, even_bounds
from tablesync.sources.dbapi import DbApiSource, _Database, _Part, dbapi_options, read, write

SCHEMA = "id bigint, name string, price double"


@pytest.fixture
def base(spark, tmp_path):
    con = sqlite3.connect(f"{tmp_path}/t.db")
    con.execute("CREATE TABLE items (id INTEGER, name TEXT, price REAL)")
    rows = [(i * i, "Ab"[i % 2] * 3 if i % 5 else None, i / 4) for i in range(300)] + [(None, "none", None)]
    con.executemany("INSERT INTO items VALUES (?, ?, ?)", rows)
    con.commit()
    con.close()
    return tmp_path, rows


def options(base, table="items", fail=None, **more):
    arguments = [f"{base}/t.db", f"{base}/notes", *([f"{base}/{fail}"] if fail else [])]
    return dbapi_options("tests.dbapi_helper:connect", arguments, table=table, **more)


def notes(base):
    return open(f"{base}/notes").read()


def stored(base, table="items"):
    con = sqlite3.connect(f"{base}/t.db")
    try:
        return Counter(con.execute(f"SELECT * FROM {table}").fetchall()), [r[0] for r in con.execute("SELECT name FROM sqlite_master")]
    finally:
        con.close()


def test_one_query_for_each_part(spark, base):
    path, rows = base
    bounds = even_bounds(spark.createDataFrame(rows, SCHEMA), "id", 6)
    found = read(spark, SCHEMA, options(path, split=bounds))
    assert Counter(tuple(r) for r in found.collect()) == Counter(rows)
    assert found.rdd.getNumPartitions() == bounds.parts == 6
    assert notes(path).count("SELECT") >= 6 and f'"id" >= {bounds.inner[-1]}' in notes(path)
    sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) <= 60
    assert read(spark, "price double, id int", options(path)).count() == 301


def test_filters_are_sent(spark, base):
    path, rows = base
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = read(spark, SCHEMA, options(path, split=Bounds("id", (400,))))
        some = found.where((F.col("id") > 100) & (F.col("id") <= 2500) & F.col("name").isin("AAA", "bbb") & (F.col("price") < 9.5) & F.col("name").startswith("A"))
        got = Counter(tuple(r) for r in some.collect())
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert got == Counter(r for r in rows if r[0] is not None and 100 < r[0] <= 2500 and r[1] == "AAA" and r[2] < 9.5)
    sent = [line for line in notes(path).splitlines() if line.startswith("SELECT")]
    assert sent and all('("id" > ?)' in s and '("id" <= ?)' in s and '"name" IN (?, ?)' in s and "100, 2500" in s for s in sent)
    assert not any('"price" <' in s for s in sent)  # decided by Spark alone


def test_what_is_sent_never_keeps_fewer():
    db = _Database("tests.dbapi_helper:connect", "[]", '"')
    source = DbApiSource({"connect": db.connect, "table": 's."t"', "filters": "true"})
    reader = source.reader(T._parse_datatype_string(SCHEMA))
    sent = [ds.EqualTo(("name",), "x"), ds.GreaterThanOrEqual(("id",), 4), ds.IsNull(("id",)), ds.IsNotNull(("id",)), ds.In(("id",), (1, 2)), ds.LessThan(("id",), 9)]
    kept = [ds.GreaterThan(("name",), "x"), ds.EqualTo(("a", "b"), 1), ds.Not(ds.IsNull(("id",))), ds.In(("name",), ("x", None)), ds.EqualTo(("flag",), True), ds.StringContains(("name",), "x")]
    assert list(reader.pushFilters([*sent, *kept])) == [*sent, *kept]
    assert len(reader.conditions) == len(sent) and reader.values == ["x", 4, 1, 2, 9]
    assert reader.statement(_Part("1 = 1")).startswith('SELECT "id", "name", "price" FROM "s"."""t""" WHERE (1 = 1) AND ("name" = ?)')


@pytest.mark.parametrize("fail", [None, "lost"])
def test_each_row_is_written_once(spark, base, fail):
    path, rows = base
    new = [(10_000 + i, f"n{i}", None if i % 7 == 0 else i / 2) for i in range(4000)]
    frame = spark.createDataFrame(new, SCHEMA).repartition(4)
    write(frame, options(path, fail=fail))
    found, tables = stored(path)
    assert found == Counter(rows) + Counter(new) and tables == ["items"]
    if fail:
        assert (path / fail).exists()  # an attempt was lost after its rows were there
    write(frame.limit(5), options(path), "overwrite")
    assert sum(stored(path)[0].values()) == 5


def test_a_failed_write_leaves_nothing(spark, base):
    path, rows = base
    broken = spark.range(100).select(F.col("id"), F.when(F.col("id") == 77, F.raise_error(F.lit("bad row"))).otherwise(F.lit("x")).cast("string").alias("name"), F.lit(1.0).alias("price"))
    with pytest.raises(Exception, match="bad row"):
        write(broken.repartition(4), options(path))
    assert stored(path) == (Counter(rows), ["items"])
    write(spark.createDataFrame([], SCHEMA), options(path))
    assert stored(path) == (Counter(rows), ["items"])


def test_a_closing_step_that_finds_too_few_rows_fails(base):
    path, rows = base
    writer = DbApiSource(options(path)).writer(T._parse_datatype_string(SCHEMA), True)
    message = writer.write(iter([(1, "a", 1.0)]))
    writer.write(iter([(2, "b", 2.0)]))  # an attempt that nobody reports
    message.rows = 2
    with pytest.raises(RuntimeError, match="lacks rows"):
        writer.commit([message])
    assert stored(path)[0] == Counter(rows)
    message.rows = 1
    writer.commit([message, None])
    assert stored(path) == (Counter([(1, "a", 1.0)]), ["items"])
