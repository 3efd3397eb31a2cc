"""Options and statements of the JDBC layer. No database server is started.

The closing statements run in DuckDB's in-memory engine, the one that also checks the queries.
"""

import duckdb
import pytest
from pyspark.sql import types as T

from tablesync.sinks import jdbc as sink
from tablesync.sources import jdbc as source
from tablesync.sources.jdbc import Connection, Dialect, Split

CONN = Connection("jdbc:redshift://host/db", Dialect.REDSHIFT, {"user": "u", "password": "hidden"})


def test_secrets_stay_out_of_text():
    assert "hidden" not in repr(CONN)


def test_dialects_are_exact():
    assert Dialect("mysql") is Dialect.MYSQL
    with pytest.raises(ValueError):
        Dialect("mysql-like")
    assert Dialect.MYSQL.quote("db.a`b") == "`db`.`a``b`"


def test_split_options():
    options = source.table_options(CONN, "s.t", Split("id", 0, 14999, 8))
    assert options["dbtable"] == '"s"."t"'
    assert {k: options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "14999",
        "numPartitions": "8",
    }
    assert source.table_options(CONN, "SELECT 1 AS x")["dbtable"] == "(SELECT 1 AS x) src"


def test_bounds_statement_runs():
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM range(3, 10) r(id)")
    assert con.execute(source.bounds_sql(CONN, "id", "t")).fetchall() == [(3, 9, 7)]
    assert con.execute(source.bounds_sql(CONN, "id", "SELECT * FROM t WHERE id > 5")).fetchall() == [(6, 9, 4)]


@pytest.mark.parametrize("size_mb, parts", [(100, 8), (130 * 20, 24), (None, 8)])
def test_split_planning(spark, monkeypatch, size_mb, parts):
    def answer(spark, conn, sql):
        if "svv_table_info" in sql:
            assert "'s'" in sql and "'it''s'" in sql
            return spark.createDataFrame([] if size_mb is None else [(size_mb,)], "size_mb int")
        return spark.sql("SELECT 3 AS lower_limit, 90 AS upper_limit, 50 AS tbl_cnt")

    monkeypatch.setattr(source, "query", answer)
    assert source.plan_split(spark, CONN, "s.it's", "id") == Split("id", 3, 90, parts)


def test_no_split_of_an_empty_extraction(spark, monkeypatch):
    monkeypatch.setattr(source, "query", lambda *_: spark.sql("SELECT NULL AS lower_limit, NULL AS upper_limit, 0 AS tbl_cnt"))
    assert source.find_split(spark, CONN, "t", "id", 8) is None


def test_write_options(spark):
    df = spark.sql("SELECT 1 AS id, 'x' AS `a b`, 'y' AS c, array(1) AS l")
    flat = sink.nested_as_text(df)
    assert dict(flat.dtypes)["l"] == "string" and flat.first()["l"] == "[1]"
    options = sink.write_options(CONN, "t_stg", flat, 4000)
    assert options["createTableColumnTypes"] == "`a b` VARCHAR(4000), `c` VARCHAR(4000), `l` VARCHAR(4000)"
    assert (options["truncate"], options["batchsize"]) == ("true", "10000")
    assert "numPartitions" not in options
    assert "createTableColumnTypes" not in sink.write_options(CONN, "t", df.select("id"), 10)
    mysql = Connection("jdbc:mysql://h/d", Dialect.MYSQL)
    assert sink.write_options(mysql, "t", df, 10)["rewriteBatchedStatements"] == "true"


def test_too_wide(spark):
    df = spark.createDataFrame([("short", "x" * 5001), ("short", None)], "a string, b string")
    checked, wide = sink.observe_wide(df)
    checked.collect()
    assert wide() == {"b": 1}
    assert sink.observe_wide(spark.range(3))[1]() == {}


@pytest.fixture
def duck(tmp_path):
    path = f"{tmp_path}/wh.db"
    with duckdb.connect(path) as con:
        con.execute("CREATE TABLE tgt(id INT, v VARCHAR, own VARCHAR)")
        con.execute("INSERT INTO tgt VALUES (1,'a','o'), (2,'b','o'), (NULL,'n','o')")
        con.execute("CREATE TABLE tgt_sync_stg(id INT, v VARCHAR)")
        con.execute("INSERT INTO tgt_sync_stg VALUES (2,'B'), (3,'c'), (NULL,'m')")
    return path


class Session:
    """DB-API behaviour over DuckDB, whose own cursors do not share a transaction."""

    def __init__(self, path):
        self.con = duckdb.connect(path)
        self.con.begin()
        self.commit, self.rollback, self.close = self.con.commit, self.con.rollback, self.con.close
        self.execute, self.rowcount = self.con.execute, -1

    def cursor(self):
        return self


def content(path, table="tgt"):
    with duckdb.connect(path) as con:
        return sorted(con.execute(f"SELECT * FROM {table}").fetchall(), key=str)


def test_merge_statement(duck):
    statements = sink.upsert_statements(Dialect.REDSHIFT, "tgt", "tgt_sync_stg", ["id"], ["id", "v"])
    sink.run_in_transaction(lambda: Session(duck), statements)
    expected = [(1, "a", "o"), (2, "B", "o"), (3, "c", None), (None, "m", None), (None, "n", "o")]
    assert content(duck) == sorted(expected, key=str)


def test_delete_insert_statements(duck):
    statements = sink.delete_insert_statements(Dialect.REDSHIFT, "tgt", "tgt_sync_stg", ["id"], ["id", "v"])
    sink.run_in_transaction(lambda: Session(duck), statements)
    expected = [(1, "a", "o"), (2, "B", None), (3, "c", None), (None, "m", None), (None, "n", "o")]
    assert content(duck) == sorted(expected, key=str)


def test_clone_statements(duck):
    sink.run_in_transaction(lambda: Session(duck), sink.clone_statements(Dialect.REDSHIFT, "tgt", "tgt_sync_stg", ["id"]))
    assert content(duck, "tgt_sync_stg") == []
    with duckdb.connect(duck) as con:
        assert [r[0] for r in con.execute("DESCRIBE tgt_sync_stg").fetchall()] == ["id"]
    keep = sink.clone_statements(Dialect.REDSHIFT, "tgt", "copy", replace=False)
    assert keep == ['CREATE TABLE IF NOT EXISTS "copy" AS SELECT * FROM "tgt" WHERE 1 = 0']


def test_a_failing_statement_rolls_back(duck):
    before = content(duck)
    with pytest.raises(duckdb.Error):
        sink.run_in_transaction(lambda: Session(duck), ["DELETE FROM tgt", "DELETE FROM nowhere"])
    assert content(duck) == before


def test_replace_statements(duck):
    statements = sink.load_statements(Dialect.REDSHIFT, "tgt", "tgt_sync_stg", [], ["id", "v"], "replace")
    sink.run_in_transaction(lambda: Session(duck), statements)
    assert content(duck) == sorted([(2, "B", None), (3, "c", None), (None, "m", None)], key=str)


def test_period_statements():
    assert source.period_sql(Dialect.MYSQL, "a.d") == "DATE_FORMAT(`a`.`d`, '%Y%m')"
    assert source.period_sql(Dialect.REDSHIFT, "d", "") == "TO_CHAR(\"d\", 'YYYYMM')"
    assert source.period_sql(Dialect.REDSHIFT, "d", "daily") == 'DATE("d")'
    assert source.newest_sql(Dialect.REDSHIFT, "s.t", "d") == 'SELECT MAX("d") AS newest FROM "s"."t"'


class FakeWarehouse(sink.Warehouse):
    """Every call into a database replaced by a record of it."""

    def columns(self, spark, table):
        return spark.createDataFrame([], "id int, v string, own string")

    def count(self, spark, table):
        return self.conn.options["counts"].pop(0)


@pytest.fixture
def fake(spark, monkeypatch):
    sent, written = [], []
    monkeypatch.setattr(sink, "run_in_transaction", lambda connect, statements: sent.append(list(statements)))

    class Writer:
        def __init__(self, df, conn, table, *rest):
            self.df, self.table = df, table

        def save(self):
            written.append((self.table, self.df.columns, self.df.count()))

    monkeypatch.setattr(sink, "writer", Writer)

    def make(*counts):
        return FakeWarehouse(Connection("jdbc:x", Dialect.REDSHIFT, {"counts": list(counts)}), lambda: None, 8), sent, written

    return make


def test_load_stages_common_columns_checks_and_merges(spark, fake):
    warehouse, sent, written = fake(2, 10, 11)
    batch = spark.createDataFrame([("extra", 1, "a"), ("extra", 2, "b")], "more string, ID int, v string")
    stats = warehouse.load(batch, "s.t", ["id"], lambda: 2)
    assert stats == {"stg_rows": 2, "inserted": 1, "matched": 1}
    assert written == [("s.t_sync_stg", ["id", "v"], 2)]
    assert sent == [
        sink.clone_statements(Dialect.REDSHIFT, "s.t", "s.t_sync_stg", ["id", "v"]),
        sink.upsert_statements(Dialect.REDSHIFT, "s.t", "s.t_sync_stg", ["id"], ["id", "v"]),
    ]


def test_load_refuses_a_stage_that_differs_from_the_batch(spark, fake):
    warehouse, sent, _ = fake(3)
    with pytest.raises(RuntimeError, match="holds 3 rows"):
        warehouse.load(spark.createDataFrame([(1, "a")], "id int, v string"), "s.t", ["id"], lambda: 1)
    assert len(sent) == 1
    with pytest.raises(ValueError, match="method"):
        warehouse.load(spark.range(1), "s.t", ["id"], lambda: 1, "other")


def test_load_can_add_columns_first(spark, fake):
    warehouse, sent, _ = fake(1, 5)
    batch = spark.createDataFrame([(1, "a", 2.0)], "id int, v string, w double")
    stats = warehouse.load(batch, "t", ["id"], lambda: 1, "replace", evolve=True)
    assert sent[0] == ['ALTER TABLE "t" ADD COLUMN "w" DOUBLE PRECISION']
    assert stats == {"stg_rows": 1, "deleted": 5, "inserted": 1}


def test_load_reports_text_that_is_too_long(spark, fake):
    warehouse, sent, _ = fake(1)
    with pytest.raises(ValueError, match="'v': 1"):
        warehouse.load(spark.createDataFrame([(1, "x" * 4001)], "id int, v string"), "s.t", ["id"], lambda: 1)
    assert len(sent) == 1  # the stage alone


def test_added_columns_have_the_warehouse_width(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(sink, "run_in_transaction", lambda connect, statements: sent.extend(statements))
    wide = sink.Warehouse(Connection("jdbc:x", Dialect.MYSQL, {}), lambda: None, 8, 300)
    wide.add_columns("t", T.StructType(), T.StructType([T.StructField("v", T.StringType())]))
    assert sent == ["ALTER TABLE `t` ADD COLUMN `v` VARCHAR(300)"]


def test_unique_index_method(spark, monkeypatch):
    assert sink.load_statements(Dialect.MYSQL, "t", "s", ["a"], ["a"], "unique_index") == [
        sink.unique_index_upsert_statement("t", "s", ["a"])
    ]
    with pytest.raises(ValueError, match="MySQL"):
        sink.load_statements(Dialect.REDSHIFT, "t", "s", ["a"], ["a"], "unique_index")


def test_mysql_statements():
    update, insert = sink.upsert_statements(Dialect.MYSQL, "d.tgt", "d.stg", ["a", "b"], ["a", "b", "v"])
    assert update == (
        "UPDATE `d`.`tgt` AS t JOIN `d`.`stg` AS s ON t.`a` = s.`a` AND t.`b` = s.`b` "
        "SET t.`a` = s.`a`, t.`b` = s.`b`, t.`v` = s.`v`"
    )
    assert insert == (
        "INSERT INTO `d`.`tgt` (`a`, `b`, `v`) SELECT s.`a`, s.`b`, s.`v` FROM `d`.`stg` AS s "
        "LEFT JOIN `d`.`tgt` AS t ON t.`a` = s.`a` AND t.`b` = s.`b` WHERE t.`a` IS NULL"
    )
    assert sink.unique_index_upsert_statement("t", "s", ["a", "v"]) == (
        "INSERT INTO `t` (`a`, `v`) SELECT `a`, `v` FROM `s` ON DUPLICATE KEY UPDATE `a` = VALUES(`a`), `v` = VALUES(`v`)"
    )
    with pytest.raises(ValueError):
        sink.upsert_statements(Dialect.MYSQL, "t", "s", [], ["a"])


def test_upsert_counts():
    assert sink.upsert_counts(10, 13, 7) == {"inserted": 3, "updated": 2}
