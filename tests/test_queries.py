"""Every registered query against its SQL, run by DuckDB on the same files."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from tablesync.plans.oracle import ORACLE
from tablesync.plans.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("query", NAMES)
def test_same_as_sql(spark, sf_dir, duck, query):
    result = contract.queries()[query](spark, sf_dir)
    rows = [tuple(r) for r in result.collect()]
    cursor = duck.execute(contract.oracle_sql()[query])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert bag(result.columns, rows) == bag(columns, expected)
    assert rows


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())
