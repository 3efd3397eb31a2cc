import csv
import glob
import random
import uuid
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.plans import merge_into, stage
from tablesync.sinks import PartitionedDir, VersionedDir, ddl, delimited, publish
from tablesync.sources.jdbc import Dialect


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def two(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")


def test_modes(spark, name):
    df = two(spark)
    publish.publish_table(df, name, mode="error")
    with pytest.raises(PySparkException):
        publish.publish_table(df, name, mode="error")
    publish.publish_table(df.limit(0), name, mode="ignore")
    publish.publish_table(df.select("v", "id"), name, mode="append")
    assert rows(spark.table(name)) == Counter({(1, "a"): 2, (2, "b"): 2})
    publish.publish_table(spark.range(1), name, mode="overwrite")
    assert spark.table(name).columns == ["id"]
    with pytest.raises(ValueError):
        publish.publish_table(df, name, mode="upsert")


def test_append_needs_the_same_columns_without_merge_schema(spark, name):
    publish.publish_table(two(spark), name)
    with pytest.raises(ValueError, match="extra"):
        publish.publish_table(two(spark).withColumn("extra", F.lit(1)), name, mode="append")


def test_merge_schema_append_and_overwrite(spark, name):
    publish.publish_table(two(spark), name)
    new = spark.createDataFrame([(3, 1.5)], "id int, w double")
    publish.publish_table(new, name, mode="append", schema_option="mergeSchema")
    assert rows(spark.table(name)) == Counter([(1, "a", None), (2, "b", None), (3, None, 1.5)])


def test_merge_schema_overwrite_keeps_old_columns(spark, name):
    publish.publish_table(two(spark), name)
    new = spark.createDataFrame([(3, 1.5)], "id int, w double")
    publish.publish_table(new, name, mode="overwrite", schema_option="mergeSchema")
    assert rows(spark.table(name).select("id", "v", "w")) == Counter([(3, None, 1.5)])


def test_partitioned_publish_and_append(spark, name):
    publish.publish_table(two(spark).withColumn("p", F.lit("x")), name, partition_by=["p"], primary_keys="id")
    more = spark.createDataFrame([("y", 3, 1.5)], "p string, id int, w double")
    publish.publish_table(more, name, mode="append", schema_option="mergeSchema", primary_keys="id")
    found = spark.table(name)
    assert rows(found.select("id", "v", "p", "w")) == Counter([(1, "a", "x", None), (2, "b", "x", None), (3, None, "y", 1.5)])
    assert any("p=y" in f for f in found.inputFiles())


def test_keys_are_first_checked_and_recorded(spark, name):
    df = two(spark).select("v", "id")
    publish.publish_table(df, name, primary_keys="id", comment="it's a table")
    assert spark.table(name).columns == ["id", "v"]
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties[publish.KEY_PROPERTY] == "id"
    with pytest.raises(ValueError, match="not unique"):
        publish.publish_table(df.unionAll(df), name, primary_keys=["id"])
    with pytest.raises(ValueError, match="NULL"):
        publish.publish_table(df.withColumn("id", F.lit(None).cast("int")), name, primary_keys=["id"])


def test_empty_clone(spark, name):
    publish.publish_table(two(spark), name)
    publish.empty_clone(spark, name, f"{name}_a")
    assert spark.table(f"{name}_a").schema == spark.table(name).schema
    assert spark.table(f"{name}_a").isEmpty()
    publish.empty_clone(spark, name, f"{name}_b", columns=["v"])
    assert spark.table(f"{name}_b").columns == ["v"]
    publish.publish_table(two(spark), f"{name}_a", mode="append")
    publish.empty_clone(spark, name, f"{name}_a", replace=False)
    assert spark.table(f"{name}_a").count() == 2
    publish.empty_clone(spark, name, f"{name}_a")
    assert spark.table(f"{name}_a").isEmpty()


def test_keyed_table(spark, tmp_path, name):
    table = VersionedDir(spark, f"{tmp_path}/keyed")
    schema = "v string, day date, id int"
    first = spark.createDataFrame([("a", None, 1)], schema).withColumn("day", F.expr("DATE'2024-01-01'"))
    publish.upsert_keyed(first, table, "id", timestamp_keys="day", table=name)
    second = first.withColumn("v", F.lit("b")).unionAll(first.withColumn("day", F.expr("DATE'2024-01-02'")))
    publish.upsert_keyed(second.withColumn("more", F.lit(1)), table, "id", timestamp_keys="day", table=name)
    assert spark.table(name).columns == ["id", "day", "v", "more"]
    assert rows(spark.table(name).select("id", "v", "more")) == Counter([(1, "b", 1), (1, "a", 1)])
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties[publish.TIME_KEY_PROPERTY] == "day"
    publish.upsert_keyed(second, table, "id", timestamp_keys="day", table=name)
    assert spark.table(name).count() == 2
    publish.upsert_keyed(first, table, "id", timestamp_keys="day", mode="overwrite", table=name)
    assert spark.table(name).count() == 1
    with pytest.raises(ValueError):
        publish.upsert_keyed(first, table, [])
    with pytest.raises(PySparkException, match="NULL in key"):
        publish.upsert_keyed(first.withColumn("id", F.lit(None).cast("int")), table, "id")


def test_keyed_table_with_a_change_feed(spark, tmp_path):
    table = VersionedDir(spark, f"{tmp_path}/keyed")
    assert table.read_changes() is None
    publish.upsert_keyed(two(spark), table, "id", feed=True)
    publish.upsert_keyed(spark.createDataFrame([(2, "B")], "id int, v string"), table, "id", feed=True)
    publish.upsert_keyed(two(spark).where("id = 1"), table, "id", feed=True, mode="overwrite")
    assert rows(table.read_changes()) == Counter(
        [
            (1, "a", "insert", 1),
            (2, "b", "insert", 1),
            (2, "b", "update_preimage", 2),
            (2, "B", "update_postimage", 2),
            (2, "B", "delete", 3),
        ]
    )
    assert rows(table.read_changes(after=2)) == Counter([(2, "B", "delete", 3)])
    table.vacuum(1)
    assert table.read_changes(after=2).count() == 1
    with pytest.raises(LookupError, match="1 to 2"):
        table.read_changes()


def test_keyed_table_moves_rows_between_partitions(spark, tmp_path):
    table = VersionedDir(spark, f"{tmp_path}/keyed")
    publish.upsert_keyed(two(spark), table, "id", partition_by=["v"])
    moved = spark.createDataFrame([(1, "b")], "id int, v string")
    publish.upsert_keyed(moved, table, "id", partition_by=["v"])
    assert rows(table.read().select("id", "v")) == Counter([(1, "b"), (2, "b")])


def test_compaction_keeps_rows_and_joins_files(spark, tmp_path):
    table = VersionedDir(spark, f"{tmp_path}/small")
    table.write(spark.range(1000).repartition(20))
    publish.compact(table)
    assert len(table.read().inputFiles()) == 1
    assert table.read().agg(F.sum("id"), F.count("id")).first()[:] == (499500, 1000)
    table.write(table.read().withColumn("p", F.col("id") % 2).repartition(20), ["p"])
    publish.compact(table)
    assert len([f for f in table.read().inputFiles() if "p=" in f]) == 2 and table.layout() == ["p"]
    assert table.read().count() == 1000
    publish.upsert_keyed(spark.range(990, 1010).withColumn("p", F.col("id") % 2), table, "id")
    assert table.layout() == ["p"] and table.read().count() == 1010


def test_a_refused_publish_leaves_the_table_as_it_was(spark, name):
    publish.publish_table(two(spark), name, primary_keys="ID")
    for bad in ([(3, "c"), (3, "d")], [(None, "n")], [(2, "again")]):
        with pytest.raises(ValueError):
            publish.publish_table(spark.createDataFrame(bad, "id int, v string"), name, mode="append", primary_keys="id")
    assert rows(spark.table(name)) == Counter([(1, "a"), (2, "b")])
    assert publish.key_first(two(spark), ["V"]).columns == ["v", "id"]


def test_keyed_input_is_evaluated_once(spark, tmp_path):
    table = VersionedDir(spark, f"{tmp_path}/keyed")
    publish.upsert_keyed(two(spark), table, "id")
    evaluated = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    more = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    publish.upsert_keyed(more.mapInArrow(count, more.schema), table, "id", feed=True)
    assert evaluated.value == 2 and table.read_changes(after=1).count() == 3


def merge_rows(table, batch, keys, **options):
    staged = stage(batch.sparkSession, batch, None)
    return merge_into(table, staged, keys, **options)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_touched_partitions_only(spark, tmp_path, limit):
    table = PartitionedDir(spark, f"{tmp_path}/parts", ["p"])
    assert not table.exists()
    base = spark.range(30).select((F.col("id") % 3).cast("int").alias("p"), "id", F.lit("a").alias("v"))
    assert merge_rows(table, base, ["p", "id"])["inserted"] == 30
    before = set(table.read().inputFiles())
    batch = spark.createDataFrame([(1, 1, "b"), (1, 100, "n"), (7, 7, "new")], "p int, id bigint, v string")
    stats = merge_rows(table, batch, ["p", "id"], broadcast_limit=limit)
    assert stats == {"inserted": 2, "updated": 1, "unchanged": 0, "kept": 9}
    after = table.read()
    assert {f for f in before if "p=1" not in f} == {f for f in after.inputFiles() if "p=0" in f or "p=2" in f}
    assert after.count() == 32
    assert rows(after.where("v <> 'a'").select("p", "id", "v")) == rows(batch)
    assert merge_rows(table, batch, ["p", "id"])["updated"] == 0
    assert table.read().count() == 32
    with pytest.raises(ValueError, match="merge keys"):
        merge_rows(table, batch, ["id"])


def test_partitioned_table_keeps_types_and_null_partitions(spark, tmp_path):
    table = PartitionedDir(spark, f"{tmp_path}/parts", ["code"])
    first = spark.createDataFrame([("007", 1), (None, 2), ("a/b c", 3)], "code string, id int")
    merge_rows(table, first, ["code", "id"])
    merge_rows(table, first.where("id <> 1"), ["code", "id"])
    # a NULL key never matches: the row is inserted again
    assert rows(table.read().select("code", "id")) == Counter({("007", 1): 1, (None, 2): 2, ("a/b c", 3): 1})
    table.replace(first.where("id = 1"))
    assert rows(table.read().select("code", "id")) == Counter([("007", 1)])


def test_a_directory_of_unknown_origin_is_not_overwritten(spark, tmp_path):
    df = spark.createDataFrame([("07", 1), ("08", 2)], "p string, id int")
    df.write.partitionBy("p").parquet(f"{tmp_path}/theirs")
    table = PartitionedDir(spark, f"{tmp_path}/theirs", ["p"])
    for write in (table.write, table.replace):
        with pytest.raises(FileExistsError):
            write(df)
    table.adopt(df.schema)
    batch = spark.createDataFrame([("08", 3)], "p string, id int")
    assert merge_rows(table, batch, ["p", "id"]) == {"inserted": 1, "updated": 0, "unchanged": 0, "kept": 1}
    assert rows(table.read().select("p", "id")) == Counter([("07", 1), ("08", 2), ("08", 3)])


def test_export_quotes_minimally_and_keeps_empty_text(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, None), (2, ""), (3, 'a,"b"'), (4, " plain "), (None, "x\\y")], "ID int, Txt string"
    )
    delimited.export_delimited(df.coalesce(1), f"{tmp_path}/out")
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert lines == ["id,txt", "1,\\n\\n", "2,", '3,"a,""b"""', "4, plain ", "\\n\\n,x\\y"]


@pytest.mark.parametrize("delimiter", [",", "|", "\t"])
def test_export_is_read_back_by_a_csv_reader(spark, tmp_path, delimiter):
    rnd = random.Random(delimiter)
    values = ["".join(rnd.choices(f'ab "{delimiter}\\\n\'', k=rnd.randrange(8))) for _ in range(300)]
    df = spark.createDataFrame([(i, v if i % 7 else None) for i, v in enumerate(values)], "ID int, Txt string")
    delimited.export_delimited(df.coalesce(1), f"{tmp_path}/out", delimiter=delimiter)
    (path,) = glob.glob(f"{tmp_path}/out/*.csv")
    with open(path, newline="", encoding="utf-8") as file:
        found = list(csv.reader(file, delimiter=delimiter))
    assert found[0] == ["id", "txt"]
    expected = [[str(i), v if i % 7 else "\\n\\n"] for i, v in enumerate(values)]
    assert sorted(found[1:], key=lambda row: int(row[0])) == expected


def test_schema_diff_statements():
    have = T.StructType.fromDDL("id int")
    want = T.StructType.fromDDL("ID int, s string, d decimal(10,2), t timestamp, v varchar(20)")
    assert ddl.add_column_ddl("db.t", have, want) == [
        "ALTER TABLE `db`.`t` ADD COLUMNS (`s` string)",
        "ALTER TABLE `db`.`t` ADD COLUMNS (`d` decimal(10,2))",
        "ALTER TABLE `db`.`t` ADD COLUMNS (`t` timestamp)",
        "ALTER TABLE `db`.`t` ADD COLUMNS (`v` varchar(20))",
    ]
    assert ddl.add_column_ddl("db.t", have, want, Dialect.REDSHIFT) == [
        'ALTER TABLE "db"."t" ADD COLUMN "s" VARCHAR(4000)',
        'ALTER TABLE "db"."t" ADD COLUMN "d" NUMERIC(10,2)',
        'ALTER TABLE "db"."t" ADD COLUMN "t" TIMESTAMP',
        'ALTER TABLE "db"."t" ADD COLUMN "v" VARCHAR(20)',
    ]
    with pytest.raises(TypeError):
        ddl.add_column_ddl("t", have, T.StructType.fromDDL("m map<string,int>"), Dialect.MYSQL)
