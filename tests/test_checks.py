import pytest
from pyspark.sql import functions as F

from tablesync.operators import quality, splits, watermark
from tablesync.operators.reconcile import compare_periods, rows_to_resync
from tablesync.sources import control, lake


def statuses(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "StaTus string")


def test_check_status(spark):
    assert quality.check_status(statuses(spark, "PASS", None, "Failed")) is True
    assert quality.check_status(statuses(spark, "PASS", None)) is False
    assert quality.check_status(statuses(spark)) is False
    assert quality.check_status(spark.range(3)) is None


def test_fail_flag_by_group_without_the_column(spark):
    assert {r["has_fail"] for r in quality.fail_flag(spark.range(3), by=["id"]).collect()} == {None}


def test_pk_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (2, None)], "a int, b int")
    assert [tuple(r) for r in quality.pk_violations(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    assert tuple(quality.null_keys(df, ["a", "b"]).first()) == (0, 2, 2)


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame([("m", "9"), ("m", "10"), ("m", None)], "name string, version string")
    assert quality.latest_version(df, "name", "version").first()["latest"] == 10
    with pytest.raises(Exception, match="draft"):
        quality.latest_version(df.unionAll(spark.sql("SELECT 'm', 'draft'")), "name", "version").collect()


def test_watermark_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "t timestamp")
    assert tuple(watermark.batch_watermark(df, "t").first()) == (None, 2)
    assert watermark.newest_or_default(df, "t").first()[0] == "1900-01-01"


def test_reconcile_null_periods_and_one_sided_ones(spark):
    source = spark.sql("SELECT * FROM VALUES (DATE'2024-01-05'), (DATE'2024-02-05'), (NULL) AS x(d)")
    target = spark.sql("SELECT * FROM VALUES (DATE'2024-01-09'), (DATE'2023-12-05') AS x(d)")
    got = {r["period"]: (r["src_cnt"], r["tgt_cnt"], r["diff"]) for r in compare_periods(source, target, "d").collect()}
    assert got == {"202401": (1, 1, 0), "202402": (1, 0, 1), None: (1, 0, 1), "202312": (0, 1, -1)}
    assert {str(r["d"]) for r in rows_to_resync(source, target, "d").collect()} == {"2024-02-05", "None"}


@pytest.mark.parametrize("mb, parts", [(0, 8), (130 * 7, 14), (130 * 8, 8), (130 * 20, 24), (130 * 100.4, 104)])
def test_splits_by_size(spark, mb, parts):
    assert spark.range(1).select(splits.splits_by_size(F.lit(float(mb)))).first()[0] == parts


def test_key_histogram_counts_nulls_first_and_the_end_last(spark):
    df = spark.createDataFrame([(None,), (0,), (5,), (10,)], "k bigint")
    assert [(r["part_id"], r["n"]) for r in splits.key_histogram(df, "k", 2).orderBy("part_id").collect()] == [(0, 2), (1, 2)]
    same = spark.createDataFrame([(3,), (3,)], "k bigint")
    assert [tuple(r) for r in splits.key_histogram(same, "k", 4).collect()] == [(0, 2, 3, 3)]


def test_fetch_policies(spark):
    none, one, two = spark.range(0), spark.range(1), spark.range(2)
    assert control.fetch(one, "one")["id"] == 0
    assert control.fetch(none, "zero_or_one") is None
    assert control.fetch(two, "any")["id"] in (0, 1)
    for df, policy in ((none, "one"), (two, "one"), (two, "zero_or_one")):
        with pytest.raises(LookupError):
            control.fetch(df, policy)


def workflow(spark):
    def table(columns, rows):
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in rows[0]._fields))
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])

    from collections import namedtuple

    step = namedtuple("s", "step_id job_id step_seq_no")
    job = namedtuple("j", "job_id frequency")
    mail = namedtuple("e", "step_id email_config_id")
    return (
        table(control.STEP_COLUMNS, [step("1", "a", "1"), step("2", "a", "1"), step("3", "b", "1"), step("3", "c", "2")]),
        table(control.JOB_COLUMNS, [job("a", "daily"), job("b", "monthly")]),
        table(control.EMAIL_COLUMNS, [mail("2", "9")]),
    )


def test_step_config(spark):
    tables = workflow(spark)
    found = control.step_config(*tables, "1")
    assert (found["step"]["step_seq_no"], found["job"]["frequency"], found["email"]) == ("1", "daily", None)
    assert control.step_config(*tables, "2")["email"]["email_config_id"] == "9"
    with pytest.raises(LookupError):
        control.step_config(*tables, "404")


def test_two_jobs_for_one_step_is_an_error(spark):
    meta_step, meta_job, _ = workflow(spark)
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        control.job_of_step(meta_job, meta_step, "3").collect()


def test_user_sql_replaces_the_generated_extraction(spark):
    spark.range(5).createOrReplaceTempView("five")
    df = lake.extract(spark, "five", sql="SELECT id FROM five WHERE id > 1", date_col="id", start="x", row_limit=1)
    assert df.count() == 3
    assert [r["id"] for r in lake.extract(spark, "five", row_limit=2, order_by=["id"]).collect()] == [0, 1]
    with pytest.raises(ValueError, match="order"):
        lake.extract(spark, "five", row_limit=2)
    with pytest.raises(ValueError):
        lake.extract(spark)


def test_range_resolution():
    from datetime import datetime

    now = datetime(2024, 5, 6, 7, 8, 9)
    assert lake.resolve_range(True, "2024-01-01", None, "x", now) == ("2024-01-01", "9999-12-31")
    assert lake.resolve_range(True, "2024-01-01", "2024-02-01", 5, now) == ("2024-01-01", "2024-02-01")
    assert lake.resolve_range(False, None, None, None, now) == ("1900-01-01", now)
    assert lake.resolve_range(False, None, None, 0, now) == (0, now)
    assert lake.resolve_range(False, "ignored", "ignored", "2024-02-02", now)[0] == "2024-02-02"
    with pytest.raises(ValueError):
        lake.resolve_range(True, None, None, None)


def test_repartition_only_upwards(spark):
    assert lake.at_least_partitions(spark.range(10, numPartitions=4), 6).rdd.getNumPartitions() == 6
    assert lake.at_least_partitions(spark.range(10, numPartitions=4), 2).rdd.getNumPartitions() == 4


def test_spread_by_row_count(spark):
    assert lake.spread(spark.range(0, 100, 1, 2), 10).rdd.getNumPartitions() == 10
    assert lake.spread(spark.range(0, 100, 1, 2), 1000).rdd.getNumPartitions() == 2
    assert lake.spread(spark.range(0), 10).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string", "date"])
def test_newer_than_is_strict_and_drops_nulls(spark, kind):
    marks = ["2024-01-01", "2024-01-02", "2024-01-03"]
    df = spark.createDataFrame([(m,) for m in [*marks, None]], "t string").select(F.col("t").cast(kind))
    us = spark.range(1).select(lake.micros(F.lit("2024-01-02"))).first()[0]
    assert [str(r["t"])[:10] for r in lake.newer_than(df, "t", us).collect()] == ["2024-01-03"]
    assert lake.newer_than(df, "t", us, overlap="1 hour").count() == 2
    assert lake.newer_than(df, "t", None).count() == 4
