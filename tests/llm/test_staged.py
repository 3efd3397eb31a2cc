"""What a staged frame leaves on the local disks."""

import time
from pathlib import Path

from tablesync.llm.common import staged


def shuffles(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for d in dirs for p in Path(d.getPath()).rglob("shuffle_*")}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffles(spark)
    wide = spark.range(50_000).selectExpr("id", "id % 7 AS k").repartition(5, "id")
    wide.write.format("noop").mode("overwrite").save()
    assert shuffles(spark) - before  # kept as long as the frame
    kept = shuffles(spark)
    read = staged(spark.range(50_000).selectExpr("id", "id % 9 AS k").repartition(5, "id"), "staged-test")
    for _ in range(50):
        if not shuffles(spark) - kept:
            break
        time.sleep(0.1)
    assert not shuffles(spark) - kept
    assert read.count() == read.distinct().count() == 50_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
