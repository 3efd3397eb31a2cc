"""Feeds over versions and as-of look-ups against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablesync.operators import asof, feeds, merge


def versions(rng, n):
    table, out = {}, []
    for _ in range(n):
        table = dict(table)
        for k in range(30):
            what = rng.random()
            if what < 0.25:
                table[k] = rng.randrange(3)
            elif what < 0.45:
                table.pop(k, None)
        out.append(table)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_net_changes_and_replay(spark, seed):
    tables = versions(random.Random(seed), 5)
    frames = [spark.createDataFrame(list(t.items()), "k int, v int") for t in tables]
    feed = None
    for i in range(1, 5):
        step = merge.change_feed(frames[i - 1], frames[i], ["k"], replace=True).withColumn("_commit_version", F.lit(i))
        feed = step if feed is None else feed.unionByName(step)
    feed = feed.cache()
    first, last = tables[0], tables[-1]
    net = {r.k: (r._change_type, r.v) for r in feeds.net_changes(feed, ["K"]).collect()}
    touched = {r.k for r in feed.collect()}
    for k in touched:
        if k in first and k in last:
            assert net[k] == ("update", last[k])
        elif k in last:
            assert net[k] == ("insert", last[k])
        elif k in first:
            assert net[k][0] == "delete"
        else:
            assert k not in net
    assert set(net) <= touched
    replayed = feeds.apply_feed(frames[0], feed, ["k"])
    assert {r.k: r.v for r in replayed.collect()} == last and replayed.count() == len(last)
    again = feeds.apply_feed(replayed, feed, ["k"])
    assert {r.k: r.v for r in again.collect()} == last and again.count() == len(last)
    feed.unpersist()


def test_odd_feeds(spark):
    replica = spark.createDataFrame([(1, "a"), (None, "n"), (None, "n")], "k int, v string")
    empty = spark.createDataFrame([], "k int, v string, _change_type string, _commit_version int")
    assert sorted(map(repr, feeds.apply_feed(replica, empty, ["k"]).collect())) == sorted(map(repr, replica.collect()))
    wide = spark.createDataFrame([(1, "b", 2.5, "update_postimage", 2), (1, "a", None, "update_preimage", 2), (3, "c", 1.0, "insert", 3)], "k int, v string, w double, _change_type string, _commit_version int")
    found = feeds.apply_feed(replica, wide, ["k"])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted([(1, "b", 2.5), (3, "c", 1.0), (None, "n", None), (None, "n", None)], key=repr)
    with pytest.raises(Exception, match="NULL key part"):
        feeds.net_changes(spark.createDataFrame([(None, "x", "insert", 1)], "k int, v string, _change_type string, _commit_version int"), ["k"]).collect()


def plain_as_of(rows, values):
    out = []
    for key, at, n in rows:
        fit = [(t, v is not None, v) for k, t, v in values if None not in (key, at, t) and k == key and t <= at]
        best = max(fit, key=lambda x: (x[0], x[1], x[2] if x[1] else 0), default=None)
        out.append((key, at, n, best[2] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_as_of_is_brute_force(spark, ranges):
    rng = random.Random(ranges)
    start = datetime(2024, 1, 1)
    when = lambda: None if rng.random() < 0.03 else start + timedelta(minutes=rng.randrange(300))
    key = lambda: None if rng.random() < 0.03 else 0 if rng.random() < 0.4 else rng.randrange(12)
    rows = [(key(), when(), i) for i in range(500)]
    values = [(key(), when(), None if rng.random() < 0.1 else rng.randrange(50)) for _ in range(260)]
    left = spark.createDataFrame(rows, "k int, at timestamp_ntz, n int")
    right = spark.createDataFrame([(v, t, k) for k, t, v in values], "v int, at timestamp_ntz, k int")
    found = asof.as_of(left, right, ["k"], "at", "v", "row", ranges)
    assert found.columns == ["k", "at", "n", "row"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_as_of(rows, values)
    nothing = asof.as_of(left, right.limit(0), ["k"], "at", "v", "x", ranges)
    assert nothing.where("x IS NOT NULL").count() == 0 and nothing.count() == 500
    assert asof.as_of(left.limit(0), right, ["k"], "at", "v", "x", ranges).count() == 0


def test_as_of_sorts_no_key_in_one_task(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    found = asof.as_of(rows, rows.where("at % 10 = 0").withColumn("v", F.col("at")), ["k"], "at", "v", "last")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k0#" in text and "part#" in text
    assert all(r.last == r.at // 10 * 10 for r in found.collect())


@pytest.mark.parametrize("options", [{}, {"small_batch": True}, {"bloom": 40}, {"on_duplicate": "latest", "order_by": ["t"]}])
def test_images_are_the_table_and_its_feed(spark, options):
    rng = random.Random(3)
    schema = "k int, v string, t int, own int"
    target = spark.createDataFrame([(i if i % 9 else None, rng.choice("ab"), rng.randrange(9), i) for i in range(80)], schema)
    batch = spark.createDataFrame([(i if i % 11 else None, rng.choice("ab"), rng.randrange(9)) for i in range(40, 120)], "k bigint, v string, t int")
    images = merge.merge_images(target, batch, ["k"], **options).cache()
    bag = lambda df: sorted(map(repr, df.collect()))
    rows = images.where("_change_type IN ('keep', 'insert', 'update_postimage')").drop("_change_type")
    assert bag(rows) == bag(merge.apply_batch(target, batch, ["k"], **options))
    assert bag(images.where("_change_type <> 'keep'")) == bag(merge.change_feed(target, batch, ["k"], **options))
    images.unpersist()
