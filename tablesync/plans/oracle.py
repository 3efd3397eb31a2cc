"""The same results in plain SQL, for an independent check by another engine."""

from __future__ import annotations

from tablesync.plans.queries import BATCH_FROM, EVENTS_FROM, EVENTS_UNTIL, TARGET_UNTIL

TARGET = f"""
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
  WHERE o_orderdate <= TIMESTAMP '{TARGET_UNTIL}'"""
BATCH = f"""
  SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice + CAST(1 AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority FROM orders
  WHERE o_orderdate > TIMESTAMP '{BATCH_FROM}'"""
LOG = """
  SELECT event_id AS log_id, user_id AS sync_key,
    CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS current_status,
    CASE WHEN event_type <> 'view' THEN ts END AS watermark_value FROM events"""
NEWEST = """
SELECT user_id, ts, event_id, event_type, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS x WHERE rn = 1"""
MERGED = f"""
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate
FROM ({TARGET}) AS t FULL OUTER JOIN ({BATCH}) AS s ON t.o_orderkey = s.o_orderkey"""
MONTHS = f"""
SELECT coalesce(a.period, b.period) AS period, coalesce(a.n, 0) AS src_cnt, coalesce(b.n, 0) AS tgt_cnt,
  coalesce(a.n, 0) - coalesce(b.n, 0) AS diff
FROM (SELECT strftime(o_orderdate, '%Y%m') AS period, count(*) AS n FROM orders GROUP BY 1) AS a
FULL OUTER JOIN (SELECT strftime(o_orderdate, '%Y%m') AS period, count(*) AS n FROM ({TARGET}) AS t GROUP BY 1) AS b
ON a.period = b.period"""
FEED = f"""
SELECT s.o_orderkey AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type,
  s.o_totalprice AS o_totalprice
FROM ({BATCH}) AS s LEFT JOIN ({TARGET}) AS t ON t.o_orderkey = s.o_orderkey
WHERE t.o_orderkey IS NULL OR t.o_totalprice IS DISTINCT FROM s.o_totalprice
UNION ALL
SELECT t.o_orderkey, 'update_preimage', t.o_totalprice
FROM ({BATCH}) AS s JOIN ({TARGET}) AS t ON t.o_orderkey = s.o_orderkey
WHERE t.o_totalprice IS DISTINCT FROM s.o_totalprice"""

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"
WRONG = """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice - CAST(1 AS DOUBLE) ELSE o_totalprice END AS o_totalprice, o_orderdate
FROM orders WHERE o_custkey % 101 <> 5
UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 997 = 0"""
LEAF = """year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day,
  CAST(floor(o_orderkey / 100000.0) AS BIGINT) AS key_range"""

ORACLE: dict[str, str] = {
    "incremental_filter": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'",
    "range_extract": """SELECT * FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'""",
    "full_load": "SELECT * FROM orders",
    "sql_passthrough": """
SELECT n_name, o_orderstatus, count(*) AS cnt, count(DISTINCT c_custkey) AS customers
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY n_name, o_orderstatus
UNION ALL
SELECT n_name, NULL, count(*), count(DISTINCT c_custkey)
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY n_name
UNION ALL
SELECT NULL, NULL, count(*), count(DISTINCT c_custkey)
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'""",
    "filter_in_list": """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "regex_filter": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%\\_pk%' ESCAPE '\\' OR p_name LIKE '%ring%'",
    "key_first_projection": "SELECT event_id, user_id, ts, event_type, value, props FROM events",
    "stride_counts": """
SELECT CAST(least(CAST(floor(CAST(8 AS DOUBLE) * (o_orderkey - b.a) / (b.z - b.a)) AS BIGINT), 7) AS INTEGER) AS part_id,
  count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi
FROM orders CROSS JOIN (SELECT min(o_orderkey) AS a, max(o_orderkey) AS z FROM orders) AS b GROUP BY 1""",
    "split_quantiles": "SELECT CAST(16 AS BIGINT) AS parts, count(*) AS n, true AS even, true AS near FROM lineitem",
    "partition_bounds": """
SELECT min(o_orderkey) AS lower_limit, max(o_orderkey) AS upper_limit, count(*) AS tbl_cnt FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'""",
    "partition_plan_rows": """
SELECT t, n, greatest(CAST(ceil(n / 5000.0) AS INTEGER), 1) AS parts FROM (
  SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
  UNION ALL SELECT 'events', count(*) FROM events
  UNION ALL SELECT 'empty', count(*) FROM orders WHERE o_orderdate > TIMESTAMP '2100-01-01 00:00:00') AS x""",
    "partition_plan_size": """
SELECT p_partkey, greatest(CAST(round(p_retailprice / 130) + round((p_retailprice / 130) % 8) AS INTEGER), 8) AS parts
FROM part""",
    "repartition_up": "SELECT CAST(16 AS BIGINT) AS parts, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem",
    "last_success_watermark": f"""
SELECT sync_key, max(watermark_value) AS watermark FROM ({LOG}) AS l WHERE current_status = 'success' GROUP BY sync_key""",
    "job_of_step": """SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_custkey = (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey = 42) ORDER BY c_custkey""",
    "single_row_lookup": "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_name = 'Customer#000000042'",
    "steps_ordered_topk": """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""",
    "merge_upsert": MERGED,
    "merge_bloom": MERGED,
    "merge_heavy_keys": """
SELECT e.user_id AS user_id, e.event_id AS event_id, e.event_type AS event_type,
  CASE WHEN c.c_custkey IS NOT NULL THEN c.c_acctbal ELSE e.value END AS value
FROM events AS e LEFT JOIN customer AS c ON c.c_custkey = e.user_id
UNION ALL
SELECT c_custkey, NULL, NULL, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
    "merge_target_only_cols": """
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, t.c_name AS c_name
FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') AS t
FULL OUTER JOIN (SELECT c_custkey, c_acctbal + CAST(5 AS DOUBLE) AS c_acctbal FROM customer
  WHERE c_acctbal < 5000 OR c_mktsegment = 'BUILDING') AS s
ON t.c_custkey = s.c_custkey""",
    "merge_null_keys": f"""
WITH t AS (SELECT CASE WHEN event_type <> 'error' THEN event_id END AS k, value AS v FROM events
           WHERE ts <= TIMESTAMP '{EVENTS_UNTIL}'),
     s AS (SELECT CASE WHEN event_type <> 'error' THEN event_id END AS k, value + CAST(1 AS DOUBLE) AS v FROM events
           WHERE ts > TIMESTAMP '{EVENTS_FROM}')
SELECT k, v FROM s UNION ALL SELECT k, v FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k)""",
    "delete_insert": f"""
SELECT * FROM ({TARGET}) AS t WHERE o_custkey NOT IN (SELECT o_custkey FROM ({BATCH}) AS s)
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM ({BATCH}) AS s2""",
    "merge_stats": f"""
SELECT sum(CASE WHEN s.o_orderkey IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS stg_rows,
  sum(CASE WHEN t.o_orderkey IS NULL THEN 1 ELSE 0 END)::BIGINT AS inserted,
  sum(CASE WHEN t.o_orderkey = s.o_orderkey AND t.o_totalprice IS DISTINCT FROM s.o_totalprice THEN 1 ELSE 0 END)::BIGINT
    AS updated,
  sum(CASE WHEN t.o_orderkey = s.o_orderkey AND t.o_totalprice IS NOT DISTINCT FROM s.o_totalprice THEN 1 ELSE 0 END)::BIGINT
    AS unchanged,
  sum(CASE WHEN s.o_orderkey IS NULL THEN 1 ELSE 0 END)::BIGINT AS kept
FROM ({TARGET}) AS t FULL OUTER JOIN ({BATCH}) AS s ON t.o_orderkey = s.o_orderkey""",
    "change_feed": FEED,
    "change_feed_replace": f"""{FEED}
UNION ALL
SELECT o_orderkey, 'delete', o_totalprice FROM ({TARGET}) AS t
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({BATCH}) AS s)""",
    "dedup_latest": """
SELECT event_id, user_id, event_type, ts FROM (SELECT event_id, user_id, event_type, ts, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS x WHERE rn = 1""",
    "merge_latest": NEWEST,
    "reconcile_monthly": MONTHS,
    "reconcile_daily": "SELECT CAST(ts AS DATE) AS period, count(*) AS cnt FROM events GROUP BY 1",
    "resync_rows": f"""
SELECT * FROM orders WHERE strftime(o_orderdate, '%Y%m') IN (SELECT period FROM ({MONTHS}) AS m WHERE diff <> 0)""",
    "validate_drilldown": f"""
WITH s AS ({ORDERS}), t AS ({WRONG}),
d AS (SELECT DISTINCT {LEAF} FROM ((SELECT * FROM s EXCEPT ALL SELECT * FROM t) UNION ALL (SELECT * FROM t EXCEPT ALL SELECT * FROM s)) AS x),
sn AS (SELECT {LEAF}, count(*) AS n FROM s GROUP BY ALL), tn AS (SELECT {LEAF}, count(*) AS n FROM t GROUP BY ALL)
SELECT d.*, coalesce(sn.n, 0) AS src_n, coalesce(tn.n, 0) AS tgt_n FROM d
LEFT JOIN sn USING (year, month, day, key_range) LEFT JOIN tn USING (year, month, day, key_range)""",
    "reconcile_sketch": f"""
SELECT o_orderkey, 'source' AS side FROM ({ORDERS} EXCEPT ({WRONG})) AS a
UNION ALL SELECT o_orderkey, 'target' FROM (({WRONG}) EXCEPT {ORDERS}) AS b""",
    "watermark_as_of": f"""
WITH e AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS sync_key, ts FROM events),
l AS (SELECT CASE WHEN sync_key % 3 = 0 THEN 0 ELSE sync_key END AS sync_key, ts, max(log_id) AS log_id
      FROM ({LOG}) AS g JOIN events ON event_id = log_id
      WHERE current_status = 'success' AND watermark_value IS NOT NULL GROUP BY 1, 2)
SELECT e.event_id, e.sync_key, e.ts, l.log_id AS last_log FROM e ASOF LEFT JOIN l ON e.sync_key = l.sync_key AND e.ts >= l.ts""",
    "batch_watermark": """
SELECT CASE WHEN count(ts) = 0 THEN NULL ELSE max(ts) END AS watermark, count(*) AS n FROM events""",
    "target_watermark": """
SELECT coalesce(strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), '1900-01-01') AS start_dt,
  coalesce((SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders
            WHERE o_orderdate > TIMESTAMP '2100-01-01 00:00:00'), '1900-01-01') AS empty_start_dt,
  coalesce((SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders
            WHERE o_orderdate > TIMESTAMP '2100-01-01 00:00:00'), '9999-12-31') AS empty_end_dt
FROM orders""",
    "table_counts": "SELECT o_orderstatus, count(*) AS cnt FROM orders GROUP BY o_orderstatus",
    "dq_fail_flag": """
SELECT c_nationkey, c_mktsegment, coalesce(bool_or(upper(st) LIKE '%FAIL%'), false) AS has_fail FROM (
  SELECT c_nationkey, c_mktsegment,
    CASE WHEN c_acctbal < -990 THEN 'failed' WHEN c_acctbal >= 0 THEN 'PASS' END AS st FROM customer) AS x
GROUP BY c_nationkey, c_mktsegment""",
    "pk_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "string_width": """
SELECT max(length(text))::BIGINT AS w_text, sum(CASE WHEN length(text) > 4000 THEN 1 ELSE 0 END)::BIGINT AS over_text,
  max(length(source))::BIGINT AS w_source, sum(CASE WHEN length(source) > 4000 THEN 1 ELSE 0 END)::BIGINT AS over_source
FROM documents""",
    "latest_version": "SELECT user_id, max(event_id) AS latest FROM events GROUP BY user_id",
    "period_bucket": """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m') AS ym, CAST(l_shipdate AS DATE) AS d FROM lineitem""",
    "audit_key": """
SELECT event_id, sha256(CAST(user_id AS VARCHAR) || '~' || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS log_key FROM events""",
    "kv_parse": "SELECT event_id, CAST(user_id AS VARCHAR) AS uid, event_type AS typ FROM events",
    "json_extract": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, -1 AS missing FROM events""",
    "config_parse": """
SELECT o_orderkey, o_orderstatus = 'O' AS by_user, 'mysql' AS tgt_db_type, o_orderpriority AS second_key,
  CASE WHEN o_custkey >= 130 THEN CAST(o_custkey AS INTEGER) ELSE 130 END AS split_mb,
  CAST(50000 AS BIGINT) AS part_rec_cnt,
  CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS start_dt
FROM orders""",
    "split_keys": "SELECT o_orderkey, trim(o_orderstatus) AS k1, trim(o_orderpriority) AS k2 FROM orders",
    "empty_clone": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "publish_merge_schema": """
SELECT c_custkey, c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer""",
    "schema_diff": f"""
SELECT m.*, s.o_orderpriority AS o_orderpriority FROM ({MERGED}) AS m
LEFT JOIN ({BATCH}) AS s ON s.o_orderkey = m.o_orderkey""",
    "feature_upsert": MERGED,
    "bucketed_upsert": MERGED,
    "touched_partitions": f"""
SELECT event_id, event_type,
  CASE WHEN ts > TIMESTAMP '{EVENTS_FROM}' AND event_type IN ('view', 'click') THEN value + CAST(1 AS DOUBLE) ELSE value END
    AS value, ts
FROM events""",
    "compact": "SELECT true AS fewer, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents",
    "compact_clustered": "SELECT true AS fewer, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders",
    "profile_incremental": "UNION ALL".join(
        f"""
SELECT '{c}' AS "column", count(*) AS n, count(*) - count({c}) AS nulls,
  CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS width, true AS near FROM events
"""
        for c in ("event_id", "user_id", "event_type", "ts", "props")
    ),
    "dsv_normalize": r"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type = 'error' THEN '\n\n' ELSE event_type END AS event_type
FROM events""",
    "dsv_export": r"""
SELECT doc_id, CASE WHEN lang = 'en' THEN '\n\n' ELSE lang END AS lang, source, sha256(text) AS text_hash FROM documents""",
    "change_feed_published": FEED,
    "feed_replay": f"{ORDERS} WHERE o_orderkey % 5 <> 0",
    "sync_run": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "sync_log": f"""
SELECT 'orders' AS sync_key, 'success' AS current_status, TIMESTAMP '{BATCH_FROM}' AS watermark_value, 'ok' AS msg
UNION ALL SELECT 'orders', 'success', max(o_orderdate), 'ok' FROM orders
UNION ALL SELECT 'broken', 'fail', NULL, 'registry row broken has no merge keys'""",
    "sync_from_target": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "validate_and_sync": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "stream_upsert": NEWEST,
    "stream_state_latest": NEWEST,
}
