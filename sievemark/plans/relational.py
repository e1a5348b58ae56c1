"""Queries on runs, versions, tasks and storage: SQL over temporary views, which Spark plans and DuckDB checks alike.

The metadata rows come from the driver's tables: an order is a run (its key the request number, its customer the dataset), a
line item is a task of a stage, and an event stands for a stored file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_RUNS = """WITH runs AS (
  SELECT o_orderkey AS request_seq, o_custkey % 7 AS dataset, CASE o_orderstatus WHEN 'F' THEN 'PUBLISHED' WHEN 'O' THEN 'QUEUED' ELSE 'FAILED' END AS status,
    CASE WHEN o_orderkey % 5 = 0 THEN 'metrics-v2.0' ELSE 'metrics-v2.1' END AS metric_version, CASE WHEN o_orderkey % 3 = 0 THEN 'rules-v1.9' ELSE 'rules-v2.0' END AS rule_version,
    o_orderkey * 37 % 10001 AS accurate, o_orderkey * 91 % 10001 AS complete, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey * 53 % 10001 END AS up_to_date, o_orderkey * 13 % 500 AS repaired
  FROM orders)
"""
_TASKS = """WITH tasks AS (
  SELECT l_orderkey % 12 AS stage, CASE WHEN l_partkey % 2 = 0 THEN 'REDUCE' ELSE 'MAP' END AS phase, (l_orderkey * 31 + l_partkey * 17) % 9973 AS millis,
    CASE WHEN l_partkey % 11 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, (l_partkey * 7 + l_suppkey) % 997 AS records, l_linenumber % 2 AS side
  FROM lineitem)
"""
SQL: dict[str, str] = {
    "history_counts": _RUNS + """SELECT dataset, metric_version, count(*) AS runs, sum(CASE WHEN status = 'PUBLISHED' THEN 1 ELSE 0 END) AS published, sum(CASE WHEN up_to_date IS NULL THEN 1 ELSE 0 END) AS without_time FROM runs GROUP BY dataset, metric_version""",
    "history_transitions": _RUNS + """, listed AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY request_seq) AS place FROM runs WHERE status = 'PUBLISHED'), pairs AS (
  SELECT *, lag(request_seq) OVER w AS before_seq, lag(accurate) OVER w AS before_accurate, lag(up_to_date) OVER w AS before_time, lag(repaired) OVER w AS before_repaired, lag(metric_version) OVER w AS before_metric, lag(rule_version) OVER w AS before_rule
  FROM listed WINDOW w AS (PARTITION BY dataset ORDER BY place))
SELECT dataset, before_seq, request_seq, CASE WHEN metric_version = before_metric THEN accurate - before_accurate END AS accurate_delta, CASE WHEN metric_version = before_metric THEN up_to_date - before_time END AS time_delta,
  CASE WHEN rule_version = before_rule THEN repaired - before_repaired END AS repaired_delta FROM pairs WHERE before_seq IS NOT NULL""",
    "run_comparison": _RUNS + """, scores AS (SELECT request_seq, metric_version, 'accurate' AS metric, accurate AS score FROM runs UNION ALL SELECT request_seq, metric_version, 'complete', complete FROM runs UNION ALL SELECT request_seq, metric_version, 'up_to_date', up_to_date FROM runs),
  a AS (SELECT * FROM scores WHERE request_seq % 2 = 0), b AS (SELECT request_seq - 1 AS other_seq, metric_version AS other_version, metric AS other_metric, score AS other_score FROM scores WHERE request_seq % 2 = 1)
SELECT coalesce(request_seq, other_seq) AS left_seq, coalesce(metric, other_metric) AS metric, score AS left_score, other_score AS right_score, CASE WHEN metric_version = other_version THEN other_score - score END AS delta
FROM a FULL OUTER JOIN b ON request_seq = other_seq AND metric = other_metric""",
    "run_page": _RUNS + "SELECT request_seq, dataset, status, metric_version FROM runs WHERE request_seq < 400 AND status = 'PUBLISHED' ORDER BY request_seq DESC LIMIT 21",
    "evidence_page": """WITH evidence AS (SELECT sha256_hex(l_orderkey, l_linenumber, l_partkey) AS evidence_id, l_returnflag AS rule, l_orderkey, l_linenumber, l_partkey FROM lineitem)
SELECT evidence_id, rule, l_orderkey, l_linenumber, l_partkey FROM evidence WHERE evidence_id > '4' AND rule = 'R' ORDER BY evidence_id, l_orderkey LIMIT 51""",
    "current_version": _RUNS + """, placed AS (SELECT dataset, request_seq, status, row_number() OVER (PARTITION BY dataset ORDER BY request_seq DESC) AS place FROM runs WHERE status = 'PUBLISHED')
SELECT dataset, request_seq, status FROM placed WHERE place = 1""",
    "queue_head": _RUNS + "SELECT request_seq, dataset FROM runs WHERE status = 'QUEUED' ORDER BY request_seq LIMIT 1",
    "status_counts": _RUNS + "SELECT status, count(*) AS n, coalesce(max(request_seq), 0) + 1 AS next_seq FROM runs GROUP BY status",
    "duration_distribution": _TASKS + """, placed AS (SELECT stage, phase, millis, row_number() OVER (PARTITION BY stage, phase ORDER BY millis) AS place, count(*) OVER (PARTITION BY stage, phase) AS n FROM tasks WHERE state = 'SUCCEEDED')
SELECT stage, phase, max(n) AS n, min(millis) AS least, CAST(median(millis) AS DOUBLE) AS median, min(CASE WHEN place * 100 >= 95 * n THEN millis END) AS p95, max(millis) AS most FROM placed GROUP BY stage, phase""",
    "baseline_delta": _TASKS + """, sums AS (SELECT stage, side, sum(millis) AS total FROM tasks GROUP BY stage, side), a AS (SELECT stage, total FROM sums WHERE side = 0), b AS (SELECT stage AS stage_b, total AS total_b FROM sums WHERE side = 1)
SELECT stage, total AS before_ms, total_b AS after_ms, total_b - total AS delta_ms, CASE WHEN total <> 0 THEN CAST((total_b - total) * 10000 AS DOUBLE) / CAST(total AS DOUBLE) END AS change FROM a JOIN b ON stage = stage_b""",
    "partition_skew": _TASKS + """SELECT stage, CAST(median(CASE WHEN records > 0 THEN records END) AS DOUBLE) AS median, max(records) AS most, CAST(max(records) AS DOUBLE) / CAST(median(CASE WHEN records > 0 THEN records END) AS DOUBLE) AS most_over_median, sum(CASE WHEN records = 0 THEN 1 ELSE 0 END) AS empty, sum(records) AS total FROM tasks WHERE phase = 'REDUCE' GROUP BY stage""",
    "attempt_states": _TASKS + "SELECT stage, sum(CASE WHEN state = 'FAILED' THEN 1 ELSE 0 END) AS failed, sum(CASE WHEN state = 'FAILED' THEN 0 ELSE 1 END) AS succeeded, sum(CASE WHEN state = 'FAILED' THEN millis ELSE 0 END) AS lost_ms FROM tasks GROUP BY stage",
    "claim_validation": _RUNS + """, claims AS (SELECT request_seq, CASE WHEN request_seq % 3 = 0 THEN accurate + 1 ELSE accurate END AS said, CASE WHEN request_seq % 4 = 1 THEN 'complete' ELSE 'accurate' END AS field FROM runs),
  checked AS (SELECT c.request_seq, c.field, c.said, CASE WHEN c.field = 'accurate' THEN r.accurate ELSE r.complete END AS fact FROM claims c JOIN runs r ON c.request_seq = r.request_seq)
SELECT field, CASE WHEN said = fact THEN 'VERIFIED' ELSE 'REJECTED' END AS verdict, count(*) AS n FROM checked GROUP BY 1, 2""",
    "history_series": _RUNS + """, named AS (SELECT o.*, row_number() OVER (PARTITION BY dataset ORDER BY request_seq) AS place FROM runs o WHERE status = 'PUBLISHED'), rows_of AS (SELECT l_orderkey AS of_seq, count(*) AS n_rows, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_rated FROM lineitem GROUP BY l_orderkey),
  pairs AS (SELECT n.*, coalesce(n_rows, 0) AS n_rows, coalesce(n_rated, 0) AS n_rated FROM named n LEFT JOIN rows_of ON of_seq = request_seq),
  stepped AS (SELECT *, lag(request_seq) OVER w AS left_seq, lag(metric_version) OVER w AS left_metric, lag(rule_version) OVER w AS left_rule, lag(accurate) OVER w AS left_accurate, lag(repaired) OVER w AS left_repaired, lag(n_rows) OVER w AS left_rows, lag(n_rated) OVER w AS left_rated FROM pairs WINDOW w AS (PARTITION BY dataset ORDER BY place))
SELECT dataset, place, request_seq, left_seq, CASE WHEN left_metric <> metric_version THEN 1 ELSE 0 END + CASE WHEN left_rule <> rule_version THEN 2 ELSE 0 END AS changed_versions, CASE WHEN left_metric = metric_version THEN accurate - left_accurate END AS accurate_delta,
  CASE WHEN left_rule = rule_version THEN repaired - left_repaired END AS repaired_delta, n_rows - left_rows AS row_delta, n_rated - left_rated AS rating_count_delta FROM stepped""",
    "current_result": _RUNS + """, published AS (SELECT request_seq AS publish_seq, dataset AS of_dataset FROM runs WHERE status = 'PUBLISHED'), latest AS (SELECT of_dataset AS current_dataset, max(publish_seq) AS current_seq FROM published GROUP BY of_dataset)
SELECT r.request_seq, r.dataset, r.status, p.publish_seq IS NOT NULL AS published, c.current_seq IS NOT NULL AS is_current FROM runs r LEFT JOIN published p ON p.publish_seq = r.request_seq LEFT JOIN latest c ON c.current_seq = p.publish_seq AND c.current_dataset = r.dataset""",
    "alias_resolution": """WITH aliases AS (SELECT DISTINCT o_orderpriority || '-' || CAST(o_custkey % 50 AS VARCHAR(20)) AS alias, o_custkey % 211 AS archive FROM orders), found AS (SELECT alias, count(*) AS n, min(archive) AS archive FROM aliases GROUP BY alias)
SELECT alias, CASE WHEN n = 1 THEN 'RESOLVED' ELSE 'AMBIGUOUS' END AS verdict, CASE WHEN n = 1 THEN archive END AS archive, n FROM found""",
    "action_delta": """WITH actions AS (SELECT user_id % 5 AS run, event_type || ':' || CAST(event_id % 9 AS VARCHAR(20)) AS action FROM events), a AS (SELECT action, count(*) AS n FROM actions WHERE run = 0 GROUP BY action), b AS (SELECT action AS other, count(*) AS k FROM actions WHERE run = 1 AND action NOT LIKE '%:3' GROUP BY action)
SELECT coalesce(action, other) AS action, coalesce(n, 0) AS before_n, coalesce(k, 0) AS after_n, coalesce(k, 0) - coalesce(n, 0) AS delta FROM a FULL OUTER JOIN b ON action = other""",
    "inventory_diff": """WITH expected AS (SELECT 'f' || CAST(event_id % 1500 AS VARCHAR(20)) AS file FROM events WHERE event_id % 3 <> 0 GROUP BY 1), present AS (SELECT 'f' || CAST(event_id % 1500 AS VARCHAR(20)) AS held FROM events WHERE event_id % 5 <> 0 GROUP BY 1)
SELECT coalesce(file, held) AS file, CASE WHEN held IS NULL THEN 'MISSING' ELSE 'EXTRA' END AS kind FROM expected FULL OUTER JOIN present ON file = held WHERE file IS NULL OR held IS NULL""",
    "backup_coverage": _RUNS + """, copies AS (SELECT o_orderkey AS copied_seq, o_orderkey * 37 % 10001 + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS copied_value FROM orders WHERE o_orderkey % 13 <> 0)
SELECT CASE WHEN copied_seq IS NULL THEN 'ABSENT' WHEN copied_value <> accurate THEN 'DIFFERENT' ELSE 'COVERED' END AS verdict, status, count(*) AS n FROM runs LEFT JOIN copies ON copied_seq = request_seq GROUP BY 1, 2""",
    "phase_totals": _TASKS + "SELECT stage, count(*) AS tasks, sum(CASE WHEN phase = 'MAP' THEN millis ELSE 0 END) AS map_ms, sum(CASE WHEN phase = 'REDUCE' THEN millis ELSE 0 END) AS reduce_ms, CASE WHEN count(*) > 256 THEN 'TOO_MANY' ELSE 'DETAILED' END AS detail FROM tasks GROUP BY stage",
    "stage_completeness": _TASKS + """, wanted AS (SELECT DISTINCT stage AS wanted_stage FROM tasks UNION SELECT 12), done AS (SELECT stage, min(CASE WHEN state = 'FAILED' AND stage < 9 THEN 0 ELSE 1 END) AS sound FROM tasks GROUP BY stage)
SELECT wanted_stage, CASE WHEN stage IS NULL THEN 'MISSING' WHEN sound = 1 THEN 'SUCCEEDED' ELSE 'FAILED' END AS verdict FROM wanted LEFT JOIN done ON stage = wanted_stage""",
}


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for t in ("orders", "lineitem", "events", "customer"):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
        return spark.sql(SPARK[name])

    run.__name__ = name
    return run


_KEY = "concat_ws(':', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)), CAST(l_partkey AS VARCHAR(20)))"
SPARK = dict(SQL)
SPARK["evidence_page"] = SQL["evidence_page"].replace("sha256_hex(l_orderkey, l_linenumber, l_partkey)", f"sha2({_KEY}, 256)")
SQL["evidence_page"] = SQL["evidence_page"].replace("sha256_hex(l_orderkey, l_linenumber, l_partkey)", f"sha256({_KEY})")
