"""Queries on stored files. Files, publications, attempts and manifests are derived from whole tables: an event is a file, an order a publication, a customer an attempt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.operators import storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _text(c) -> str:
    return f"CAST({c} AS VARCHAR(20))"


_FILES = f"""SELECT path, min(event_id) % 1000 AS bytes, CASE WHEN min(event_id) % 37 = 0 THEN NULL ELSE min(event_id) % 90 END AS modified_days FROM (SELECT event_id, '/ml/' || CASE event_id % 6
  WHEN 0 THEN 'published/p' || {_text('user_id % 97')} || '/t' || {_text('event_id % 5')} || '/f' || {_text('event_id % 11')} || '.parquet' WHEN 1 THEN 'raw/v' || {_text('user_id % 9')} || '/f' || {_text('event_id')}
  WHEN 2 THEN 'staging/run=r' || {_text('user_id')} || '/attempt=a' || {_text('event_id % 4')} || '/f' || {_text('event_id')} WHEN 3 THEN 'staging/uploads/u' || {_text('event_id')}
  WHEN 4 THEN 'staging/run=x' || {_text('user_id')} || '/attempt=a0/f' || {_text('event_id')} ELSE 'other/f' || {_text('event_id')} END AS path FROM events) e GROUP BY path"""
_PUBLICATIONS = f"""SELECT publish_id, token, '/ml/published/' || publish_id || '/t' || {_text('token')} AS storage_path, CASE WHEN min(o_orderkey) % 3 = 0 THEN 'UPLOADING' ELSE 'PUBLISHED' END AS status, 'r' || {_text('min(o_custkey)')} AS run_id, 'a' || {_text('min(o_orderkey) % 4')} AS attempt_id
  FROM (SELECT 'p' || {_text('o_orderkey % 89')} AS publish_id, o_custkey % 4 AS token, o_orderkey, o_custkey FROM orders) o GROUP BY publish_id, token"""
_RAW = f"SELECT DISTINCT '/ml/raw/v' || {_text('n_nationkey % 7')} AS storage_uri FROM nation"
_ATTEMPTS = f"""SELECT 'r' || {_text('c_custkey')} AS run_id, 'a' || {_text('c_custkey % 4')} AS attempt_id, CASE c_custkey % 3 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'RUNNING' ELSE 'PUBLISHED' END AS status, c_custkey % 2 = 0 AS lease_alive,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 70 END AS ended_days, CASE WHEN c_custkey % 7 = 0 THEN 'a' || {_text('c_custkey % 4')} END AS active_attempt FROM customer"""
_DECLARED = f"""SELECT publish_id, token, 'f' || {_text('i')} || '.parquet' AS name, i * 100 AS bytes FROM (SELECT DISTINCT 'p' || {_text('o_orderkey % 89')} AS publish_id, o_custkey % 4 AS token FROM orders) p CROSS JOIN (SELECT r_regionkey * 2 AS i FROM region) r"""
_PARTS = {"files": _FILES, "publications": _PUBLICATIONS, "raw_versions": _RAW, "attempts": _ATTEMPTS, "declared": _DECLARED}
_WITH = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in _PARTS.items())
# the counterpart compares paths with prefixes one by one
_CLASSED = _WITH + """, live AS (SELECT *, token < max(token) OVER (PARTITION BY publish_id) AS superseded FROM publications),
owned AS (SELECT f.path, l.publish_id, l.status, l.superseded, row_number() OVER (PARTITION BY f.path ORDER BY superseded, status <> 'PUBLISHED', -length(storage_path), l.publish_id) AS place FROM files f JOIN live l ON starts_with(f.path, l.storage_path || '/')),
staged AS (SELECT path, bytes, modified_days, nullif(regexp_extract(path, '^/ml/staging/run=([^/]+)/attempt=([^/]+)/', 1), '') AS run_id, nullif(regexp_extract(path, '^/ml/staging/run=([^/]+)/attempt=([^/]+)/', 2), '') AS attempt_id FROM files),
classed AS (SELECT s.*, o.publish_id, CASE WHEN o.path IS NOT NULL THEN CASE WHEN o.superseded THEN 'RETAINED_PUBLICATION_HISTORY' WHEN o.status = 'PUBLISHED' THEN 'PROTECTED_PUBLISHED' ELSE 'PENDING_PUBLICATION' END
  WHEN EXISTS (SELECT 1 FROM raw_versions r WHERE s.path = r.storage_uri OR starts_with(s.path, r.storage_uri || '/')) THEN 'PROTECTED_RAW'
  WHEN s.run_id IS NOT NULL THEN CASE WHEN a.run_id IS NULL THEN 'UNREGISTERED_ATTEMPT_REVIEW' WHEN a.status IN ('FAILED', 'PUBLISHED') THEN 'RETAINED_ATTEMPT_HISTORY' WHEN a.lease_alive THEN 'ACTIVE_ATTEMPT' ELSE 'RECOVERY_REQUIRED' END
  WHEN starts_with(s.path, '/ml/staging/uploads/') THEN 'UNREFERENCED_UPLOAD_REVIEW' ELSE 'UNREGISTERED_PATH_REVIEW' END AS classification,
  a.status AS attempt_status, a.lease_alive, a.ended_days, a.active_attempt
  FROM staged s LEFT JOIN (SELECT * FROM owned WHERE place = 1) o ON o.path = s.path LEFT JOIN attempts a ON a.run_id = s.run_id AND a.attempt_id = s.attempt_id)
"""


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    for t in ("events", "orders", "nation", "customer", "region"):
        spark.read.parquet(f"{d}/{t}.parquet").createOrReplaceTempView(t)
    return {k: spark.sql(v) for k, v in _PARTS.items()}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _classified(t: dict[str, DataFrame]) -> DataFrame:
    return storage.classify(storage.checked(t["files"]), t["publications"], t["raw_versions"], t["attempts"])


@query(_CLASSED + "SELECT classification, count(*) AS files, sum(bytes)::BIGINT AS bytes FROM classed GROUP BY 1")
def storage_classification(spark, d):
    return _classified(_tables(spark, d)).groupBy("classification").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


@query(_CLASSED + "SELECT path, classification, publish_id, run_id, attempt_id FROM classed")
def storage_files(spark, d):
    return _classified(_tables(spark, d)).select("path", "classification", "publish_id", "run_id", "attempt_id")


@query(_CLASSED + """, want AS (SELECT l.publish_id, l.storage_path || '/' || name AS path, bytes FROM live l JOIN declared e ON e.publish_id = l.publish_id AND e.token = l.token WHERE NOT superseded UNION ALL SELECT publish_id, storage_path || '/manifest.json', NULL FROM live WHERE NOT superseded)
SELECT publish_id, path, 'missing' AS kind FROM want WHERE path NOT IN (SELECT path FROM files) UNION ALL SELECT publish_id, path, 'byte_length' FROM want JOIN files USING (path) WHERE want.bytes <> files.bytes
UNION ALL SELECT l.publish_id, f.path, 'undeclared_file' FROM files f JOIN live l ON starts_with(f.path, l.storage_path || '/') AND NOT superseded WHERE f.path NOT IN (SELECT path FROM want)""")
def publication_gaps(spark, d):
    t = _tables(spark, d)
    return storage.publication_gaps(t["files"], t["publications"], t["declared"])


@query(_CLASSED + """SELECT path, bytes, CASE WHEN e THEN 'FAILED_ATTEMPT_RETENTION_EXPIRED' ELSE classification END AS reason, e AS eligible FROM (SELECT *, coalesce(attempt_status = 'FAILED' AND NOT lease_alive AND ended_days > 30 AND active_attempt IS DISTINCT FROM attempt_id
  AND modified_days > 30 AND NOT EXISTS (SELECT 1 FROM publications p WHERE p.run_id = classed.run_id AND p.attempt_id = classed.attempt_id), false) AS e FROM classed)""")
def retention_candidates(spark, d):
    t = _tables(spark, d)
    return storage.retention(_classified(t), t["publications"], t["attempts"])
