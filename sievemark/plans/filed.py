"""Queries that write files into the shared folder and read them back: lines with offsets, profiles of files, exports, versions, backups."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions import exprs as X
from sievemark.operators import artifacts, backup, cleaning, exploring, history, validation
from sievemark.plans import oracles
from sievemark.plans.validated import _at
from sievemark.sources import synthetic
from sievemark.sources.files import inventory, relative_path, shared_folder, stored
from sievemark.sources.lines import read_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Files of each table; users end their lines with carriage return and line feed.
BUCKETS = 4


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _files(spark: SparkSession, d: str) -> str:
    """Writes the raw lines as text, BUCKETS files for a table, in order of the key within a file."""
    folder = shared_folder(spark, "lines")
    for table, lines in synthetic.raw(spark, d).items():
        rows = lines.withColumn("bucket", F.col("source_offset") % BUCKETS)
        dealt = rows.repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", "source_offset").select("bucket", "raw_record")
        dealt.write.option("lineSep", "\r\n" if table == "users" else "\n").partitionBy("bucket").text(f"{folder}/{table}")
    return folder


def _placed(c: str) -> list:
    return [F.split_part(c, F.lit("/"), F.lit(1)).alias("source_table"), F.regexp_extract(c, "bucket=([0-9]+)", 1).cast("int").alias("bucket")]


_LINES = oracles._RAW + f""", text AS (SELECT source_table, source_offset AS k, source_offset % {BUCKETS} AS bucket, raw_record, octet_length(encode(raw_record)) AS size, CASE source_table WHEN 'users' THEN 2 ELSE 1 END AS ending FROM
  (SELECT source_table, source_offset, raw_record FROM raw_users UNION ALL SELECT source_table, source_offset, raw_record FROM raw_movies UNION ALL SELECT source_table, source_offset, raw_record FROM raw_ratings)),
placed AS (SELECT *, coalesce(sum(size + ending) OVER (PARTITION BY source_table, bucket ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM text)
"""


@query(_LINES + "SELECT source_table, bucket::INT AS bucket, start AS source_offset, size::INT AS size FROM placed")
def line_source(spark, d):
    """Lines read back with their byte offsets; a Latin-1 character is a byte."""
    rows = read_lines(spark, _files(spark, d), splitBytes=str(1 << 16))
    return rows.select(*_placed("source_file"), "source_offset", F.length("raw_record").alias("size"))


@query(_LINES + "SELECT source_table, bucket::INT AS bucket, sum(size + ending)::BIGINT AS bytes, true AS whole_utf8, count(*) FILTER (ending = 2) AS crlf, count(*) AS lines FROM placed GROUP BY 1, 2")
def file_profile(spark, d):
    folder = _files(spark, d)
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    found = exploring.files(binary.withColumn("path", relative_path("path", folder)))
    return found.select(*_placed("path"), "bytes", "whole_utf8", "crlf", "lines")


@query(_LINES + "SELECT source_table, bucket::INT AS bucket, sum(size + ending)::BIGINT AS bytes FROM placed GROUP BY 1, 2")
def namespace_listing(spark, d):
    return inventory(spark, _files(spark, d)).select(*_placed("path"), "bytes")


@query(_LINES + "SELECT 'bytes_recovered' AS gate, 0 AS sound, (count(*) FILTER (start % 5 = 1) + 2 * count(*) FILTER (start % 7 = 2 AND start % 5 <> 1))::BIGINT AS mutated FROM placed")
def byte_recovery(spark, d):
    """Sources against the bytes at their place; the mutation changes some records and moves others."""
    rows = read_lines(spark, _files(spark, d))
    lines = stored(rows.withColumn("source_table", F.split_part("source_file", F.lit("/"), F.lit(1))), "lines")
    wrong = validation.changed(lines, _at(5, 1), raw_record=F.concat("raw_record", F.lit("!")))
    wrong = validation.changed(wrong, _at(7, 2) & ~_at(5, 1), source_file=F.concat("source_file", F.lit(".moved")))
    return validation.compared(validation.recovered(lines, lines), validation.recovered(wrong, lines))


@query(oracles._CLEAN + """SELECT source_table, 'payload' AS kind, payload AS value FROM cleaned WHERE disposition = 'KEEP' UNION ALL SELECT source_table, 'id', split_part(payload, '::', 1) FROM cleaned WHERE disposition = 'KEEP' AND source_table <> 'ratings'""")
def payload_export(spark, d):
    """Kept payloads and reference ids, written as text and read back."""
    cleaned = cleaning.clean_all(synthetic.raw(spark, d))
    folder, out = shared_folder(spark, "export"), []
    for t, rows in cleaned.items():
        artifacts.export(rows, f"{folder}/{t}")
        out.append(spark.read.text(f"{folder}/{t}/payload").select(F.lit(t).alias("source_table"), F.lit("payload").alias("kind"), "value"))
        if t != "ratings":
            out.append(spark.read.text(f"{folder}/{t}/ids").select(F.lit(t).alias("source_table"), F.lit("id").alias("kind"), "value"))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def _versions(spark, d) -> tuple[dict, dict, str]:
    """Two versions of the eight tables of a history: all rows, and without the ratings after the second bound."""
    raw = synthetic.raw(spark, d)
    outputs = artifacts.outputs(raw, cleaning.clean_all(raw))
    tables = {t: outputs[f"cleaned_{t}"].drop("related_source_ids") for t in synthetic.TABLES} | {f"evidence_{t}": outputs[f"evidence_{t}"] for t in synthetic.TABLES}
    for phase in ("before", "after"):
        tables[f"quality_{phase}"] = outputs[f"quality_{phase}_users"].unionByName(outputs[f"quality_{phase}_movies"]).unionByName(outputs[f"quality_{phase}_ratings"])
    tables = {t: stored(v, t) for t, v in tables.items()}
    folder = shared_folder(spark, "versions")
    early = tables | {"ratings": tables["ratings"].where(F.col("timestamp_seconds") <= X.T2)}
    rows = {"v1": history.project(tables, folder, "v1"), "v2": history.project(early, folder, "v2")}
    return tables, rows, folder


_VERSIONS = oracles._SEEN.rstrip() + f", kept AS (SELECT *, source_table = 'ratings' AND coalesce(try_cast(split_part(payload, '::', 4) AS BIGINT) > {X.T2}, false) AS late FROM cleaned WHERE disposition = 'KEEP')\n"


@query(_VERSIONS + """, t AS (SELECT source_table, late FROM kept UNION ALL SELECT 'evidence_' || source_table, false FROM ev UNION ALL SELECT 'quality_' || phase, false FROM seen)
SELECT v AS version, source_table, count(*) AS actual_rows, count(*) AS bound_rows, count(*) AS expected_rows, true AS reconciled, '' AS odd FROM t, (SELECT unnest(['v1', 'v2']) AS v) WHERE v = 'v1' OR NOT late GROUP BY 1, 2""")
def history_projection(spark, d):
    tables, rows, folder = _versions(spark, d)
    named = history.register(spark, folder, tables, f"history_{uuid.uuid4().hex}")
    odd = ",".join(f"{t}:{w}" for t, n in named.items() for w in history.odd_table(spark, n, tables[t], f"{folder}/{t}"))
    bound = {t: F.col("source_table") == t.removeprefix("evidence_") for t in tables} | {f"quality_{p}": (F.col("phase") == p) & F.col("source_table").isin(*synthetic.TABLES) for p in ("before", "after")}
    parts = [history.analysis(spark, named, v, rows[v], bound).withColumn("version", F.lit(v)) for v in rows]
    return parts[0].unionByName(parts[1]).withColumn("odd", F.lit(odd))


@query(_VERSIONS + """SELECT 'v1' AS left_version, 'v2' AS right_version, CAST(split_part(payload, '::', 3) AS TINYINT) AS rating, (0 - count(*) FILTER (late))::BIGINT AS records_delta FROM kept WHERE source_table = 'ratings' GROUP BY 3""")
def version_transitions(spark, d):
    tables, _, folder = _versions(spark, d)
    named = history.register(spark, folder, {"ratings": tables["ratings"]}, f"history_{uuid.uuid4().hex}")
    return history.transitions(history.distributions(spark, named["ratings"]), ["v1", "v2"])


@query("SELECT 'orders' AS name, count(*) AS n_rows, 0 AS lost, 0 AS added FROM orders UNION ALL SELECT 'customer', count(*), 0, 0 FROM customer UNION ALL SELECT 'events', count(*), 0, 0 FROM events")
def backup_round_trip(spark, d):
    """Tables written as typed cells and read back: rows that are lost or added, as multisets."""
    out = None
    for name in ("orders", "customer", "events"):
        df = spark.read.parquet(f"{d}/{name}.parquet")
        folder = shared_folder(spark, "backup")
        backup.write(df, folder)
        back = backup.restored(spark, folder, df.schema)
        counts = [x.agg(F.count("*").alias(c)) for c, x in (("n_rows", back), ("lost", df.exceptAll(back)), ("added", back.exceptAll(df)))]
        row = counts[0].crossJoin(counts[1]).crossJoin(counts[2]).withColumn("name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("SELECT 'QUEUED' AS status, count(*) AS n FROM orders WHERE o_orderstatus = 'O' HAVING count(*) > 0 UNION ALL SELECT 'RUNNING', count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0")
def backup_quiescence(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "PUBLISHED").when(F.col("o_orderstatus") == "O", "QUEUED").otherwise("RUNNING")
    return backup.quiescent(spark.read.parquet(f"{d}/orders.parquet").select(status.alias("status")))
