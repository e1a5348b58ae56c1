"""Typed tables of a cleaning run, written as Parquet with a manifest and a report."""

from __future__ import annotations

import datetime
import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions import exprs as X
from sievemark.operators import cleaning, lineage, quality
from sievemark.operators.timing import canonical
from sievemark.sources.files import file_system, listing, put_once, stored

# The names of the versions.
VERSIONS = {"rule_version": "rules-v2.0", "metric_version": "metrics-v2.1"}
#: Bytes of a row group.
ROW_GROUP_BYTES = 16 << 20


def _field(i: int):
    c = F.split_part("payload", F.lit(X.SEP), F.lit(i))
    return F.when(c != "NULL", c)


def typed(cleaned: DataFrame, table: str) -> DataFrame:
    """Kept records with typed columns; ids and ZIP codes stay text, and the literal NULL is null."""
    kept = cleaned.where("disposition = 'KEEP'")
    title = _field(2)
    year = X.year_of(title).cast("int")
    columns = {
        "users": [_field(1).alias("user_id"), _field(2).alias("gender"), _field(3).cast("int").alias("age"), _field(4).cast("int").alias("occupation"), _field(5).alias("zip_code")],
        "movies": [_field(1).alias("movie_id"), title.alias("title"), F.when(year <= X.LAST_YEAR, year).alias("year"), F.split(_field(3), r"\|", -1).alias("genres")],
        "ratings": [_field(1).alias("user_id"), _field(2).alias("movie_id"), _field(3).cast("tinyint").alias("rating"), _field(4).cast("long").alias("timestamp_seconds")],
    }[table]
    return kept.select("source_id", "source_table", "source_file", "source_offset", *columns)


def with_lineage(rows: DataFrame, all_rows: DataFrame) -> DataFrame:
    """Adds the ids of the records that each kept one stands for."""
    related = lineage.winners(all_rows).groupBy(F.col("winner").alias("_winner")).agg(F.array_sort(F.collect_set("source_id")).alias("related_source_ids"))
    return rows.join(related, F.col("source_id") == F.col("_winner"), "left").drop("_winner").withColumn("related_source_ids", F.coalesce("related_source_ids", F.array().cast("array<string>")))


def outputs(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The twenty tables of a run: five for each table and record state, quality before and after, groups and summary."""
    rows, seen = lineage.together(cleaned), quality.unique_primary(quality.detail(raw, cleaned))
    out = {}
    for t, d in cleaned.items():
        own = F.col("source_table") == t
        out[f"cleaned_{t}"] = with_lineage(typed(d, t), rows.where(own))
        out[f"quarantine_{t}"] = d.where("disposition = 'ISOLATE'").withColumn("reason_rule", F.element_at("events", -1)["rule"]).drop("events")
        out[f"dispositions_{t}"] = d.drop("events")
        out[f"evidence_{t}"] = lineage.events(d)
        for phase in ("before", "after"):
            out[f"quality_{phase}_{t}"] = seen.where(own & (F.col("phase") == phase))
    return out | {"quality_groups": quality.groups(seen), "quality_summary": quality.summary(quality.counters(seen))}


def export(cleaned: DataFrame, folder: str, envelope: bool = False) -> None:
    """Writes kept payloads as text under folder/payload, with the events before them if asked for, and the ids of users and movies under folder/ids."""
    kept = cleaned.where("disposition = 'KEEP'")
    line = F.col("payload")
    if envelope:
        line = F.concat_ws("|", F.concat(F.col("source_offset").cast("string"), F.lit("@"), F.base64(F.to_json(F.struct("source_id", "raw_record", "events")).cast("binary"))), F.element_at("events", -1)["action"], F.element_at("events", -1)["rule"], "payload")
    kept.select(line.alias("value")).write.mode("errorifexists").text(f"{folder}/payload")
    kept.where("source_table <> 'ratings'").select(F.split_part("payload", F.lit(X.SEP), F.lit(1)).alias("value")).write.mode("errorifexists").text(f"{folder}/ids")


def report(cleaned: dict[str, DataFrame], summary: DataFrame, counted: DataFrame) -> dict:
    """Scores to two decimals, deltas, composites, changes, balances and the split, from aggregates of a few rows. Python rounds the exact binary value half to even, which Spark's round does not."""
    scores: dict = {}
    for r in summary.collect():
        value = None if r["score"] is None else r["score"] if r["metric"] == "up_to_date" else round(r["score"], 2)
        scores.setdefault(r["source_table"], {}).setdefault(LABELS[r["phase"]], {})[r["metric"]] = value
    mean = lambda d: round(sum(v for v in d.values() if v is not None) / max(1, sum(v is not None for v in d.values())), 2)
    for of in scores.values():
        of["delta"] = {m: None if of["raw"][m] is None else round(of["clean"][m] - of["raw"][m], 2) for m in of["raw"]}
        of |= {f"composite_{p}": mean(of[p]) for p in ("raw", "clean")}
    whole = {p: round(sum(scores[t][f"composite_{p}"] * w for t, w in quality.WEIGHTS.items()), 2) for p in ("raw", "clean") if quality.WEIGHTS.keys() <= scores.keys()}
    balance: dict = {t: {"raw": 0, "keep": 0, "isolate": 0, "dedup": 0} for t in cleaned}
    for r in lineage.together(cleaned).groupBy("source_table", "disposition").count().collect():
        balance[r["source_table"]][r["disposition"].lower()] = r["count"]
        balance[r["source_table"]]["raw"] += r["count"]
    change = {t: {"raw": b["raw"], "clean": b["keep"], "removed": b["raw"] - b["keep"]} for t, b in balance.items()}
    split = {k: r[k] for r in counted.where("phase = 'after' and source_table = 'ratings'").collect() for k in ("train", "valid", "test")}
    bounds = {k: datetime.datetime.fromtimestamp(v, datetime.UTC).isoformat() for k, v in (("t1", X.T1), ("t2", X.T2))}
    return {"versions": VERSIONS, "scores": scores, "source_balance": balance, "row_change": change, "dataset_composite": whole, "split": split | bounds}


LABELS = {"before": "raw", "after": "clean"}


def file_identities(spark, folder: str) -> list[dict]:
    """path, bytes, sha256 of the files of a table, hashed where they lie."""
    files = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return [r.asDict() for r in files.orderBy("path").collect()]


def schema_sha256(df: DataFrame) -> str:
    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def publish(raw: dict[str, DataFrame], out_dir: str) -> dict:
    """Writes all tables under out_dir, then the report and last the manifest, which alone makes a run complete; returns the report."""
    cleaned = cleaning.clean_all(raw)
    spark, files = next(iter(raw.values())).sparkSession, []
    counted = stored(quality.counters(quality.detail(raw, cleaned)), "counters")
    for name, df in outputs(raw, cleaned).items():
        df.write.mode("errorifexists").option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(f"{out_dir}/{name}")
        back = spark.read.parquet(f"{out_dir}/{name}")
        files.append({"name": name, "rows": back.count(), "schema_sha256": schema_sha256(back), "files": file_identities(spark, f"{out_dir}/{name}")})
    said = report(cleaned, spark.read.parquet(f"{out_dir}/quality_summary"), counted)
    cleaning.release(cleaned)
    put_once(canonical(said).encode(), f"{out_dir}/report.json")
    manifest = {"schema_version": "manifest-v1", "files": files, "source_balance": said["source_balance"], **VERSIONS}
    put_once(canonical(manifest).encode(), f"{out_dir}/manifest.json")
    return said


def preflight(spark, out_dir: str, versions: dict = VERSIONS) -> dict:
    """The manifest of a finished run, or ValueError with what is wrong: another version, a table that is missing, changed or not declared, or counts that contradict the balance."""
    fs, root = file_system(out_dir)
    read = lambda name: json.loads(fs.open_input_stream(f"{root}/{name}", compression=None).read())
    manifest, said = read("manifest.json"), read("report.json")
    if any(manifest[k] != v or said["versions"][k] != v for k, v in versions.items()):
        raise ValueError("the run is of another version")
    declared = {f["name"]: f for f in manifest["files"]}
    found = {path.split("/")[0] for path, _ in listing(out_dir) if "/" in path}
    if set(declared) != found or len(declared) != len(manifest["files"]):
        raise ValueError("tables and manifest differ")
    for name, item in declared.items():
        df = spark.read.parquet(f"{out_dir}/{name}")
        if file_identities(spark, f"{out_dir}/{name}") != item["files"] or schema_sha256(df) != item["schema_sha256"] or df.count() != item["rows"]:
            raise ValueError(f"{name} was changed")
    if manifest["source_balance"] != said["source_balance"]:
        raise ValueError("report and manifest differ")
    for t, b in manifest["source_balance"].items():
        rows = {n: declared[f"{n}_{t}"]["rows"] for n in ("cleaned", "quarantine", "dispositions", "quality_before", "quality_after", "evidence")}
        if b["raw"] != b["keep"] + b["isolate"] + b["dedup"] or said["row_change"][t] != {"raw": b["raw"], "clean": b["keep"], "removed": b["raw"] - b["keep"]}:
            raise ValueError(f"{t}: sources are not conserved")
        if (rows["cleaned"], rows["quarantine"], rows["dispositions"], rows["quality_before"], rows["quality_after"]) != (b["keep"], b["isolate"], b["raw"], b["raw"], b["keep"]) or rows["evidence"] < b["raw"]:
            raise ValueError(f"{t}: tables contradict the balance")
    if declared["quality_summary"]["rows"] != 30:
        raise ValueError("quality dimensions are missing")
    return manifest


def published_report(spark, out_dir: str) -> dict:
    """The report of a run whose manifest holds; ValueError otherwise."""
    preflight(spark, out_dir)
    fs, root = file_system(out_dir)
    return json.loads(fs.open_input_stream(f"{root}/report.json", compression=None).read())
