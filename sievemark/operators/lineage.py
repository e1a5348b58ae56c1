"""Evidence, de-duplication lineage and the gates that a cleaning run must pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions import exprs as X
from sievemark.sources.files import stored


def together(cleaned: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, cleaned.values())


def events(rows: DataFrame) -> DataFrame:
    """One row for each event of each source, in order."""
    return rows.select("source_table", "source_id", "source_offset", "disposition", F.posexplode("events").alias("event_order", "e")).select("source_table", "source_id", "source_offset", "disposition", "event_order", "e.*")


def edges(rows: DataFrame) -> DataFrame:
    """source_table, source_id, rule, target: from every duplicate to the record kept instead."""
    return events(rows).where("action = 'dedup'").select("source_table", "source_id", "rule", "target")


def winners(rows: DataFrame) -> DataFrame:
    """source_table, source_id, winner, hops: where the edges from each duplicate end. Rules run in two stages at most, so a pointer jumps twice; one that has still not arrived is reported by the gates."""
    e = edges(rows)
    n = e.select(F.col("source_id").alias("next"), F.col("target").alias("further"))
    one = e.join(n, F.col("target") == F.col("next"), "left")
    return one.select("source_table", "source_id", F.coalesce("further", "target").alias("winner"), F.when(F.col("further").isNotNull(), 2).otherwise(1).alias("hops"))


def lineage(rows: DataFrame) -> DataFrame:
    """winner and the sorted ids of all records that it stands for."""
    return winners(rows).groupBy("source_table", "winner").agg(F.array_sort(F.collect_set("source_id")).alias("ids")).select("source_table", "winner", F.size("ids").alias("n_related"), F.array_join("ids", ",").alias("related"))


def chain_holds():
    """Whether events begin at the raw record, hand each payload on and end at the last one."""
    e = F.col("events")
    linked = F.forall(F.zip_with(F.slice(e, 1, F.size(e) - 1), F.slice(e, 2, F.size(e)), lambda a, b: F.coalesce(a["after"] == b["before"], F.lit(True))), lambda x: x)
    return (F.element_at(e, 1)["before"] == F.col("raw_record")) & (F.element_at(e, -1)["after"] == F.col("payload")) & linked


def _noted(rows: DataFrame) -> DataFrame:
    """What the gates go by, a narrow row for each source: its end, the targets of its dedup events, the ids in its payload, and what it shows by itself."""
    part = lambda i: F.split_part("payload", F.lit(X.SEP), F.lit(i))
    kept, terminal = F.col("disposition") == "KEEP", F.element_at("events", -1)["action"]
    genres = F.split(part(3), r"\|", -1)
    targets = F.transform(F.filter("events", lambda e: e["action"] == "dedup"), lambda e: e["target"])
    odd = (F.col("disposition") == "ISOLATE") != (terminal == "isolate")
    return rows.select(
        "source_table", "source_id", "disposition", targets.alias("targets"), F.when(kept, part(1)).alias("id"), F.when(kept & (F.col("source_table") == "ratings"), part(2)).alias("movie"), (~chain_holds()).alias("origin_chain"),
        (odd | ((F.col("disposition") == "DEDUP") != (terminal == "dedup"))).alias("terminal_action"), (kept & (F.col("source_table") == "movies") & (F.size(F.array_distinct(genres)) < F.size(genres))).alias("genres_distinct"),
    )


def gates(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> DataFrame:
    """gate, violations: how many records break each rule of a sound run. What the gates go by is stored once, table by table: each gate reads it, and a plan that held the rules for every gate filled the driver's memory."""
    rows = reduce(DataFrame.unionByName, (stored(_noted(d), f"noted_{t}") for t, d in cleaned.items()))
    n_raw = reduce(DataFrame.unionByName, (d.select("source_id") for d in raw.values()))
    e = rows.select("source_id", F.explode("targets").alias("target"))
    n = e.select(F.col("source_id").alias("next"), F.col("target").alias("further"))
    ends = rows.select(F.col("source_id").alias("w"), F.col("disposition").alias("end"))
    found = e.join(n, F.col("target") == F.col("next"), "left").select(F.coalesce("further", "target").alias("winner")).join(ends, F.col("winner") == F.col("w"), "left")
    kept = rows.where("disposition = 'KEEP'")
    rated = kept.where("source_table = 'ratings'").select(F.col("id").alias("u"), F.col("movie").alias("m"))
    ids = lambda t: kept.where(F.col("source_table") == t).select("id").distinct()
    # what a row shows by itself is counted in one pass
    local = ("origin_chain", "terminal_action", "genres_distinct")
    one = rows.agg(*(F.count_if(F.col(g)).alias(g) for g in local))
    parts = [one.select(F.explode(F.array(*(F.struct(F.lit(g).alias("gate"), F.col(g).alias("violations")) for g in local))).alias("x")).select("x.*")]
    checks = {
        "population": n_raw.join(rows.select("source_id"), "source_id", "left_anti"),
        "unique_source": rows.groupBy("source_id").count().where("count > 1"),
        "dedup_target": found.where("end is null or end <> 'KEEP'"),
        "one_edge": e.groupBy("source_id").count().where("count > 1"),
        "user_reference": rated.join(ids("users"), F.col("u") == F.col("id"), "left_anti"),
        "movie_reference": rated.join(ids("movies"), F.col("m") == F.col("id"), "left_anti"),
    }
    parts += [d.agg(F.count("*").alias("violations")).select(F.lit(g).alias("gate"), "violations") for g, d in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def summary_gates(counted: DataFrame) -> DataFrame:
    """gate, violations: counters that contradict each other, and whether the summary has all its rows."""
    clean = counted.where("phase = 'after' and source_table = 'ratings'")
    checks = {
        "six_tables": counted.agg(F.abs(F.count("*") - 6)),
        "within_records": counted.agg(F.count_if((F.greatest("acc", "cons", "ud", "uniq_excess") > F.col("n")) | (F.least(*(c for c in counted.columns if c not in ("phase", "source_table"))) < 0))),
        "splits_conserve": clean.agg(F.count_if(F.col("train") + F.col("valid") + F.col("test") != F.col("n"))),
        "clean_is_unique": counted.agg(F.count_if((F.col("phase") == "after") & (F.col("uniq_excess") != 0))),
    }
    return reduce(DataFrame.unionByName, (d.select(F.lit(g).alias("gate"), F.col(d.columns[0]).cast("long").alias("violations")) for g, d in checks.items()))


def event_gates(rows: DataFrame) -> DataFrame:
    """gate, violations: of the events alone. Orders are complete from 0, kept rows end in no other state, a keep rewrites nothing, and only duplicates have a target, never themselves."""
    e = events(rows)
    per = e.groupBy("source_id").agg(F.min("event_order").alias("low"), F.max("event_order").alias("high"), F.count_distinct("event_order").alias("k"), F.count("*").alias("n"))
    checks = {
        "order_complete": per.agg(F.count_if((F.col("low") != 0) | (F.col("high") != F.col("n") - 1) | (F.col("k") != F.col("n")))),
        "kept_without_end": e.agg(F.count_if((F.col("disposition") == "KEEP") & F.col("action").isin("isolate", "dedup"))),
        "keep_rewrites": e.agg(F.count_if((F.col("action") == "keep") & ~F.col("before").eqNullSafe(F.col("after")))),
        "target_elsewhere": e.agg(F.count_if((F.col("action") == "dedup") != F.coalesce(F.col("target") != F.col("source_id"), F.lit(False)))),
    }
    return reduce(DataFrame.unionByName, (d.select(F.lit(g).alias("gate"), F.col(d.columns[0]).alias("violations")) for g, d in checks.items()))
