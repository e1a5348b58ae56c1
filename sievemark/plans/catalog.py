"""All queries on record quality, by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievemark.functions import exprs as X
from sievemark.operators import artifacts, cleaning, exploring, lineage, profiling, quality
from sievemark.plans import filed, judged, oracles, relational, stored, validated
from sievemark.sources import synthetic
from sievemark.sources.files import stored as stored_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.SQL | relational.SQL | stored.ORACLES | validated.ORACLES | judged.ORACLES | filed.ORACLES


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _cleaned(spark, d):
    return cleaning.clean_all(synthetic.raw(spark, d))


def _seen(spark, d):
    raw = synthetic.raw(spark, d)
    return quality.detail(raw, cleaning.clean_all(raw))


def _short(rows: DataFrame) -> DataFrame:
    rules = F.array_join(F.transform("events", lambda e: F.concat(e["action"], F.lit(":"), e["rule"])), ",")
    return rows.select("source_table", "source_offset", "source_id", "payload", "disposition", rules.alias("rules"))


@query
def extract_user_ids(spark, d):
    return quality.raw_ids(synthetic.raw_users(spark, d))


@query
def extract_movie_ids(spark, d):
    return quality.raw_ids(synthetic.raw_movies(spark, d))


@query
def clean_users(spark, d):
    return _short(cleaning.clean_users(synthetic.raw_users(spark, d)))


@query
def clean_movies(spark, d):
    return _short(cleaning.clean_movies(synthetic.raw_movies(spark, d)))


@query
def clean_ratings(spark, d):
    return _short(_cleaned(spark, d)["ratings"])


@query
def dispositions(spark, d):
    return lineage.together(_cleaned(spark, d)).select("source_table", "source_offset", "source_id", "raw_record", "payload", "disposition")


@query
def quarantine_by_rule(spark, d):
    rows = lineage.together(_cleaned(spark, d)).where("disposition = 'ISOLATE'")
    return rows.groupBy("source_table", F.element_at("events", -1)["rule"].alias("rule")).agg(F.count("*").alias("n"))


@query
def action_counts(spark, d):
    e = lineage.events(lineage.together(_cleaned(spark, d))).where("action <> 'keep' or disposition = 'KEEP'")
    return e.groupBy("source_table", "action", "rule").agg(F.count("*").alias("n"))


@query
def source_balance(spark, d):
    rows = lineage.together(_cleaned(spark, d))
    part = lambda x: F.sum((F.col("disposition") == x).cast("long"))
    return rows.groupBy("source_table").agg(F.count("*").alias("raw"), part("KEEP").alias("keep"), part("ISOLATE").alias("isolate"), part("DEDUP").alias("dedup"))


@query
def evidence_events(spark, d):
    return lineage.events(lineage.together(_cleaned(spark, d))).drop("source_offset")


@query
def evidence_quality(spark, d):
    s = quality.unique_primary(_seen(spark, d))
    items = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(c).cast("long").alias("numerator"), n.alias("denominator")) for m, c, n in (("accurate", "accurate", F.lit(1)), ("complete", "present", F.col("required")), ("unique", "unique_primary", F.lit(1)), ("up_to_date", "up_to_date", F.lit(1)), ("consistent", "consistent", F.lit(1)))))
    return s.select("phase", "source_table", "source_id", F.explode(items).alias("x")).select("phase", "source_table", "source_id", "x.*").where("numerator is not null")


@query
def quality_detail(spark, d):
    return quality.unique_primary(_seen(spark, d)).drop("split", "source_file")


@query
def quality_groups(spark, d):
    return quality.groups(_seen(spark, d))


@query
def score_counters(spark, d):
    return quality.counters(_seen(spark, d))


@query
def counter_scan(spark, d):
    """The counters written as pairs and scanned again."""
    return quality.scan_counters(stored_table(quality.counter_pairs(quality.counters(_seen(spark, d))), "pairs"))


def _scored(table: str, phase: str):
    def run(spark, d):
        raw = synthetic.raw(spark, d)
        if phase == "before":
            lines = raw[table]
            seen = {"users": quality.observe_users, "movies": quality.observe_movies}[table](lines, "raw_record") if table != "ratings" else quality.observe_ratings(lines, "raw_record", quality.raw_ids(raw["users"]), quality.raw_ids(raw["movies"]))
            seen = seen.withColumn("phase", F.lit("before"))
        else:
            seen = _seen(spark, d).where((F.col("source_table") == table) & (F.col("phase") == phase))
        return quality.counters(seen).drop("phase", "source_table")

    return run


for _t in synthetic.TABLES:
    QUERIES[f"score_{_t}_raw"], QUERIES[f"score_{_t}_clean"] = _scored(_t, "before"), _scored(_t, "after")


@query
def quality_summary(spark, d):
    return quality.summary(quality.counters(_seen(spark, d)))


@query
def five_dimensions(spark, d):
    s = quality.summary(quality.counters(_seen(spark, d)))
    return s.groupBy("phase", "source_table").agg(*(F.max(F.when(F.col("metric") == m, F.col("score"))).alias(m) for m in quality.DIMENSIONS))


@query
def composites(spark, d):
    return quality.composites(quality.summary(quality.counters(_seen(spark, d)))).select("phase", "scope", F.round("composite", 6).alias("composite"))


@query
def temporal_split(spark, d):
    return _seen(spark, d).where("split is not null").groupBy("phase", "split").agg(F.count("*").alias("n"))


@query
def row_change(spark, d):
    c = quality.counters(_seen(spark, d)).groupBy("source_table").agg(F.max(F.when(F.col("phase") == "before", F.col("n"))).alias("raw"), F.max(F.when(F.col("phase") == "after", F.col("n"))).alias("clean"))
    return c.withColumn("removed", F.col("raw") - F.col("clean"))


@query
def dedup_edges(spark, d):
    return lineage.edges(lineage.together(_cleaned(spark, d)))


@query
def dedup_winner_graph(spark, d):
    return lineage.winners(lineage.together(_cleaned(spark, d)))


@query
def dedup_lineage(spark, d):
    return lineage.lineage(lineage.together(_cleaned(spark, d)))


@query
def rating_distribution(spark, d):
    kept = _cleaned(spark, d)["ratings"].where("disposition = 'KEEP'")
    return kept.groupBy(F.split_part("payload", F.lit(X.SEP), F.lit(3)).alias("rating")).agg(F.count("*").alias("n")).orderBy("rating")


@query
def dangling_references(spark, d):
    raw = synthetic.raw(spark, d)
    f = raw["ratings"].select("source_offset", X.fields(F.col("raw_record")).alias("f")).where(F.size("f") == 4).select("source_offset", X.jtrim(X.at(F.col("f"), 0)).alias("u"), X.jtrim(X.at(F.col("f"), 1)).alias("m"))
    u = f.join(quality.raw_ids(raw["users"]), F.col("u") == F.col("id"), "left_anti").select(F.lit("user").alias("kind"), F.col("u").alias("id"))
    m = f.join(quality.raw_ids(raw["movies"]), F.col("m") == F.col("id"), "left_anti").select(F.lit("movie").alias("kind"), F.col("m").alias("id"))
    return u.unionByName(m).groupBy("kind", "id").agg(F.count("*").alias("n"))


@query
def id_offset_repair(spark, d):
    return lineage.events(_cleaned(spark, d)["ratings"]).where("rule in ('R8a', 'R8b')").select("source_id", "rule", "before", "after")


@query
def mojibake_titles(spark, d):
    return lineage.events(cleaning.clean_movies(synthetic.raw_movies(spark, d))).where("rule = 'M8'").select("source_id", "before", "after")


@query
def genre_normalise(spark, d):
    return lineage.events(cleaning.clean_movies(synthetic.raw_movies(spark, d))).where("rule = 'M4'").select("source_id", "action", "before", "after")


@query
def genre_violations(spark, d):
    g = synthetic.raw_movies(spark, d).select("source_offset", X.fields(F.col("raw_record")).alias("f")).where(F.size("f") == 3).select("source_offset", X.at(F.col("f"), 2).alias("genres"))
    return g.where(~X.genres_legal(F.col("genres")))


@query
def zip_masks(spark, d):
    return profiling.zip_masks(synthetic.raw_users(spark, d))


@query
def profile_users(spark, d):
    return profiling.profile_users(synthetic.raw_users(spark, d))


@query
def profile_movies(spark, d):
    return profiling.profile_movies(synthetic.raw_movies(spark, d))


@query
def profile_ratings(spark, d):
    raw = synthetic.raw(spark, d)
    return profiling.profile_ratings(raw["ratings"], quality.raw_ids(raw["users"]), quality.raw_ids(raw["movies"]))


@query
def ratings_per_user_stats(spark, d):
    return profiling.ratings_per_user(synthetic.raw_ratings(spark, d))


@query
def id_gaps(spark, d):
    return profiling.id_gaps(synthetic.raw_movies(spark, d))


@query
def title_conflicts(spark, d):
    return profiling.title_conflicts(synthetic.raw_movies(spark, d))


@query
def validation_gates(spark, d):
    raw = synthetic.raw(spark, d)
    return lineage.gates(raw, cleaning.clean_all(raw))


@query
def orphan_rows(spark, d):
    """Rows of evidence and quality whose source is not there, when every 37th source is left out."""
    cleaned = _cleaned(spark, d)
    rows = lineage.together(cleaned)
    known = rows.where("source_offset % 37 <> 0").select("source_id")
    seen = quality.detail(synthetic.raw(spark, d), cleaned)
    kinds = (lineage.events(rows).select(F.lit("evidence").alias("kind"), "source_table", "source_id"), seen.select(F.lit("quality").alias("kind"), "source_table", "source_id"))
    return kinds[0].unionByName(kinds[1]).join(known, "source_id", "left_anti").groupBy("kind", "source_table").agg(F.count("*").alias("n"))


@query
def group_reconciliation(spark, d):
    s = _seen(spark, d)
    a = quality.groups(s).groupBy("phase", "source_table").agg(F.sum("duplicate_excess").alias("declared"), F.sum("records").alias("records"))
    b = quality.unique_primary(s).groupBy("phase", "source_table").agg(F.sum(1 - F.col("unique_primary")).alias("recomputed"))
    return a.join(b, ["phase", "source_table"], "full_outer").withColumn("equal", F.col("declared").eqNullSafe(F.col("recomputed")))


@query
def samples_per_stream(spark, d):
    w = Window.partitionBy("source_table", "disposition").orderBy("source_file", "source_offset")
    return lineage.together(_cleaned(spark, d)).withColumn("place", F.row_number().over(w)).where("place <= 3").select("source_table", "disposition", "place", "payload")


@query
def source_fingerprint(spark, d):
    rows = lineage.together(synthetic.raw(spark, d)).select("source_table", F.sha2("raw_record", 256).alias("h"))
    return rows.groupBy("source_table").agg(F.count("*").alias("n"), F.min("h").alias("first"), F.max("h").alias("last"), F.countDistinct("h").alias("distinct_lines"))


@query
def multiset_diff(spark, d):
    """Rows that two rule variants do not share, with how often more the left side has them."""
    left = _cleaned(spark, d)["ratings"].where("disposition = 'KEEP'").select("payload", F.lit(1).alias("side"))
    right = left.where("cast(split_part(payload, '::', 4) as bigint) <= 1025481600").select("payload", F.lit(-1).alias("side"))
    return left.unionByName(right).groupBy("payload").agg(F.sum("side").alias("surplus")).where("surplus <> 0")


def _explored(table: str):
    def run(spark, d):
        return {"users": exploring.explore_users, "movies": exploring.explore_movies, "ratings": exploring.explore_ratings}[table](synthetic.raw(spark, d)[table])

    return run


for _t in synthetic.TABLES:
    QUERIES[f"explore_{_t}"] = _explored(_t)


@query
def most_repeated_pairs(spark, d):
    return exploring.most_repeated_pairs(synthetic.raw_ratings(spark, d))


@query
def most_active_users(spark, d):
    return exploring.most_active_users(synthetic.raw_ratings(spark, d))


@query
def value_histogram(spark, d):
    return exploring.value_histogram(synthetic.raw_ratings(spark, d))


@query
def width_histogram(spark, d):
    return exploring.widths(synthetic.raw(spark, d))


@query
def bad_value_histogram(spark, d):
    return exploring.bad_values(synthetic.raw(spark, d))


@query
def official_counts(spark, d):
    return profiling.official_counts(synthetic.raw(spark, d))


@query
def explore_samples(spark, d):
    return exploring.samples(synthetic.raw(spark, d))


@query
def unknown_references(spark, d):
    return exploring.unknown_references(synthetic.raw(spark, d))


@query
def summary_gates(spark, d):
    return lineage.summary_gates(quality.counters(_seen(spark, d)))


@query
def event_gates(spark, d):
    return lineage.event_gates(lineage.together(_cleaned(spark, d)))


def _typed(table: str):
    def run(spark, d):
        cleaned = _cleaned(spark, d)
        rows = artifacts.with_lineage(artifacts.typed(cleaned[table], table), lineage.together(cleaned))
        rows = rows.withColumn("related", F.array_join("related_source_ids", ",")).drop("related_source_ids", "source_file")
        return rows.withColumn("genres", F.array_join("genres", "|")) if table == "movies" else rows

    return run


for _t in synthetic.TABLES:
    QUERIES[f"typed_{_t}"] = _typed(_t)


QUERIES |= stored.QUERIES | validated.QUERIES | judged.QUERIES | filed.QUERIES | {name: relational.runner(name) for name in relational.SQL}
