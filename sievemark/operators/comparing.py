"""Two runs held against each other: their tables as multisets, their reports field by field, their scores and actions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators import quality

#: What says when and as what a row was made, not what it says.
OPERATIONAL = ("run_id", "attempt_id", "evidence_id")


def body(df: DataFrame):
    """A hash of a row: all columns but the operational ones in order of their names, nulls and the order of lists included."""
    names = sorted(c for c in df.columns if c not in OPERATIONAL)
    return F.sha2(F.to_json(F.struct(*(F.col(c) for c in names)), {"ignoreNullFields": "false"}), 256)


def multisets(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """artefact, left_rows, right_rows, left_only, right_only, equal of every table that either run has; rows count as often as they occur."""
    sides = [d.select(F.lit(name).alias("artefact"), body(d).alias("body"), F.lit(sign).alias("sign")) for tables, sign in ((left, 1), (right, -1)) for name, d in tables.items()]
    per = reduce(DataFrame.unionByName, sides).groupBy("artefact", "body").agg(F.sum("sign").alias("surplus"), F.count_if(F.col("sign") == 1).alias("l"), F.count_if(F.col("sign") == -1).alias("r"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = per.groupBy("artefact").agg(total("l").alias("left_rows"), total("r").alias("right_rows"), total(F.greatest("surplus", F.lit(0))).alias("left_only"), total(F.greatest(-F.col("surplus"), F.lit(0))).alias("right_only"))
    return out.withColumn("equal", (F.col("left_only") == 0) & (F.col("right_only") == 0))


def report_facts(counted: DataFrame, digits: int = 6) -> DataFrame:
    """pointer, value of every number of a report: scores and composites of both phases, their deltas, row changes, dataset composites and the split. counted: the counters of all tables."""
    summary = quality.summary(counted)
    label = F.when(F.col("phase") == "before", "raw").otherwise("clean")
    rounded = lambda c: F.round(c, digits)
    scores = summary.select(F.concat_ws("/", F.lit("/scores"), "source_table", label, "metric").alias("pointer"), rounded("score").alias("value"))
    pair = summary.groupBy("source_table", "metric").agg(F.max(F.when(F.col("phase") == "before", F.col("score"))).alias("raw"), F.max(F.when(F.col("phase") == "after", F.col("score"))).alias("clean"))
    deltas = pair.select(F.concat_ws("/", F.lit("/scores"), "source_table", F.lit("delta"), "metric").alias("pointer"), rounded(F.col("clean") - F.col("raw")).alias("value"))
    whole = quality.composites(summary)
    composite = whole.where("scope <> 'dataset'").select(F.concat(F.lit("/scores/"), "scope", F.lit("/composite_"), label).alias("pointer"), rounded("composite").alias("value"))
    dataset = whole.where("scope = 'dataset'").select(F.concat(F.lit("/dataset_composite/"), label).alias("pointer"), rounded("composite").alias("value"))
    rows = counted.groupBy("source_table").agg(*(F.max(F.when(F.col("phase") == p, F.col("n"))).alias(n) for p, n in (("before", "raw"), ("after", "clean"))))
    changes = F.array(*(F.struct(F.lit(n).alias("k"), c.cast("double").alias("v")) for n, c in (("raw", F.col("raw")), ("clean", F.col("clean")), ("removed", F.col("raw") - F.col("clean")))))
    change = rows.select("source_table", F.explode(changes).alias("x")).select(F.concat_ws("/", F.lit("/row_change"), "source_table", "x.k").alias("pointer"), F.col("x.v").alias("value"))
    parts = F.array(*(F.struct(F.lit(n).alias("k"), F.col(n).cast("double").alias("v")) for n in ("train", "valid", "test")))
    split = counted.where("phase = 'after' and source_table = 'ratings'").select(F.explode(parts).alias("x")).select(F.concat(F.lit("/split/"), "x.k").alias("pointer"), F.col("x.v").alias("value"))
    return reduce(DataFrame.unionByName, (scores, deltas, composite, dataset, change, split))


def report_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """pointer, left_value, right_value of the fields that differ or that one report lacks."""
    r = right.select(F.col("pointer").alias("_pointer"), F.col("value").alias("right_value"), F.lit(1).alias("_r"))
    both = left.select("pointer", F.col("value").alias("left_value"), F.lit(1).alias("_l")).join(r, F.col("pointer") == F.col("_pointer"), "full_outer")
    differs = F.col("_l").isNull() | F.col("_r").isNull() | ~F.col("left_value").eqNullSafe(F.col("right_value"))
    return both.where(differs).select(F.coalesce("pointer", "_pointer").alias("pointer"), "left_value", "right_value")


def score_changes(left: DataFrame, right: DataFrame, same_metric: bool = True) -> DataFrame:
    """source_table, phase, metric, left_score, right_score, delta of two summaries; no delta between metric versions that differ."""
    r = right.select(*(F.col(c).alias(f"_{c}") for c in ("source_table", "phase", "metric")), F.col("score").alias("right_score"))
    on = [F.col(c) == F.col(f"_{c}") for c in ("source_table", "phase", "metric")]
    both = left.select("source_table", "phase", "metric", F.col("score").alias("left_score")).join(r, on, "full_outer")
    delta = F.round(F.col("right_score") - F.col("left_score"), 6) if same_metric else F.lit(None).cast("double")
    return both.select(*(F.coalesce(c, f"_{c}").alias(c) for c in ("source_table", "phase", "metric")), F.round("left_score", 6).alias("left_score"), F.round("right_score", 6).alias("right_score"), delta.alias("delta"))


def report_gates(facts: DataFrame, report: DataFrame) -> DataFrame:
    """gate, violations: pointers of a report whose value does not follow from the counters, that it lacks, or that it adds. Both: pointer, value."""
    d = report_differences(facts, report)
    known, own = facts.select("pointer"), report.select("pointer")
    missing, added = d.join(own, "pointer", "left_anti"), d.join(known, "pointer", "left_anti")
    wrong = d.join(known, "pointer", "left_semi").join(own, "pointer", "left_semi")
    count = lambda x, g: x.agg(F.lit(g).alias("gate"), F.count("*").alias("violations"))
    return reduce(DataFrame.unionByName, (count(wrong, "value_wrong"), count(missing, "field_missing"), count(added, "field_added")))
