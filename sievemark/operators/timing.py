"""Durations of jobs and tasks, read from the job history's JSON, and baselines made of them."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The stages of a whole run, the states in which a task can end, and the most bytes of a baseline.
STAGES = ("extractUsers", "extractMovies", "cleanUsers", "cleanMovies", "cleanMoviesTitle", "cleanRatings", "score-raw-users", "score-raw-movies", "score-raw-ratings", "score-clean-users", "score-clean-movies", "score-clean-ratings")
STATES = ("SUCCEEDED", "FAILED", "KILLED")
MOST_BYTES = 64 << 20
TASKS = "struct<job:struct<id:string,name:string,state:string,startTime:bigint,finishTime:bigint>,tasks:struct<task:array<struct<id:string,type:string,state:string,startTime:bigint,finishTime:bigint,elapsedTime:bigint,successfulAttempt:string,records:bigint>>>>"


def parsed(documents: DataFrame) -> DataFrame:
    """job_id, submission_id, state, start, finish and one row for each task (kind, task_state, task_start, task_finish, millis, records), with whether the document can be read at all (readable). documents: body (JSON)."""
    d = documents.select(F.from_json("body", TASKS, {"mode": "PERMISSIVE"}).alias("x"))
    flat = d.select("x.job.id", "x.job.name", "x.job.state", "x.job.startTime", "x.job.finishTime", F.col("x.job.id").isNotNull().alias("readable"), F.explode_outer("x.tasks.task").alias("t"))
    return flat.select(F.col("id").alias("job_id"), F.col("name").alias("submission_id"), "state", F.col("startTime").alias("start"), F.col("finishTime").alias("finish"), "readable", F.col("t.id").alias("task_id"), F.col("t.type").alias("kind"), F.col("t.state").alias("task_state"), F.col("t.startTime").alias("task_start"), F.col("t.finishTime").alias("task_finish"), F.col("t.elapsedTime").alias("millis"), F.col("t.records").alias("records"))


def odd_task() -> Column:
    """Why a task cannot be counted: identity of another job, a state that is no end, or times that contradict each other."""
    suffix = F.concat(F.lit(r"\Atask_"), F.regexp_replace("job_id", "^job_", ""), F.when(F.col("kind") == "MAP", "_m_").otherwise("_r_"), F.lit(r"[0-9]+\z"))
    foreign = ~F.col("kind").isin("MAP", "REDUCE") | ~F.rlike("task_id", suffix)
    return (
        F.when(~F.col("readable"), "UNREADABLE")
        .when(F.coalesce(foreign, F.lit(True)), "FOREIGN_TASK")
        .when(~F.coalesce(F.col("task_state").isin(*STATES), F.lit(False)) | ((F.col("state") == "SUCCEEDED") & (F.col("task_state") != "SUCCEEDED")), "NOT_ENDED")
        .when(~F.coalesce((F.col("task_start") >= 0) & (F.col("task_start") <= F.col("task_finish")) & (F.col("millis") == F.col("task_finish") - F.col("task_start")), F.lit(False)), "TIMES_CONTRADICT")
    )


def jobs(tasks: DataFrame) -> DataFrame:
    """job_id, available, duration_ms, tasks, odd: a job with one task that cannot be counted has no figures, not smaller ones."""
    per = tasks.withColumn("_odd", odd_task()).groupBy("job_id").agg(F.max(F.col("finish") - F.col("start")).alias("_ms"), F.count("task_id").alias("tasks"), F.count_if(F.col("_odd").isNotNull()).alias("odd"), F.count_distinct("task_id").alias("_ids"))
    sound = (F.col("odd") == 0) & (F.col("_ids") == F.col("tasks"))
    return per.select("job_id", sound.alias("available"), F.when(sound, F.col("_ms")).alias("duration_ms"), "tasks", "odd")


def distribution(values: DataFrame, keys: list[str], value: str = "millis") -> DataFrame:
    """keys, n, least, median, p95 (nearest rank), most of the values, exact. Equal values are counted first, so that no group is gathered."""
    hist = values.groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("k"))
    order = Window.partitionBy(*keys).orderBy("v")
    run = hist.withColumn("through", F.sum("k").over(order)).withColumn("n", F.sum("k").over(Window.partitionBy(*keys)))
    at = lambda place: F.min(F.when(F.col("through") >= place, F.col("v")))
    median = (at(F.expr("(n + 1) div 2")) + at(F.expr("n div 2 + 1"))) / 2
    return run.groupBy(*keys).agg(F.max("n").alias("n"), F.min("v").alias("least"), median.cast("double").alias("median"), at(F.expr("(n * 95 + 99) div 100")).alias("p95"), F.max("v").alias("most"))


def skew(tasks: DataFrame) -> DataFrame:
    """job_id, partitions, empty, total, most_over_median (of the positive ones) of reducers; null totals where a count is unknown, which is not zero."""
    reducers = tasks.where("kind = 'REDUCE'")
    known = reducers.groupBy("job_id").agg(F.count("*").alias("partitions"), F.count("records").alias("known"), F.count_if(F.col("records") == 0).alias("empty"), F.sum("records").alias("total"), F.max("records").alias("most"))
    middle = distribution(reducers.where("records > 0"), ["job_id"], "records").select(F.col("job_id").alias("_job"), "median")
    whole = F.col("known") == F.col("partitions")
    d = known.join(middle, F.col("job_id") == F.col("_job"), "left")
    return d.select("job_id", "partitions", F.when(whole, F.col("empty")).alias("empty"), F.when(whole, F.col("total")).alias("total"), F.when(whole, F.col("most") / F.col("median")).alias("most_over_median"))


def run_gates(found: DataFrame) -> DataFrame:
    """run_id, verdict of each run whose jobs (run_id, stage, job_id, state, expected_id) were found: COMPLETE, or what is wrong."""
    known = F.array(*(F.lit(s) for s in STAGES))
    per = found.groupBy("run_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("stage")).alias("stages"), F.count_distinct("job_id").alias("ids"), F.bool_and(F.col("state") == "SUCCEEDED").alias("ended"), F.bool_and(F.col("job_id").eqNullSafe(F.col("expected_id"))).alias("same"))
    verdict = F.when((F.col("n") != len(STAGES)) | (F.col("stages") != F.sort_array(known)), "STAGES_DIFFER").when(~F.col("ended"), "NOT_SUCCEEDED").when(~F.col("same") | (F.col("ids") != len(STAGES)), "IDENTITY_DIFFERS").otherwise("COMPLETE")
    return per.select("run_id", verdict.alias("verdict"))


def baseline_changes(left: DataFrame, right: DataFrame) -> DataFrame:
    """stage, before_ms, after_ms, delta_ms, change_percent (null where before is 0) of two complete baselines (stage, duration_ms); both need the same stages."""
    a, b = (d.select("stage", F.col("duration_ms").alias(n)) for d, n in ((left, "before_ms"), (right, "after_ms")))
    d = a.join(b, "stage").withColumn("delta_ms", F.col("after_ms") - F.col("before_ms"))
    return d.withColumn("change_percent", F.when(F.col("before_ms") != 0, F.col("delta_ms") * 100.0 / F.col("before_ms")))


def canonical(value) -> str:
    """JSON with sorted keys and no spaces, other letters kept."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def envelope(identity: str, payload: dict) -> str:
    """A baseline with its id and the hash of its contents."""
    text = canonical({"baseline_id": identity, "payload": payload, "sha256": hashlib.sha256(canonical(payload).encode()).hexdigest()})
    if len(text.encode()) > MOST_BYTES:
        raise ValueError("the baseline is too large")
    return text


def opened(text: str, identity: str) -> dict:
    """The payload of an envelope, or an error if it is another one or was changed; a baseline that says it is complete has to be."""
    held = json.loads(text)
    payload = held["payload"]
    if held["baseline_id"] != identity or hashlib.sha256(canonical(payload).encode()).hexdigest() != held["sha256"]:
        raise ValueError("the baseline is another one or was changed")
    if payload["complete"]:
        found = payload["jobs"]
        if sorted(j["stage"] for j in found) != sorted(STAGES) or any(type(j["duration_ms"]) is not int or j["duration_ms"] < 0 for j in found):
            raise ValueError("the baseline is not as complete as it says")
    return payload
