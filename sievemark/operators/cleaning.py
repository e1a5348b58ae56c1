"""Ordered repair, log and isolate rules of the three tables, and de-duplication.

Each cleaner turns raw lines into one row for each source: its payload after all rules, the events (rule, action, before,
after, target) in order, and the disposition KEEP, ISOLATE or DEDUP. Rules are `when` chains over named payload columns; no
row leaves its partition until de-duplication.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions import exprs as X
from sievemark.sources.files import discard, settle, stored
from sievemark.sources.synthetic import narrowed, record_name, widened

EVENT = "struct<rule:string,action:string,before:string,after:string,target:string>"
KEPT = ["source_table", "source_file", "source_offset", "source_id", "raw_record", "payload", "events", "disposition"]


def _event(when: Column, rule: str | Column, action: str | Column, before: Column, after: Column) -> Column:
    rule, action = (F.lit(x) if isinstance(x, str) else x for x in (rule, action))
    return F.when(when, F.struct(rule.alias("rule"), action.alias("action"), before.alias("before"), after.alias("after"), F.lit(None).cast("string").alias("target")))


def _events(keep_rule: str, *events: Column) -> Column:
    found = F.filter(F.array(*events), lambda e: e.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(_event(F.lit(True), keep_rule, "keep", F.col("payload"), F.col("payload"))))


def _own_key(key: str) -> Column:
    """Rows that are no longer KEEP have a key of their own, so that no key collects them in a join."""
    return F.when(F.col("disposition") == "KEEP", F.concat(F.lit("K"), F.col(key))).otherwise(F.concat_ws(":", F.lit("I"), "source_file", F.col("source_offset").cast("string")))


def _least(rows: DataFrame, *id_columns: str) -> DataFrame:
    """_key, _b: the row of least rank, file and offset of every key among those that are still KEEP, and how many there are."""
    return rows.where("disposition = 'KEEP'").groupBy("_key").agg(F.min(F.struct("_rank", *id_columns)).alias("_b"), F.count("*").alias("_n"))


def _told(rows: DataFrame, best: Column, rule: str) -> DataFrame:
    """rows, of which those that another one (best) is kept for become DEDUP and point to it."""
    lost = F.coalesce(best != F.col("source_id"), F.lit(False))
    event = F.array(F.struct(F.lit(rule).alias("rule"), F.lit("dedup").alias("action"), F.col("payload").alias("before"), F.col("payload").alias("after"), best.alias("target")))
    return rows.withColumn("_lost", lost).withColumn("events", F.when(F.col("_lost"), F.concat("events", event)).otherwise(F.col("events"))).withColumn("disposition", F.when(F.col("_lost"), "DEDUP").otherwise(F.col("disposition"))).drop("_lost")


def _distinct(df: DataFrame, key: str, rank: Column, rule: str, held: list[DataFrame] | None = None) -> DataFrame:
    """Keeps the row of least rank, file and offset of every key among those that are still KEEP; the others become DEDUP and point to it.

    The best is found by an aggregate, whose partial sums leave one row of a key and task, and joined back; so a key that a
    third of all rows have is no group that one task has to sort. The rows are persisted, so that rules run once for both."""
    rows = df.withColumn("_key", _own_key(key)).withColumn("_rank", rank).persist()
    if held is not None:
        held.append(rows)
    best = _least(rows, "source_file", "source_offset", "source_id")
    joined = rows.join(best.select("_key", F.col("_b.source_id").alias("_best")), "_key", "left")
    return _told(joined, F.col("_best"), rule).drop("_key", "_best", "_rank")


def ruled_users(lines: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The rules on rows, with the key and the rank of de-duplication."""
    d = lines.withColumn("f0", X.fields(F.col("raw_record"))).withColumn("c0", F.split("raw_record", ":", -1))
    d = d.withColumn("u1c", (F.size("f0") == 1) & (F.size("c0") == 5) & F.forall("c0", lambda x: ~X.blank(x)))
    d = d.withColumn("f1", F.when(F.col("u1c"), F.col("c0")).otherwise(F.col("f0")))
    f = [X.jtrim(X.at(F.col("f1"), i)) for i in range(4)]
    d = d.withColumn("u1a", (F.size("f1") == 6) & X.digits(f[0]) & X.full(f[1], "[FM]") & f[2].isin(X.AGES) & X.occupation(f[3]))
    d = d.withColumn("f2", F.when(F.col("u1a"), F.slice("f1", 1, 5)).otherwise(F.col("f1")))
    d = d.select(*lines.columns, "u1c", "u1a", "f2", F.array_join("f1", X.SEP).alias("p1"), F.array_join("f2", X.SEP).alias("p2"), *(X.jtrim(X.at(F.col("f2"), i)).alias(n) for i, n in enumerate(("uid", "g", "a", "o", "z"))))
    d = d.withColumn("ok", (F.size("f2") == 5) & X.digits(F.col("uid")))
    d = d.withColumn("g2", F.when(X.full(F.col("g"), "[FM]"), F.col("g")).otherwise("NULL")).withColumn("a2", F.when(F.col("a").isin(X.AGES), F.col("a")).otherwise("NULL")).withColumn("o2", F.when(X.occupation(F.col("o")), F.col("o")).otherwise("NULL"))
    z = F.col("z")
    d = d.withColumn("u5", F.when(X.full(z, "[0-9]{5}-[0-9]{4}"), "U5a").when(X.full(z, "[0-9]{9}"), "U5b").when(~X.full(z, "[0-9]{5}"), "U5c"))
    d = d.withColumn("z2", F.when(F.col("u5") == "U5c", "NULL").otherwise(F.substring("z", 1, 5)))
    steps = [("g", "a", "o", "z"), ("g2", "a", "o", "z"), ("g2", "a2", "o", "z"), ("g2", "a2", "o2", "z"), ("g2", "a2", "o2", "z2")]
    d = d.select("*", *(X.join(F.col("uid"), *(F.col(c) for c in s)).alias(f"p{n + 3}") for n, s in enumerate(steps)))
    c, ok = F.col, F.col("ok")
    d = d.withColumn("payload", F.when(ok, c("p7")).otherwise(c("p2"))).withColumn("disposition", F.when(ok, "KEEP").otherwise("ISOLATE"))
    events = _events(
        "U0",
        _event(c("u1c"), "U1c", "repair", c("raw_record"), c("p1")),
        _event(c("u1a"), "U1a", "repair", c("p1"), c("p2")),
        _event(~ok, "U1b", "isolate", c("p2"), c("p2")),
        _event(ok & (c("p3") != c("p2")), "U0", "repair", c("p2"), c("p3")),
        _event(ok & ~X.full(c("g"), "[FM]"), "U2", "log", c("p3"), c("p4")),
        _event(ok & ~c("a").isin(X.AGES), "U3", "log", c("p4"), c("p5")),
        _event(ok & ~X.occupation(c("o")), "U4", "log", c("p5"), c("p6")),
        _event(ok & c("u5").isNotNull(), c("u5"), F.when(c("u5") == "U5c", "log").otherwise("repair"), c("p6"), c("p7")),
    )
    score = sum((x.cast("int") for x in (X.full(c("g2"), "[FM]"), c("a2").isin(X.AGES), X.occupation(c("o2")), X.full(c("z2"), "[0-9]{5}"))), F.lit(1))
    d = d.withColumn("events", events).withColumn("score", score)
    return d.select(*KEPT, "uid", "score", *keep)


def clean_users(lines: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    return _distinct(ruled_users(lines), "uid", -F.col("score"), "U6", held).select(*KEPT)


def ruled_movies(lines: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The rules on rows, with the keys and the rank of de-duplication; title_key is what the second stage goes by."""
    c = F.col
    d = lines.withColumn("f0", X.fields(c("raw_record")))
    d = d.select(*lines.columns, "f0", *(X.jtrim(X.at(c("f0"), i)).alias(n) for i, n in enumerate(("mid", "t1", "g1"))))
    d = d.withColumn("t2", X.unmojibake(c("t1"))).withColumn("three", (F.size("f0") == 3) & X.digits(c("mid"))).withColumn("ok", c("three") & (c("t2") != ""))
    d = d.withColumn("g2", X.genres_kept(c("g1"))).withColumn("year", X.year_of(c("t2")))
    d = d.select("*", X.join(c("mid"), c("t1"), c("g1")).alias("p1"), X.join(c("mid"), c("t2"), c("g1")).alias("p2"), X.join(c("mid"), c("t2"), c("g2")).alias("p3"))
    ok, three = c("ok"), c("three")
    d = d.withColumn("payload", F.when(ok, c("p3")).when(three, c("p2")).otherwise(c("raw_record"))).withColumn("disposition", F.when(ok, "KEEP").otherwise("ISOLATE"))
    late = c("year").isNull() | (c("year").cast("int") > X.LAST_YEAR)
    events = _events(
        "M0",
        _event(three & (c("p1") != c("raw_record")), "M1", "repair", c("raw_record"), c("p1")),
        _event(three & (c("t2") != c("t1")), "M8", "repair", c("p1"), c("p2")),
        _event(~ok, "M2", "isolate", c("payload"), c("payload")),
        _event(ok & (c("g2") != c("g1")), "M4", F.when(c("g2") == "NULL", "log").otherwise("repair"), c("p2"), c("p3")),
        _event(ok & late, "M3", "log", c("p3"), c("p3")),
    )
    score = F.lit(1) + c("year").isNotNull().cast("int") + (c("g2") != "NULL").cast("int")
    title = F.when(c("year").isNotNull(), F.concat_ws("|", X.plain_title(c("t2")), c("year"))).otherwise(F.concat(F.lit("\x00"), c("source_id")))
    d = d.withColumn("events", events).withColumn("score", score).withColumn("title_key", title)
    return d.select(*KEPT, "mid", "score", "title_key", *keep)


def first_stage_movies(lines: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    """The rules on rows and the first of each id; title_key is what the second stage goes by."""
    return _distinct(ruled_movies(lines), "mid", -F.col("score"), "M5a", held)


def sound_movies(first: DataFrame) -> DataFrame:
    """Isolates survivors of the first stage whose payload is no longer three fields."""
    broken = (F.col("disposition") == "KEEP") & (F.size(X.fields(F.col("payload"))) != 3)
    event = F.array(F.struct(F.lit("M5b-invalid").alias("rule"), F.lit("isolate").alias("action"), F.col("payload").alias("before"), F.col("payload").alias("after"), F.lit(None).cast("string").alias("target")))
    sound = first.withColumn("_broken", broken).withColumn("events", F.when(F.col("_broken"), F.concat("events", event)).otherwise(F.col("events")))
    return sound.withColumn("disposition", F.when(F.col("_broken"), "ISOLATE").otherwise(F.col("disposition"))).drop("_broken")


def second_stage_movies(first: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    """Isolates survivors whose payload is no longer three fields, and keeps the first of each title and year."""
    return _distinct(sound_movies(first), "title_key", -F.col("score"), "M5b", held).select(*KEPT)


def clean_movies(lines: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    return second_stage_movies(first_stage_movies(lines, held), held)


def reference_ids(cleaned: DataFrame) -> DataFrame:
    """Distinct ids of the records that cleaning keeps."""
    return cleaned.where("disposition = 'KEEP'").select(F.split_part("payload", F.lit(X.SEP), F.lit(1)).alias("id")).distinct()


def _known(df: DataFrame, ids: DataFrame, value: str, name: str) -> DataFrame:
    return df.join(ids.select(F.col("id").alias(f"_{name}"), F.lit(True).alias(name)), F.col(value) == F.col(f"_{name}"), "left").drop(f"_{name}").withColumn(name, F.coalesce(name, F.lit(False)))


def _read_ratings(lines: DataFrame) -> DataFrame:
    """The fields of each line; u, m: the ids that it names, uc, mc: the ones that a shifted id may stand for."""
    c = F.col
    d = lines.withColumn("f0", X.fields(c("raw_record"))).withColumn("c0", F.split("raw_record", ",", -1))
    d = d.withColumn("r1b", (F.size("f0") == 1) & (F.size("c0") == 4)).withColumn("f1", F.when(c("r1b"), c("c0")).otherwise(c("f0")))
    d = d.withColumn("r1a", F.size("f1") == 5).withColumn("f2", F.when(c("r1a"), F.slice("f1", 1, 4)).otherwise(c("f1")))
    d = d.select(*lines.columns, "r1b", "r1a", "f2", F.array_join("f1", X.SEP).alias("p1"), F.array_join("f2", X.SEP).alias("p2"), *(X.jtrim(X.at(c("f2"), i)).alias(n) for i, n in enumerate(("u", "m", "r", "t"))))
    return d.withColumn("uc", F.when(F.length("u") >= 7, X.offset_candidate(c("u")))).withColumn("mc", F.when(F.length("m") >= 7, X.offset_candidate(c("m"))))


REFERENCES = (("u", "u_known"), ("uc", "uc_known"), ("m", "m_known"), ("mc", "mc_known"))


def ruled_ratings(d: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The rules on rows, with the key and the rank of de-duplication. d: the fields of lines, and which ids of each are known."""
    c = F.col
    d = d.withColumn("four", (F.size("f2") == 4) & ~F.exists("f2", X.blank)).withColumn("n", X.number(c("t"))).withColumn("r5", F.coalesce(c("n") > 1_000_000_000_000, F.lit(False)))
    d = d.withColumn("ts", F.when(c("r5"), F.expr("n div 1000")).otherwise(c("n")))
    # why a row is isolated before its references are looked at
    bad = F.when(~c("four"), "R1c").when(~X.digits(c("u")) | ~X.digits(c("m")), "R1c").when(~X.full(c("r"), "[1-5]"), F.when(X.digits(c("r")), "R3").otherwise("R2")).when(c("n").isNull(), "R4").when(~c("ts").between(X.TS_MIN, X.TS_MAX), "R6")
    d = d.withColumn("bad", bad).withColumn("r8a", ~c("u_known") & c("uc_known")).withColumn("r8b", ~c("m_known") & c("mc_known"))
    d = d.withColumn("u2", F.when(c("r8a"), c("uc")).otherwise(c("u"))).withColumn("m2", F.when(c("r8b"), c("mc")).otherwise(c("m")))
    sound = c("bad").isNull()
    d = d.withColumn("why", F.coalesce("bad", F.when(~((c("u_known") | c("r8a")) & (c("m_known") | c("r8b"))), "R9"))).withColumn("s", c("ts").cast("string"))
    d = d.select("*", X.join(c("u"), c("m"), c("r"), c("t")).alias("p3"), X.join(c("u"), c("m"), c("r"), c("s")).alias("p4"), X.join(c("u2"), c("m"), c("r"), c("s")).alias("p5"), X.join(c("u2"), c("m2"), c("r"), c("s")).alias("p6"))
    timed = sound | (c("bad") == "R6")
    d = d.withColumn("payload", F.when(sound, c("p6")).when(c("bad") == "R6", c("p4")).when(c("four"), c("p3")).otherwise(c("p2"))).withColumn("disposition", F.when(c("why").isNull(), "KEEP").otherwise("ISOLATE"))
    events = _events(
        "R0",
        _event(c("r1b"), "R1b", "repair", c("raw_record"), c("p1")),
        _event(c("r1a"), "R1a", "repair", c("p1"), c("p2")),
        _event(c("four") & (c("p3") != c("p2")), "R0", "repair", c("p2"), c("p3")),
        _event(timed & c("r5"), "R5", "repair", c("p3"), c("p4")),
        _event(sound & c("r8a"), "R8a", "repair", c("p4"), c("p5")),
        _event(sound & c("r8b"), "R8b", "repair", c("p5"), c("p6")),
        _event(c("why").isNotNull(), c("why"), "isolate", c("payload"), c("payload")),
    )
    d = d.withColumn("events", events).withColumn("pair", F.concat_ws("|", "u2", "m2"))
    return d.select(*KEPT, "pair", "ts", *keep)


def clean_ratings(lines: DataFrame, users: DataFrame, movies: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    """users, movies: the ids that ratings may refer to."""
    d = _read_ratings(lines)
    for value, name in REFERENCES:
        d = _known(d, users if value in ("u", "uc") else movies, value, name)
    return _distinct(ruled_ratings(d), "pair", -F.col("ts"), "R7", held).select(*KEPT)


def clean_all(raw: dict[str, DataFrame], held: list[DataFrame] | None = None) -> dict[str, DataFrame]:
    """All three tables, persisted: each is used several times by what follows, and a cut keeps plans small; for that, the ids that ratings refer to are stored, too. release gives them back, and what de-duplication persists if held is given for it."""
    users, movies = clean_users(raw["users"], held).persist(), clean_movies(raw["movies"], held).persist()
    ids = [stored(reference_ids(d), "ids") for d in (users, movies)]
    return {"users": users, "movies": movies, "ratings": clean_ratings(raw["ratings"], *ids, held).persist()}


def release(cleaned: dict[str, DataFrame], held: Iterable[DataFrame] = ()) -> None:
    for d in (*cleaned.values(), *held):
        d.unpersist()


def _flags(d: DataFrame, ids: DataFrame, value: str, candidate: str, label: str) -> DataFrame:
    """The values that lines name, and of each whether it or its candidate is known; a narrow stored table without those of which neither is. The values are few beside the lines."""
    told = d.select(value, candidate).distinct()
    for c in (value, candidate):
        told = _known(told, ids, c, f"{c}_known")
    return stored(told.where(F.col(f"{value}_known") | F.col(f"{candidate}_known")).drop(candidate), label)


def _bests(ruled: DataFrame, lines: DataFrame, key: str, rank: Column, name: str, label: str) -> DataFrame:
    """lines with name: the id of the row that is kept for each one's key where the key occurs more than once, null where it is the only one. ruled: lines with key and rank."""
    keyed = narrowed(ruled).withColumn("_key", _own_key(key)).withColumn("_rank", rank)
    place = ("source_file", "source_offset", "source_table", "source_id")
    shared = stored(_least(keyed, *place).where("_n > 1").select("_key", *(F.col(f"_b.{c}").alias(f"_{c}") for c in place)), f"keys_{label}", compression="zstd")
    settle(lines.sparkSession)
    moved = keyed.select("_key", *lines.columns).join(shared, "_key", "left")
    best = F.when(F.col("_source_table").isNotNull(), F.coalesce("_source_id", record_name(F.col("_source_table"), F.col("_source_file"), F.col("_source_offset"))))
    return widened(moved.select(*lines.columns, best.alias(name)))


def _dealt(lines: DataFrame) -> DataFrame:
    """lines over all tasks by offset: a file with few row groups would leave the rules to as many tasks."""
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return widened(narrowed(lines).repartition(tasks, "source_offset"))


def settled(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All three tables as clean_all gives them, without caches: what the rules make of a row is stored, so that they run once, and goes when the table is. Shuffles go table by table."""
    spark = raw["users"].sparkSession

    def one_of(ruled: DataFrame, key: str, rank: Column, rule: str, label: str) -> DataFrame:
        return _told(_bests(widened(ruled), ruled, key, rank, "_one", label), F.col("_one"), rule).drop("_one")

    def held(ruled: DataFrame, label: str) -> DataFrame:
        out = stored(narrowed(ruled), f"ruled_{label}", compression="zstd")
        settle(spark)
        return out

    def kept(d: DataFrame, label: str) -> DataFrame:
        out = widened(stored(narrowed(d).select(*KEPT), f"settled_{label}", compression="zstd"))
        settle(spark)
        return out

    score = -F.col("score")
    ruled = held(ruled_users(_dealt(raw["users"])), "users")
    users = kept(one_of(ruled, "uid", score, "U6", "users"), "users")
    discard(ruled)
    ruled = held(ruled_movies(_dealt(raw["movies"])), "movies")
    # the second stage starts from a stored first one
    first = held(sound_movies(one_of(ruled, "mid", score, "M5a", "movies")).drop("mid"), "movies_first")
    discard(ruled)
    movies = kept(one_of(first, "title_key", score, "M5b", "titles"), "movies")
    discard(first)
    d = _read_ratings(raw["ratings"])
    ids = {"u": stored(reference_ids(users), "ids"), "m": stored(reference_ids(movies), "ids")}
    for value, of in ids.items():
        told = _flags(d, of, value, f"{value}c", f"known_{value}")
        names = [f"{value}_known", f"{value}c_known"]
        d = d.join(told.select(F.col(value).alias("_v"), *names), F.col(value) == F.col("_v"), "left").drop("_v").withColumns({n: F.coalesce(n, F.lit(False)) for n in names})
    known = stored(narrowed(d).select(*raw["ratings"].columns, *(n for _, n in REFERENCES)), "ratings_known", compression="zstd")
    settle(spark)
    ruled = held(ruled_ratings(_read_ratings(widened(known))), "ratings")
    discard(known)
    ratings = kept(one_of(ruled, "pair", -F.col("ts"), "R7", "ratings"), "ratings")
    discard(ruled)
    return {"users": users, "movies": movies, "ratings": ratings}
