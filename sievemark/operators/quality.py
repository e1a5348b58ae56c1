"""Quality observations of every record before and after cleaning, and the counters, groups and scores made of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions import exprs as X

SOURCE = ["source_table", "source_file", "source_offset", "source_id"]
REQUIRED = {"users": 5, "movies": 2, "ratings": 4}
WEIGHTS = {"ratings": 0.6, "users": 0.2, "movies": 0.2}
DIMENSIONS = ("accurate", "complete", "unique", "up_to_date", "consistent")
COUNTERS = ("n", "acc", "comp", "cons", "ud", "train", "valid", "test", "uniq_excess")


def raw_ids(lines: DataFrame) -> DataFrame:
    """Distinct ids of raw lines: their first field, trimmed, where it is all digits."""
    return lines.select(X.jtrim(X.at(X.fields(F.col("raw_record")), 0)).alias("id")).where(X.digits(F.col("id"))).distinct()


def _present(f, first: int, last: int):
    own = F.filter(F.slice(f, first + 1, last - first), lambda x: ~X.missing(x))
    return F.size(own)


def _seen(df: DataFrame, accurate, present, consistent, up_to_date, label, key, keep=()) -> DataFrame:
    table = F.col("source_table")
    required = F.create_map(*(F.lit(x) for kv in REQUIRED.items() for x in kv))[table]
    flag = lambda c: c if c is None else F.coalesce(c, F.lit(False)).cast("int")
    none = F.lit(None)
    return df.select(
        *SOURCE, flag(accurate).alias("accurate"), present.alias("present"), required.alias("required"), flag(consistent).alias("consistent"),
        (none.cast("int") if up_to_date is None else flag(up_to_date)).alias("up_to_date"), (none.cast("string") if label is None else label).alias("split"), F.coalesce(key, F.concat(F.lit("ROW:"), F.col("source_id"))).alias("business_key"), *keep,
    )


def observe_users(df: DataFrame, line: str, keep=()) -> DataFrame:
    d = df.withColumn("f", X.fields(F.col(line)))
    f = [X.at(F.col("f"), i) for i in range(5)]
    five = F.size("f") == 5
    base = five & X.digits(f[0]) & X.full(f[1], "[FM]") & f[2].isin(X.AGES) & X.occupation(f[3])
    return _seen(d, base & X.full(f[4], "[0-9]{5}"), _present(F.col("f"), 0, 5), base & X.full(f[4], "[0-9]{5}(-[0-9]{4})?"), None, None, F.when(five & X.digits(f[0]), F.concat(F.lit("U:"), f[0])), keep)


def observe_movies(df: DataFrame, line: str, keep=()) -> DataFrame:
    d = df.withColumn("f", X.fields(F.col(line))).withColumn("title", X.jtrim(X.at(F.col("f"), 1)))
    d = d.withColumn("year", X.year_of(F.col("title"))).withColumn("plain", X.plain_title(F.col("title")))
    whole = (F.size("f") == 3) & (F.col("title") != "") & X.genres_legal(X.at(F.col("f"), 2))
    key = F.when((F.col("plain") != "") & F.col("year").isNotNull(), F.concat(F.lit("M:"), F.to_json(F.array("plain", "year"))))
    return _seen(d, whole & (F.col("year").cast("int") <= X.LAST_YEAR), _present(F.col("f"), 1, 3), whole & X.digits(X.at(F.col("f"), 0)) & F.col("year").isNotNull(), None, None, key, keep)


def observe_ratings(df: DataFrame, line: str, users: DataFrame, movies: DataFrame, keep=()) -> DataFrame:
    d = df.withColumn("f", X.fields(F.col(line)))
    d = d.select("*", *(X.jtrim(X.at(F.col("f"), i)).alias(n) for i, n in enumerate("umrt")))
    for ids, c in ((users, "u"), (movies, "m")):
        d = d.join(ids.select(F.col("id").alias(f"_{c}")), F.col(c) == F.col(f"_{c}"), "left")
    four, ids = F.size("f") == 4, X.digits(F.col("u")) & X.digits(F.col("m"))
    ts = F.when(four, X.number(F.col("t")))
    rated, inside = X.full(F.col("r"), "[1-5]"), ts.between(X.TS_MIN, X.TS_MAX)
    known = F.col("_u").isNotNull() & F.col("_m").isNotNull()
    key = F.when((F.size("f") >= 2) & ids, F.concat(F.lit("R:"), F.to_json(F.array("u", "m"))))
    return _seen(d, four & ids & rated & inside & known, _present(F.col("f"), 0, 4), four & ids & rated & X.full(F.col("t"), "[0-9]{9,10}"), inside, F.when(ts.isNotNull(), X.split_label(ts)), key, keep)


def observed(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame], keep: tuple[str, ...] = (), narrow: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> list[DataFrame]:
    """Observations of each table in each phase, with phase. keep: further columns of both that go along; cleaned rows hold their raw records, so they may be given for raw, too. narrow: makes of reference ids, and of those that ratings name (value), the ids that both hold."""
    kept = {t: d.where("disposition = 'KEEP'").select(*SOURCE, "payload", *keep) for t, d in cleaned.items()}
    ids = lambda t: kept[t].select(F.split_part("payload", F.lit(X.SEP), F.lit(1)).alias("id")).distinct()

    def rated(d: DataFrame, line: str, users: DataFrame, movies: DataFrame) -> DataFrame:
        if narrow:
            f = X.fields(F.col(line))
            users, movies = (narrow(of, d.select(X.jtrim(X.at(f, i)).alias("value"))) for i, of in enumerate((users, movies)))
        return observe_ratings(d, line, users, movies, keep)

    parts = [
        *((d, "before") for d in (observe_users(raw["users"], "raw_record", keep), observe_movies(raw["movies"], "raw_record", keep), rated(raw["ratings"], "raw_record", raw_ids(raw["users"]), raw_ids(raw["movies"])))),
        *((d, "after") for d in (observe_users(kept["users"], "payload", keep), observe_movies(kept["movies"], "payload", keep), rated(kept["ratings"], "payload", ids("users"), ids("movies")))),
    ]
    return [d.withColumn("phase", F.lit(p)) for d, p in parts]


def detail(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """Observations of all tables in both phases, in one table."""
    return reduce(DataFrame.unionByName, observed(raw, cleaned, keep))


def unique_primary(seen: DataFrame) -> DataFrame:
    """Adds whether a record is the first of its business key in order of file and offset. The first is found by an aggregate and joined back, so that no key is sorted in one task."""
    key = ["phase", "source_table", "business_key"]
    first = seen.groupBy(*key).agg(F.min(F.struct("source_file", "source_offset")).alias("_first"))
    own = F.struct("source_file", "source_offset")
    return seen.join(first, key).withColumn("unique_primary", (own == F.col("_first")).cast("int")).drop("_first").select(*seen.columns, "unique_primary")


def groups(seen: DataFrame) -> DataFrame:
    return seen.groupBy("phase", "source_table", "business_key").agg(F.count("*").alias("records")).withColumn("duplicate_excess", F.col("records") - 1)


def counters(seen: DataFrame) -> DataFrame:
    """One row for each phase and table. Keys are counted in a first aggregate, so that each row is summed twice at most."""
    sums = {"acc": "accurate", "comp": "present", "cons": "consistent", "ud": "up_to_date"}
    label = lambda x: F.sum((F.coalesce("split", F.lit("")) == x.upper()).cast("long"))
    per = seen.groupBy("phase", "source_table", "business_key").agg(F.count("*").alias("n"), *(F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(k) for k, c in sums.items()), *(label(x).alias(x) for x in ("train", "valid", "test")))
    return per.groupBy("phase", "source_table").agg(*(F.sum(c).alias(c) for c in COUNTERS[:-1]), F.sum(F.col("n") - 1).alias("uniq_excess"))


def counter_pairs(counted: DataFrame) -> DataFrame:
    """phase, source_table, key, value: the counters one by one, under their capital names."""
    items = F.array(*(F.struct(F.lit(c.upper()).alias("key"), F.col(c).alias("value")) for c in COUNTERS))
    return counted.select("phase", "source_table", F.explode(items).alias("x")).select("phase", "source_table", "x.*")


def scan_counters(pairs: DataFrame) -> DataFrame:
    """Counters from their pairs; an unknown key, a key that occurs twice or a negative value is an error, a missing one is 0."""
    names = [c.upper() for c in COUNTERS]
    odd = pairs.groupBy("phase", "source_table", "key").agg(F.count("*").alias("k"), F.min("value").alias("least")).where(~F.col("key").isin(names) | (F.col("k") > 1) | (F.col("least") < 0) | F.col("least").isNull()).limit(1).collect()
    if odd:
        raise ValueError(f"odd counter {odd[0].asDict()}")
    return pairs.groupBy("phase", "source_table").agg(*(F.coalesce(F.max(F.when(F.col("key") == n, F.col("value"))), F.lit(0)).alias(n.lower()) for n in names))


def summary(counted: DataFrame) -> DataFrame:
    """phase, source_table, metric, numerator, denominator, score: thirty rows for three tables in two phases."""
    required = F.create_map(*(F.lit(x) for kv in REQUIRED.items() for x in kv))[F.col("source_table")]
    rated = F.col("source_table") == "ratings"
    top = {"accurate": F.col("acc"), "complete": F.col("comp"), "unique": F.col("n") - F.col("uniq_excess"), "up_to_date": F.when(rated, F.col("ud")), "consistent": F.col("cons")}
    bottom = {"complete": F.col("n") * required, "up_to_date": F.when(rated, F.col("n"))}
    items = F.array(*(F.struct(F.lit(m).alias("metric"), top[m].alias("numerator"), bottom.get(m, F.col("n")).alias("denominator")) for m in DIMENSIONS))
    out = counted.select("phase", "source_table", F.explode(items).alias("x")).select("phase", "source_table", "x.*")
    return out.withColumn("score", F.when(F.col("denominator") > 0, 100.0 * F.col("numerator") / F.col("denominator")).when(F.col("denominator") == 0, F.lit(0.0)))


def composites(scores: DataFrame) -> DataFrame:
    """phase, scope, composite: of each table the mean of its dimensions, and of the dataset their weighted sum."""
    tables = scores.groupBy("phase", "source_table").agg((F.sum("score") / F.count("score")).alias("composite"))
    part = lambda t: F.max(F.when(F.col("source_table") == t, F.col("composite")))
    whole = tables.groupBy("phase").agg((part("ratings") * 0.6 + part("users") * 0.2 + part("movies") * 0.2).alias("composite"))
    return tables.withColumnRenamed("source_table", "scope").unionByName(whole.withColumn("scope", F.lit("dataset")))
