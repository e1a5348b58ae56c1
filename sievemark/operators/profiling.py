"""Profiles of raw tables: field counts, bad values, repeated keys, conflicts, gaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions import exprs as X


# Characters that tell of wrongly decoded titles, the first and last second of a plausible rating, and the official sizes.
MOJIBAKE = "[ÃÂâ€¢ð]"
FIRST_SECOND, LAST_SECOND = 788918400, 1104537600
OFFICIAL = {"users": 6040, "movies": 3883, "ratings": 1000209}


def filled(names: str) -> Column:
    """Whether a row has as many fields as it has names, none of them empty."""
    fields = names.split()
    return reduce(lambda a, c: a & (F.col(c) != ""), fields, F.col("width") == len(fields))


def split_lines(lines: DataFrame, names: str) -> DataFrame:
    """The lines with their number of fields (width) and the fields by name; missing ones are empty."""
    d = lines.withColumn("f", X.fields(F.col("raw_record")))
    return d.select("source_offset", "raw_record", F.size("f").alias("width"), *(X.at(F.col("f"), i).alias(n) for i, n in enumerate(names.split())))


def counted(d: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """measure, n: how many rows hold for each check, in one pass."""
    row = d.agg(*(F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0)).alias(k) for k, c in checks.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), F.col(k).alias("n")) for k in checks))).alias("x")).select("x.*")


def _repeats(d: DataFrame, key: str) -> DataFrame:
    """Whether a row repeats a key, and whether its line differs from the one before with that key."""
    w = Window.partitionBy(key).orderBy("source_offset")
    return d.withColumn("again", F.row_number().over(w) > 1).withColumn("changed", F.col("raw_record") != F.lag("raw_record").over(w))


def profile_users(lines: DataFrame) -> DataFrame:
    d = split_lines(lines, "id g a o z")
    ok = F.col("width") == 5
    whole = _repeats(d.where(ok), "id")
    legal = [str(i) for i in range(21)]
    checks = {"repeated_id": F.col("again"), "conflicting_id": F.col("changed"), "bad_id": ~X.digits(F.col("id")), "bad_gender": ~F.col("g").isin("F", "M"), "bad_age": ~F.col("a").isin(X.AGES), "bad_occupation": ~F.col("o").isin(legal), "bad_zip": ~X.full(F.col("z"), "[0-9]{5}(-[0-9]{4})?")}
    distinct = whole.agg(F.lit("distinct_id").alias("measure"), F.countDistinct("id").alias("n"))
    return counted(d, {"total": F.lit(True), "wrong_width": ~ok}).unionByName(counted(whole, checks)).unionByName(distinct)


def profile_movies(lines: DataFrame) -> DataFrame:
    d = split_lines(lines, "id t g")
    ok = F.col("width") == 3
    whole = _repeats(d.where(ok), "id").withColumn("gs", F.when(X.blank(F.col("g")), F.array().cast("array<string>")).otherwise(F.split("g", r"\|", -1)))
    checks = {"repeated_id": F.col("again"), "conflicting_id": F.col("changed"), "bad_id": ~X.digits(F.col("id")), "empty_title": X.blank(F.col("t")), "mojibake": F.col("t").rlike(MOJIBAKE), "no_year": X.year_of(F.col("t")).isNull(), "empty_genres": X.blank(F.col("g")), "repeated_genre": F.size(F.array_distinct("gs")) < F.size("gs")}
    more = [whole.agg(F.lit("distinct_id").alias("measure"), F.countDistinct("id").alias("n"))]
    more += [whole.agg(F.lit("unknown_genres").alias("measure"), F.coalesce(F.sum(F.size(F.filter("gs", lambda x: ~x.isin(X.GENRES)))), F.lit(0)).cast("long").alias("n"))]
    return reduce(DataFrame.unionByName, more, counted(d, {"total": F.lit(True), "wrong_width": ~ok}).unionByName(counted(whole, checks)))


def profile_ratings(lines: DataFrame, users: DataFrame, movies: DataFrame, low: int = FIRST_SECOND, high: int = LAST_SECOND) -> DataFrame:
    """low, high: the bounds of the years that the profile takes for plausible."""
    d = split_lines(lines, "u m r t")
    ok = F.col("width") == 4
    whole = d.where(ok).withColumn("ts", X.number(F.col("t")))
    w = Window.partitionBy("u", "m").orderBy("source_offset")
    paired = whole.withColumn("again", F.row_number().over(w) > 1).withColumn("other", F.col("r") != F.first("r").over(w))
    for ids, c in ((users, "u"), (movies, "m")):
        paired = paired.join(ids.select(F.col("id").alias(f"_{c}")), F.col(c) == F.col(f"_{c}"), "left")
    checks = {"bad_user": ~X.digits(F.col("u")), "bad_movie": ~X.digits(F.col("m")), "bad_rating": ~X.full(F.col("r"), "[1-5]"), "bad_time": F.col("ts").isNull(), "time_outside": ~F.col("ts").between(low, high), "extra_rows": F.col("again"), "rating_conflict": F.col("other"), "unknown_user": X.digits(F.col("u")) & F.col("_u").isNull(), "unknown_movie": X.digits(F.col("m")) & F.col("_m").isNull()}
    pairs = whole.groupBy("u", "m").count()
    more = [pairs.agg(F.lit("distinct_pairs").alias("measure"), F.count("*").alias("n")), pairs.where("count > 1").agg(F.lit("repeated_pairs").alias("measure"), F.count("*").alias("n"))]
    more += [whole.where(F.col("ts").between(low, high)).agg(F.lit(f"{k}_time").alias("measure"), f("ts").alias("n")) for k, f in (("first", F.min), ("last", F.max))]
    return reduce(DataFrame.unionByName, more, counted(d, {"total": F.lit(True), "wrong_width": ~ok}).unionByName(counted(paired, checks)))


def official_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """source_table, official, n, surplus: rows against the sizes that the data set is published with."""
    each = (d.agg(F.lit(t).alias("source_table"), F.lit(OFFICIAL[t]).cast("long").alias("official"), F.count("*").alias("n")) for t, d in raw.items())
    return reduce(DataFrame.unionByName, each).withColumn("surplus", F.col("n") - F.col("official"))


def zip_masks(lines: DataFrame, top: int = 10) -> DataFrame:
    """mask, n: the most frequent patterns of ZIP codes in complete rows, digits as 9."""
    d = split_lines(lines, "id g a o z").where(filled("id g a o z"))
    return d.groupBy(F.regexp_replace("z", "[0-9]", "9").alias("mask")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "mask").limit(top)


def ratings_per_user(lines: DataFrame, heavy: int = 2000) -> DataFrame:
    """users, least, upper_median, most, heavy: of the number of complete ratings a user has. Users are counted by their number of ratings first, so that the median is found among few rows."""
    per = split_lines(lines, "u m r t").where(filled("u m r t")).groupBy("u").count()
    hist = per.groupBy("count").agg(F.count("*").alias("users"))
    w = Window.orderBy("count")
    run = hist.withColumn("through", F.sum("users").over(w)).withColumn("all", F.sum("users").over(Window.partitionBy()))
    half = F.min(F.when(F.col("through") > F.expr("all div 2"), F.col("count")))
    return run.agg(F.sum("users").alias("users"), F.min("count").alias("least"), half.alias("upper_median"), F.max("count").alias("most"), F.coalesce(F.sum(F.when(F.col("count") > heavy, F.col("users"))), F.lit(0)).alias("heavy"))


def id_gaps(lines: DataFrame) -> DataFrame:
    """low, high, gaps of the ids of complete rows."""
    i = X.number(F.col("id"))
    return split_lines(lines, "id t g").where(filled("id t g")).agg(F.min(i).alias("low"), F.max(i).alias("high"), (F.max(i) - F.min(i) + 1 - F.countDistinct("id")).alias("gaps"))


def title_conflicts(lines: DataFrame) -> DataFrame:
    """kind, n over complete rows: names (titles without their year) with several ids, and ids with several titles, genre lists or rows."""
    d = split_lines(lines, "id t g").where(filled("id t g")).withColumn("name", X.jtrim(F.regexp_replace("t", r"[(][0-9]{4}[)]\s*$", "")))
    out = [d.groupBy("name").agg(F.countDistinct("id").alias("k")).where("k > 1").agg(F.lit("name_with_ids").alias("kind"), F.count("*").alias("n"))]
    per = d.groupBy("id").agg(F.countDistinct("t").alias("titles"), F.countDistinct("g").alias("genres"), F.count("*").alias("rows"))
    out += [per.agg(F.lit(f"id_with_{c}").alias("kind"), F.coalesce(F.sum((F.col(c) > 1).cast("long")), F.lit(0)).alias("n")) for c in ("titles", "genres", "rows")]
    return reduce(DataFrame.unionByName, out)
