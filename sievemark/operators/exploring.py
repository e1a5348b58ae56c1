"""Exploration of raw tables: rows that have all fields filled, what is odd about them, and how their values are spread."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions import exprs as X
from sievemark.operators.profiling import counted, filled, split_lines

FIELDS = {"users": "id g a o z", "movies": "id t g", "ratings": "u m r t"}
# Seconds between which a rating's time is plausible.
PLAUSIBLE = (631123200, 1047791999)
#: Characters of a bad value that are reported.
PREFIXES = {"gender": 12, "age": 12, "occupation": 12, "zip": 10, "genre": 16, "rating": 8}


def _rows(lines: DataFrame, table: str) -> tuple[DataFrame, Column]:
    return split_lines(lines, FIELDS[table]), filled(FIELDS[table])


def explore_users(lines: DataFrame) -> DataFrame:
    """measure, n: odd fields, ids with several rows or different attributes, and genders by id (the least one of an id)."""
    d, ok = _rows(lines, "users")
    number = lambda c: X.number(F.col(c))
    checks = {"incomplete": ~ok, "bad_gender": ok & ~F.col("g").isin("F", "M"), "bad_age": ok & ~F.coalesce(number("a").isin([int(a) for a in X.AGES]), F.lit(False)), "bad_occupation": ok & ~F.coalesce(number("o") <= X.LAST_OCCUPATION, F.lit(False)), "bad_zip": ok & ~X.full(F.col("z"), "[0-9]{5}")}
    per = d.where(ok).groupBy("id").agg(F.count("*").alias("k"), F.countDistinct("g", "a", "o", "z").alias("v"), F.min("g").alias("gender"))
    ids = counted(per, {"id_with_rows": F.col("k") > 1, "id_with_attributes": F.col("v") > 1})
    return counted(d, checks).unionByName(ids).unionByName(per.groupBy(F.concat(F.lit("gender_"), "gender").alias("measure")).agg(F.count("*").alias("n")))


def explore_movies(lines: DataFrame) -> DataFrame:
    """measure, n: odd titles and genres of complete rows, and names (titles without their year) that several ids have."""
    d, ok = _rows(lines, "movies")
    genres = F.transform(F.split("g", r"\|", -1), X.jtrim)
    checks = {"incomplete": ~ok, "beyond_ascii": ok & F.col("t").rlike(r"[^\x00-\x7F]"), "padded_title": ok & (X.jtrim(F.col("t")) != F.col("t")), "no_year": ok & X.year_of(F.col("t")).isNull(), "empty_genres": ok & X.blank(F.col("g")), "unknown_genre": ok & F.exists(genres, lambda x: ~x.isin(X.GENRES))}
    name = X.jtrim(F.regexp_replace("t", r"[(][0-9]{4}[)]\s*$", ""))
    names = d.where(ok).groupBy(name.alias("name")).agg(F.countDistinct("id").alias("k"))
    return counted(d, checks).unionByName(counted(names, {"name_with_ids": F.col("k") > 1}))


def explore_ratings(lines: DataFrame) -> DataFrame:
    """measure, n: odd ratings and times of complete rows, and user and movie pairs with several rows or ratings."""
    d, ok = _rows(lines, "ratings")
    d = d.withColumn("rv", X.number(F.col("r"))).withColumn("ts", X.number(F.col("t")))
    checks = {"incomplete": ~ok, "no_integer": ok & F.col("rv").isNull(), "outside_1_5": ok & ~F.col("rv").between(1, 5), "no_time": ok & F.col("ts").isNull(), "time_implausible": (F.col("width") == 4) & ~F.col("ts").between(*PLAUSIBLE)}
    per = d.where(ok).groupBy("u", "m").agg(F.count("*").alias("k"), F.countDistinct("rv").alias("v"))
    pairs = counted(per, {"repeated_pairs": F.col("k") > 1, "conflicting_pairs": F.col("v") > 1})
    times = [d.where(ok).agg(F.lit(f"{k}_time").alias("measure"), f("ts").alias("n")) for k, f in (("first", F.min), ("last", F.max))]
    return reduce(DataFrame.unionByName, times, counted(d, checks)).unionByName(pairs).unionByName(per.agg(F.lit("rows_of_repeated_pairs").alias("measure"), F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).alias("n")))


def most_repeated_pairs(lines: DataFrame, top: int = 5) -> DataFrame:
    """u, m, n of the user and movie pairs with most rows; ties to the smaller ids as text."""
    d, ok = _rows(lines, "ratings")
    return d.where(ok).groupBy("u", "m").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "u", "m").limit(top)


def most_active_users(lines: DataFrame, top: int = 5) -> DataFrame:
    """u, n of the users with most rows; ties to the smaller id as text."""
    d, ok = _rows(lines, "ratings")
    return d.where(ok).groupBy("u").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "u").limit(top)


def value_histogram(lines: DataFrame) -> DataFrame:
    """rating, n over complete rows whose rating is an integer."""
    d, ok = _rows(lines, "ratings")
    return d.where(ok).select(X.number(F.col("r")).alias("rating")).where("rating is not null").groupBy("rating").agg(F.count("*").alias("n"))


def widths(raw: dict[str, DataFrame]) -> DataFrame:
    """source_table, width, n: how many lines have how many fields."""
    each = (d.select(F.lit(t).alias("source_table"), F.size(X.fields(F.col("raw_record"))).alias("width")) for t, d in raw.items())
    return reduce(DataFrame.unionByName, each).groupBy("source_table", "width").agg(F.count("*").alias("n"))


def bad_values(raw: dict[str, DataFrame]) -> DataFrame:
    """source_table, field, value, n: values outside their domain in rows of the right width, cut to the length reported, most of a table's fields in one pass."""
    u, m, r = (split_lines(raw[t], FIELDS[t]).where(F.col("width") == len(FIELDS[t].split())) for t in FIELDS)
    said = lambda field, bad, c: F.when(bad, F.struct(F.lit(field).alias("field"), F.substring(c, 1, PREFIXES[field]).alias("value")))
    legal = [str(i) for i in range(X.LAST_OCCUPATION + 1)]
    users = F.array(said("gender", ~F.col("g").isin("F", "M"), F.col("g")), said("age", ~F.col("a").isin(X.AGES), F.col("a")), said("occupation", ~F.col("o").isin(legal), F.col("o")), said("zip", ~X.full(F.col("z"), "[0-9]{5}(-[0-9]{4})?"), F.col("z")))
    movies = F.when(~X.blank(F.col("g")), F.transform(F.split("g", r"\|", -1), lambda x: said("genre", ~x.isin(X.GENRES), x)))
    ratings = F.array(said("rating", ~X.full(F.col("r"), "[1-5]"), F.col("r")))
    each = (d.select(F.lit(t).alias("source_table"), F.explode(x).alias("x")).where("x is not null").select("source_table", "x.*") for t, d, x in (("users", u, users), ("movies", m, movies), ("ratings", r, ratings)))
    return reduce(DataFrame.unionByName, each).groupBy("source_table", "field", "value").agg(F.count("*").alias("n"))


def samples(raw: dict[str, DataFrame], most: int = 3) -> DataFrame:
    """source_table, kind, place, source_offset, raw_record: the first odd lines of each kind."""
    out = []
    for table, checks in (
        ("users", {"incomplete": None, "bad_gender": ~F.col("g").isin("F", "M"), "bad_zip": ~X.full(F.col("z"), "[0-9]{5}")}),
        ("movies", {"incomplete": None, "padded_title": X.jtrim(F.col("t")) != F.col("t"), "no_year": X.year_of(F.col("t")).isNull()}),
        ("ratings", {"incomplete": None, "no_integer": X.number(F.col("r")).isNull(), "outside_1_5": ~X.number(F.col("r")).between(1, 5), "no_time": X.number(F.col("t")).isNull()}),
    ):
        d, ok = _rows(raw[table], table)
        kinds = F.array(*(F.when(~ok if c is None else ok & c, F.lit(k)) for k, c in checks.items()))
        out.append(d.select(F.lit(table).alias("source_table"), F.explode(kinds).alias("kind"), "source_offset", "raw_record").where("kind is not null"))
    first = Window.partitionBy("source_table", "kind").orderBy("source_offset")
    return reduce(DataFrame.unionByName, out).withColumn("place", F.row_number().over(first)).where(F.col("place") <= most)


def unknown_references(raw: dict[str, DataFrame]) -> DataFrame:
    """kind, id: the distinct users and movies of complete ratings that no complete row of their table has, in order."""
    out = []
    rated, ok = _rows(raw["ratings"], "ratings")
    for kind, table, c in (("user", "users", "u"), ("movie", "movies", "m")):
        d, known = _rows(raw[table], table)
        ids = d.where(known).select(F.col("id").alias("known")).distinct()
        out.append(rated.where(ok).select(F.col(c).alias("id")).distinct().join(ids, F.col("id") == F.col("known"), "left_anti").select(F.lit(kind).alias("kind"), "id"))
    return out[0].unionByName(out[1]).orderBy("kind", "id")


def files(binary: DataFrame) -> DataFrame:
    """path, bytes, whole_utf8, crlf, lines of whole files (path, content): whether all of it is UTF-8, line ends with a carriage return, and lines that are not empty."""
    text = F.decode("content", "ISO-8859-1")
    rows = F.filter(F.split(text, "\n", -1), lambda x: x != "")
    return binary.select("path", F.octet_length("content").cast("long").alias("bytes"), F.is_valid_utf8(F.col("content").cast("string")).alias("whole_utf8"), F.regexp_count(text, F.lit("\r\n")).cast("long").alias("crlf"), F.size(rows).cast("long").alias("lines"))
