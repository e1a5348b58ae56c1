"""Dirty raw lines made from the driver's tables, with the faults that the rules treat, chosen by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions import exprs as X

VERSION = "raw-synthetic"
TABLES = ("users", "movies", "ratings")


def record_name(table: Column, file: Column, offset: Column) -> Column:
    return X.record_id(VERSION, table, file, offset)


def _own_name() -> Column:
    return record_name(F.col("source_table"), F.col("source_file"), F.col("source_offset"))


def narrowed(d: DataFrame) -> DataFrame:
    """d with a source_id that is null where table, file and offset give it, so that its 64 digits need not be stored or shuffled."""
    return d.withColumn("source_id", F.when(~F.col("source_id").eqNullSafe(_own_name()), F.col("source_id")))


def widened(d: DataFrame) -> DataFrame:
    return d.withColumn("source_id", F.coalesce("source_id", _own_name()))


def _lines(df: DataFrame, table: str, key: str, raw) -> DataFrame:
    file, offset = F.lit(table + ".dat"), F.col(key).cast("long")
    return df.select(F.lit(table).alias("source_table"), file.alias("source_file"), offset.alias("source_offset"), X.record_id(VERSION, F.lit(table), file, offset).alias("source_id"), raw.alias("raw_record"))


def _pick(fault, cases: dict, otherwise):
    out = otherwise
    for k, v in cases.items():
        out = F.when(fault == k, v).otherwise(out)
    return out


def _nth(values: list[str], i) -> object:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (i + 1).cast("int"))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    k = F.col("c_custkey")
    i, g = (k + 1).cast("string"), F.when(k % 2 == 0, "F").otherwise("M")
    a, o, z = _nth(X.AGES, k % 7), (k % 23).cast("string"), F.lpad(((k * 37) % 100000).cast("string"), 5, "0")
    base = X.join(i, g, a, o, z)
    raw = _pick(
        k % 53,
        {0: F.concat(base, F.lit("::x")), 1: X.join(i, g, a, o), 2: F.concat_ws(":", i, g, a, o, z), 3: X.join(i, F.lit("X"), a, o, z), 4: X.join(i, g, F.lit("30"), o, z), 5: F.concat(base, F.lit("-1234")), 6: F.concat(base, F.lit("6789")), 7: X.join(i, g, a, o, F.lit("ABCDE")), 8: X.join(k.cast("string"), g, a, o, z), 9: F.concat_ws(" :: ", F.concat(F.lit(" "), i), g, a, o, F.concat(z, F.lit(" ")))},
        base,
    )
    return _lines(c, "users", "c_custkey", raw)


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    i = (k + 1).cast("string")
    title = F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1930) + k % 80).cast("string"), F.lit(")"))
    genres = F.concat_ws("|", _nth(X.GENRES, k % 18), _nth(X.GENRES, k % 7 + 11))
    raw = _pick(
        k % 47,
        {0: X.join(i, title, F.lit("UnknownGenre")), 1: X.join(i, title), 2: X.join(i, F.lit(""), genres), 3: X.join(i, F.col("p_name"), genres), 4: X.join(i, F.concat(F.col("p_name"), F.lit(" CafÃ© (1999)")), genres), 5: X.join(k.cast("string"), title, genres), 6: F.concat_ws(" :: ", i, title, genres), 7: X.join(i, title, F.concat(genres, F.lit("|Weird")))},
        X.join(i, title, genres),
    )
    return _lines(p, "movies", "p_partkey", raw)


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id")
    k = F.col("event_id")
    user, movie = F.col("user_id") + 1, k % 64 + 1
    u, m, r, t = user.cast("string"), movie.cast("string"), (k % 5 + 1).cast("string"), (F.lit(946684800) + (k * 7919) % 100000000).cast("string")
    base = X.join(u, m, r, t)
    raw = _pick(
        k % 101,
        {0: F.concat(base, F.lit("::extra")), 1: F.concat_ws(",", u, m, r, t), 2: X.join(u, m, r), 3: X.join(u, m, F.lit("3.5"), t), 4: X.join(u, m, F.lit("6"), t), 5: X.join(u, m, r, F.lit("bad")), 6: F.concat(base, F.lit("000")), 7: X.join(u, m, r, F.lit("0")), 8: X.join((user + 1000000).cast("string"), m, r, t), 9: X.join(u, (movie + 2000000).cast("string"), r, t), 10: X.join(F.lit("999999"), m, r, t), 11: F.concat_ws(" :: ", F.concat(F.lit(" "), u), m, r, F.concat(t, F.lit(" ")))},
        base,
    )
    return _lines(e, "ratings", "event_id", raw)


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"users": raw_users(spark, sf_dir), "movies": raw_movies(spark, sf_dir), "ratings": raw_ratings(spark, sf_dir)}
