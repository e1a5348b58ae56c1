"""Versions of published tables as external tables: written once under their version, registered, and counted against what was published."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "output_version"


def literal(value: str) -> str:
    """A quoted name or location for SQL; anything but letters, digits and a few marks is refused."""
    if not re.fullmatch(r"[A-Za-z0-9_./=:-]+", value) or ".." in value:
        raise ValueError(f"{value!r} cannot stand in a statement")
    return f"'{value}'"


def project(tables: dict[str, DataFrame], folder: str, version: str) -> dict[str, int]:
    """Writes tables under folder/table/output_version=version and returns their rows; a version that is there is never replaced."""
    literal(version)
    rows = {}
    for name, df in tables.items():
        path = f"{folder}/{name}/{PARTITION}={version}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        rows[name] = df.sparkSession.read.parquet(path).count()
    return rows


def register(spark: SparkSession, folder: str, names: dict[str, DataFrame], prefix: str) -> dict[str, str]:
    """Creates an external table for each folder and returns their names. A table that is there has to be the same; nothing is dropped or repaired."""
    found = {}
    for name, like in names.items():
        table = f"{prefix}_{name}"
        if not re.fullmatch(r"[a-z][a-z0-9_]{0,127}", table):
            raise ValueError(f"{table!r} is no table name")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{PARTITION}` string) USING parquet PARTITIONED BY (`{PARTITION}`) LOCATION {literal(f'{folder}/{name}')}")
        spark.catalog.recoverPartitions(table)
        found[name] = table
    return found


def odd_table(spark: SparkSession, table: str, like: DataFrame, location: str) -> list[str]:
    """What differs between a registered table and what it should be: columns, partition column, format, place."""
    out = []
    want = [(f.name, f.dataType.simpleString()) for f in like.schema]
    have = spark.table(table).schema
    if [(f.name, f.dataType.simpleString()) for f in have if f.name != PARTITION] != want:
        out.append("columns")
    said = {r["col_name"].strip(): (r["data_type"] or "").strip() for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    if have.names[-1] != PARTITION or "# Partition Information" not in said:
        out.append("partition")
    if said.get("Type") != "EXTERNAL" or said.get("Provider", "").lower() != "parquet":
        out.append("format")
    plain = lambda p: re.sub(r"^file:/+", "/", p).rstrip("/")
    if plain(said.get("Location", "")) != plain(location):
        out.append("location")
    return out


def analysis(spark: SparkSession, tables: dict[str, str], version: str, expected: dict[str, int], bound: dict[str, Column]) -> DataFrame:
    """source_table, actual_rows, bound_rows, expected_rows, reconciled: all rows of a version, those that fulfil what binds them to their table, and those that were published. Rows that a condition would hide show in the difference."""
    each = (spark.table(t).where(F.col(PARTITION) == version).agg(F.lit(name).alias("source_table"), F.count("*").alias("actual_rows"), F.count_if(bound[name]).alias("bound_rows"), F.lit(expected[name]).cast("long").alias("expected_rows")) for name, t in tables.items())
    return reduce(DataFrame.unionByName, each).withColumn("reconciled", (F.col("actual_rows") == F.col("expected_rows")) & (F.col("bound_rows") == F.col("actual_rows")))


def distributions(spark: SparkSession, table: str) -> DataFrame:
    """output_version, rating, records of all versions."""
    return spark.table(table).groupBy(PARTITION, "rating").agg(F.count("*").alias("records"))


def transitions(per_version: DataFrame, order: list[str]) -> DataFrame:
    """left_version, right_version, rating, records_delta between neighbours in the caller's order; a rating that one side lacks counts 0 there."""
    steps = per_version.sparkSession.createDataFrame(list(zip(order, order[1:], strict=False)), "left_version string, right_version string")
    ratings = steps.crossJoin(per_version.select("rating").distinct())  # a few steps by five ratings
    side = lambda n: per_version.select(F.col(PARTITION).alias(f"{n}_version"), "rating", F.col("records").alias(f"{n}_records"))
    both = ratings.join(side("left"), ["left_version", "rating"], "left").join(side("right"), ["right_version", "rating"], "left")
    return both.select("left_version", "right_version", "rating", (F.coalesce("right_records", F.lit(0)) - F.coalesce("left_records", F.lit(0))).alias("records_delta"))
