"""Backups of tables as JSON lines whose cells name their kind, so that what is read back has the types it had."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: How a kind of value is written and read again.
KINDS = {"bigint": "integer", "int": "integer", "smallint": "integer", "tinyint": "integer", "string": "text", "boolean": "boolean", "double": "number", "float": "number", "date": "date", "timestamp": "time", "timestamp_ntz": "time", "binary": "bytes"}


def _cell(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    text = F.base64(c) if kind == "binary" else F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if kind.startswith("timestamp") else c.cast("string")
    known = KINDS.get(kind, "decimal" if kind.startswith("decimal") else None)
    if known is None:
        raise ValueError(f"{name}: no cell for {kind}")
    return F.when(c.isNotNull(), F.struct(F.lit(known).alias("kind"), text.alias("value")))


def cells(df: DataFrame) -> DataFrame:
    """line: each row as JSON with a cell (kind, value) for each column, null for null."""
    return df.select(F.to_json(F.struct(*(_cell(f.name, f.dataType.simpleString()).alias(f.name) for f in df.schema)), {"ignoreNullFields": "false"}).alias("line"))


def write(df: DataFrame, folder: str) -> None:
    cells(df).write.mode("errorifexists").text(folder)


def restored(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows of a backup with the types of schema; a cell of another kind than its column's raises."""
    shape = "struct<" + ",".join(f"`{f.name}`:struct<kind:string,value:string>" for f in schema) + ">"
    rows = spark.read.text(folder).select(F.from_json("value", shape, {"mode": "FAILFAST"}).alias("x"))
    out = []
    for f in schema:
        kind = f.dataType.simpleString()
        cell = F.col("x").getField(f.name)
        value = cell.getField("value")
        typed = F.unbase64(value) if kind == "binary" else value.cast(f.dataType)
        known = KINDS.get(kind, "decimal")
        out.append(F.when(cell.isNull(), F.lit(None).cast(f.dataType)).when(cell.getField("kind") == known, typed).otherwise(F.raise_error(F.lit(f"{f.name} holds another kind than {known}")).cast(f.dataType)).alias(f.name))
    return rows.select(*out)


def quiescent(runs: DataFrame, ended: tuple[str, ...] = ("PUBLISHED", "FAILED")) -> DataFrame:
    """status, n of the runs that are still at work: a backup is taken when there is none. runs: status."""
    return runs.where(~F.col("status").isin(*ended)).groupBy("status").agg(F.count("*").alias("n"))
