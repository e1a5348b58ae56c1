"""The registered query of every corpus operator, with production parameters, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, html_text, language_id, mixing, near_dup, oracles, secrets, substring_dedup, top_k, toxicity, warc
from .common import shared_dir, table


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(top_k.quantised(table(spark, sf_dir, "embeddings")), lambda vec_id: vec_id % 50 == 0, 5)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    positions = [F.get("positions", F.lit(j)).alias("position" if j == 0 else f"position{j + 1}") for j in range(mixing.CEILING)]
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", *positions)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), out)
    return warc.read_archives(spark, out).drop("url")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("h")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_top_k, op2_substring_dedup, op3_mixing, op4_warc, op5_toxicity, op6_language_id, op7_secrets, op8_near_dup, op9_decontamination, op10_html_text)
}
ORACLES: dict[str, str] = oracles.SQL
