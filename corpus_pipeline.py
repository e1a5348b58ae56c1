"""A corpus pipeline over the documents table, in stages that each read what the one before wrote.

run(spark, sf_dir) applies the stages to documents; each stage's rows are written as Parquet in the shared folder and read
again as the next one's docs, so that a lost executor costs no more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievemark.llm import decontamination, language_id, mixing, near_dup, secrets
from sievemark.llm.common import small_batches, table, written

#: Least similarity to the closest profile, of 1, at which a document counts as being in that language. On a third of sf0.1 documents lie above 0.41, the Polish and Finnish sentences tried at 0.31, random letters below 0.26.
LEAST_SIMILARITY = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, in `lang` too where that was null; others go."""
    small_batches(spark)
    return language_id.keep_identified(docs, language_id.fit(docs), LEAST_SIMILARITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    small_batches(spark)
    return near_dup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    small_batches(spark)
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every copy that the mix takes, in training order, with the document's columns, how the mix treats it, and the copy's position."""
    return mixing.training_order(mixing.mix(docs, keep=True))


STAGES = [
    ("language ID", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secret scan", redact_secrets),
    ("mixing", mix_sources),
]

#: No SQL: language identification and entropy scans lie outside it. tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage leaves."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = written(docs, f"stage{n}")
    return docs
