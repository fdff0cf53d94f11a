"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all that its predecessor kept and returns the columns of documents;
the last returns them with ``copies``, the times a document is drawn into the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaptally.llm import base as B
from snaptally.llm import decontaminate, mixing, quality, secrets, simhash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    B.prepare(spark)
    return quality.keep(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    B.prepare(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    B.prepare(spark)
    return decontaminate.keep_clean(docs, B.table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; no document goes."""
    B.prepare(spark)
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn into the mixture, with their number of copies."""
    B.prepare(spark)
    return mixing.draw(docs)


STAGES = [("quality", quality_stage), ("simhash", simhash_stage), ("decontaminate", decontaminate_stage),
          ("secrets", secrets_stage), ("mixing", mixing_stage)]

# SQL has no XXH64 for the SimHash stage; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written to the shared folder and read back."""
    docs = B.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = B.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
