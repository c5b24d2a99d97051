"""The corpus pipeline: documents through five stages, each written to the shared folder and read again.

Every stage keeps the columns of ``documents``; the last adds ``copies``. A stage's docstring in ``salesflow.llm`` says what it does with
nulls, empty texts, ties, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesflow.llm import decontaminate, exact_dedup, minhash, mixture, toxicity
from salesflow.llm.shared import ship_package, stored


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon rejects go."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id."""
    ship_package(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id: five-word shingles, similarity 0.8."""
    ship_package(spark)
    return minhash.drop_near_copies(docs, words=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of times each is read in ``copies``."""
    return mixture.take_mix(docs)


STAGES = [("toxicity", toxic_documents), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("decontaminate", benchmark_leaks), ("mixing", mixing)]
# The lexicon, the rolling hash and the signatures have no SQL form; tests/llm/test_pipeline.py follows the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
