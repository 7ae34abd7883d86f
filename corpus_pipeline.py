"""From raw documents to packed token rows, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyguard.llm.decontaminate import clean_documents
from tallyguard.llm.mixing import mixed_documents
from tallyguard.llm.neardup import one_of_each
from tallyguard.llm.packing import pack
from tallyguard.llm.quality import keep_good
from tallyguard.llm.tables import Steps


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return clean_documents(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of packed token ids."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixture", mixture),
    ("token_packing", packing),
]

# Sampling, similarity and tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    steps = Steps(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = steps.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
