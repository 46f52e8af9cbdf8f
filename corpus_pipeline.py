"""A corpus pipeline: from raw documents to packed sequences, each stage over what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segmart.llm import exact_dedup, jaccard_join, packing, quality_rules, substring_dedup
from segmart.llm.queries import vocabulary
from segmart.session import staged

NEAR_COPIES = jaccard_join.Similarity(k=5, percent=80)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of quality rules."""
    return quality_rules.passing(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the least id."""
    return exact_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id."""
    return jaccard_join.without_near_copies(docs, NEAR_COPIES)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has."""
    return substring_dedup.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their sequence and place."""
    return packing.pack(packing.token_pieces(docs, vocabulary()))


STAGES = [
    ("quality rules", rules_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("substring dedup", substring_stage),
    ("packing", packing_stage),
]

# Components of a similarity graph and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
