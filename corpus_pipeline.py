"""A corpus from raw documents to packed sequences, one stage after the other.

Quality trees reject poor documents, the toxicity grammar toxic ones, MinHash keeps one of
every group of near-duplicates, decontamination drops documents with benchmark items, and
best-fit packing lays what is left out in sequences. Each stage works on all that the stage
before has kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickwarden.llm import decontamination, minhash, packing, quality, toxicity
from clickwarden.llm.common import read_table, spill


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, read_table(spark, sf_dir, "labels"), 0.3)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels"), 0.5)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.first_of_groups(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# trained models and the tokenizer can't be written as SQL; tests/llm checks run() by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage is stored before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spill(stage(spark, docs, sf_dir), f"corpus_{name}")
    return docs
