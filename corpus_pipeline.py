"""The corpus pipeline: documents to training sequences in five stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import mixing, packing, pii, quality_rules, simhash
from shelfwise.llm.queries import tokenizer_file
from shelfwise.session import ensure_checkpoint_dir


def stage_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.clean_documents(docs)


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.without_near_duplicates(docs)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and the terms that disclose it."""
    return pii.sanitised_documents(docs, length_col="n_chars")


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often, and as far, as their source's share wants."""
    return mixing.mixed_documents(docs, length_col="n_chars")


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the pieces of every document."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality rules", stage_quality_rules),
    ("simhash near-dedup", stage_simhash),
    ("pii", stage_pii),
    ("mixing", stage_mixing),
    ("packing", stage_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
