"""Corpus pipeline: five stages from raw documents to packed token sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundspark.llm import jaccard_join, mixing, packing, pii, quality
from fundspark.llm.shared import materialise

# Options of mixing.mix_sources (weights, block_chars, period). The packing stage works the mixture
# out again from them, as a Parquet table read again does not promise the order of its rows.
MIX: dict = {}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted, rejected = (labels.where(f"quality = {q}").select("doc_id") for q in (1, 0))
    return quality.keep_good(docs, trusted, rejected=rejected)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of five-word-shingle similarity 0.8."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the text by the name of its kind; n_chars follows the new text."""
    return pii.redact(docs, length="n_chars")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, ordered so that the sources interleave at their target weights."""
    return mixing.interleave(docs, **MIX)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of at most 2048 ids, numbered along the mixture."""
    return packing.pack_documents(docs, mix=MIX)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # similarity joins over whole texts, tokens and packing are beyond SQL here


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage's result being written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
