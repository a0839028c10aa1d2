"""From documents to packed training sequences: quality, language, near duplicates, packing.

Every stage takes (spark, docs, sf_dir), works on all documents the one before kept and returns the
columns of `documents`; the last returns the packed pieces. Rejected documents are gone for good.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from worklink.llm import jaccard, language, packing, quality
from worklink.llm.common import read_table, stored
from worklink.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model, fitted on `labels`, scores at least 0.7."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"), keep=0.7)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that resemble a language of the corpus as labelled documents do, but for their lowest hundredth."""
    return language.keep_known_languages(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of documents that share 0.8 of their five-word shingles."""
    return jaccard.keep_one_of_each(docs, words=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), size=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The learned stages cannot be said in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`, each written as a table and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
