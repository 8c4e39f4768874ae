"""The corpus pipeline: quality rules, exact, near and substring de-duplication, packing.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finlake.llm import exact_dedup, near_dedup, packing, passages, quality_rules
from finlake.llm.common import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.drop_near_duplicates(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    return passages.drop_passages(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in training sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("substring_dedup", substring),
          ("packing", pack)]

# Alignments, BPE ids and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
