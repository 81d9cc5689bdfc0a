"""A training-corpus pipeline: every stage works on what the one before it kept.

Quality, exact duplicates, near duplicates, mixture, packing. Stages take (spark, docs, sf_dir);
all but the last return the columns of documents. What a stage returns is written to the shared
folder and read again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import exact_dedup, mixing, packing, quality, shingle_join
from quarry.llm.common import table
from quarry.scale import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.passed(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts, the one with the smallest id."""
    return exact_dedup.unique(docs, exact_dedup.newer_half(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of similar ones, the one with the smallest id."""
    return shingle_join.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", exact_duplicates),
    ("shingle_join", near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]

# Training, sampling and tokenising have no SQL form; tests compare columns and counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
