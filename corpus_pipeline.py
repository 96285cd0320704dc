"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir), docs being what its predecessor kept,
and works on all of it. All but the last return rows with the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxelforge.llm import exact_dedup, mixing, near_dedup, packing, quality
from voxelforge.session import discard, stored, table

#: Near-duplicates: words in a shingle and percent of similarity.
WORDS, PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return near_dedup.drop_near(docs, WORDS, PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.take(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, with their ids."""
    return packing.pack(docs, specials=True)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near-dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: Robust estimates, hashed buckets, balanced sampling and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over documents; what a stage keeps is written as Parquet in the shared folder
    before the next reads it, and removed when the one after that has been written."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        kept = stored(stage(spark, docs, sf_dir))
        if i:
            discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
