"""From raw documents to packed training sequences, stage by stage.

Every stage reads what its predecessor wrote and works on all of it. All but the last return the
columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard_join, line_dedup, mixing, quality_rules
from millrace.llm.common import kept, table
from millrace.llm.queries import packed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality_rules.filter_by_rules(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that others repeat; those with nothing left go."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of five-word shingles with a similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, percent=80, words=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that follows the target weights."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, their sequence and their place in it."""
    return packed(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: SQL has neither zstandard nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), "stage")
    return docs
