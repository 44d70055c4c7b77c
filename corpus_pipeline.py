"""The training-data pipeline over documents: quality rules, toxicity, near duplicates, packing.

Each stage takes what its predecessor kept and returns the columns of documents
for the rows that it keeps; the last one returns the packed pieces. Texts stay
as they are, so pieces can be traced to their documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapwatch.llm import neardup, quality
from gapwatch.llm.common import written
from gapwatch.llm.queries import packed_sequences, scored_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep."""
    return quality.kept_documents(docs).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return scored_toxicity(spark, docs, sf_dir).filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near duplicates; only rows that repeat id and text count as one."""
    return neardup.one_per_group(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences of at most 2048 tokens."""
    return packed_sequences(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]
#: The lexicon, MinHash and token packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
