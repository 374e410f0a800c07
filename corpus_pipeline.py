"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all the stage before it kept; its result is written
as Parquet and read again as the next one's documents. All but the last return the columns of
``documents``. The stages call the operators of ``hazardgrid.llm`` and follow their rules for nulls, empty
and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardgrid.llm.best_fit_packing import best_fit_packing
from hazardgrid.llm.chunk_dedup import without_copies
from hazardgrid.llm.common import saved, table
from hazardgrid.llm.mixing import mixed_documents
from hazardgrid.llm.quality_knn import good_documents
from hazardgrid.llm.queries import tokenizer
from hazardgrid.llm.simhash_dedup import without_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote finds good."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document."""
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return best_fit_packing(docs, tokenizer())


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: The vote and the fingerprints are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
