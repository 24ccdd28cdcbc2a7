"""Corpus pipeline: quality classifier, exact dedup, near dedup, source mixing, tokenizing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet in the shared folder of spark.checkpoint.dir and rereads it as the
next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm.common import table
from contrail.llm.exact_dedup import kept_documents
from contrail.llm.mixing import repeat_documents
from contrail.llm.near_dedup import keep_one
from contrail.llm.quality import keep_good
from contrail.llm.tokenize import tokenize
from contrail.session import intermediates, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8)."""
    return keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated to equal weights, as many characters as before; copies are rows of their own, globally shuffled."""
    return repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return tokenize(docs, keep=("doc_id", "lang", "source"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("tokenize", tokens)]
#: Trained trees and hashed similarity search have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with intermediates(spark):  # what the stage wrote on its way goes when its result is written
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
