"""Queries of this subpackage: opN_<name> over the whole of its table, and the oracle SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.ann import nearest
from contrail.llm.chat import digests, format_chat, text_parts
from contrail.llm.collocations import collocations
from contrail.llm.common import table
from contrail.llm.exact_dedup import exact_dedup
from contrail.llm.licenses import license_scan
from contrail.llm.mixing import mix_sources
from contrail.llm.near_dedup import near_dedup
from contrail.llm.oracle import ORACLE
from contrail.llm.quality import score_documents
from contrail.llm.secrets import secret_scan
from contrail.llm.spelling import spelling_variants
from contrail.llm.substring_dedup import substring_dedup
from contrail.llm.suffix_dedup import suffix_dedup
from contrail.llm.tokenize import tokenize


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal weights over all sources, as many characters as the input; texts travel with their copies."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "text", "n_copies", "copy", "shuffle_key")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.85."""
    found = near_dedup(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose two texts hold control strings of the template."""
    more = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast("int").alias("turn"), F.lit(role).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text")) for turn, role in enumerate(("user", "assistant"))])))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return digests(format_chat(text_parts(rows)))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mixing, op2_substring_dedup, op3_nearest_neighbours, op4_quality_classifier, op5_license_scan,
        op6_suffix_array_dedup, op7_exact_dedup, op8_sentencepiece, op9_secret_scan, op10_near_dedup, op11_spelling_variants, op12_chat_format,
        op13_collocations)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
