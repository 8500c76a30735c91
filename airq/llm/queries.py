"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airq.llm import alignment, binary_output, bpe, embedding_dedup, exact_dedup, hard_negatives, language_id, near_dedup, packing, quality_classifier, quality_rules, sharding, substring_dedup
from airq.llm.tables import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op5_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_output.encode_to_files(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_language_id, op3_exact_dedup, op4_near_dedup, op5_binary_output, op6_sharding, op7_byte_bpe, op8_substring_dedup, op9_quality_rules, op10_quality_classifier,
        op11_alignment, op12_hard_negatives, op13_embedding_dedup,
    )
}
SQL = {"op3_exact_dedup": exact_dedup.ORACLE, "op9_quality_rules": quality_rules.oracle(), "op12_hard_negatives": hard_negatives.ORACLE, "op13_embedding_dedup": embedding_dedup.ORACLE}
