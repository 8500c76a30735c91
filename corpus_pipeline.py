"""A training corpus from raw documents: ``STAGES`` in order, each written as Parquet before the next reads it.

Every row is a document of its own. Rows that share a ``doc_id`` (NULL is one such id) are told apart by a row
number in the order of (doc_id, text), under which the operators see them; so each row is kept,
cut or dropped for its own text, and of rows with equal id and text exact dedup keeps one. All columns of
``documents`` are passed on as they are, but for the text (and ``n_chars``) of documents that lose a
repeated passage; a document of which nothing else is left stays with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.llm import exact_dedup, near_dedup, packing, quality_rules, substring_dedup
from airq.llm.tables import kept_table, table


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``: the doc_id where no two rows share one, else a number that follows the order of (doc_id, text)."""
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        return docs.withColumn("_row", F.col("doc_id").cast("long"))
    # numbers of a sorted table rise from partition to partition; written, they stay what they are
    return kept_table(docs.orderBy("doc_id", F.sha2("text", 256)).withColumn("_row", F.monotonically_increasing_id()), "numbered")


def _seen(rows: DataFrame) -> DataFrame:
    """What the operators read: the row number as doc_id."""
    return rows.select(F.col("_row").alias("doc_id"), "text")


def _stay(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows that are kept, without their number."""
    ids = decisions.filter("kept").select(F.col("doc_id").alias("_kept_id"))
    return rows.join(ids, rows["_row"] == ids["_kept_id"], "left_semi").drop("_row")


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs proven together. A label holds for all rows of its doc_id."""
    rows, labels = _numbered(docs), table(spark, sf_dir, "labels")
    own = rows.filter(~F.col("_row").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("_id"), "_row")
    if not own.isEmpty():  # labels under the rows' numbers
        own = rows.select(F.col("doc_id").cast("long").alias("_id"), "_row")
        labels = labels.join(own, labels["doc_id"].cast("long") == own["_id"]).withColumn("doc_id", F.col("_row")).select(*labels.columns)
    return _stay(rows, quality_rules.judge(_seen(rows), labels))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    rows = _numbered(docs)
    return _stay(rows, exact_dedup.exact_groups(_seen(rows)))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one with the least id."""
    rows = _numbered(docs)
    return _stay(rows, near_dedup.near_groups(_seen(rows), 5, 80, 100))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the document with the least id and are cut from the others."""
    rows = _numbered(docs)
    cut = substring_dedup.cut_repeats(_seen(rows)).select(F.col("doc_id").alias("_cut_id"), F.col("text").alias("_cut_text"))
    hit = F.col("_cut_id").isNotNull()
    new = {"text": F.when(hit, F.col("_cut_text")).otherwise(F.col("text")), "n_chars": F.when(hit, F.length("_cut_text").cast("long")).otherwise(F.col("n_chars"))}
    return rows.join(cut, rows["_row"] == cut["_cut_id"], "left").withColumns({k: v for k, v in new.items() if k in docs.columns}).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as sequences of at most 1024 token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", reject_low_quality),
    ("exact dedup", keep_one_copy),
    ("near dedup", keep_one_of_each_group),
    ("substring dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: Near duplicates and token ids have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
