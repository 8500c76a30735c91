"""Exact duplicates by recipes of content-defined chunks, in DataFrame functions only.

A text is cut where its content says so (a line or sentence end after at least
``MIN`` characters, or ``MAX`` characters), so a text's recipe depends on the text
alone. Long texts move once, as distinct chunks, and meet again only as lists of
64-bit identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.llm.tables import kept_table, lower_ascii, scratch

MIN, MAX = 512, 4096


def chunks(text: Column, least: int = MIN, most: int = MAX) -> Column:
    """The text in pieces, in order; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{least},{most - 1}}}?[\\n.]|.{{1,{most}}}"), F.lit(0))


def ambiguous_identifiers(docs: DataFrame, text: Column, identify=F.xxhash64) -> DataFrame:
    """Identifiers that stand for more than one distinct chunk: one row ``id`` each.

    Chunk contents are reduced map-side and shuffled once; equal identifiers are
    verified by comparing the contents themselves.
    """
    c = docs.select(F.explode(chunks(text)).alias("chunk")).select(identify("chunk").alias("id"), "chunk").distinct()
    return c.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")


def exact_groups(docs: DataFrame, identify=F.xxhash64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty, so
    NULL and empty texts form one group. The largest ``doc_id`` of a group stays;
    repeated rows with one ``doc_id`` count in ``group_size`` and share the decision.
    A group whose ids are all NULL keeps NULL. An empty table gives no rows. A document
    that holds an identifier of two different chunks is also compared by its SHA-256.
    """
    base = docs.select("doc_id", lower_ascii(F.col("text")).alias("norm"))
    recipe = base.select("doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), F.transform(chunks(F.col("norm")), lambda c: identify(c)).alias("recipe"))
    recipe = kept_table(recipe, "recipes")
    with scratch(docs.sparkSession) as keep:
        unsure = keep(ambiguous_identifiers(base, F.col("norm"), identify), "ambiguous")
        some = not unsure.isEmpty()
        if some:
            hit = recipe.select("doc_id", F.explode("recipe").alias("id")).join(unsure, "id").select(F.col("doc_id").alias("_d")).distinct()
            recipe = kept_table(
                recipe.join(hit, F.col("doc_id").eqNullSafe(F.col("_d")), "left").withColumn("tie", F.when(F.col("_d").isNotNull(), F.col("text_sha256"))).drop("_d"), "recipes"
            )
        else:
            recipe = recipe.withColumn("tie", F.lit(None).cast("string"))
    groups = recipe.groupBy(F.col("recipe").alias("_recipe"), F.col("tie").alias("_tie")).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    same = (F.col("recipe") == F.col("_recipe")) & F.col("tie").eqNullSafe(F.col("_tie"))
    return recipe.join(groups, same).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256 FROM d JOIN g USING (norm)
"""
