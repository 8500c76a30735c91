"""Connected components of an edge table, by rounds of star joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _towards_minimum(edges: DataFrame, larger: bool) -> DataFrame:
    """Links of each node's neighbours (those above it, or it and those below) to the least node it sees."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).withColumn("m", F.least("w", "m"))
    met = both.join(least, F.col("u") == F.col("w"))
    out = met.filter("v > u" if larger else "v < u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not larger:
        out = out.union(least.select(F.col("w"), F.col("m")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, keep, label: str = "stars") -> DataFrame:
    """``node, component`` (its least node) for every node of ``edges`` (columns ``a, b``) but each component's least.

    ``keep(df, label)`` writes a table. Neighbours above a node are linked to the least it sees, then
    those below; rounds end when the table stays the same, after about log of the longest chain.
    """
    cur = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    mark = None
    while True:
        cur = keep(_towards_minimum(_towards_minimum(cur, True), False), label)
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = now
