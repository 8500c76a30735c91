"""Inputs, scratch tables and numbering shared by the operators of this subpackage.

Operators take any frame with ``doc_id`` and ``text``; further columns, whatever
their names, are left out before anything is computed, so none can clash.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airq.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; NULL counts as empty. Texts of ASCII only take the faster built-in."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32(doc_id as text) mod 4 is 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession):
    """Written tables below the shared folder that last as long as the block.

    ``keep(df, label)`` writes a frame and reads it back, which cuts lineage
    with files that outlive any executor.
    """
    made: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        made.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        for path in made:
            drop_path(spark, path)


def kept_table(df: DataFrame, label: str) -> DataFrame:
    """A written table that stays for the caller, for inputs that a returned frame still reads."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def number(df: DataFrame, group: list[str], order: str, total: int, name: str, block_rows: int = 50_000) -> DataFrame:
    """Adds ``name``: positions from 0 without gaps within each group.

    Rows are spread over hash blocks of about ``block_rows`` rows each, so that a
    group of any size is numbered by many tasks; the order is by block, then ``order``.
    """
    blocks = max(1, -(-total // block_rows))
    df = df.withColumn("_block", F.pmod(F.xxhash64(order), F.lit(blocks)))
    inside = Window.partitionBy(*group, "_block").orderBy(order)
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = df.withColumn("_r", F.row_number().over(inside) - 1)
    on = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)] + [F.col("_block") == F.col("_b")]
    return ranked.join(starts, on, "left").withColumn(name, (F.col("_start") + F.col("_r")).cast("long")).drop("_block", "_b", "_r", "_start", *[f"_g{i}" for i in range(len(group))])
