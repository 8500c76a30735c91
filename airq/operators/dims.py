"""Pairing rows with a dimension table without a cross join.

Each row draws a salt, the table is copied once per salt and both meet on it: a single
copy of a table that Spark broadcasts by its estimated size, else one per task. Whether
a copy is broadcast or shuffled is left to Spark; values are the same either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType


def _tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def planned_bytes(df: DataFrame) -> int:
    """The planner's own estimate of a table's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _small(dim: DataFrame) -> bool:
    """Is the table, by the planner's own estimate, one that it broadcasts."""
    return planned_bytes(dim) <= dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def parts_for(df: DataFrame, each: int) -> int:
    """Tasks for a step whose rows open into many: one per ``each`` planned bytes of ``df``, and no fewer than the usual number.

    A size that the planner doesn't know counts as none.
    """
    size = planned_bytes(df)
    return max(_tasks(df), -(-size // each) if size < 1 << 50 else 0)


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's plain columns, the same on every attempt; maps and nested columns are left out."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain]) if plain else F.lit(0).cast("long")


def pair_with(df: DataFrame, dim: DataFrame, salts: int | None = None) -> DataFrame:
    """Every row of ``df`` with every row of ``dim``.

    A table that is broadcast anyway is copied once. Of any other there is a copy per task, and each
    row draws one by its hash.
    """
    salts = salts or (1 if _small(dim) else _tasks(df))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    first = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)][:1]
    own = row_hash(df.select(*[F.col(f"`{c}`") for c in first])) if salts == 1 else row_hash(df)
    return df.withColumn("_salt", F.pmod(own, F.lit(salts)).cast("int")).join(copies, "_salt").drop("_salt")


def as_array(dim: DataFrame, name: str) -> DataFrame:
    """One row with the table's rows as an array of structs, in the order of its columns."""
    return dim.agg(F.array_sort(F.collect_list(F.struct("*"))).alias(name))


def spread(df: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Hash rows by ``keys`` over a fixed number of tasks.

    For steps whose work is far larger than their input bytes, which adaptive
    coalescing would otherwise pack into a few tasks.  Aggregations by a superset of
    ``keys`` then need no further exchange.
    """
    return df.repartition(parts or _tasks(df), *keys)
