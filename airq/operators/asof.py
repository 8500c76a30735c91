"""Nearest-in-time join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.operators.ordering import earliest


def nearest_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
                 right_cols: list[str], tolerance: int, right_tie: list[str] | None = None,
                 seconds: int = 86400) -> DataFrame:
    """Each left row with the nearest right row of its keys within ``tolerance`` seconds.

    A tie in distance goes to the earlier right row; left rows without a match
    are dropped and none is repeated; a NULL key matches a NULL key, a NULL time nothing.
    Both sides are laid on one time line per
    (key, time chunk), right rows copied across a chunk edge they are near to, so
    no pairs are formed.
    """
    micros = tolerance * 1_000_000
    span = max(seconds * 1_000_000, micros)
    one = earliest(right.select(*keys, right_time, *right_cols, *(right_tie or [])), [*keys, right_time],
                   right_tie or [right_cols[0]], keep=right_cols)

    def us(c):
        return F.unix_micros(F.col(c).cast("timestamp"))

    chunk = lambda x: F.floor(x / F.lit(span))
    l = left.select(*keys, us(left_time).alias("_t"), F.struct(*left.columns).alias("_l"))
    l = l.withColumn("_chunk", chunk(F.col("_t"))).withColumn("_r", F.lit(None))
    r = one.select(*keys, us(right_time).alias("_t"),
                   F.struct(us(right_time).alias("_rt"), F.col(right_time), *right_cols).alias("_r"))
    r = r.withColumn("_chunk", F.explode(F.array_distinct(F.array(
        chunk(F.col("_t")), chunk(F.col("_t") - micros), chunk(F.col("_t") + micros)
    ))))
    line = l.unionByName(r.withColumn("_l", F.lit(None)))
    # both frames grow row by row; one that ends at the last row would be read anew for every row
    side = W.partitionBy(*keys, "_chunk")
    seen = line.withColumns({
        "_p": F.last("_r", ignorenulls=True).over(side.orderBy("_t").rangeBetween(W.unboundedPreceding, 0)),
        "_n": F.last("_r", ignorenulls=True).over(side.orderBy(F.desc("_t")).rangeBetween(W.unboundedPreceding, 0)),
    }).filter(F.col("_l").isNotNull())
    dp = F.col("_t") - F.col("_p._rt")
    dn = F.col("_n._rt") - F.col("_t")
    best = F.when(dn.isNull() | (dp <= dn), F.col("_p")).otherwise(F.col("_n"))
    out = seen.withColumn("_m", best).filter(F.abs(F.col("_m._rt") - F.col("_t")) <= micros)
    return out.select("_l.*", *[F.col(f"_m.{c}").alias(c) for c in (right_time, *right_cols)
                                if c not in left.columns])
