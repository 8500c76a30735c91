"""Ordered computation that never needs one key in one task.

A station may hold a third of all rows, so no window here is partitioned by the
key alone.  Row order is numbered per (key, time block) and stitched together
from block counts; row windows then run over (key, chunk of row numbers) with
copies of the neighbouring rows each window reaches, and range windows over
(key, time chunk) with copies of the neighbouring span.  Results are those of the
plain window, since every owned row sees all rows its frame covers.

A NULL key is a key like any other and rows without a time form a block of their
own, first in order, as in a plain window: whatever is stitched together meets on
null-safe equality (``meet``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.functions.clock import epoch
from airq.operators.dims import pair_with, row_hash

BLOCK_SECONDS = 7 * 86400
CHUNK_ROWS = 4096


def meet(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name where NULL equals NULL; the columns are kept once."""
    other = right.withColumnsRenamed({k: f"_m_{k}" for k in on})
    equal = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in on]
    joined = left.join(other, reduce(lambda a, b: a & b, equal), how) if on else pair_with(left, other)
    return joined.drop(*[f"_m_{k}" for k in on])


def _keys(keys: list[str]) -> list[Column]:
    return [F.col(k) for k in keys] or [F.lit(0)]


def with_block(df: DataFrame, time: str, seconds: int = BLOCK_SECONDS) -> DataFrame:
    return df.withColumn("_block", F.floor(epoch(F.col(time)) / F.lit(seconds)))


def number_rows(df: DataFrame, keys: list[str], time: str, tie: list[str] | None = None,
                seconds: int = BLOCK_SECONDS, block: Column | None = None) -> DataFrame:
    """Add ``seq`` (1-based row number by time within the keys) and ``total``.

    ``block`` replaces the time block where the order column is not a time; it must
    never decrease along the order.
    """
    df = df.drop("seq", "total")
    if not keys and block is None:
        return _number_all(df, time, tie)
    blocked = with_block(df, time, seconds) if block is None else df.withColumn("_block", block)
    counts = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(*_keys(keys))
    offsets = counts.select(
        *keys, "_block",
        F.coalesce(F.sum("_n").over(whole.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias("total"),
    )
    inside = W.partitionBy(*keys, "_block").orderBy(time, *(tie or []))
    joined = meet(blocked.withColumn("_rn", F.row_number().over(inside)), offsets, [*keys, "_block"])
    return joined.withColumn("seq", F.col("_off") + F.col("_rn")).drop("_block", "_rn", "_off")


def _number_all(df: DataFrame, time: str, tie: list[str] | None) -> DataFrame:
    """Row numbers over the whole table by (time, tie).

    Rows are numbered within (exact time, slice of the tie column), so even an instant
    shared by a large part of the table is spread; slices are counted first and their
    offsets summed within the hour and then over hours.  Without a tie a hash of the
    row decides.
    """
    tie_cols = [F.col(c) for c in tie or []]
    whole_number = bool(tie) and df.schema[tie[0]].dataType.typeName() in ("long", "integer", "short", "byte")
    first = tie_cols[0].cast("bigint") if whole_number else row_hash(df)
    width = 2**16 if whole_number else 2**50
    us = F.unix_micros(F.col(time).cast("timestamp"))
    d = df.withColumns({"_us": us, "_first": first}).withColumn("_slice", F.floor(F.col("_first") / F.lit(float(width))))
    counts = d.groupBy(F.floor(F.col("_us") / F.lit(3_600_000_000)).alias("_hour"), "_us", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    hours = counts.groupBy("_hour").agg(F.sum("_n").alias("_h"))
    # one row per hour of the series from here to the join
    one = W.partitionBy(F.lit(0))
    starts = hours.select(
        "_hour", F.coalesce(F.sum("_h").over(one.orderBy("_hour").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_h").over(one).alias("total"))
    inside = W.partitionBy("_hour").orderBy("_us", "_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = meet(counts.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))), starts, ["_hour"]).select(
        "_us", "_slice", (F.col("_start") + F.col("_in")).alias("_off"), "total")
    w = W.partitionBy("_us", "_slice").orderBy("_first", *tie_cols)
    numbered = meet(d.withColumn("_rn", F.row_number().over(w)), offsets, ["_us", "_slice"])
    return numbered.withColumn("seq", F.col("_off") + F.col("_rn")).drop("_us", "_first", "_slice", "_rn", "_off")


def row_windows(df: DataFrame, keys: list[str], before: int, after: int,
                build: Callable[[W], dict[str, Column]], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Columns over row frames of a numbered frame, reaching ``before``/``after`` rows.

    A chunk is at least as long as the reach, so a row is copied to two more at most.
    """
    chunk_rows = max(chunk_rows, before, after)
    pos = F.col("seq") - 1
    own = F.floor(pos / F.lit(chunk_rows))
    reach = [own]
    if before:
        reach.append(F.floor((pos + before) / F.lit(chunk_rows)))
    if after:
        reach.append(F.floor((pos - after) / F.lit(chunk_rows)))
    spread = df.withColumn("_own", own).withColumn("_chunk", F.explode(F.array_distinct(F.array(*reach))))
    w = W.partitionBy(*keys, "_chunk").orderBy("seq")
    return spread.withColumns(build(w)).filter(F.col("_chunk") == F.col("_own")).drop("_own", "_chunk")


def time_windows(df: DataFrame, keys: list[str], time: str, before: int, after: int,
                 build: Callable[[W], dict[str, Column]], seconds: int = 7 * 86400) -> DataFrame:
    """Columns over range frames in seconds, reaching ``before``/``after`` seconds.

    ``build`` gets a window ordered by the long column ``_t``; a chunk is at least as
    long as the reach.
    """
    seconds = max(seconds, before, after)
    t = F.col("_t")
    own = F.floor(t / F.lit(seconds))
    reach = [own]
    if before:
        reach.append(F.floor((t + before) / F.lit(seconds)))
    if after:
        reach.append(F.floor((t - after) / F.lit(seconds)))
    spread = (
        df.withColumn("_t", epoch(F.col(time)))
        .withColumn("_own", own)
        .withColumn("_chunk", F.explode(F.array_distinct(F.array(*reach))))
    )
    w = W.partitionBy(*keys, "_chunk").orderBy("_t")
    return spread.withColumns(build(w)).filter(F.col("_chunk").eqNullSafe(F.col("_own"))).drop("_t", "_own", "_chunk")


def running_sums(df: DataFrame, keys: list[str], time: str, sums: dict[str, str],
                 tie: list[str] | None = None, seconds: int = BLOCK_SECONDS, block: Column | None = None) -> DataFrame:
    """Inclusive cumulative sums by time within the keys; ``sums`` maps new column to summed column."""
    blocked = with_block(df, time, seconds) if block is None else df.withColumn("_block", block)
    per = blocked.groupBy(*keys, "_block").agg(*[F.sum(v).alias(f"_s_{o}") for o, v in sums.items()])
    before = W.partitionBy(*_keys(keys)).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carry = per.select(*keys, "_block", *[
        F.coalesce(F.sum(f"_s_{o}").over(before), F.lit(0)).alias(f"_c_{o}") for o in sums
    ])
    inside = W.partitionBy(*keys, "_block").orderBy(time, *(tie or [])).rowsBetween(W.unboundedPreceding, 0)
    local = blocked.withColumns({f"_i_{o}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for o, v in sums.items()})
    out = {o: F.col(f"_c_{o}") + F.col(f"_i_{o}") for o in sums}
    return meet(local, carry, [*keys, "_block"]).withColumns(out).drop(
        "_block", *[f"_{k}_{o}" for o in sums for k in "ic"])


def fill_missing(df: DataFrame, keys: list[str], time: str, cols: list[str], forward: bool = True,
                 tie: list[str] | None = None, seconds: int = BLOCK_SECONDS, suffix: str = "") -> DataFrame:
    """Carry the last (``forward``) or next non-null value of each column."""
    blocked = with_block(df, time, seconds)
    order = [F.col(time), *[F.col(x) for x in tie or []]]
    if not forward:
        order = [c.desc() for c in order]
    pick = F.max if forward else F.min
    tag = F.struct(F.col(time), *[F.col(x) for x in tie or []])
    ends = blocked.groupBy(*keys, "_block").agg(*[
        pick(F.when(F.col(c).isNotNull(), F.struct(tag.alias("o"), F.col(c).alias("v"))))["v"].alias(f"_e_{c}")
        for c in cols
    ])
    side = F.col("_block") if forward else F.col("_block").desc()
    prior = W.partitionBy(*_keys(keys)).orderBy(side).rowsBetween(W.unboundedPreceding, -1)
    carry = ends.select(*keys, "_block", *[
        F.last(f"_e_{c}", ignorenulls=True).over(prior).alias(f"_c_{c}") for c in cols
    ])
    inside = W.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inner = blocked.withColumns({f"_i_{c}": F.last(c, ignorenulls=True).over(inside) for c in cols})
    joined = meet(inner, carry, [*keys, "_block"])
    out = {f"{c}{suffix}": F.coalesce(F.col(f"_i_{c}"), F.col(f"_c_{c}")) for c in cols}
    return joined.withColumns(out).drop("_block", *[f"_{k}_{c}" for c in cols for k in "ic"])


def latest(df: DataFrame, keys: list[str], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """The last row per key by ``order``: an aggregate, so each map task sends one row per key."""
    rest = keep or [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                          F.struct(*rest).alias("r"))).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, "_b.r.*")


def earliest(df: DataFrame, keys: list[str], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """The first row per key by ``order``."""
    rest = keep or [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                          F.struct(*rest).alias("r"))).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, "_b.r.*")
