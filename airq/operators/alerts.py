"""Exceedance events and alert debouncing over history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions.classes import flag
from airq.functions.clock import epoch
from airq.operators.ordering import BLOCK_SECONDS, number_rows, row_windows, running_sums, with_block
from airq.session import materialize

TIERS = [("watch", C.WATCH_PPB), ("critical", C.CRITICAL_PPB)]


def exceedances(readings: DataFrame, h2s: str = "h2s", tiers=TIERS) -> DataFrame:
    """One row per reading and tier it reaches."""
    arr = F.array(*[F.struct(F.lit(n).alias("tier"), F.lit(t).alias("threshold")) for n, t in tiers])
    return readings.select("*", F.inline(arr)).filter(F.col(h2s) >= F.col("threshold"))


def exceedance_events(readings: DataFrame, keys: list[str], as_of=None, time: str = "obs_time", h2s: str = "h2s",
                      tiers=TIERS, quiet_h: float = C.QUIET_HOURS, close_h: float = C.CLOSE_WAIT_HOURS) -> DataFrame:
    """Events per station and tier.

    An exceedance opens an event when the ``quiet_h`` hours before it are free of
    others.  The event closes ``close_h`` hours after its last exceedance; later ones
    that find no quiet spell belong to no event.
    """
    k = [*keys, "tier"]
    # the passes below read this few-percent subset several times
    up = materialize(exceedances(readings, h2s, tiers), "exceedances")
    gap = row_windows(number_rows(up, k, time), k, 1, 0, lambda w: {
        "_gap": epoch(F.col(time)) - epoch(F.lag(time).over(w))})
    marked = gap.withColumns({
        "_onset": flag(F.col("_gap").isNull() | (F.col("_gap") > quiet_h * 3600)),
        "_break": flag((F.col("_gap") > close_h * 3600) & (F.col("_gap") <= quiet_h * 3600)),
    })
    runs = running_sums(marked, k, time, {"event_no": "_onset", "_breaks": "_break"})
    rad = F.radians("wind_direction_10m") if "wind_direction_10m" in readings.columns else None
    aggs = [
        F.min(time).alias("event_start"), F.max(time).alias("last_exceedance"), F.count(F.lit(1)).alias("n"),
        F.max(h2s).alias("peak"), F.max(F.struct(F.col(h2s), -epoch(F.col(time)), F.col(time)))[time].alias("peak_time"),
        F.avg(h2s).alias("mean_h2s"), F.max("_onset").alias("_opened"),
        *[F.sum(flag(F.col(h2s) >= t)).alias(f"n_{n}") for n, t in tiers],
    ]
    if rad is not None:
        aggs.append(F.pmod(F.degrees(F.atan2(F.avg(F.sin(rad)), F.avg(F.cos(rad)))), F.lit(360.0)).alias("mean_direction"))
    ev = runs.groupBy(*k, "event_no", "_breaks").agg(*aggs).filter("_opened = 1").drop("_opened", "_breaks")
    if as_of is not None:
        end = F.col("last_exceedance") + F.expr(f"INTERVAL {int(close_h * 60)} MINUTES")
        ev = ev.withColumn("closed", end <= as_of)
    return ev


def scan_cells(records: DataFrame, keys: list[str], time: str = "evaluated_at", clear_below: float = 0.3, clears: int = 3,
               seconds: int = BLOCK_SECONDS, block: str | None = None) -> DataFrame:
    """Add the state of an alert cell after each cycle (``last_fire``, ``clear_cycles``, ``active``) and before it (``was_active``, ``was_last``).

    A cell's state is its last fire and the clear cycles since. What a block of its history does to the state
    is one of two maps: with a fire it ends in (that fire, the clears after it) whatever came
    before; without one it adds its clears. Such maps compose, so the rows of a block are packed into one row with the block's map, the maps of
    a key's blocks are composed over these rows, and each row combines its own part with what
    its block started from. The history is computed once: a second reading of it, for the maps alone, would not share its exchange.
    ``block`` names a column that holds the block already, such as one by which the records are partitioned.
    """
    fired, calm = F.col("fired"), ~F.col("fired") & (F.col("score") < clear_below)
    d = with_block(records, time, seconds) if block is None else records.withColumn("_block", F.col(block))
    rest = [c for c in records.columns if c not in [*keys, time, block]]
    # of a block: its last fire, its clears and, if it has a fire, those after the last one
    maps = d.groupBy(*keys, "_block").agg(
        F.sort_array(F.collect_list(F.struct(time, *rest))).alias("_h"), F.max(F.when(fired, F.col(time))).alias("_last"),
        F.sum(flag(calm)).alias("_clears"), F.max("fired").alias("_any"))
    later = F.aggregate("_h", F.lit(0), lambda n, x: F.when(x["fired"], 0).otherwise(n + flag(~x["fired"] & (x["score"] < clear_below))))
    maps = maps.withColumn("_after", F.when(F.col("_any"), later))
    of = W.partitionBy(*keys).orderBy("_block")
    earlier = of.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("_clears").over(of.rowsBetween(W.unboundedPreceding, 0))
    maps = maps.withColumn("_t", total).withColumn("_fire", F.col("_t") - F.col("_after"))
    starts = maps.select(*keys, "_block", "_h", F.max("_last").over(earlier).alias("_l0"), (F.max("_t").over(earlier) - F.last("_fire", ignorenulls=True).over(earlier)).alias("_c0"))
    d = starts.select(*keys, "_block", *([F.col("_block").alias(block)] if block else []), "_l0", "_c0", F.inline("_h"))
    # the rows of a block are where its key is: no exchange from here on
    w = W.partitionBy(*keys, "_block").orderBy(time)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumns({"_l": F.max(F.when(fired, F.col(time))).over(upto), "_s": F.coalesce(F.sum(flag(calm)).over(upto), F.lit(0))})
    # clears of the block at its last fire; without one, None
    d = d.withColumn("_at", F.max(F.when(fired, F.col("_s"))).over(upto))
    d = d.withColumns({"_was": F.lag(F.struct("_l", "_s", "_at")).over(w)})

    def state(last, seen, at):
        """(last fire, clears since) of the block's start followed by a part of the block."""
        return F.coalesce(last, F.col("_l0")), F.when(at.isNotNull(), seen - at).otherwise(F.col("_c0") + F.coalesce(seen, F.lit(0)))

    last, since = state(F.col("_l"), F.col("_s"), F.col("_at"))
    before, before_since = state(F.col("_was._l"), F.col("_was._s"), F.col("_was._at"))
    return d.select(*records.columns, last.alias("last_fire"), F.when(last.isNull(), 0).otherwise(F.least(since, F.lit(clears))).alias("clear_cycles"),
                    (last.isNotNull() & (since < clears)).alias("active"), before.alias("was_last"), (before.isNotNull() & (before_since < clears)).alias("was_active"))


def debounce(records: DataFrame, keys: list[str], time: str = "evaluated_at", refire_h: float = C.QUIET_HOURS,
             clear_below: float = 0.3, clears: int = 3, block: str | None = None) -> DataFrame:
    """Alert cell history: ``active`` after each cycle, ``clear_cycles`` since the last
    fire, and ``send_onset`` where a fire opens the cell or follows ``refire_h`` of silence.

    A cycle that neither fires nor scores below ``clear_below`` changes nothing. ``block`` goes to ``scan_cells``.
    """
    d = scan_cells(records, keys, time, clear_below, clears, block=block)
    silent = epoch(F.col(time)) - epoch(F.col("was_last")) >= refire_h * 3600
    onset = F.col("fired") & (~F.col("was_active") | F.coalesce(silent, F.lit(True)))
    return d.withColumn("send_onset", onset).drop("last_fire", "was_last", "was_active")
