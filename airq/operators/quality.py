"""Data quality, summaries and exploratory tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.operators.features import since_latest
from airq.operators.ordering import number_rows, row_windows
from airq.operators.ranks import medians, quantiles


def column_quality(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: rows, missing count and percent, minimum, maximum, mean — one pass."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max"), F.avg(c).alias(f"{c}__avg")]
    rows = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("present"), F.col(f"{c}__min").alias("min"),
        F.col(f"{c}__max").alias("max"), F.col(f"{c}__avg").alias("mean")) for c in cols])
    return df.agg(*aggs).select("n", F.inline(rows)).withColumns({
        "missing": F.col("n") - F.col("present"),
        "missing_pct": (F.col("n") - F.col("present")) * 100.0 / F.col("n"),
    })


def class_shares(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.withColumn("pct", F.col("n") * 100.0 / total.scalar())


def describe_training(df: DataFrame, h2s: str = "h2s", time: str = "obs_time") -> DataFrame:
    """One row of training metadata."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("first"), F.max(time).alias("last"),
        F.avg(h2s).alias("mean"), F.stddev_samp(h2s).alias("std"), F.min(h2s).alias("min"), F.max(h2s).alias("max"),
        F.count(h2s).alias("labelled"),
    )


def wind_bin_table(df: DataFrame, h2s: str = "h2s", wind: str = "wind_speed_10m") -> DataFrame:
    """Mean, median, maximum and count of h2s per metre-per-second bin, 5 and above together."""
    binned = df.filter(F.col(wind).isNotNull() & F.col(h2s).isNotNull()).withColumn(
        "wind_bin", F.least(F.floor(F.col(wind)), F.lit(5)))
    stats = binned.groupBy("wind_bin").agg(F.avg(h2s).alias("mean"), F.max(h2s).alias("max"), F.count(h2s).alias("n"))
    return stats.join(quantiles(binned, ["wind_bin"], h2s, {"median": 0.5}), "wind_bin")


def polar_bins(df: DataFrame, keys: list[str], hours: int = 12, dirs: int = 36, speeds: int = 10, cap: float = 15.0,
               h2s: str = "h2s", wind: str = "wind_speed_10m", direction: str = "wind_direction_10m") -> DataFrame:
    """Mean h2s per site, direction bin and speed bin over each site's last ``hours``."""
    recent = since_latest(df, f"{hours} HOURS", keys=keys)
    angle = F.pmod(F.radians(F.lit(90.0) - F.col(direction)), F.lit(2 * math.pi))
    d = F.least(F.floor(angle / (2 * math.pi / dirs)), F.lit(dirs - 1))
    ws = F.least(F.greatest(F.col(wind), F.lit(0.0)), F.lit(cap))
    s = F.least(F.floor(ws / (cap / speeds)), F.lit(speeds - 1))
    return (
        recent.filter(F.col(h2s).isNotNull() & F.col(wind).isNotNull())
        .groupBy(*keys, d.alias("dir_bin"), s.alias("speed_bin"))
        .agg(F.avg(h2s).alias("mean_h2s"), F.count(F.lit(1)).alias("n"))
    )


def daily_timeseries(df: DataFrame, h2s: str = "h2s", flow: str = "flow_border", time: str = "obs_time") -> DataFrame:
    """Per day: mean h2s over sites, mean flow, number of yellow and orange readings."""
    from airq.functions.classes import three_class

    c = three_class(F.col(h2s), "right")
    return df.groupBy(F.date_trunc("day", time).alias("day")).agg(
        F.avg(h2s).alias("mean_h2s"), F.avg(flow).alias("mean_flow"),
        F.count(F.when(c == "yellow", 1)).alias("yellow"), F.count(F.when(c == "orange", 1)).alias("orange"),
    )


def hourly_means(df: DataFrame, cols: list[str], time: str = "obs_time") -> DataFrame:
    return df.groupBy(F.date_trunc("hour", time).alias("hour")).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def odor_complaints(df: DataFrame, text: str = "description", day: str = "date") -> DataFrame:
    """Daily count of complaints whose text mentions odor in any case."""
    return df.filter(F.col(text).ilike("%odor%")).groupBy(F.to_date(day).alias("day")).agg(F.count(F.lit(1)).alias("complaints"))


def baseline_medians(df: DataFrame, cols: list[str], hours: int = 72, keys: list[str] | None = None) -> DataFrame:
    return medians(since_latest(df, f"{hours} HOURS", keys=keys), keys or [], cols)


def lagged_correlations(df: DataFrame, keys: list[str], target: str, features: list[str], max_lag: int = 24,
                        least: int = 10, time: str = "obs_time") -> DataFrame:
    """Correlation of the target with each feature shifted by -max_lag..max_lag rows.

    A positive lag pairs the target with an earlier feature value.  The shifted
    features sit beside the target, so each row opens into its lags and the map
    side folds them into one partial sum per lag.
    """
    rows = number_rows(df.filter(F.col(target).isNotNull()).select(*keys, time, target, *features), keys, time)
    lags = list(range(-max_lag, max_lag + 1))

    def build(w):
        return {"_l": F.array(*[F.struct(F.lit(n).alias("lag"), *[
            (F.lag(f, n) if n >= 0 else F.lead(f, -n)).over(w).alias(f) for f in features]) for n in lags])}

    wide = row_windows(rows.withColumn("_y", F.col(target)).drop(target, time), keys, max_lag, max_lag, build)
    opened = wide.select("_y", F.inline("_l"))
    aggs = []
    for f in features:
        aggs += [F.corr("_y", f).alias(f"{f}__c"), F.count(f).alias(f"{f}__n")]
    per = opened.groupBy("lag").agg(*aggs)
    out = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}__c").alias("corr"), F.col(f"{f}__n").alias("n")) for f in features])
    return per.select("lag", F.inline(out)).withColumn("corr", F.when(F.col("n") >= least, F.col("corr")))


def top_features(corr: DataFrame, n: int = 6) -> DataFrame:
    """The ``n`` features with the largest absolute peak correlation."""
    return corr.groupBy("feature").agg(F.max(F.abs("corr")).alias("peak")).orderBy(F.desc("peak"), "feature").limit(n)
