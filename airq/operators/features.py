"""Filters, per-station lags and rollings, splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions.features import base_features, targets
from airq.operators.ordering import number_rows, row_windows
from airq.operators.ranks import medians

SITE = ["network", "site_name"]


def measured(df: DataFrame, h2s: str = "h2s", cap: float = 500.0) -> DataFrame:
    """Measured readings up to ``cap``, with negative values raised to zero."""
    return df.filter(F.col("h2s_measured") & (F.col(h2s) <= cap)).withColumn(
        h2s, F.greatest(F.col(h2s), F.lit(0.0))
    )


def positive_target(df: DataFrame, h2s: str = "h2s") -> DataFrame:
    return df.filter(F.col(h2s) > 0)


def through_month(df: DataFrame, month: str, time: str = "obs_time") -> DataFrame:
    """All rows before the end of ``month`` (YYYY-MM), its last day included whole."""
    return df.filter(F.col(time) < F.add_months(F.to_date(F.lit(f"{month}-01")), 1).cast("timestamp"))


def day_slice(df: DataFrame, day: str, time: str = "obs_time") -> DataFrame:
    start = F.lit(day).cast("timestamp")
    return df.filter((F.col(time) >= start) & (F.col(time) < start + F.expr("INTERVAL 1 DAY")))


def since_latest(df: DataFrame, interval: str, time: str = "obs_time", keys: list[str] | None = None) -> DataFrame:
    """Rows within ``interval`` of the newest row, overall or per key.

    The newest time is a one-row (or one-row-per-key) aggregate joined back.
    """
    keys = keys or []
    top = df.groupBy(*keys).agg(F.max(time).alias("_top"))
    if keys:
        return df.join(top, keys).filter(F.col(time) >= F.col("_top") - F.expr(f"INTERVAL {interval}")).drop("_top")
    cut = top.select((F.col("_top") - F.expr(f"INTERVAL {interval}")).alias("_cut"))
    return df.filter(F.col(time) >= cut.scalar())


def recent_site(df: DataFrame, site_text: str, now: str, hours: int, time: str = "obs_time") -> DataFrame:
    """Rows of sites whose name contains ``site_text``, no older than ``hours`` before ``now``."""
    cut = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    return df.filter((F.col(time) >= cut) & F.lower("site_name").contains(site_text.lower()))


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Missing values become the exact batch median of their column, all medians from one subquery."""
    med = medians(df, [], cols).select(F.struct(*cols)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), med[c]) for c in cols})


def station_windows(df: DataFrame, keys: list[str] = SITE, h2s: str = "h2s", flow: str = "flow_border") -> DataFrame:
    """Row-based lags and rollings per station; expects a numbered frame."""
    c = F.col

    def build(w):
        roll = lambda n: w.rowsBetween(1 - n, 0)
        out = {}
        for n in (2, 3, 4):
            out[f"wind_speed_10m_avg_{n}h"] = F.avg("wind_speed_10m").over(roll(n))
            out[f"wind_gusts_10m_max_{n}h"] = F.max("wind_gusts_10m").over(roll(n))
        for n in (1, 3, 6):
            out[f"h2s_lag_{n}h"] = F.lag(h2s, n).over(w)
        for n in (6, 24):
            out[f"h2s_rolling_{n}h"] = F.avg(h2s).over(roll(n))
        out["flow_lag_6h"] = F.lag(c(flow), 6).over(w)
        out["flow_rolling_24h"] = F.avg(flow).over(roll(24))
        return out

    return row_windows(df, keys, 23, 0, build)


def training_features(obs: DataFrame, keys: list[str] = SITE, time: str = "obs_time",
                      required: list[str] | None = C.FEATURES_33) -> DataFrame:
    """Clean rows with all model features and targets; rows missing a required feature are dropped."""
    clean = base_features(measured(obs), time)
    full = targets(station_windows(number_rows(clean, keys, time), keys))
    return full.dropna(subset=required) if required else full


def persistence(df: DataFrame, lag: int = 1, keys: list[str] = SITE, time: str = "obs_time",
                h2s: str = "h2s", out: str = "persistence") -> DataFrame:
    """The value ``lag`` rows earlier at the same station."""
    return row_windows(number_rows(df, keys, time), keys, lag, 0, lambda w: {out: F.lag(h2s, lag).over(w)})


def chronological_split(df: DataFrame, fraction: float, keys: list[str] | None = None,
                        time: str = "obs_time", tie: list[str] | None = None) -> DataFrame:
    """Add ``split``: the first floor(n * fraction) rows by time are ``train``."""
    if not 0 < fraction < 1:
        raise ValueError("fraction must be between 0 and 1")
    numbered = number_rows(df, keys or [], time, tie)
    return numbered.withColumn(
        "split", F.when(F.col("seq") <= F.floor(F.col("total") * F.lit(fraction)), "train").otherwise("test")
    ).drop("seq", "total")


def expanding_folds(df: DataFrame, k: int = 5, keys: list[str] | None = None,
                    time: str = "obs_time", tie: list[str] | None = None) -> DataFrame:
    """Add ``fold``: 0 for rows that are only trained on, 1..k for the k test blocks
    of size n // (k+1) at the end of the series."""
    numbered = number_rows(df, keys or [], time, tie)
    size = F.floor(F.col("total") / F.lit(k + 1))
    first = F.col("total") - size * k
    return numbered.withColumn(
        "fold", F.when(F.col("seq") <= first, 0).otherwise(F.floor((F.col("seq") - first - 1) / size) + 1)
    ).drop("seq", "total")


def select_features(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    if name not in C.FEATURE_SETS:
        raise ValueError(f"unknown feature set {name!r}")
    return df.select(*keys, *C.FEATURE_SETS[name])
