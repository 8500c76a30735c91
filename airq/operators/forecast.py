"""Forecast-side features: seed state, forecast expansion, decayed lags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.functions.features import base_features
from airq.operators.dims import pair_with
from airq.operators.features import SITE
from airq.operators.ordering import number_rows


def seed_state(obs: DataFrame, keys: list[str] = SITE, time: str = "obs_time", h2s: str = "h2s",
               flow: str = "flow_border") -> DataFrame:
    """Per station: the newest value and the means of its last 6 and 24 rows."""
    # the rank filter is applied before the shuffle too, so a task holds at most the newest rows
    newest = W.partitionBy(*keys).orderBy(F.col(time).desc())
    tail = obs.select(*keys, time, h2s, flow).withColumn("_b", F.row_number().over(newest)).filter(F.col("_b") <= 24)
    last = lambda c: F.max(F.when(F.col("_b") == 1, F.col(c)))
    return tail.groupBy(*keys).agg(
        last(h2s).alias("h2s_last"),
        F.avg(F.when(F.col("_b") <= 6, F.col(h2s))).alias("h2s_6"),
        F.avg(h2s).alias("h2s_24"),
        F.coalesce(last(flow), F.lit(2.0)).alias("flow_last"),
        F.coalesce(F.avg(flow), F.lit(2.0)).alias("flow_24"),
    )


def forecast_rows(forecast: DataFrame, seed: DataFrame, group: list[str], hours: int = 24, time: str = "obs_time",
                  keys: list[str] = SITE) -> DataFrame:
    """The first ``hours`` rows of a group's forecast for each of its stations, with
    lag features decayed from the station's seed state."""
    steps = number_rows(forecast, group, time).filter(F.col("seq") <= hours).withColumn("step", F.col("seq") - 1).drop("seq", "total")
    clash = [c for c in steps.columns if c in seed.columns and c not in group]
    df = steps.drop(*clash).join(seed, group)
    h = F.col("step").cast("double")
    fast = lambda n: F.exp((h - n) / -12.0)

    def lag(n):
        return F.when(h < n, F.col("h2s_last")).otherwise(F.col("h2s_last") * fast(n))

    return df.withColumns({
        "h2s_lag_1h": lag(1), "h2s_lag_3h": lag(3), "h2s_lag_6h": lag(6),
        "h2s_rolling_6h": F.col("h2s_6") * fast(0), "h2s_rolling_24h": F.col("h2s_24") * F.exp(h / -36.0),
        "flow_lag_6h": F.col("flow_last"), "flow_rolling_24h": F.col("flow_24"),
    })


def forecast_features(forecast: DataFrame, seed: DataFrame, group: list[str], hours: int = 24, time: str = "obs_time") -> DataFrame:
    """Model-ready rows: decayed lags, gusts from speed, forecast-side rollings, base features."""
    df = forecast_rows(forecast, seed, group, hours, time)
    df = df.withColumn("wind_gusts_10m", F.col("wind_speed_10m") * 1.8)
    # at most ``hours`` rows per station reach this window
    w = W.partitionBy(*SITE).orderBy("step")
    for n in (2, 3, 4):
        df = df.withColumns({
            f"wind_speed_10m_avg_{n}h": F.avg("wind_speed_10m").over(w.rowsBetween(1 - n, 0)),
            f"wind_gusts_10m_max_{n}h": F.max("wind_gusts_10m").over(w.rowsBetween(1 - n, 0)),
        })
    return base_features(df, time, night_rule="utc")


def station_forecast(scored: DataFrame) -> DataFrame:
    """Rounded forecast rows with their risk; the risk uses the unrounded values."""
    from airq.functions.classes import risk_tier

    c = F.col
    return scored.withColumns({
        "risk": risk_tier(c("p5"), c("p10"), c("ppb")),
        "h2s_pred": F.round(F.greatest(c("ppb"), F.lit(0.0)), 1),
        "prob_5": F.round(c("p5") * 100, 1), "prob_10": F.round(c("p10") * 100, 1),
    })
