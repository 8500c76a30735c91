"""Row-local model features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions.classes import flag
from airq.functions.clock import night

# fixed values: tidal codes of the package and of the older script
TIDAL_CODES = [("flood", 0), ("ebb", 1), ("slack high", 2), ("slack low", 3)]
TIDAL_CODES_OLD = [("ebb", 0), ("flood", 1), ("slack", 2), ("slack high", 3), ("slack low", 4)]


def cycle(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def source_regime(is_night: Column, wind_dir: Column) -> Column:
    return (
        F.when((F.coalesce(is_night, F.lit(0)) == 0) | wind_dir.isNull(), 0)
        .when((wind_dir >= 22.5) & (wind_dir < 135), 1)
        .when((wind_dir >= 247.5) | (wind_dir < 22.5), 2)
        .otherwise(3)
    )


def tidal_code(state: Column, codes=None) -> Column:
    table = F.create_map(*[F.lit(v) for p in (codes or TIDAL_CODES) for v in p])
    return F.coalesce(table[state], F.lit(-1))


def base_features(df: DataFrame, time: str = "obs_time", flow: str = "flow_border", night_rule: str = "utc") -> DataFrame:
    """Add every row-local feature that ``df`` does not have yet."""
    have = set(df.columns)
    c = F.col

    def add(frame: DataFrame, new: dict[str, Column]) -> DataFrame:
        fresh = {k: v for k, v in new.items() if k not in have}
        have.update(fresh)
        return frame.withColumns(fresh) if fresh else frame

    hs, hc = cycle(F.hour(c(time)).cast("double"), 24.0)
    ms, mc = cycle(F.month(c(time)).cast("double"), 12.0)
    df = add(df, {
        "hour_sin": hs, "hour_cos": hc, "month_sin": ms, "month_cos": mc,
        "is_night": night(c(time), night_rule),
    })
    df = add(df, {
        "source_regime": source_regime(c("is_night"), c("wind_direction_10m"))
        if "wind_direction_10m" in have else F.lit(0),
        "stable_atm": flag((c("wind_speed_10m") < 5) & (c("is_night") == 1))
        if "wind_speed_10m" in have else F.lit(0),
    })
    if "wind_direction_10m" in have:
        angle = F.radians(c("wind_direction_10m"))
        df = add(df, {"wind_direction_sin": F.sin(angle), "wind_direction_cos": F.cos(angle)})
    if "wind_speed_10m" in have:
        df = add(df, {"wind_gusts_10m": c("wind_speed_10m") * 1.8})
    if flow in have:
        df = add(df, {
            "flow_log": F.log1p(F.greatest(c(flow), F.lit(0.0))),
            "flow_low": flag(c(flow) < 1), "flow_high": flag(c(flow) > 5),
        })

    def product(a: str, b: str) -> Column:
        return c(a) * c(b) if {a, b} <= have else F.lit(0.0)

    df = add(df, {
        "wind_temp_interaction": product("wind_speed_10m", "temperature_2m"),
        "humidity_temp_interaction": product("relative_humidity_2m", "temperature_2m"),
        "wind_x_stable_atm": product("wind_speed_10m", "stable_atm"),
        "tidal_state_encoded": tidal_code(c("tidal_state")) if "tidal_state" in have else F.lit(-1),
    })
    return plant_defaults(df)


def plant_defaults(df: DataFrame) -> DataFrame:
    """Plant-flow columns with their defaults; the anomaly follows a known flow."""
    base = C.PLANT_BASELINE_MGD
    have = set(df.columns)
    new = {
        "sbiwtp_flow_mgd": F.lit(base),
        "sbiwtp_anomaly": F.col("sbiwtp_flow_mgd") - base if "sbiwtp_flow_mgd" in have else F.lit(0.0),
        "sbiwtp_deficit": F.lit(0.0),
        "sbiwtp_flow_x_temp": F.lit(base * 18.0),
        "sbiwtp_hourly_mgd": F.lit(base / 24),
        "sbiwtp_sli": F.lit(0.0),
    }
    fresh = {k: v for k, v in new.items() if k not in have}
    return df.withColumns(fresh) if fresh else df


def targets(df: DataFrame, h2s: str = "h2s") -> DataFrame:
    return df.withColumns({f"exceed_{t}": flag(F.col(h2s) > t) for t in (5, 10, 30)})
