"""Closed-form plume of one source at one receptor, as Column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq import catalog as C

LAT_M = C.METRES_PER_DEGREE
LON_M = C.METRES_PER_DEGREE * math.cos(math.radians(C.REFERENCE_LATITUDE))
POINT_FLOOR_KM, GRID_FLOOR_KM = 0.1, 0.01


def stability(wind: Column, is_night: Column) -> Column:
    return F.when(
        is_night == 1, F.when(wind < 2.0, "F").when(wind < 3.0, "E").otherwise("D")
    ).otherwise(F.when(wind < 2.0, "B").when(wind < 5.0, "C").otherwise("D"))


def coefficient(stab: Column, axis: str) -> Column:
    """The lateral (``y``) or vertical (``z``) factor of a stability class."""
    at = 1 if axis == "y" else 2
    return F.create_map(*[F.lit(v) for row in C.PLUME_COEFFICIENTS for v in (row[0], row[at])])[stab]


def sigma(factor: Column, x_km: Column, floor_km: float = POINT_FLOOR_KM) -> Column:
    return factor * F.pow(F.greatest(x_km, F.lit(floor_km)), F.lit(C.PLUME_EXPONENT)) * 1000.0


def wind_u(speed: Column, direction: Column) -> Column:
    return -speed * F.sin(F.radians(direction))


def wind_v(speed: Column, direction: Column) -> Column:
    return -speed * F.cos(F.radians(direction))


def to_ppb(ug_m3: Column, temp_c: Column) -> Column:
    return ug_m3 * (C.MOLAR_VOLUME / 293.15 / C.MOLAR_MASS_H2S) * (temp_c + 273.15)


@dataclass(frozen=True)
class PlumeSettings:
    stack_m: float = 2.0
    receptor_m: float = 1.5
    meander_deg: float = 20.0
    floor_km: float = POINT_FLOOR_KM
    calm_ms: float = 0.1


def with_wind_terms(df, speed="wind_speed_10m", direction="wind_direction_10m", is_night="is_night"):
    """Per-met-row terms used by every source: wind components and coefficients."""
    stab = stability(F.col(speed), F.col(is_night))
    return df.withColumns({
        "_u": wind_u(F.col(speed), F.col(direction)),
        "_v": wind_v(F.col(speed), F.col(direction)),
        "_stab": stab,
    }).withColumns({
        "_ws": F.sqrt(F.col("_u") * F.col("_u") + F.col("_v") * F.col("_v")),
        "_ay": coefficient(F.col("_stab"), "y"),
        "_az": coefficient(F.col("_stab"), "z"),
    })


def add_plume(df: DataFrame, rec_lat: str, rec_lon: str, s: PlumeSettings = PlumeSettings(), out: str = "_ug") -> DataFrame:
    """Add the concentration in µg/m³ of (source_lat, source_lon, rate) at a receptor;
    reads the columns of :func:`with_wind_terms`.

    Calm air spreads evenly over a 50 m layer, upwind receptors get nothing and never
    reach the powers and exponentials, the rest is the reflected plume with meander.
    Each step is its own projection, so a term used twice is evaluated once.
    """
    c = F.col
    steps = [
        {"_dx": (c(rec_lon) - c("source_lon")) * LON_M, "_dy": (c(rec_lat) - c("source_lat")) * LAT_M},
        {"_al": (c("_dx") * c("_u") + c("_dy") * c("_v")) / _speed(), "_cr": (c("_u") * c("_dy") - c("_v") * c("_dx")) / _speed()},
        {"_km": F.when(c("_al") > 0, F.pow(F.greatest(c("_al") / 1000.0, F.lit(s.floor_km)), F.lit(C.PLUME_EXPONENT)) * 1000.0)},
        {"_sy": c("_ay") * c("_km"), "_sz": c("_az") * c("_km"), "_dr": c("_al") * math.radians(s.meander_deg)},
        {"_s2": c("_sy") * c("_sy") + c("_dr") * c("_dr"), "_z2": c("_sz") * c("_sz")},
        {out: _final(s, c("rate"), c("_dx"), c("_dy"), c("_al"), c("_cr"), c("_s2"), c("_z2"), c("_sz"))},
    ]
    for step in steps:
        df = df.withColumns(step)
    return df.drop("_dx", "_dy", "_al", "_cr", "_km", "_sy", "_sz", "_dr", "_s2", "_z2")


def _speed() -> Column:
    """The wind speed as a divisor; still air takes the calm branch whatever the quotient."""
    return F.greatest(F.col("_ws"), F.lit(1e-9))


def _final(s: PlumeSettings, rate, dx, dy, along, cross, s2, z2, sz) -> Column:
    ws = F.col("_ws")
    dist = F.greatest(F.sqrt(dx * dx + dy * dy), F.lit(50.0))
    calm = rate * 1e6 / (dist * dist * 50.0)
    direct, mirror = -0.5 * (s.receptor_m - s.stack_m) ** 2, -0.5 * (s.receptor_m + s.stack_m) ** 2
    vertical = F.exp(F.lit(direct) / z2) + F.exp(F.lit(mirror) / z2)
    plume = rate * 1e6 / (F.greatest(ws, F.lit(0.3)) * F.sqrt(s2) * sz * math.pi) * F.exp(cross * cross / s2 * -0.5) * vertical
    return F.when(ws < s.calm_ms, calm).when(along <= 0, 0.0).otherwise(plume)


def plume_array(sources: Column, rec_lat: Column, rec_lon: Column, s: PlumeSettings = PlumeSettings()) -> Column:
    """Unit-rate concentrations of an array of sources at one receptor, in array order.

    The steps of :func:`add_plume` as a chain of array transforms.
    """
    c = F.col

    def place(x):
        return F.struct(((rec_lon - x["source_lon"]) * LON_M).alias("dx"), ((rec_lat - x["source_lat"]) * LAT_M).alias("dy"))

    def turn(x):
        return F.struct(x["dx"].alias("dx"), x["dy"].alias("dy"), ((x["dx"] * c("_u") + x["dy"] * c("_v")) / _speed()).alias("al"),
                        ((c("_u") * x["dy"] - c("_v") * x["dx"]) / _speed()).alias("cr"))

    def reach(x):
        km = F.when(x["al"] > 0, F.pow(F.greatest(x["al"] / 1000.0, F.lit(s.floor_km)), F.lit(C.PLUME_EXPONENT)) * 1000.0)
        return F.struct(*[x[n].alias(n) for n in ("dx", "dy", "al", "cr")], km.alias("km"))

    def widen(x):
        sy, sz, dr = c("_ay") * x["km"], c("_az") * x["km"], x["al"] * math.radians(s.meander_deg)
        return F.struct(*[x[n].alias(n) for n in ("dx", "dy", "al", "cr")], (sy * sy + dr * dr).alias("s2"), (sz * sz).alias("z2"), sz.alias("sz"))

    def end(x):
        return _final(s, F.lit(1.0), x["dx"], x["dy"], x["al"], x["cr"], x["s2"], x["z2"], x["sz"])

    for step in (place, turn, reach, widen, end):
        sources = F.transform(sources, step)
    return sources


def confidence(min_dist_m: Column, lead_h: Column) -> Column:
    near = F.least(F.greatest(F.lit(1.0) - min_dist_m / 1000.0 * 0.07, F.lit(0.3)), F.lit(1.0))
    return near * F.greatest(F.lit(1.0) - lead_h * 0.02, F.lit(0.3))


def plume_values(dx: np.ndarray, dy: np.ndarray, rate, u, v, speed, ay, az, s: PlumeSettings = PlumeSettings()) -> np.ndarray:
    """The values of :func:`add_plume` at offsets in metres from a source, for arrays that broadcast; NULL is NaN."""
    dx, dy, rate, u, v, speed, ay, az = np.broadcast_arrays(dx, dy, rate, u, v, speed, ay, az)
    by = np.maximum(speed, 1e-9)
    along = (dx * u + dy * v) / by
    out = np.where(np.isnan(along), np.nan, 0.0)
    calm = speed < s.calm_ms
    d = np.maximum(np.sqrt(dx[calm] ** 2 + dy[calm] ** 2), 50.0)
    out[calm] = rate[calm] * 1e6 / (d * d * 50.0)
    down = np.nonzero((along > 0) & ~calm)
    dx, dy, rate, u, v, speed, ay, az, along = (x[down] for x in (dx, dy, rate, u, v, speed, ay, az, along))
    cross = (u * dy - v * dx) / speed
    km = np.power(np.maximum(along / 1000.0, s.floor_km), C.PLUME_EXPONENT) * 1000.0
    spread, sz = along * math.radians(s.meander_deg), az * km
    s2, z2 = (ay * km) ** 2 + spread * spread, sz * sz
    direct, mirror = -0.5 * (s.receptor_m - s.stack_m) ** 2, -0.5 * (s.receptor_m + s.stack_m) ** 2
    vertical = np.exp(direct / z2) + np.exp(mirror / z2)
    out[down] = rate * 1e6 / (np.maximum(speed, 0.3) * np.sqrt(s2) * sz * math.pi) * np.exp(cross * cross / s2 * -0.5) * vertical
    return out


def confidence_values(min_dist_m: np.ndarray, lead_h: np.ndarray) -> np.ndarray:
    """The values of :func:`confidence`; NULL is NaN."""
    near = np.fmin(np.fmax(1.0 - min_dist_m / 1000.0 * 0.07, 0.3), 1.0)
    return near * np.fmax(1.0 - lead_h * 0.02, 0.3)
