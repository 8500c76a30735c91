"""Bearings, distances, back-calculated rates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(lon2 - lon1, lat2 - lat1)), F.lit(360.0))


def angular_difference(a: Column, b: Column) -> Column:
    """Signed difference in [-180, 180)."""
    return F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    x = (lon1 - lon2) * F.cos(F.radians((lat1 + lat2) / 2.0))
    y = lat1 - lat2
    return F.sqrt(y * y + x * x) * 111.32


def back_rate(ppb: Column, wind: Column, dist_m: Column) -> Column:
    """Emission rate (g/s) that explains ``ppb`` at ``dist_m`` downwind, class D."""
    speed = F.greatest(wind, F.lit(0.5))
    sy = dist_m * 0.08 / F.sqrt(dist_m * 0.0001 + 1.0)
    sz = dist_m * 0.06 / F.sqrt(dist_m * 0.0015 + 1.0)
    return ppb * 1.42 * math.pi * sy * sz * speed / 1e6
