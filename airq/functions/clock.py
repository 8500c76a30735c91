"""Time expressions: epochs, night rules, calendar keys, zone handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions.classes import flag


def epoch(ts: Column) -> Column:
    """Seconds since 1970 as a long."""
    return F.unix_timestamp(ts.cast("timestamp"))


def night(ts: Column, rule: str = "utc", day_night: Column | None = None, tz: str = C.LOCAL_TZ) -> Column:
    """0/1 night flag: ``utc`` hours 20-05 as stored, ``local`` hours 20-07, or
    the ``day_night`` text where there is one (else the utc rule)."""
    hour = F.hour(ts)
    utc = flag((hour >= 20) | (hour <= 5))
    if rule == "utc":
        return utc
    if rule == "local":
        local = F.hour(F.from_utc_timestamp(ts, tz))
        return flag((local >= 20) | (local <= 7))
    if rule == "column":
        if day_night is None:
            raise ValueError("rule 'column' needs day_night")
        return F.when(day_night.isNull(), utc).otherwise(flag(day_night == "night"))
    raise ValueError(f"unknown night rule {rule!r}")


def local_naive_to_utc(ts: Column, tz: str = C.LOCAL_TZ) -> Column:
    return F.to_utc_timestamp(ts, tz)


def round_to_hour(ts: Column) -> Column:
    """Nearest hour; an exact half hour goes to the even hour."""
    secs = F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)
    return F.timestamp_seconds(F.bround(secs / F.lit(3600.0)) * F.lit(3600.0))


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def week_start(ts: Column) -> Column:
    return F.date_trunc("week", ts)
