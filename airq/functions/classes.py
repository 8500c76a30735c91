"""Hazard classes, risk tiers, decisions and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airq import catalog as C


def flag(cond: Column) -> Column:
    """A comparison as 0/1, with a missing operand counted as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def truth(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def three_class(ppb: Column, closed: str = "left") -> Column:
    """green / yellow / orange cut at 5 and 30 ppb.

    ``closed='left'`` puts 5.0 in yellow and 30.0 in orange; ``'right'`` keeps
    each edge in the lower class.
    """
    if closed not in ("left", "right"):
        raise ValueError("closed must be 'left' or 'right'")
    below = (lambda v: ppb < v) if closed == "left" else (lambda v: ppb <= v)
    return (
        F.when(ppb.isNull(), F.lit(None))
        .when(below(C.PPB_LOW), "green")
        .when(below(C.PPB_HIGH), "yellow")
        .otherwise("orange")
    )


def five_class(ppb: Column) -> Column:
    return (
        F.when(ppb.isNull(), F.lit(None))
        .when(ppb < C.PPB_LOW, "green")
        .when(ppb < C.PPB_MED, "yellow_low")
        .when(ppb < C.PPB_HIGH, "yellow_high")
        .when(ppb < C.CRITICAL_PPB, "orange")
        .otherwise("critical")
    )


def risk_tier(prob_5: Column, prob_10: Column, ppb: Column, prob_30: Column | None = None) -> Column:
    """Four-step risk; a positive 30-ppb probability takes over the top step."""
    p30 = F.coalesce(prob_30, F.lit(0.0)) if prob_30 is not None else F.lit(0.0)
    top = F.when(p30 > 0.0, p30 > C.PROB_30_ALERT).otherwise(prob_10 > C.PROB_10_ALERT)
    return (
        F.when(truth(top) | truth(ppb > C.PPB_HIGH), "ORANGE")
        .when(truth(prob_5 > C.PROB_5_ALERT) | truth(ppb > C.PPB_MED), "YELLOW_HIGH")
        .when(truth(prob_5 > C.PROB_5_CAUTION) | truth(ppb > C.PPB_LOW), "YELLOW_LOW")
        .otherwise("GREEN")
    )


# fixed values: risk tier to class, class to integer
RISK_CLASS = [("GREEN", "green"), ("YELLOW_LOW", "yellow"), ("YELLOW_HIGH", "yellow"), ("ORANGE", "orange")]
CLASS_CODE = [("green", 0), ("orange", 1), ("yellow", 2)]


def _lookup(pairs, key: Column) -> Column:
    return F.create_map(*[F.lit(v) for p in pairs for v in p])[key]


def risk_to_class(risk: Column) -> Column:
    return _lookup(RISK_CLASS, risk)


def class_code(label: Column) -> Column:
    return _lookup(CLASS_CODE, label)


def hill(ppb: Column, c: float = 5.0, b: float = 1.23) -> Column:
    x = F.pow(F.greatest(ppb, F.lit(0.0)), F.lit(b))
    return x / (F.lit(c**b) + x)


def hill_inverse(risk: Column, c: float = 5.0, b: float = 1.23) -> Column:
    return F.lit(c) * F.pow(risk / (1.0 - risk), F.lit(1.0 / b))


def expected_ppb(green: Column, yellow: Column, orange: Column) -> Column:
    return green * 2.5 + yellow * 17.5 + orange * 50.0


def decide(green: Column, orange: Column, yellow: Column, orange_cut=None, yellow_cut=None) -> Column:
    """Class by largest probability (ties in the order green, orange, yellow), or
    orange-first by cuts when either cut is given (the other defaults to 0.33)."""
    if orange_cut is None and yellow_cut is None:
        top = F.greatest(green, orange, yellow)
        return F.when(green == top, "green").when(orange == top, "orange").otherwise("yellow")
    oc = 0.33 if orange_cut is None else orange_cut
    yc = 0.33 if yellow_cut is None else yellow_cut
    return F.when(orange >= oc, "orange").when(yellow >= yc, "yellow").otherwise("green")


def wind_flag(ms: Column) -> Column:
    return (
        F.when(ms < 2.0, "calm — elevated dispersion risk").when(ms < 4.0, "light").otherwise("moderate")
    )


def deficit_label(flow: Column, baseline: float = C.PLANT_BASELINE_MGD) -> Column:
    gap = F.lit(baseline) - flow
    return F.when(
        gap <= 0, F.format_string("%.1f MGD  (at or above baseline)", flow)
    ).otherwise(F.format_string("%.1f MGD  (deficit: %.1f MGD below baseline)", flow, gap))


def local_time_label(ts: Column, tz: str = C.LOCAL_TZ) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, tz), "EEE MMM d, yyyy  HH:mm")


def duration_label(start: Column, end: Column) -> Column:
    secs = F.unix_timestamp(end) - F.unix_timestamp(start)
    hours = F.floor(secs / 3600)
    mins = F.floor((secs % 3600) / 60)
    return F.when(mins == 0, F.format_string("%d hr", hours)).otherwise(
        F.format_string("%d hr %d min", hours, mins)
    )


def trend_arrow(new: Column, old: Column, band: float = 0.005) -> Column:
    d = new - old
    return (
        F.when(new.isNull() | old.isNull(), "")
        .when(F.abs(d) < band, "➡️")
        .when(d > 0, "⬆️")
        .otherwise("⬇️")
    )
