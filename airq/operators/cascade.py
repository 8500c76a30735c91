"""Compute-on-trigger cascade over lead-hour products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq import catalog as C


def trigger_cascade(df: DataFrame, keys: list[str], lead: str) -> DataFrame:
    """Per key: does each tier's product reach its probability cut, given all tiers before it."""
    windows = {n: (a, b) for n, a, b in C.PRODUCT_WINDOWS}
    aggs = []
    for tier, product, ppb, cut in C.CASCADE:
        a, b = windows[product]
        inside = (F.col(lead) >= a) & (F.col(lead) < b)
        aggs.append(F.coalesce(F.max(F.when(inside, F.col(f"prob_{ppb:g}"))) >= cut, F.lit(False)).alias(f"_{tier}"))
    d = df.groupBy(*keys).agg(*aggs)
    fired = F.lit(True)
    out = []
    for tier, *_ in C.CASCADE:
        fired = fired & F.col(f"_{tier}")
        out.append(fired.alias(tier))
    return d.select(*keys, *out)
