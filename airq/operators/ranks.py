"""Exact order statistics without a single-task sort.

Equal values are merged first (one row per distinct value, so a hot value costs
nothing), values fall into monotone buckets, and cumulative counts come from
bucket totals plus the count inside the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.operators.ordering import meet
from airq.session import materialize


def _bucket(value: Column) -> Column:
    """A monotone, magnitude-aware integer bucket of a double."""
    return F.floor(F.signum(value) * F.log(F.abs(value) + 1.0) * 256.0)


def value_counts(df: DataFrame, keys: list[str], value: str, extra: dict[str, Column] | None = None,
                 weight: Column | None = None) -> DataFrame:
    """One row per (keys, value): ``n``, rows ``below`` it, group ``total``.

    ``extra`` are further aggregates per value; ``weight`` counts a row several times.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .withColumn("_bkt", _bucket(F.col(value)))
        .groupBy(*keys, "_bkt", value)
        .agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"), *[c.alias(k) for k, c in (extra or {}).items()])
    )
    totals = counted.groupBy(*keys, "_bkt").agg(F.sum("n").alias("_n"))
    whole = W.partitionBy(*([F.col(k) for k in keys] or [F.lit(0)]))
    offsets = totals.select(
        *keys, "_bkt",
        F.coalesce(F.sum("_n").over(whole.orderBy("_bkt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias("total"),
    )
    inside = W.partitionBy(*keys, "_bkt").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    placed = meet(counted.withColumn("_in", F.coalesce(F.sum("n").over(inside), F.lit(0))), offsets, [*keys, "_bkt"])
    return placed.withColumn("below", F.col("_off") + F.col("_in")).drop("_bkt", "_in", "_off")


def average_ranks(df: DataFrame, keys: list[str], value: str, out: str, weight: Column | None = None) -> DataFrame:
    """(keys, value, ``out``): the mean 1-based rank of each distinct value."""
    vc = value_counts(df, keys, value, weight=weight)
    return vc.select(*keys, value, (F.col("below") + (F.col("n") + 1) / F.lit(2.0)).alias(out))


def quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per key, one column per entry of ``probs``."""
    vc = value_counts(df, keys, value)
    aggs = []
    for name, p in probs.items():
        at = (F.col("total") - 1) * F.lit(float(p))
        for tag, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("below") <= pos) & (pos < F.col("below") + F.col("n"))
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{tag}_{name}"))
    aggs.append(F.max("total").alias("_total"))
    res = vc.groupBy(*keys).agg(*aggs)
    cols = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return res.select(*keys, *cols)


def _near_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int) -> DataFrame:
    """(keys, prob, total, value, n): how many rows lie below the bounds of a quantile (``value`` NULL) and each value inside with its count.

    A mergeable sketch gives the bounds, two sketch errors to either side of the quantile, so what is shuffled is
    a small share of the values; a key of few values, for which the next rank may lie beyond them, is taken whole.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    step = 2.0 / accuracy

    def edge(p, end):
        return end if p <= 0 or p >= 1 else F.when(F.count(F.lit(1)) < 4 * accuracy, end).otherwise(F.percentile_approx("_v", p, accuracy))

    ends = F.array(*[F.struct(F.lit(name).alias("prob"), edge(p - step, F.min("_v")).alias("lo"), edge(p + step, F.max("_v")).alias("hi")) for name, p in probs.items()])
    bounds = rows.groupBy(*keys).agg(ends.alias("_ends"), F.count(F.lit(1)).alias("total"))
    placed = meet(rows, bounds, keys).select(*keys, "total", "_v", F.inline("_ends")).filter(F.col("_v") <= F.col("hi"))
    return placed.groupBy(*keys, "prob", "total", F.when(F.col("_v") >= F.col("lo"), F.col("_v")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def selected_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """The same quantiles in two passes, for few keys with many different values: a first pass bounds each quantile, a second ranks only what lies inside.

    Exact; should a quantile ever lie outside its bounds, the query fails rather than answer wrongly.
    """
    w = W.partitionBy(*keys, "prob").orderBy(F.col("value").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    d = _near_quantiles(df, keys, value, probs, accuracy).withColumn("below", F.coalesce(F.sum("n").over(w), F.lit(0)))
    p = F.create_map(*[x for name, q in probs.items() for x in (F.lit(name), F.lit(float(q)))])[F.col("prob")]
    at = (F.col("total") - 1) * p
    hit = lambda pos: F.max(F.when((F.col("below") <= pos) & (pos < F.col("below") + F.col("n")), F.col("value")))
    per = d.groupBy(*keys, "prob").agg(hit(F.floor(at)).alias("_lo"), hit(F.ceil(at)).alias("_hi"), F.max(at - F.floor(at)).alias("_part"))
    lost = F.col("_lo").isNull() | F.col("_hi").isNull()
    got = F.when(lost, F.raise_error(F.lit("a quantile lies outside the bounds of its sketch")).cast("double")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part"))
    per = per.withColumn("_q", got)
    return per.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == name, F.col("_q"))).alias(name) for name in probs])


def medians(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Exact medians of several columns, one row per key."""
    long = df.select(*keys, F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c).cast("double") for c in cols])
    )).alias("_col", "_val"))
    # over the whole table there are few keys and many values
    med = (quantiles if keys else selected_quantiles)(long, [*keys, "_col"], "_val", {"m": 0.5})
    return med.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_col") == c, F.col("m"))).alias(c) for c in cols
    ])


def spearman(df: DataFrame, keys: list[str], y: str, p: str, least: int = 3) -> DataFrame:
    """(keys, n, spearman): rank correlation of the complete pairs; null below ``least``.

    Both rankings start from the merged pairs, written once, so the rows are read and
    shuffled once.
    A value shared by many pairs makes the join back to them uneven; adaptive skew
    handling splits that side of the sort-merge join.
    """
    pairs = materialize(
        df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
        .groupBy(*keys, y, p).agg(F.count(F.lit(1)).alias("m")), "pairs")
    m = F.col("m")
    ranked = meet(pairs, average_ranks(pairs, keys, y, "ry", m), [*keys, y])
    ranked = meet(ranked, average_ranks(pairs, keys, p, "rp", m), [*keys, p])
    s = ranked.groupBy(*keys).agg(
        F.sum("m").alias("n"),
        F.sum(m * F.col("ry")).alias("sy"), F.sum(m * F.col("rp")).alias("sp"),
        F.sum(m * F.col("ry") * F.col("ry")).alias("syy"), F.sum(m * F.col("rp") * F.col("rp")).alias("spp"),
        F.sum(m * F.col("ry") * F.col("rp")).alias("syp"),
    )
    n = F.col("n").cast("double")
    cov = F.col("syp") - F.col("sy") * F.col("sp") / n
    vy = F.col("syy") - F.col("sy") * F.col("sy") / n
    vp = F.col("spp") - F.col("sp") * F.col("sp") / n
    rho = F.when((F.col("n") >= least) & (vy > 0) & (vp > 0), cov / F.sqrt(vy * vp))
    return s.select(*keys, "n", rho.alias("spearman"))


def auc(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """(keys, auc): rank-sum area under the curve; 0.5 when only one class is present."""
    vc = value_counts(df.filter(F.col(label).isNotNull()), keys, score, {"pos": F.sum(F.col(label))})
    rank = F.col("below") + (F.col("n") + 1) / F.lit(2.0)
    s = vc.groupBy(*keys).agg(
        F.sum(F.col("pos") * rank).alias("r"), F.sum("pos").alias("np"), F.sum("n").alias("n")
    )
    np_, nn = F.col("np").cast("double"), (F.col("n") - F.col("np")).cast("double")
    area = (F.col("r") - np_ * (np_ + 1) / 2) / (np_ * nn)
    return s.select(*keys, F.when((np_ > 0) & (nn > 0), area).otherwise(0.5).alias("auc"))
