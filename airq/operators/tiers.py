"""Multi-horizon alert tiers: horizon features, gates, scores, backtest, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions.classes import flag, truth
from airq.functions.clock import epoch, night
from airq.operators.dims import parts_for, spread
from airq.operators.ranks import quantiles

MEANS = ["sbiwtp_flow_mgd", "sbiwtp_anomaly", "sbiwtp_sli", "sbiwtp_deficit", "precipitation", "flow_log",
         "wind_speed_10m", "stable_atm", "temperature_2m", "dewpoint_2m", "surface_pressure"]
GATE_WIND, GATE_TEMP, GATE_DEW, GATE_STABLE = 4.0, 13.0, 11.0, 0.6
PPB = dict(C.TIER_PPB)
#: Planned bytes of readings a task: some 10,000 rows, which open into 24 hours each.
TASK_BYTES = 512 << 10


def group_facts(obs: DataFrame, group: list[str], time: str = "obs_time", h2s: str = "h2s",
                primary: str = C.PRIMARY_STATION) -> DataFrame:
    """Per group: first and last evaluation hour (a day before the last reading),
    whether the primary station reports at all (a lone station stands in for it), whether
    there is one station only, and how many stations carry h2s."""
    first = F.date_trunc("hour", F.min(time) + F.expr("INTERVAL 3599999999 MICROSECONDS"))
    last = F.date_trunc("hour", F.max(time)) - F.expr("INTERVAL 24 HOURS")
    lone = F.min("site_name") == F.max("site_name")
    return obs.groupBy(*group).agg(
        first.alias("first_eval"), last.alias("last_eval"), lone.alias("lone"),
        (F.bool_or(F.col("site_name") == primary) | lone).alias("has_primary"),
        F.count_distinct(F.when(F.col(h2s).isNotNull(), F.col("site_name"))).alias("n_active"))


def _readings(obs: DataFrame, group: list[str], time: str, h2s: str, horizons, seconds: int) -> DataFrame:
    """What the cells are made of, once per chunk of evaluation hours that a reading belongs to."""
    rad = F.radians("wind_direction_10m")
    reach = (max(b for _, _, b in horizons) - 1) * 3600
    rows = obs.select(
        *group, "site_name", epoch(F.date_trunc("hour", time)).alias("_t"), epoch(F.col(time)).alias("_at"), *MEANS,
        F.col(h2s).alias("_h2s"), (-F.col("wind_speed_10m") * F.sin(rad)).alias("_u"),
        (-F.col("wind_speed_10m") * F.cos(rad)).alias("_v"), night(F.col(time), "local").alias("_night")).filter("_t IS NOT NULL")
    chunk = lambda x: F.floor(x / F.lit(seconds))
    return rows.withColumn("_chunk", F.explode(F.array_distinct(F.array(chunk(F.col("_t")), chunk(F.col("_t") - reach)))))


def _hours_ahead(horizons) -> Column:
    """(horizon, _e) of each evaluation hour of a reading."""
    return F.array(*[F.struct(F.lit(n).alias("horizon"), (F.col("_t") - o * 3600).alias("_e")) for n, a, b in horizons for o in range(a, b)])


def _cell_values() -> list[Column]:
    return [
        F.count("_t").alias("n"), *[F.avg(c).alias(c) for c in MEANS], F.min("wind_speed_10m").alias("wind_speed_min"),
        F.min("temperature_2m").alias("temp_min"), F.avg("_night").alias("night_share"), F.avg("_u").alias("wind_u"), F.avg("_v").alias("wind_v"),
        F.max("_h2s").alias("h2s_max"), *[F.min(F.when(F.col("_h2s") >= p, F.col("_at"))).alias(f"first_{n}") for n, p in C.TIER_PPB]]


def horizon_cells(obs: DataFrame, group: list[str], time: str = "obs_time", h2s: str = "h2s",
                  horizons=C.HORIZONS, seconds: int = 7 * 86400) -> DataFrame:
    """(group, evaluated_at, site, horizon): aggregates over the rows of
    [t + start, t + end) at that site; windows without rows are absent.

    A reading belongs to one evaluation hour per hour of look-ahead.  Readings are
    shuffled once, by station and time chunk (with copies for evaluation hours of
    the chunk before), and open into their hours only behind that shuffle, where the
    same partitioning serves the aggregation. The number of tasks follows the size of the input.
    """
    placed = spread(_readings(obs, group, time, h2s, horizons, seconds), [*group, "site_name", "_chunk"], parts_for(obs, TASK_BYTES))
    opened = placed.select("*", F.inline(_hours_ahead(horizons))).filter(F.floor(F.col("_e") / F.lit(seconds)) == F.col("_chunk"))
    cells = opened.groupBy(*group, "site_name", "_chunk", "_e", "horizon").agg(*_cell_values())
    return cells.withColumn("evaluated_at", F.timestamp_seconds("_e")).drop("_chunk", "_e")


def mean_direction(u: Column, v: Column) -> Column:
    """Direction the mean wind comes from; null for a zero vector."""
    deg = F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0))
    return F.when((u != 0) | (v != 0), deg)


def score(cell: str, weights: dict[str, float], single: Column) -> Column:
    """Weighted sum of standardised features through a sigmoid, at most 0.95."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        parts = []
        for stats in (C.SINGLE_STATION_STATS, C.QUIET_STATS):
            mean, std = stats[name]
            parts.append((F.col(f"{cell}_{name}") - mean) / std * weight if std else F.lit(0.0))
        total = total + F.coalesce(F.when(single, parts[0]).otherwise(parts[1]), F.lit(0.0))
    return F.least(F.lit(0.95), F.lit(1.0) / (F.exp(-total) + 1.0))


def contributions(cell: str, weights: dict[str, float], single: Column) -> Column:
    """Array of (abs_z, feature, value, z, weight) of the features with a value."""
    rows = []
    for name, weight in weights.items():
        v = F.col(f"{cell}_{name}")
        z = F.when(single, (v - C.SINGLE_STATION_STATS[name][0]) / C.SINGLE_STATION_STATS[name][1]).otherwise(
            (v - C.QUIET_STATS[name][0]) / C.QUIET_STATS[name][1])
        rows.append(F.struct(F.abs(z).alias("abs_z"), F.lit(name).alias("feature"), v.alias("value"), z.alias("z"), F.lit(weight).alias("weight")))
    return F.filter(F.array(*rows), lambda s: s["value"].isNotNull())


def tier_cells(obs: DataFrame, stations: DataFrame, group: list[str], time: str = "obs_time", h2s: str = "h2s",
               primary: str = C.PRIMARY_STATION, backup: str = C.BACKUP_STATION, seconds: int = 7 * 86400, chunk_as: str | None = None) -> DataFrame:
    """One row per evaluation hour and horizon: gates, bellwether features, scores, labels.

    A station without rows in a window borrows the met window: the primary
    station's, or the backup's in a group without a primary.  Borrowed cells equal
    the met cell, so they only add to the number of stations that pass the first
    gate.  The bellwether is the primary's window, else the backup's.

    The windows of a group's only station count for all stations in gates and scores;
    labels (maxima, exceedances, first times) are those of its own readings.

    Readings and the groups' first and last hours are shuffled by group and time chunk; all
    that they open into is aggregated behind that exchange. ``chunk_as`` names a column for the time chunk, for what is done per
    group and chunk next without another exchange.
    """
    known = obs.join(stations.select("site_name"), "site_name", "left_semi")
    facts = group_facts(known, group, time, h2s, primary)
    chunk = lambda x: F.floor(x / F.lit(seconds))
    first, last, start = epoch(F.col("first_eval")), epoch(F.col("last_eval")), F.col("_chunk") * seconds
    # a group's hours are opened, as its readings are, behind the exchange by (group, chunk)
    due = facts.dropna(subset=group).filter("first_eval <= last_eval").select(
        *group, "has_primary", "n_active", F.lit(True).alias("_spine"), first.alias("_first"), last.alias("_last"),
        F.explode(F.sequence(chunk(first), chunk(last))).alias("_chunk"))
    rows = _readings(known, group, time, h2s, C.HORIZONS, seconds).join(facts.select(*group, "lone"), group)
    placed = spread(rows.unionByName(due, allowMissingColumns=True), [*group, "_chunk"], parts_for(known, TASK_BYTES))
    low = F.col("_first") + F.greatest(F.ceil((start - F.col("_first")) / 3600), F.lit(0)) * 3600
    high = F.least(F.col("_last"), start + (seconds - 1))
    hours = F.when(low <= high, F.sequence(low, high, F.lit(3600).cast("long")))
    steps = F.flatten(F.transform(hours, lambda e: F.array(*[F.struct(F.lit(n).alias("horizon"), e.alias("_e")) for n, _, _ in C.HORIZONS])))
    opened = placed.select("*", F.inline(F.when(F.col("_spine"), steps).otherwise(_hours_ahead(C.HORIZONS)))).filter(chunk(F.col("_e")) == F.col("_chunk"))
    cells = opened.groupBy(*group, "_chunk", "site_name", "_e", "horizon").agg(
        *_cell_values(), F.bool_or("lone").alias("lone"), F.bool_or("_spine").alias("_spine"), F.bool_or("has_primary").alias("has_primary"), F.max("n_active").alias("n_active"))
    # a lone station's windows stand for those of all stations
    total = stations.agg(F.count(F.lit(1))).scalar()
    named = lambda site: stations.agg(F.bool_or(F.col("site_name") == site)).scalar()
    cells = cells.withColumns({
        "_times": F.when(F.col("lone"), total).otherwise(F.lit(1)), **{
            f"_at_{site}": (F.col("site_name") == site) | (F.col("lone") & named(site)) for site in (primary, backup)}})
    c, times = F.col, F.col("_times")
    g1 = c("wind_speed_10m").isNotNull()
    g2 = truth(c("wind_speed_10m") < GATE_WIND)
    g3 = g2 & truth((c("temp_min") > GATE_TEMP) & (c("dewpoint_2m") > GATE_DEW) & (c("stable_atm") > GATE_STABLE))
    at = lambda site, col: F.max(F.when(c(f"`_at_{site}`"), c(col)))
    own = lambda site: F.max(F.when(c("site_name") == site, c("h2s_max")))
    keep = ["n", *MEANS, "wind_speed_min", "temp_min", "night_share", "h2s_max"]
    aggs = [
        F.coalesce(F.sum(F.when(c("site_name").isNotNull(), times)), F.lit(0)).alias("_present"), F.sum(flag(g1) * times).alias("_t1"),
        F.max(flag(g2)).alias("_g2"), F.max(flag(g3)).alias("_g3"),
        F.coalesce(F.max("h2s_max"), F.lit(0.0)).alias("any_max"), F.bool_or("_spine").alias("_due"),
        F.bool_or("has_primary").alias("has_primary"), F.max("n_active").alias("n_active"),
        *[at(primary, k).alias(f"p_{k}") for k in keep], *[at(backup, k).alias(f"b_{k}") for k in keep],
        own(primary).alias("p_own"), own(backup).alias("b_own"),
    ]
    for t, p in C.TIER_PPB:
        aggs += [F.sum(flag(c("h2s_max") >= p)).alias(f"exceeding_{t}"), F.min(f"first_{t}").alias(f"first_{t}")]
    d = cells.groupBy(*group, "_chunk", "_e", "horizon").agg(*aggs).filter("_due").withColumn("evaluated_at", F.timestamp_seconds("_e"))
    p_ok, b_ok = c("p_n").isNotNull(), c("b_n").isNotNull()
    met = lambda k: F.when(c("has_primary"), c(f"p_{k}")).otherwise(c(f"b_{k}"))
    n_t1 = c("_t1") + F.when(met("wind_speed_10m").isNotNull(), total - c("_present")).otherwise(0)
    least = F.least(F.lit(2), F.greatest(F.lit(1), c("n_active")))
    d = d.withColumn("n_t1", n_t1).withColumns({
        "gate_tier_1": c("n_t1") > 0,
        "gate_tier_2": (c("n_t1") >= least) & (F.coalesce(c("_g2"), F.lit(0)) == 1),
        "gate_tier_3": (c("n_t1") >= least) & (F.coalesce(c("_g3"), F.lit(0)) == 1),
        "degraded": ~c("has_primary"), "single_station_mode": c("n_active") <= 1,
        "daytime_horizon": truth(met("night_share") < 0.75),
        "primary_known": p_ok | (~c("has_primary") & b_ok), "bell_known": p_ok | b_ok,
        "primary_max": F.coalesce(c("p_own"), F.lit(0.0)), "backup_max": F.coalesce(c("b_own"), F.lit(0.0)),
        **{f"bell_{k}": F.when(p_ok, c(f"p_{k}")).otherwise(c(f"b_{k}")) for k in keep},
    })
    single = c("single_station_mode")
    return d.withColumns({f"score_{t}": score("bell", C.TIER_WEIGHTS[t], single) for t, _ in C.TIER_PPB}).select(
        *group, "evaluated_at", "horizon", *[f"gate_{t}" for t, _ in C.TIER_PPB], *[f"score_{t}" for t, _ in C.TIER_PPB], "n_t1", "n_active",
        "degraded", "single_station_mode", "daytime_horizon", "primary_known", "bell_known", "primary_max", "backup_max", "any_max",
        *[f"exceeding_{t}" for t, _ in C.TIER_PPB], *[f"first_{t}" for t, _ in C.TIER_PPB], *[f"bell_{k}" for k in keep],
        *([c("_chunk").alias(chunk_as)] if chunk_as else []))


def backtest(cells: DataFrame, group: list[str], threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Records per evaluation time, horizon and tier, with further columns ``keep`` of the cell; a tier fires only with its parent."""
    fires, above = [], F.lit(True)
    for t, _ in C.TIER_PPB:
        above = above & F.col(f"gate_{t}") & (F.col(f"score_{t}") >= threshold)
        fires.append(above)
    rows = F.array(*[F.struct(
        F.lit(t).alias("tier"), F.col(f"gate_{t}").alias("gate_passed"), F.round(F.col(f"score_{t}"), 4).alias("score"),
        fire.alias("fired"), F.col(f"exceeding_{t}").alias("n_stations_exceeding"),
        ((F.col(f"first_{t}") - epoch(F.col("evaluated_at"))) / 3600.0).alias("lead_time_hours"),
        (F.col("primary_max") >= PPB[t]).alias("primary_exceeds"),
    ) for (t, _), fire in zip(C.TIER_PPB, fires)])
    return cells.select(
        *group, "evaluated_at", "horizon", "daytime_horizon", "single_station_mode", "primary_max", "backup_max", "any_max", *(keep or []), F.inline(rows))


def firing_scores(df: DataFrame, keys: list[str], actual: Column) -> DataFrame:
    """Precision, recall, F1, mean lead time, events and fires per key."""
    return _firing(df.groupBy(*keys).agg(*_firing_sums(actual)))


def _firing_sums(actual: Column) -> list[Column]:
    f = F.col("fired")
    return [
        F.sum(flag(f & actual)).alias("tp"), F.sum(flag(f & ~actual)).alias("fp"), F.sum(flag(~f & actual)).alias("fn"),
        F.avg(F.when(f & actual, F.col("lead_time_hours"))).alias("mean_lead_time_h"), F.count(F.lit(1)).alias("n_rows"),
    ]


def _firing(d: DataFrame) -> DataFrame:
    tp, fp, fn = (F.col(x).cast("double") for x in ("tp", "fp", "fn"))
    zero = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return d.withColumns({
        "precision": zero(tp, tp + fp), "recall": zero(tp, tp + fn), "f1": zero(tp * 2, tp * 2 + fp + fn),
        "n_events": F.col("tp") + F.col("fn"), "n_fires": F.col("tp") + F.col("fp"),
    }).drop("tp", "fp", "fn")


def tier_report(records: DataFrame) -> DataFrame:
    """Monthly day / night rows and whole-period rows per tier and horizon, labelled by
    the primary station, in one pass over grouping sets."""
    d = records.withColumns({
        "month": F.date_format("evaluated_at", "yyyy-MM"), "period": F.when(F.col("daytime_horizon"), "day").otherwise("night")})
    sets = d.groupingSets([["tier", "month", "horizon", "period"], ["tier", "horizon"]], "tier", "month", "horizon", "period")
    return _firing(sets.agg(*_firing_sums(F.col("primary_exceeds")))).withColumns({
        "month": F.coalesce("month", F.lit("ALL")), "period": F.coalesce("period", F.lit("all"))})


def monthly_counts(report: DataFrame, tier: str = "tier_3") -> DataFrame:
    """Events and fires per month and the share of fires beyond the events."""
    m = report.filter((F.col("tier") == tier) & (F.col("month") != "ALL")).groupBy("month").agg(
        F.sum("n_events").alias("n_events"), F.sum("n_fires").alias("n_fires"))
    extra = F.col("n_fires") - F.least("n_events", "n_fires")
    return m.withColumn("far", F.when(F.col("n_fires") > 0, extra / F.col("n_fires")))


def f1_matrix(report: DataFrame, months: list[str]) -> DataFrame:
    """F1 per tier, horizon and period with one column per month."""
    return report.filter(F.col("month") != "ALL").groupBy("tier", "horizon", "period").pivot("month", months).agg(F.max("f1"))


def lead_times(records: DataFrame, tier: str = "tier_3") -> DataFrame:
    """Quartiles of the lead time of hits per horizon, all hits and night hits."""
    hits = records.filter((F.col("tier") == tier) & F.col("fired") & F.col("primary_exceeds"))
    both = hits.withColumn("part", F.explode(F.when(F.col("daytime_horizon"), F.array(F.lit("all"))).otherwise(F.array(F.lit("all"), F.lit("night")))))
    return quantiles(both, ["horizon", "part"], "lead_time_hours", {"q1": 0.25, "median": 0.5, "q3": 0.75})


def quiet_night_stats(cells: DataFrame, features: list[str] = MEANS) -> DataFrame:
    """Mean and sample deviation of the primary station's nowcast features over quiet local nights."""
    calm = cells.filter(
        (F.col("horizon") == "nowcast") & (night(F.col("evaluated_at"), "local") == 1) & (F.col("primary_max") < 1.0)
        & F.col("primary_known"))
    aggs = []
    for f in features:
        aggs += [F.avg(f"bell_{f}").alias(f"{f}__m"), F.stddev_samp(f"bell_{f}").alias(f"{f}__s")]
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}__m").alias("mean"), F.col(f"{f}__s").alias("std")) for f in features])
    return calm.agg(*aggs).select(F.inline(rows))


def top_contributors(cells: DataFrame, group: list[str], tier: str = "tier_3", n: int = 4) -> DataFrame:
    """The ``n`` features with the largest absolute z per evaluation time and horizon."""
    z = contributions("bell", C.TIER_WEIGHTS[tier], F.col("single_station_mode"))
    best = F.slice(F.reverse(F.array_sort(z)), 1, n)
    return cells.filter("bell_known").select(*group, "evaluated_at", "horizon", F.inline(best))
