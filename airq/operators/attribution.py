"""Attribution of readings to sources, joins of the daily analysis, summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions import geo
from airq.functions.clock import night
from airq.operators.dims import pair_with
from airq.operators.ordering import earliest, fill_missing, latest, meet
from airq.operators.ranks import medians, quantiles
from airq.session import materialize

MIXED, UNALIGNED = "Daytime (mixed)", "Unaligned"


def station_geometry(stations: DataFrame, sources: DataFrame) -> DataFrame:
    """Per station its coordinates and ``near``: bearing and distance of every source, in
    the order of ``ord`` or else of the sources' names."""
    ordered = sources if "ord" in sources.columns else sources.withColumn("ord", F.struct("source", "source_lat", "source_lon"))
    g = [F.col(c) for c in ("station_lat", "station_lon", "source_lat", "source_lon")]
    pairs = pair_with(stations, ordered).select(
        "site_name", "station_lat", "station_lon",
        F.struct("ord", "source", geo.bearing(*g).alias("bearing"), geo.distance_km(*g).alias("km")).alias("s"))
    return pairs.groupBy("site_name", "station_lat", "station_lon").agg(F.array_sort(F.collect_list("s")).alias("near"))


def aligned_source(df: DataFrame, stations: DataFrame, sources: DataFrame, threshold: float = 30.0,
                   wind_dir: str = "wind_direction_10m", is_night: str = "is_night") -> DataFrame:
    """Add ``aligned_source`` and ``source_distance_km``: the source whose bearing from
    the station is nearest to the wind direction, if within ``threshold``.

    Bearings are worked out once per station and joined by its name; a name with several
    places gives a row for each.  Unknown stations are dropped.
    """
    geometry = station_geometry(stations, sources)
    placed = df.join(geometry.select("site_name", F.col("near").alias("_near")), "site_name")
    off = lambda s: F.abs(geo.angular_difference(F.col(wind_dir), s["bearing"]))
    best = placed.withColumn("_b", F.array_min(F.transform("_near", lambda s: F.struct(
        off(s).alias("off"), s["ord"].alias("ord"), s["source"].alias("source"), s["km"].alias("km")))))
    near = (F.col(is_night) == 1) & (F.col("_b.off") < threshold)
    label = (
        F.when(F.coalesce(F.col(is_night), F.lit(0)) == 0, MIXED).when(near, F.col("_b.source")).otherwise(UNALIGNED)
    )
    return best.withColumns({
        "aligned_source": label, "source_distance_km": F.when(near, F.col("_b.km")),
    }).drop("_b", "_near")


def attribute_sources(obs: DataFrame, stations: DataFrame, sources: DataFrame, h2s: str = "h2s",
                      wind: str = "wind_speed_10m") -> DataFrame:
    """Aligned source per reading and, above 2 ppb, the emission rate that explains it."""
    placed = aligned_source(obs, stations, sources)
    rate = geo.back_rate(F.col(h2s), F.col(wind), F.col("source_distance_km") * 1000.0)
    return placed.withColumn("emission_rate_gs", F.when(F.col(h2s) > 2, rate))


def active_sources(attributed: DataFrame, keys: list[str], h2s: str = "h2s") -> DataFrame:
    """Per source: hours above 5 ppb, mean and maximum h2s, median emission rate."""
    # written once: counts and medians both read it, and the alignment is not repeated in their filters
    rows = materialize(attributed.select(*keys, h2s, "aligned_source", "emission_rate_gs"), "attributed")
    up = rows.filter((F.col(h2s) > 5) & ~F.col("aligned_source").isin(UNALIGNED, MIXED))
    k = [*keys, "aligned_source"]
    stats = up.groupBy(*k).agg(F.count(F.lit(1)).alias("hours"), F.avg(h2s).alias("mean_h2s"), F.max(h2s).alias("max_h2s"))
    return meet(stats, quantiles(up, k, "emission_rate_gs", {"median_rate": 0.5}), k, "left")


def top_sources(attributed: DataFrame, keys: list[str], n: int = 6) -> DataFrame:
    """The ``n`` most frequent aligned sources per key."""
    counts = attributed.filter(~F.col("aligned_source").isin(UNALIGNED, MIXED)).groupBy(*keys, "aligned_source").agg(
        F.count(F.lit(1)).alias("hours"))
    w = W.partitionBy(*keys).orderBy(F.desc("hours"), "aligned_source")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def probability_surface(obs: DataFrame, stations: DataFrame, bounds: tuple[float, float, float, float], step: float,
                        least_ppb: float = 10.0, h2s: str = "h2s") -> DataFrame:
    """Likelihood surface of source positions from night readings above ``least_ppb``.

    Each reading adds a direction, distance and magnitude weight to each cell; the
    map side folds readings into one sum per cell before the shuffle.
    """
    south, north, west, east = bounds
    rows, cols = math.ceil((north - south) / step - 1e-9), math.ceil((east - west) / step - 1e-9)
    up = obs.filter((F.col("is_night") == 1) & (F.col(h2s) > least_ppb)).join(stations, "site_name").select(
        "station_lat", "station_lon", F.coalesce("wind_direction_10m", F.lit(0.0)).alias("wd"),
        F.coalesce("wind_speed_10m", F.lit(1.0)).alias("ws"), F.col(h2s).alias("ppb"))
    cell = up.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(rows * cols - 1))))
    dlat = F.floor(F.col("cell") / cols) * step + south - F.col("station_lat")
    dlon = F.col("cell") % cols * step + west - F.col("station_lon")
    cell = cell.withColumns({"dlat": dlat, "dlon": dlon})
    dlat, dlon = F.col("dlat"), F.col("dlon")
    off = geo.angular_difference(F.pmod(F.degrees(F.atan2(dlon, dlat)), F.lit(360.0)), F.col("wd"))
    scaled = dlon * F.cos(F.radians("station_lat"))
    dist = F.sqrt(dlat * dlat + scaled * scaled)
    reach = F.greatest(F.col("ws") * 3600.0 / 111000.0, F.lit(0.005)) * 0.3
    weight = (
        F.exp(F.pow(off / 15.0, F.lit(2.0)) * -0.5) * F.log1p("ppb") * F.exp(F.pow((dist - reach) / 0.015, F.lit(2.0)) * -0.5)
    )
    total = cell.groupBy("cell").agg(F.sum(weight).alias("w"))
    # one row per grid cell from here on: the window holds the grid, not the readings
    top = F.max("w").over(W.partitionBy(F.lit(0)))
    return total.select(
        F.floor(F.col("cell") / cols).alias("row"), (F.col("cell") % cols).alias("col"),
        F.when(top > 0, F.col("w") / top).otherwise(F.col("w")).alias("probability"))


def attach_hour(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
                cols: list[str], tie: list[str]) -> DataFrame:
    """Left equi-join on the floored hour, the right side reduced to its first row per hour."""
    one = earliest(right.withColumn("hour_key", F.date_trunc("hour", right_time)).select(*keys, "hour_key", *tie, *cols),
                   [*keys, "hour_key"], tie, keep=cols)
    return left.withColumn("hour_key", F.date_trunc("hour", left_time)).join(one, [*keys, "hour_key"], "left")


def fill_from_profile(df: DataFrame, value: str, time: str = "obs_time", keys: list[str] | None = None) -> DataFrame:
    """Missing ``value`` becomes the median of its month and hour, else the overall median."""
    keys = keys or []
    dated = df.withColumns({"_m": F.month(time), "_h": F.hour(time)})
    profile = quantiles(dated, [*keys, "_m", "_h"], value, {"_p": 0.5})
    overall = medians(df, [], [value])
    return dated.join(profile, [*keys, "_m", "_h"], "left").withColumn(
        value, F.coalesce(F.col(value), F.col("_p"), overall.select(value).scalar())).drop("_m", "_h", "_p")


def replicate_stations(df: DataFrame, stations: DataFrame, group: list[str]) -> DataFrame:
    """Where a group has fewer than two stations, copy its rows to the absent ones."""
    present = df.select(*group, "site_name").distinct()
    lone = present.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < 2).drop("_n")
    absent = pair_with(lone, stations.select("site_name")).join(present, [*group, "site_name"], "left_anti")
    copies = df.drop("site_name").join(lone, group, "left_semi").join(absent, group).select(*df.columns)
    return df.unionByName(copies)


def primary_or_backup(df: DataFrame, keys: list[str], cols: list[str], primary: str = C.PRIMARY_STATION,
                      backup: str = C.BACKUP_STATION) -> DataFrame:
    """Per key the values of the primary station, else of the backup (then ``degraded``)."""
    def at(site, c):
        return F.max(F.when(F.col("site_name") == site, F.col(c)))

    seen = F.max((F.col("site_name") == primary).cast("int")) == 1
    return df.filter(F.col("site_name").isin(primary, backup)).groupBy(*keys).agg(
        *[F.when(seen, at(primary, c)).otherwise(at(backup, c)).alias(c) for c in cols], (~seen).alias("degraded"))


def ensemble(variants: list[DataFrame], keys: list[str]) -> DataFrame:
    """Mean class probabilities over models; ties in the order green, yellow, orange."""
    rows = variants[0]
    for v in variants[1:]:
        rows = rows.unionByName(v)
    cols = ["probability_green", "probability_yellow", "probability_orange"]
    m = rows.groupBy(*keys).agg(*[(F.sum(F.coalesce(c, F.lit(0.0))) / F.count(F.lit(1))).alias(c) for c in cols],
                                F.count(F.lit(1)).alias("n_models"))
    top = F.greatest(*cols)
    g, y = F.col(cols[0]), F.col(cols[1])
    said = F.when(g == top, "green").when(y == top, "yellow").otherwise("orange")
    return m.withColumns({"predicted_category": said, "confidence": top}).withColumn(
        "alert", F.col("predicted_category").isin("yellow", "orange"))


def attach_latest(readings: DataFrame, context: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The newest context row per key beside every reading."""
    return readings.join(latest(context.select(*keys, *order, *cols), keys, order, keep=cols), keys, "left")


def interpolate_wind(met: DataFrame, times: DataFrame, keys: list[str], met_time: str, at: str) -> DataFrame:
    """Wind components at each row of ``times``, linear between the neighbouring met
    rows and held constant beyond both ends."""
    from airq.functions.plume import wind_u, wind_v

    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    point = F.struct(us(met_time).alias("t"), wind_u(F.col("wind_speed_10m"), F.col("wind_direction_10m")).alias("u"),
                     wind_v(F.col("wind_speed_10m"), F.col("wind_direction_10m")).alias("v"))
    m = met.filter("wind_speed_10m IS NOT NULL AND wind_direction_10m IS NOT NULL").select(
        *keys, F.col(met_time).cast("timestamp").alias("_at"), F.lit(0).alias("_kind"), point.alias("_p"))
    q = times.select(*keys, F.col(at).cast("timestamp").alias("_at"), F.lit(1).alias("_kind"), F.struct(*times.columns).alias("_q"))
    line = m.unionByName(q, allowMissingColumns=True).withColumn("_n", F.col("_p"))
    both = fill_missing(line, keys, "_at", ["_p"], tie=["_kind"])
    both = fill_missing(both, keys, "_at", ["_n"], forward=False, tie=["_kind"])
    got = both.filter("_kind = 1")
    span = F.col("_n.t") - F.col("_p.t")
    share = F.when(span > 0, (us("_at") - F.col("_p.t")) / span).otherwise(0.0)

    def lerp(x):
        a, b = F.col(f"_p.{x}"), F.col(f"_n.{x}")
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + (b - a) * share)

    return got.select("_q.*", F.coalesce(lerp("u"), F.lit(0.0)).alias("wind_u"), F.coalesce(lerp("v"), F.lit(0.0)).alias("wind_v"))


def merge_models(models: list[tuple[str, DataFrame]], keys: list[str], value: str = "predicted_ppb") -> DataFrame:
    """The larger prediction per key and the model it comes from; a tie keeps the first model."""
    rows = None
    for rank, (name, df) in enumerate(models):
        part = df.select(*keys, F.coalesce(F.col(value), F.lit(0.0)).alias(value), F.lit(name).alias("model"), F.lit(-rank).alias("_r"))
        rows = part if rows is None else rows.unionByName(part)
    return latest(rows, keys, [value, "_r"], keep=[value, "model"])


def lookahead_alerts(merged: DataFrame, start: Column, hours: int = 6, time: str = "obs_time", value: str = "predicted_ppb") -> DataFrame:
    """WATCH / CRITICAL rows of the first ``hours`` after ``start`` (end included)."""
    tier = F.when(F.col(value) >= C.CRITICAL_PPB, "CRITICAL").when(F.col(value) >= C.WATCH_PPB, "WATCH")
    return merged.filter(F.col(time) <= start + F.expr(f"INTERVAL {hours} HOURS")).withColumn("tier", tier).filter("tier IS NOT NULL")


def spill_hours(obs: DataFrame, spills: DataFrame, keys: list[str], time: str = "obs_time") -> DataFrame:
    """Readings inside a spill interval (whole days), joined day by day."""
    days = spills.withColumn("day", F.explode(F.sequence("start_date", "end_date")))
    return obs.withColumn("day", F.to_date(time)).join(days, [*keys, "day"])


def station_summary(df: DataFrame, keys: list[str], h2s: str = "h2s", time: str = "obs_time") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.max(time).alias("last_time"), F.max(F.struct(time, h2s))[h2s].alias("last_h2s"), F.avg(h2s).alias("mean_24h"),
        F.max(h2s).alias("max_24h"), (F.avg(F.when(F.col(h2s) > 5, 1.0).otherwise(0.0)) * 100).alias("pct_exceed_5"))


def forecast_rollup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Maxima and hours per risk tier."""
    hours = lambda r: F.count(F.when(F.col("risk") == r, 1)).alias(f"hours_{r.lower()}")
    return df.groupBy(*keys).agg(
        F.max("h2s_pred").alias("max_h2s"), F.max("prob_5").alias("max_prob_5"), F.max("prob_10").alias("max_prob_10"),
        *[hours(r) for r in ("ORANGE", "YELLOW_HIGH", "YELLOW_LOW", "GREEN")])


def with_night(df: DataFrame, time: str = "obs_time") -> DataFrame:
    return df.withColumn("is_night", night(F.col(time)))
