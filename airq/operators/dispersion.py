"""Plume forecasts, footprints and emission tables over receptors and grids."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airq import catalog as C
from airq.functions import emission
from airq.functions import plume as P
from airq.operators.dims import as_array, pair_with, spread
from airq.operators.ordering import number_rows, row_windows, running_sums

#: Values of a raster that are computed at a time, and cells of a batch that a task gives out.
TILE, BATCH_CELLS = 1 << 16, 1 << 18


def point_sources(conditions: DataFrame) -> DataFrame:
    """Sewage sources under the given conditions and minor community sources by hour."""
    spark = conditions.sparkSession
    sewage = C.literal_table(spark, C.SEWAGE_SOURCES, "source string, lat double, lon double, mult double, dph double, fdo double")
    minor = C.literal_table(spark, C.MINOR_SOURCES, "source string, lat double, lon double, base double")
    c = F.col
    big = pair_with(conditions, sewage).withColumn("emission", emission.sulfide_production(
        c("flow") * c("mult"), c("temperature"), c("ph") + c("dph"), c("oxygen") * c("fdo"), c("tide"), c("lat"), c("lon")))
    small = pair_with(conditions, minor).withColumn("emission", c("base") * (F.sin(F.hour("obs_time") * math.pi / 12) * 0.2 + 1.0))
    keep = [*conditions.columns, "source", "lat", "lon", "emission"]
    return big.select(*keep).unionByName(small.select(*keep))


def channel_segments(points: DataFrame, spacing_m: float = 150.0, keys: list[str] | None = None, order: str = "ord") -> DataFrame:
    """Centroids about every ``spacing_m`` along the line through the ordered points.

    ``segment`` counts from 0 in channel order within the keys; ``order`` is a
    non-negative number.
    """
    keys = keys or []
    block = F.floor(F.col(order) / F.lit(4096))
    numbered = number_rows(points, keys, order, block=block)
    ends = row_windows(numbered, keys, 0, 1, lambda w: {"_la": F.lead("lat").over(w), "_lo": F.lead("lon").over(w)}).filter("_la IS NOT NULL")
    dy, dx = (F.col("_la") - F.col("lat")) * P.LAT_M, (F.col("_lo") - F.col("lon")) * P.LON_M
    n = F.greatest(F.lit(1), F.floor(F.sqrt(dx * dx + dy * dy) / spacing_m)).cast("int")
    upto = running_sums(ends.withColumn("_n", n).drop("seq", "total"), keys, order, {"_upto": "_n"}, block=block)
    steps = upto.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    t = (F.col("_k") + 0.5) / F.col("_n")
    return steps.select(
        *keys, (F.col("lat") + (F.col("_la") - F.col("lat")) * t).alias("source_lat"),
        (F.col("lon") + (F.col("_lo") - F.col("lon")) * t).alias("source_lon"), (F.col("_upto") - F.col("_n") + F.col("_k")).alias("segment"))


def n_segments(points: list[tuple[float, float]], spacing_m: float = 150.0) -> int:
    """How many centroids ``channel_segments`` makes of a fixed list of (lat, lon)."""
    legs = zip(points, points[1:])
    return sum(max(1, math.floor(math.hypot((b[0] - a[0]) * P.LAT_M, (b[1] - a[1]) * P.LON_M) / spacing_m)) for a, b in legs)


def receptor_met(met: DataFrame, receptors: DataFrame, group: list[str], ref_site: str = C.PRIMARY_STATION,
                 cadence_min: int = 60, start=None, hours: int | None = None, time: str = "obs_time") -> DataFrame:
    """Time spine per group and receptor with the receptor's met row, else the reference
    station's; hours without either stay with null met.

    The spine runs over the group's own span, or ``hours`` from its start.
    """
    first = F.min(time) if start is None else F.lit(start).cast("timestamp")
    spans = met.groupBy(*group).agg(first.alias("_a"), F.max(time).alias("_z"))
    if hours is not None:
        spans = spans.withColumn("_z", F.col("_a") + F.expr(f"INTERVAL {hours * 60 - cadence_min} MINUTES"))
    spine = spans.filter("_a <= _z").select(*group, F.explode(F.sequence("_a", "_z", F.expr(f"INTERVAL {cadence_min} MINUTES"))).alias(time))
    cols = ["wind_speed_10m", "wind_direction_10m", "temperature_2m", "is_night"]
    row = F.struct(*cols)
    own = met.select(*group, time, "site_name", row.alias("_own"))
    ref = met.filter(F.col("site_name") == ref_site).select(*group, time, row.alias("_ref"))
    wide = pair_with(spine, receptors).join(own, [*group, time, "site_name"], "left").join(ref, [*group, time], "left")
    return wide.withColumn("_m", F.coalesce("_own", "_ref")).drop("_own", "_ref").select("*", "_m.*").drop("_m")


def forward_model(met: DataFrame, sources: DataFrame, keys: list[str], min_rate: float = 0.0,
                  settings: P.PlumeSettings = P.PlumeSettings()) -> DataFrame:
    """(keys, predicted_ppb): the sum of the plumes of all ``sources``
    (source_lat, source_lon, rate) at (station_lat, station_lon); null without met.

    Sources below ``min_rate`` are dropped first.  Met rows are hashed by the keys, so
    the plumes of a row are evaluated and summed in one task without an exchange of
    met x source rows.
    """
    active = sources.filter(F.col("rate") >= min_rate if min_rate > 0 else F.col("rate") > 0).select("source_lat", "source_lon", "rate")
    d = P.add_plume(pair_with(P.with_wind_terms(spread(met, keys)), active), "station_lat", "station_lon", settings)
    return d.groupBy(*keys).agg(F.sum(P.to_ppb(F.col("_ug"), F.col("temperature_2m"))).alias("predicted_ppb"))


def grid_shape(bounds: tuple[float, float, float, float], resolution_m: float) -> tuple[int, int]:
    """Rows and columns of a grid over (south, north, west, east)."""
    south, north, west, east = bounds
    lon_m = C.METRES_PER_DEGREE * math.cos(math.radians((south + north) / 2))
    return round((north - south) * C.METRES_PER_DEGREE / resolution_m), round((east - west) * lon_m / resolution_m)


def on_grid(df: DataFrame, bounds=C.FORWARD_GRID_BOUNDS, resolution_m: float = 100.0) -> DataFrame:
    """Each row at every cell centre; cells come from arithmetic, not from a table."""
    rows, cols = grid_shape(bounds, resolution_m)
    return place_cells(df.withColumn("_cell", F.explode(F.sequence(F.lit(0), F.lit(rows * cols - 1)))), bounds, rows, cols)


def place_cells(d: DataFrame, bounds, rows: int, cols: int) -> DataFrame:
    """Row, column and centre of the cell number ``_cell``."""
    south, north, west, east = bounds
    d = d.withColumns({"row": F.floor(F.col("_cell") / cols), "col": F.col("_cell") % cols}).drop("_cell")
    return d.withColumns({
        "cell_lat": (F.col("row") + 0.5) * ((north - south) / rows) + south,
        "cell_lon": (F.col("col") + 0.5) * ((east - west) / cols) + west,
    })


def _span(centre, half, origin, step, count):
    """Numbers of the cells whose centres lie within ``half`` of a place, with a little room."""
    room = 1e-6
    first = F.greatest(F.ceil((centre - half - origin) / step - 0.5 - room), F.lit(0)).cast("int")
    last = F.least(F.floor((centre + half - origin) / step - 0.5 + room), F.lit(count - 1)).cast("int")
    return F.when(first <= last, F.sequence(first, last))


def rows_within(df: DataFrame, lat: str, lon: str, radius_m: float, keys: list[str], bounds=C.FORWARD_GRID_BOUNDS, resolution_m: float = 100.0) -> DataFrame:
    """Each row at every row of the grid that the circle around its point touches (``row, cell_lat``), hashed by (keys, row)."""
    south, north = bounds[:2]
    rows, _ = grid_shape(bounds, resolution_m)
    high = (north - south) / rows
    strips = df.withColumn("row", F.explode(_span(F.col(lat), F.lit(radius_m / P.LAT_M), south, high, rows)))
    return spread(strips, [*keys, "row"]).withColumn("cell_lat", (F.col("row") + 0.5) * high + south)


def cells_within(df: DataFrame, lat: str, lon: str, radius_m: float, keys: list[str], bounds=C.FORWARD_GRID_BOUNDS, resolution_m: float = 100.0) -> DataFrame:
    """Each row at every cell centre of the grid within ``radius_m`` of its point (``row, col, cell_lat, cell_lon``), and at hardly any other.

    A row first opens into the grid's rows that the circle touches, is hashed by (keys, row), and opens there into
    the columns between the circle's edges: the exchange carries strips, and what is opened grows with the circle and
    not with the grid. Edges have a little room, so a caller's own distance test decides. A
    point without a position, or whose circle misses the grid, has no cell.
    """
    _, _, west, east = bounds
    _, cols = grid_shape(bounds, resolution_m)
    wide = (east - west) / cols
    strips = rows_within(df, lat, lon, radius_m, keys, bounds, resolution_m)
    dy = (F.col("cell_lat") - F.col(lat)) * P.LAT_M
    half = F.sqrt(F.greatest(F.lit(radius_m * radius_m) - dy * dy, F.lit(0.0))) / P.LON_M
    d = strips.withColumn("col", F.explode(_span(F.col(lon), half, west, wide, cols)))
    return d.withColumn("cell_lon", (F.col("col") + 0.5) * wide + west)


def _add(total: np.ndarray | None, seen: np.ndarray, to: np.ndarray, values: np.ndarray | None, there: np.ndarray) -> None:
    """Add rows of values to the rows ``to``, which rise, and mark where there are any."""
    first = np.flatnonzero(np.diff(to, prepend=-1))
    if total is not None:
        total[to[first]] += np.add.reduceat(values, first, axis=0)
    seen[to[first]] |= np.logical_or.reduceat(there, first, axis=0)


def gridded_forecast(met: DataFrame, sources: DataFrame, sensors: DataFrame, keys: list[str], bounds=C.FORWARD_GRID_BOUNDS,
                     resolution_m: float = 100.0, scale: float = 0.1, clip_ppb: float = 500.0, lead_h: str | None = None,
                     block_cells: int = 4096) -> DataFrame:
    """Long raster (keys, row, col, ppb, confidence): one row per frame and cell.

    Frames are copied once per block of cells and hashed by frame and block; met rows of a frame meet there, and
    a task computes the block's cells under all sources as arrays. The exchange carries met
    rows only, and no task works on a whole frame of a large grid.
    """
    src = as_array(sources.filter("rate > 0").select("source_lat", "source_lon", (F.col("rate") * scale).alias("rate")), "_src")
    near = as_array(sensors.select("station_lat", "station_lon"), "_near")
    lead = F.col(lead_h) if lead_h else F.lit(0.0)
    rows, cols = grid_shape(bounds, resolution_m)
    south, north, west, east = bounds
    blocks = -(-rows * cols // block_cells)
    terms = {"u": F.col("_u"), "v": F.col("_v"), "ws": F.col("_ws"), "ay": F.col("_ay"), "az": F.col("_az"), "ppb": P.to_ppb(F.lit(1.0), F.col("temperature_2m")), "lead": lead}
    d = met.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    d = P.with_wind_terms(spread(d, [*keys, "_block"]))
    d = d.groupBy(*keys, "_block").agg(F.collect_list(F.struct(*[c.cast("double").alias(k) for k, c in terms.items()])).alias("_met"))
    names = list(terms)
    d = pair_with(pair_with(d, src.filter(F.size("_src") > 0)), near)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            block, n = batch.column("_block").to_numpy(), batch.column("_met").value_lengths().to_numpy()
            start, flat = np.cumsum(n) - n, batch.column("_met").flatten()
            t = {k: flat.field(k).to_numpy(zero_copy_only=False)[:, None, None] for k in names}
            point = lambda c, k: np.array([np.nan if x[k] is None else x[k] for x in batch.column(c)[0].as_py()])
            la, lo, rate, s_la, s_lo = (point(*x)[:, None] for x in (("_src", "source_lat"), ("_src", "source_lon"), ("_src", "rate"), ("_near", "station_lat"), ("_near", "station_lon")))
            for b in np.unique(block):
                cell = np.arange(b * block_cells, min((b + 1) * block_cells, rows * cols))
                row, col = cell // cols, cell % cols
                lat, lon = (row + 0.5) * ((north - south) / rows) + south, (col + 0.5) * ((east - west) / cols) + west
                dy, dx = (lat - la) * P.LAT_M, (lon - lo) * P.LON_M
                placed = ~np.isnan(dy[:, 0] + dx[:, 0])
                apart = np.sqrt(((lat - s_la) * P.LAT_M) ** 2 + ((lon - s_lo) * P.LON_M) ** 2)
                apart = np.fmin.reduce(apart, axis=0, initial=np.nan)
                frames = np.flatnonzero(block == b)
                for at in range(0, len(frames), max(1, BATCH_CELLS // len(cell))):
                    own = frames[at : at + max(1, BATCH_CELLS // len(cell))]
                    of = np.repeat(np.arange(len(own)), n[own])
                    rows_ = np.concatenate([np.arange(start[k], start[k] + n[k]) for k in own])
                    total, known = np.zeros((len(own), len(cell))), np.zeros((len(own), len(cell)), dtype=bool)
                    step = max(1, TILE // (max(1, placed.sum()) * len(cell)))
                    for k in range(0, len(rows_), step):
                        m = rows_[k : k + step]
                        ug = P.plume_values(dx[placed], dy[placed], rate[placed], *[t[x][m] for x in ("u", "v", "ws", "ay", "az")], P.PlumeSettings(floor_km=P.GRID_FLOOR_KM))
                        part = ug * t["ppb"][m]
                        there = ~np.isnan(part)
                        _add(total, known, of[k : k + step], np.where(there, part, 0.0).sum(axis=1), there.any(axis=1))
                    first = t["lead"][start[own], 0]
                    out = {"row": np.tile(row, len(own)), "col": np.tile(col.astype(np.int32), len(own)),
                           "ppb": np.where(known, np.minimum(total, clip_ppb), clip_ppb).ravel(), "confidence": P.confidence_values(apart, first).ravel()}
                    again = pa.array(np.repeat(own, len(cell)))
                    yield pa.RecordBatch.from_arrays([*[batch.column(x).take(again) for x in keys], *map(pa.array, out.values())], [*keys, *out])

    schema = StructType([met.schema[k] for k in keys]).add("row", "long").add("col", "integer").add("ppb", "double").add("confidence", "double")
    return d.mapInArrow(run, schema)


def downsample_frames(frames: DataFrame, group: list[str], minutes: int = 60, time: str = "obs_time") -> DataFrame:
    """Per-cell maximum of ppb and confidence over windows of ``minutes``."""
    return frames.groupBy(*group, F.window(time, f"{minutes} minutes")["start"].alias("frame_time"), "row", "col").agg(
        F.max("ppb").alias("ppb"), F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("n_samples"))


def frame_arrays(frames: DataFrame, keys: list[str]) -> DataFrame:
    """One row per frame with the raster as an array of rows, for the sink only."""
    line = frames.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(F.struct("col", "ppb"))).alias("_c"))
    return line.withColumn("_v", F.transform("_c", lambda x: x["ppb"])).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("row", "_v"))).alias("_r")).select(*keys, F.transform("_r", lambda x: x["_v"]).alias("data"))


def river_grid(conditions: DataFrame, keys: list[str], bounds=C.FORWARD_GRID_BOUNDS, resolution_m: float = 100.0, radius_km: float = 8.0) -> DataFrame:
    """Smell intensity per cell from the river sources under given flow, tide,
    temperature and wind, distances stretched along the wind; cells beyond the
    radius of every point are absent. Points meet by grid row behind one exchange, where a
    task computes the row's cells as arrays."""
    spark = conditions.sparkSession
    pts = [(n, k, b, int(f), int(t), la, lo) for n, k, b, f, t, xy in C.RIVER_SOURCES for la, lo in xy]
    src = C.literal_table(spark, pts, "source string, kind string, base double, fd int, td int, source_lat double, source_lon double")
    d = pair_with(conditions, src)
    d = d.withColumn("_e", emission.river_strength(
        F.col("base"), F.col("kind"), F.col("fd") == 1, F.col("td") == 1, F.col("flow"), F.col("tide"), F.col("temperature"))).filter("_e > 0")
    d = rows_within(d, "source_lat", "source_lon", radius_km * 1000.0, keys, bounds, resolution_m)
    terms = {"lat": F.col("source_lat"), "lon": F.col("source_lon"), "e": F.col("_e") * F.when(F.col("kind") == "channel", 1.2).otherwise(1.0),
             "from": F.radians(F.col("wind_direction") + 180.0), "ws": F.col("wind_speed")}
    d = d.groupBy(*keys, "row").agg(F.collect_list(F.struct(*[c.cast("double").alias(k) for k, c in terms.items()])).alias("_strips"))
    names = list(terms)
    south, north, west, east = bounds
    rows, cols = grid_shape(bounds, resolution_m)
    lon = (np.arange(cols) + 0.5) * ((east - west) / cols) + west

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            row, n = batch.column("row").to_numpy(), batch.column("_strips").value_lengths().to_numpy()
            start, flat = np.cumsum(n) - n, batch.column("_strips").flatten()
            t = {k: flat.field(k).to_numpy(zero_copy_only=False)[:, None] for k in names}
            lat = np.repeat((row + 0.5) * ((north - south) / rows) + south, n)[:, None]
            step = max(1, TILE // cols)
            for at in range(0, len(row), step):
                own = np.arange(at, min(at + step, len(row)))
                total, known, inside = np.zeros((len(own), cols)), np.zeros((len(own), cols), dtype=bool), np.zeros((len(own), cols), dtype=bool)
                of = np.repeat(np.arange(len(own)), n[own])
                low, end = start[own[0]], start[own[-1]] + n[own[-1]]
                for k in range(low, end, step):
                    m = slice(k, min(k + step, end))
                    dx, dy = (lon - t["lon"][m]) * P.LON_M, (lat[m] - t["lat"][m]) * P.LAT_M
                    km, al = np.sqrt(dx * dx + dy * dy) / 1000.0, np.cos(np.arctan2(dx, dy) - t["from"][m])
                    sigma = np.where(al > 0, km * 0.1 + 0.5, 0.4)
                    eff = np.where(al > 0, km / np.where(al > 0, al * t["ws"][m] / 10.0 + 1.0, 1.0), km * 3.0)
                    near = km <= radius_km
                    conc = np.where(near, t["e"][m] * np.exp(-(eff * eff) / (sigma * sigma * 2.0)), np.nan)
                    there, to = ~np.isnan(conc), of[m.start - low : m.stop - low]
                    _add(total, known, to, np.where(there, conc, 0.0), there)
                    _add(None, inside, to, None, near)
                r, col = np.nonzero(inside)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(x).take(pa.array(own[r])) for x in (*keys, "row")], pa.array(col.astype(np.int32)), pa.array(total[r, col], mask=~known[r, col])],
                    [*keys, "row", "col", "emission"])

    schema = StructType([conditions.schema[k] for k in keys]).add("row", "integer").add("col", "integer").add("emission", "double")
    return d.mapInArrow(run, schema)


def zone_rates(fractions: DataFrame, keys: list[str], total: float = C.TOTAL_RATE) -> DataFrame:
    """Rates per zone and per source from source fractions, scaled to ``total``."""
    pairs = [(s, z) for z, names in C.ZONE_OF_SOURCE.items() for s in names]
    zone = F.create_map(*[F.lit(v) for p in pairs for v in p])[F.col("source")]
    w = W.partitionBy(*(keys or [F.lit(0)]))
    share = F.col("fraction") / F.when(F.sum("fraction").over(w) > 0, F.sum("fraction").over(w)).otherwise(1.0)
    d = fractions.withColumns({"zone": zone, "source_rate": share * total})
    return d.withColumn("zone_rate", F.sum("source_rate").over(W.partitionBy(*keys, "zone")))


def default_rates(spark) -> DataFrame:
    """Zone defaults split evenly over the sources of each zone."""
    at = dict((n, (la, lo)) for n, la, lo in C.SOURCES)
    rates = dict(C.ZONE_RATES)
    rows = [(s, *at[s], rates[z] / len(names)) for z, names in C.ZONE_OF_SOURCE.items() for s in names]
    return C.literal_table(spark, rows, "source string, source_lat double, source_lon double, rate double")


def residence_histogram(positions: DataFrame, keys: list[str], grid=C.FOOTPRINT_GRID, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Share of positions per grid cell; positions outside the grid are ignored.

    Counts are merged on the map side, so a key never holds more than its cells.
    """
    south, north, west, east, rows, cols = grid
    r = F.floor((F.col(lat) - south) / ((north - south) / rows))
    c = F.floor((F.col(lon) - west) / ((east - west) / cols))
    cells = positions.withColumns({"row": r, "col": c}).filter(
        F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1)).groupBy(*keys, "row", "col").agg(F.count(F.lit(1)).alias("_n"))
    return cells.withColumn("density", F.col("_n") / F.sum("_n").over(W.partitionBy(*keys))).drop("_n")


def cell_centre(grid=C.FOOTPRINT_GRID):
    south, north, west, east, rows, cols = grid
    return ((F.col("row") + 0.5) * ((north - south) / rows) + south, (F.col("col") + 0.5) * ((east - west) / cols) + west)


def combine_footprints(footprints: DataFrame, readings: DataFrame, event: list[str], sensor: str = "site_name", h2s: str = "h2s",
                       background: float = 1.0) -> DataFrame:
    """Per event the footprints weighted by ppb above background, normalised."""
    weights = readings.select(*event, sensor, F.greatest(F.col(h2s) - background, F.lit(0.0)).alias("_w"))
    cells = footprints.join(weights, [*event, sensor]).groupBy(*event, "row", "col").agg(F.sum(F.col("_w") * F.col("density")).alias("_d"))
    whole = F.sum("_d").over(W.partitionBy(*event))
    return cells.withColumn("density", F.when(whole > 0, F.col("_d") / whole).otherwise(0.0)).drop("_d")


def ensemble_footprint(combined: DataFrame, event: list[str]) -> DataFrame:
    """Mean over events (an absent cell counts as zero), normalised."""
    n = combined.select(*event).distinct().agg(F.count(F.lit(1))).scalar()
    cells = combined.groupBy("row", "col").agg((F.sum("density") / n).alias("_d"))
    # one row per grid cell: the window holds the grid
    whole = F.sum("_d").over(W.partitionBy(F.lit(0)))
    return cells.withColumn("density", F.when(whole > 0, F.col("_d") / whole).otherwise(0.0)).drop("_d")


def kernel_attribution(footprint: DataFrame, sources: DataFrame, keys: list[str], kernel_m: float = 500.0, uniform: bool = False) -> DataFrame:
    """Fraction per source: footprint mass under a Gaussian kernel around it, normalised;
    without any mass nothing, or with ``uniform`` equal shares."""
    lat, lon = cell_centre()
    d = pair_with(footprint.withColumns({"_la": lat, "_lo": lon}), sources.select("source", "source_lat", "source_lon"))
    y = (F.col("_la") - F.col("source_lat")) / (kernel_m / P.LAT_M)
    x = (F.col("_lo") - F.col("source_lon")) / (kernel_m / P.LON_M)
    mass = d.groupBy(*keys, "source").agg(F.sum(F.col("density") * F.exp((y * y + x * x) * -0.5)).alias("_m"))
    w = W.partitionBy(*(keys or [F.lit(0)]))
    total = F.sum("_m").over(w)
    other = F.lit(1.0) / F.count(F.lit(1)).over(w) if uniform else F.lit(0.0)
    return mass.withColumn("fraction", F.when(total > 0, F.col("_m") / total).otherwise(other)).drop("_m")


def fraction_rates(fractions: DataFrame, readings: DataFrame, event: list[str], h2s: str = "h2s", background: float = 1.0,
                   calibration: float = 1.4, least: float = 0.02) -> DataFrame:
    """Rate per source: mean ppb above background over the elevated sensors x fraction x calibration."""
    up = F.col(h2s) - background
    eff = readings.groupBy(*event).agg(F.avg(F.when(up > 0, up)).alias("_c"))
    return fractions.filter(F.col("fraction") >= least).join(eff, event).filter("_c > 0").withColumn(
        "rate", F.col("_c") * F.col("fraction") * calibration).drop("_c")


def resample_footprint(footprint: DataFrame, keys: list[str], bounds=C.FORWARD_GRID_BOUNDS, resolution_m: float = 100.0) -> DataFrame:
    """Footprint on the forward grid by nearest source cell, normalised; sparse, an
    absent cell is zero."""
    spark = footprint.sparkSession
    south, north, west, east, rows, cols = C.FOOTPRINT_GRID
    h, w = (north - south) / rows, (east - west) / cols
    grid = on_grid(spark.range(1).select(), bounds, resolution_m)
    inside = F.col("cell_lat").between(south + h / 2, north - h / 2) & F.col("cell_lon").between(west + w / 2, east - w / 2)
    near = grid.filter(inside).select(
        F.col("row").alias("to_row"), F.col("col").alias("to_col"),
        F.floor((F.col("cell_lat") - south) / h).alias("row"), F.floor((F.col("cell_lon") - west) / w).alias("col"))
    d = footprint.join(near, ["row", "col"]).select(*keys, F.col("to_row").alias("row"), F.col("to_col").alias("col"), "density")
    whole = F.sum("density").over(W.partitionBy(*(keys or [F.lit(0)])))
    return d.withColumn("density", F.when(whole > 0, F.col("density") / whole).otherwise(0.0))


def look_back_hours(mean_wind, domain_m: float = 6000.0, lo: float = 0.5, hi: float = 4.0):
    """Hours a mean wind needs to cross the domain, clamped."""
    t = F.lit(domain_m) / F.greatest(mean_wind, F.lit(0.3)) / 3600.0
    return F.least(F.greatest(t, F.lit(lo)), F.lit(hi))
