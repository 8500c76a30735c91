"""Plume forecasts, rasters, footprints, inversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions import plume as P
from airq.operators import dispersion as D
from airq.operators import inversion as V
from airq.operators.features import SITE
from airq.operators.ordering import latest
from airq.plans.daily_queries import SOURCES_SQL, STATIONS_SQL, values
from airq.plans.registry import query

LON_M, LAT_M = f"CAST({P.LON_M!r} AS DOUBLE)", "CAST(111320.0 AS DOUBLE)"


def stab_sql(ws: str, night: str) -> str:
    return (f"CASE WHEN {night} = 1 THEN CASE WHEN {ws} < 2 THEN 'F' WHEN {ws} < 3 THEN 'E' ELSE 'D' END "
            f"ELSE CASE WHEN {ws} < 2 THEN 'B' WHEN {ws} < 5 THEN 'C' ELSE 'D' END END")


AY = "CASE stab " + " ".join(f"WHEN '{s}' THEN {y}" for s, y, _ in C.PLUME_COEFFICIENTS) + " END"
AZ = "CASE stab " + " ".join(f"WHEN '{s}' THEN {z}" for s, _, z in C.PLUME_COEFFICIENTS) + " END"


def wind_sql(src: str) -> str:
    """Rows of ``src`` with u, v, ws, ay, az."""
    return (f"(SELECT *, CAST({AY} AS DOUBLE) AS ay, CAST({AZ} AS DOUBLE) AS az, sqrt(u * u + v * v) AS ws FROM (SELECT *, "
            f"-wind_speed_10m * sin(radians(wind_direction_10m)) AS u, -wind_speed_10m * cos(radians(wind_direction_10m)) AS v, "
            f"{stab_sql('wind_speed_10m', 'is_night')} AS stab FROM {src}))")


def plume_sql(src: str, rlat: str, rlon: str, q: str = "rate", floor: float = 0.1) -> str:
    """A derived table adding ``ug`` to the paired rows of ``src``."""
    return f"""(SELECT * EXCLUDE (dx, dy, along, cross_m, kmx), CASE WHEN ws < 0.1 THEN {q} * 1e6 / (pow(greatest(sqrt(dx * dx + dy * dy), 50), 2) * 50)
   WHEN along <= 0 THEN 0 ELSE {q} * 1e6 / (pi() * greatest(ws, 0.3) * sqrt(pow(ay * kmx, 2) + pow(radians(20) * along, 2)) * az * kmx)
     * exp(-0.5 * cross_m * cross_m / (pow(ay * kmx, 2) + pow(radians(20) * along, 2)))
     * (exp(-0.5 * pow((1.5 - 2.0) / (az * kmx), 2)) + exp(-0.5 * pow((1.5 + 2.0) / (az * kmx), 2))) END AS ug
  FROM (SELECT *, pow(greatest(along / 1000, {floor}), 0.894) * 1000 AS kmx FROM (
    SELECT *, (dx * u + dy * v) / nullif(ws, 0) AS along, (u * dy - v * dx) / nullif(ws, 0) AS cross_m FROM (
      SELECT *, ({rlon} - source_lon) * {LON_M} AS dx, ({rlat} - source_lat) * {LAT_M} AS dy FROM {src}))))"""


PPB = "(24.45 * (273.15 + temperature_2m) / 293.15 / 34.08)"
RATES_SQL = values([(n, la, lo, q) for (n, la, lo), (_, q) in zip(C.ZONES, C.ZONE_RATES)], "source, source_lat, source_lon, rate")


def zone_sources(spark):
    return C.literal_table(spark, [(n, la, lo, q) for (n, la, lo), (_, q) in zip(C.ZONES, C.ZONE_RATES)],
                           "source string, source_lat double, source_lon double, rate double")


@query("e19_e24_plume_terms", "E19 E20 E22 E23 E24", "network:i site_name:s obs_time:t stab:s sy:d sz:d u:d v:d ppb:d conf:d", f"""
SELECT *, ay * pow(greatest(k2, 0.1), 0.894) * 1000 AS sy, az * pow(greatest(k2, 0.1), 0.894) * 1000 AS sz, 100 * {PPB} AS ppb,
  greatest(0.3, least(1.0, 1 - 0.07 * k2 * 3)) * greatest(1 - 0.02 * hour(obs_time), 0.3) AS conf
FROM {wind_sql("(SELECT *, share * 4 AS k2 FROM clean_n WHERE wind_speed_10m IS NOT NULL)")}""", "clean_n AS (SELECT * FROM base)")
def _(i):
    d = P.with_wind_terms(i.base().filter("wind_speed_10m IS NOT NULL").withColumn("k2", F.col("share") * 4))
    return d.withColumns({
        "stab": F.col("_stab"), "sy": P.sigma(F.col("_ay"), F.col("k2")), "sz": P.sigma(F.col("_az"), F.col("k2")), "u": F.col("_u"), "v": F.col("_v"),
        "ppb": P.to_ppb(F.lit(100.0), F.col("temperature_2m")), "conf": P.confidence(F.col("k2") * 3000.0, F.hour("obs_time")),
    })


def spine_sql(hours: int | None = None) -> str:
    end = "max(obs_time)" if hours is None else f"min(obs_time) + INTERVAL {hours - 1} HOUR"
    return f"""
spine AS (SELECT network, unnest(generate_series(min(obs_time), {end}, INTERVAL 1 HOUR)) AS obs_time FROM base GROUP BY network),
rmet AS (SELECT s.network, s.obs_time, st.*,
    CASE WHEN o.event_id IS NOT NULL THEN o.wind_speed_10m ELSE p.wind_speed_10m END AS wind_speed_10m,
    CASE WHEN o.event_id IS NOT NULL THEN o.wind_direction_10m ELSE p.wind_direction_10m END AS wind_direction_10m,
    CASE WHEN o.event_id IS NOT NULL THEN o.temperature_2m ELSE p.temperature_2m END AS temperature_2m,
    CASE WHEN o.event_id IS NOT NULL THEN o.is_night ELSE p.is_night END AS is_night
  FROM spine s CROSS JOIN {STATIONS_SQL} st
  LEFT JOIN base o ON o.network = s.network AND o.obs_time = s.obs_time AND o.site_name = st.site_name
  LEFT JOIN base p ON p.network = s.network AND p.obs_time = s.obs_time AND p.site_name = 'NESTOR - BES')"""


def forward_sql(src: str) -> str:
    return f"""SELECT network, site_name, count(*) hours_n, count(ppb) predicted, sum(ppb) ppb_sum, max(ppb) peak FROM (
  SELECT network, site_name, obs_time, sum(ug) * any_value({PPB}) AS ppb FROM {plume_sql(f"(SELECT * FROM {wind_sql('rmet')} CROSS JOIN {src})", "station_lat", "station_lon")}
  GROUP BY ALL) GROUP BY network, site_name"""


FWD = "network:i site_name:s hours_n:i predicted:i ppb_sum:d peak:d"


def _forward(i, sources, hours=None, min_rate=0.0):
    met = D.receptor_met(i.base(), C.stations(i.spark), ["network"], hours=hours)
    d = D.forward_model(met, sources, ["network", "site_name", "obs_time"], min_rate)
    return d.groupBy(*SITE).agg(F.count("*").alias("hours_n"), F.count("predicted_ppb").alias("predicted"),
                                F.sum("predicted_ppb").alias("ppb_sum"), F.max("predicted_ppb").alias("peak"))


@query("j06_forward_zones", "J6 J8 E21 A31", FWD, forward_sql(RATES_SQL), spine_sql())
def _(i):
    return _forward(i, zone_sources(i.spark))


DEFAULTS_SQL = values([(s, *dict((n, (la, lo)) for n, la, lo in C.SOURCES)[s], dict(C.ZONE_RATES)[z] / len(names))
                       for z, names in C.ZONE_OF_SOURCE.items() for s in names], "source, source_lat, source_lon, rate")


@query("j06_forward_sources", "J6 A31 A32", FWD, forward_sql(DEFAULTS_SQL), spine_sql(72))
def _(i):
    return _forward(i, D.default_rates(i.spark), hours=72)


def segments_sql(points: str, spacing: float, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""(SELECT {k}source_lat, source_lon, row_number() OVER ({part} ORDER BY ord, kk) - 1 AS segment FROM (
  SELECT {k}ord, kk, lat + (kk + 0.5) / n * (la1 - lat) AS source_lat, lon + (kk + 0.5) / n * (lo1 - lon) AS source_lon FROM (
    SELECT *, unnest(range(n)) AS kk FROM (SELECT *, greatest(1, CAST(floor(sqrt(pow((la1 - lat) * {LAT_M}, 2) + pow((lo1 - lon) * {LON_M}, 2)) / {spacing}) AS INT)) AS n FROM (
      SELECT *, lead(lat) OVER ({part} ORDER BY ord) la1, lead(lon) OVER ({part} ORDER BY ord) lo1 FROM {points}) WHERE la1 IS NOT NULL))))"""


WAYPOINTS_SQL = values([(i, la, lo) for i, (la, lo) in enumerate(C.CHANNEL_WAYPOINTS)], "ord, lat, lon")
POS = """
pos AS (SELECT event_id, network, site_name, 32.5 + CAST(event_id % 1200 AS DOUBLE) / 10000 + 0.00005 AS lat,
  -117.18 + CAST(user_id * 37 % 1600 AS DOUBLE) / 10000 + 0.00003 AS lon FROM r)"""


def _positions(i):
    return i.raw().select("event_id", *SITE, ((F.col("event_id") % 1200).cast("double") / 10000 + 32.5 + 0.00005).alias("lat"),
                          ((F.col("user_id") * 37 % 1600).cast("double") / 10000 + (-117.18) + 0.00003).alias("lon"))


@query("w17_channel_segments", "W17", "network:i segments:i lat_sum:d lon_sum:d last:i", f"""
SELECT network, count(*) segments, sum(source_lat) lat_sum, sum(source_lon) lon_sum, max(segment) AS last
FROM {segments_sql("(SELECT network, event_id AS ord, lat, lon FROM pos)", 1500.0, "network")} GROUP BY network""", POS)
def _(i):
    pts = _positions(i).select("network", F.col("event_id").alias("ord"), "lat", "lon")
    return D.channel_segments(pts, 1500.0, ["network"]).groupBy("network").agg(
        F.count("*").alias("segments"), F.sum("source_lat").alias("lat_sum"), F.sum("source_lon").alias("lon_sum"), F.max("segment").alias("last"))


SEG_RATE = f"(SELECT *, 0.0005 + 0.9 * (segment % 5) AS rate FROM {segments_sql(WAYPOINTS_SQL, 400.0)})"


@query("j06_forward_q_field", "J6 F16", FWD, forward_sql(f"(SELECT * FROM {SEG_RATE} WHERE rate >= 0.001)"), spine_sql(24))
def _(i):
    seg = D.channel_segments(C.waypoints(i.spark), 400.0).withColumn("rate", F.col("segment") % 5 * 0.9 + 0.0005)
    return _forward(i, seg, hours=24, min_rate=1e-3)


GRID_M = 4000.0
ROWS, COLS = D.grid_shape(C.FORWARD_GRID_BOUNDS, GRID_M)
S0, N0, W0, E0 = C.FORWARD_GRID_BOUNDS
DIST = ", ".join(f"sqrt(pow((cell_lat - {la}) * {LAT_M}, 2) + pow((cell_lon - {lo}) * {LON_M}, 2))" for _, _, la, lo in C.STATIONS)
GRID = f"""
cells AS (SELECT r.row, c.col, {S0} + (r.row + 0.5) * CAST({(N0 - S0) / ROWS!r} AS DOUBLE) AS cell_lat, {W0} + (c.col + 0.5) * CAST({(E0 - W0) / COLS!r} AS DOUBLE) AS cell_lon
  FROM range({ROWS}) r(row) CROSS JOIN range({COLS}) c(col)),
gmet AS (SELECT *, CAST(hour(obs_time) AS DOUBLE) AS lead FROM base WHERE site_name = 'NESTOR - BES' AND wind_speed_10m IS NOT NULL),
raster AS (SELECT network, obs_time, row, col, least(sum(ug) * any_value({PPB}), 500) AS ppb,
    any_value(greatest(0.3, least(1.0, 1 - 0.07 * least({DIST}) / 1000)) * greatest(1 - 0.02 * lead, 0.3)) AS confidence
  FROM {plume_sql(f"(SELECT w.*, c.*, s.source_lat, s.source_lon, s.rate * 0.1 AS rate FROM {wind_sql('gmet')} w CROSS JOIN cells c CROSS JOIN {DEFAULTS_SQL} s)", "cell_lat", "cell_lon", floor=0.01)}
  GROUP BY network, obs_time, row, col)"""


def _raster(i):
    met = i.base().filter("site_name = 'NESTOR - BES' AND wind_speed_10m IS NOT NULL").withColumn("lead", F.hour("obs_time").cast("double"))
    return D.gridded_forecast(met, D.default_rates(i.spark), C.stations(i.spark), ["network", "obs_time"], resolution_m=GRID_M, lead_h="lead")


@query("j07_gridded_forecast", "J7 E24", "network:i row:i col:i frames:i ppb_sum:d ppb_max:d conf:d", """
SELECT network, row, col, count(*) frames, sum(ppb) ppb_sum, max(ppb) ppb_max, avg(confidence) conf FROM raster GROUP BY network, row, col""", GRID)
def _(i):
    return _raster(i).groupBy("network", "row", "col").agg(
        F.count("*").alias("frames"), F.sum("ppb").alias("ppb_sum"), F.max("ppb").alias("ppb_max"), F.avg("confidence").alias("conf"))


@query("a36_downsampled_frames", "A36 ST6", "network:i frame_time:t cells:i samples:i ppb_sum:d conf_sum:d", """
SELECT network, frame_time, count(*) cells, sum(n) samples, sum(ppb) ppb_sum, sum(conf) conf_sum FROM (
  SELECT network, time_bucket(INTERVAL 6 HOUR, obs_time) AS frame_time, row, col, max(ppb) ppb, max(confidence) conf, count(*) n FROM raster GROUP BY ALL)
GROUP BY network, frame_time""", GRID)
def _(i):
    return D.downsample_frames(_raster(i), ["network"], 360).groupBy("network", "frame_time").agg(
        F.count("*").alias("cells"), F.sum("n_samples").alias("samples"), F.sum("ppb").alias("ppb_sum"), F.sum("confidence").alias("conf_sum"))


RIVER_SQL = values([(n, k, b, f, t, la, lo) for n, k, b, f, t, xy in C.RIVER_SOURCES for la, lo in xy], "source, kind, base, fd, td, source_lat, source_lon")


def river_sql(cells: str) -> str:
    return f"""
SELECT network, row, col, sum(e * exp(-(eff * eff) / (2 * sg * sg)) * CASE WHEN kind = 'channel' THEN 1.2 ELSE 1 END) AS emission FROM (
  SELECT *, CASE WHEN al > 0 THEN 0.5 + km * 0.1 ELSE 0.4 END AS sg, CASE WHEN al > 0 THEN km / (1 + al * ws / 10) ELSE km * 3 END AS eff FROM (
    SELECT *, sqrt(dx * dx + dy * dy) / 1000 AS km, cos(atan2(dx, dy) - radians(wd + 180)) AS al FROM (
      SELECT c.*, g.row, g.col, s.*, (cell_lon - source_lon) * {LON_M} AS dx, (cell_lat - source_lat) * {LAT_M} AS dy,
        least(50, base * CASE WHEN fd THEN least(2, fl / 50) ELSE 1 END * CASE WHEN td THEN 1.5 - tide * 0.5 ELSE 1 END
          * greatest(0.5, least(1.5, 1 + (temp - 20) * 0.02)) * CASE WHEN kind = 'bridge' THEN 1.3 ELSE 1 END) AS e
      FROM cond c CROSS JOIN {cells} g CROSS JOIN {RIVER_SQL} s))) WHERE km <= 8 AND e > 0 GROUP BY network, row, col"""


COND = GRID + """,
cond AS (SELECT network, avg(wind_speed_10m) ws, avg(wind_direction_10m) wd, avg(flow_border) * 12 AS fl, avg(tide_height) tide, avg(temperature_2m) temp FROM base GROUP BY network)"""


def _conditions(i):
    return i.base().groupBy("network").agg(
        F.avg("wind_speed_10m").alias("wind_speed"), F.avg("wind_direction_10m").alias("wind_direction"), (F.avg("flow_border") * 12).alias("flow"),
        F.avg("tide_height").alias("tide"), F.avg("temperature_2m").alias("temperature"))


@query("j13_river_grid", "J13 E27", "network:i row:i col:i emission:d", river_sql("cells"), COND)
def _(i):
    return D.river_grid(_conditions(i), ["network"], resolution_m=GRID_M)


FINE_M = 100.0
FINE_ROWS, FINE_COLS = D.grid_shape(C.FORWARD_GRID_BOUNDS, FINE_M)
FINE = f"""(SELECT r.row, c.col, {S0} + (r.row + 0.5) * CAST({(N0 - S0) / FINE_ROWS!r} AS DOUBLE) AS cell_lat, {W0} + (c.col + 0.5) * CAST({(E0 - W0) / FINE_COLS!r} AS DOUBLE) AS cell_lon
  FROM range({FINE_ROWS}) r(row) CROSS JOIN range({FINE_COLS}) c(col))"""


FINE_RASTER = GRID + f""",
fmet AS (SELECT * FROM gmet QUALIFY row_number() OVER (PARTITION BY network ORDER BY obs_time DESC) = 1),
fraster AS (SELECT network, row, col, least(sum(ug) * any_value({PPB}), 500) AS ppb,
    any_value(greatest(0.3, least(1.0, 1 - 0.07 * least({DIST}) / 1000)) * greatest(1 - 0.02 * lead, 0.3)) AS confidence
  FROM {plume_sql(f"(SELECT w.*, c.*, s.source_lat, s.source_lon, s.rate * 0.1 AS rate FROM {wind_sql('fmet')} w CROSS JOIN {FINE} c CROSS JOIN {DEFAULTS_SQL} s)", "cell_lat", "cell_lon", floor=0.01)}
  GROUP BY network, row, col)"""


@query("j07_newest_frame_100m", "J7 E24", "network:i row:i cells:i ppb_sum:d ppb_max:d conf:d", """
SELECT network, row, count(*) cells, sum(ppb) ppb_sum, max(ppb) ppb_max, avg(confidence) conf FROM fraster GROUP BY network, row""", FINE_RASTER)
def _(i):
    """Each network's newest frame on the whole grid at its real size, summed by grid row."""
    met = latest(i.base().filter("site_name = 'NESTOR - BES' AND wind_speed_10m IS NOT NULL"), ["network"], ["obs_time"])
    d = D.gridded_forecast(met.withColumn("lead", F.hour("obs_time").cast("double")), D.default_rates(i.spark), C.stations(i.spark), ["network"], resolution_m=FINE_M, lead_h="lead")
    return d.groupBy("network", "row").agg(F.count("*").alias("cells"), F.sum("ppb").alias("ppb_sum"), F.max("ppb").alias("ppb_max"), F.avg("confidence").alias("conf"))


@query("j13_river_grid_100m", "J13 E27", "network:i row:i cells:i emission:d peak:d",
       f"SELECT network, row, count(*) AS cells, sum(emission) AS emission, max(emission) AS peak FROM ({river_sql(FINE)}) GROUP BY network, row", COND)
def _(i):
    """The whole grid at its real size, summed by grid row."""
    d = D.river_grid(_conditions(i), ["network"], resolution_m=FINE_M)
    return d.groupBy("network", "row").agg(F.count("*").alias("cells"), F.sum("emission").alias("emission"), F.max("emission").alias("peak"))


FOOT = POS + """,
fp AS (SELECT network, site_name, row, col, n / sum(n) OVER (PARTITION BY network, site_name) AS density FROM (
  SELECT network, site_name, floor((lat - 32.50) / CAST(""" + repr((32.62 - 32.50) / 120) + """ AS DOUBLE)) AS row,
    floor((lon - (-117.18)) / CAST(""" + repr((-117.02 + 117.18) / 160) + """ AS DOUBLE)) AS col, count(*) n FROM pos GROUP BY ALL)
  WHERE row BETWEEN 0 AND 119 AND col BETWEEN 0 AND 159),
seen AS (SELECT network, site_name, avg(h2s) h2s FROM clean GROUP BY network, site_name),
comb AS (SELECT network, row, col, d / sum(d) OVER (PARTITION BY network) AS density FROM (
  SELECT network, row, col, sum(greatest(h2s - 1, 0) * density) d FROM fp JOIN seen USING (network, site_name) GROUP BY network, row, col))"""


def _fp(i):
    return D.residence_histogram(_positions(i), SITE)


def _seen(i):
    return i.clean().groupBy(*SITE).agg(F.avg("h2s").alias("h2s"))


@query("a34_residence_histogram", "A34", "network:i site_name:s row:i col:i density:d", "SELECT * FROM fp", FOOT)
def _(i):
    return _fp(i)


@query("a33_combined_footprint", "A33", "network:i row:i col:i density:d", "SELECT * FROM comb", FOOT)
def _(i):
    return D.combine_footprints(_fp(i), _seen(i), ["network"])


@query("a33_ensemble_footprint", "A33", "row:i col:i density:d", """
SELECT row, col, d / sum(d) OVER () AS density FROM (SELECT row, col, sum(density) / (SELECT count(DISTINCT network) FROM comb) d FROM comb GROUP BY row, col)""", FOOT)
def _(i):
    return D.ensemble_footprint(D.combine_footprints(_fp(i), _seen(i), ["network"]), ["network"])


def kernel_sql(src: str, km: float) -> str:
    return f"""SELECT network, source, m / sum(m) OVER (PARTITION BY network) AS fraction FROM (
  SELECT network, source, sum(density * exp(-0.5 * (pow((32.50 + (row + 0.5) * CAST({(32.62 - 32.50) / 120!r} AS DOUBLE) - source_lat) * {LAT_M} / {km}, 2)
    + pow((-117.18 + (col + 0.5) * CAST({(-117.02 + 117.18) / 160!r} AS DOUBLE) - source_lon) * {LON_M} / {km}, 2)))) m
  FROM comb CROSS JOIN {src} GROUP BY network, source)"""


def _fractions(i):
    return D.kernel_attribution(D.combine_footprints(_fp(i), _seen(i), ["network"]), C.sources(i.spark), ["network"])


@query("j11_kernel_attribution", "J11", "network:i source:s fraction:d", kernel_sql(SOURCES_SQL, 500.0), FOOT)
def _(i):
    return _fractions(i)


@query("j11_channel_projection", "J11 W17", "network:i source:i fraction:d",
       kernel_sql(f"(SELECT segment AS source, source_lat, source_lon FROM {segments_sql(WAYPOINTS_SQL, 400.0)})", 350.0), FOOT)
def _(i):
    seg = D.channel_segments(C.waypoints(i.spark), 400.0).withColumnRenamed("segment", "source")
    return D.kernel_attribution(D.combine_footprints(_fp(i), _seen(i), ["network"]), seg, ["network"], 350.0, uniform=True)


ZONE_SQL = values([(s, z) for z, ns in C.ZONE_OF_SOURCE.items() for s in ns], "source, zone")


@query("a32_zone_rates", "A32", "network:i source:s zone:s source_rate:d zone_rate:d", f"""
SELECT *, sum(source_rate) OVER (PARTITION BY network, zone) AS zone_rate FROM (
  SELECT network, source, zone, fraction / sum(fraction) OVER (PARTITION BY network) * 167 AS source_rate FROM ({kernel_sql(SOURCES_SQL, 500.0)}) JOIN {ZONE_SQL} USING (source))""", FOOT)
def _(i):
    return D.zone_rates(_fractions(i), ["network"])


@query("a35_fraction_rates", "A35", "network:i source:s rate:d", f"""
SELECT network, source, c * fraction * 1.4 AS rate FROM ({kernel_sql(SOURCES_SQL, 500.0)}) JOIN (
  SELECT network, avg(CASE WHEN h2s > 1 THEN h2s - 1 END) c FROM seen GROUP BY network) USING (network) WHERE fraction >= 0.02 AND c > 0""", FOOT)
def _(i):
    return D.fraction_rates(_fractions(i), _seen(i), ["network"])


R2, C2 = D.grid_shape(C.FORWARD_GRID_BOUNDS, 150.0)


@query("j14_resampled_footprint", "J14", "network:i cells:i weighted_row:d weighted_col:d", f"""
SELECT network, count(*) cells, sum(density * trow) / sum(density) weighted_row, sum(density * tcol) / sum(density) weighted_col FROM comb JOIN (
  SELECT trow, tcol, floor((la - 32.50) / CAST({(32.62 - 32.50) / 120!r} AS DOUBLE)) AS row, floor((lo - (-117.18)) / CAST({(-117.02 + 117.18) / 160!r} AS DOUBLE)) AS col FROM (
    SELECT r.i AS trow, c.i AS tcol, {S0} + (r.i + 0.5) * CAST({(N0 - S0) / R2!r} AS DOUBLE) AS la, {W0} + (c.i + 0.5) * CAST({(E0 - W0) / C2!r} AS DOUBLE) AS lo
    FROM range({R2}) r(i) CROSS JOIN range({C2}) c(i))
  WHERE la BETWEEN 32.5005 AND 32.6195 AND lo BETWEEN -117.1795 AND -117.0205) USING (row, col) GROUP BY network""", FOOT)
def _(i):
    d = D.resample_footprint(D.combine_footprints(_fp(i), _seen(i), ["network"]), ["network"], resolution_m=150.0)
    return d.groupBy("network").agg(F.count("*").alias("cells"), F.sum(F.col("density") * F.col("row")).alias("weighted_row"),
                                    F.sum(F.col("density") * F.col("col")).alias("weighted_col"))


# segments are spaced 400 m in the checked queries, 150 m by default
SENS = f"""
ev AS (SELECT DISTINCT network, obs_time FROM base WHERE h2s >= 30 AND stable_atm = 1),
fr AS (SELECT *, count(*) OVER w AS n_met, avg(wind_speed_10m) OVER w AS mean_wind FROM base
  WINDOW w AS (PARTITION BY network, site_name ORDER BY obs_time RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW)),
part AS (SELECT * FROM fr SEMI JOIN ev USING (network, obs_time) WHERE n_met >= 2 AND h2s >= 1),
fm AS (SELECT network, obs_time, coalesce(wind_speed_10m, 1.0) AS wind_speed_10m, wind_direction_10m, temperature_2m, is_night FROM part
  QUALIFY row_number() OVER (PARTITION BY network, obs_time ORDER BY CASE site_name WHEN 'NESTOR - BES' THEN 1 WHEN 'IB CIVIC CTR' THEN 2 ELSE 3 END) = 1),
sens AS (SELECT p.network, p.obs_time, p.site_name, p.h2s - 1 AS c_bg, p.n_met, p.mean_wind, fm.wind_speed_10m, fm.wind_direction_10m, fm.temperature_2m, fm.is_night, st.station_lat, st.station_lon
  FROM part p JOIN fm USING (network, obs_time) JOIN {STATIONS_SQL} st ON st.site_name = p.site_name WHERE p.h2s > 1),
amat AS (SELECT network, obs_time, site_name, segment, c_bg, ug * {PPB} AS a
  FROM {plume_sql(f"(SELECT w.*, s.*, 1.0 AS rate FROM {wind_sql('sens')} w CROSS JOIN {segments_sql(WAYPOINTS_SQL, 400.0)} s)", "station_lat", "station_lon")}),
chk AS (SELECT *, max_obs / max_a AS q_required, max_obs / max_a > 500 AS skipped FROM (
  SELECT network, obs_time, max(a) max_a, max(c_bg) max_obs, count(DISTINCT site_name) n_sensors FROM amat GROUP BY network, obs_time) WHERE max_a >= 1e-6)"""


def _segments(i):
    return D.channel_segments(C.waypoints(i.spark), 400.0)


#: Segments of the fixed way points at 400 m; a test compares it with the table.
N_SEGMENTS = D.n_segments(C.CHANNEL_WAYPOINTS, 400.0)


def _rows(i):
    base = i.base()
    ev = V.event_times(base, ["network"], top=None)
    return V.sensitivities(V.event_sensors(base, ev, C.stations(i.spark), ["network"]), _segments(i))


@query("f18_a53_event_sensors", "F18 A53", "network:i obs_time:t site_name:s c_bg:d n_met:i hours_back:d wind_speed_10m:d", """
SELECT *, least(greatest(6000 / greatest(coalesce(mean_wind, 1.0), 0.3) / 3600, 0.5), 4.0) AS hours_back FROM sens""", SENS)
def _(i):
    base = i.base()
    return V.event_sensors(base, V.event_times(base, ["network"], top=None), C.stations(i.spark), ["network"])


@query("a37_sensitivity_rows", "A37 W17", "network:i obs_time:t site_name:s segment:i a:d", "SELECT * FROM amat", SENS)
def _(i):
    return _rows(i).select("network", "obs_time", "site_name", F.posexplode("a").alias("segment", "a"))


@query("f15_geometry_filter", "F15", "network:i obs_time:t n_sensors:i max_a:d max_obs:d q_log:d skipped:b", "SELECT *, ln(q_required) AS q_log FROM chk", SENS)
def _(i):
    return V.geometry_check(_rows(i), ["network"]).withColumn("q_log", F.log("q_required"))


@query("a41_sensitivity_summary", "A41 F17", "week:s n_events:i max_a_max:d peak_obs_max:d q_max_log:d n_needing_gt_500:i n_skipped:i max_a_p50:d q_required_p50:d", """
SELECT CAST(date_trunc('week', obs_time) AS DATE) AS week, count(*) n_events, max(max_a) max_a_max, max(max_obs) peak_obs_max, ln(max(q_required)) q_max_log,
  count(CASE WHEN q_required > 500 THEN 1 END) n_needing_gt_500, count(CASE WHEN skipped THEN 1 END) n_skipped, median(max_a) max_a_p50, median(q_required) q_required_p50
FROM chk GROUP BY 1""", SENS)
def _(i):
    d = V.geometry_check(_rows(i), ["network"]).withColumn("week", F.to_date(F.date_trunc("week", "obs_time")))
    return V.sensitivity_summary(d, ["week"]).withColumn("q_max_log", F.log("q_required_max"))


def _usable(i):
    rows = _rows(i)
    return V.usable_rows(rows, V.geometry_check(rows, ["network"]), ["network"])


def _solved(i):
    return V.solve_weeks(V.normal_equations(_usable(i), ["week"], N_SEGMENTS), ["week"], N_SEGMENTS)


@query("a38_weekly_inversion", "A38", "week:s segment:i rate:d fraction:d active:b kkt:d")
def _(i):
    return V.q_field(_solved(i), _segments(i), ["week"])


@query("a38_normal_equations", "A38", "week:s j:i k:i v:d", """
SELECT CAST(date_trunc('week', x.obs_time) AS DATE) AS week, x.segment AS j, y.segment AS k, sum(x.a * y.a) AS v
FROM amat x JOIN amat y ON x.network = y.network AND x.obs_time = y.obs_time AND x.site_name = y.site_name AND y.segment >= x.segment
SEMI JOIN (SELECT * FROM chk WHERE NOT skipped) c ON c.network = x.network AND c.obs_time = x.obs_time GROUP BY ALL""", SENS)
def _(i):
    return V.normal_equations(_usable(i), ["week"], N_SEGMENTS).filter("k >= 0")


@query("a39_leave_sensor_out", "A39 E35", "week:s held_out:s n_test:i rmse:d bias:d c_obs_std:d rmse_over_std:d")
def _(i):
    return V.cross_validate(_usable(i), "site_name", N_SEGMENTS)


@query("a40_leave_time_fold_out", "A40 E35", "week:s held_out:i n_test:i rmse:d bias:d c_obs_std:d rmse_over_std:d")
def _(i):
    return V.cross_validate(V.with_time_folds(_usable(i), ["network"]), "fold", N_SEGMENTS)


def _report(pred):
    return V.fold_report(pred, ["week"])


REPORT_SPEC = "week:s scope:s part:s n_test:i rmse:d bias:d c_obs_std:d rmse_over_std:d"


@query("a39_sensor_report", "A39 E35", REPORT_SPEC)
def _(i):
    return _report(V.held_out_predictions(_usable(i), "site_name", N_SEGMENTS))


@query("a40_time_fold_report", "A40 E35", REPORT_SPEC)
def _(i):
    return _report(V.held_out_predictions(V.with_time_folds(_usable(i), ["network"]), "fold", N_SEGMENTS))


@query("a39_training_matrices", "A39 A40", "week:s held_out:s j:i k:i v:d m:d", """
SELECT h.week, h.held_out, p.j, p.k, sum(p.v) AS v, max(p.m) AS m FROM (SELECT DISTINCT week, site_name AS held_out FROM parts) h
JOIN parts p ON p.week = h.week AND p.site_name <> h.held_out GROUP BY ALL""", SENS + """,
used AS (SELECT CAST(date_trunc('week', obs_time) AS DATE) AS week, a.* FROM amat a SEMI JOIN (SELECT * FROM chk WHERE NOT skipped) c USING (network, obs_time)),
parts AS (
  SELECT x.week, x.site_name, x.segment AS j, y.segment AS k, sum(x.a * y.a) AS v, 0.0 AS m
  FROM used x JOIN used y ON x.network = y.network AND x.obs_time = y.obs_time AND x.site_name = y.site_name AND y.segment >= x.segment GROUP BY ALL
  UNION ALL SELECT week, site_name, segment, -1, sum(a * c_bg), 0.0 FROM used GROUP BY ALL
  UNION ALL SELECT week, site_name, segment, -2, 0.0, max(a) FROM used GROUP BY ALL)""")
def _(i):
    """The systems that each held-out sensor is scored with: sums of all other sensors' matrices."""
    return V.others_matrices(V.normal_equations(_usable(i), ["week", "site_name"], N_SEGMENTS), ["week"], "site_name")


@query("a41_fit_residuals", "A41", "week:s site_name:s n_test:i rmse:d bias:d")
def _(i):
    """Per sensor, how far the week's own rates are from its readings."""
    rows = _usable(i)
    return V.residual_scores(V.predict_rows(rows, _solved(i), ["week"]), ["week", "site_name"])


@query("a41_fixed_field_residuals", "A41 A39 A40", "week:s scope:s part:s n_test:i rmse:d bias:d c_obs_std:d rmse_over_std:d", """
SELECT week, scope, part, count(*) n_test, sqrt(avg(e * e)) rmse, avg(e) bias, stddev_pop(c_bg) c_obs_std,
  CASE WHEN stddev_pop(c_bg) > 0 THEN sqrt(avg(e * e)) / stddev_pop(c_bg) END AS rmse_over_std FROM (
  SELECT week, c_bg, c_bg - c_pred AS e, unnest(['held_out', 'sensor', 'overall']) AS scope, unnest([site_name, site_name, 'all']) AS part FROM (
    SELECT CAST(date_trunc('week', obs_time) AS DATE) AS week, network, obs_time, site_name, any_value(c_bg) AS c_bg, sum(a * (segment % 7) * 0.01) AS c_pred
    FROM amat SEMI JOIN (SELECT * FROM chk WHERE NOT skipped) c USING (network, obs_time) GROUP BY ALL)) GROUP BY ALL""", SENS)
def _(i):
    """The residual scores of a fixed field of rates in place of the solution, which SQL can't find."""
    rows = _usable(i).withColumn("held_out", F.col("site_name"))
    field = rows.select("week").distinct().withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(N_SEGMENTS - 1)))).withColumn("rate", F.col("segment") % 7 * 0.01)
    return _report(V.predict_rows(rows, field, ["week"]))


@query("f17_rolling_window", "F17 A41", "n_events:i max_a_max:d peak_obs_max:d q_max_log:d n_skipped:i first:t last:t", """
SELECT count(*) n_events, max(max_a) max_a_max, max(max_obs) peak_obs_max, ln(max(q_required)) q_max_log, count(CASE WHEN skipped THEN 1 END) n_skipped,
  min(obs_time) AS first, max(obs_time) AS last FROM chk
WHERE obs_time BETWEEN (SELECT max(obs_time) FROM base) - INTERVAL 10 DAY AND (SELECT max(obs_time) FROM base)""", SENS)
def _(i):
    """Event diagnostics of the ten days up to the newest reading."""
    newest = i.base().agg(F.max("obs_time")).first()[0]
    d = V.rolling_window(V.geometry_check(_rows(i), ["network"]), 10, newest)
    return d.agg(F.count("*").alias("n_events"), F.max("max_a").alias("max_a_max"), F.max("max_obs").alias("peak_obs_max"), F.log(F.max("q_required")).alias("q_max_log"),
                 F.count(F.when(F.col("skipped"), 1)).alias("n_skipped"), F.min("obs_time").alias("first"), F.max("obs_time").alias("last"))


@query("s11_fixed_field_copies", "S11", "copy:s week:s segments:i rate:d", """
SELECT copy, week, count(*) AS segments, sum(segment % 7 * 0.01 * day(week)) AS rate
FROM weeks, range(""" + str(N_SEGMENTS) + """) AS r(segment), (VALUES ('weekly'), ('latest')) AS c(copy)
WHERE copy = 'weekly' OR week = (SELECT max(week) FROM weeks WHERE date_diff('day', week + 7, DATE '2024-02-20') <= 30) GROUP BY copy, week""", SENS + """,
weeks AS (SELECT DISTINCT CAST(date_trunc('week', obs_time) AS DATE) AS week FROM chk WHERE NOT skipped)""")
def _(i):
    """The weekly copies and the one that is recent enough, of a fixed field in place of the solution."""
    from airq.session import scratch_path
    from airq.sources.sinks import write_q_field

    weeks = V.usable_rows(_rows(i), V.geometry_check(_rows(i), ["network"]), ["network"]).select("week").distinct()
    field = weeks.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(N_SEGMENTS - 1)))).withColumn("rate", F.col("segment") % 7 * 0.01 * F.dayofmonth("week"))
    path = scratch_path(i.spark, "fixed-field")
    write_q_field(field, path, "2024-02-20")
    copy = lambda name, at: i.spark.read.parquet(f"{path}/{at}").select(F.lit(name).alias("copy"), F.to_date("week").alias("week"), "rate")
    return copy("weekly", "weekly").unionByName(copy("latest", "latest")).groupBy("copy", "week").agg(F.count("*").alias("segments"), F.sum("rate").alias("rate"))


@query("e35_gates", "E35 F16", "week:s cv_pass:b n_test:i total_rate:d budget_pass:b strong:i")
def _(i):
    cv = V.cv_gates(V.cross_validate(_usable(i), "site_name", N_SEGMENTS), ["week"])
    field = _solved(i)
    strong = V.sources_above(field, ["week"]).groupBy("week").agg(F.count("*").alias("strong"))
    return cv.join(V.budget_gate(field, ["week"]), "week").join(strong, "week", "left")
