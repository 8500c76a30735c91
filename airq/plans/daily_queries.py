"""Source attribution, forecast expansion, joins of the daily analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions import classes as K
from airq.functions import emission, geo
from airq.operators import alerts as L
from airq.operators import attribution as A
from airq.operators import features as X
from airq.operators.dims import pair_with
from airq.operators.forecast import forecast_features, seed_state
from airq.operators.ordering import earliest
from airq.plans.registry import query

SITE = X.SITE


def values(rows, cols: str) -> str:
    def t(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, bool):
            return str(v).upper()
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)

    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(t(v) for v in r) + ')' for r in rows)}) t({cols}))"


STATIONS_SQL = values([(n, la, lo) for n, _, la, lo in C.STATIONS], "site_name, station_lat, station_lon")
SOURCES_SQL = values([(k, n, la, lo) for k, (n, la, lo) in enumerate(C.SOURCES)], "ord, source, source_lat, source_lon")
MOD360 = "(({x}) - 360 * floor(({x}) / 360))"


def mod360(x: str) -> str:
    return MOD360.replace("{x}", x)


BEARING = mod360("degrees(atan2(source_lon - station_lon, source_lat - station_lat))")
OFF = f"abs({mod360('wind_direction_10m - ' + BEARING + ' + 180')} - 180)"
KM = ("sqrt(pow(station_lat - source_lat, 2) + pow((station_lon - source_lon) * cos(radians((station_lat + source_lat) / 2)), 2)) * 111.32")
ATTR = f"""
near AS (
  SELECT b.*, s.source, {OFF} AS off_deg, {KM} AS km,
    row_number() OVER (PARTITION BY b.event_id ORDER BY {OFF}, s.ord) AS pick
  FROM base b JOIN {STATIONS_SQL} st USING (site_name) CROSS JOIN {SOURCES_SQL} s),
attr0 AS (
  SELECT * EXCLUDE (pick), CASE WHEN is_night = 0 THEN 'Daytime (mixed)' WHEN off_deg < 30 THEN source ELSE 'Unaligned' END AS aligned_source,
    CASE WHEN is_night = 1 AND off_deg < 30 THEN km * 1000 END AS dist FROM near WHERE pick = 1),
attr AS (
  SELECT *, CASE WHEN h2s > 2 THEN h2s * 1.42 * pi() * (0.08 * dist / sqrt(1 + 0.0001 * dist)) * (0.06 * dist / sqrt(1 + 0.0015 * dist))
    * greatest(wind_speed_10m, 0.5) / 1e6 END AS emission_rate_gs FROM attr0)"""
# greatest() skips a missing wind in both engines, so the floor of 0.5 m/s applies to it as well


def _attributed(i):
    return A.attribute_sources(i.base(), C.stations(i.spark), C.sources(i.spark))


@query("a21_source_attribution", "A21 J5 E17 E18", "network:i site_name:s obs_time:t h2s:d is_night:b aligned_source:s emission_rate_gs:d",
       "SELECT * FROM attr", ATTR)
def _(i):
    return _attributed(i)


@query("a20_active_sources", "A20", "network:i aligned_source:s hours:i mean_h2s:d max_h2s:d median_rate:d", """
SELECT network, aligned_source, count(*) AS hours, avg(h2s) mean_h2s, max(h2s) max_h2s, median(emission_rate_gs) median_rate
FROM attr WHERE h2s > 5 AND aligned_source NOT IN ('Unaligned', 'Daytime (mixed)') GROUP BY ALL""", ATTR)
def _(i):
    return A.active_sources(_attributed(i), ["network"])


@query("k03_top_sources", "K3", "network:i aligned_source:s hours:i rank:i", """
SELECT network, aligned_source, count(*) AS hours, row_number() OVER (PARTITION BY network ORDER BY count(*) DESC, aligned_source) AS rank
FROM attr WHERE aligned_source NOT IN ('Unaligned', 'Daytime (mixed)') GROUP BY network, aligned_source QUALIFY rank <= 6""", ATTR)
def _(i):
    return A.top_sources(_attributed(i), ["network"])


@query("e17_geometry", "E17", "site_name:s source:s bearing:d km:d diff:d n:i", f"""
SELECT site_name, source, {BEARING} AS bearing, {KM} AS km, n, {mod360('wd - ' + BEARING + ' + 180')} - 180 AS diff
FROM (SELECT site_name, avg(wind_direction_10m) wd, count(*) n FROM obs GROUP BY site_name) JOIN {STATIONS_SQL} USING (site_name) CROSS JOIN {SOURCES_SQL}""")
def _(i):
    per = i.obs().groupBy("site_name").agg(F.avg("wind_direction_10m").alias("wd"), F.count("*").alias("n"))
    d = pair_with(per.join(C.stations(i.spark), "site_name"), C.sources(i.spark))
    g = [F.col(c) for c in ("station_lat", "station_lon", "source_lat", "source_lon")]
    return d.withColumns({"bearing": geo.bearing(*g), "km": geo.distance_km(*g), "diff": geo.angular_difference(F.col("wd"), geo.bearing(*g))})


@query("j12_probability_surface", "J12", "row:i col:i probability:d", f"""
SELECT row, col, w / max(w) OVER () AS probability FROM (
  SELECT row, col, sum(exp(-0.5 * pow(({mod360('br - wd + 180')} - 180) / 15, 2)) * ln(1 + h2s)
     * exp(-0.5 * pow((sqrt(pow(dlat, 2) + pow(dlon * cos(radians(station_lat)), 2)) - greatest(ws * 3600 / 111000, 0.005) * 0.3) / 0.015, 2))) AS w FROM (
    SELECT *, {mod360('degrees(atan2(dlon, dlat))')} AS br FROM (
      SELECT r.row, c.col, 32.525 + r.row * 0.01 - station_lat AS dlat, -117.135 + c.col * 0.01 - station_lon AS dlon, station_lat, h2s,
        wind_direction_10m AS wd, coalesce(wind_speed_10m, 1.0) AS ws
      FROM base JOIN {STATIONS_SQL} USING (site_name) CROSS JOIN range(7) r(row) CROSS JOIN range(11) c(col)
      WHERE is_night = 1 AND h2s > 10 AND obs_time >= (SELECT max(obs_time) FROM base) - INTERVAL 7 DAY))
  GROUP BY row, col)""")
def _(i):
    recent = X.since_latest(i.base(), "7 DAYS")
    return A.probability_surface(recent, C.stations(i.spark), (32.525, 32.595, -117.135, -117.025), 0.01)


@query("j01_forecast_hour_join", "J1", "event_id:i obs_time:t wind_speed_10m:d temperature_2m:d", """
SELECT a.event_id, a.obs_time, b.wind_speed_10m, b.temperature_2m FROM readings a LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY network, obs_time ORDER BY event_id) rn FROM obs) b
ON a.network = b.network AND date_trunc('hour', a.obs_time) = b.obs_time AND b.rn = 1""")
def _(i):
    return A.attach_hour(i.readings(), i.obs(), ["network"], "obs_time", "obs_time", ["wind_speed_10m", "temperature_2m"], ["event_id"])


@query("j15_diurnal_profile", "J15", "network:i site_name:s obs_time:t flow_border:d", """
SELECT network, site_name, obs_time, coalesce(flow_border, p, (SELECT median(flow_border) FROM obs)) AS flow_border FROM obs
LEFT JOIN (SELECT month(obs_time) m, hour(obs_time) h, median(flow_border) p FROM obs GROUP BY ALL) ON m = month(obs_time) AND h = hour(obs_time)""")
def _(i):
    return A.fill_from_profile(i.obs(), "flow_border")


HOT = "hot AS (SELECT network, site_name, obs_time, h2s FROM obs WHERE h2s > 350)"


@query("j16_replicate_stations", "J16", "network:i site_name:s obs_time:t h2s:d", f"""
SELECT * FROM hot UNION ALL SELECT h.network, s.site_name, h.obs_time, h.h2s FROM hot h
JOIN (SELECT network FROM hot GROUP BY network HAVING count(DISTINCT site_name) < 2) USING (network)
CROSS JOIN {STATIONS_SQL} s WHERE s.site_name <> h.site_name""", HOT)
def _(i):
    hot = i.obs().filter("h2s > 350").select(*SITE, "obs_time", "h2s")
    return A.replicate_stations(hot, C.stations(i.spark), ["network"])


@query("j17_primary_or_backup", "J17", "network:i obs_time:t wind_speed_10m:d h2s:d degraded:b", """
SELECT network, obs_time, CASE WHEN has THEN nw ELSE iw END AS wind_speed_10m, CASE WHEN has THEN nh ELSE ih END AS h2s, NOT has AS degraded FROM (
  SELECT network, obs_time, bool_or(site_name = 'NESTOR - BES') has, max(CASE WHEN site_name = 'NESTOR - BES' THEN wind_speed_10m END) nw,
    max(CASE WHEN site_name = 'IB CIVIC CTR' THEN wind_speed_10m END) iw, max(CASE WHEN site_name = 'NESTOR - BES' THEN h2s END) nh,
    max(CASE WHEN site_name = 'IB CIVIC CTR' THEN h2s END) ih FROM obs WHERE site_name <> 'SAN YSIDRO' GROUP BY ALL)""")
def _(i):
    return A.primary_or_backup(i.obs(), ["network", "obs_time"], ["wind_speed_10m", "h2s"])


VARIANTS = """
vars AS (
  SELECT network, site_name, obs_time, f, 1.0 / (1.0 + model_ppb / f) AS g,
    (1.0 - 1.0 / (1.0 + model_ppb / f)) * share AS o, (1.0 - 1.0 / (1.0 + model_ppb / f)) * (1.0 - share) AS y
  FROM base CROSS JOIN (VALUES (5.0), (15.0), (40.0)) t(f))"""


@query("j18_ensemble", "J18 M3", "network:i site_name:s obs_time:t predicted_category:s probability_green:d probability_yellow:d probability_orange:d confidence:d alert:b n_models:i", """
SELECT *, greatest(probability_green, probability_yellow, probability_orange) AS confidence, predicted_category <> 'green' AS alert FROM (
  SELECT *, CASE WHEN probability_green >= probability_yellow AND probability_green >= probability_orange THEN 'green'
    WHEN probability_yellow >= probability_orange THEN 'yellow' ELSE 'orange' END AS predicted_category FROM (
    SELECT network, site_name, obs_time, avg(g) probability_green, avg(y) probability_yellow, avg(o) probability_orange, count(*) n_models
    FROM vars GROUP BY ALL))""", VARIANTS)
def _(i):
    def variant(f):
        g = F.lit(1.0) / (F.col("model_ppb") / f + 1.0)
        return i.base().select(*SITE, "obs_time", g.alias("probability_green"), ((1.0 - g) * (1.0 - F.col("share"))).alias("probability_yellow"),
                               ((1.0 - g) * F.col("share")).alias("probability_orange"))

    return A.ensemble([variant(f) for f in (5.0, 15.0, 40.0)], [*SITE, "obs_time"])


@query("j21_latest_context", "J21", "event_id:i network:i context_time:t temperature_2m:d wind_speed_10m:d", """
SELECT a.event_id, a.network, b.obs_time AS context_time, b.temperature_2m, b.wind_speed_10m FROM readings a LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY network ORDER BY obs_time DESC, event_id DESC) rn FROM obs) b ON a.network = b.network AND b.rn = 1""")
def _(i):
    ctx = i.obs().withColumnRenamed("obs_time", "context_time").withColumnRenamed("event_id", "ctx_id")
    return A.attach_latest(i.readings(), ctx, ["network"], ["context_time", "ctx_id"], ["context_time", "temperature_2m", "wind_speed_10m"])


@query("j22_interpolated_wind", "J22", "event_id:i wind_u:d wind_v:d", """
SELECT event_id, coalesce(CASE WHEN pu IS NULL THEN nu WHEN nu IS NULL THEN pu WHEN nt > pt THEN pu + (nu - pu) * (epoch_us(t) - pt) / (nt - pt) ELSE pu END, 0) AS wind_u,
  coalesce(CASE WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv WHEN nt > pt THEN pv + (nv - pv) * (epoch_us(t) - pt) / (nt - pt) ELSE pv END, 0) AS wind_v
FROM (SELECT q.event_id, q.obs_time t, epoch_us(p.obs_time) pt, p.u pu, p.v pv, epoch_us(n.obs_time) nt, n.u nu, n.v nv FROM readings q
  ASOF LEFT JOIN met p ON q.network = p.network AND q.site_name = p.site_name AND q.obs_time >= p.obs_time
  ASOF LEFT JOIN met n ON q.network = n.network AND q.site_name = n.site_name AND q.obs_time <= n.obs_time)""", """
met AS (SELECT network, site_name, obs_time, -wind_speed_10m * sin(radians(wind_direction_10m)) u, -wind_speed_10m * cos(radians(wind_direction_10m)) v
  FROM clean WHERE wind_speed_10m IS NOT NULL)""")
def _(i):
    return A.interpolate_wind(i.clean(), i.readings(), SITE, "obs_time", "obs_time")


MERGED = """
two AS (SELECT network, site_name, obs_time, 0 AS ord, 'plume' AS model, coalesce(model_ppb * 2, 0) AS ppb FROM obs
  UNION ALL SELECT network, site_name, obs_time, 1, 'detailed', coalesce(h2s, 0) FROM obs),
merged AS (SELECT network, site_name, obs_time, ppb AS predicted_ppb, model FROM two
  QUALIFY row_number() OVER (PARTITION BY network, site_name, obs_time ORDER BY ppb DESC, ord) = 1)"""


def _merged(i):
    a = i.obs().select(*SITE, "obs_time", (F.col("model_ppb") * 2).alias("predicted_ppb"))
    b = i.obs().select(*SITE, "obs_time", F.col("h2s").alias("predicted_ppb"))
    return A.merge_models([("plume", a), ("detailed", b)], [*SITE, "obs_time"])


@query("j23_merge_models", "J23", "network:i site_name:s obs_time:t predicted_ppb:d model:s", "SELECT * FROM merged", MERGED)
def _(i):
    return _merged(i)


@query("st11_lookahead_alerts", "ST11 K3", "network:i site_name:s obs_time:t predicted_ppb:d model:s tier:s", """
SELECT *, CASE WHEN predicted_ppb >= 100 THEN 'CRITICAL' ELSE 'WATCH' END AS tier FROM merged
WHERE predicted_ppb >= 30 AND obs_time <= TIMESTAMP '2024-01-12 00:00:00' + INTERVAL 6 HOUR""", MERGED)
def _(i):
    return A.lookahead_alerts(_merged(i), F.lit("2024-01-12 00:00:00").cast("timestamp"))


SPILLS = """
spills AS (SELECT network, event_id AS spill_id, CAST(obs_time AS DATE) AS s, CAST(obs_time AS DATE) + CAST(event_id % 4 AS INT) AS e
  FROM obs WHERE h2s > 300)"""


@query("j24_spill_hours", "J24", "network:i spill_id:i hours:i mean_h2s:d", """
SELECT s.network, s.spill_id, count(*) AS hours, avg(o.h2s) mean_h2s FROM obs o JOIN spills s
ON o.network = s.network AND CAST(o.obs_time AS DATE) BETWEEN s.s AND s.e GROUP BY ALL""", SPILLS)
def _(i):
    day = F.to_date("obs_time")
    spills = i.obs().filter("h2s > 300").select("network", F.col("event_id").alias("spill_id"), day.alias("start_date"),
                                               F.date_add(day, (F.col("event_id") % 4).cast("int")).alias("end_date"))
    return A.spill_hours(i.obs(), spills, ["network"]).groupBy("network", "spill_id").agg(F.count("*").alias("hours"), F.avg("h2s").alias("mean_h2s"))


SEWAGE_SQL = values(C.SEWAGE_SOURCES, "source, lat, lon, mult, dph, fdo")
MINOR_SQL = values(C.MINOR_SOURCES, "source, lat, lon, emission")
PRODUCTION = """greatest(exp(-60000.0 / 8.314 * (1 / (t + 273.15) - 1 / 293.15)) * 0.015 * 50 * exp(-0.5 * pow((ph + dph - 7.2) / 1.5, 2))
  * exp(-(ox * fdo) / 0.5) * (1 + 0.5 * exp(-tide / 0.5)) / (1 + fl * mult / 100)
  * CASE WHEN lat > 32.53 AND lat < 32.55 AND lon > -117.13 AND lon < -117.11 THEN 1.5
         WHEN lat > 32.52 AND lat < 32.54 AND lon > -117.15 AND lon < -117.14 THEN 1.3 ELSE 1 END, 0)"""


@query("j25_point_sources", "J25 E28", "network:i source:s n:i emission:d", f"""
SELECT network, source, count(*) n, avg(e) emission FROM (
  SELECT network, source, {PRODUCTION} AS e FROM (SELECT network, temperature_2m AS t, 7.5 + share / 3 AS ph, 2.0 AS ox, tide_height AS tide,
     coalesce(flow_border, 50.0) AS fl FROM clean) CROSS JOIN {SEWAGE_SQL}
  UNION ALL SELECT network, source, emission * (1 + 0.2 * sin(hour(obs_time) * pi() / 12)) FROM clean CROSS JOIN {MINOR_SQL}) GROUP BY ALL""")
def _(i):
    from airq.operators.dispersion import point_sources

    cond = i.clean().select("network", "obs_time", F.col("temperature_2m").alias("temperature"), (F.col("share") / 3 + 7.5).alias("ph"),
                            F.lit(2.0).alias("oxygen"), F.col("tide_height").alias("tide"), F.coalesce("flow_border", F.lit(50.0)).alias("flow"))
    return point_sources(cond).groupBy("network", "source").agg(F.count("*").alias("n"), F.avg("emission").alias("emission"))


FC = """
seed AS (SELECT network, site_name, max(CASE WHEN rn = 1 THEN h2s END) h2s_last, avg(CASE WHEN rn <= 6 THEN h2s END) h2s_6, avg(h2s) h2s_24,
    coalesce(max(CASE WHEN rn = 1 THEN flow_border END), 2.0) flow_last, coalesce(avg(flow_border), 2.0) flow_24
  FROM (SELECT *, row_number() OVER (PARTITION BY network, site_name ORDER BY obs_time DESC) rn FROM clean) WHERE rn <= 24 GROUP BY ALL),
fc AS (SELECT network, obs_time, wind_speed_10m, row_number() OVER (PARTITION BY network ORDER BY obs_time) - 1 AS step FROM (
  SELECT *, row_number() OVER (PARTITION BY network, obs_time ORDER BY event_id) rn FROM obs) WHERE rn = 1 QUALIFY step < 24)"""


@query("e34_forecast_features", "E34 W12 F18", "network:i site_name:s obs_time:t step:i h2s_lag_1h:d h2s_lag_3h:d h2s_lag_6h:d h2s_rolling_6h:d h2s_rolling_24h:d flow_lag_6h:d flow_rolling_24h:d wind_speed_10m_avg_3h:d wind_gusts_10m_max_4h:d", """
SELECT network, site_name, obs_time, step, CASE WHEN step < 1 THEN h2s_last ELSE h2s_last * exp(-(step - 1) / 12.0) END h2s_lag_1h,
  CASE WHEN step < 3 THEN h2s_last ELSE h2s_last * exp(-(step - 3) / 12.0) END h2s_lag_3h,
  CASE WHEN step < 6 THEN h2s_last ELSE h2s_last * exp(-(step - 6) / 12.0) END h2s_lag_6h,
  h2s_6 * exp(-step / 12.0) h2s_rolling_6h, h2s_24 * exp(-step / 36.0) h2s_rolling_24h, flow_last flow_lag_6h, flow_24 flow_rolling_24h,
  avg(wind_speed_10m) OVER (PARTITION BY network, site_name ORDER BY step ROWS 2 PRECEDING) wind_speed_10m_avg_3h,
  max(wind_speed_10m * 1.8) OVER (PARTITION BY network, site_name ORDER BY step ROWS 3 PRECEDING) wind_gusts_10m_max_4h
FROM fc JOIN seed USING (network)""", FC)
def _(i):
    fc = earliest(i.obs(), ["network", "obs_time"], ["event_id"]).drop("site_name", "h2s", "h2s_measured", "flow_border", "event_id")
    return forecast_features(fc, seed_state(i.clean()), ["network"])


@query("a18_station_summary", "A18", "network:i site_name:s last_time:t last_h2s:d mean_24h:d max_24h:d pct_exceed_5:d", """
SELECT network, site_name, max(obs_time) last_time, max_by(h2s, obs_time) last_h2s, avg(h2s) mean_24h, max(h2s) max_24h,
  100 * avg(CASE WHEN h2s > 5 THEN 1.0 ELSE 0 END) pct_exceed_5 FROM clean WHERE obs_time >= (SELECT max(obs_time) FROM clean) - INTERVAL 24 HOUR GROUP BY ALL""")
def _(i):
    return A.station_summary(X.since_latest(i.clean(), "24 HOURS"), SITE)


@query("a19_forecast_rollup", "A19 E1", "network:i site_name:s max_h2s:d max_prob_5:d max_prob_10:d hours_orange:i hours_yellow_high:i hours_yellow_low:i hours_green:i", """
SELECT network, site_name, max(model_ppb) max_h2s, max(prob_5) max_prob_5, max(prob_10) max_prob_10, count(CASE WHEN risk = 'ORANGE' THEN 1 END) hours_orange,
  count(CASE WHEN risk = 'YELLOW_HIGH' THEN 1 END) hours_yellow_high, count(CASE WHEN risk = 'YELLOW_LOW' THEN 1 END) hours_yellow_low,
  count(CASE WHEN risk = 'GREEN' THEN 1 END) hours_green FROM (
  SELECT *, CASE WHEN prob_10 > 0.5 OR model_ppb > 30 THEN 'ORANGE' WHEN prob_5 > 0.5 OR model_ppb > 10 THEN 'YELLOW_HIGH'
    WHEN prob_5 > 0.25 OR model_ppb > 5 THEN 'YELLOW_LOW' ELSE 'GREEN' END AS risk FROM scored) GROUP BY ALL""")
def _(i):
    d = i.scored().withColumn("risk", K.risk_tier(F.col("prob_5"), F.col("prob_10"), F.col("model_ppb"))).withColumnRenamed("model_ppb", "h2s_pred")
    return A.forecast_rollup(d, SITE)


EVENTS = """
up AS (SELECT c.*, tier, thr, epoch(obs_time - lag(obs_time) OVER (PARTITION BY network, site_name, tier ORDER BY obs_time)) AS gap
  FROM clean c JOIN (VALUES ('watch', 30.0), ('critical', 100.0)) t(tier, thr) ON h2s >= thr),
isl AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 10800 THEN 1 ELSE 0 END) OVER w AS event_no,
  sum(CASE WHEN gap > 5400 AND gap <= 10800 THEN 1 ELSE 0 END) OVER w AS brk FROM up
  WINDOW w AS (PARTITION BY network, site_name, tier ORDER BY obs_time ROWS UNBOUNDED PRECEDING)),
first_brk AS (SELECT network, site_name, tier, event_no, min(brk) AS brk FROM isl GROUP BY ALL),
events_of AS (SELECT isl.* FROM isl JOIN first_brk USING (network, site_name, tier, event_no, brk))"""


@query("w14_a45_exceedance_events", "W14 A45 E31", "network:i site_name:s tier:s event_no:i event_start:t last_exceedance:t n:i peak:d peak_time:t mean_h2s:d n_watch:i n_critical:i mean_direction:d closed:b", f"""
SELECT network, site_name, tier, event_no, min(obs_time) event_start, max(obs_time) last_exceedance, count(*) n, max(h2s) peak,
  min_by(obs_time, (-h2s, obs_time)) peak_time, avg(h2s) mean_h2s, count(CASE WHEN h2s >= 30 THEN 1 END) n_watch, count(CASE WHEN h2s >= 100 THEN 1 END) n_critical,
  {mod360('degrees(atan2(avg(sin(radians(wind_direction_10m))), avg(cos(radians(wind_direction_10m)))))')} mean_direction,
  max(obs_time) + INTERVAL 90 MINUTE <= TIMESTAMP '2024-01-30 12:00:00' AS closed
FROM events_of GROUP BY network, site_name, tier, event_no""", EVENTS)
def _(i):
    return L.exceedance_events(i.clean(), SITE, F.lit("2024-01-30 12:00:00").cast("timestamp"))


@query("s13_k05_event_index", "S13 K5", "event_id:s generated_at:t network:i site_name:s tier:s peak:d", """
SELECT concat_ws('_', network, replace(site_name, ' ', '-'), tier, strftime(event_start, '%Y%m%dT%H%M')) AS event_id, last_exceedance AS generated_at, * FROM (
  SELECT network, site_name, tier, event_no, min(obs_time) event_start, max(obs_time) last_exceedance, max(h2s) peak FROM events_of GROUP BY ALL)
ORDER BY last_exceedance DESC, event_id LIMIT 500""", EVENTS)
def _(i):
    from airq.sources.sinks import newest_index, with_event_id

    ev = with_event_id(L.exceedance_events(i.clean(), SITE), ["network", "site_name"])
    return newest_index(ev.withColumn("generated_at", F.col("last_exceedance")), 500)


@query("e27_river_strength", "E27", "network:i source:s strength:d n:i", f"""
SELECT network, source, count(*) n, avg(least(50, base * CASE WHEN fd THEN least(2, fl / 50) ELSE 1 END * CASE WHEN td THEN 1.5 - tide_height * 0.5 ELSE 1 END
  * greatest(0.5, least(1.5, 1 + (temperature_2m - 20) * 0.02)) * CASE WHEN kind = 'bridge' THEN 1.3 ELSE 1 END)) AS strength
FROM (SELECT *, coalesce(flow_border * 12, 50.0) AS fl FROM clean) CROSS JOIN {values([(n, k, b, f, t) for n, k, b, f, t, _ in C.RIVER_SOURCES], "source, kind, base, fd, td")} GROUP BY ALL""")
def _(i):
    src = C.literal_table(i.spark, [(n, k, b, int(f), int(t)) for n, k, b, f, t, _ in C.RIVER_SOURCES], "source string, kind string, base double, fd int, td int")
    d = pair_with(i.clean().withColumn("fl", F.coalesce(F.col("flow_border") * 12, F.lit(50.0))), src)
    s = emission.river_strength(F.col("base"), F.col("kind"), F.col("fd") == 1, F.col("td") == 1, F.col("fl"), F.col("tide_height"), F.col("temperature_2m"))
    return d.groupBy("network", "source").agg(F.count("*").alias("n"), F.avg(s).alias("strength"))
