"""Horizon cells, gates, scores, backtest records and reports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions.features import base_features
from airq.operators import alerts as L
from airq.operators import tiers as T
from airq.plans.daily_queries import STATIONS_SQL
from airq.plans.registry import query

G = ["network"]


def _obs(i):
    return base_features(i.obs())


def _cells(i):
    return T.horizon_cells(_obs(i), G)


def _tier_cells(i):
    return T.tier_cells(_obs(i), C.stations(i.spark), G)


HZ = ", ".join(f"('{n}', {a}, {b})" for n, a, b in C.HORIZONS)
MEANS = ", ".join(f"avg({m}) AS {m}" for m in T.MEANS)
FIRSTS = ", ".join(f"min(CASE WHEN h2s >= {p} THEN obs_time END) AS first_{t}" for t, p in C.TIER_PPB)
CELLS = f"""
ob AS (SELECT *, sbiwtp_flow_mgd - 23.5 AS sbiwtp_anomaly, 0.0 AS sbiwtp_sli, 0.0 AS sbiwtp_deficit, ln(1 + greatest(flow_border, 0)) AS flow_log,
  CASE WHEN wind_speed_10m < 5 AND (hour(obs_time) >= 20 OR hour(obs_time) <= 5) THEN 1 ELSE 0 END AS stable_atm,
  CASE WHEN hour(obs_time - INTERVAL 8 HOUR) >= 20 OR hour(obs_time - INTERVAL 8 HOUR) <= 7 THEN 1 ELSE 0 END AS ln FROM obs),
spine AS (SELECT network, unnest(generate_series(min(obs_time), max(obs_time) - INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS evaluated_at FROM ob GROUP BY network),
cells AS (
  SELECT s.network, s.evaluated_at, st.site_name, h.horizon, count(o.event_id) AS n, {MEANS}, min(wind_speed_10m) AS wind_speed_min, min(temperature_2m) AS temp_min,
    avg(ln) AS night_share, max(h2s) AS h2s_max, {FIRSTS},
    avg(-wind_speed_10m * sin(radians(wind_direction_10m))) AS wind_u, avg(-wind_speed_10m * cos(radians(wind_direction_10m))) AS wind_v
  FROM spine s CROSS JOIN {STATIONS_SQL} st CROSS JOIN (VALUES {HZ}) h(horizon, a, b)
  LEFT JOIN ob o ON o.network = s.network AND o.site_name = st.site_name
    AND o.obs_time >= s.evaluated_at + to_hours(h.a) AND o.obs_time < s.evaluated_at + to_hours(h.b)
  GROUP BY s.network, s.evaluated_at, st.site_name, h.horizon),"""
CN = [*T.MEANS, "wind_speed_min", "temp_min"]
EFF = ", ".join(f"CASE WHEN c.n > 0 THEN c.{m} ELSE m.{m} END AS {m}" for m in CN)


def score_sql(tier: str) -> str:
    def part(stats):
        return " + ".join(f"coalesce({w} * ({f} - {stats[f][0]}) / {stats[f][1]}, 0)" for f, w in C.TIER_WEIGHTS[tier].items())

    return (f"least(0.95, 1 / (1 + exp(-CAST(CASE WHEN n_active <= 1 THEN {part(C.SINGLE_STATION_STATS)} "
            f"ELSE {part(C.QUIET_STATS)} END AS DOUBLE))))")


NB, IB = C.PRIMARY_STATION, C.BACKUP_STATION
BELL = ", ".join(f"CASE WHEN nb_ok THEN nb_{m} ELSE ib_{m} END AS {m}" for m in CN)
RECORDS = CELLS + f"""
known AS (SELECT network, bool_or(site_name = '{NB}') OR count(DISTINCT site_name) = 1 AS has, count(DISTINCT site_name) AS n_sites, min(site_name) AS lone_site, count(DISTINCT CASE WHEN h2s IS NOT NULL THEN site_name END) AS n_active FROM ob GROUP BY network),
feat AS (SELECT c.network, c.evaluated_at, c.horizon, c.site_name, k.n_active, NOT k.has AS degraded, (c.n > 0 OR m.n > 0) AS ok, coalesce(m.night_share < 0.75, false) AS day, c.h2s_max,
    c.first_tier_1, c.first_tier_2, c.first_tier_3, {EFF} FROM cells c JOIN known k USING (network)
  LEFT JOIN cells m ON m.network = c.network AND m.evaluated_at = c.evaluated_at AND m.horizon = c.horizon AND m.n > 0
    AND m.site_name = CASE WHEN k.n_sites = 1 THEN k.lone_site WHEN k.has THEN '{NB}' ELSE '{IB}' END),
g1 AS (SELECT *, wind_speed_10m IS NOT NULL AS gate1, count(wind_speed_10m) OVER (PARTITION BY network, evaluated_at, horizon) AS n_t1 FROM feat),
g2 AS (SELECT *, coalesce(gate1 AND n_t1 >= least(2, greatest(1, n_active)) AND wind_speed_10m < 4, false) AS gate2 FROM g1),
g3 AS (SELECT *, coalesce(gate2 AND temp_min > 13 AND dewpoint_2m > 11 AND stable_atm > 0.6, false) AS gate3 FROM g2),
tc0 AS (SELECT network, evaluated_at, horizon, bool_or(gate1) gate_tier_1, bool_or(gate2) gate_tier_2, bool_or(gate3) gate_tier_3, max(n_t1) n_t1, max(n_active) n_active,
    bool_or(degraded) degraded, coalesce(bool_or(site_name = '{NB}' AND ok), false) AS nb_ok, bool_or(site_name = '{NB}' AND ok AND day) AS daytime_horizon,
    bool_or(ok AND site_name IN ('{NB}', '{IB}')) AS bell_ok,
    coalesce(max(CASE WHEN site_name = '{NB}' THEN h2s_max END), 0) AS primary_max, coalesce(max(CASE WHEN site_name = '{IB}' THEN h2s_max END), 0) AS backup_max,
    coalesce(max(h2s_max), 0) AS any_max,
    {", ".join(f"count(CASE WHEN h2s_max >= {p} THEN 1 END) AS exceeding_{t}, min(first_{t}) AS first_{t}" for t, p in C.TIER_PPB)},
    {", ".join(f"max(CASE WHEN site_name = '{NB}' THEN {m} END) AS nb_{m}, max(CASE WHEN site_name = '{IB}' THEN {m} END) AS ib_{m}" for m in CN)}
  FROM g3 GROUP BY network, evaluated_at, horizon),
tc1 AS (SELECT *, {BELL} FROM tc0),
tc AS (SELECT *, {", ".join(f"{score_sql(t)} AS score_{t}" for t, _ in C.TIER_PPB)} FROM tc1),
fires AS (SELECT *, gate_tier_1 AND score_tier_1 >= 0.5 AS f1, gate_tier_1 AND score_tier_1 >= 0.5 AND gate_tier_2 AND score_tier_2 >= 0.5 AS f2,
  gate_tier_1 AND score_tier_1 >= 0.5 AND gate_tier_2 AND score_tier_2 >= 0.5 AND gate_tier_3 AND score_tier_3 >= 0.5 AS f3 FROM tc),
rec AS (
  {" UNION ALL ".join(f"SELECT network, evaluated_at, horizon, daytime_horizon, n_active <= 1 AS single_station_mode, primary_max, backup_max, any_max, '{t}' AS tier, gate_{t} AS gate_passed, round(score_{t}, 4) AS score, f{k} AS fired, exceeding_{t} AS n_stations_exceeding, epoch(first_{t} - evaluated_at) / 3600.0 AS lead_time_hours, primary_max >= {p} AS primary_exceeds FROM fires" for k, (t, p) in enumerate(C.TIER_PPB, 1))})"""

SUM_COLS = ["n", "sbiwtp_flow_mgd", "precipitation", "flow_log", "wind_speed_10m", "stable_atm", "temperature_2m", "wind_speed_min", "temp_min", "night_share", "h2s_max"]


ALL_CELLS = CELLS.replace("LEFT JOIN ob o", "JOIN ob o").replace(
    "unnest(generate_series(min(obs_time), max(obs_time) - INTERVAL 24 HOUR, INTERVAL 1 HOUR))",
    "unnest(generate_series(min(obs_time) - INTERVAL 23 HOUR, max(obs_time), INTERVAL 1 HOUR))")


@query("j09_horizon_cells", "J9 J10 W9 A22", "network:i site_name:s horizon:s cells:i " + " ".join(f"{c}:d" for c in SUM_COLS) + " exceed_30:i",
       "SELECT network, site_name, horizon, count(*) cells, " + ", ".join(f"sum({c}) AS {c}" for c in SUM_COLS)
       + ", count(first_tier_3) exceed_30 FROM cells GROUP BY ALL", ALL_CELLS)
def _(i):
    return _cells(i).groupBy("network", "site_name", "horizon").agg(
        F.count("*").alias("cells"), *[F.sum(c).alias(c) for c in SUM_COLS], F.count("first_tier_3").alias("exceed_30"))


DIR = "{a} - 360 * floor(({a}) / 360)".replace("{a}", "degrees(atan2(-wind_u, -wind_v))")


@query("a22_window_direction", "A22", "site_name:s horizon:s sin_dir:d cos_dir:d n:i", f"""
SELECT site_name, horizon, avg(sin(radians({DIR}))) sin_dir, avg(cos(radians({DIR}))) cos_dir, count(wind_u) n FROM cells WHERE wind_u <> 0 OR wind_v <> 0 GROUP BY ALL""", ALL_CELLS)
def _(i):
    d = F.radians(T.mean_direction(F.col("wind_u"), F.col("wind_v")))
    return _cells(i).filter("wind_u <> 0 OR wind_v <> 0").groupBy("site_name", "horizon").agg(F.avg(F.sin(d)).alias("sin_dir"), F.avg(F.cos(d)).alias("cos_dir"), F.count("wind_u").alias("n"))


@query("e25_e26_gates_and_scores", "E25 E26 A54", "network:i horizon:s n:i gate_1:i gate_2:i gate_3:i n_t1:i n_active:i score_tier_1:d score_tier_2:d score_tier_3:d day:i", """
SELECT network, horizon, count(*) n, count(CASE WHEN gate_tier_1 THEN 1 END) gate_1, count(CASE WHEN gate_tier_2 THEN 1 END) gate_2, count(CASE WHEN gate_tier_3 THEN 1 END) gate_3,
  sum(n_t1) n_t1, max(n_active) n_active, sum(score_tier_1) score_tier_1, sum(score_tier_2) score_tier_2, sum(score_tier_3) score_tier_3,
  count(CASE WHEN daytime_horizon THEN 1 END) AS day FROM tc GROUP BY ALL""", RECORDS)
def _(i):
    b = lambda c, n: F.count(F.when(F.col(c), 1)).alias(n)
    return _tier_cells(i).groupBy("network", "horizon").agg(
        F.count("*").alias("n"), b("gate_tier_1", "gate_1"), b("gate_tier_2", "gate_2"), b("gate_tier_3", "gate_3"), F.sum("n_t1").alias("n_t1"),
        F.max("n_active").alias("n_active"), *[F.sum(f"score_{t}").alias(f"score_{t}") for t, _ in C.TIER_PPB], b("daytime_horizon", "day"))


SOLO = "(SELECT * REPLACE (network * 3 + CASE site_name WHEN '{a}' THEN 0 WHEN '{b}' THEN 1 ELSE 2 END AS network) FROM obs)".format(a=NB, b=IB)


@query("a54_one_station_groups", "A54 J16", "network:i tier:s horizon:s n:i fired:i gates:i score:d exceeding:i lead:d primary_max:d any_max:d n_t1:i degraded:i", """
SELECT network, tier, horizon, count(*) n, count(CASE WHEN fired THEN 1 END) fired, count(CASE WHEN gate_passed THEN 1 END) gates, sum(score) score,
  sum(n_stations_exceeding) exceeding, sum(lead_time_hours) lead, sum(primary_max) primary_max, sum(any_max) any_max, max(m) n_t1, max(g) degraded
FROM rec JOIN (SELECT network, sum(n_t1) m, count(CASE WHEN degraded THEN 1 END) g FROM tc GROUP BY network) USING (network) GROUP BY network, tier, horizon""",
       RECORDS.replace("FROM obs)", f"FROM {SOLO})"))
def _(i):
    """Every station as a network of its own."""
    site = F.when(F.col("site_name") == NB, 0).when(F.col("site_name") == IB, 1).otherwise(2)
    cells = T.tier_cells(_obs(i).withColumn("network", F.col("network") * 3 + site), C.stations(i.spark), G)
    rows = T.backtest(cells, G, keep=["n_t1", "degraded"]).groupBy("network", "tier", "horizon").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("fired"), 1)).alias("fired"), F.count(F.when(F.col("gate_passed"), 1)).alias("gates"),
        F.sum("score").alias("score"), F.sum("n_stations_exceeding").alias("exceeding"), F.sum("lead_time_hours").alias("lead"),
        F.sum("primary_max").alias("primary_max"), F.sum("any_max").alias("any_max"),
        F.sum("n_t1").alias("_t1"), F.count(F.when(F.col("degraded"), 1)).alias("_degraded"))
    # a cell has a record per tier; one tier's rows give the network's sums
    one, whole = F.col("tier") == C.TIER_PPB[0][0], W.partitionBy("network")
    return rows.withColumns({"n_t1": F.sum(F.when(one, F.col("_t1"))).over(whole), "degraded": F.sum(F.when(one, F.col("_degraded"))).over(whole)}).drop("_t1", "_degraded")


@query("a23_backtest_records", "A23 A54", "network:i tier:s horizon:s n:i fired:i gates:i score:d exceeding:i lead:d primary_max:d any_max:d", """
SELECT network, tier, horizon, count(*) n, count(CASE WHEN fired THEN 1 END) fired, count(CASE WHEN gate_passed THEN 1 END) gates, sum(score) score,
  sum(n_stations_exceeding) exceeding, sum(lead_time_hours) lead, sum(primary_max) primary_max, sum(any_max) any_max FROM rec GROUP BY ALL""", RECORDS)
def _(i):
    return T.backtest(_tier_cells(i), G).groupBy("network", "tier", "horizon").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("fired"), 1)).alias("fired"), F.count(F.when(F.col("gate_passed"), 1)).alias("gates"),
        F.sum("score").alias("score"), F.sum("n_stations_exceeding").alias("exceeding"), F.sum("lead_time_hours").alias("lead"),
        F.sum("primary_max").alias("primary_max"), F.sum("any_max").alias("any_max"))


FIRE = "precision:d recall:d f1:d mean_lead_time_h:d n_events:i n_fires:i n_rows:i"


def fire_sql(keys: str, actual: str, group: str | None = None) -> str:
    return f"""
SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  tp + fn AS n_events, tp + fp AS n_fires FROM (SELECT {keys}, count(CASE WHEN fired AND {actual} THEN 1 END) tp, count(CASE WHEN fired AND NOT {actual} THEN 1 END) fp,
  count(CASE WHEN NOT fired AND {actual} THEN 1 END) fn, avg(CASE WHEN fired AND {actual} THEN lead_time_hours END) mean_lead_time_h, count(*) n_rows
  FROM rec2 GROUP BY {group or keys})"""


REC2 = RECORDS + """,
rec2 AS (SELECT *, strftime(evaluated_at, '%Y-%m') AS month, CASE WHEN daytime_horizon THEN 'day' ELSE 'night' END AS period FROM rec)"""


@query("a24_tier3_scores", "A24", f"network:i horizon:s {FIRE}",
       fire_sql("network, horizon", "(n_stations_exceeding >= 1)").replace("FROM rec2", "FROM rec2 WHERE tier = 'tier_3'"), REC2)
def _(i):
    return T.firing_scores(T.backtest(_tier_cells(i), G).filter("tier = 'tier_3'"), ["network", "horizon"], F.col("n_stations_exceeding") >= 1)


REPORT = fire_sql("tier, coalesce(month, 'ALL') AS month, horizon, coalesce(period, 'all') AS period", "primary_exceeds",
                  "GROUPING SETS ((tier, month, horizon, period), (tier, horizon))")


@query("a25_tier_report", "A25", f"tier:s month:s horizon:s period:s {FIRE}", REPORT, REC2)
def _(i):
    return T.tier_report(T.backtest(_tier_cells(i), G))


@query("a47_monthly_counts", "A47", "month:s n_events:i n_fires:i far:d", f"""
SELECT month, sum(n_events) n_events, sum(n_fires) n_fires, (sum(n_fires) - least(sum(n_events), sum(n_fires))) / nullif(sum(n_fires), 0) AS far
FROM ({REPORT}) WHERE tier = 'tier_3' AND month <> 'ALL' GROUP BY month""", REC2)
def _(i):
    return T.monthly_counts(T.tier_report(T.backtest(_tier_cells(i), G)))


@query("a47_f1_matrix", "A47", "tier:s horizon:s period:s jan:d", f"""
SELECT tier, horizon, period, max(CASE WHEN month = '2024-01' THEN f1 END) AS jan FROM ({REPORT}) WHERE month <> 'ALL' GROUP BY ALL""", REC2)
def _(i):
    return T.f1_matrix(T.tier_report(T.backtest(_tier_cells(i), G)), ["2024-01"]).withColumnRenamed("2024-01", "jan")


@query("a47_lead_times", "A47", "horizon:s part:s q1:d median:d q3:d", """
SELECT horizon, part, quantile_cont(lead_time_hours, 0.25) q1, median(lead_time_hours) median, quantile_cont(lead_time_hours, 0.75) q3 FROM (
  SELECT *, 'all' AS part FROM rec UNION ALL SELECT *, 'night' FROM rec WHERE NOT daytime_horizon)
WHERE tier = 'tier_3' AND fired AND primary_exceeds GROUP BY ALL""", RECORDS)
def _(i):
    return T.lead_times(T.backtest(_tier_cells(i), G))


QN = [m for m in T.MEANS]


@query("a26_quiet_night_stats", "A26", "feature:s mean:d std:d", "\nUNION ALL ".join(
    f"SELECT '{m}' AS feature, avg(nb_{m}) AS mean, stddev_samp(nb_{m}) AS std FROM tc WHERE horizon = 'nowcast' AND primary_max < 1 AND nb_ok "
    "AND (hour(evaluated_at - INTERVAL 8 HOUR) >= 20 OR hour(evaluated_at - INTERVAL 8 HOUR) <= 7)" for m in QN), RECORDS)
def _(i):
    return T.quiet_night_stats(_tier_cells(i))


ZS = "\nUNION ALL ".join(
    f"SELECT network, evaluated_at, horizon, '{f}' AS feature, abs(({f} - CASE WHEN n_active <= 1 THEN {C.SINGLE_STATION_STATS[f][0]} ELSE {C.QUIET_STATS[f][0]} END) "
    f"/ CASE WHEN n_active <= 1 THEN {C.SINGLE_STATION_STATS[f][1]} ELSE {C.QUIET_STATS[f][1]} END) AS z FROM tc WHERE {f} IS NOT NULL AND bell_ok"
    for f in C.TIER_WEIGHTS["tier_3"])


@query("w16_top_contributors", "W16", "network:i horizon:s feature:s n:i abs_z:d", f"""
SELECT network, horizon, feature, count(*) n, sum(z) abs_z FROM (SELECT *, row_number() OVER (PARTITION BY network, evaluated_at, horizon ORDER BY z DESC, feature DESC) rn FROM zs)
WHERE rn <= 4 GROUP BY ALL""", RECORDS + f", zs AS ({ZS})")
def _(i):
    return T.top_contributors(_tier_cells(i), G).groupBy("network", "horizon", "feature").agg(F.count("*").alias("n"), F.sum("abs_z").alias("abs_z"))


@query("w15_debounced_cells", "W15 ST4", "network:i tier:s horizon:s cycles:i onsets:i active:i clear_cycles:i", """
SELECT network, tier, horizon, count(*) cycles, count(CASE WHEN fired AND (NOT coalesce(was, false) OR prev IS NULL OR epoch(evaluated_at - prev) >= 10800) THEN 1 END) onsets,
  count(CASE WHEN active THEN 1 END) active, sum(cc) clear_cycles FROM (
  SELECT *, lag(active) OVER (PARTITION BY network, tier, horizon ORDER BY evaluated_at) was, lag(lastf) OVER (PARTITION BY network, tier, horizon ORDER BY evaluated_at) prev FROM (
    SELECT *, grp > 0 AND cl < 3 AS active, CASE WHEN grp > 0 THEN least(cl, 3) ELSE 0 END cc FROM (
      SELECT *, sum(c) OVER (PARTITION BY network, tier, horizon, grp ORDER BY evaluated_at) cl FROM (
        SELECT *, CASE WHEN NOT fired AND score < 0.3 THEN 1 ELSE 0 END c,
          sum(CASE WHEN fired THEN 1 ELSE 0 END) OVER (PARTITION BY network, tier, horizon ORDER BY evaluated_at) grp,
          max(CASE WHEN fired THEN evaluated_at END) OVER (PARTITION BY network, tier, horizon ORDER BY evaluated_at) lastf FROM rec))))
GROUP BY network, tier, horizon""", RECORDS)
def _(i):
    # the cells' chunks are the blocks of the scan, so a block's records are where its cells were made
    rows = T.backtest(T.tier_cells(_obs(i), C.stations(i.spark), G, chunk_as="week"), G, keep=["week"])
    d = L.debounce(rows.select("network", "tier", "horizon", "evaluated_at", "fired", "score", "week"), ["network", "tier", "horizon"], block="week")
    return d.groupBy("network", "tier", "horizon").agg(
        F.count("*").alias("cycles"), F.count(F.when(F.col("send_onset"), 1)).alias("onsets"), F.count(F.when(F.col("active"), 1)).alias("active"),
        F.sum("clear_cycles").alias("clear_cycles"))
