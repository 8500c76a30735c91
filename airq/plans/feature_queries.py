"""Filters, row features, windows, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import catalog as C
from airq import schema
from airq.functions import classes as K
from airq.functions import clock as T
from airq.functions.features import TIDAL_CODES_OLD, base_features, tidal_code
from airq.operators import features as X
from airq.operators.ordering import fill_missing, latest, number_rows, row_windows, time_windows
from airq.plans.registry import query

KEY = "network:i site_name:s obs_time:t"
SITE = X.SITE
OVER = "OVER (PARTITION BY network, site_name ORDER BY obs_time)"


@query("f01_measured_cap_clip", "F1", f"{KEY} h2s:d", "SELECT * FROM clean")
def _(i):
    return X.measured(i.obs())


@query("f02_positive_target", "F2", f"{KEY} h2s:d", "SELECT * FROM obs WHERE h2s > 0")
def _(i):
    return X.positive_target(i.obs())


@query("f03_through_month", "F3", "network:i site_name:s n:i last:t",
       "SELECT network, site_name, count(*) n, max(obs_time) AS last FROM obs WHERE obs_time < TIMESTAMP '2024-02-01' GROUP BY ALL")
def _(i):
    return X.through_month(i.obs(), "2024-01").groupBy(*SITE).agg(F.count("*").alias("n"), F.max("obs_time").alias("last"))


@query("f04_day_slice", "F4", f"{KEY} h2s:d",
       "SELECT * FROM obs WHERE obs_time >= TIMESTAMP '2024-01-15' AND obs_time < TIMESTAMP '2024-01-16'")
def _(i):
    return X.day_slice(i.obs(), "2024-01-15")


@query("f05_lookback_from_latest", "F5", f"{KEY} h2s:d",
       "SELECT * FROM clean WHERE obs_time >= (SELECT max(obs_time) FROM clean) - INTERVAL 7 DAY")
def _(i):
    return X.since_latest(i.clean(), "7 DAYS")


@query("f06_lookback_from_now", "F6", f"{KEY} h2s:d",
       "SELECT * FROM clean WHERE obs_time >= TIMESTAMP '2024-01-20 06:00:00' - INTERVAL 12 HOUR AND lower(site_name) LIKE '%nestor%'")
def _(i):
    return X.recent_site(i.clean(), "Nestor", "2024-01-20 06:00:00", 12)


PROBS = """
probs AS (
  SELECT *, 1.0 / (1.0 + model_ppb / 5.0) AS green, (1.0 - 1.0 / (1.0 + model_ppb / 5.0)) * share AS orange,
         (1.0 - 1.0 / (1.0 + model_ppb / 5.0)) * (1.0 - share) AS yellow FROM base)"""


def with_probs(df):
    g = F.lit(1.0) / (F.col("model_ppb") / 5.0 + 1.0)
    return df.withColumns({
        "green": g, "orange": (F.lit(1.0) - g) * F.col("share"), "yellow": (F.lit(1.0) - g) * (F.lit(1.0) - F.col("share")),
    })


@query("f07_alert_filter", "F7", f"{KEY} predicted_category:s orange:d", """
SELECT *, CASE WHEN orange >= 0.33 THEN 'orange' ELSE 'yellow' END AS predicted_category
FROM probs WHERE orange >= 0.33 OR yellow >= 0.33""", PROBS)
def _(i):
    d = with_probs(i.base()).withColumn(
        "predicted_category", K.decide(F.col("green"), F.col("orange"), F.col("yellow"), 0.33, 0.33))
    return d.filter(F.col("predicted_category").isin("orange", "yellow"))


@query("f09_dashboard_filter", "F9", f"{KEY} h2s:d",
       "SELECT * FROM obs WHERE year(obs_time) = 2024 AND site_name IN ('SAN YSIDRO', 'IB CIVIC CTR')")
def _(i):
    return i.obs().filter((F.year("obs_time") == 2024) & F.col("site_name").isin("SAN YSIDRO", "IB CIVIC CTR"))


@query("f11_conform_model_matrix", "F11", f"{KEY} wind_speed_10m:d flow_border:d not_delivered:d", """
SELECT network, site_name, obs_time, coalesce(wind_speed_10m, 0.0) AS wind_speed_10m,
       coalesce(flow_border, 0.0) AS flow_border, 0.0 AS not_delivered FROM obs""")
def _(i):
    return schema.model_matrix(i.obs(), ["wind_speed_10m", "flow_border", "not_delivered"], [*SITE, "obs_time"])


@query("f12_median_impute", "F12", f"{KEY} wind_speed_10m:d flow_border:d", """
SELECT network, site_name, obs_time,
  coalesce(wind_speed_10m, (SELECT median(wind_speed_10m) FROM obs)) AS wind_speed_10m,
  coalesce(flow_border, (SELECT median(flow_border) FROM obs)) AS flow_border FROM obs""")
def _(i):
    return X.impute_median(i.obs(), ["wind_speed_10m", "flow_border"])


ROWS = """
feat AS (
  SELECT *, wind_speed_10m * 1.8 AS wind_gusts_10m,
    lag(h2s, 1) {o} AS h2s_lag_1h, lag(h2s, 3) {o} AS h2s_lag_3h, lag(h2s, 6) {o} AS h2s_lag_6h,
    avg(h2s) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 5 PRECEDING) AS h2s_rolling_6h,
    avg(h2s) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 23 PRECEDING) AS h2s_rolling_24h,
    lag(flow_border, 6) {o} AS flow_lag_6h,
    avg(flow_border) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 23 PRECEDING) AS flow_rolling_24h,
    avg(wind_speed_10m) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 1 PRECEDING) AS wind_speed_10m_avg_2h,
    avg(wind_speed_10m) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 2 PRECEDING) AS wind_speed_10m_avg_3h,
    avg(wind_speed_10m) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 3 PRECEDING) AS wind_speed_10m_avg_4h,
    max(wind_speed_10m * 1.8) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 1 PRECEDING) AS wind_gusts_10m_max_2h,
    max(wind_speed_10m * 1.8) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 2 PRECEDING) AS wind_gusts_10m_max_3h,
    max(wind_speed_10m * 1.8) OVER (PARTITION BY network, site_name ORDER BY obs_time ROWS 3 PRECEDING) AS wind_gusts_10m_max_4h
  FROM base),
row_feat AS (
  SELECT *, sin(2*pi()*hour(obs_time)/24.0) AS hour_sin, cos(2*pi()*hour(obs_time)/24.0) AS hour_cos,
    sin(2*pi()*month(obs_time)/12.0) AS month_sin, cos(2*pi()*month(obs_time)/12.0) AS month_cos,
    sin(radians(wind_direction_10m)) AS wind_direction_sin, cos(radians(wind_direction_10m)) AS wind_direction_cos,
    CASE WHEN is_night = 0 THEN 0 WHEN wind_direction_10m >= 22.5 AND wind_direction_10m < 135 THEN 1
         WHEN wind_direction_10m >= 247.5 OR wind_direction_10m < 22.5 THEN 2 ELSE 3 END AS source_regime,
    ln(1 + greatest(flow_border, 0)) AS flow_log, CASE WHEN flow_border < 1 THEN 1 ELSE 0 END AS flow_low,
    CASE WHEN flow_border > 5 THEN 1 ELSE 0 END AS flow_high,
    wind_speed_10m * temperature_2m AS wind_temp_interaction,
    relative_humidity_2m * temperature_2m AS humidity_temp_interaction,
    wind_speed_10m * stable_atm AS wind_x_stable_atm,
    coalesce(CASE tidal_state WHEN 'flood' THEN 0 WHEN 'ebb' THEN 1 WHEN 'slack high' THEN 2 WHEN 'slack low' THEN 3 END, -1) AS tidal_state_encoded,
    sbiwtp_flow_mgd - 23.5 AS sbiwtp_anomaly,
    CASE WHEN h2s > 5 THEN 1 ELSE 0 END AS exceed_5, CASE WHEN h2s > 10 THEN 1 ELSE 0 END AS exceed_10,
    CASE WHEN h2s > 30 THEN 1 ELSE 0 END AS exceed_30
  FROM feat)""".replace("{o}", OVER)


@query("e06_e13_row_features", "E6 E7 E8 E9 E10 E11 E12 E13", KEY + (
    " hour_sin:d hour_cos:d month_sin:d month_cos:d wind_direction_sin:d wind_direction_cos:d is_night:i source_regime:i"
    " flow_log:d flow_low:i flow_high:i wind_gusts_10m:d wind_temp_interaction:d humidity_temp_interaction:d stable_atm:i"
    " wind_x_stable_atm:d tidal_state_encoded:i sbiwtp_anomaly:d sbiwtp_hourly_mgd:d"),
    "SELECT *, 23.5 / 24 AS sbiwtp_hourly_mgd FROM row_feat", ROWS)
def _(i):
    return base_features(i.clean())


@query("e07_night_rules", "E7", f"{KEY} utc_night:i local_night:i", """
SELECT *, night_flag AS utc_night,
  CASE WHEN hour(obs_time - INTERVAL 8 HOUR) >= 20 OR hour(obs_time - INTERVAL 8 HOUR) <= 7 THEN 1 ELSE 0 END AS local_night FROM base""")
def _(i):
    t = F.col("obs_time")
    return i.clean().withColumns({"utc_night": T.night(t), "local_night": T.night(t, "local")})


@query("e11_tidal_codes_old", "E11", f"{KEY} code:i", """
SELECT *, coalesce(CASE tidal_state WHEN 'ebb' THEN 0 WHEN 'flood' THEN 1 WHEN 'slack' THEN 2 WHEN 'slack high' THEN 3
  WHEN 'slack low' THEN 4 END, -1) AS code FROM obs""")
def _(i):
    return i.obs().withColumn("code", tidal_code(F.col("tidal_state"), TIDAL_CODES_OLD))


@query("w01_w02_station_windows", "W1 W2 E13 K1", KEY + (
    " h2s_lag_1h:d h2s_lag_3h:d h2s_lag_6h:d h2s_rolling_6h:d h2s_rolling_24h:d flow_lag_6h:d flow_rolling_24h:d"
    " wind_speed_10m_avg_2h:d wind_speed_10m_avg_3h:d wind_speed_10m_avg_4h:d wind_gusts_10m_max_2h:d"
    " wind_gusts_10m_max_3h:d wind_gusts_10m_max_4h:d"), "SELECT * FROM feat", ROWS)
def _(i):
    return X.station_windows(number_rows(base_features(i.clean()), SITE, "obs_time"))


@query("f13_training_features", "F13 F14 E14", KEY + " " + " ".join(f"{f}:d" for f in C.FEATURES_33)
       + " exceed_5:i exceed_10:i exceed_30:i",
       "SELECT * FROM row_feat WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in C.FEATURES_33), ROWS)
def _(i):
    return X.training_features(i.obs())


@query("f14_minimal_feature_set", "F14", KEY + " " + " ".join(f"{f}:d" for f in C.FEATURES_11),
       "SELECT * FROM row_feat WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in C.FEATURES_11), ROWS)
def _(i):
    return X.select_features(X.training_features(i.obs(), required=C.FEATURES_11), "minimal", [*SITE, "obs_time"])


@query("w03_persistence", "W3", f"{KEY} h2s:d persistence:d",
       "SELECT *, lag(h2s, 1) " + OVER + " AS persistence FROM clean")
def _(i):
    return X.persistence(i.clean())


@query("w04_time_gaps", "W4", f"{KEY} gap_hours:d", f"""
SELECT * FROM (SELECT *, epoch(obs_time - lag(obs_time) {OVER}) / 3600.0 AS gap_hours FROM obs) WHERE gap_hours > 24""")
def _(i):
    d = row_windows(number_rows(i.obs(), SITE, "obs_time"), SITE, 1, 0, lambda w: {
        "gap_hours": (T.epoch(F.col("obs_time")) - T.epoch(F.lag("obs_time").over(w))) / 3600.0})
    return d.filter("gap_hours > 24")


@query("w05_latest_per_site", "W5", f"{KEY} h2s:d event_id:i", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY network, site_name ORDER BY obs_time DESC) rn FROM obs) WHERE rn = 1""")
def _(i):
    return latest(i.obs(), SITE, ["obs_time"])


@query("w06_seed_state", "W6", "network:i site_name:s h2s_last:d h2s_6:d h2s_24:d flow_last:d flow_24:d", """
SELECT network, site_name, max(CASE WHEN rn = 1 THEN h2s END) AS h2s_last, avg(CASE WHEN rn <= 6 THEN h2s END) AS h2s_6,
  avg(h2s) AS h2s_24, coalesce(max(CASE WHEN rn = 1 THEN flow_border END), 2.0) AS flow_last,
  coalesce(avg(flow_border), 2.0) AS flow_24
FROM (SELECT *, row_number() OVER (PARTITION BY network, site_name ORDER BY obs_time DESC) rn FROM clean)
WHERE rn <= 24 GROUP BY network, site_name""")
def _(i):
    from airq.operators.forecast import seed_state

    return seed_state(i.clean())


RUNS = """
runs AS (
  SELECT network, obs_time, site_name, run_hour, event_id, model_ppb FROM obs)"""


@query("w07_keep_latest_run", "W7", "network:i obs_time:t run_hour:i event_id:i model_ppb:d", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY network, obs_time ORDER BY run_hour DESC, event_id DESC) rn FROM runs)
WHERE rn = 1""", RUNS)
def _(i):
    return latest(i.obs(), ["network", "obs_time"], ["run_hour", "event_id"], keep=["run_hour", "event_id", "model_ppb"])


@query("w08_quiet_before_onset", "W8", f"{KEY} h2s:d onset:b", """
SELECT *, h2s >= 30 AND coalesce(before < 30, true) AS onset FROM (
  SELECT *, max(h2s) OVER (PARTITION BY network, site_name ORDER BY obs_time
    RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING) AS before FROM clean)""")
def _(i):
    d = time_windows(i.clean(), SITE, "obs_time", 3 * 3600, 0,
                     lambda w: {"_b": F.max("h2s").over(w.rangeBetween(-3 * 3600, -1))})
    return d.withColumn("onset", (F.col("h2s") >= 30) & F.coalesce(F.col("_b") < 30, F.lit(True)))


@query("w10_chronological_split", "W10", f"{KEY} overall:s per_site:s", """
SELECT network, site_name, obs_time, CASE WHEN a <= floor(na * 0.7) THEN 'train' ELSE 'test' END AS overall,
  CASE WHEN s <= floor(ns * 0.8) THEN 'train' ELSE 'test' END AS per_site FROM (
  SELECT *, row_number() OVER (ORDER BY obs_time, event_id) a, count(*) OVER () na,
    row_number() OVER (PARTITION BY network, site_name ORDER BY obs_time) s, count(*) OVER (PARTITION BY network, site_name) ns
  FROM clean)""")
def _(i):
    d = X.chronological_split(i.clean(), 0.7, tie=["event_id"]).withColumnRenamed("split", "overall")
    return X.chronological_split(d, 0.8, SITE).withColumnRenamed("split", "per_site")


@query("w11_expanding_folds", "W11", "fold:i n:i first:t last:t", """
SELECT fold, count(*) n, min(obs_time) AS first, max(obs_time) AS last FROM (
  SELECT obs_time, CASE WHEN s <= n - 5 * (n // 6) THEN 0 ELSE (s - (n - 5 * (n // 6)) - 1) // (n // 6) + 1 END AS fold
  FROM (SELECT obs_time, row_number() OVER (ORDER BY obs_time, event_id) s, count(*) OVER () n FROM clean)) GROUP BY fold""")
def _(i):
    return X.expanding_folds(i.clean(), 5, tie=["event_id"]).groupBy("fold").agg(
        F.count("*").alias("n"), F.min("obs_time").alias("first"), F.max("obs_time").alias("last"))


@query("w13_fill_gaps", "W13", f"{KEY} wind_speed_10m:d flow_border:d", """
SELECT network, site_name, obs_time,
  coalesce(last_value(wind_speed_10m IGNORE NULLS) OVER f, first_value(wind_speed_10m IGNORE NULLS) OVER b) AS wind_speed_10m,
  coalesce(last_value(flow_border IGNORE NULLS) OVER f, first_value(flow_border IGNORE NULLS) OVER b) AS flow_border
FROM obs WINDOW f AS (PARTITION BY network, site_name ORDER BY obs_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY network, site_name ORDER BY obs_time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def _(i):
    cols = ["wind_speed_10m", "flow_border"]
    return fill_missing(fill_missing(i.obs(), SITE, "obs_time", cols), SITE, "obs_time", cols, forward=False)


@query("e01_risk_tier", "E1", f"{KEY} risk:s risk_no30:s", """
SELECT *, CASE WHEN (CASE WHEN prob_30 > 0 THEN prob_30 > 0.35 ELSE prob_10 > 0.5 END) OR model_ppb > 30 THEN 'ORANGE'
  WHEN prob_5 > 0.5 OR model_ppb > 10 THEN 'YELLOW_HIGH' WHEN prob_5 > 0.25 OR model_ppb > 5 THEN 'YELLOW_LOW' ELSE 'GREEN' END AS risk,
  CASE WHEN prob_10 > 0.5 OR model_ppb > 30 THEN 'ORANGE' WHEN prob_5 > 0.5 OR model_ppb > 10 THEN 'YELLOW_HIGH'
  WHEN prob_5 > 0.25 OR model_ppb > 5 THEN 'YELLOW_LOW' ELSE 'GREEN' END AS risk_no30 FROM scored""")
def _(i):
    c = F.col
    return i.scored().withColumns({
        "risk": K.risk_tier(c("prob_5"), c("prob_10"), c("model_ppb"), c("prob_30")),
        "risk_no30": K.risk_tier(c("prob_5"), c("prob_10"), c("model_ppb")),
    })


@query("e02_e05_class_cuts", "E2 E3 E4 E5", f"{KEY} left_closed:s right_closed:s five:s code:i from_risk:s", """
SELECT *, CASE WHEN v IS NULL THEN NULL WHEN v < 5 THEN 'green' WHEN v < 30 THEN 'yellow' ELSE 'orange' END AS left_closed,
  CASE WHEN v IS NULL THEN NULL WHEN v <= 5 THEN 'green' WHEN v <= 30 THEN 'yellow' ELSE 'orange' END AS right_closed,
  CASE WHEN v IS NULL THEN NULL WHEN v < 5 THEN 'green' WHEN v < 10 THEN 'yellow_low' WHEN v < 30 THEN 'yellow_high'
    WHEN v < 100 THEN 'orange' ELSE 'critical' END AS five,
  CASE WHEN v IS NULL THEN NULL WHEN v < 5 THEN 0 WHEN v < 30 THEN 2 ELSE 1 END AS code,
  CASE WHEN model_ppb > 30 THEN 'orange' WHEN model_ppb > 5 THEN 'yellow' ELSE 'green' END AS from_risk
FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN CAST(5 + 25 * (event_id % 2) AS DOUBLE) ELSE h2s END AS v FROM obs)""")
def _(i):
    v = F.when(F.col("event_id") % 7 == 0, (5 + 25 * (F.col("event_id") % 2)).cast("double")).otherwise(F.col("h2s"))
    d = i.obs().withColumn("v", v)
    left = K.three_class(F.col("v"))
    risk = K.risk_tier(F.lit(0.0), F.lit(0.0), F.col("model_ppb"))
    return d.withColumns({
        "left_closed": left, "right_closed": K.three_class(F.col("v"), "right"), "five": K.five_class(F.col("v")),
        "code": K.class_code(left), "from_risk": K.risk_to_class(risk),
    })


@query("e15_e16_decision", "E15 E16", f"{KEY} by_max:s by_cut:s confidence:d expected:d h2s_risk:d back:d", """
SELECT *, CASE WHEN green >= orange AND green >= yellow THEN 'green' WHEN orange >= yellow THEN 'orange' ELSE 'yellow' END AS by_max,
  CASE WHEN orange >= 0.25 THEN 'orange' WHEN yellow >= 0.33 THEN 'yellow' ELSE 'green' END AS by_cut,
  greatest(green, orange, yellow) AS confidence, pow(e, 1.23) / (pow(5.0, 1.23) + pow(e, 1.23)) AS h2s_risk, e AS expected,
  5.0 * pow(share / 2 / (1 - share / 2), 1 / 1.23) AS back
FROM (SELECT *, green * 2.5 + yellow * 17.5 + orange * 50.0 AS e FROM probs)""", PROBS)
def _(i):
    c = F.col
    d = with_probs(i.base())
    d = d.withColumn("expected", K.expected_ppb(c("green"), c("yellow"), c("orange")))
    return d.withColumns({
        "by_max": K.decide(c("green"), c("orange"), c("yellow")),
        "by_cut": K.decide(c("green"), c("orange"), c("yellow"), orange_cut=0.25),
        "confidence": F.greatest("green", "orange", "yellow"), "h2s_risk": K.hill(c("expected")),
        "back": K.hill_inverse(c("share") / 2),
    })


@query("e29_e30_time_keys", "E29 E30", "event_id:i rounded:t local_utc:t month:s iso_week:i day:s week:t", """
SELECT event_id, to_timestamp(round_even(epoch(obs_time) / 3600.0, 0) * 3600) AT TIME ZONE 'UTC' AS rounded,
  date_trunc('second', obs_time) + INTERVAL 8 HOUR AS local_utc, strftime(obs_time, '%Y-%m') AS month,
  weekofyear(obs_time) AS iso_week, strftime(obs_time, '%Y-%m-%d') AS day, date_trunc('week', obs_time) AS week FROM readings""")
def _(i):
    t = F.col("obs_time")
    return i.readings().withColumns({
        "rounded": T.round_to_hour(t), "local_utc": T.local_naive_to_utc(t), "month": T.month_key(t),
        "iso_week": F.weekofyear(t), "day": F.date_format(t, "yyyy-MM-dd"), "week": T.week_start(t),
    })


@query("e31_e33_labels", "E31 E33", f"{KEY} wind:s deficit:s local:s duration:s arrow:s", """
SELECT network, site_name, obs_time,
  CASE WHEN wind_speed_10m < 2 THEN 'calm — elevated dispersion risk' WHEN wind_speed_10m < 4 THEN 'light' ELSE 'moderate' END AS wind,
  CASE WHEN 23.5 - sbiwtp_flow_mgd <= 0 THEN format('{:.1f}', sbiwtp_flow_mgd) || ' MGD  (at or above baseline)'
   ELSE format('{:.1f}', sbiwtp_flow_mgd) || ' MGD  (deficit: ' || format('{:.1f}', 23.5 - sbiwtp_flow_mgd) || ' MGD below baseline)' END AS deficit,
  strftime(obs_time - INTERVAL 8 HOUR, '%a %b %-d, %Y  %H:%M') AS local,
  CASE WHEN mins = 0 THEN hrs || ' hr' ELSE hrs || ' hr ' || mins || ' min' END AS duration,
  CASE WHEN h2s IS NULL THEN '' WHEN abs(share - 0.5) < 0.005 THEN '➡️' WHEN share > 0.5 THEN '⬆️' ELSE '⬇️' END AS arrow
FROM (SELECT *, (event_id % 500) // 60 AS hrs, (event_id % 500) % 60 AS mins FROM obs)""")
def _(i):
    c = F.col
    end = F.timestamp_seconds(T.epoch(c("obs_time")) + c("event_id") % 500 * 60)
    return i.obs().select(
        *SITE, "obs_time", K.wind_flag(c("wind_speed_10m")).alias("wind"), K.deficit_label(c("sbiwtp_flow_mgd")).alias("deficit"),
        K.local_time_label(c("obs_time")).alias("local"), K.duration_label(c("obs_time"), end).alias("duration"),
        K.trend_arrow(F.when(c("h2s").isNotNull(), c("share")), F.lit(0.5)).alias("arrow"),
    )
