"""Confusion counts, scorecards, regression and rank metrics, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import schema
from airq.functions.classes import flag
from airq.operators import features as X
from airq.operators import metrics as M
from airq.operators import quality as Q
from airq.operators import scorecards as S
from airq.operators.ordering import latest
from airq.plans.inputs import PRED_SQL
from airq.plans.registry import query
from airq.session import scratch_path
from airq.sources.rollups import DailyRollup

SITE = X.SITE
PERS = """
pers AS (SELECT *, lag(h2s, 1) OVER (PARTITION BY network, site_name ORDER BY obs_time) AS persistence FROM base),
"""


def sums_sql(keys: str, src: str, group: str | None = None) -> str:
    cols = ", ".join(
        f"sum(CASE WHEN actual='{c}' THEN n ELSE 0 END) sup_{c}, sum(CASE WHEN predicted='{c}' THEN n ELSE 0 END) pred_{c}, "
        f"sum(CASE WHEN actual='{c}' AND predicted='{c}' THEN n ELSE 0 END) tp_{c}" for c in M.CLASSES)
    by = f"GROUP BY {group or keys}" if (group or keys) else ""
    return f"SELECT {keys + ', ' if keys else ''}sum(n) n, {cols} FROM {src} {by}"


def scores_sql(src: str, zero: str = "NULL") -> str:
    rec = " + ".join(f"coalesce(tp_{c} / nullif(sup_{c}, 0), 0)" for c in M.CLASSES)
    have = " + ".join(f"CASE WHEN sup_{c} > 0 THEN 1 ELSE 0 END" for c in M.CLASSES)
    per = ", ".join(
        f"coalesce(tp_{c} / nullif(sup_{c}, 0), {zero}) {c}_recall, coalesce(tp_{c} / nullif(pred_{c}, 0), {zero}) {c}_precision, "
        f"coalesce(2.0 * tp_{c} / nullif(sup_{c} + pred_{c}, 0), {zero}) {c}_f1" for c in M.CLASSES)
    return (f"SELECT *, ({rec}) / nullif({have}, 0) AS balanced_accuracy, (tp_green + tp_yellow + tp_orange) / nullif(n, 0) AS accuracy, "
            f"{per}, coalesce((pred_orange - tp_orange) / nullif(n - sup_orange, 0), {zero}) AS false_alarm_rate FROM ({src})")


CM = "cm AS (SELECT network, site_name, actual, predicted, count(*) n FROM scored GROUP BY ALL)"
SCORE_SPEC = ("balanced_accuracy:d accuracy:d green_recall:d green_precision:d green_f1:d yellow_recall:d yellow_precision:d "
              "yellow_f1:d orange_recall:d orange_precision:d orange_f1:d false_alarm_rate:d")


@query("a01_confusion", "A1", "network:i site_name:s actual:s predicted:s n:i", "SELECT * FROM cm", CM)
def _(i):
    return M.confusion(i.scored(), SITE)


@query("a02_combined_confusion", "A2", "actual:s predicted:s n:i",
       "SELECT actual, predicted, sum(n) n FROM cm GROUP BY ALL", CM)
def _(i):
    return M.combine(M.confusion(i.scored(), SITE), [])


@query("a03_a05_class_scores", "A3 A4 A5", f"network:i site_name:s n:i {SCORE_SPEC}",
       scores_sql(sums_sql("network, site_name", "cm")), CM)
def _(i):
    return M.confusion_scores(M.confusion(i.scored(), SITE), SITE)


@query("a04_training_metrics", "A4", f"n:i {SCORE_SPEC}", scores_sql(sums_sql("", "cm"), "0"), CM)
def _(i):
    return M.confusion_scores(M.confusion(i.scored(), []), [], zero=0.0)


HITS = "hits AS (SELECT *, CASE WHEN actual = 'orange' THEN 1 ELSE 0 END AS hit, least(CAST(floor(prob_30 * 10) AS INT), 9) AS bin FROM scored)"


def _hits(i):
    return i.scored().withColumn("hit", flag(F.col("actual") == "orange"))


@query("a06_a07_brier_ece", "A6 A7", "network:i site_name:s n:i brier:d ece:d", """
SELECT network, site_name, sum(n) n, sum(sq) / sum(n) brier, sum(abs(p - h)) / sum(n) ece FROM (
  SELECT network, site_name, bin, count(*) n, sum(prob_30) p, sum(hit) h, sum((prob_30 - hit) * (prob_30 - hit)) sq FROM hits GROUP BY ALL)
GROUP BY ALL""", HITS)
def _(i):
    return M.calibration_error(_hits(i), SITE, "prob_30", "hit")


@query("a08_reliability_bins", "A8", "site_name:s bin:i bin_lo:d bin_hi:d n:i mean_pred:d observed_rate:d", """
SELECT s.site_name, b AS bin, b / 10 AS bin_lo, (b + 1) / 10 AS bin_hi, count(hit) n, avg(prob_30) mean_pred, avg(hit) observed_rate
FROM (SELECT DISTINCT site_name FROM hits) s CROSS JOIN range(10) t(b) LEFT JOIN hits h ON h.site_name = s.site_name AND h.bin = b
GROUP BY ALL""", HITS)
def _(i):
    return M.reliability(_hits(i), ["site_name"], "prob_30", "hit")


@query("a09_regression_scores", "A9", "network:i site_name:s n:i rmse:d mae:d bias:d r2:d", """
SELECT network, site_name, count(*) n, sqrt(avg(pow(model_ppb - h2s, 2))) rmse, avg(abs(model_ppb - h2s)) mae, avg(model_ppb - h2s) bias,
  CASE WHEN var_pop(h2s) > 0 THEN 1 - avg(pow(model_ppb - h2s, 2)) / var_pop(h2s) END r2 FROM scored GROUP BY ALL""")
def _(i):
    return M.regression_scores(i.scored(), SITE, "h2s", "model_ppb")


def thr_sql(y: str, p: str, ts) -> str:
    out = []
    for t in ts:
        a, b, c = f"{y} > {t} AND {p} IS NOT NULL", f"{p} > {t} AND {y} IS NOT NULL", f"{y} > {t} AND {p} > {t}"
        out.append(
            f"count(CASE WHEN {a} THEN 1 END) n_positives_{t}, count(CASE WHEN {b} THEN 1 END) n_predicted_{t}, "
            f"coalesce(count(CASE WHEN {c} THEN 1 END) / nullif(count(CASE WHEN {a} THEN 1 END), 0), 0) recall_{t}, "
            f"coalesce(count(CASE WHEN {c} THEN 1 END) / nullif(count(CASE WHEN {b} THEN 1 END), 0), 0) precision_{t}")
    return ", ".join(out)


def thr_spec(ts) -> str:
    return " ".join(f"n_positives_{t}:i n_predicted_{t}:i recall_{t}:d precision_{t}:d" for t in ts)


@query("a10_recall_at_threshold", "A10", f"site_name:s n:i {thr_spec((5, 10, 30, 100))}",
       f"SELECT site_name, count(*) n, {thr_sql('h2s', 'persistence', (5, 10, 30, 100))} FROM pers GROUP BY ALL", PERS)
def _(i):
    d = X.persistence(i.base())
    ts = (5.0, 10.0, 30.0, 100.0)
    return M.threshold_scores(d.groupBy("site_name").agg(F.count("*").alias("n"), *M.threshold_sums("h2s", "persistence", ts)), ts)


@query("a11_spearman", "A11", "network:i site_name:s n:i spearman:d", """
SELECT network, site_name, count(*) n, CASE WHEN count(*) >= 3 THEN corr(ry, rp) END AS spearman FROM (
  SELECT network, site_name, rank() OVER (PARTITION BY network, site_name ORDER BY h2s)
      + (count(*) OVER (PARTITION BY network, site_name, h2s) - 1) / 2.0 ry,
    rank() OVER (PARTITION BY network, site_name ORDER BY persistence)
      + (count(*) OVER (PARTITION BY network, site_name, persistence) - 1) / 2.0 rp
  FROM pers WHERE persistence IS NOT NULL) GROUP BY ALL""", PERS)
def _(i):
    return M.spearman(X.persistence(i.base()), SITE, "h2s", "persistence")


@query("a12_classifier_scores", "A12", "site_name:s n:i auc:d brier:d f1:d precision:d recall:d", """
SELECT site_name, count(*) n, avg(pow(prob_30 - hit, 2)) brier,
  (sum(hit * rk) - sum(hit) * (sum(hit) + 1) / 2) / (sum(hit) * (count(*) - sum(hit))) AS auc,
  coalesce(2.0 * sum(hit * said) / nullif(sum(hit) + sum(said), 0), 0) f1, coalesce(sum(hit * said) / nullif(sum(said), 0), 0) AS precision,
  coalesce(sum(hit * said) / nullif(sum(hit), 0), 0) recall
FROM (SELECT *, CASE WHEN prob_30 > 0.3 THEN 1 ELSE 0 END said, rank() OVER (PARTITION BY site_name ORDER BY prob_30)
    + (count(*) OVER (PARTITION BY site_name, prob_30) - 1) / 2.0 rk FROM hits) GROUP BY ALL""", HITS)
def _(i):
    return M.classifier_scores(_hits(i), ["site_name"], "hit", "prob_30")


@query("a13_calibration_report", "A13 A10 A11", f"scope:s slice:s n:i {thr_spec((30, 100))} spearman:d", f"""
SELECT a.*, s.spearman FROM (SELECT scope, slice, count(*) n, {thr_sql('h2s', 'persistence', (30, 100))} FROM scoped GROUP BY ALL) a
LEFT JOIN (SELECT scope, slice, CASE WHEN count(*) >= 3 THEN corr(ry, rp) END AS spearman FROM (
  SELECT scope, slice, rank() OVER (PARTITION BY scope, slice ORDER BY h2s)
      + (count(*) OVER (PARTITION BY scope, slice, h2s) - 1) / 2.0 ry,
    rank() OVER (PARTITION BY scope, slice ORDER BY persistence)
      + (count(*) OVER (PARTITION BY scope, slice, persistence) - 1) / 2.0 rp
  FROM scoped WHERE persistence IS NOT NULL) GROUP BY ALL) s USING (scope, slice)""", PERS + """
scoped AS (
  SELECT 'overall' AS scope, 'all' AS slice, h2s, persistence FROM pers
  UNION ALL SELECT 'site', network || '/' || site_name, h2s, persistence FROM pers
  UNION ALL SELECT 'regime', CASE WHEN stable_atm = 1 THEN 'calm_stable_atm_1' ELSE 'windy_stable_atm_0' END, h2s, persistence FROM pers)""")
def _(i):
    return M.calibration_report(X.persistence(i.base()), "h2s", "persistence", SITE)


@query("j02_prediction_observation_join", "J2", "network:i site_name:s obs_time:t h2s:d prediction:d", """
SELECT a.network, a.site_name, a.obs_time, b.h2s, a.model_ppb AS prediction FROM obs a
JOIN clean b ON a.network = b.network AND a.site_name = b.site_name AND a.obs_time = b.obs_time""")
def _(i):
    preds = i.obs().select(*SITE, "obs_time", F.col("model_ppb").alias("prediction"))
    return preds.join(i.clean().select(*SITE, "obs_time", "h2s"), [*SITE, "obs_time"])


@query("j03_nearest_join", "J3", "event_id:i network:i site_name:s pred_time:t obs_time:t h2s:d predicted_ppb:d",
       "SELECT * FROM matched", PRED_SQL)
def _(i):
    return S.match_predictions(i.predictions(), i.actuals())


@query("j03_nearest_join_by_site", "J3", "event_id:i site_name:s pred_time:t obs_time:t h2s:d predicted_ppb:d", """
SELECT * FROM (
    SELECT p.*, a.obs_time, a.h2s, row_number() OVER (PARTITION BY p.event_id
        ORDER BY abs(epoch_us(a.obs_time) - epoch_us(p.pred_time)), a.obs_time, a.actual_id) AS rn
    FROM preds p JOIN actuals a ON a.site_name = p.site_name
     AND a.obs_time BETWEEN p.pred_time - INTERVAL 30 MINUTE AND p.pred_time + INTERVAL 30 MINUTE) WHERE rn = 1""", PRED_SQL)
def _(i):
    return S.match_predictions(i.predictions(), i.actuals().drop("network"), ["site_name"])


CELLS = """
pc AS (SELECT * FROM (SELECT network, site_name, predicted, to_timestamp(round_even(epoch(ts) / 3600.0, 0) * 3600) AT TIME ZONE 'UTC' AS hour_time,
  row_number() OVER (PARTITION BY network, site_name, round_even(epoch(ts) / 3600.0, 0) ORDER BY ts DESC, event_id DESC) rn FROM (
    SELECT *, CASE WHEN value*value/97.0 < 5 THEN 'green' WHEN value*value/97.0 < 30 THEN 'yellow' ELSE 'orange' END AS predicted
    FROM r WHERE event_type = 'click')) WHERE rn = 1),
ac AS (SELECT * FROM (SELECT network, site_name, actual, to_timestamp(round_even(epoch(ts) / 3600.0, 0) * 3600) AT TIME ZONE 'UTC' AS hour_time,
  row_number() OVER (PARTITION BY network, site_name, round_even(epoch(ts) / 3600.0, 0) ORDER BY ts DESC, event_id DESC) rn FROM (
    SELECT *, CASE WHEN value*value/97.0 < 5 THEN 'green' WHEN value*value/97.0 < 30 THEN 'yellow' ELSE 'orange' END AS actual
    FROM r WHERE event_type = 'view')) WHERE rn = 1),
cells AS (SELECT coalesce(p.network, a.network) network, coalesce(p.site_name, a.site_name) site_name,
  coalesce(p.hour_time, a.hour_time) hour_time, predicted, actual FROM pc p FULL JOIN ac a
  ON p.network = a.network AND p.site_name = a.site_name AND p.hour_time = a.hour_time)"""


def _cells(i):
    from airq.functions.classes import three_class

    p = i.predictions().withColumnRenamed("pred_time", "obs_time").withColumn("predicted", three_class(F.col("predicted_ppb")))
    a = i.actuals().withColumnRenamed("actual_id", "event_id").withColumn("actual", three_class(F.col("h2s")))
    return S.hourly_cells(p, a, SITE)


@query("j04_hourly_cells", "J4", "network:i site_name:s hour_time:t hour:i predicted:s actual:s",
       "SELECT *, hour(hour_time) AS hour FROM cells", CELLS)
def _(i):
    return _cells(i)


@query("a48_match_rate", "A48", "network:i site_name:s matched:i mismatched:i match_rate:d", """
SELECT network, site_name, sum(CASE WHEN predicted = actual THEN 1 ELSE 0 END) matched,
  sum(CASE WHEN predicted <> actual THEN 1 ELSE 0 END) mismatched, avg(CASE WHEN predicted = actual THEN 1.0 ELSE 0 END) match_rate
FROM cells WHERE predicted IS NOT NULL AND actual IS NOT NULL GROUP BY ALL""", CELLS)
def _(i):
    same = flag(F.col("predicted") == F.col("actual"))
    return _cells(i).filter("predicted IS NOT NULL AND actual IS NOT NULL").groupBy(*SITE).agg(
        F.sum(same).alias("matched"), F.sum(1 - same).alias("mismatched"), F.avg(same).alias("match_rate"))


MCM = PRED_SQL + """,
mc AS (SELECT *, CASE WHEN h2s <= 5 THEN 'green' WHEN h2s <= 30 THEN 'yellow' ELSE 'orange' END actual,
  CASE WHEN predicted_ppb <= 5 THEN 'green' WHEN predicted_ppb <= 30 THEN 'yellow' ELSE 'orange' END predicted FROM matched),
mcm AS (SELECT network, site_name, actual, predicted, count(*) n FROM mc GROUP BY ALL)"""


@query("a14_site_scorecards", "A14", "network:s site_name:s n_predictions:i n_matched:i balanced_accuracy:d orange_recall:d "
       "orange_precision:d false_alarm_rate:d brier:d ece:d", f"""
SELECT m.network, m.site_name, m.n_predictions, coalesce(s.n, 0) AS n_matched, s.balanced_accuracy, s.orange_recall, s.orange_precision,
  s.false_alarm_rate, e.brier, e.ece
FROM (SELECT coalesce(CAST(network AS VARCHAR), '*') network, coalesce(site_name, '*') site_name, count(*) n_predictions FROM preds GROUP BY ROLLUP (network, site_name)) m
LEFT JOIN ({scores_sql(sums_sql("coalesce(CAST(network AS VARCHAR), '*') network, coalesce(site_name, '*') site_name", "mcm", "ROLLUP (network, site_name)"))}) s
  ON s.network = m.network AND s.site_name = m.site_name
LEFT JOIN (SELECT CAST(network AS VARCHAR) network, site_name, sum(sq) / sum(n) brier, sum(abs(p - h)) / sum(n) ece FROM (
  SELECT network, site_name, least(floor(probability_orange * 10), 9) b, count(*) n, sum(probability_orange) p,
    sum(CASE WHEN actual = 'orange' THEN 1 ELSE 0 END) h,
    sum(pow(probability_orange - CASE WHEN actual = 'orange' THEN 1 ELSE 0 END, 2)) sq FROM mc GROUP BY ALL) GROUP BY ALL) e
  ON e.network = m.network AND e.site_name = m.site_name""", MCM)
def _(i):
    return S.site_scorecards(i.predictions(), S.match_predictions(i.predictions(), i.actuals()))


@query("a15_regime_slices", "A15", f"regime:s n:i {SCORE_SPEC}",
       scores_sql(sums_sql("regime", "(SELECT regime, actual, predicted, count(*) n FROM mc GROUP BY ALL)")), MCM)
def _(i):
    return S.regime_scores(S.match_predictions(i.predictions(), i.actuals()), "regime")


DAILY = """
daily AS (SELECT CAST(obs_time AS DATE) AS day, CASE WHEN event_id % 3 = 0 THEN 'root' ELSE 'daily_station' END pipeline,
  network, site_name, actual, predicted, count(*) n FROM scored GROUP BY ALL),
eff AS (SELECT * FROM daily d WHERE pipeline = 'daily_station' OR NOT EXISTS (SELECT 1 FROM daily x WHERE x.day = d.day
  AND x.network = d.network AND x.site_name = d.site_name AND x.pipeline = 'daily_station'))"""
PERIODS = DAILY + """,
win AS (SELECT * FROM (VALUES ('daily', DATE '2024-01-30', DATE '2024-01-30'), ('rolling_7d', DATE '2024-01-23', DATE '2024-01-30'),
  ('rolling_30d', DATE '2023-12-31', DATE '2024-01-30'), ('rolling_90d', DATE '2023-11-01', DATE '2024-01-30'),
  ('monthly', DATE '2023-12-01', DATE '2023-12-31')) t(scope, s, e)),
placed AS (SELECT scope, s AS period_start, e AS period_end, network || '/' || site_name AS site, actual, predicted, n
  FROM eff JOIN win ON day BETWEEN s AND e),
sited AS (SELECT * FROM placed UNION ALL SELECT * REPLACE ('overall' AS site) FROM placed)"""


def _daily(i):
    d = i.scored().withColumns({
        "day": F.to_date("obs_time"), "pipeline": F.when(F.col("event_id") % 3 == 0, "root").otherwise("daily_station")})
    return M.confusion(d, ["day", "pipeline", *SITE])


ORDER = ["daily_station", "root"]


@query("a16_period_scorecards", "A16", f"scope:s period_start:s period_end:s site:s n:i {SCORE_SPEC}",
       scores_sql(sums_sql("scope, period_start, period_end, site", "sited")), PERIODS)
def _(i):
    return S.period_scorecards(S.effective_cells(_daily(i), ORDER), S.period_windows(i.spark, "2024-01-30"))


@query("a16_kept_scorecards", "A16 A46 A2", f"scope:s period_start:s period_end:s site:s n:i {SCORE_SPEC}",
       scores_sql(sums_sql("scope, period_start, period_end, site", "sited")), PERIODS)
def _(i):
    """The periods from kept daily counts: the first refresh sees the table without its last day and with wrong rows on another, the second
    reads those two days."""
    rows = i.scored().select("event_id", *SITE, "actual", "predicted", F.to_date("obs_time").alias("day"))
    pipeline = F.when(F.col("event_id") % 3 == 0, "root").otherwise("daily_station")
    source, store = scratch_path(i.spark, "days"), scratch_path(i.spark, "rollup")
    late, wrong = F.col("day") == F.lit("2024-01-30").cast("date"), F.col("day") == F.lit("2024-01-12").cast("date")
    early = rows.filter(~late).withColumn("predicted", F.when(wrong, "green").otherwise(F.col("predicted")))
    early.write.partitionBy("day").parquet(source)
    kept = DailyRollup(i.spark, source, store, lambda d: M.confusion(d.withColumn("pipeline", pipeline), ["day", "pipeline", *SITE]))
    kept.refresh()
    rows.filter(late | wrong).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(source)
    kept.refresh()
    return S.period_scorecards(S.effective_cells(kept.cells(), ORDER), S.period_windows(i.spark, "2024-01-30"))


@query("a17_alert_performance", "A17", "site:s orange_recall:d orange_precision:d orange_f1:d yellow_recall:d yellow_precision:d false_alarm_rate:d",
       scores_sql(sums_sql("site", "(SELECT * FROM sited WHERE scope = 'rolling_30d')"), "0"), PERIODS)
def _(i):
    win = S.period_windows(i.spark, "2024-01-30").filter("scope = 'rolling_30d'")
    return S.period_scorecards(S.effective_cells(_daily(i), ORDER), win, zero=0.0)


@query("a46_trend_and_shares", "A46", "day:s n:i balanced_accuracy:d orange_recall:d false_alarm_rate:d",
       scores_sql(sums_sql("day", "eff")), DAILY)
def _(i):
    return M.confusion_scores(S.effective_cells(_daily(i), ORDER), ["day"])


@query("a46_row_shares", "A46", "actual:s predicted:s n:i share:d", """
SELECT actual, predicted, sum(n) n, sum(n) / sum(sum(n)) OVER (PARTITION BY actual) share FROM eff GROUP BY actual, predicted""", DAILY)
def _(i):
    from pyspark.sql import Window as W

    cm = M.combine(S.effective_cells(_daily(i), ORDER), [])
    return cm.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("actual")))


@query("s06_metrics_documents", "S6", "day:s pipeline:s site_name:s actual:s predicted:s n:i", """
SELECT CAST(obs_time AS DATE) AS day, CASE WHEN network % 2 = 0 THEN 'daily_station' ELSE 'root' END AS pipeline,
  network || '/' || site_name AS site_name, actual, predicted, count(*) n FROM scored GROUP BY ALL""")
def _(i):
    from airq.sources.documents import confusion_to_documents, read_metrics_documents

    d = i.scored().select(F.to_date("obs_time").alias("day"),
                          F.when(F.col("network") % 2 == 0, "daily_station").otherwise("root").alias("pipeline"),
                          "network", F.concat_ws("/", F.col("network").cast("string"), "site_name").alias("site_name"), "actual", "predicted")
    path = scratch_path(i.spark, "metrics")
    docs = confusion_to_documents(M.confusion(d, ["day", "pipeline", "network", "site_name"]),
                                  nested=F.col("pipeline") == "daily_station", group=["network"])
    docs.write.json(path)
    return read_metrics_documents(i.spark, path).filter("n > 0")


@query("s16_flatten_scorecard", "S16", f"scope:s site:s n:i balanced_accuracy:d orange_recall:d false_alarm_rate:d",
       scores_sql(sums_sql("scope, site", "(SELECT * FROM sited WHERE site <> 'overall')")), PERIODS)
def _(i):
    from airq.sources.documents import flatten_sites, nest_sites

    cards = S.period_scorecards(S.effective_cells(_daily(i), ORDER), S.period_windows(i.spark, "2024-01-30"))
    cols = ["n", "balanced_accuracy", "orange_recall", "false_alarm_rate"]
    per = cards.filter("site <> 'overall'").withColumn("network", F.split("site", "/")[0])
    return flatten_sites(nest_sites(per, ["scope", "network"], "site", cols), ["scope"], "site")


@query("a27_column_quality", "A27", "column_name:s n:i present:i missing:i missing_pct:d min:d max:d mean:d", """
SELECT c AS column_name, count(*) n, count(v) present, count(*) - count(v) missing, 100.0 * (count(*) - count(v)) / count(*) AS missing_pct,
  min(v) min, max(v) max, avg(v) mean FROM (
  SELECT 'h2s' c, h2s v FROM obs UNION ALL SELECT 'wind_speed_10m', wind_speed_10m FROM obs UNION ALL SELECT 'flow_border', flow_border FROM obs
  UNION ALL SELECT 'temperature_2m', temperature_2m FROM obs) GROUP BY c""")
def _(i):
    return Q.column_quality(i.obs(), ["h2s", "wind_speed_10m", "flow_border", "temperature_2m"])


@query("a27_class_shares", "A27", "actual:s n:i pct:d",
       "SELECT actual, count(*) n, 100.0 * count(*) / (SELECT count(*) FROM scored) pct FROM scored GROUP BY actual")
def _(i):
    return Q.class_shares(i.scored(), "actual")


@query("a28_class_weights", "A28 E5", "class:s n:i weight:d", """
SELECT actual AS class, count(*) n, (SELECT count(*) FROM scored) / (3.0 * count(*)) * CASE WHEN actual = 'green' THEN 1 ELSE 3 END AS weight
FROM scored GROUP BY actual""")
def _(i):
    return M.class_weights(i.scored(), "actual")


@query("a29_fold_summary", "A29", "metric:s mean:d std:d min:d max:d", f"""
SELECT metric, avg(value) mean, stddev_pop(value) std, min(value) min, max(value) max FROM (
  UNPIVOT (SELECT balanced_accuracy, orange_recall, accuracy FROM ({scores_sql(sums_sql("network", "cm"))})) ON balanced_accuracy, orange_recall, accuracy
  INTO NAME metric VALUE value) GROUP BY metric""", CM)
def _(i):
    per = M.confusion_scores(M.confusion(i.scored(), ["network"]), ["network"])
    return M.fold_summary(M.wide_to_metrics(per, ["network"], ["balanced_accuracy", "orange_recall", "accuracy"]), ["metric"])


CMP = f"""
{CM},
n1 AS (UNPIVOT ({scores_sql(sums_sql("", "(SELECT actual, predicted, sum(n) n FROM cm WHERE site_name <> 'SAN YSIDRO' GROUP BY ALL)"))})
  ON balanced_accuracy, orange_recall, orange_precision, accuracy INTO NAME metric VALUE value),
n2 AS (UNPIVOT ({scores_sql(sums_sql("", "(SELECT actual, predicted, sum(n) n FROM cm WHERE site_name = 'SAN YSIDRO' GROUP BY ALL)"))})
  ON balanced_accuracy, orange_recall, orange_precision, false_alarm_rate INTO NAME metric VALUE value),
cmp AS (SELECT coalesce(a.metric, b.metric) metric, a.value new_value, b.value current_value, a.value - b.value difference,
  a.value IS NULL missing_in_new, b.value IS NULL missing_in_current,
  a.value - b.value >= CASE coalesce(a.metric, b.metric) WHEN 'balanced_accuracy' THEN -0.05 WHEN 'orange_recall' THEN -0.05 WHEN 'orange_precision' THEN -0.1 END AS gate_passed
  FROM n1 a FULL JOIN n2 b ON a.metric = b.metric)"""
FLOORS = {"balanced_accuracy": -0.05, "orange_recall": -0.05, "orange_precision": -0.10}


def _compare(i):
    cm = M.confusion(i.scored(), SITE)
    new = M.confusion_scores(cm.filter("site_name <> 'SAN YSIDRO'"), [])
    cur = M.confusion_scores(cm.filter("site_name = 'SAN YSIDRO'"), [])
    shared = ["balanced_accuracy", "orange_recall", "orange_precision"]
    return S.compare_metrics(M.wide_to_metrics(new, [], [*shared, "accuracy"]),
                             M.wide_to_metrics(cur, [], [*shared, "false_alarm_rate"]), FLOORS)


@query("j19_compare_metrics", "J19 U3", "metric:s new_value:d current_value:d difference:d missing_in_new:b missing_in_current:b gate_passed:b",
       "SELECT * FROM cmp", CMP)
def _(i):
    return _compare(i)


@query("m09_approval", "M9", "approved:b field_mismatch:b", """
SELECT coalesce(bool_and(gate_passed), true) AS approved, bool_or(missing_in_new OR missing_in_current) AS field_mismatch FROM cmp""", CMP)
def _(i):
    return S.approval(_compare(i))


DAYS = """
pd AS (SELECT DISTINCT network, CAST(obs_time AS DATE) AS day FROM obs),
md AS (SELECT DISTINCT network, CAST(obs_time AS DATE) AS day FROM clean WHERE h2s > 30)"""


def _days(i):
    key = ["network", F.to_date("obs_time").alias("day")]
    return i.obs().select(*key).distinct(), i.clean().filter("h2s > 30").select(*key).distinct()


@query("j20_days_without_metrics", "J20", "network:i day:s has_metrics:b", """
SELECT network, day, false AS has_metrics FROM pd ANTI JOIN md USING (network, day)
UNION ALL SELECT network, day, true FROM pd SEMI JOIN md USING (network, day)""", DAYS)
def _(i):
    p, m = _days(i)
    on = ["network", "day"]
    return p.join(m, on, "left_anti").withColumn("has_metrics", F.lit(False)).unionByName(
        p.join(m, on, "left_semi").withColumn("has_metrics", F.lit(True)))


@query("u03_u04_set_algebra", "U3 U4", "kind:s network:i day:s", """
SELECT 'both' AS kind, * FROM (SELECT * FROM pd INTERSECT SELECT * FROM md)
UNION ALL SELECT 'missing', * FROM (SELECT * FROM pd EXCEPT SELECT * FROM md)""", DAYS)
def _(i):
    p, m = _days(i)
    return p.intersect(m).withColumn("kind", F.lit("both")).unionByName(p.subtract(m).withColumn("kind", F.lit("missing")))


@query("u01_union_runs", "U1", "run_hour:i network:i n:i model_ppb:d day_night:s", """
SELECT run_hour, network, count(*) n, avg(model_ppb) model_ppb, max(day_night) day_night FROM (
  SELECT run_hour, network, model_ppb, NULL AS day_night FROM obs UNION ALL
  SELECT run_hour, network, h2s, 'night' FROM base WHERE is_night = 1) GROUP BY run_hour, network""")
def _(i):
    a = i.obs().select("run_hour", "network", "model_ppb")
    b = i.base().filter("is_night = 1").select("run_hour", "network", F.col("h2s").alias("model_ppb"), F.lit("night").alias("day_night"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("run_hour", "network").agg(
        F.count("*").alias("n"), F.avg("model_ppb").alias("model_ppb"), F.max("day_night").alias("day_night"))


EVENTS = "ev AS (SELECT DISTINCT network, obs_time FROM base WHERE h2s >= 30 AND stable_atm = 1)"


@query("f08_event_times", "F8 U2 K2", "network:i obs_time:t newest:i", """
SELECT network, obs_time, row_number() OVER (PARTITION BY network ORDER BY obs_time DESC) AS newest FROM ev QUALIFY newest <= 40""", EVENTS)
def _(i):
    from airq.operators.inversion import event_times

    return event_times(i.base(), ["network"], top=40)


@query("k02_strongest_hours", "K2", "network:i obs_time:t h2s:d", """
SELECT network, obs_time, max(h2s) h2s FROM clean GROUP BY ALL ORDER BY h2s DESC, network, obs_time LIMIT 40""")
def _(i):
    return i.clean().groupBy("network", "obs_time").agg(F.max("h2s").alias("h2s")).orderBy(F.desc("h2s"), "network", "obs_time").limit(40)


@query("a30_k04_lagged_correlation", "A30 K4", "feature:s peak:d", """
SELECT feature, max(abs(c)) peak FROM (SELECT feature, lag, CASE WHEN count(v) >= 10 THEN corr(y, v) END c FROM lagged GROUP BY ALL)
GROUP BY feature ORDER BY peak DESC, feature LIMIT 3""", """
rn AS (SELECT *, row_number() OVER (PARTITION BY network, site_name ORDER BY obs_time) AS seq FROM clean),
lagged AS (SELECT l AS lag, f AS feature, y, v FROM (
  SELECT l, a.h2s y, b.wind_speed_10m, b.temperature_2m, b.dewpoint_2m, b.relative_humidity_2m, b.tide_height FROM rn a
  CROSS JOIN range(-24, 25) t(l) LEFT JOIN rn b ON b.network = a.network AND b.site_name = a.site_name AND b.seq = a.seq - l)
  UNPIVOT INCLUDE NULLS (v FOR f IN (wind_speed_10m, temperature_2m, dewpoint_2m, relative_humidity_2m, tide_height)))""")
def _(i):
    feats = ["wind_speed_10m", "temperature_2m", "dewpoint_2m", "relative_humidity_2m", "tide_height"]
    return Q.top_features(Q.lagged_correlations(i.clean(), SITE, "h2s", feats), 3)


@query("a42_polar_bins", "A42", "network:i site_name:s dir_bin:i speed_bin:i mean_h2s:d n:i", """
SELECT network, site_name, least(floor(rad / (2 * pi() / 36)), 35) dir_bin, least(floor(greatest(least(wind_speed_10m, 15), 0) / 1.5), 9) speed_bin,
  avg(h2s) mean_h2s, count(*) n FROM (
  SELECT *, CASE WHEN radians(90 - wind_direction_10m) < 0 THEN radians(90 - wind_direction_10m) + 2 * pi() ELSE radians(90 - wind_direction_10m) END rad,
    max(obs_time) OVER (PARTITION BY network, site_name) top FROM obs)
WHERE obs_time >= top - INTERVAL 12 HOUR AND h2s IS NOT NULL AND wind_speed_10m IS NOT NULL GROUP BY ALL""")
def _(i):
    return Q.polar_bins(i.obs(), SITE)


@query("a43_daily_series", "A43", "day:t mean_h2s:d mean_flow:d yellow:i orange:i", """
SELECT date_trunc('day', obs_time) AS day, avg(h2s) mean_h2s, avg(flow_border) mean_flow,
  count(CASE WHEN h2s > 5 AND h2s <= 30 THEN 1 END) yellow, count(CASE WHEN h2s > 30 THEN 1 END) orange FROM obs GROUP BY 1""")
def _(i):
    return Q.daily_timeseries(i.obs())


@query("a43_hourly_means", "A43", "hour:t mean_h2s:d mean_flow_border:d",
       "SELECT obs_time AS hour, avg(h2s) mean_h2s, avg(flow_border) mean_flow_border FROM obs GROUP BY 1")
def _(i):
    return Q.hourly_means(i.obs(), ["h2s", "flow_border"])


@query("a44_baseline_medians", "A44", "network:i wind_speed_10m:d relative_humidity_2m:d sbiwtp_flow_mgd:d h2s:d", """
SELECT network, median(wind_speed_10m) wind_speed_10m, median(relative_humidity_2m) relative_humidity_2m,
  median(sbiwtp_flow_mgd) sbiwtp_flow_mgd, median(h2s) h2s
FROM (SELECT *, max(obs_time) OVER (PARTITION BY network) top FROM clean) WHERE obs_time >= top - INTERVAL 72 HOUR GROUP BY network""")
def _(i):
    return Q.baseline_medians(i.clean(), ["wind_speed_10m", "relative_humidity_2m", "sbiwtp_flow_mgd", "h2s"], keys=["network"])


@query("a49_daily_model_counts", "A49", "day:s model:s green:i yellow:i orange:i correct:i accuracy:d", """
SELECT CAST(obs_time AS DATE) AS day, model, count(CASE WHEN said = 'green' THEN 1 END) green, count(CASE WHEN said = 'yellow' THEN 1 END) yellow,
  count(CASE WHEN said = 'orange' THEN 1 END) orange, count(CASE WHEN said = actual THEN 1 END) correct,
  avg(CASE WHEN said = actual THEN 1.0 ELSE 0 END) accuracy FROM (
  SELECT obs_time, actual, 'model' AS model, predicted AS said FROM scored UNION ALL
  SELECT obs_time, actual, 'cut', CASE WHEN prob_30 > 0.35 THEN 'orange' WHEN prob_5 > 0.5 THEN 'yellow' ELSE 'green' END FROM scored) GROUP BY ALL""")
def _(i):
    cut = F.when(F.col("prob_30") > 0.35, "orange").when(F.col("prob_5") > 0.5, "yellow").otherwise("green")
    both = F.array(F.struct(F.lit("model").alias("model"), F.col("predicted").alias("said")), F.struct(F.lit("cut").alias("model"), cut.alias("said")))
    d = i.scored().select(F.to_date("obs_time").alias("day"), "actual", F.inline(both))
    hit = flag(F.col("said") == F.col("actual"))
    return d.groupBy("day", "model").agg(*[F.count(F.when(F.col("said") == c, 1)).alias(c) for c in M.CLASSES],
                                         F.sum(hit).alias("correct"), F.avg(hit).alias("accuracy"))


@query("a50_wind_bins", "A50", "wind_bin:i mean:d median:d max:d n:i", """
SELECT least(floor(wind_speed_10m), 5) wind_bin, avg(h2s) mean, median(h2s) median, max(h2s) max, count(*) n FROM clean
WHERE wind_speed_10m IS NOT NULL GROUP BY 1""")
def _(i):
    return Q.wind_bin_table(i.clean())


@query("a51_fullest_station", "A51", "network:i site_name:s n:i",
       "SELECT network, site_name, count(h2s) n FROM obs GROUP BY ALL ORDER BY n DESC, network, site_name LIMIT 1")
def _(i):
    return i.obs().groupBy(*SITE).agg(F.count("h2s").alias("n")).orderBy(F.desc("n"), *SITE).limit(1)


@query("a52_training_metadata", "A52", "rows:i first:t last:t mean:d std:d min:d max:d labelled:i", """
SELECT count(*) AS rows, min(obs_time) AS first, max(obs_time) AS last, avg(h2s) mean, stddev_samp(h2s) std, min(h2s) min, max(h2s) max,
  count(h2s) labelled FROM obs""")
def _(i):
    return Q.describe_training(i.obs())
