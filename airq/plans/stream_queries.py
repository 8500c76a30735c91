"""Streams over the event files, run over all data present, against their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq.operators.ordering import latest
from airq.plans.inputs import Inputs
from airq.plans.io_queries import FEED_SQL, _feed, _split_site
from airq.plans.registry import query
from airq.plans.tier_queries import _tier_cells, G, RECORDS
from airq.session import scratch_path
from airq.streaming import machines as M
from airq.streaming import streams as S

KEYS = ["network", "site_name"]


def readings(i: Inputs):
    """The event table as a stream of readings."""
    fields = i.table("events").schema
    raw = S.parquet_stream(i.spark, i.sf_dir, fields, glob="events.parquet")
    ts = F.col("ts").cast("timestamp")
    return raw.select(
        "event_id", F.expr("user_id div 3").alias("network"),
        F.when(F.col("user_id") % 3 == 0, "NESTOR - BES").when(F.col("user_id") % 3 == 1, "IB CIVIC CTR").otherwise("SAN YSIDRO").alias("site_name"),
        ts.alias("time"), (F.col("value") * F.col("value") / 97.0).alias("h2s_ppb"))


@query("st01_reading_stream", "ST1 S3", "network:i site_name:s time:t h2s_ppb:d", "SELECT * FROM feed", FEED_SQL)
def _(i):
    path = scratch_path(i.spark, "feed")
    _feed(i).repartition(4).write.option("header", True).csv(path)
    return _split_site(S.run_available(S.sensor_csv_stream(i.spark, path, max_files=2), "readings"))


@query("st02_deduplicated_stream", "ST2", "network:i site_name:s time:t h2s_ppb:d",
       "SELECT network, site_name, obs_time AS time, h2s AS h2s_ppb FROM readings")
def _(i):
    # the same file delivered twice, as a poll that re-reads the whole file does
    path = scratch_path(i.spark, "twice")
    once = i.readings().select(*KEYS, F.col("obs_time").alias("time"), F.col("h2s").alias("h2s_ppb"))
    once.unionAll(once).write.parquet(path)
    return S.run_available(S.deduplicated(S.parquet_stream(i.spark, path, once.schema), KEYS), "dedup")


WM = "(SELECT max(obs_time) - INTERVAL 2 HOUR FROM readings)"
WIN = "network:i site_name:s window_start:t window_end:t mean:d max:d n:i"


@query("st06_tumbling_hours", "ST6", WIN, f"""
SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM (SELECT network, site_name, date_trunc('hour', obs_time) AS window_start, avg(h2s) mean, max(h2s) max, count(*) n
  FROM readings GROUP BY ALL) WHERE window_start + INTERVAL 1 HOUR <= {WM}""")
def _(i):
    return S.run_available(S.hourly(readings(i), KEYS), "hourly")


@query("st09_late_rows", "ST9", WIN, f"""
SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM (SELECT network, site_name, date_trunc('hour', obs_time) AS window_start, avg(h2s) mean, max(h2s) max, count(*) n
  FROM readings GROUP BY ALL) WHERE window_start + INTERVAL 1 HOUR <= {WM}""")
def _(i):
    """Readings, then altered copies of those whose windows the watermark has closed: the copies change nothing."""
    path, cp, out = (scratch_path(i.spark, x) for x in ("late-in", "late-cp", "late-out"))
    once = i.readings().select(*KEYS, F.col("obs_time").alias("time"), F.col("h2s").alias("h2s_ppb"))
    late = once.filter(F.col("time") < once.agg(F.max("time") - F.expr("INTERVAL 4 HOURS")).scalar()).withColumn("h2s_ppb", F.col("h2s_ppb") + 1000)
    for part in (once, late):
        part.write.mode("append").parquet(path)
        got = S.run_available(S.hourly(S.parquet_stream(i.spark, path, once.schema), KEYS), "late", checkpoint=cp, sink=out)
    return got


@query("st07_sliding_day", "ST7", "network:i windows:i mean_sum:d max:d n:i", f"""
SELECT network, count(*) AS windows, sum(mean) mean_sum, max(mx) max, sum(n) n FROM (
  SELECT network, date_trunc('hour', obs_time) - to_hours(k) AS window_start, avg(h2s) mean, max(h2s) mx, count(*) n
  FROM readings CROSS JOIN range(24) t(k) GROUP BY ALL) WHERE window_start + INTERVAL 24 HOUR <= {WM} GROUP BY network""")
def _(i):
    d = S.run_available(S.rolling_day(readings(i), ["network"]), "rolling")
    return d.groupBy("network").agg(F.count("*").alias("windows"), F.sum("mean").alias("mean_sum"), F.max("max").alias("max"), F.sum("n").alias("n"))


@query("st08_exceedance_sessions", "ST8", WIN, f"""
SELECT network, site_name, min(obs_time) AS window_start, max(obs_time) + INTERVAL 3 HOUR AS window_end, avg(h2s) mean, max(h2s) max, count(*) n FROM (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 10800 THEN 1 ELSE 0 END) OVER (PARTITION BY network, site_name ORDER BY obs_time) s FROM (
    SELECT *, epoch(obs_time - lag(obs_time) OVER (PARTITION BY network, site_name ORDER BY obs_time)) gap FROM readings WHERE h2s >= 30))
GROUP BY network, site_name, s HAVING max(obs_time) + INTERVAL 3 HOUR <= (SELECT max(obs_time) - INTERVAL 2 HOUR FROM readings WHERE h2s >= 30)""")
def _(i):
    return S.run_available(S.exceedance_sessions(readings(i), KEYS, 30.0), "sessions")


EVENT_ROWS = """
SELECT network, site_name, tier, 'onset' AS trigger, min(obs_time) AS event_start, min(obs_time) AS last_exceedance FROM ev_rows GROUP BY network, site_name, tier, event_no
UNION ALL SELECT network, site_name, tier, 'summary', min(obs_time), max(obs_time) FROM ev_rows GROUP BY network, site_name, tier, event_no
HAVING max(obs_time) + INTERVAL 90 MINUTE <= any_value(wm)"""
EVENT_CTES = """
up AS (SELECT r.*, tier, wm, epoch(obs_time - lag(obs_time) OVER (PARTITION BY network, site_name, tier ORDER BY obs_time)) AS gap
  FROM readings r JOIN (VALUES ('watch', 30.0), ('critical', 100.0)) t(tier, thr) ON h2s >= thr
  CROSS JOIN (SELECT max(obs_time) - INTERVAL 2 HOUR AS wm FROM readings) WHERE obs_time <= wm),
isl AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 10800 THEN 1 ELSE 0 END) OVER w AS event_no,
  sum(CASE WHEN gap > 5400 AND gap <= 10800 THEN 1 ELSE 0 END) OVER w AS brk FROM up
  WINDOW w AS (PARTITION BY network, site_name, tier ORDER BY obs_time ROWS UNBOUNDED PRECEDING)),
ev_rows AS (SELECT isl.* FROM isl JOIN (SELECT network, site_name, tier, event_no, min(brk) AS brk FROM isl GROUP BY ALL) USING (network, site_name, tier, event_no, brk))"""


@query("st03_event_machine", "ST3 W14", "network:i site_name:s tier:s trigger:s event_start:t last_exceedance:t", EVENT_ROWS, EVENT_CTES)
def _(i):
    return S.run_available(M.event_stream(readings(i)), "events")


MESSAGES = """
SELECT network, evaluated_at, tier, horizons, n_onsets, sent, CASE WHEN sent THEN '' WHEN evaluated_at - last_sent < INTERVAL 3 HOUR THEN 'sent recently' ELSE 'higher tier active' END AS reason
FROM (
  WITH RECURSIVE sends AS (
    SELECT network, tier, min(evaluated_at) AS t FROM cand WHERE NOT hidden GROUP BY network, tier
    UNION ALL
    SELECT s.network, s.tier, min(c.evaluated_at) FROM sends s JOIN cand c ON c.network = s.network AND c.tier = s.tier AND NOT c.hidden AND c.evaluated_at >= s.t + INTERVAL 3 HOUR
    GROUP BY s.network, s.tier)
  SELECT c.*, max(CASE WHEN s.t = c.evaluated_at THEN 1 ELSE 0 END) = 1 AS sent, max(CASE WHEN s.t < c.evaluated_at THEN s.t END) AS last_sent
  FROM cand c LEFT JOIN sends s ON s.network = c.network AND s.tier = c.tier GROUP BY ALL)
WHERE evaluated_at < (SELECT max(evaluated_at) - INTERVAL 2 HOUR FROM rec)"""
MESSAGE_CTES = RECORDS + """,
states AS (
  SELECT *, fired AND (NOT coalesce(was, false) OR prev IS NULL OR epoch(evaluated_at - prev) >= 10800) AS onset FROM (
    SELECT *, lag(active) OVER w AS was, lag(lastf) OVER w AS prev FROM (
      SELECT *, grp > 0 AND sum(c) OVER (PARTITION BY network, tier, horizon, grp ORDER BY evaluated_at) < 3 AS active FROM (
        SELECT network, tier, horizon, evaluated_at, fired, CASE WHEN NOT fired AND score < 0.3 THEN 1 ELSE 0 END AS c,
          sum(CASE WHEN fired THEN 1 ELSE 0 END) OVER v AS grp, max(CASE WHEN fired THEN evaluated_at END) OVER v AS lastf
        FROM rec WINDOW v AS (PARTITION BY network, tier, horizon ORDER BY evaluated_at)))
    WINDOW w AS (PARTITION BY network, tier, horizon ORDER BY evaluated_at))),
above AS (
  SELECT o.network, o.evaluated_at, o.tier, o.horizon, coalesce(bool_or(a.active), false) AS hidden
  FROM states o LEFT JOIN states a ON a.network = o.network AND a.evaluated_at = o.evaluated_at AND a.horizon = o.horizon AND a.tier > o.tier
  WHERE o.onset GROUP BY ALL),
cand AS (SELECT network, tier, evaluated_at, string_agg(horizon, ',' ORDER BY horizon) AS horizons, count(*) AS n_onsets, bool_and(hidden) AS hidden FROM above GROUP BY ALL)"""


@query("st05_tier_messages", "ST4 ST5", "network:i evaluated_at:t tier:s horizons:s n_onsets:i sent:b reason:s", MESSAGES, MESSAGE_CTES)
def _(i):
    from airq.operators.tiers import backtest

    path = scratch_path(i.spark, "cycles")
    cycles = M.cycle_rows(backtest(_tier_cells(i), G))
    cycles.write.parquet(path)
    return S.run_available(M.tier_message_stream(S.parquet_stream(i.spark, path, cycles.schema)), "messages")


@query("st10_enriched_stream", "ST10 J21", "event_id:i network:i h2s_ppb:d temperature_2m:d max_ppb:d", """
SELECT r.event_id, r.network, r.h2s AS h2s_ppb, w.temperature_2m, f.max_ppb FROM readings r
LEFT JOIN (SELECT network, temperature_2m FROM obs QUALIFY row_number() OVER (PARTITION BY network ORDER BY obs_time DESC, event_id DESC) = 1) w USING (network)
LEFT JOIN (SELECT network, site_name, max(model_ppb) AS max_ppb FROM obs GROUP BY ALL) f ON f.network = r.network AND f.site_name = r.site_name""")
def _(i):
    fc = i.obs().groupBy(*KEYS).agg(F.max("model_ppb").alias("max_ppb"))
    weather = latest(i.obs(), ["network"], ["obs_time", "event_id"], keep=["temperature_2m"])
    return S.run_available(S.enriched(readings(i), fc, weather, KEYS), "enriched")


@query("st12_report_archive", "ST12 S13", "network:i onsets:i summaries:i ids:i", f"""
SELECT network, count(CASE WHEN trigger = 'onset' THEN 1 END) AS onsets, count(CASE WHEN trigger = 'summary' THEN 1 END) AS summaries,
  count(DISTINCT concat_ws('_', site_name, tier, trigger, strftime(event_start, '%Y%m%d%H%M'))) AS ids FROM ({EVENT_ROWS}) GROUP BY network""", EVENT_CTES)
def _(i):
    from airq.sources.sinks import archive_batch, with_event_id

    path = scratch_path(i.spark, "archive")
    ev = with_event_id(M.event_stream(readings(i)), KEYS)
    ev = ev.withColumn("event_id", F.concat_ws("_", "event_id", "trigger"))
    S.run_available(ev, "archive", foreach_batch=archive_batch(path))
    d = i.spark.read.parquet(path)
    hit = lambda t: F.count(F.when(F.col("trigger") == t, 1))
    return d.groupBy("network").agg(hit("onset").alias("onsets"), hit("summary").alias("summaries"), F.count_distinct("event_id").alias("ids"))



@query("st12_archive_of_two_runs", "ST12 S13", "network:i onsets:i summaries:i ids:i reports:i", f"""
SELECT network, count(CASE WHEN trigger = 'onset' THEN 1 END) AS onsets, count(CASE WHEN trigger = 'summary' THEN 1 END) AS summaries,
  count(DISTINCT concat_ws('_', site_name, tier, trigger, strftime(event_start, '%Y%m%d%H%M'))) AS ids, count(*) AS reports FROM ({EVENT_ROWS}) GROUP BY network""", EVENT_CTES)
def _(i):
    """The stream runs twice, the second time under a new checkpoint: every event is archived twice, compacted after each run, and read once."""
    from airq.sources.sinks import ReportArchive, with_event_id

    archive = ReportArchive(i.spark, scratch_path(i.spark, "reports"))
    ev = with_event_id(M.event_stream(readings(i)), KEYS)
    ev = ev.withColumn("event_id", F.concat_ws("_", "event_id", "trigger"))
    for run in ("first", "second"):
        S.run_available(ev, f"reports-{run}", foreach_batch=archive.writer(run))
        archive.compact()
    hit = lambda t: F.count(F.when(F.col("trigger") == t, 1))
    return archive.read().groupBy("network").agg(hit("onset").alias("onsets"), hit("summary").alias("summaries"), F.count_distinct("event_id").alias("ids"), F.count("*").alias("reports"))
