"""Round trips through sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import schema
from airq.operators import attribution as A
from airq.operators.alerts import exceedance_events
from airq.operators.features import SITE
from airq.operators.ordering import latest
from airq.operators.quality import odor_complaints
from airq.plans.daily_queries import EVENTS
from airq.plans.registry import query
from airq.session import scratch_path
from airq.sources import readers as R
from airq.sources import sinks as S

KEY = "network:i site_name:s obs_time:t"


@query("s01_observation_scan", "S1 F4", f"{KEY} h2s:d wind_speed_10m:d",
       "SELECT * FROM obs WHERE h2s_measured AND obs_time >= TIMESTAMP '2024-01-10' AND obs_time < TIMESTAMP '2024-01-20'")
def _(i):
    path = scratch_path(i.spark, "obs")
    i.obs().select(*schema.OBS.fieldNames()).write.parquet(path)
    return R.read_observations(i.spark, path, "2024-01-10", "2024-01-20")


@query("s02_forecast_scan", "S2", "source:s network:i n:i wind:d temp:d", """
SELECT source, network, count(*) n, sum(wind_speed_10m) AS wind, sum(temperature_2m) AS temp FROM obs CROSS JOIN (VALUES ('csv'), ('parquet')) t(source) GROUP BY ALL""")
def _(i):
    met = i.obs().select("network", F.col("obs_time").alias("date"), "wind_speed_10m", "temperature_2m")
    out = None
    for fmt in ("csv", "parquet"):
        path = scratch_path(i.spark, "fc")
        w = met.write.option("header", True)
        w.csv(path) if fmt == "csv" else w.parquet(path)
        one = R.read_forecast(i.spark, path, fmt).withColumn("source", F.lit(fmt))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("source", "network").agg(F.count("*").alias("n"), F.sum("wind_speed_10m").alias("wind"), F.sum("temperature_2m").alias("temp"))


FEED_SQL = """
feed AS (SELECT network, site_name, date_trunc('second', obs_time) AS time, h2s AS h2s_ppb FROM readings WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0)"""


def _feed(i):
    """The readings as the long text feed, with unreadable values, times and other parameters among them."""
    e = F.col("event_id")
    return i.readings().select(
        F.concat_ws("#", F.col("network").cast("string"), "site_name").alias("Site Name"),
        F.when(e % 19 == 0, "not a time").otherwise(F.date_format("obs_time", "yyyy-MM-dd HH:mm:ss")).alias("Date with time"),
        F.when(e % 23 == 0, "08 SO2 PPB").otherwise(R.H2S_PARAMETER).alias("Parameter"),
        F.when(e % 17 == 0, "n/a").otherwise(F.col("h2s").cast("string")).alias("Result"), F.lit("ok").alias("level"))


def _split_site(df):
    parts = F.split("site_name", "#")
    return df.withColumns({"network": parts[0].cast("bigint"), "site_name": parts[1]})


@query("s03_sensor_csv_scan", "S3", "network:i site_name:s time:t h2s_ppb:d", "SELECT * FROM feed", FEED_SQL)
def _(i):
    path = scratch_path(i.spark, "feed")
    _feed(i).write.option("header", True).csv(path)
    return _split_site(R.read_sensor_csv(i.spark, path))


@query("s04_spill_scan", "S4 J24", "location:s start_date:s end_date:s days:i", """
SELECT CAST(event_id AS VARCHAR) AS location, CAST(obs_time AS DATE) AS start_date, CAST(obs_time AS DATE) + CAST(event_id % 4 AS INT) AS end_date, event_id % 4 AS days
FROM obs WHERE h2s > 300""")
def _(i):
    path = scratch_path(i.spark, "spills")
    day = F.to_date("obs_time")
    e = F.col("event_id")
    i.obs().filter("h2s > 300").select(
        F.lit("32.5").alias("Latitude"), F.lit("-117.1").alias("Longitude"), e.cast("string").alias("Discharge Location"),
        F.when(e % 2 == 0, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("Start Date"),
        F.date_format(F.date_add(day, (e % 4).cast("int")), "M/d/yyyy").alias("End Date"), F.lit("~1 MG").alias("Approximate Discharge Volume"),
    ).write.option("header", True).csv(path)
    return R.read_spills(i.spark, path).withColumn("days", F.datediff("end_date", "start_date"))


@query("s05_f10_odor_complaints", "S5 F10 A43", "day:s complaints:i", """
SELECT CAST(ts AS DATE) AS day, count(*) complaints FROM r WHERE event_type IN ('view', 'error') GROUP BY 1""")
def _(i):
    path = scratch_path(i.spark, "complaints")
    text = F.when(F.col("event_type") == "view", "Strong ODOR at night").when(F.col("event_type") == "error", "odor, beach").otherwise("noise")
    i.raw().select(F.date_format("ts", "MM/dd/yyyy").alias("date"), text.alias("description"), F.col("site_name").alias("site")).write.option("header", True).csv(path)
    return odor_complaints(R.read_complaints(i.spark, path))


@query("s07_s08_multi_format_copies", "S7 S8", "fmt:s n:i h2s:d last:s", """
SELECT fmt, count(*) n, sum(h2s) h2s, strftime(max(obs_time), '%Y-%m-%dT%H:%M:%SZ') AS last FROM clean CROSS JOIN (VALUES ('csv'), ('json'), ('parquet'), ('latest')) t(fmt) GROUP BY fmt""")
def _(i):
    base = scratch_path(i.spark, "copies")
    df = i.clean().select(*SITE, "obs_time", "h2s")
    rows = S.write_versioned(df, base, "2024-02-01")
    S.write_formats(rows, f"{base}/out", ("csv", "json", "parquet"))
    spark = i.spark
    text = "network bigint, site_name string, obs_time string, h2s double"
    iso = F.date_format("obs_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parts = [
        ("csv", spark.read.schema(text).option("header", True).csv(f"{base}/out.csv")),
        ("json", spark.read.schema(text).json(f"{base}/out.json")),
        ("parquet", spark.read.schema(df.schema).parquet(f"{base}/out.parquet").withColumn("obs_time", iso)),
        ("latest", spark.read.schema(df.schema).parquet(f"{base}/latest").withColumn("obs_time", iso)),
    ]
    out = None
    for name, d in parts:
        one = d.select(F.lit(name).alias("fmt"), "h2s", "obs_time")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("fmt").agg(F.count("*").alias("n"), F.sum("h2s").alias("h2s"), F.max("obs_time").alias("last"))


@query("s09_s10_prediction_runs", "S9 S10 W7", "network:i site_name:s obs_time:t run_hour:i model_ppb:d", """
SELECT network, site_name, obs_time, run_hour, model_ppb FROM obs WHERE run_hour IN (0, 6, 12)""")
def _(i):
    path = scratch_path(i.spark, "runs")
    run = F.to_timestamp(F.concat(F.lit("2024-02-01 "), F.lpad(F.col("run_hour").cast("string"), 2, "0"), F.lit(":00:00")))
    S.write_predictions(i.obs().select(*SITE, "obs_time", "model_ppb", run.alias("run_time")), path, "pooled")
    runs = R.read_prediction_runs(i.spark, path, "2024-02-01", (0, 6, 12))
    return latest(runs.drop("run_time"), [*SITE, "obs_time"], ["run_hour"], keep=["run_hour", "model_ppb"])


@query("s14_quarter_hour_met", "S14 E7", "event_id:i is_night:i", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 1 WHEN event_id % 3 = 0 THEN 0 WHEN hour(obs_time) >= 20 OR hour(obs_time) <= 5 THEN 1 ELSE 0 END AS is_night FROM readings""")
def _(i):
    e = F.col("event_id")
    d = i.readings().withColumns({"is_night": F.when(e % 5 == 0, 1), "day_night": F.when(e % 3 == 0, "day")})
    return R.with_night_flag(d)


@query("s12_training_snapshot", "S12", "n:i h2s:d", "SELECT count(*) n, sum(h2s) h2s FROM clean")
def _(i):
    path = S.write_snapshot(i.clean().select(*SITE, "obs_time", "h2s"), scratch_path(i.spark, "snap"), "20240201T000000")
    return i.spark.read.parquet(path).agg(F.count("*").alias("n"), F.sum("h2s").alias("h2s"))


@query("s11_q_field_copies", "S11", "copy:s weeks:i segments:i rate:d")
def _(i):
    from airq.plans.dispersion_queries import _segments, _solved
    from airq.operators.inversion import q_field

    path = scratch_path(i.spark, "qfield")
    S.write_q_field(q_field(_solved(i), _segments(i), ["week"]), path, "2024-02-10")
    weekly, last = i.spark.read.parquet(f"{path}/weekly"), i.spark.read.parquet(f"{path}/latest")
    both = weekly.select(F.lit("weekly").alias("copy"), "week", "rate").unionByName(last.select(F.lit("latest").alias("copy"), "week", "rate"))
    return both.groupBy("copy").agg(F.count_distinct("week").alias("weeks"), F.count("*").alias("segments"), F.sum("rate").alias("rate"))


@query("e32_event_reports", "E32", "event_id:s tier:s name:s peak:d baseline:d watch:d", """
SELECT concat_ws('_', network, replace(site_name, ' ', '-'), tier, strftime(min(obs_time), '%Y%m%dT%H%M')) AS event_id, tier, site_name AS name, max(h2s) AS peak,
  23.5 AS baseline, 30.0 AS watch FROM events_of GROUP BY network, site_name, tier, event_no""", EVENTS)
def _(i):
    from airq import catalog as C

    ctx = latest(i.obs(), ["network"], ["obs_time", "event_id"], keep=["wind_speed_10m", "wind_direction_10m", "temperature_2m", "relative_humidity_2m", "sbiwtp_flow_mgd"])
    d = S.event_reports(exceedance_events(i.clean(), SITE), C.stations(i.spark), ctx, SITE)
    g = lambda p, t="double": F.get_json_object("report", p).cast(t)
    return d.select("event_id", "tier", g("$.station.name", "string").alias("name"), g("$.observation.h2s_ppb").alias("peak"),
                    g("$.flow.sbiwtp_baseline_mgd").alias("baseline"), g("$.thresholds.watch_ppb").alias("watch"))


@query("st13_trigger_cascade", "ST13", "network:i site_name:s day:s tier_1:b tier_2:b tier_3:b", """
SELECT network, site_name, day, a AS tier_1, a AND b AS tier_2, a AND b AND c AS tier_3 FROM (
  SELECT network, site_name, CAST(obs_time AS DATE) AS day,
    coalesce(max(CASE WHEN hour(obs_time) < 3 THEN prob_5 END) >= 0.5, false) a, coalesce(max(CASE WHEN hour(obs_time) >= 3 AND hour(obs_time) < 6 THEN prob_10 END) >= 0.5, false) b,
    coalesce(max(CASE WHEN hour(obs_time) >= 6 THEN prob_30 END) >= 0.5, false) c FROM scored GROUP BY ALL)""")
def _(i):
    from airq.operators.cascade import trigger_cascade

    d = i.scored().withColumns({"day": F.to_date("obs_time"), "lead_h": F.hour("obs_time")})
    return trigger_cascade(d, [*SITE, "day"], "lead_h")


@query("j21_context_summary", "J21", "network:i n:i latest:t", "SELECT network, count(*) n, max(obs_time) AS latest FROM readings GROUP BY network")
def _(i):
    ctx = i.readings().groupBy("network").agg(F.count("*").alias("n")).withColumn("k", F.lit(1))
    top = latest(i.readings(), ["network"], ["obs_time"], keep=["obs_time"]).withColumnRenamed("obs_time", "latest")
    return A.attach_latest(top, ctx, ["network"], ["k"], ["n"])
