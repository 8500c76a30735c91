"""Sensor-shaped inputs derived from the ``events`` table, in both engines.

Every user is a station; three neighbouring users form one network with the three
named sites, so the number of stations grows with the data.  Divisors such as 97
keep values off exact decimal ties, where two engines may round differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.operators.ordering import earliest

BASE_SQL = """
r AS (
  SELECT event_id, ts, date_trunc('hour', ts) AS hr, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         user_id // 3 AS network,
         CASE user_id % 3 WHEN 0 THEN 'NESTOR - BES' WHEN 1 THEN 'IB CIVIC CTR' ELSE 'SAN YSIDRO' END AS site_name
  FROM events),
first_of_hour AS (SELECT user_id, hr, min(event_id) AS event_id FROM r GROUP BY user_id, hr),
obs AS (
  SELECT r.network, r.site_name, r.hr AS obs_time, r.event_id,
    CASE WHEN r.event_id % 53 = 0 THEN NULL ELSE least(r.value * r.value / 97.0, 600.0) END AS h2s,
    r.event_id % 10 <> 0 AS h2s_measured,
    CASE WHEN r.event_id % 31 = 0 THEN NULL ELSE CAST(r.k AS DOUBLE) / 13 END AS wind_speed_10m,
    CAST((r.k * 37) % 360 AS DOUBLE) AS wind_direction_10m,
    CAST(10 + r.user_id % 12 AS DOUBLE) + CAST(r.k AS DOUBLE) / 37 AS temperature_2m,
    CAST(8 + r.event_id % 9 AS DOUBLE) + CAST(r.k AS DOUBLE) / 41 AS dewpoint_2m,
    CAST(55 + r.event_id % 40 AS DOUBLE) + CAST(r.k AS DOUBLE) / 43 AS relative_humidity_2m,
    CAST(1005 + r.event_id % 17 AS DOUBLE) + CAST(r.k AS DOUBLE) / 47 AS surface_pressure,
    CAST(CASE WHEN r.event_id % 23 = 0 THEN 1.5 ELSE 0 END AS DOUBLE) AS precipitation,
    CAST(r.event_id % 101 AS DOUBLE) AS cloud_cover,
    CASE WHEN r.event_id % 29 = 0 THEN NULL ELSE CAST(r.event_id % 80 AS DOUBLE) / 9 END AS flow_border,
    CAST(r.event_id % 25 AS DOUBLE) / 9 - 0.5 AS tide_height,
    CASE r.event_type WHEN 'view' THEN 'flood' WHEN 'click' THEN 'ebb'
         WHEN 'signup' THEN 'slack high' WHEN 'error' THEN 'slack low' END AS tidal_state,
    CAST(18 + r.k % 12 AS DOUBLE) + CAST(r.k AS DOUBLE) / 51 AS sbiwtp_flow_mgd,
    (r.value * 0.8 + r.k * 0.4) * (r.value * 0.8 + r.k * 0.4) / 97.0 AS model_ppb,
    CAST(r.k AS DOUBLE) / 99 AS share,
    r.event_id % 4 * 6 AS run_hour
  FROM r JOIN first_of_hour f ON r.event_id = f.event_id),
clean AS (
  SELECT * REPLACE (greatest(h2s, 0.0) AS h2s) FROM obs WHERE h2s_measured AND h2s <= 500.0),
base AS (
  SELECT *, CASE WHEN night_flag = 1 AND wind_speed_10m < 5 THEN 1 ELSE 0 END AS stable_atm, night_flag AS is_night
  FROM (SELECT *, CASE WHEN hour(obs_time) >= 20 OR hour(obs_time) <= 5 THEN 1 ELSE 0 END AS night_flag FROM clean)),
scored AS (
  SELECT *,
    CASE WHEN h2s < 5 THEN 'green' WHEN h2s < 30 THEN 'yellow' ELSE 'orange' END AS actual,
    CASE WHEN model_ppb < 5 THEN 'green' WHEN model_ppb < 30 THEN 'yellow' ELSE 'orange' END AS predicted,
    least(model_ppb / 40.0, 1.0) AS prob_5, least(model_ppb / 80.0, 1.0) AS prob_10,
    least(model_ppb / 160.0, 1.0) AS prob_30
  FROM base),
readings AS (
  SELECT event_id, network, site_name, ts AS obs_time, value * value / 97.0 AS h2s FROM r)"""


class Inputs:
    """Lazily built input tables for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self) -> DataFrame:
        ts = F.col("ts").cast("timestamp")
        return self.table("events").select(
            "event_id", ts.alias("ts"), F.date_trunc("hour", ts).alias("hr"), "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.expr("user_id div 3").alias("network"),
            F.when(F.col("user_id") % 3 == 0, "NESTOR - BES").when(F.col("user_id") % 3 == 1, "IB CIVIC CTR")
            .otherwise("SAN YSIDRO").alias("site_name"),
        )

    def obs(self) -> DataFrame:
        one = earliest(self.raw().drop("ts"), ["user_id", "hr"], ["event_id"])
        c, e = F.col, F.col("event_id")
        k = F.col("k").cast("double")
        mix = c("value") * 0.8 + c("k") * 0.4
        state = (
            F.when(c("event_type") == "view", "flood").when(c("event_type") == "click", "ebb")
            .when(c("event_type") == "signup", "slack high").when(c("event_type") == "error", "slack low")
        )
        return one.select(
            "network", "site_name", c("hr").alias("obs_time"), "event_id",
            F.when(e % 53 != 0, F.least(c("value") * c("value") / 97.0, F.lit(600.0))).alias("h2s"),
            (e % 10 != 0).alias("h2s_measured"),
            F.when(e % 31 != 0, k / 13).alias("wind_speed_10m"),
            ((c("k") * 37) % 360).cast("double").alias("wind_direction_10m"),
            ((10 + c("user_id") % 12).cast("double") + k / 37).alias("temperature_2m"),
            ((8 + e % 9).cast("double") + k / 41).alias("dewpoint_2m"),
            ((55 + e % 40).cast("double") + k / 43).alias("relative_humidity_2m"),
            ((1005 + e % 17).cast("double") + k / 47).alias("surface_pressure"),
            F.when(e % 23 == 0, 1.5).otherwise(0.0).alias("precipitation"),
            (e % 101).cast("double").alias("cloud_cover"),
            F.when(e % 29 != 0, (e % 80).cast("double") / 9).alias("flow_border"),
            ((e % 25).cast("double") / 9 - 0.5).alias("tide_height"),
            state.alias("tidal_state"),
            ((18 + c("k") % 12).cast("double") + k / 51).alias("sbiwtp_flow_mgd"),
            (mix * mix / 97.0).alias("model_ppb"),
            (k / 99).alias("share"),
            (e % 4 * 6).alias("run_hour"),
        )

    def clean(self) -> DataFrame:
        from airq.operators.features import measured

        return measured(self.obs())

    def base(self) -> DataFrame:
        from airq.functions.classes import flag
        from airq.functions.clock import night

        return self.clean().withColumn("is_night", night(F.col("obs_time"))).withColumn(
            "stable_atm", flag((F.col("is_night") == 1) & (F.col("wind_speed_10m") < 5))
        )

    def scored(self) -> DataFrame:
        from airq.functions.classes import three_class

        return self.base().withColumns({
            "actual": three_class(F.col("h2s")), "predicted": three_class(F.col("model_ppb")),
            **{f"prob_{t}": F.least(F.col("model_ppb") / d, F.lit(1.0)) for t, d in ((5, 40.0), (10, 80.0), (30, 160.0))},
        })

    def readings(self) -> DataFrame:
        return self.raw().select(
            "event_id", "network", "site_name", F.col("ts").alias("obs_time"),
            (F.col("value") * F.col("value") / 97.0).alias("h2s"),
        )

    def predictions(self) -> DataFrame:
        """Irregular predictions (clicks) for the nearest-time joins."""
        return self.raw().filter("event_type = 'click'").select(
            "event_id", "network", "site_name", F.col("ts").alias("pred_time"),
            (F.col("value") * F.col("value") / 97.0).alias("predicted_ppb"),
            (F.col("k").cast("double") / 99).alias("probability_orange"),
            F.when(F.col("k") < 50, "calm").otherwise("windy").alias("regime"),
        )

    def actuals(self) -> DataFrame:
        return self.raw().filter("event_type = 'view'").select(
            F.col("event_id").alias("actual_id"), "network", "site_name", F.col("ts").alias("obs_time"),
            (F.col("value") * F.col("value") / 97.0).alias("h2s"),
        )


PRED_SQL = """
preds AS (
  SELECT event_id, network, site_name, ts AS pred_time, value * value / 97.0 AS predicted_ppb,
         CAST(k AS DOUBLE) / 99 AS probability_orange, CASE WHEN k < 50 THEN 'calm' ELSE 'windy' END AS regime
  FROM r WHERE event_type = 'click'),
actuals AS (
  SELECT event_id AS actual_id, network, site_name, ts AS obs_time, value * value / 97.0 AS h2s
  FROM r WHERE event_type = 'view'),
matched AS (
  SELECT * FROM (
    SELECT p.*, a.obs_time, a.h2s, row_number() OVER (PARTITION BY p.event_id
        ORDER BY abs(epoch_us(a.obs_time) - epoch_us(p.pred_time)), a.obs_time, a.actual_id) AS rn
    FROM preds p JOIN actuals a ON a.network = p.network AND a.site_name = p.site_name
     AND a.obs_time BETWEEN p.pred_time - INTERVAL 30 MINUTE AND p.pred_time + INTERVAL 30 MINUTE) WHERE rn = 1)"""
