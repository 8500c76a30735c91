"""Prediction-against-observation scorecards and their roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.functions.classes import flag, three_class
from airq.operators.asof import nearest_join
from airq.operators.dims import pair_with
from airq.operators.metrics import calibration_error, class_scores, class_sums, combine, confusion, confusion_scores

SITE = ["network", "site_name"]


def match_predictions(preds: DataFrame, obs: DataFrame, keys: list[str] = SITE, tolerance: int = 1800,
                      pred_time: str = "pred_time", obs_time: str = "obs_time") -> DataFrame:
    """Predictions with the nearest observation, both classed with right-closed cuts."""
    cols = [c for c in obs.columns if c not in [*keys, obs_time]]
    tie = [c for c in cols if c.endswith("_id")]
    hit = nearest_join(preds, obs, keys, pred_time, obs_time, cols, tolerance, tie)
    return hit.filter(F.col("h2s").isNotNull()).withColumns({
        "actual": three_class(F.col("h2s"), "right"), "predicted": three_class(F.col("predicted_ppb"), "right"),
    })


def site_scorecards(preds: DataFrame, matched: DataFrame, keys: list[str] = SITE, prob: str = "probability_orange") -> DataFrame:
    """One row per site and the network and overall roll-ups (null keys)."""
    made = preds.rollup(*keys).agg(F.count(F.lit(1)).alias("n_predictions"))
    cm = confusion(matched, keys)
    scores = class_scores(cm.rollup(*keys).agg(*class_sums()))
    labelled = matched.withColumn("_hit", flag(F.col("actual") == "orange"))
    per_site = calibration_error(labelled, keys, prob, "_hit").drop("n")

    def key(df):
        return df.withColumns({f"_{k}": F.coalesce(F.col(k).cast("string"), F.lit("*")) for k in keys}).drop(*keys)

    ks = [f"_{k}" for k in keys]
    out = key(made).join(key(scores), ks, "left").join(key(per_site), ks, "left")
    return out.withColumns({
        "n_matched": F.coalesce("n", F.lit(0)),
    }).select(*[F.col(f"_{k}").alias(k) for k in keys], "n_predictions", "n_matched", "balanced_accuracy", "orange_recall",
              "orange_precision", "false_alarm_rate", "brier", "ece")


def regime_scores(matched: DataFrame, regime: str) -> DataFrame:
    return confusion_scores(confusion(matched, [regime]), [regime])


def effective_cells(daily: DataFrame, precedence: list[str], keys: list[str] = SITE) -> DataFrame:
    """Daily confusion cells of the first pipeline of ``precedence`` that has the day and site."""
    rank = F.array_position(F.array(*[F.lit(p) for p in precedence]), F.col("pipeline"))
    ranked = daily.withColumn("_rank", rank).filter(F.col("_rank") > 0)
    best = ranked.groupBy("day", *keys).agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, ["day", *keys, "_rank"]).drop("_rank", "pipeline")


def period_windows(spark, as_of: str) -> DataFrame:
    """The reporting windows that end at ``as_of``; both ends belong to a window."""
    d = f"DATE '{as_of}'"
    return spark.sql(f"""
      SELECT 'daily' AS scope, {d} AS period_start, {d} AS period_end
      UNION ALL SELECT 'rolling_7d', date_sub({d}, 7), {d}
      UNION ALL SELECT 'rolling_30d', date_sub({d}, 30), {d}
      UNION ALL SELECT 'rolling_90d', date_sub({d}, 90), {d}
      UNION ALL SELECT 'monthly', add_months(trunc({d}, 'MM'), -1), date_sub(trunc({d}, 'MM'), 1)""")


def period_scorecards(cells: DataFrame, windows: DataFrame, keys: list[str] = SITE, zero: float | None = None) -> DataFrame:
    """All windows in one pass over the daily cells, per site and overall."""
    placed = pair_with(cells, windows).filter(F.col("day").between(F.col("period_start"), F.col("period_end")))
    merged = combine(placed, ["scope", "period_start", "period_end", *keys])
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    both = merged.withColumn("site", F.explode(F.array(name, F.lit("overall"))))
    return confusion_scores(both, ["scope", "period_start", "period_end", "site"], zero)


def hourly_cells(preds: DataFrame, obs: DataFrame, keys: list[str], time: str = "obs_time") -> DataFrame:
    """Full outer join of the last prediction and the last observation per hour."""
    from airq.functions.clock import round_to_hour
    from airq.operators.ordering import latest

    def last(df, value, tie):
        hours = df.withColumn("hour_time", round_to_hour(F.col(time))).filter(F.col(value).isNotNull())
        return latest(hours.select(*keys, "hour_time", time, tie, value), [*keys, "hour_time"], [time, tie], keep=[value])

    p = last(preds, "predicted", "event_id")
    a = last(obs, "actual", "event_id")
    return p.join(a, [*keys, "hour_time"], "full").withColumns({
        "date": F.to_date("hour_time"), "hour": F.hour("hour_time"),
    })


def compare_metrics(new: DataFrame, current: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Metric rows of two models side by side: difference, gate and where one is missing.

    The accuracy gate stands in only where balanced accuracy is not on both sides.
    """
    n = new.select("metric", F.col("value").alias("new_value"))
    c = current.select("metric", F.col("value").alias("current_value"))
    both = n.join(c, "metric", "full")
    floor = F.create_map(*[F.lit(v) for kv in floors.items() for v in kv])[F.col("metric")] if floors else F.lit(None)
    delta = F.col("new_value") - F.col("current_value")
    return both.select(
        "metric", "new_value", "current_value", delta.alias("difference"),
        F.col("new_value").isNull().alias("missing_in_new"), F.col("current_value").isNull().alias("missing_in_current"),
        (delta >= floor).alias("gate_passed"),
    )


def approval(comparison: DataFrame) -> DataFrame:
    """One row: does every gate that applies pass, and do the metric sets differ."""
    return comparison.agg(
        F.coalesce(F.bool_and("gate_passed"), F.lit(True)).alias("approved"),
        F.bool_or(F.col("missing_in_new") | F.col("missing_in_current")).alias("field_mismatch"),
    )
