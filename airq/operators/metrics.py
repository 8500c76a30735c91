"""Scores of predictions: confusion counts, calibration, rank and regression metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.functions.classes import flag
from airq.operators.ordering import meet
from airq.operators.ranks import auc, spearman
from airq.session import materialize

CLASSES = ["green", "yellow", "orange"]


def confusion(df: DataFrame, keys: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Long confusion counts; rows with an unknown label on either side are ignored."""
    return (
        df.filter(F.col(actual).isin(CLASSES) & F.col(predicted).isin(CLASSES))
        .groupBy(*keys, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def combine(cm: DataFrame, keys: list[str]) -> DataFrame:
    return cm.groupBy(*keys, "actual", "predicted").agg(F.sum("n").alias("n"))


def _sum_where(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("n")).otherwise(0))


def class_sums(extra: dict[str, Column] | None = None) -> list[Column]:
    """Aggregates over a long confusion table: support, predicted and hit counts per class."""
    a, p = F.col("actual"), F.col("predicted")
    out = [F.sum("n").alias("n")]
    for c in CLASSES:
        out += [
            _sum_where(a == c).alias(f"sup_{c}"), _sum_where(p == c).alias(f"pred_{c}"),
            _sum_where((a == c) & (p == c)).alias(f"tp_{c}"),
        ]
    return out + [c.alias(k) for k, c in (extra or {}).items()]


def ratio(a: Column, b: Column, zero: float | None = None) -> Column:
    r = F.when(b != 0, a / b)
    return r if zero is None else F.coalesce(r, F.lit(zero))


def class_scores(sums: DataFrame, zero: float | None = None) -> DataFrame:
    """Balanced accuracy, accuracy, per-class precision / recall / F1 and the orange
    false-alarm rate; ``zero`` replaces an undefined ratio (null without it)."""
    c = F.col
    recalls = [ratio(c(f"tp_{k}"), c(f"sup_{k}")) for k in CLASSES]
    present = sum(flag(c(f"sup_{k}") > 0) for k in CLASSES)
    new = {
        "balanced_accuracy": ratio(sum(F.coalesce(r, F.lit(0.0)) for r in recalls), present),
        "accuracy": ratio(sum(c(f"tp_{k}") for k in CLASSES), c("n"), zero),
    }
    for k in CLASSES:
        tp, sup, pred = c(f"tp_{k}"), c(f"sup_{k}"), c(f"pred_{k}")
        new[f"{k}_recall"] = ratio(tp, sup, zero)
        new[f"{k}_precision"] = ratio(tp, pred, zero)
        new[f"{k}_f1"] = ratio(tp * 2.0, sup + pred, zero)
    fp = c("pred_orange") - c("tp_orange")
    new["false_alarm_rate"] = ratio(fp, c("n") - c("sup_orange"), zero)
    return sums.withColumns(new)


def confusion_scores(cm: DataFrame, keys: list[str], zero: float | None = None) -> DataFrame:
    return class_scores(cm.groupBy(*keys).agg(*class_sums()), zero)


def brier(prob: Column, hit: Column) -> Column:
    return F.avg((prob - hit) * (prob - hit))


def probability_bin(prob: Column, bins: int = 10) -> Column:
    """Bin of a probability in [0, 1], the last bin closed."""
    return F.least(F.floor(prob * bins), F.lit(bins - 1))


def reliability(df: DataFrame, keys: list[str], prob: str, hit: str, bins: int = 10) -> DataFrame:
    """Per key and bin: n, mean prediction, observed rate; empty bins are listed."""
    per = df.withColumn("bin", probability_bin(F.col(prob), bins)).groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_pred"), F.avg(hit).alias("observed_rate")
    )
    spine = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    return spine.join(per, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("bin") / bins).alias("bin_lo"), ((F.col("bin") + 1) / bins).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"), "mean_pred", "observed_rate",
    )


def calibration_error(df: DataFrame, keys: list[str], prob: str, hit: str, bins: int = 10) -> DataFrame:
    """(keys, n, brier, ece)."""
    b = df.withColumn("_bin", probability_bin(F.col(prob), bins)).groupBy(*keys, "_bin").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(prob).alias("_p"), F.sum(hit).alias("_h"),
        F.sum((F.col(prob) - F.col(hit)) * (F.col(prob) - F.col(hit))).alias("_sq"),
    )
    gap = F.abs(F.col("_p") - F.col("_h"))
    return b.groupBy(*keys).agg(
        F.sum("_n").alias("n"), (F.sum("_sq") / F.sum("_n")).alias("brier"), (F.sum(gap) / F.sum("_n")).alias("ece")
    )


def regression_scores(df: DataFrame, keys: list[str], y: str, p: str) -> DataFrame:
    """RMSE, MAE, bias (prediction minus truth) and R² (null without variance)."""
    e = F.col(p) - F.col(y)
    rows = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    s = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(e).alias("bias"), F.avg(e * e).alias("_mse"), F.var_pop(y).alias("_var"),
    )
    return s.withColumn("r2", F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var"))).drop("_mse", "_var")


def threshold_sums(y: str, p: str, thresholds) -> list[Column]:
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    out = []
    for t in thresholds:
        s = f"{t:g}"
        hit, said = both & (F.col(y) > t), both & (F.col(p) > t)
        out += [
            F.sum(flag(hit)).alias(f"n_positives_{s}"), F.sum(flag(said)).alias(f"n_predicted_{s}"),
            F.sum(flag(hit & said)).alias(f"_tp_{s}"),
        ]
    return out


def threshold_scores(df: DataFrame, thresholds) -> DataFrame:
    for t in thresholds:
        s = f"{t:g}"
        df = df.withColumns({
            f"recall_{s}": ratio(F.col(f"_tp_{s}"), F.col(f"n_positives_{s}"), 0.0),
            f"precision_{s}": ratio(F.col(f"_tp_{s}"), F.col(f"n_predicted_{s}"), 0.0),
        }).drop(f"_tp_{s}")
    return df


def calibration_report(df: DataFrame, y: str, p: str, site: list[str], regime: str = "stable_atm",
                       thresholds=(30.0, 100.0)) -> DataFrame:
    """Counts, rank correlation and recall / precision at each threshold, for all
    rows, per site and per stability regime, from one labelled copy of the rows."""
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in site])
    calm = F.when(F.col(regime) == 1, "calm_stable_atm_1").otherwise("windy_stable_atm_0")
    scopes = F.array(
        F.struct(F.lit("overall").alias("scope"), F.lit("all").alias("slice")),
        F.struct(F.lit("site").alias("scope"), name.alias("slice")),
        F.struct(F.lit("regime").alias("scope"), calm.alias("slice")),
    )
    # counts and ranks read the labelled columns, not the features behind them
    narrow = materialize(df.select(*site, regime, y, p), "scored")
    rows = narrow.select(F.explode(scopes).alias("_s"), y, p).select("_s.scope", "_s.slice", y, p)
    keys = ["scope", "slice"]
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *threshold_sums(y, p, thresholds))
    rho = spearman(rows, keys, y, p).drop("n")
    return meet(threshold_scores(sums, thresholds), rho, keys, "left")


def classifier_scores(df: DataFrame, keys: list[str], label: str, prob: str, cut: float = 0.3) -> DataFrame:
    """AUC, Brier, and F1 / precision / recall at ``cut`` (strictly above)."""
    y, said = F.col(label), flag(F.col(prob) > cut)
    s = df.groupBy(*keys).agg(
        brier(F.col(prob), y).alias("brier"), F.sum(y).alias("_pos"), F.sum(said).alias("_said"), F.sum(y * said).alias("_tp"),
        F.count(F.lit(1)).alias("n"),
    )
    s = s.select(
        *keys, "n", "brier", ratio(F.col("_tp"), F.col("_said"), 0.0).alias("precision"),
        ratio(F.col("_tp"), F.col("_pos"), 0.0).alias("recall"),
        ratio(F.col("_tp") * 2.0, F.col("_pos") + F.col("_said"), 0.0).alias("f1"),
    )
    area = auc(df, keys, label, prob)
    return meet(s, area, keys)


def class_weights(df: DataFrame, label: str, hazard: float = 3.0) -> DataFrame:
    """(label, n, weight): n_total / (3 * n), hazard classes multiplied; an absent
    class counts as one row."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    wide = counts.agg(F.sum("n").alias("total"), *[
        F.coalesce(F.sum(F.when(F.col("class") == c, F.col("n"))), F.lit(0)).alias(c) for c in CLASSES
    ])
    rows = F.array(*[F.struct(F.lit(c).alias("class"), F.col(c).alias("n")) for c in CLASSES])
    w = F.col("total") / (F.greatest(F.col("n"), F.lit(1)) * len(CLASSES))
    return wide.select("total", F.inline(rows)).select(
        "class", "n", F.when(F.col("class") == "green", w).otherwise(w * hazard).alias("weight")
    )


def fold_summary(long: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, population std, min and max of ``value`` per metric over the folds."""
    return long.groupBy(*keys).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )


def wide_to_metrics(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*keys, F.inline(rows)).filter(F.col("value").isNotNull())
