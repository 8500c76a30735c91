"""Scores against the published matrix and hand-worked frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from airq.operators import metrics as M
from airq.operators import models as Z
from airq.operators import scorecards as S
from airq.operators.quality import lagged_correlations, polar_bins, top_features

PUBLISHED = {("green", "green"): 1263, ("green", "orange"): 84, ("green", "yellow"): 198, ("orange", "green"): 14, ("orange", "orange"): 84,
             ("orange", "yellow"): 39, ("yellow", "green"): 75, ("yellow", "orange"): 57, ("yellow", "yellow"): 113}


def test_published_matrix(spark):
    cm = spark.createDataFrame([(a, p, n) for (a, p), n in PUBLISHED.items()], "actual string, predicted string, n bigint")
    r = M.confusion_scores(cm, []).first()
    assert r.balanced_accuracy == pytest.approx((1263 / 1545 + 84 / 137 + 113 / 245) / 3)
    assert r.orange_recall == pytest.approx(84 / 137) and r.orange_precision == pytest.approx(84 / 225)
    assert r.false_alarm_rate == pytest.approx(141 / 1790) and r.n == 1927


def test_undefined_ratios_are_null_or_zero(spark):
    cm = spark.createDataFrame([("green", "green", 4)], "actual string, predicted string, n bigint")
    r, z = M.confusion_scores(cm, []).first(), M.confusion_scores(cm, [], zero=0.0).first()
    assert r.orange_recall is None and r.balanced_accuracy == 1.0 and z.orange_recall == 0.0


def test_unknown_labels_are_ignored(spark):
    df = spark.createDataFrame([("green", "green"), ("purple", "green"), ("green", None)], "actual string, predicted string")
    assert M.confusion(df, []).agg(F.sum("n")).first()[0] == 1


def test_calibration_error_closes_the_last_bin(spark):
    df = spark.createDataFrame([(1.0, 1), (0.95, 0), (0.05, 0)], "p double, y int")
    r = M.calibration_error(df, [], "p", "y").first()
    assert r.ece == pytest.approx((abs(1.95 - 1) + 0.05) / 3) and r.brier == pytest.approx((0.95**2 + 0.05**2) / 3)
    bins = M.reliability(df.withColumn("k", F.lit(1)), ["k"], "p", "y").orderBy("bin").collect()
    assert [b.n for b in bins] == [1] + [0] * 8 + [2] and bins[4].mean_pred is None


def test_calibration_report_slices(spark):
    rows = [(1, "A", 40.0, 35.0, 1), (1, "A", 10.0, 40.0, 1), (1, "A", 50.0, 10.0, 0), (1, "B", 120.0, 130.0, 0), (1, "B", 5.0, None, 0), (1, "B", 1.0, 2.0, 0)]
    df = spark.createDataFrame(rows, "network bigint, site_name string, y double, p double, stable_atm int")
    r = {(x.scope, x["slice"]): x for x in M.calibration_report(df, "y", "p", ["network", "site_name"]).collect()}
    assert r[("overall", "all")].n == 6 and r[("overall", "all")].recall_30 == pytest.approx(2 / 3)
    assert r[("site", "1/A")].precision_30 == 0.5 and r[("regime", "calm_stable_atm_1")].spearman is None
    assert r[("overall", "all")].recall_100 == 1.0 and set(k[0] for k in r) == {"overall", "site", "regime"}


def test_class_weights_of_an_absent_class(spark):
    df = spark.createDataFrame([("green",), ("green",), ("yellow",), ("orange",)], "c string")
    w = {r["class"]: r.weight for r in M.class_weights(df, "c").collect()}
    assert w == pytest.approx({"green": 4 / 6, "yellow": 4.0, "orange": 4.0})
    w = {r["class"]: r.weight for r in M.class_weights(df.filter("c = 'green'"), "c").collect()}
    assert w["orange"] == pytest.approx(2 / 3 * 3)


def test_rolling_windows_hold_both_ends_and_precedence(spark):
    rows = [("2024-03-10", "daily_station", 1), ("2024-03-10", "root", 50), ("2024-03-03", "root", 2), ("2024-03-02", "root", 4), ("2024-02-29", "root", 8)]
    cells = spark.createDataFrame([(d, p, 1, "A", "green", "green", n) for d, p, n in rows],
                                  "d string, pipeline string, network bigint, site_name string, actual string, predicted string, n bigint")
    cells = cells.select(F.to_date("d").alias("day"), "pipeline", "network", "site_name", "actual", "predicted", "n")
    cards = S.period_scorecards(S.effective_cells(cells, ["daily_station", "root"]), S.period_windows(spark, "2024-03-10"))
    n = {r.scope: r.n for r in cards.filter("site = 'overall'").collect()}
    assert n == {"daily": 1, "rolling_7d": 3, "rolling_30d": 15, "rolling_90d": 15, "monthly": 8}


def test_model_comparison_gates(spark):
    def m(**kw):
        return spark.createDataFrame(list(kw.items()), "metric string, value double")

    floors = {"balanced_accuracy": -0.05, "recall_orange": -0.05, "precision_orange": -0.10}
    good = S.approval(S.compare_metrics(m(balanced_accuracy=0.70, recall_orange=0.65, precision_orange=0.60),
                                        m(balanced_accuracy=0.65, recall_orange=0.60, precision_orange=0.55), floors)).first()
    bad = S.approval(S.compare_metrics(m(balanced_accuracy=0.50, recall_orange=0.45), m(balanced_accuracy=0.65, recall_orange=0.60, extra=1.0), floors)).first()
    assert good.approved and not good.field_mismatch and not bad.approved and bad.field_mismatch


def test_selector_table(spark):
    rows = [("w1", "a", 0.60), ("w1", "b", 0.61), ("w2", "a", 0.9), ("w2", "b", 0.5), ("w3", "a", 0.2), ("w3", "b", 0.5), ("w4", "a", 0.3)]
    df = spark.createDataFrame([(k, m, "recall_30", v) for k, m, v in rows], "k string, model string, metric string, value double")
    r = {x.k: x for x in Z.select_models(df, ["k"]).collect()}
    assert [r[k].choice for k in ("w1", "w2", "w3", "w4")] == ["ensemble", "a", "b", "a"]
    assert r["w1"].weight_a == pytest.approx(0.60 / 1.21) and r["w3"].weight_b == 1.0
    with pytest.raises(ValueError):
        Z.select_models(df, ["k"], "f1")


def test_acceptance_tolerances(spark):
    df = spark.createDataFrame([("base", 0.80, 0.6, 0.8), ("ok", 0.785, 0.56, 0.79), ("no", 0.77, 0.6, 0.8)],
                               "variant string, recall_30 double, recall_100 double, spearman double")
    assert {r.variant: r.accepted for r in Z.acceptance(df, "base").collect()} == {"base": True, "ok": True, "no": False}


def test_oversampling_balances_and_stays_inside(spark):
    rows = [(i, "green", float(i)) for i in range(90)] + [(100 + i, "orange", 500.0 + i) for i in range(7)]
    df = spark.createDataFrame(rows, "id bigint, c string, x double")
    n = {r.c: r["count"] for r in Z.oversample_random(df, "c").groupBy("c").count().collect()}
    assert n["green"] == 90 and 84 <= n["orange"] <= 91
    syn = Z.oversample_synthetic(df, "c", ["orange"], ["x"], ["c"], "id").collect()
    assert len(syn) == 14 and all(500.0 <= r.x <= 506.0 for r in syn)
    full = Z.oversample_synthetic(df, "c", ["orange"], ["x"], ["c"], "id", copies=None)
    assert 78 <= full.count() <= 88 and full.filter("x < 500 OR x > 506").count() == 0


def test_scoring_keeps_rows_with_missing_features(spark):
    rows = [(i, float(i % 50), None if i % 7 == 0 else float(i % 5), int(i % 50 > 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, x double, z double, hit int")
    settings = Z.TreeSettings(trees=3, depth=3)
    for task, label in (("regression", "x"), ("clf_5ppb", "hit")):
        models = Z.fit_pair(df, task, label, ["x", "z"], settings)
        got = Z.score_pair(models, df, task)
        assert got.count() == 300 and got.filter("a IS NULL OR b IS NULL").count() == 0 and got.filter("z IS NULL").count() == df.filter("z IS NULL").count()
    _, scores, pred = Z.train_classes(df.withColumn("obs_time", F.timestamp_seconds("id")).withColumn("c", F.when(F.col("hit") == 1, "orange").otherwise("green")), "c", ["x", "z"], 3, settings, tie=["id"])
    assert pred.count() == 3 * 75 and scores.count() == 3


def test_both_learners_pass_over_rows_assembled_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def looked_at(v):
        seen.add(1)
        return v

    df = spark.range(300).select((F.col("id") % 50).cast("double").alias("x"), looked_at((F.col("id") % 7).cast("double")).alias("z"))
    models = Z.fit_pair(df, "regression", "x", ["x", "z"], Z.TreeSettings(trees=3, depth=3))
    # the first pass of a fit looks at a few rows of the first partition, to learn the width of a vector
    assert [type(m.stages[-1]).__name__ for m in models] == ["RandomForestRegressionModel", "GBTRegressionModel"] and seen.value <= 2 * 300


def test_variants_of_a_station_share_a_split_and_give_what_each_gives_alone(spark, monkeypatch):
    rows = [(i, "s", float(i * 37 % 50), float(i % 11), float(i * 37 % 50), int(i * 37 % 50 > 30)) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id bigint, site_name string, x double, z double, h2s double, hit int").withColumn("obs_time", F.timestamp_seconds("event_id"))
    settings, tasks = Z.TreeSettings(trees=2, depth=2), [("regression", "h2s"), ("clf_30ppb", "hit")]
    values = lambda one: sorted(map(tuple, one[1].collect()))
    alone = {("both", t): values(one) for t, one in Z.train_station(df, "s", ["x", "z"], tasks, settings=settings).items()}
    alone |= {("one", t): values(one) for t, one in Z.train_station(df, "s", ["z"], tasks, settings=settings).items()}
    splits, split = [], Z.chronological_split
    monkeypatch.setattr(Z, "chronological_split", lambda *a, **k: splits.append(a) or split(*a, **k))
    fitted = Z.train_variants(df, "s", {"both": ["x", "z"], "one": ["z"]}, tasks, settings=settings, keep=["event_id"])
    assert len(splits) == 1 and list(fitted) == list(alone) and {k: values(one) for k, one in fitted.items()} == alone
    assert set(fitted["one", "regression"][3].columns) == {"event_id", "h2s", "a", "b", "prediction"} and fitted["one", "regression"][3].count() == 80


def test_work_side_by_side_keeps_its_order_and_raises(spark):
    import threading

    both = threading.Barrier(2)
    assert Z.side_by_side(spark, lambda k: (both.wait(20), k)[1], [1, 2]) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        Z.side_by_side(spark, lambda k: 1 // k, [1, 0])


def test_each_task_has_its_own_selection_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "x double, h2s double")
    with pytest.raises(ValueError):
        Z.train_and_select(df, df, "regression", "h2s", ["x"], metric="auc")
    with pytest.raises(ValueError):
        Z.train_and_select(df, df, "clf_5ppb", "h2s", ["x"], metric="recall_30")


def test_positive_lag_means_the_feature_leads(frame):
    import random

    rng = random.Random(1)
    x = [rng.random() for _ in range(300)]
    rows = [(1, "A", f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00", x[i - 3] if i >= 3 else 0.0, x[i]) for i in range(300)]
    df = frame(rows, "network bigint, site_name string, obs_time timestamp, y double, x double")
    c = lagged_correlations(df, ["network", "site_name"], "y", ["x"], 5)
    best = c.orderBy(F.desc("corr")).first()
    assert best.lag == 3 and best["corr"] > 0.99 and top_features(c, 1).first().feature == "x"


def test_polar_bins_of_a_north_wind(frame):
    df = frame([("A", "2024-01-01 00:00:00", 7.0, 99.0, 0.0), ("A", "2023-12-31 11:00:00", 9.0, 1.0, 0.0)],
               "site_name string, obs_time timestamp, h2s double, wind_speed_10m double, wind_direction_10m double")
    r = polar_bins(df, ["site_name"]).collect()
    assert len(r) == 1 and (r[0].dir_bin, r[0].speed_bin, r[0].mean_h2s) == (9, 9, 7.0)


def test_rollup_reads_changed_days_only(spark):
    from pyspark.sql import functions as F

    from airq.session import scratch_path
    from airq.sources.rollups import DailyRollup

    source, store = scratch_path(spark, "src"), scratch_path(spark, "store")
    rows = spark.createDataFrame([(f"2024-01-{d:02d}", d * n) for d in range(1, 8) for n in range(1, 5)], "day string, v int")
    rows.write.partitionBy("day").parquet(source)
    r = DailyRollup(spark, source, store, lambda d: d.groupBy("day").agg(F.sum("v").alias("v"), F.count("*").alias("n")))
    assert len(r.refresh()) == 7 and r.refresh() == []
    kept = lambda: {x.day.day: (x.v, x.n) for x in r.cells().collect()}
    want = {d: (10 * d, 4) for d in range(1, 8)}
    assert kept() == want
    # a late correction, a late row and a day that goes
    fix = spark.createDataFrame([("2024-01-03", 1), ("2024-01-08", 5)], "day string, v int")
    fix.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(source)
    spark.createDataFrame([("2024-01-05", 100)], "day string, v int").write.mode("append").partitionBy("day").parquet(source)
    r._drop(f"{source}/day=2024-01-07")
    days, gone = r.changed()
    assert days == ["2024-01-03", "2024-01-05", "2024-01-08"] and gone == ["2024-01-07"]
    files = r.rows_of(days).inputFiles()
    assert files and all(any(f"day={d}" in f for d in days) for f in files)
    assert r.refresh() == days
    del want[7]
    assert kept() == want | {3: (1, 1), 5: (150, 5), 8: (5, 1)} and r.changed() == ([], [])


def test_training_queries_use_full_size_settings(spark, monkeypatch):
    """Both queries train 500 trees a learner: forests 20 deep, boosted trees 6 deep, for classes 5."""
    from airq.plans import load_all
    from airq.plans.registry import spark_queries

    load_all()
    seen = []

    def stop(*args, settings=Z.TreeSettings(), **how):
        seen.append(settings)
        raise InterruptedError

    monkeypatch.setattr(Z, "train_variants", stop)
    monkeypatch.setattr(Z, "ablation", stop)
    for name in ("m01_station_training", "m08_feature_ablation"):
        with pytest.raises(InterruptedError):
            spark_queries()[name](spark, "/root/testdata/sf0.001")
    assert len(seen) == 2
    for s in seen:
        forest, boost, classes = Z._estimator("a", "regression", s), Z._estimator("b", "regression", s), Z._estimator("b", "clf_5ppb", s)
        assert (forest.getNumTrees(), forest.getMaxDepth(), boost.getMaxIter(), boost.getMaxDepth(), classes.getMaxDepth()) == (500, 20, 500, 6, 5)
    small = Z._estimator("b", "clf_5ppb", Z.TreeSettings(trees=3, depth=3))
    assert (small.getMaxIter(), small.getMaxDepth()) == (3, 3)
