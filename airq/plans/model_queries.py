"""Selection and blending against SQL; fits checked by rows and properties."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from airq import catalog as C
from airq.operators import features as X
from airq.operators import metrics as M
from airq.operators import models as Z
from airq.operators import oversample as O
from airq.operators import trees as T
from airq.operators.forecast import forecast_features, seed_state
from airq.operators.ordering import earliest
from airq.plans.registry import query
from airq.session import materialize, scratch_path
from airq.sources.readers import read_model_variant
from airq.sources.sinks import save_model_variant

SITE = X.SITE
FEATS = C.FEATURES_11
VARIANTS = {"legacy": C.FEATURES_44, "evidence": C.FEATURES_33, "lean": C.FEATURES_19, "minimal": C.FEATURES_11}
PAIRS = """
pm AS (SELECT network, coalesce(avg(CASE WHEN h2s > 30 THEN CASE WHEN model_ppb > 30 THEN 1.0 ELSE 0 END END), 0) a,
  coalesce(avg(CASE WHEN h2s > 30 THEN CASE WHEN share > 0.5 THEN 1.0 ELSE 0 END END), 0) b FROM scored GROUP BY network),
sel AS (SELECT *, CASE WHEN choice = 'ensemble' THEN greatest(a, 0) / greatest(a + b, 0.01) WHEN choice = 'a' THEN 1.0 ELSE 0.0 END AS weight_a FROM (
  SELECT *, CASE WHEN abs(a - b) < 0.2 THEN 'ensemble' WHEN a > b THEN 'a' ELSE 'b' END AS choice FROM pm))"""


def _choice(i):
    d = i.scored().withColumn("other", F.col("share") * 60)
    out = None
    for name, col in (("a", "model_ppb"), ("b", "other")):
        s = M.threshold_scores(d.groupBy("network").agg(*M.threshold_sums("h2s", col, (30.0,))), (30.0,))
        one = M.wide_to_metrics(s, ["network"], ["recall_30"]).withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return Z.select_models(out, ["network"], "recall_30", 0.2)


@query("m02_selector", "M2", "network:i a:d b:d choice:s weight_a:d weight_b:d", "SELECT *, 1 - weight_a AS weight_b FROM sel", PAIRS)
def _(i):
    return _choice(i)


@query("m03_blend", "M3", "network:i site_name:s obs_time:t prediction:d", """
SELECT network, site_name, obs_time, weight_a * model_ppb + (1 - weight_a) * share * 60 AS prediction FROM scored JOIN sel USING (network)""", PAIRS)
def _(i):
    return Z.blend(i.scored().withColumn("other", F.col("share") * 60), _choice(i), ["network"], "model_ppb", "other", "prediction")


def _features(i):
    return X.training_features(i.obs(), required=FEATS)


@query("m01_station_training", "M1 M2 M3", "station:s variant:s task:s model:s metric:s value:d")
def _(i):
    feats = materialize(X.training_features(i.obs(), required=FEATS), "features")
    out = None
    variants = {"evidence": C.FEATURES_33, "minimal": FEATS}
    for station, _, _, _ in C.STATIONS:
        for (variant, task), (_, metrics, _, _) in Z.train_variants(feats, station, variants, keep=[]).items():
            one = metrics.select(F.lit(station).alias("station"), F.lit(variant).alias("variant"), F.lit(task).alias("task"), "model", "metric", "value")
            out = one if out is None else out.unionByName(one)
    return out


STATION_LEARNERS = {"a": replace(T.FOREST, trees=20, depth=6), "b": replace(T.BOOST, trees=40, min_hessian=2.0)}


def _station_rows(i, names):
    """Rows of all stations with what training and scoring take of them, written once: numbering, training and scoring each read them."""
    labels = [y for _, y in Z.TASKS]
    return materialize(X.training_features(i.obs(), required=names).select(*dict.fromkeys([*SITE, "obs_time", "event_id", *names, *labels])), "features")


def _stations(feats, names, tasks=Z.TASKS):
    return Z.train_stations(feats, SITE, names, ["obs_time", "event_id"], STATION_LEARNERS, tasks, min_rows=30, n_bins=16)


@query("m01_every_station", "M1 M2", "network:i site_name:s variant:s task:s model:s metric:s value:d")
def _(i):
    """Every station of the table has its own models, both variants, four tasks and two learners."""
    out = None
    for variant, names in (("lean", C.FEATURES_19), ("minimal", FEATS)):
        one = _stations(_station_rows(i, names), names)[1].withColumn("variant", F.lit(variant))
        out = one if out is None else out.unionByName(one)
    return out


@query("m04_every_station", "M3 M4 M7", "network:i site_name:s obs_time:t out_regression:d out_clf_30ppb:d risk:s")
def _(i):
    """Each station's history under its own blend of both learners."""
    tasks = [t for t in Z.TASKS if t[0] in ("regression", "clf_30ppb")]
    feats = _station_rows(i, FEATS)
    nodes, _, choices, _ = _stations(feats, FEATS, tasks)
    return Z.forecast_stations(feats, nodes, choices, SITE, FEATS, ["obs_time"], tasks)


@query("m10_every_station", "M10", "network:i site_name:s feature:s importance:d")
def _(i):
    """Each station's share of gain by feature in its boosted regression."""
    feats = X.training_features(i.obs(), required=FEATS)
    nodes = T.train_groups(feats, SITE, FEATS, Z.TASKS[:1], {"b": STATION_LEARNERS["b"]}, ["obs_time", "event_id"], n_bins=16, min_rows=30)
    return T.importances(nodes, SITE)


@query("m01_first_split", "M1", "network:i site_name:s feature:s threshold:d gain:d n:i", """
SELECT * FROM (
  SELECT network, site_name, ['temperature_2m', 'wind_speed_10m', 'dewpoint_2m', 'relative_humidity_2m'][f + 1] AS feature, edge AS threshold, gain, n,
    row_number() OVER (PARTITION BY network, site_name ORDER BY CAST(gain AS FLOAT) DESC, f, k) AS best
  FROM (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM sums WHERE nl >= 5 AND n - nl >= 5)) WHERE best = 1""", """
long AS (
  SELECT network, site_name, h2s, unnest([0, 1, 2, 3]) AS f,
    unnest([coalesce(temperature_2m, 0), coalesce(wind_speed_10m, 0), coalesce(dewpoint_2m, 0), coalesce(relative_humidity_2m, 0)]) AS x
  FROM clean SEMI JOIN (SELECT network, site_name FROM clean GROUP BY ALL HAVING count(*) >= 30) big USING (network, site_name)),
edges AS (SELECT network, site_name, f, k, min(x) + (max(x) - min(x)) * (k / 8.0) AS edge FROM long, range(1, 8) AS r(k) GROUP BY network, site_name, f, k),
sums AS (
  SELECT network, site_name, f, k, edge, count(*) AS n, sum(h2s) AS s, count(CASE WHEN x <= edge THEN 1 END) AS nl, sum(CASE WHEN x <= edge THEN h2s END) AS sl
  FROM long JOIN edges USING (network, site_name, f) GROUP BY ALL)""")
def _(i):
    """The first split of every station's tree on even bins, all rows and features."""
    names = ["temperature_2m", "wind_speed_10m", "dewpoint_2m", "relative_humidity_2m"]
    one = T.Learner(trees=1, depth=1, features=1.0, rows=1.0, balanced=False)
    nodes = T.train_groups(i.clean(), SITE, names, [("regression", "h2s")], {"t": one}, ["obs_time", "event_id"], n_bins=8, min_rows=30, even=True)
    return nodes.filter("node = 1 AND feature IS NOT NULL")


@query("m04_m07_forecast_and_hindcast", "M4 M7 S15", "kind:s network:i site_name:s obs_time:t out_regression:d out_clf_5ppb:d out_clf_10ppb:d out_clf_30ppb:d risk:s")
def _(i):
    feats = materialize(_features(i), "features")
    fitted = Z.train_station(feats, None, FEATS, settings=Z.TreeSettings(trees=5, depth=3), keep=[])
    fc = earliest(i.obs(), ["network", "obs_time"], ["event_id"]).drop("site_name", "h2s", "h2s_measured", "flow_border", "event_id")
    ahead = forecast_features(fc, seed_state(i.clean()), ["network"])
    keys = [*SITE, "obs_time"]
    return Z.score_forecast(ahead, fitted, keys).withColumn("kind", F.lit("forecast")).unionByName(
        Z.score_forecast(feats, fitted, keys).withColumn("kind", F.lit("hindcast")))


@query("s15_model_variant", "S15", "features:s n:i same:i", """
SELECT 'temperature_2m,wind_speed_10m' AS features, count(*) AS n, count(*) AS same FROM clean""")
def _(i):
    """A stored pipeline, read back with its feature list, scores every row as the fitted one does."""
    names = ["temperature_2m", "wind_speed_10m"]
    rows = materialize(i.clean().select("event_id", "h2s", *names), "variant-rows")
    path = scratch_path(i.spark, "variant")
    model = Z.fit_learner("a", rows, "regression", "h2s", names, Z.TreeSettings(trees=3, depth=3))
    save_model_variant(model, names, path, i.spark)
    again, feats = read_model_variant(i.spark, path)
    both = Z.score_rows(again, Z.score_rows(model, rows).withColumnRenamed("a", "first"))
    return both.agg(F.lit(",".join(feats)).alias("features"), F.count("*").alias("n"), F.count(F.when(F.col("a") == F.col("first"), 1)).alias("same"))


@query("m05_m11_weighted_classes", "M5 M11 A28 A29 W11", "fold:i n:i balanced_accuracy:d orange_recall:d false_alarm_rate:d")
def _(i):
    from airq.functions.classes import three_class

    d = _features(i).withColumn("actual", three_class(F.col("h2s")))
    return Z.train_classes(d, "actual", FEATS, 5, Z.TreeSettings(trees=5, depth=4), tie=["event_id"])[1]


def _validated(i):
    from airq.functions.classes import three_class

    d = _features(i).withColumn("actual", three_class(F.col("h2s")))
    return Z.train_classes(d, "actual", FEATS, 5, Z.TreeSettings(trees=20, depth=5), tie=["event_id"], keep=[*SITE, "obs_time", "h2s"])[2]


@query("m11_validation_predictions", "M11", "fold:i network:i site_name:s obs_time:t h2s:d actual:s predicted:s p_orange:d")
def _(i):
    """Every row of the test folds with its class, the one predicted without it or later rows, and the hazard's probability."""
    return _validated(i).withColumn("p_orange", F.coalesce(F.try_element_at("probabilities", F.lit("orange")), F.lit(0.0)))


@query("m11_validation_report", "M11 A4", "scope:s n:i accuracy:d balanced_accuracy:d orange_recall:d orange_precision:d yellow_recall:d false_alarm_rate:d")
def _(i):
    """Scores of those predictions per fold and over all of them."""
    d = _validated(i).withColumn("scope", F.explode(F.array(F.concat(F.lit("fold "), F.col("fold").cast("string")), F.lit("all"))))
    return M.confusion_scores(M.confusion(d, ["scope"]), ["scope"], zero=0.0)


@query("m06_oversampling", "M6", "kind:s actual:s n:i")
def _(i):
    d = i.scored().select(*SITE, "obs_time", "actual", "temperature_2m", "dewpoint_2m", "share")
    a = Z.oversample_random(d, "actual").groupBy("actual").agg(F.count("*").alias("n")).withColumn("kind", F.lit("random"))
    b = Z.oversample_synthetic(d, "actual", ["green", "yellow"], ["temperature_2m", "dewpoint_2m", "share"], SITE, "obs_time")
    return a.unionByName(b.groupBy("actual").agg(F.count("*").alias("n")).withColumn("kind", F.lit("synthetic")))


NEAR = ["temperature_2m", "dewpoint_2m", "share"]
NEAR_CTES = "\nunit AS (SELECT network, event_id, actual, " + ", ".join(
    f"coalesce(({f} - avg({f}) OVER w) / nullif(stddev_pop({f}) OVER w, 0), 0) AS x{k}" for k, f in enumerate(NEAR)) + """ FROM scored WINDOW w AS (PARTITION BY network)),
near AS (
  SELECT * FROM (
    SELECT a.network, a.event_id, a.actual, b.actual AS other,
      row_number() OVER (PARTITION BY a.network, a.event_id ORDER BY round((a.x0 - b.x0) * (a.x0 - b.x0) + (a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2), 9), b.event_id) AS rn
    FROM unit a LEFT JOIN unit b ON a.network = b.network AND a.event_id <> b.event_id) WHERE rn <= 10)"""


@query("m06_borderline", "M6", "network:i event_id:i actual:s n_near:i n_other:i danger:b", """
SELECT *, n_near > 0 AND n_other * 2 >= n_near AND n_other < n_near AS danger FROM (
  SELECT network, event_id, actual, count(other) AS n_near, count(CASE WHEN other <> actual THEN 1 END) AS n_other FROM near GROUP BY ALL)""", NEAR_CTES)
def _(i):
    """A network's rows fit a bucket, so the search is exact here."""
    return O.borderline(i.scored(), ["network"], "event_id", "actual", NEAR, bucket=4096)


@query("m06_balanced_classes", "M6", "network:i actual:s n:i made:i", """
SELECT network, actual, max(n) OVER (PARTITION BY network) AS n, max(n) OVER (PARTITION BY network) - n AS made
FROM (SELECT network, actual, count(*) AS n FROM scored GROUP BY ALL)""")
def _(i):
    rows = i.scored().select("network", "event_id", "actual", *NEAR)
    new = O.oversample_borderline(rows, ["network"], "event_id", "actual", NEAR)
    both = rows.select("network", "actual", F.lit(0).alias("new")).unionByName(new.select("network", "actual", F.lit(1).alias("new")))
    return both.groupBy("network", "actual").agg(F.count("*").alias("n"), F.sum("new").alias("made"))


@query("m08_feature_ablation", "M8 E35", "variant:s n:i spearman:d recall_30:d recall_100:d spearman_drop:d accepted:b")
def _(i):
    # numbering the rows for the split reads them more than once
    feats = materialize(X.training_features(i.obs()), "features")
    return Z.ablation(feats, VARIANTS, "evidence", SITE, ["event_id"])


@query("m10_feature_importance", "M10", "feature:s importance:d")
def _(i):
    feats = materialize(_features(i).select("h2s", *FEATS), "features")
    return Z.feature_importance(Z.fit_learner("a", feats, "regression", "h2s", FEATS, Z.TreeSettings(trees=5, depth=3)), FEATS, i.spark, 10)
