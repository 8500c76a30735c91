"""Footprints, inversion, forecast seeds, sources and sinks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airq import catalog as C
from airq import schema
from airq.functions import plume as P
from airq.operators import dispersion as D
from airq.operators import inversion as V
from airq.operators.forecast import forecast_features, seed_state
from airq.session import scratch_path
from airq.sources import readers as R
from airq.sources import sinks as S


def test_channel_segments(spark):
    seg = D.channel_segments(C.waypoints(spark), 150.0).orderBy("segment").collect()
    want = []
    for (a, b), (c, d) in zip(C.CHANNEL_WAYPOINTS, C.CHANNEL_WAYPOINTS[1:]):
        n = max(1, int(np.hypot((c - a) * D.P.LAT_M, (d - b) * D.P.LON_M) / 150.0))
        want += [(a + (k + 0.5) / n * (c - a), b + (k + 0.5) / n * (d - b)) for k in range(n)]
    assert [r.segment for r in seg] == list(range(len(want)))
    assert np.allclose([(r.source_lat, r.source_lon) for r in seg], want)


def test_grid_has_the_documented_shape():
    assert D.grid_shape(C.FORWARD_GRID_BOUNDS, 100.0) == (278, 235)


def test_grid_blocks_do_not_change_the_raster(spark):
    met = spark.createDataFrame([(1, 2.0, 200.0, 15.0, 1), (2, 0.0, 10.0, 15.0, 0)], "t int, wind_speed_10m double, wind_direction_10m double, temperature_2m double, is_night int")
    run = lambda b: D.gridded_forecast(met, D.default_rates(spark), C.stations(spark), ["t"], resolution_m=3000.0, block_cells=b)
    a, b = run(4096).toPandas(), run(7).toPandas()
    key = ["t", "row", "col"]
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True))
    assert (a.ppb <= 500).all() and a.confidence.between(0.3, 1.0).all() and len(a) == 2 * np.prod(D.grid_shape(C.FORWARD_GRID_BOUNDS, 3000.0))
    arr = D.frame_arrays(run(4096), ["t"]).filter("t = 1").first().data
    assert (len(arr), len(arr[0])) == D.grid_shape(C.FORWARD_GRID_BOUNDS, 3000.0)


def test_forward_model_leaves_hours_without_met_empty(frame, spark):
    met = frame([(1, "NESTOR - BES", "2024-01-01 00:00:00", 3.0, 200.0, 15.0, 1), (1, "SAN YSIDRO", "2024-01-01 02:00:00", 3.0, 200.0, 15.0, 1)],
                "network bigint, site_name string, obs_time timestamp, wind_speed_10m double, wind_direction_10m double, temperature_2m double, is_night int")
    wide = D.receptor_met(met, C.stations(spark), ["network"])
    got = D.forward_model(wide, D.default_rates(spark), ["network", "site_name", "obs_time"]).toPandas()
    have = got.dropna().groupby("site_name").obs_time.apply(lambda x: sorted(t.hour for t in x)).to_dict()
    assert have == {"NESTOR - BES": [0], "IB CIVIC CTR": [0], "SAN YSIDRO": [0, 2]} and len(got) == 9


def test_zone_rates_follow_the_budget(spark):
    df = spark.createDataFrame([(n, 1.0) for n, _, _ in C.SOURCES], "source string, fraction double")
    r = D.zone_rates(df, []).toPandas()
    assert r.source_rate.sum() == pytest.approx(167.0)
    assert r.groupby("zone").zone_rate.first().to_dict() == pytest.approx({"east": 167 * 6 / 17, "west": 167 * 5 / 17, "south": 167 * 6 / 17})
    assert D.default_rates(spark).agg(F.sum("rate")).first()[0] == pytest.approx(167.0)


def test_uniform_shares_without_mass(spark):
    fp = spark.createDataFrame([(1, 0, 0, 0.0)], "e int, row bigint, col bigint, density double")
    r = D.kernel_attribution(fp, C.sources(spark), ["e"], uniform=True).toPandas()
    assert np.allclose(r.fraction, 1 / 17)


def test_solver_meets_the_optimality_conditions():
    rng = np.random.default_rng(2)
    a, q = rng.random((80, 30)), np.where(rng.random(30) < 0.3, rng.random(30) * 10, 0.0)
    h, r = a.T @ a + 0.09 * np.eye(30), a.T @ (a @ q)
    x = V.nonnegative_solve(h, r)
    g = h @ x - r
    assert (x >= 0).all() and np.abs(g[x > 0]).max() < 1e-6 and g[x == 0].min() > -1e-6


def test_inversion_recovers_planted_sources(spark):
    rng = np.random.default_rng(4)
    n, m = 6, 60
    a = rng.random((m, n)) * np.array([1, 2, 5, 1, 1, 3])
    q = np.array([10.0, 0, 0, 40.0, 0, 5.0])
    rows = [("w", "ABC"[i % 3], a[i].tolist(), float(a[i] @ q)) for i in range(m)]
    df = spark.createDataFrame(rows, "week string, site_name string, a array<double>, c_bg double").repartition(5)
    got = V.solve_weeks(V.normal_equations(df, ["week"], n), ["week"], n, ridge=1e-3).orderBy("segment").collect()
    assert np.allclose([r.rate for r in got], q, atol=0.05) and max(r.kkt for r in got) < 1e-6
    cv = V.cross_validate(df, "site_name", n, ridge=1e-3).collect()
    assert sorted(r.held_out for r in cv) == ["A", "B", "C"] and all(r.n_test == 20 and r.rmse < 0.1 for r in cv)
    gate = V.cv_gates(V.cross_validate(df, "site_name", n, ridge=1e-3), ["week"]).first()
    assert gate.cv_pass and gate.n_test == 60


def test_partial_matrices_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([("w", rng.random(4).tolist(), 1.0) for _ in range(40)], "week string, a array<double>, c_bg double")
    one = V.normal_equations(df.coalesce(1), ["week"], 4).orderBy("j", "k").toPandas()
    many = V.normal_equations(df.repartition(9), ["week"], 4).orderBy("j", "k").toPandas()
    assert np.allclose(one[["v", "m"]], many[["v", "m"]])


def test_forecast_decay(frame):
    obs = frame([(1, "A", f"2024-01-01 {h:02d}:00:00", float(h), 3.0) for h in range(8)], "network bigint, site_name string, obs_time timestamp, h2s double, flow_border double")
    seed = seed_state(obs)
    s = seed.first()
    assert (s.h2s_last, s.h2s_6, s.h2s_24) == (7.0, 4.5, 3.5)
    fc = frame([(1, f"2024-01-02 {h:02d}:00:00", 4.0, 90.0) for h in range(10)], "network bigint, obs_time timestamp, wind_speed_10m double, wind_direction_10m double")
    r = forecast_features(fc, seed, ["network"], hours=5).orderBy("step").collect()
    assert len(r) == 5 and r[0].h2s_lag_1h == 7.0 and r[2].h2s_lag_1h == pytest.approx(7 * np.exp(-1 / 12)) and r[2].h2s_lag_3h == 7.0
    assert r[4].h2s_rolling_24h == pytest.approx(3.5 * np.exp(-4 / 36)) and r[4].wind_gusts_10m_max_2h == pytest.approx(7.2)


def test_conform_turns_nan_into_null(spark):
    df = spark.createDataFrame([(float("nan"), "2024-01-01", 3)], "h2s double, date string, other int")
    r = schema.conform(df, schema.OBS, aliases={"date": "obs_time"}, defaults={"network": 7}, keep=["other"]).first()
    assert r.h2s is None and r.network == 7 and r.obs_time.day == 1 and r.other == 3 and r.wind_speed_10m is None


def test_dynamic_partitions_and_missing_runs(spark, frame):
    path = scratch_path(spark, "t-runs")
    df = frame([("A", "2024-01-01 06:00:00", 1.0), ("A", "2024-01-01 12:00:00", 2.0)], "site_name string, run_time timestamp, v double")
    S.write_predictions(df, path, "m")
    S.write_predictions(df.filter("v = 2").withColumn("v", F.lit(9.0)), path, "m")
    got = {r.run_hour: r.v for r in R.read_prediction_runs(spark, path, "2024-01-01").collect()}
    assert got == {6: 1.0, 12: 9.0}


def test_scan_prunes_and_pushes(spark, frame):
    path = scratch_path(spark, "t-obs")
    schema.conform(frame([("2024-01-01 00:00:00", 1.0, True)], "obs_time timestamp, h2s double, h2s_measured boolean"), schema.OBS).write.parquet(path)
    plan = R.read_observations(spark, path, "2024-01-01", "2024-01-02").select("obs_time", "h2s")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(obs_time)" in plan and "ReadSchema: struct<obs_time:timestamp,h2s:double,h2s_measured:boolean>" in plan


def test_latest_q_field_only_when_recent(spark):
    field = spark.createDataFrame([("2024-01-01", 0, 1.0), ("2024-01-08", 0, 2.0)], "week string, segment int, rate double").withColumn("week", F.to_date("week"))
    new, old = scratch_path(spark, "q"), scratch_path(spark, "q")
    S.write_q_field(field, new, "2024-02-01")
    S.write_q_field(field, old, "2024-06-01")
    assert spark.read.parquet(f"{new}/latest").first().rate == 2.0 and spark.read.parquet(f"{new}/weekly").count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(f"{old}/latest").count()


def test_retried_batch_replaces_itself(spark):
    path = scratch_path(spark, "arch")
    df = spark.createDataFrame([("e1", 1.0), ("e1", 1.0), ("e2", 2.0)], "event_id string, v double")
    w = S.archive_batch(path)
    w(df, 0)
    w(df, 0)
    assert spark.read.parquet(path).count() == 2


def test_archive_counts_an_event_once(spark):
    from pyspark.sql import Row

    make = lambda *rows: spark.createDataFrame(list(rows), "event_id string, v double")
    a = S.ReportArchive(spark, scratch_path(spark, "archive"))
    assert a.read() is None and a.commits().count() == 0
    a.compact()
    a.vacuum()
    a.add(make(("e1", 1.0), ("e2", 2.0), ("e2", 2.0)), 0, "first")
    a.add(make(("e1", 1.0), ("e2", 2.0), ("e2", 2.0)), 0, "first")  # a batch that is retried
    a.add(make(("e2", 9.0), ("e3", 3.0)), 0, "second")  # a restart under a new checkpoint
    a.add(make(), 1, "second")
    want = [Row(event_id="e1", v=1.0), Row(event_id="e2", v=2.0), Row(event_id="e3", v=3.0)]
    read = lambda: sorted(a.read().select("event_id", "v").collect())
    assert read() == want and a.commits().count() == 3
    before = a.read()
    a.compact()
    assert a.commits().count() == 1 and read() == want and before.count() == 3  # older readers go on
    a.add(make(("e3", 7.0), ("e4", 4.0)), 2, "second")
    a.vacuum()
    assert read() == [*want, Row(event_id="e4", v=4.0)] and len(a._folders("data")) == 2
    # data without a commit is not read
    make(("e9", 9.0)).write.parquet(f"{a.path}/data/unfinished")
    assert read()[-1].event_id == "e4"


def test_snapshot_is_never_overwritten(spark):
    base = scratch_path(spark, "snap")
    S.write_snapshot(spark.range(3), base, "a")
    with pytest.raises(Exception):
        S.write_snapshot(spark.range(3), base, "a")


def test_unknown_formats_are_refused(spark):
    with pytest.raises(ValueError):
        R.read_forecast(spark, "x", "xml")
    with pytest.raises(ValueError):
        S.write_formats(spark.range(1), scratch_path(spark, "f"), ("xml",))


def test_model_variant_round_trip(spark):
    from airq.operators import models as Z

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.random(200), "z": rng.random(200)})
    pdf["h2s"] = 50 * pdf.x
    df = spark.createDataFrame(pdf)
    model = Z.fit_pair(df, "regression", "h2s", ["x", "z"], Z.TreeSettings(trees=3, depth=3))[0]
    path = scratch_path(spark, "variant")
    S.save_model_variant(model, ["x", "z"], path, spark)
    again, feats = R.read_model_variant(spark, path)
    assert feats == ["x", "z"]
    a = model.transform(df).agg(F.sum("a")).first()[0]
    assert again.transform(df).agg(F.sum("a")).first()[0] == pytest.approx(a)
    assert Z.feature_importance(model, feats, spark, 1).first().feature == "x"


def test_written_tables_last_as_long_as_their_block(spark):
    from airq.session import materialize, written_tables

    with written_tables(spark):
        kept = materialize(spark.range(5), "brief")
        path = kept.inputFiles()[0]
        assert kept.count() == 5
    with pytest.raises(Exception, match="(?i)path|exist"):
        spark.read.parquet(path).count()


def test_matrices_of_the_others(spark):
    rng = np.random.default_rng(8)
    rows = [("w", s, rng.random(3).tolist(), float(rng.random())) for s in ["A", "B", "C", None] for _ in range(5)] + [("alone", "A", [1.0, 2.0, 3.0], 1.0)]
    df = spark.createDataFrame(rows, "week string, site_name string, a array<double>, c_bg double")
    got = V.others_matrices(V.normal_equations(df, ["week", "site_name"], 3), ["week"], "site_name").toPandas()
    assert set(got.week) == {"w"} and len(got) == 4 * (6 + 3 + 3)
    for held in ["A", "B", "C", None]:
        own = got[got.held_out.isna()] if held is None else got[got.held_out == held]
        a, c = np.array([r[2] for r in rows if r[0] == "w" and r[1] != held]), np.array([r[3] for r in rows if r[0] == "w" and r[1] != held])
        at = {(r.j, r.k): (r.v, r.m) for r in own.itertuples()}
        assert all(at[j, k][0] == pytest.approx((a.T @ a)[j, k]) for j in range(3) for k in range(j, 3))
        assert all(at[j, -1][0] == pytest.approx((a.T @ c)[j]) and at[j, -2][1] == a[:, j].max() for j in range(3))


def test_fold_report_by_numpy(spark):
    rng = np.random.default_rng(9)
    rows = [("w", "ABC"[i % 3], i % 2, rng.random(3).tolist(), float(3 * rng.random())) for i in range(30)]
    df = spark.createDataFrame(rows, "week string, site_name string, fold int, a array<double>, c_bg double")
    pred = V.held_out_predictions(df, "fold", 3)
    got = {(r["scope"], r["part"]): r for r in V.fold_report(pred, ["week"]).collect()}
    assert set(got) == {("overall", "all"), *[("sensor", s) for s in "ABC"], ("held_out", "0"), ("held_out", "1")}
    fitted = {}
    for f in (0, 1):
        a, c = np.array([r[3] for r in rows if r[2] != f]), np.array([r[4] for r in rows if r[2] != f])
        s = a.max(axis=0)
        fitted[f] = V.nonnegative_solve((a.T @ a) / np.outer(s, s) + 0.09 * np.eye(3), (a.T @ c) / s) / s
    e = np.array([r[4] - np.array(r[3]) @ fitted[r[2]] for r in rows])
    for (scope, part), r in got.items():
        own = np.array([scope == "overall" or (scope == "sensor" and x[1] == part) or (scope == "held_out" and str(x[2]) == part) for x in rows])
        c = np.array([x[4] for x in rows])[own]
        assert r["n_test"] == own.sum() and r["rmse"] == pytest.approx(np.sqrt((e[own] ** 2).mean())) and r["bias"] == pytest.approx(e[own].mean())
        assert r["rmse_over_std"] == pytest.approx(np.sqrt((e[own] ** 2).mean()) / c.std())


def test_rolling_window_ends(frame):
    d = frame([(f"2024-01-{k:02d} 06:00:00",) for k in range(1, 11)], "obs_time timestamp")
    day = lambda w: sorted(r[0].day for r in w.collect())
    assert day(V.rolling_window(d, 3)) == [7, 8, 9, 10]
    assert day(V.rolling_window(d, 1.5, "2024-01-05 18:00:00")) == [4, 5] and day(V.rolling_window(d.limit(0), 3)) == []


def test_cells_within_a_circle(spark):
    pts = [("a", 32.55, -117.1), ("b", 32.45, -117.25), ("c", 32.9, -117.1), ("d", None, -117.1), ("e", 32.699, -117.001)]
    df = spark.createDataFrame(pts, "k string, la double, lo double")
    rows, cols = D.grid_shape(C.FORWARD_GRID_BOUNDS, 1000.0)
    km = lambda d: F.sqrt(F.pow((F.col("cell_lat") - F.col("la")) * P.LAT_M, 2) + F.pow((F.col("cell_lon") - F.col("lo")) * P.LON_M, 2))
    want = {(r.k, r.row, r.col) for r in D.on_grid(df, resolution_m=1000.0).filter(km(df) <= 5000.0).collect()}
    opened = D.cells_within(df, "la", "lo", 5000.0, ["k"], resolution_m=1000.0)
    got = {(r.k, r.row, r.col) for r in opened.filter(km(df) <= 5000.0).collect()}
    assert got == want and len({k for k, _, _ in got}) == 3 and opened.count() <= len(want) + 4
    assert rows * cols * 5 > 4 * len(want)


def test_segments_of_fixed_points(spark):
    for spacing in (150.0, 400.0, 5000.0):
        assert D.n_segments(C.CHANNEL_WAYPOINTS, spacing) == D.channel_segments(C.waypoints(spark), spacing).count()


def test_pairs_with_maps_and_repeated_rows(spark):
    from airq.operators.dims import pair_with

    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1}), (2, None)], "i int, m map<string, int>")
    dim = spark.createDataFrame([(10,), (20,)], "d int")
    for salts in (None, 1, 7):
        assert sorted((r.i, r.d) for r in pair_with(df, dim, salts).collect()) == [(1, 10), (1, 10), (1, 20), (1, 20), (2, 10), (2, 20)]
    assert pair_with(df.select("m"), dim).count() == 6


def test_rasters_of_arrays_equal_those_of_expressions(spark):
    met = spark.createDataFrame(
        [("a", 2.0, 200.0, 15.0, 1, 3.0), ("b", 0.0, 10.0, 15.0, 0, None), ("c", None, 10.0, 15.0, 0, 1.0), ("d", 4.0, 30.0, None, 0, 1.0), (None, 6.0, 300.0, 5.0, None, 60.0), ("a", 3.0, 90.0, 9.0, 0, 3.0)],
        "k string, wind_speed_10m double, wind_direction_10m double, temperature_2m double, is_night int, lead double")
    src = D.default_rates(spark)
    d = D.on_grid(P.with_wind_terms(met), resolution_m=2500.0)
    d = P.add_plume(D.pair_with(d, src.withColumn("rate", F.col("rate") * 0.1)), "cell_lat", "cell_lon", P.PlumeSettings(floor_km=P.GRID_FLOOR_KM))
    near = F.least(*[F.sqrt(F.pow((F.col("cell_lat") - la) * P.LAT_M, 2) + F.pow((F.col("cell_lon") - lo) * P.LON_M, 2)) for _, _, la, lo in C.STATIONS])
    want = d.groupBy("k", "row", "col").agg(F.least(F.sum(P.to_ppb(F.col("_ug"), F.col("temperature_2m"))), F.lit(500.0)).alias("ppb"), F.first(P.confidence(near, F.col("lead"))).alias("confidence"))
    got = D.gridded_forecast(met, src, C.stations(spark), ["k"], resolution_m=2500.0, lead_h="lead", block_cells=50)
    assert "MapInArrow" in got._jdf.queryExecution().toString()
    at = lambda x: {(r.k, r.row, r.col): (r.ppb, r.confidence) for r in x.collect()}
    got, want = at(got), at(want)
    assert got.keys() == want.keys() and len(got) == 5 * np.prod(D.grid_shape(C.FORWARD_GRID_BOUNDS, 2500.0))
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9), k


def test_river_grid_equals_a_loop_over_cells(spark):
    rows = [("a", 3.0, 200.0, 40.0, 1.0, 22.0), ("b", None, 20.0, 90.0, 0.5, 15.0), (None, 5.0, None, 10.0, 0.0, 30.0), ("c", 2.0, 90.0, 40.0, 1.0, None)]
    cond = spark.createDataFrame(rows, "k string, wind_speed double, wind_direction double, flow double, tide double, temperature double")
    pts = [(n, k, b, int(f), int(t), la, lo) for n, k, b, f, t, xy in C.RIVER_SOURCES for la, lo in xy]
    src = C.literal_table(spark, pts, "source string, kind string, base double, fd int, td int, source_lat double, source_lon double")
    e = D.emission.river_strength(F.col("base"), F.col("kind"), F.col("fd") == 1, F.col("td") == 1, F.col("flow"), F.col("tide"), F.col("temperature"))
    want = {}
    cells = D.on_grid(D.pair_with(cond, src).withColumn("e", e).filter("e > 0"), resolution_m=2000.0).collect()
    for r in cells:
        dx, dy = (r.cell_lon - r.source_lon) * P.LON_M, (r.cell_lat - r.source_lat) * P.LAT_M
        km = np.sqrt(dx * dx + dy * dy) / 1000
        if km <= 8.0:
            al = -1.0 if r.wind_direction is None else np.cos(np.arctan2(dx, dy) - np.radians(r.wind_direction + 180))
            if al > 0 and r.wind_speed is None:
                want.setdefault((r.k, r.row, r.col), None)
                continue
            eff, sg = (km / (al * r.wind_speed / 10 + 1), km * 0.1 + 0.5) if al > 0 else (km * 3, 0.4)
            c = r.e * np.exp(-(eff * eff) / (2 * sg * sg)) * (1.2 if r.kind == "channel" else 1.0)
            want[r.k, r.row, r.col] = (want.get((r.k, r.row, r.col)) or 0.0) + c
    got = {(r.k, r.row, r.col): r.emission for r in D.river_grid(cond, ["k"], resolution_m=2000.0).collect()}
    assert got.keys() == want.keys() and len({k for k, _, _ in got}) >= 3
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or got[k] == pytest.approx(v, rel=1e-9)), k
