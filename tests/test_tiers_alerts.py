"""Tier cells against a brute-force loop, events and messages against direct machines."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions.features import base_features
from airq.operators import alerts as L
from airq.operators import attribution as A
from airq.operators import tiers as T
from airq.schema import OBS, conform
from airq.session import scratch_path
from airq.streaming import machines as SM
from airq.streaming import streams as ST

NB, IB, SY = C.PRIMARY_STATION, C.BACKUP_STATION, "SAN YSIDRO"


@pytest.fixture(scope="module")
def hourly():
    rng = np.random.default_rng(42)
    rows = []
    for net, sites in ((1, (NB, IB, SY)), (2, (IB, SY)), (3, (NB,))):
        for s in sites:
            for h in range(60):
                if rng.random() < 0.25:
                    continue
                rows.append({
                    "network": net, "site_name": s, "obs_time": pd.Timestamp("2024-01-01") + pd.Timedelta(hours=h),
                    "h2s": float(rng.choice([0.5, 8.0, 35.0])) if rng.random() > 0.1 else None, "wind_speed_10m": float(rng.uniform(0, 7)),
                    "wind_direction_10m": float(rng.uniform(0, 360)), "temperature_2m": float(rng.uniform(12, 18)), "dewpoint_2m": float(rng.uniform(10, 15)),
                    "surface_pressure": 1013.0, "precipitation": 0.0, "flow_border": 2.0, "sbiwtp_flow_mgd": 22.0})
    return pd.DataFrame(rows)


def brute(pdf):
    pdf = pdf.assign(
        flow_log=np.log1p(pdf.flow_border), sbiwtp_anomaly=pdf.sbiwtp_flow_mgd - 23.5, sbiwtp_sli=0.0, sbiwtp_deficit=0.0,
        night=pdf.obs_time.dt.hour.isin([20, 21, 22, 23, 0, 1, 2, 3, 4, 5]).astype(int), local=((pdf.obs_time - pd.Timedelta(hours=8)).dt.hour.isin([*range(20, 24), *range(8)])).astype(int))
    pdf["stable_atm"] = ((pdf.wind_speed_10m < 5) & (pdf.night == 1)).astype(int)
    out = {}
    for net, df in pdf.groupby("network"):
        times = pd.date_range(df.obs_time.min().ceil("1h"), df.obs_time.max().floor("1h") - pd.Timedelta(hours=24), freq="1h")
        active = df.dropna(subset=["h2s"]).site_name.nunique()
        stats = C.SINGLE_STATION_STATS if active <= 1 else C.QUIET_STATS
        met_site = df.site_name.iloc[0] if df.site_name.nunique() == 1 else NB if (df.site_name == NB).any() else IB
        for t in times:
            for hz, a, b in C.HORIZONS:
                win = df[(df.obs_time >= t + pd.Timedelta(hours=a)) & (df.obs_time < t + pd.Timedelta(hours=b))]
                own = {s: win[win.site_name == s] for s in (NB, IB, SY)}
                met = own[met_site]
                cells = {s: (w if len(w) else met) for s, w in own.items()}
                cells = {s: w for s, w in cells.items() if len(w)}
                g1 = {s: w.wind_speed_10m.notna().any() for s, w in cells.items()}
                n1 = sum(g1.values())
                ok2 = n1 >= min(2, max(1, active))
                g2 = {s: g1[s] and ok2 and w.wind_speed_10m.mean() < 4 for s, w in cells.items()}
                g3 = {s: g2[s] and w.temperature_2m.min() > 13 and w.dewpoint_2m.mean() > 11 and w.stable_atm.mean() > 0.6 for s, w in cells.items()}
                bell = cells.get(NB, cells.get(IB))
                parent = True
                for (tier, ppb), gates in zip(C.TIER_PPB, (g1, g2, g3)):
                    z = 0.0
                    if bell is not None:
                        for f, wt in C.TIER_WEIGHTS[tier].items():
                            v = bell.wind_speed_10m.min() if f == "wind_speed_min" else bell[f].mean()
                            if not math.isnan(v) and stats[f][1]:
                                z += wt * (v - stats[f][0]) / stats[f][1]
                    score = min(0.95, 1 / (1 + math.exp(-z)))
                    fire = any(gates.values()) and score >= 0.5 and parent
                    parent = fire
                    exc = win[win.h2s >= ppb]
                    lead = (exc.obs_time.min() - t).total_seconds() / 3600 if len(exc) else None
                    day = NB in cells and len(met) > 0 and met.local.mean() < 0.75
                    nb = own[NB].h2s.max()
                    out[(net, t, hz, tier)] = (any(gates.values()), round(score, 3), fire, exc.site_name.nunique(), lead, day, 0.0 if nb != nb else nb)
    return out


def test_backtest_equals_the_loop(spark, hourly):
    # two more networks with one station each
    hourly = pd.concat([hourly, *[hourly[hourly.site_name == x].assign(network=90 + k) for k, x in enumerate((IB, SY))]], ignore_index=True)
    obs = base_features(conform(spark.createDataFrame(hourly), OBS).repartition(4))
    rec = T.backtest(T.tier_cells(obs, C.stations(spark), ["network"]), ["network"])
    got = {(r.network, pd.Timestamp(r.evaluated_at), r.horizon, r.tier): (
        r.gate_passed, round(r.score, 3), r.fired, r.n_stations_exceeding, r.lead_time_hours, r.daytime_horizon, r.primary_max) for r in rec.collect()}
    want = brute(hourly)
    assert set(got) == set(want)
    bad = [(k, got[k], want[k]) for k in want if got[k][0] != want[k][0] or abs(got[k][1] - want[k][1]) > 0.0015 or got[k][2:] != want[k][2:]]
    assert not bad, bad[:3]
    fired = {k for k, v in got.items() if v[2]}
    for net, t, hz, tier in fired:
        if tier != "tier_1":
            assert (net, t, hz, f"tier_{int(tier[-1]) - 1}") in fired
    assert {k[3] for k in fired} == {"tier_1", "tier_2", "tier_3"}


def test_horizon_cells_do_not_depend_on_chunks(spark, hourly):
    obs = base_features(conform(spark.createDataFrame(hourly), OBS))
    a = T.horizon_cells(obs, ["network"], seconds=7 * 86400)
    b = T.horizon_cells(obs.repartition(7), ["network"], seconds=86400)
    key = ["network", "site_name", "horizon", "evaluated_at"]
    cols = [*key, "n", F.round("wind_speed_10m", 9).alias("w"), "first_tier_3"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0 and a.count() == b.count()


def test_score_saturates_and_starts_at_half(spark):
    w = {"wind_speed_10m": -0.34, "stable_atm": 0.27}
    df = spark.createDataFrame([(None, None), (-500.0, 1.0)], "c_wind_speed_10m double, c_stable_atm double")
    assert sorted(r.s for r in df.select(T.score("c", w, F.lit(False)).alias("s")).collect()) == [0.5, 0.95]


def direct_events(times, quiet=3.0, close=1.5):
    """Plain replay of the machine with a clock that also fires the closing time."""
    events, is_open, seen = [], False, None
    for t in times:
        if is_open and t - events[-1][1] > close:
            is_open = False
        if is_open:
            events[-1][1] = t
            events[-1][2] += 1
        elif seen is None or t - seen > quiet:
            events.append([t, t, 1])
            is_open = True
        seen = t
    return [tuple(e) for e in events]


@pytest.fixture(scope="module")
def readings(spark):
    rng = np.random.default_rng(9)
    rows = []
    for site in ("A", "B"):
        for q in sorted(rng.choice(4 * 24 * 20, 600, replace=False)):
            rows.append((1, site, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=15 * int(q)), float(rng.choice([5.0, 31.0, 150.0], p=[0.75, 0.2, 0.05]))))
    return pd.DataFrame(rows, columns=["network", "site_name", "time", "h2s_ppb"])


def wanted_events(pdf):
    out = set()
    for (net, site), g in pdf.groupby(["network", "site_name"]):
        for tier, thr in L.TIERS:
            up = g[g.h2s_ppb >= thr].sort_values("time")
            hours = [(t - pd.Timestamp("2024-01-01")).total_seconds() / 3600 for t in up.time]
            out |= {(site, tier, *e) for e in direct_events(hours)}
    return out


def test_events_equal_the_replay(spark, readings):
    df = spark.createDataFrame(readings).repartition(3)
    ev = L.exceedance_events(df, ["network", "site_name"], time="time", h2s="h2s_ppb")
    hours = lambda t: (pd.Timestamp(t) - pd.Timestamp("2024-01-01")).total_seconds() / 3600
    got = {(r.site_name, r.tier, hours(r.event_start), hours(r.last_exceedance), r.n) for r in ev.collect()}
    assert got == wanted_events(readings) and len(got) > 40


def test_stream_equals_batch_whatever_the_arrival(spark, readings):
    """Rows arrive in several files, shuffled within the delay."""
    path = scratch_path(spark, "arrivals")
    pdf = readings.sort_values("time").reset_index(drop=True)
    pdf["file"] = ((pdf.time - pdf.time.min()).dt.total_seconds() // (6 * 3600)).astype(int)
    schema = "network bigint, site_name string, time timestamp, h2s_ppb double"
    for n, (_, part) in enumerate(pdf.groupby("file")):
        spark.createDataFrame(part.sample(frac=1, random_state=n).drop(columns="file"), schema).coalesce(1).write.mode("append").parquet(path)
    out = ST.run_available(SM.event_stream(ST.parquet_stream(spark, path, spark.read.parquet(path).schema, max_files=7)), "t-events").collect()
    wm = readings.time.max() - pd.Timedelta(hours=2)
    done = readings[readings.time <= wm]
    hours = lambda t: (pd.Timestamp(t) - pd.Timestamp("2024-01-01")).total_seconds() / 3600
    want = wanted_events(done)
    onsets = {(r.site_name, r.tier, hours(r.event_start)) for r in out if r.trigger == "onset"}
    sums = {(r.site_name, r.tier, hours(r.event_start), hours(r.last_exceedance)) for r in out if r.trigger == "summary"}
    assert onsets == {e[:3] for e in want}
    assert sums == {e[:4] for e in want if e[3] + 1.5 <= hours(wm)}
    assert len(onsets) == sum(r.trigger == "onset" for r in out)


def test_late_rows_are_dropped_after_the_watermark(spark):
    path = scratch_path(spark, "late")
    schema = "network bigint, site_name string, time timestamp, h2s_ppb double"
    ts = lambda h: pd.Timestamp("2024-01-01").to_pydatetime() + pd.Timedelta(hours=h).to_pytimedelta()
    cp, out = scratch_path(spark, "late-cp"), scratch_path(spark, "late-out")
    for rows in ([(1, "A", ts(10), 1.0)], [(1, "A", ts(3), 99.0), (1, "A", ts(9), 3.0)], [(1, "A", ts(20), 5.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        got = ST.run_available(ST.hourly(ST.parquet_stream(spark, path, spark.read.parquet(path).schema), ["site_name"]), "late", checkpoint=cp, sink=out)
    assert {r.window_start.hour: r["max"] for r in got.collect()} == {9: 3.0, 10: 1.0}


def test_repeated_rows_are_dropped_once(spark):
    path = scratch_path(spark, "dups")
    pdf = pd.DataFrame({"network": 1, "site_name": "A", "time": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 00:15"]), "h2s_ppb": [1.0, 2.0]})
    for _ in range(3):
        spark.createDataFrame(pdf).coalesce(1).write.mode("append").parquet(path)
    s = ST.deduplicated(ST.parquet_stream(spark, path, spark.read.parquet(path).schema, max_files=1), ["network", "site_name"])
    assert ST.run_available(s, "dups").count() == 2


def test_tier_messages(spark):
    m, machine = {"cells": {}, "sent": {}}, SM.TierMachine()
    hour = SM.HOUR_US

    def cycle(h, **fired):
        rows = [(t, "nowcast", "true" if fired.get(t) else "false", "0.9" if fired.get(t) else "0.1") for t in ("tier_1", "tier_2", "tier_3")]
        return [(o[1], o[3], o[4]) for o in machine.cycle(m, h * hour, rows)]

    assert cycle(0, tier_1=True) == [("tier_1", True, "")]
    assert cycle(1, tier_1=True) == []
    assert cycle(2, tier_1=True, tier_2=True) == [("tier_2", True, "")]
    for h in (3, 4, 5):
        assert cycle(h) == []
    assert not m["cells"]["tier_1/nowcast"]["active"]
    assert cycle(6, tier_1=True, tier_2=True, tier_3=True) == [("tier_1", False, "higher tier active"), ("tier_2", False, "higher tier active"), ("tier_3", True, "")]


def test_debounce_matches_a_replay(frame):
    pattern = [(1, .9), (1, .9), (0, .4), (0, .2), (0, .2), (0, .2), (0, .1), (1, .9), (0, .2), (1, .9), (0, .5), (0, .5), (0, .5), (1, .9)]
    rows = [("k", f"2024-01-01 {h:02d}:00:00", bool(f), s) for h, (f, s) in enumerate(pattern)]
    df = L.debounce(frame(rows, "k string, evaluated_at timestamp, fired boolean, score double"), ["k"])
    active, last, clear, want = False, None, 0, []
    for h, (f, s) in enumerate(pattern):
        onset = False
        if f:
            onset = not active or last is None or h - last >= 3
            active, last, clear = True, h, 0
        elif s < 0.3 and active:
            clear += 1
            active = clear < 3
        want.append((onset, active))
    got = [(r.send_onset, r.active) for r in df.orderBy("evaluated_at").collect()]
    assert got == want


def test_aligned_source_rules(spark):
    rows = [("NESTOR - BES", 170.0, 1), ("NESTOR - BES", 170.0, 0), ("NESTOR - BES", 80.0, 1), ("ELSEWHERE", 80.0, 1)]
    df = spark.createDataFrame(rows, "site_name string, wind_direction_10m double, is_night int")
    got = {(r.wind_direction_10m, r.is_night): r.aligned_source for r in A.aligned_source(df, C.stations(spark), C.sources(spark)).collect()}
    assert got[(170.0, 0)] == A.MIXED and got[(80.0, 1)] == A.UNALIGNED and got[(170.0, 1)] in {n for n, _, _ in C.SOURCES} and len(got) == 3


def test_merge_keeps_the_first_model_on_a_tie(frame):
    mk = lambda v: frame([("A", "2024-01-01 00:00:00", v)], "site_name string, obs_time timestamp, predicted_ppb double")
    merged = A.merge_models([("x", mk(40.0)), ("y", mk(40.0))], ["site_name", "obs_time"])
    r = A.lookahead_alerts(merged, F.lit("2023-12-31 18:00:00").cast("timestamp")).first()
    assert (r.model, r.tier) == ("x", "WATCH")
    assert A.lookahead_alerts(merged, F.lit("2023-12-31 17:59:00").cast("timestamp")).count() == 0


@pytest.mark.parametrize("seconds", [3600, 5 * 3600, 7 * 86400])
def test_scan_over_blocks_matches_a_replay(frame, seconds):
    import random

    rng, rows, want = random.Random(seconds), [], {}
    for key in ("a", "b", None):
        active, last, clear = False, None, 0
        for h in range(60):
            if rng.random() < 0.2:
                continue  # cycles may be missing
            f, s = rng.random() < 0.2, rng.choice([0.1, 0.2, 0.5])
            rows.append((key, f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00", f, s))
            was = (last, active)
            if f:
                active, last, clear = True, h, 0
            elif s < 0.3 and last is not None:
                clear = min(clear + 1, 3)
                active = clear < 3
            want[key, h] = (last, clear, active, *was)
    d = L.scan_cells(frame(rows, "k string, evaluated_at timestamp, fired boolean, score double"), ["k"], seconds=seconds)
    hour = lambda t: None if t is None else (t.day - 1) * 24 + t.hour
    got = {(r.k, hour(r.evaluated_at)): (hour(r.last_fire), r.clear_cycles, r.active, hour(r.was_last), r.was_active) for r in d.collect()}
    assert got == want


class FakeMap(dict):
    """A map state that counts what is read."""

    read = 0

    def updateValue(self, k, v):
        self[k] = v

    def getValue(self, k):
        self.read += 1
        return self[k]

    def removeKey(self, k):
        del self[k]

    def iterator(self):
        self.read += len(self)
        return iter(list(self.items()))


class FakeValue:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, v):
        self.held = v


class FakeHandle:
    def __init__(self):
        self.timers, self.map = set(), FakeMap()

    def getMapState(self, *a):
        return self.map

    def getValueState(self, *a):
        return FakeValue()

    def registerTimer(self, t):
        self.timers.add(t)


def test_a_timer_reads_what_is_due(monkeypatch):
    """Rows come out once and in order under any batches and watermarks, and a timer leaves parts alone that begin behind the watermark."""
    import random

    class Echo(SM.WaitingRows):
        def start(self):
            return {"n": 0}

        def advance(self, m, due, now):
            m["n"] += len(due)
            assert all(t < now for t, _ in due)
            return due, None

        def frame(self, key, out):
            return pd.DataFrame(out, columns=["t", "body"])

    class At:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    for seed in range(6):
        rng, handle, machine = random.Random(seed), FakeHandle(), Echo()
        machine.LEAST = 3
        machine.init(handle)
        sent, got, now = [], [], 0
        for batch in range(12):
            rows = [(1000 * rng.randint(now, now + 400), f"{batch}-{k}") for k in range(rng.choice([0, 1, 40]))]
            sent += rows
            list(machine.handleInputRows(("k",), iter([pd.DataFrame(rows, columns=["t", "body"])]), At(now)))
            now += rng.choice([0, 1, 60, 200])
            while handle.timers and min(handle.timers) <= now:
                handle.timers = {t for t in handle.timers if t > now}
                behind = [k for k in handle.map if k[0] >= now * 1000]
                before, handle.map.read = dict(handle.map), 0
                for f in machine.handleExpiredTimer(("k",), At(now), None):
                    got += list(zip(f["t"], f["body"])) if len(f) else []
                assert all(handle.map[k] == before[k] for k in behind) and handle.map.read <= len(before) - len(behind)
        assert got == sorted(got) and set(got) == {r for r in sent if r[0] < now * 1000} and len(got) == len(set(got))
        assert handle.timers or not handle.map


def test_few_waiting_rows_cost_few_calls_to_the_state():
    """Rows that come and are handled take a read and a write of one value each time, whatever they hold; an event is told in full."""
    calls, asked = [], 0

    class Counted(FakeHandle):
        def getMapState(self, *a):
            calls.append(super().getMapState(*a))
            for name in ("updateValue", "getValue", "removeKey", "iterator", "keys", "clear"):
                setattr(calls[0], name, lambda *a, n=name: pytest.fail(n))
            return calls[0]

        def getValueState(self, *a):
            value = super().getValueState(*a)
            calls.append(value)
            for name in ("exists", "get", "update"):
                def count(*a, f=getattr(value, name)):
                    nonlocal asked
                    asked += 1
                    return f(*a)
                setattr(value, name, count)
            return value

    class At:
        def __init__(self, us):
            self.us = us

        def getCurrentWatermarkInMs(self):
            return self.us // 1000

    hour, machine, handle = SM.HOUR_US, SM.ExceedanceMachine(), Counted()
    machine.init(handle)
    rows = pd.DataFrame([(k * hour // 2, "") for k in range(1, 41)], columns=["t", "body"])
    assert list(machine.handleInputRows((1, "s", "watch"), iter([rows]), At(0))) == [] and asked == 2
    (told,) = machine.handleExpiredTimer((1, "s", "watch"), At(30 * hour), None)
    assert list(told["trigger"]) == ["onset", "summary"] and asked == 4
    assert list(machine.handleExpiredTimer((1, "s", "watch"), At(31 * hour), None)) == []


def test_tier_cells_shuffle_readings_and_not_what_they_open_into(spark, hourly):
    obs = base_features(conform(spark.createDataFrame(hourly), OBS))
    plan = T.tier_cells(obs, C.stations(spark), ["network"])._jdf.queryExecution().executedPlan().toString()
    own = [line for line in plan.splitlines() if ":" not in line.split("+-")[0]]  # without subqueries
    first = next(k for k, line in enumerate(own) if "Generate inline" in line)
    assert not [line for line in own[:first] if "Exchange" in line or "Join" in line]


def test_tier_cells_do_not_depend_on_chunks(spark, hourly):
    obs = base_features(conform(spark.createDataFrame(hourly), OBS))
    a = T.tier_cells(obs, C.stations(spark), ["network"])
    b = T.tier_cells(obs.repartition(7), C.stations(spark), ["network"], seconds=86400)
    cols = ["network", "evaluated_at", "horizon", "gate_tier_1", "gate_tier_2", "gate_tier_3", "n_t1", "n_active", "primary_max", "any_max", "first_tier_1", F.round("score_tier_1", 9).alias("s")]
    assert a.count() == b.count() > 0 and a.select(cols).exceptAll(b.select(cols)).count() == 0


def test_tasks_follow_the_size_of_the_input(spark):
    from airq.operators.dims import parts_for

    few, many = spark.range(1000), spark.range(10_000_000)
    assert parts_for(many, 1 << 20) > parts_for(few, 1 << 20) == parts_for(spark.createDataFrame([(1,)], "a int"), 1)


def test_debounced_cells_are_computed_once(spark):
    """One exchange of readings by group and chunk, and one of packed blocks by cell; no second reading of the history."""
    from airq.plans import load_all
    from airq.plans.registry import spark_queries

    load_all()
    plan = spark_queries()["w15_debounced_cells"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "SortMergeJoin" not in plan
    by_block = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "_block" in x]
    assert not by_block


def test_scan_takes_blocks_that_are_there(frame):
    rows = [("a", f"2024-01-01 {h:02d}:00:00", h % 5 == 1, 0.1 + 0.3 * (h % 2)) for h in range(20)] + [(None, None, True, 0.9), (None, "2024-01-01 01:00:00", None, 0.1)]
    d = frame(rows, "k string, evaluated_at timestamp, fired boolean, score double").withColumn("part", F.floor(F.hour("evaluated_at") / 6))
    out = lambda x: {tuple(r) for r in x.select("k", "evaluated_at", "score", "last_fire", "clear_cycles", "active", "was_last", "was_active").collect()}
    got = L.scan_cells(d, ["k"], block="part")
    assert {r["part"] for r in got.collect()} == {0, 1, 2, 3, None}
    assert out(got) == out(L.scan_cells(d, ["k"], seconds=6 * 3600)) and got.count() == 22
