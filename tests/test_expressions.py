"""Row expressions against hand-worked values."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions import classes as K
from airq.functions import clock as T
from airq.functions import geo
from airq.functions import plume as P
from airq.functions.features import base_features, source_regime


def one(spark, **cols):
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    return row.asDict()


def test_class_edges_differ_by_closed_side(spark):
    r = one(spark, a=K.three_class(F.lit(5.0)), b=K.three_class(F.lit(5.0), "right"), c=K.three_class(F.lit(30.0)),
            d=K.three_class(F.lit(30.0), "right"), e=K.three_class(F.lit(None).cast("double")))
    assert r == {"a": "yellow", "b": "green", "c": "orange", "d": "yellow", "e": None}
    with pytest.raises(ValueError):
        K.three_class(F.lit(1.0), "both")


def test_risk_uses_the_30_ppb_probability_only_when_positive(spark):
    lit = F.lit
    r = one(spark, absent=K.risk_tier(lit(0.0), lit(0.6), lit(1.0)), low30=K.risk_tier(lit(0.0), lit(0.9), lit(1.0), lit(0.2)),
            high30=K.risk_tier(lit(0.0), lit(0.0), lit(1.0), lit(0.4)), edge=K.risk_tier(lit(0.25), lit(0.5), lit(5.0)))
    assert r == {"absent": "ORANGE", "low30": "GREEN", "high30": "ORANGE", "edge": "GREEN"}


def test_decision_ties_and_orange_first(spark):
    r = one(spark, tie=K.decide(F.lit(0.4), F.lit(0.4), F.lit(0.2)), cut=K.decide(F.lit(0.5), F.lit(0.3), F.lit(0.2), orange_cut=0.3),
            yellow=K.decide(F.lit(0.5), F.lit(0.1), F.lit(0.4), orange_cut=0.33))
    assert r == {"tie": "green", "cut": "orange", "yellow": "yellow"}


def test_hill_inverts(spark):
    r = one(spark, at=K.hill(F.lit(5.0)), back=K.hill_inverse(K.hill(F.lit(17.5))))
    assert r["at"] == pytest.approx(0.5) and r["back"] == pytest.approx(17.5)


def test_flag_counts_missing_as_zero(spark):
    assert one(spark, f=K.flag(F.lit(None).cast("double") > 5))["f"] == 0


def test_half_hours_round_to_the_even_hour(spark):
    ts = lambda x: F.lit(x).cast("timestamp")
    r = one(spark, a=T.round_to_hour(ts("2024-01-01 10:30:00")), b=T.round_to_hour(ts("2024-01-01 11:30:00")), c=T.round_to_hour(ts("2024-01-01 11:29:59")))
    assert [v.hour for v in r.values()] == [10, 12, 11]


def test_night_rules(spark):
    ts = F.lit("2024-01-15 15:00:00").cast("timestamp")
    r = one(spark, utc=T.night(ts), local=T.night(ts, "local"), col=T.night(ts, "column", F.lit("night")), missing=T.night(ts, "column", F.lit(None).cast("string")))
    assert r == {"utc": 0, "local": 1, "col": 1, "missing": 0}


def test_source_regime_quadrants(spark):
    d = {f"d{i}": source_regime(F.lit(1), F.lit(v)) for i, v in enumerate((22.4, 22.5, 134.9, 135.0, 247.5))}
    assert list(one(spark, **d).values()) == [2, 1, 1, 3, 2]
    assert one(spark, day=source_regime(F.lit(0), F.lit(90.0)), none=source_regime(F.lit(1), F.lit(None).cast("double"))) == {"day": 0, "none": 0}


def test_base_features_keeps_what_is_there(frame):
    df = frame([("2026-03-01 02:00:00", 0.5, 9.9)], "obs_time timestamp, wind_speed_10m double, hour_sin double")
    r = base_features(df).first()
    assert r.hour_sin == 9.9 and r.stable_atm == 1 and r.wind_x_stable_atm == 0.5
    assert r.tidal_state_encoded == -1 and r.sbiwtp_flow_mgd == 23.5 and r.wind_temp_interaction == 0.0


def test_feature_sets_nest():
    assert [len(C.FEATURE_SETS[n]) for n in ("legacy", "evidence", "lean", "minimal")] == [44, 33, 19, 11]
    assert set(C.FEATURES_19) <= set(C.FEATURES_33) <= set(C.FEATURES_44) and set(C.FEATURES_11) <= set(C.FEATURES_44)


def test_angles_keep_the_positive_remainder(spark):
    r = one(spark, b=geo.bearing(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(-1.0)), d=geo.angular_difference(F.lit(10.0), F.lit(350.0)),
            e=geo.angular_difference(F.lit(0.0), F.lit(180.0)))
    assert r["b"] == pytest.approx(270.0) and r["d"] == pytest.approx(20.0) and r["e"] == -180.0


def plume_ref(u, v, dx, dy, q, ay, az, floor):
    ws = math.hypot(u, v)
    if ws < 0.1:
        return q * 1e6 / (max(math.hypot(dx, dy), 50.0) ** 2 * 50.0)
    along, cross = (dx * u + dy * v) / ws, (u * dy - v * dx) / ws
    if along <= 0:
        return 0.0
    km = max(along / 1000, floor) ** 0.894 * 1000
    sy, sz = math.hypot(ay * km, math.radians(20) * along), az * km
    return q * 1e6 / (math.pi * max(ws, 0.3) * sy * sz) * math.exp(-0.5 * (cross / sy) ** 2) * (
        math.exp(-0.5 * (0.5 / sz) ** 2) + math.exp(-0.5 * (3.5 / sz) ** 2))


@pytest.mark.parametrize("floor", [P.POINT_FLOOR_KM, P.GRID_FLOOR_KM])
def test_plume_matches_its_formula(spark, floor):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "wind_speed_10m": np.append(rng.uniform(0, 8, 60), [0.0, 0.05]), "wind_direction_10m": rng.uniform(0, 360, 62), "is_night": rng.integers(0, 2, 62),
        "source_lat": 32.55 + rng.uniform(-0.01, 0.01, 62), "source_lon": -117.08 + rng.uniform(-0.01, 0.01, 62), "rate": 3.0, "la": 32.55, "lo": -117.08})
    d = P.add_plume(P.with_wind_terms(spark.createDataFrame(pdf)), "la", "lo", P.PlumeSettings(floor_km=floor))
    coef = {s: (y, z) for s, y, z in C.PLUME_COEFFICIENTS}
    seen = 0
    for r in d.collect():
        dx, dy = (r.lo - r.source_lon) * P.LON_M, (r.la - r.source_lat) * P.LAT_M
        want = plume_ref(r._u, r._v, dx, dy, 3.0, *coef[r._stab], floor)
        assert r._ug == pytest.approx(want, rel=1e-9, abs=1e-12)
        seen += want > 0
    assert seen > 20


def test_plume_array_equals_plume_rows(spark):
    pdf = pd.DataFrame({"wind_speed_10m": [3.0, 0.0], "wind_direction_10m": [200.0, 10.0], "is_night": [1, 0], "la": 32.56, "lo": -117.09})
    src = F.array(*[F.struct(F.lit(a).alias("source_lat"), F.lit(b).alias("source_lon")) for _, a, b in C.SOURCES])
    base = P.with_wind_terms(spark.createDataFrame(pdf))
    arr = base.select("wind_speed_10m", P.plume_array(src, F.col("la"), F.col("lo")).alias("a")).collect()
    rows = P.add_plume(base.withColumn("s", F.explode(src)).select("*", "s.*").withColumn("rate", F.lit(1.0)), "la", "lo").collect()
    for r in arr:
        assert r.a == pytest.approx([x._ug for x in rows if x.wind_speed_10m == r.wind_speed_10m], rel=1e-12)
