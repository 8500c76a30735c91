"""Distributed ordering against plain windows and pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.operators import features as X
from airq.operators.asof import nearest_join
from airq.operators.dims import pair_with
from airq.operators.ordering import fill_missing, latest, number_rows, row_windows, running_sums, time_windows
from airq.operators.ranks import _near_quantiles, auc, medians, quantiles, selected_quantiles, spearman


@pytest.fixture(scope="module")
def gappy(spark):
    """One site with most rows, one sparse, one with a single row, with long gaps and nulls."""
    rng = np.random.default_rng(3)
    rows = []
    for site, n, span in (("hot", 900, 2000), ("thin", 40, 9000), ("one", 1, 10)):
        for h in sorted(rng.choice(span, n, replace=False)):
            v = None if rng.random() < 0.2 else float(rng.integers(0, 30))
            rows.append((site, (pd.Timestamp("2024-01-01") + pd.Timedelta(hours=int(h))).to_pydatetime(), v))
    return spark.createDataFrame(rows, "site string, t timestamp, v double").repartition(5).cache()


@pytest.mark.parametrize("seconds,chunk", [(6 * 3600, 8), (30 * 86400, 4096), (86400, 24)])
def test_row_windows_equal_the_plain_window(gappy, seconds, chunk):
    w = W.partitionBy("site").orderBy("t")
    want = gappy.withColumns({
        "seq": F.row_number().over(w), "total": F.count("*").over(W.partitionBy("site")), "l": F.lag("v", 6).over(w), "n": F.lead("v", 2).over(w),
        "m": F.max("v").over(w.rowsBetween(-5, 0))})
    got = row_windows(number_rows(gappy, ["site"], "t", seconds=seconds), ["site"], 6, 2, lambda w: {
        "l": F.lag("v", 6).over(w), "n": F.lead("v", 2).over(w), "m": F.max("v").over(w.rowsBetween(-5, 0))}, chunk_rows=chunk)
    cols = ["site", "t", "v", "seq", "total", "l", "n", "m"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_time_windows_equal_the_plain_range(gappy):
    w = W.partitionBy("site").orderBy(F.unix_timestamp("t")).rangeBetween(-3 * 3600, 5 * 3600)
    want = gappy.withColumn("s", F.sum("v").over(w))
    got = time_windows(gappy, ["site"], "t", 3 * 3600, 5 * 3600, lambda w: {"s": F.sum("v").over(w.rangeBetween(-3 * 3600, 5 * 3600))}, seconds=8 * 3600)
    assert sorted(map(str, got.select("site", "t", "s").collect())) == sorted(map(str, want.select("site", "t", "s").collect()))
    # a chunk shorter than the reach is lengthened
    got = time_windows(gappy, ["site"], "t", 3 * 3600, 5 * 3600, lambda w: {"s": F.sum("v").over(w.rangeBetween(-3 * 3600, 5 * 3600))}, seconds=10)
    assert sorted(map(str, got.select("site", "t", "s").collect())) == sorted(map(str, want.select("site", "t", "s").collect()))


def test_running_sums_and_fills(gappy):
    w = W.partitionBy("site").orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    b = W.partitionBy("site").orderBy("t").rowsBetween(0, W.unboundedFollowing)
    want = gappy.withColumns({"c": F.coalesce(F.sum("v").over(w), F.lit(0.0)), "f": F.last("v", True).over(w), "g": F.first("v", True).over(b)})
    got = running_sums(gappy, ["site"], "t", {"c": "v"}, seconds=86400)
    got = fill_missing(got.withColumns({"f": F.col("v"), "g": F.col("v")}), ["site"], "t", ["f"], seconds=86400)
    got = fill_missing(got, ["site"], "t", ["g"], forward=False, seconds=86400)
    cols = ["site", "t", "c", "f", "g"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_lags_do_not_leak_between_stations(frame):
    rows = [(1, s, f"2024-01-01 0{h}:00:00", b * (h + 1)) for s, b in (("A", 10.0), ("B", 100.0)) for h in range(4)]
    df = X.persistence(frame(rows, "network bigint, site_name string, obs_time timestamp, h2s double"))
    got = {(r.site_name, r.h2s): r.persistence for r in df.collect()}
    assert got[("A", 10.0)] is None and got[("B", 100.0)] is None and got[("B", 200.0)] == 100.0 and got[("A", 40.0)] == 30.0


def test_splits_and_folds(frame):
    df = frame([(i, f"2024-01-01 {i:02d}:00:00") for i in range(10)], "x int, obs_time timestamp")
    got = {r.x: r.split for r in X.chronological_split(df, 0.75).collect()}
    assert [got[i] for i in range(10)] == ["train"] * 7 + ["test"] * 3
    folds = {r.x: r.fold for r in X.expanding_folds(df, 3).collect()}
    assert [folds[i] for i in range(10)] == [0, 0, 0, 0, 1, 1, 2, 2, 3, 3]
    for bad in (0, 1, 1.5):
        with pytest.raises(ValueError):
            X.chronological_split(df, bad)


def test_through_month_keeps_the_whole_last_day(frame):
    df = frame([("2024-01-31 23:00:00",), ("2024-02-01 00:00:00",)], "obs_time timestamp")
    assert X.through_month(df, "2024-01").count() == 1


def test_latest_keeps_one_row(gappy):
    got = {r.site: r.t for r in latest(gappy, ["site"], ["t"]).collect()}
    want = {r.site: r.t for r in gappy.groupBy("site").agg(F.max("t").alias("t")).collect()}
    assert got == want


def test_nearest_join_matches_pandas(spark):
    rng = np.random.default_rng(5)
    base = pd.Timestamp("2024-03-01")

    def side(n, name):
        secs = rng.choice(4 * 86400, n, replace=False)
        return pd.DataFrame({"site": rng.choice(["a", "b"], n, p=[0.9, 0.1]), name: [base + pd.Timedelta(seconds=int(s)) for s in secs]})

    left, right = side(300, "lt"), side(200, "rt")
    left["id"], right["val"] = range(300), rng.random(200)
    got = nearest_join(spark.createDataFrame(left), spark.createDataFrame(right), ["site"], "lt", "rt", ["val"], 1800, seconds=3600)
    got = {r.id: r.val for r in got.collect()}
    m = pd.merge_asof(left.sort_values("lt"), right.sort_values("rt"), left_on="lt", right_on="rt", by="site", tolerance=pd.Timedelta("30min"), direction="nearest")
    want = {r.id: r.val for r in m.dropna(subset=["val"]).itertuples()}
    assert len(want) > 50 and got == want


def test_nearest_join_tie_goes_to_the_earlier(frame):
    left = frame([("s", "2024-01-01 12:00:00")], "site string, lt timestamp")
    right = frame([("s", "2024-01-01 11:50:00", 1.0), ("s", "2024-01-01 12:10:00", 2.0)], "site string, rt timestamp, val double")
    assert nearest_join(left, right, ["site"], "lt", "rt", ["val"], 1800).first().val == 1.0
    far = frame([("s", "2024-01-01 11:29:59", 1.0)], "site string, rt timestamp, val double")
    assert nearest_join(left, far, ["site"], "lt", "rt", ["val"], 1800).count() == 0


def test_ranks_and_quantiles_match_pandas(spark):
    rng = np.random.default_rng(11)
    n = 3000
    y = np.where(rng.random(n) < 0.35, 0.0, np.round(rng.gamma(1.0, 40.0, n), 1))
    p = np.round(y * 0.5 + rng.normal(0, 20, n), 1)
    pdf = pd.DataFrame({"g": rng.choice(["u", "v"], n), "y": y, "p": p, "hit": (y > 30).astype(int)})
    df = spark.createDataFrame(pdf).repartition(6)
    for r in spearman(df, ["g"], "y", "p").collect():
        part = pdf[pdf.g == r.g]
        assert r.n == len(part) and r.spearman == pytest.approx(part.y.rank().corr(part.p.rank()), abs=1e-12)
    q = {r.g: r for r in quantiles(df, ["g"], "p", {"a": 0.1, "b": 0.5, "c": 0.99}).collect()}
    for g, part in pdf.groupby("g"):
        for name, at in (("a", 0.1), ("b", 0.5), ("c", 0.99)):
            assert q[g][name] == pytest.approx(part.p.quantile(at))
    m = medians(df, [], ["y", "p"]).first()
    assert m.y == pytest.approx(pdf.y.median()) and m.p == pytest.approx(pdf.p.median())
    pos, neg = pdf[pdf.hit == 1].p.to_numpy(), pdf[pdf.hit == 0].p.to_numpy()
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert auc(df, [], "hit", "p").first().auc == pytest.approx(want)


def test_few_pairs_have_no_rank_correlation(frame):
    df = frame([("a", 1.0, 2.0), ("a", 2.0, 1.0)], "g string, y double, p double")
    assert spearman(df, ["g"], "y", "p").first().spearman is None


@pytest.mark.parametrize("size", [10, 5000])
def test_pairing_keeps_values_whatever_the_size(spark, size):
    """Microseconds and repeated names survive; no nested loop."""
    a = spark.range(20).withColumnRenamed("id", "x")
    b = spark.range(size).select(F.timestamp_micros(F.col("id") + 1704067200123456).alias("t"), (F.col("id") % 7).cast("string").alias("name"))
    got = pair_with(a, b, salts=4)
    assert got.count() == 20 * size and got.select("x", "t").distinct().count() == 20 * size
    assert got.agg(F.min(F.unix_micros("t")), F.max(F.unix_micros("t"))).first()[:] == (1704067200123456, 1704067200123455 + size)
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture(scope="module")
def holes(spark):
    """NULL in key, time, tie and value, with repeated times."""
    rng = np.random.default_rng(11)
    t0 = pd.Timestamp("2024-01-01")
    rows = []
    for i in range(300):
        site = [None, "a", "b"][int(rng.integers(0, 3))]
        t = None if rng.random() < 0.2 else (t0 + pd.Timedelta(hours=int(rng.integers(0, 900)))).to_pydatetime()
        rows.append((site, t, None if i % 23 == 0 else i, None if rng.random() < 0.3 else float(rng.integers(0, 9)), float(rng.integers(0, 9))))
    return spark.createDataFrame(rows, "site string, t timestamp, tie int, v double, p double").repartition(4).cache()


def same(a, b, cols):
    return sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def test_missing_keys_times_and_ties_lose_no_row(holes):
    w = W.partitionBy("site").orderBy("t", "tie")
    up = w.rowsBetween(W.unboundedPreceding, 0)
    # rows that agree in key, time and tie have no order, so they are left out of the exact comparison
    once = holes.groupBy("site", "t", "tie").agg(F.count("*").alias("_n"), F.first("v").alias("v"), F.first("p").alias("p")).filter("_n = 1").drop("_n").cache()
    assert number_rows(holes, ["site"], "t", ["tie"], seconds=86400).select("seq", "total", "site").count() == holes.count()
    want = once.withColumns({
        "seq": F.row_number().over(w), "total": F.count("*").over(W.partitionBy("site")), "c": F.coalesce(F.sum("p").over(up), F.lit(0.0)),
        "f": F.last("v", True).over(up), "g": F.first("v", True).over(w.rowsBetween(0, W.unboundedFollowing))})
    got = number_rows(once, ["site"], "t", ["tie"], seconds=86400)
    got = running_sums(got, ["site"], "t", {"c": "p"}, tie=["tie"], seconds=86400)
    got = fill_missing(got.withColumns({"f": F.col("v"), "g": F.col("v")}), ["site"], "t", ["f"], tie=["tie"], seconds=86400)
    got = fill_missing(got, ["site"], "t", ["g"], forward=False, tie=["tie"], seconds=86400)
    assert same(got, want, ["site", "t", "tie", "v", "seq", "total", "c", "f", "g"])


def test_whole_table_numbering_and_splits_keep_rows_without_time(holes):
    for tie in (["tie"], None):
        got = number_rows(holes, [], "t", tie).select("seq", "total").toPandas()
        assert sorted(got.seq) == list(range(1, 301)) and (got.total == 300).all()
    parts = {r.split: r["count"] for r in X.chronological_split(holes, 0.5, time="t", tie=["tie"]).groupBy("split").count().collect()}
    assert parts == {"train": 150, "test": 150}


def test_range_windows_with_missing_times_and_keys(holes):
    w = W.partitionBy("site").orderBy(F.unix_timestamp("t")).rangeBetween(-7200, 0)
    got = time_windows(holes, ["site"], "t", 7200, 0, lambda w: {"s": F.sum("p").over(w.rangeBetween(-7200, 0))})
    assert same(got, holes.withColumn("s", F.sum("p").over(w)), ["site", "t", "tie", "v", "s"])


def test_ranks_with_missing_keys(holes):
    pdf = holes.toPandas()
    got = {r.site: r.m for r in quantiles(holes, ["site"], "v", {"m": 0.5}).collect()}
    assert got == {(None if k != k else k): g.v.median() for k, g in pdf.groupby("site", dropna=False)}
    rho = {r.site: r.n for r in spearman(holes, ["site"], "v", "p").collect()}
    assert rho == {(None if k != k else k): int(g.v.notna().sum()) for k, g in pdf.groupby("site", dropna=False)}
    area = auc(holes.withColumn("hit", (F.col("p") > 4).cast("int")), ["site"], "hit", "v")
    assert {r.site for r in area.collect()} == {None, "a", "b"}


def test_nearest_join_takes_a_missing_key_as_a_key(frame):
    left = frame([(None, "2024-01-01 00:00:00", 1), ("a", None, 2)], "site string, lt timestamp, id int")
    right = frame([(None, "2024-01-01 00:10:00", 5.0), ("a", "2024-01-01 00:10:00", 6.0)], "site string, rt timestamp, v double")
    got = nearest_join(left, right, ["site"], "lt", "rt", ["v"], 10**6).collect()
    assert [(r.id, r.v) for r in got] == [(1, 5.0)]


@pytest.mark.parametrize("tie", [["id"], ["name"], None])
def test_numbering_a_whole_table_with_a_crowded_instant(spark, tie):
    rng = np.random.default_rng(8)
    t = [pd.Timestamp("2024-01-01")] * 400 + [pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=int(m)) for m in rng.integers(0, 9000, 600)]
    pdf = pd.DataFrame({"t": t, "id": rng.permutation(1000) * 500})
    pdf["name"] = pdf.id.map("{:07d}".format)
    got = number_rows(spark.createDataFrame(pdf).repartition(5), [], "t", tie).toPandas().sort_values("seq")
    assert list(got.seq) == list(range(1, 1001)) and (got.total == 1000).all() and got.t.is_monotonic_increasing
    if tie == ["id"]:
        want = pdf.sort_values(["t", "id"]).id.tolist()
        assert got.id.tolist() == want


def test_selected_quantiles_are_exact_and_narrow(spark):
    rng = np.random.default_rng(12)
    parts = {"wide": rng.normal(size=30_000), "hot": np.where(rng.random(9000) < 0.4, 1.5, rng.random(9000) * 3), "two": np.array([1.0, 4.0]), None: rng.random(501), "one": np.array([2.5])}
    rows = [(k, float(v)) for k, x in parts.items() for v in x] + [("wide", None), ("void", None)]
    d = spark.createDataFrame(pd.DataFrame(rows, columns=["k", "v"]).astype({"k": object}), "k string, v double").withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(9)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    for accuracy in (100, 10_000):
        got = {r["k"]: [r[n] for n in probs] for r in selected_quantiles(d, ["k"], "v", probs, accuracy).collect()}
        assert set(got) == set(parts)
        for k, x in parts.items():
            assert np.allclose(got[k], np.quantile(x, list(probs.values()))), (k, accuracy)
    inside = _near_quantiles(d.filter("k = 'wide'"), ["k"], "v", {"c": 0.5}, 1000).count()
    assert inside < 0.02 * 30_000
    plain = quantiles(d, ["k"], "v", {"c": 0.5}).collect()
    assert {r["k"]: round(r["c"], 9) for r in plain} == {k: round(float(np.median(x)), 9) for k, x in parts.items()}
    assert medians(d.withColumn("w", F.col("v") * 2), [], ["v", "w"]).first()["w"] == pytest.approx(2 * np.median(np.concatenate(list(parts.values()))))


def test_nearest_join_reads_each_row_once_per_frame(frame):
    """A frame up to the last row is evaluated anew for every row, which is quadratic in a chunk."""
    left = frame([("a", "2024-01-01 00:10:00")], "site string, lt timestamp")
    right = frame([("a", "2024-01-01 00:00:00", 1.0)], "site string, rt timestamp, val double")
    plan = nearest_join(left, right, ["site"], "lt", "rt", ["val"], 1800)._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
