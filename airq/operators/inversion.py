"""Event selection and weekly emission inversion."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq import catalog as C
from airq.functions import plume as P
from airq.operators.dims import as_array, pair_with
from airq.operators.dispersion import look_back_hours
from airq.operators.ordering import number_rows, time_windows
from airq.operators.ranks import medians
from airq.session import materialize


def event_times(df: DataFrame, keys: list[str], threshold: float = 30.0, require_stable: bool = True,
                top: int | None = None, h2s: str = "h2s", time: str = "obs_time") -> DataFrame:
    """Distinct hours of a network at or above ``threshold`` (in stable air), newest first.

    ``top`` keeps the newest per key (all by default); the rank filter is applied before the shuffle
    as well, so no task holds more than its own newest hours.
    """
    hits = df.filter((F.col(h2s) >= threshold) & ((F.col("stable_atm") == 1) if require_stable else F.lit(True)))
    times = hits.select(*keys, time).distinct()
    ranked = times.withColumn("newest", F.row_number().over(W.partitionBy(*keys).orderBy(F.col(time).desc())))
    return ranked.filter(F.col("newest") <= top) if top else ranked


def event_sensors(obs: DataFrame, events: DataFrame, stations: DataFrame, group: list[str], hours_back: int = 4, background: float = 1.0,
                  order: list[str] | None = None, time: str = "obs_time", h2s: str = "h2s") -> DataFrame:
    """Sensors that take part in each event: a reading above background and at least two
    met rows in the look-back.

    Each row carries its concentration above background (``c_bg``), the mean wind of
    its look-back with the adaptive look-back hours, and the event's met row, which is
    that of the first taking-part sensor in ``order``.
    """
    order = order or [C.PRIMARY_STATION, C.BACKUP_STATION, "SAN YSIDRO"]
    frame = time_windows(obs.withColumn("_one", F.lit(1)), [*group, "site_name"], time, hours_back * 3600, 0, lambda w: {
        "n_met": F.count("_one").over(w.rangeBetween(-hours_back * 3600, 0)),
        "mean_wind": F.avg("wind_speed_10m").over(w.rangeBetween(-hours_back * 3600, 0)),
    }).drop("_one")
    rows = frame.filter((F.col("n_met") >= 2) & (F.col(h2s) >= background)).join(events.select(*group, time), [*group, time], "left_semi")
    met = F.struct(*[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in (
        ("wind_speed_10m", 1.0), ("wind_direction_10m", 180.0), ("temperature_2m", 18.0), ("is_night", 1))])
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("site_name"))
    first = rows.groupBy(*group, time).agg(F.min(F.struct(rank.alias("r"), met.alias("m")))["m"].alias("_m"))
    kept = rows.filter(F.col(h2s) > background).select(
        *group, time, "site_name", F.col(h2s).alias("c_obs"), (F.col(h2s) - background).alias("c_bg"), "n_met", "mean_wind",
        look_back_hours(F.coalesce("mean_wind", F.lit(1.0))).alias("hours_back"))
    return kept.join(first, [*group, time]).select("*", "_m.*").drop("_m").join(stations, "site_name")


def sensitivities(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Add ``a``: ppb at the sensor per 1 g/s at each segment, in segment order.

    The segments are one side of the system to solve; they reach each row as one array.
    """
    wind = P.with_wind_terms(pair_with(rows, as_array(segments.select("segment", "source_lat", "source_lon"), "_seg")))
    ug = P.plume_array(F.col("_seg"), F.col("station_lat"), F.col("station_lon"))
    factor = P.to_ppb(F.lit(1.0), F.col("temperature_2m"))
    return wind.withColumn("_f", factor).withColumn("a", F.transform(ug, lambda x: x * F.col("_f"))).drop(
        "_f", "_seg", "_u", "_v", "_ws", "_ay", "_az", "_stab")


def geometry_check(rows: DataFrame, group: list[str], limit: float = 500.0, time: str = "obs_time") -> DataFrame:
    """Per event: strongest sensitivity, peak above background, the rate it would take,
    and whether the event is skipped as out of the model's reach."""
    ev = rows.groupBy(*group, time).agg(
        F.max(F.array_max("a")).alias("max_a"), F.max("c_bg").alias("max_obs"), F.count(F.lit(1)).alias("n_sensors"))
    need = F.col("max_obs") / F.col("max_a")
    return ev.filter(F.col("max_a") >= 1e-6).withColumn("q_required", need).withColumn("skipped", need > limit)


def usable_rows(rows: DataFrame, checked: DataFrame, group: list[str], time: str = "obs_time") -> DataFrame:
    ok = checked.filter("NOT skipped").select(*group, time)
    return rows.join(ok, [*group, time], "left_semi").withColumn("week", F.to_date(F.date_trunc("week", time)))


def sensitivity_summary(checked: DataFrame, keys: list[str]) -> DataFrame:
    """Median and maximum of the per-event diagnostics, counts of events out of reach."""
    base = checked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("max_a").alias("max_a_max"), F.max("max_obs").alias("peak_obs_max"),
        F.max("q_required").alias("q_required_max"), F.sum((F.col("q_required") > 500).cast("int")).alias("n_needing_gt_500"),
        F.sum(F.col("skipped").cast("int")).alias("n_skipped"))
    return base.join(medians(checked, keys, ["max_a", "q_required"]).withColumnsRenamed(
        {"max_a": "max_a_p50", "q_required": "q_required_p50"}), keys) if keys else base


def normal_equations(rows: DataFrame, keys: list[str], n_segments: int) -> DataFrame:
    """(keys, j, k, v, m): entries of A'A for k >= j, of A'c at k = -1 (``v`` summed)
    and column maxima at k = -2 (``m``).

    Each task folds its rows into one small matrix per key before anything is
    shuffled, so the exchange carries matrices, not row pairs; it holds one matrix at a time.
    """
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    ddl = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", j int, k int, v double, m double"
    ju, ku = np.triu_indices(n_segments)

    def entries(key, g, r, mx):
        out = pd.DataFrame({
            "j": np.concatenate([ju, np.arange(n_segments), np.arange(n_segments)]).astype("int32"),
            "k": np.concatenate([ku, np.full(n_segments, -1), np.full(n_segments, -2)]).astype("int32"),
            "v": np.concatenate([g[ju, ku], r, np.zeros(n_segments)]),
            "m": np.concatenate([np.zeros(len(ju) + n_segments), mx]),
        })
        for name, v in zip(keys, key if isinstance(key, tuple) else (key,)):
            out.insert(0, name, pd.Series([None if pd.isna(v) else v] * len(out), dtype=object))
        return out[[*keys, "j", "k", "v", "m"]]

    def fold(batches):
        # rows come sorted by key: a task holds one matrix and gives it out when the key changes
        have = None
        for pdf in batches:
            for key, g in pdf.groupby(keys, sort=False, dropna=False):
                a = np.vstack(g["a"].to_numpy())
                c = g["c_bg"].to_numpy(dtype=float)
                part = (a.T @ a, a.T @ c, a.max(axis=0))
                if have is not None and have[0] == key:
                    have = (key, have[1] + part[0], have[2] + part[1], np.maximum(have[3], part[2]))
                else:
                    if have is not None:
                        yield entries(*have)
                    have = (key, *part)
        if have is not None:
            yield entries(*have)

    parts = rows.select(*keys, "a", "c_bg").sortWithinPartitions(*keys).mapInPandas(fold, ddl)
    return parts.groupBy(*keys, "j", "k").agg(F.sum("v").alias("v"), F.max("m").alias("m"))


def nonnegative_solve(h: np.ndarray, r: np.ndarray, tol: float = 1e-10, sweeps: int = 20000) -> np.ndarray:
    """Minimise q'Hq/2 - r'q over q >= 0 by cyclic coordinate descent; H is positive definite."""
    q = np.zeros(len(r))
    grad = -r.copy()
    diag = np.diag(h)
    scale = max(1.0, float(np.abs(r).max(initial=0.0)))
    for _ in range(sweeps):
        for j in range(len(r)):
            new = max(0.0, q[j] - grad[j] / diag[j])
            if new != q[j]:
                grad += h[:, j] * (new - q[j])
                q[j] = new
        worst = np.where(q > 0, np.abs(grad), np.maximum(-grad, 0.0)).max(initial=0.0)
        if worst <= tol * scale:
            break
    return q


def solve_weeks(normal: DataFrame, keys: list[str], n_segments: int, ridge: float = 0.3, smooth: float = 0.0) -> DataFrame:
    """(keys, segment, rate): non-negative ridge solution per key on column-scaled
    equations.  A group is one matrix of the bounded segment table, whatever the rows."""
    types = {f.name: f.dataType.simpleString() for f in normal.schema.fields}
    ddl = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", segment int, rate double, kkt double"

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        j, k, v = pdf["j"].to_numpy(), pdf["k"].to_numpy(), pdf["v"].to_numpy()
        g, r, top = np.zeros((n_segments, n_segments)), np.zeros(n_segments), np.zeros(n_segments)
        up = k >= 0
        g[j[up], k[up]] = v[up]
        g = np.triu(g) + np.triu(g, 1).T
        r[j[k == -1]] = v[k == -1]
        top[j[k == -2]] = pdf["m"].to_numpy()[k == -2]
        s = np.maximum(top, 1e-8)
        h = g / np.outer(s, s) + ridge * ridge * np.eye(n_segments)
        if smooth > 0 and n_segments > 1:
            d = np.diff(np.eye(n_segments), axis=0)
            h += smooth * smooth * d.T @ d
        q = nonnegative_solve(h, r / s)
        grad = h @ q - r / s
        kkt = np.where(q > 0, np.abs(grad), np.maximum(-grad, 0.0)).max(initial=0.0)
        out = pd.DataFrame({"segment": np.arange(n_segments, dtype="int32"), "rate": q / s, "kkt": kkt})
        for name in reversed(keys):
            v = pdf[name].iloc[0]
            out.insert(0, name, pd.Series([None if pd.isna(v) else v] * len(out), dtype=object))
        return out

    return normal.groupBy(*keys).applyInPandas(solve, ddl)


def q_field(solved: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Rates with positions, their share of the total and the active flag."""
    w = W.partitionBy(*keys)
    total = F.sum("rate").over(w)
    d = solved.join(segments, "segment")
    return d.withColumns({
        "fraction": F.when(total > 0, F.col("rate") / total).otherwise(0.0),
        "active": F.col("rate") > F.greatest(total * 0.01, F.lit(0.5)),
    })


def sources_above(field: DataFrame, keys: list[str], min_fraction: float = 0.05) -> DataFrame:
    """Segments that hold at least ``min_fraction`` of the total rate."""
    total = F.sum("rate").over(W.partitionBy(*(keys or [F.lit(0)])))
    return field.withColumn("fraction", F.col("rate") / total).filter(F.col("fraction") >= min_fraction)


def predict_rows(rows: DataFrame, solved: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``c_pred``: the rates of each key applied to its rows."""
    q = solved.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("segment", "rate"))), lambda x: x["rate"]).alias("_q"))
    dot = F.aggregate(F.zip_with("a", "_q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return rows.join(q, keys).withColumn("c_pred", dot).drop("_q")


def residual_scores(pred: DataFrame, keys: list[str]) -> DataFrame:
    e = F.col("c_bg") - F.col("c_pred")
    d = pred.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"),
                                F.stddev_pop("c_bg").alias("c_obs_std"))
    return d.withColumn("rmse_over_std", F.when(F.col("c_obs_std") > 0, F.col("rmse") / F.col("c_obs_std")))


def with_time_folds(rows: DataFrame, group: list[str], time: str = "obs_time") -> DataFrame:
    """Add ``fold``: the events of a week in hash order cut into k equal parts,
    k between 2 and 5 by a third of the number of events."""
    events = rows.select("week", *group, time).distinct().withColumn("_h", F.xxhash64(*group, F.col(time).cast("string")))
    numbered = number_rows(events, ["week"], "_h", [*group, time], block=F.floor(F.col("_h") / F.lit(float(2**53))))
    k = F.greatest(F.lit(2), F.least(F.lit(5), F.floor(F.col("total") / 3)))
    folds = numbered.withColumn("fold", F.floor((F.col("seq") - 1) * k / F.col("total"))).drop("_h", "seq", "total")
    return rows.join(folds, ["week", *group, time])


def others_matrices(parts: DataFrame, keys: list[str], hold: str) -> DataFrame:
    """(keys, held_out, j, k, v, m): for each value of ``hold`` the sum and maximum of all other values' matrices.

    Sums of the values before and of those after are added: the work grows with the number of values and not
    with its square, and nothing is subtracted, so no digits are lost. A key with a single value has none.
    """
    w = W.partitionBy(*keys, "j", "k")
    before = w.orderBy(F.col(hold).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    after = w.orderBy(F.col(hold).desc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    both = parts.withColumns({"_v0": F.sum("v").over(before), "_m0": F.max("m").over(before), "_v1": F.sum("v").over(after), "_m1": F.max("m").over(after)})
    zero = F.lit(0.0)
    train = both.filter("_v0 IS NOT NULL OR _v1 IS NOT NULL").withColumns({
        "v": F.coalesce("_v0", zero) + F.coalesce("_v1", zero), "m": F.greatest(F.coalesce("_m0", zero), F.coalesce("_m1", zero))})
    return train.select(*keys, F.col(hold).alias("held_out"), "j", "k", "v", "m")


def held_out_predictions(rows: DataFrame, hold: str, n_segments: int, keys: list[str] | None = None, ridge: float = 0.3) -> DataFrame:
    """Rows with ``held_out`` and ``c_pred``: each row under rates solved without its own value of ``hold``.

    Matrices are built once per (key, hold), so the rows are never copied per fold.
    """
    keys = keys or ["week"]
    rows = materialize(rows, "inversion-rows")
    train = others_matrices(normal_equations(rows, [*keys, hold], n_segments), keys, hold)
    solved = solve_weeks(train, [*keys, "held_out"], n_segments, ridge)
    return predict_rows(rows.withColumn("held_out", F.col(hold)), solved, [*keys, "held_out"])


def cross_validate(rows: DataFrame, hold: str, n_segments: int, keys: list[str] | None = None, ridge: float = 0.3) -> DataFrame:
    """Scores on each held-out value of ``hold`` with rates from all other rows of the key."""
    keys = keys or ["week"]
    return residual_scores(held_out_predictions(rows, hold, n_segments, keys, ridge), [*keys, "held_out"])


def fold_report(pred: DataFrame, keys: list[str], sensor: str = "site_name") -> DataFrame:
    """Scores per held-out value, per sensor and overall: (keys, scope, part, n_test, rmse, bias, c_obs_std, rmse_over_std)."""
    scopes = F.array(F.struct(F.lit("held_out").alias("scope"), F.col("held_out").cast("string").alias("part")),
                     F.struct(F.lit("sensor").alias("scope"), F.col(sensor).cast("string").alias("part")),
                     F.struct(F.lit("overall").alias("scope"), F.lit("all").alias("part")))
    return residual_scores(pred.select(*keys, F.inline(scopes), "c_bg", "c_pred"), [*keys, "scope", "part"])


def rolling_window(rows: DataFrame, days: float, end=None, time: str = "obs_time") -> DataFrame:
    """Rows of the ``days`` up to ``end`` (by default the newest time of the table), both ends included."""
    last = F.lit(end).cast("timestamp") if end is not None else rows.agg(F.max(time)).scalar()
    return rows.filter((F.col(time) <= last) & (F.col(time) >= last - F.make_dt_interval(secs=F.lit(days * 86400).cast("decimal(18,6)"))))


def cv_gates(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: do all held-out parts stay below one deviation in RMSE and 10 ppb in bias."""
    ok = F.coalesce((F.col("rmse_over_std") < 1.0) & (F.abs("bias") < 10.0), F.lit(False))
    return scores.groupBy(*keys).agg(F.bool_and(ok).alias("cv_pass"), F.sum("n_test").alias("n_test"))


def budget_gate(field: DataFrame, keys: list[str], low: float = 30.0, high: float = 500.0) -> DataFrame:
    d = field.groupBy(*keys).agg(F.sum("rate").alias("total_rate"))
    return d.withColumn("budget_pass", F.col("total_rate").between(low, high))
