"""Stateful processors: exceedance events and tier message debouncing.

Rows wait in state until the watermark passes them and are then handled in time
order, so the result does not depend on the order of arrival within the delay.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from airq import catalog as C
from airq.operators.alerts import TIERS, exceedances

HOUR_US = 3_600_000_000
EVENT_SCHEMA = "network bigint, site_name string, tier string, trigger string, event_start timestamp, last_exceedance timestamp"


class WaitingRows(StatefulProcessor):
    """Keeps rows until the watermark passes them, with one timer per key and batch.

    A key's memory, its waiting rows while they are few, and the times of its parts lie in one value, read and
    written once per call: a call to the state costs more than the rows of most keys. Where more rows wait, they
    lie in parts of a map state, keyed by the time of a part's first row. Whatever timer fires, the
    keys tell which parts have begun before the watermark; only those are read, all rows due are
    handled in time order, and what such parts hold beyond the watermark goes back as one part. So a timer
    costs as much as the rows it handles and those of the parts that it cuts, however many wait behind. One timer
    is set for the earliest row or part that is left. A time to live can't be set in event time;
    a key whose rows are handled keeps its memory alone.
    """

    #: Rows of a part at least and beside the memory at most, parts of one key's rows of a batch at most.
    LEAST, PARTS = 64, 16

    def init(self, handle):
        self.handle = handle
        self.pending = handle.getMapState("pending", "t bigint, part bigint", "rows string")
        self.held = handle.getValueState("held", "body string")

    def load(self):
        """A key's memory, rows beside it, parts and the number of the last one."""
        value = self.held.get()
        return json.loads(value[0]) if value else {"memory": None, "few": [], "parts": [], "last": 0}

    def keep(self, held, rows):
        """Puts rows in time order away: beside the memory while all are few, else in parts."""
        if len(held["few"]) + len(rows) <= self.LEAST:
            held["few"] += rows
            return
        size = max(self.LEAST, -(-len(rows) // self.PARTS))
        for k in range(0, len(rows), size):
            held["last"] += 1
            held["parts"].append((rows[k][0], held["last"]))
            self.pending.updateValue(held["parts"][-1], (json.dumps(rows[k : k + size]),))

    def handleInputRows(self, key, rows, timerValues):
        fresh = []
        for pdf in rows:
            fresh += list(zip((int(t) for t in pdf["t"]), pdf["body"]))
        if fresh:
            fresh.sort()
            held = self.load()
            self.keep(held, fresh)
            self.held.update((json.dumps(held),))
            self.handle.registerTimer(fresh[0][0] // 1000 + 1)
        return iter(())

    def take(self, held, now):
        """(rows before ``now`` in time order, time of the earliest row or part that is left)."""
        waiting, behind = held["few"], []
        for k in map(tuple, held["parts"]):
            if k[0] < now:
                waiting += json.loads(self.pending.getValue(k)[0])
                self.pending.removeKey(k)
            else:
                behind.append(k)
        waiting = sorted((int(t), body) for t, body in waiting)
        due = [r for r in waiting if r[0] < now]
        later = waiting[len(due):]
        held.update(few=[], parts=behind)
        if later:
            self.keep(held, later)
        first = [t for t, _ in behind] + [t for t, _ in later[:1]]
        return due, min(first, default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = self.load()
        due, left = self.take(held, now)
        if held["memory"] is None:
            held["memory"] = self.start()
        out, wake = self.advance(held["memory"], due, now)
        self.held.update((json.dumps(held),))
        if left is not None:
            wake = min(wake, left // 1000 + 1) if wake is not None else left // 1000 + 1
        if wake is not None:
            self.handle.registerTimer(wake)
        if out:
            yield self.frame(key, out)

    def close(self):
        pass


class ExceedanceMachine(WaitingRows):
    """Onset and summary of events of one (station, tier); its input holds exceedances only."""

    def __init__(self, quiet_h: float = C.QUIET_HOURS, close_h: float = C.CLOSE_WAIT_HOURS):
        self.quiet, self.close_after = int(quiet_h * HOUR_US), int(close_h * HOUR_US)

    def start(self):
        return {"open": False, "first": 0, "last": 0, "seen": None}

    def advance(self, m, due, now):
        out = []
        for t, _ in due:
            if m["open"] and t - m["last"] > self.close_after:
                out.append(("summary", m["first"], m["last"]))
                m["open"] = False
            if m["open"]:
                m["last"] = t
            elif m["seen"] is None or t - m["seen"] > self.quiet:
                m.update(open=True, first=t, last=t)
                out.append(("onset", t, t))
            m["seen"] = t
        if not m["open"]:
            return out, None
        end = m["last"] + self.close_after
        if end <= now:
            out.append(("summary", m["first"], m["last"]))
            m["open"] = False
            return out, None
        return out, math.ceil(end / 1000)

    def frame(self, key, out):
        network, site, tier = key
        return pd.DataFrame({
            "network": network, "site_name": site, "tier": tier, "trigger": [o[0] for o in out],
            "event_start": pd.to_datetime([o[1] for o in out], unit="us"), "last_exceedance": pd.to_datetime([o[2] for o in out], unit="us"),
        })


def event_stream(readings: DataFrame, time: str = "time", h2s: str = "h2s_ppb", delay: str = "2 hours", tiers=TIERS) -> DataFrame:
    """Onset and summary rows of a reading stream keyed by (network, site, tier)."""
    up = exceedances(readings.withWatermark(time, delay), h2s, tiers)
    rows = up.select("network", "site_name", "tier", time, F.unix_micros(time).alias("t"), F.lit("").alias("body"))
    return rows.groupBy("network", "site_name", "tier").transformWithStateInPandas(
        ExceedanceMachine(), EVENT_SCHEMA, outputMode="Append", timeMode="EventTime")


MESSAGE_SCHEMA = "network bigint, evaluated_at timestamp, tier string, horizons string, n_onsets int, sent boolean, reason string"


class TierMachine(WaitingRows):
    """Debounced messages of one network: its tier x horizon cells live in one state, so
    the higher-tier check needs no other key.

    All cells of a cycle are updated before its messages are decided; a message counts
    against the quiet time only once it is sent.
    """

    def __init__(self, quiet_h: float = C.QUIET_HOURS, clears: int = 3, clear_below: float = 0.3):
        self.quiet, self.clears, self.clear_below = int(quiet_h * HOUR_US), clears, clear_below

    def start(self):
        return {"cells": {}, "sent": {}}

    def advance(self, m, due, now):
        out = []
        for t, body in due:
            out += self.cycle(m, t, [c.split("|") for c in body.split(";")])
        return out, None

    def cycle(self, m, t, rows):
        cells, sent, onsets = m["cells"], m["sent"], {}
        for tier, horizon, fired, score in rows:
            c = cells.setdefault(f"{tier}/{horizon}", {"active": False, "fired": None, "clear": 0, "fires": 0})
            if fired == "true":
                if not c["active"] or c["fired"] is None or t - c["fired"] >= self.quiet:
                    onsets.setdefault(tier, []).append(horizon)
                c.update(active=True, fired=t, clear=0, fires=c["fires"] + 1)
            elif float(score) < self.clear_below and c["active"]:
                c["clear"] += 1
                c["active"] = c["clear"] < self.clears
        out = []
        for tier, horizons in sorted(onsets.items()):
            if tier in sent and t - sent[tier] < self.quiet:
                out.append((t, tier, horizons, False, "sent recently"))
            elif all(self.higher(cells, tier, h) for h in horizons):
                out.append((t, tier, horizons, False, "higher tier active"))
            else:
                sent[tier] = t
                out.append((t, tier, horizons, True, ""))
        return out

    @staticmethod
    def higher(cells, tier, horizon):
        return any(o > tier and cells.get(f"{o}/{horizon}", {}).get("active", False) for o, _ in C.TIER_PPB)

    def frame(self, key, out):
        return pd.DataFrame({
            "network": key[0], "evaluated_at": pd.to_datetime([o[0] for o in out], unit="us"), "tier": [o[1] for o in out],
            "horizons": [",".join(o[2]) for o in out], "n_onsets": pd.Series([len(o[2]) for o in out], dtype="int32"),
            "sent": [o[3] for o in out], "reason": [o[4] for o in out],
        })


def cycle_rows(records: DataFrame) -> DataFrame:
    """Backtest records as one row per network and cycle; a cycle has at most tiers x
    horizons cells."""
    cell = F.concat_ws("|", "tier", "horizon", F.col("fired").cast("string"), F.col("score").cast("string"))
    return records.groupBy("network", "evaluated_at").agg(F.concat_ws(";", F.array_sort(F.collect_list(cell))).alias("cells"))


def tier_message_stream(cycles: DataFrame, delay: str = "2 hours") -> DataFrame:
    rows = cycles.withWatermark("evaluated_at", delay).select("network", "evaluated_at", F.unix_micros("evaluated_at").alias("t"), F.col("cells").alias("body"))
    return rows.groupBy("network").transformWithStateInPandas(TierMachine(), MESSAGE_SCHEMA, outputMode="Append", timeMode="EventTime")
