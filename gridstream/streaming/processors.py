"""Stateful processors for ``transformWithStateInPandas``.

State is per station and small: at most 30 recent readings plus the not-yet
-released ones (W03, in pieces by time), one (start, mean) pair (W05), one (active, lock) pair
(W08); the buffers (D14) hold a fixed number of rows per shard of stations.  All of it lives in the checkpointed state store, so a restart
resumes where it stopped.
"""

from __future__ import annotations

from itertools import groupby
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridstream import config as C

READING = T.StructType([
    T.StructField("ts_us", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("kwh", T.DoubleType()), T.StructField("time_new", T.StringType()),
])
FIELDS = ["ts_us", "seq", "kwh", "time_new"]

ROLLED = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("event_time", T.TimestampType()),
    T.StructField("time_new", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("kwh", T.DoubleType()), T.StructField("rolling_mean_kwh", T.DoubleType()),
    T.StructField("rolling_std_kwh", T.DoubleType()), T.StructField("anomaly_flag", T.IntegerType()),
    T.StructField("original_kwh", T.DoubleType()), T.StructField("corrected_kwh", T.DoubleType()),
])


def snap(x: np.ndarray) -> np.ndarray:
    """Same 1e-9 grid as rules.snap (round half away from zero)."""
    return np.copysign(np.floor(np.abs(x) * 1e9 + 0.5), x) / 1e9


def rolled(recent: pd.DataFrame, ready: pd.DataFrame, rows: int, k: float) -> pd.DataFrame:
    """``ready`` (in order) with mean, deviation and flag of each reading's
    frame: itself and up to ``rows`` readings before it, from ``recent`` on."""
    values = np.concatenate((recent["kwh"].to_numpy(float), ready["kwh"].to_numpy(float)))
    padded = np.concatenate((np.full(rows, np.nan), values))
    frames = np.lib.stride_tricks.sliding_window_view(padded, rows + 1)[len(recent):]
    mean, std = np.nanmean(frames, axis=1), np.nanstd(frames, axis=1)
    own = values[len(recent):]
    flag = (std > 0) & (snap(np.abs(own - mean)) > snap(k * std))
    return ready.assign(rolling_mean_kwh=mean, rolling_std_kwh=std, anomaly_flag=flag.astype("int32"), original_kwh=own,
                        corrected_kwh=np.where(flag, mean, own))


BUCKET_US = 6 * 3600 * 1_000_000       # time that waiting readings of one bucket span
PIECE_ROWS = 50_000                    # readings of one piece in the state, and of one frame of output
PIECE = pa.schema([("ts_us", pa.int64()), ("seq", pa.int64()), ("kwh", pa.float64()), ("time_new", pa.string())])


def packed(readings: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, PIECE) as out:
        out.write(pa.RecordBatch.from_pandas(readings, PIECE, preserve_index=False))
    return sink.getvalue().to_pybytes()


def unpacked(piece: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(piece).read_pandas()


def gathered(frames: Iterator[pd.DataFrame], rows: int = 10 * PIECE_ROWS) -> Iterator[pd.DataFrame]:
    """The frames put together to frames of about ``rows`` rows."""
    held, n = [], 0
    for f in frames:
        held.append(f)
        n += len(f)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def micros(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[us]").astype("int64")


class RollingClean(StatefulProcessor):
    """W03 + F03/F04: ROWS n PRECEDING..CURRENT mean / population std per
    station in event-time order, then the 3-sigma flag and correction.

    Readings wait until the watermark passes them, then leave in (time, seq)
    order against the last n values, so out-of-order input inside the watermark
    gives the batch result.  Waiting readings lie in pieces (Arrow tables) keyed
    by their bucket of time and a running number: a call to the state store costs
    the same for one reading as for thousands, and a release reads and removes
    the buckets that the watermark has reached, one after the other.  One
    event-time timer per station stands at the earliest waiting reading.  Of
    waiting readings with one (time, seq) the last one stays.  Readings behind
    the watermark are not used (the engine doesn't filter this operator's input):
    they leave at once with the flag LATE, so that a sink can count them.
    """

    def __init__(self, rows: int = C.ROLLING_PRECEDING_ROWS, k: float = C.SIGMA_K):
        self.rows, self.k = int(rows), float(k)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", READING)
        self.pending = handle.getMapState("pending", T.StructType([T.StructField("bucket", T.LongType()), T.StructField("piece", T.LongType())]),
                                          T.StructType([T.StructField("readings", T.BinaryType())]))
        self.pieces = handle.getValueState("pieces", T.StructType([T.StructField("n", T.LongType())]))
        # the one registered timer (ms): the earliest unreleased reading + 1
        self.timer = handle.getValueState("timer", T.StructType([T.StructField("ms", T.LongType())]))

    def _arm(self, earliest_us: int) -> None:
        at = earliest_us // 1000 + 1
        cur = self.timer.get()[0] if self.timer.exists() else None
        if cur is None or at < cur:
            if cur is not None:
                self.handle.deleteTimer(cur)
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def _wait(self, readings: pd.DataFrame) -> None:
        n = self.pieces.get()[0] if self.pieces.exists() else 0
        for bucket, own in readings.groupby(readings["ts_us"] // BUCKET_US):
            for i in range(0, len(own), PIECE_ROWS):
                self.pending.updateValue((int(bucket), n), (packed(own.iloc[i:i + PIECE_ROWS]),))
                n += 1
        self.pieces.update((n,))
        self._arm(int(readings["ts_us"].min()))

    def _waiting(self, keys) -> pd.DataFrame:
        return pd.concat([unpacked(self.pending.getValue(k)[0]) for k in keys], ignore_index=True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        for pdf in gathered(rows):
            d = pdf.assign(ts_us=micros(pdf["event_time"]), kwh=pdf["kwh"].astype(float))
            on_time = (d["ts_us"] >= wm_us) if wm_us > 0 else pd.Series(True, index=d.index)
            if on_time.any():
                self._wait(d.loc[on_time, FIELDS])
            late = d[~on_time]
            if len(late):                       # out at once, marked, so that sinks can count them
                yield self._out(key, late.assign(rolling_mean_kwh=np.nan, rolling_std_kwh=np.nan, anomaly_flag=np.int32(LATE),
                                                 original_kwh=late["kwh"], corrected_kwh=late["kwh"]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        recent = pd.DataFrame(sorted(map(tuple, self.recent.get())) if self.recent.exists() else [], columns=FIELDS)
        released = False
        for bucket, own in groupby(sorted(tuple(k) for k in self.pending.keys()), key=lambda k: k[0]):
            own = list(own)
            d = self._waiting(own)
            due = d["ts_us"] < wm_us
            if not due.any():
                self._arm(int(d["ts_us"].min()))
                break
            for k in own:
                self.pending.removeKey(k)
            if not due.all():
                self._wait(d[~due])
            ready = d[due].drop_duplicates(["ts_us", "seq"], keep="last").sort_values(["ts_us", "seq"])
            for i in range(0, len(ready), PIECE_ROWS):
                some = ready.iloc[i:i + PIECE_ROWS]
                yield self._out(key, rolled(recent, some, self.rows, self.k))
                recent = (pd.concat([recent, some]) if len(recent) else some).tail(self.rows)
            released = True
            if not due.all():
                break
        if released:
            self.recent.put([(int(t), int(s), float(v), x) for t, s, v, x in recent.itertuples(index=False, name=None)])

    @staticmethod
    def _out(key, d: pd.DataFrame) -> pd.DataFrame:
        d = d.assign(station_id=key[0], event_time=pd.to_datetime(d["ts_us"].astype("int64"), unit="us"))
        return d[[f.name for f in ROLLED.fields]]

    def close(self) -> None:
        pass


LATE = -1       # anomaly_flag of a reading that came behind the watermark

PREV = T.StructType([T.StructField("start_us", T.LongType()), T.StructField("mean", T.DoubleType())])


class PreviousWindow(StatefulProcessor):
    """W05 + F09-F11: rate of change against the station's window exactly one
    width earlier (else 0); keeps one (start, mean) pair per station."""

    def __init__(self, window_minutes: int = C.WINDOW_MINUTES):
        self.width_us = int(window_minutes) * 60 * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", PREV)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.sort_values("window_start", kind="stable")
        starts = pdf["window_start"].astype("datetime64[us]").astype("int64").tolist()
        means = pdf["mean_kwh"].tolist()
        prev = self.last.get() if self.last.exists() else None
        rates = []
        for st, m in zip(starts, means):
            hit = prev is not None and prev[0] == st - self.width_us
            rates.append(m - prev[1] if hit else 0.0)
            prev = (st, m)
        self.last.update(prev)
        pdf = pdf.assign(rate_of_change=rates)
        yield pdf

    def close(self) -> None:
        pass


SESSION = T.StructType([T.StructField("active", T.BooleanType()), T.StructField("lock", T.DoubleType())])


class SessionLock(StatefulProcessor):
    """W08 + P07: per-station session lock in window order.  The price a
    session would lock and the idle price are columns (``lock_offer``,
    ``idle_price``) from the batch rules; the state carries the lock only."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("session", SESSION)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("window_start", kind="stable")
        was_active, lock = self.state.get() if self.state.exists() else (False, None)
        active = (pdf["capacity_utilization_ratio"] > 0).to_numpy(bool)
        before = np.concatenate(([bool(was_active)], active[:-1]))
        started = active & ~before
        offers = pd.Series(np.where(started, pdf["lock_offer"].to_numpy(float), np.nan)).ffill()
        locked = offers.fillna(np.nan if lock is None else lock).to_numpy(float)
        self.state.update((bool(active[-1]), float(locked[-1]) if active[-1] else None))
        yield pdf.drop(columns=["lock_offer", "idle_price"]).assign(
            guaranteed_price_cad=np.where(active, locked, pdf["idle_price"].to_numpy(float)),
            session_status=np.where(started, "session_started", np.where(active, "session_ongoing", "idle")))

    def close(self) -> None:
        pass


class RecentRows(StatefulProcessor):
    """The newest ``keep`` rows of a shard, by ``order`` descending.  A batch's
    rows enter, the oldest beyond ``keep`` are evicted, and the shard leaves as a
    whole.  With ``ttl_ms`` rows that no batch touched for so long expire too."""

    def __init__(self, schema: T.StructType, keep: int, order: list[str], ttl_ms: int | None = None):
        self.schema, self.keep, self.order, self.ttl_ms = schema, int(keep), list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [f.name for f in self.schema.fields]
        best = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        at = [names.index(c) for c in self.order]
        for pdf in rows:
            least = best[-1][at[0]] if best and len(best) == self.keep else None
            if least is not None:                 # what lies below the last row held doesn't enter
                pdf = pdf[pdf[self.order[0]].notna()]
                pdf = pdf[pdf[self.order[0]] >= least]
            new = pdf[names].astype(object).where(pdf[names].notna(), None).itertuples(index=False, name=None)
            best = sorted((*best, *new), key=lambda r: tuple((r[i] is not None, r[i]) for i in at), reverse=True)[:self.keep]
        self.rows.put(best)
        yield pd.DataFrame(best, columns=names).assign(shard=np.int32(key[0]))[["shard", *names]]

    def close(self) -> None:
        pass
