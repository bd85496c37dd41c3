"""Stream equals batch on in-order input; state survives a restart."""

import tempfile

import pytest
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.operators import features as FE
from gridstream.operators import pricing as PR
from gridstream.sources import messages as MS
from gridstream.sources.telemetry import PROFILE_A, PROFILE_B, load_telemetry
from gridstream.streaming import queries as SQ
from gridstream.streaming.starting import STREAM_CONF, session_conf, start
from gridstream.streaming.state import state_of

from conftest import SF_SMALL

COLS = ["station_id", "time_new", "duration", "kwh", "seq"]


def _tmp(prefix):
    return tempfile.mkdtemp(prefix=prefix, dir="/tmp")


@pytest.fixture(scope="module")
def source_parts(spark):
    """Telemetry of profile A as JSON lines, one folder per 8-day slice."""
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A)
    tel = tel.withColumn("part", (F.unix_seconds("event_time") / 86400 / 8).cast("int"))
    parts = sorted(r[0] for r in tel.select("part").distinct().collect())
    root = _tmp("gs-src-")
    for p in parts:
        (MS.encode(tel.filter(F.col("part") == p).select(*COLS), "ev-telemetry").select("value")
           .coalesce(1).write.text(f"{root}/p{p}"))
    return root, parts


def _run(spark, df, out, ck):
    q = start(spark, df.writeStream.format("parquet").option("checkpointLocation", ck).option("path", out)
              .outputMode("append").trigger(availableNow=True))
    q.awaitTermination(900)
    assert q.exception() is None


def _batch_features(spark):
    return FE.stream_features(load_telemetry(spark, SF_SMALL, PROFILE_A), PROFILE_A.window_minutes,
                              PROFILE_A.capacity)


def _compare(res, b):
    j = res.alias("s").join(b.alias("b"), ["station_id", "time_bin"])
    assert j.count() == res.count()
    bad = j.filter((F.abs(F.col("s.mean_kwh") - F.col("b.mean_kwh")) > 1e-9)
                   | (F.abs(F.col("s.variance_kwh") - F.col("b.variance_kwh")) > 1e-9)
                   | (F.abs(F.col("s.rate_of_change") - F.col("b.rate_of_change")) > 1e-9)
                   | (F.col("s.anomaly_flag") != F.col("b.anomaly_flag"))
                   | (F.abs(F.col("s.data_completeness") - F.col("b.data_completeness")) > 1e-12))
    assert bad.count() == 0


def test_stream_features_equal_batch(spark, source_parts):
    root, _ = source_parts
    out, ck = _tmp("gs-out-"), _tmp("gs-ck-")
    stream = SQ.decode_telemetry(SQ.message_stream(spark, path=f"{root}/*", max_files=1))
    _run(spark, SQ.features_stream(stream, PROFILE_A.window_minutes, PROFILE_A.capacity), out, ck)
    res = spark.read.parquet(out)
    b = _batch_features(spark)
    # every closed window is emitted once; only each station's open last window is missing
    assert b.count() - res.count() <= 15 and res.count() > 0.95 * b.count()
    assert res.select("station_id", "time_bin").distinct().count() == res.count()
    _compare(res, b)


def test_stream_restart_resumes_state(spark, source_parts):
    root, parts = source_parts
    live = _tmp("gs-live-")
    out, ck = _tmp("gs-out-"), _tmp("gs-ck-")
    import shutil
    half = len(parts) // 2
    for p in parts[:half]:
        shutil.copytree(f"{root}/p{p}", f"{live}/p{p}")

    def build():
        s = SQ.decode_telemetry(SQ.message_stream(spark, path=f"{live}/*", max_files=1))
        return SQ.features_stream(s, PROFILE_A.window_minutes, PROFILE_A.capacity)

    _run(spark, build(), out, ck)
    first = spark.read.parquet(out).count()
    for p in parts[half:]:
        shutil.copytree(f"{root}/p{p}", f"{live}/p{p}")
    _run(spark, build(), out, ck)            # restart from the checkpoint
    # what the restarted query holds: at most 30 recent readings of a station, its last window
    recent = state_of(spark, ck, "recent").groupBy("station_id").count().collect()
    assert len(recent) == 15 and all(r["count"] <= C.ROLLING_PRECEDING_ROWS for r in recent)
    last = {r.station_id: r.mean for r in state_of(spark, ck, "last").collect()}
    newest = spark.read.parquet(out).groupBy("station_id").agg(F.max_by("mean_kwh", "window_start").alias("m")).collect()
    assert last == {r.station_id: r.m for r in newest}
    res = spark.read.parquet(out)
    assert res.count() > first
    assert res.select("station_id", "time_bin").distinct().count() == res.count()
    _compare(res, _batch_features(spark))


def test_stream_session_lock_equals_batch(spark):
    tel = load_telemetry(spark, SF_SMALL, PROFILE_B)
    feats = FE.stream_features(tel, PROFILE_B.window_minutes, PROFILE_B.capacity, keep_start=True) \
              .drop("last_event_time")
    src = _tmp("gs-feat-") + "/t"
    feats.withColumn("day", F.to_date("window_start")).write.partitionBy("day").parquet(src)
    stream = (spark.readStream.schema(feats.schema).option("maxFilesPerTrigger", 4)
                   .parquet(f"{src}/*"))
    out, ck = _tmp("gs-out-"), _tmp("gs-ck-")
    _run(spark, SQ.priced_stream(stream), out, ck)
    res = spark.read.parquet(out)
    batch = PR.price_features(feats, tel, keep_start=True)
    j = res.alias("s").join(batch.alias("b"), ["station_id", "time_bin"])
    assert j.count() == feats.count() == res.count()
    assert j.filter((F.col("s.session_status") != F.col("b.session_status"))
                    | (F.abs(F.col("s.guaranteed_price_cad") - F.col("b.guaranteed_price_cad")) > 1e-9)).count() == 0


def test_micro_batch_writer_and_grid_stream(spark):
    from gridstream.functions.rules import round_exact
    from gridstream.operators.alerts import grid_stress_by_bin
    tel = load_telemetry(spark, SF_SMALL, PROFILE_B)
    feats = FE.stream_features(tel, PROFILE_B.window_minutes, PROFILE_B.capacity, keep_start=True) \
              .drop("last_event_time")
    src = _tmp("gs-feat2-") + "/t"
    feats.withColumn("day", F.to_date("window_start")).write.partitionBy("day").parquet(src)
    stream = spark.readStream.schema(feats.schema).option("maxFilesPerTrigger", 8).parquet(f"{src}/*")
    prices, alerts, ck = _tmp("gs-prices-") + "/t", _tmp("gs-alerts-") + "/t", _tmp("gs-ck-")
    q = start(spark, SQ.priced_stream(stream).writeStream.foreachBatch(SQ.price_batch_writer(prices, alerts))
              .option("checkpointLocation", ck).trigger(availableNow=True))
    q.awaitTermination(900)
    assert q.exception() is None
    p = spark.read.parquet(prices)
    assert p.count() == feats.count()
    crit = p.filter("alert_level = 'critical'").count()
    raised = spark.read.parquet(alerts)
    assert raised.filter("type = 'station'").count() == crit > 0
    hot = grid_stress_by_bin(p, C.CAPACITY_KWH).filter("triggered_alert").count()
    assert raised.filter("type = 'regional'").count() == hot > 0

    # Regional score per bin from the stored rows, as a stream
    stored = spark.read.parquet(prices).drop("batch_id", "predicted_kwh")
    src2 = _tmp("gs-stored-") + "/t"
    stored.withColumn("day", F.to_date("window_start")).write.partitionBy("day").parquet(src2)
    # parallel writers give the day files arbitrary modification times; read
    # them as one batch so the file order cannot make rows late
    s2 = spark.readStream.schema(stored.schema).parquet(f"{src2}/*")
    out, ck2 = _tmp("gs-grid-") + "/t", _tmp("gs-ck-")
    _run(spark, SQ.grid_stress_stream(s2, PROFILE_B.capacity), out, ck2)
    got = spark.read.parquet(out)
    want = grid_stress_by_bin(stored.withColumn("predicted_kwh", round_exact("mean_kwh", 4)), PROFILE_B.capacity)
    j = got.alias("g").join(want.alias("w"), "time_bin")
    assert got.count() > 0 and j.count() == got.count()
    assert j.filter((F.abs(F.col("g.stress_score") - F.col("w.stress_score")) > 1e-12)
                    | (F.col("g.station_count") != F.col("w.station_count"))).count() == 0


def test_late_rows_are_dropped_and_counted(spark):
    import json
    root = _tmp("gs-late-")
    rows1 = [{"station_id": "1", "time_new": f"2024-01-02 00:{m:02d}:00", "duration": 0.0, "kwh": 1.0, "seq": m}
             for m in range(0, 50, 5)]
    rows2 = [{"station_id": "1", "time_new": "2024-01-01 00:00:00", "duration": 0.0, "kwh": 9.0, "seq": 99},
             {"station_id": "1", "time_new": "2024-01-02 05:00:00", "duration": 0.0, "kwh": 1.0, "seq": 100}]
    for i, rows in enumerate([rows1, rows2]):
        spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1) \
             .write.text(f"{root}/p{i}")
    s = SQ.decode_telemetry(SQ.message_stream(spark, path=f"{root}/*", max_files=1))
    out, ck = _tmp("gs-out-") + "/t", _tmp("gs-ck-")
    q = start(spark, SQ.rolling_clean_stream(s).writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", ck).trigger(availableNow=True))
    q.awaitTermination(600)
    assert q.exception() is None
    res = spark.read.parquet(out)
    late = SQ.late_readings(res).collect()
    assert [r.seq for r in late] == [99]                  # behind the watermark: passed on as late
    used = res.filter("anomaly_flag >= 0")
    assert used.filter("seq < 50").count() == len(rows1)
    assert all(abs(r.rolling_mean_kwh - 1.0) < 1e-12 for r in used.collect())   # the late 9.0 is in no baseline


def test_feature_job_upsert_and_data_quality(spark, source_parts):
    from gridstream.streaming.jobs import start_feature_job
    root, _ = source_parts
    feats_path, dq_path, ck = _tmp("gs-ft-") + "/t", _tmp("gs-dq-") + "/t", _tmp("gs-ck-")
    qs = start_feature_job(spark, f"{root}/*", feats_path, dq_path, ck, PROFILE_A.window_minutes,
                           PROFILE_A.capacity, trigger={"availableNow": True}, max_files=2)
    for q in qs:
        q.awaitTermination(900)
        assert q.exception() is None
    res = spark.read.parquet(feats_path).drop("dt")
    assert res.select("station_id", "time_bin").distinct().count() == res.count()
    _compare(res, _batch_features(spark))
    dq = spark.read.parquet(dq_path)
    batch_dq = FE.data_quality_rows(FE.clean_readings(load_telemetry(spark, SF_SMALL, PROFILE_A)))
    assert dq.join(batch_dq, ["station_id", "time_new"]).count() == dq.count() > 0


def test_pricing_job_chain(spark, source_parts):
    from gridstream.streaming.jobs import start_pricing_job
    root, _ = source_parts
    prices, alerts, ck = _tmp("gs-pr-") + "/t", _tmp("gs-al-") + "/t", _tmp("gs-ck-")
    q = start_pricing_job(spark, f"{root}/*", prices, alerts, ck, PROFILE_A.window_minutes, PROFILE_A.capacity,
                          trigger={"availableNow": True}, max_files=1)
    q.awaitTermination(900)
    assert q.exception() is None
    p = spark.read.parquet(prices)
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A)
    batch = PR.price_features(FE.stream_features(tel, PROFILE_A.window_minutes, PROFILE_A.capacity,
                                                 keep_start=True), tel, keep_start=True)
    j = p.alias("s").join(batch.alias("b"), ["station_id", "time_bin"])
    assert j.count() == p.count() > 0.95 * batch.count()
    assert j.filter((F.col("s.session_status") != F.col("b.session_status"))
                    | (F.col("s.dynamic_price_cad") != F.col("b.dynamic_price_cad"))
                    | (F.col("s.guaranteed_price_cad") != F.col("b.guaranteed_price_cad"))).count() == 0


def test_session_settings_are_put_back(spark):
    key = next(iter(STREAM_CONF))
    own = dict(spark.conf.getAll)
    with session_conf(spark, {**STREAM_CONF, "spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get(key) == STREAM_CONF[key] and spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert dict(spark.conf.getAll) == own and key not in own


def test_counts_take_a_batch_once(spark):
    """A batch that runs again overwrites its report; broken reports and other queries don't count."""
    from types import SimpleNamespace as N
    from pyspark.sql import Row
    from gridstream.streaming import counting as CT
    folder = _tmp("gs-counts-")
    counts = CT.Counts(spark, folder)
    for q, batch, n, late in [("a", 0, 5, 0), ("a", 1, 9, 1), ("a", 1, 7, 2), ("b", 0, 1, 0)]:
        counts.onQueryProgress(N(progress=N(id=q, batchId=batch, numInputRows=n, stateOperators=[N(numRowsDroppedByWatermark=late)],
                                            observedMetrics={"seen": Row(readings=n)})))
    got = {r["query"]: (r.batches, r.input_rows, r.dropped) for r in CT.totals(spark, folder).collect()}
    assert got == {"a": (2, 12, 2), "b": (1, 1, 0)}
    assert {r["query"]: r.total for r in CT.observed_total(spark, folder, SQ.SEEN).collect()} == {"a": 12, "b": 1}


class FakeState:
    """The state of one key, in memory; ``calls`` counts what a state server would have to answer."""

    def __init__(self):
        self.calls, self.values, self.maps, self.lists, self.timers = 0, {}, {}, {}, []

    def getValueState(self, name, schema, ttl=None):
        return FakeVariable(self, self.values, name)

    def getMapState(self, name, key, value, ttl=None):
        return FakeVariable(self, self.maps.setdefault(name, {}), None)

    def getListState(self, name, schema, ttl=None):
        return FakeVariable(self, self.lists, name)

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class FakeVariable:
    def __init__(self, state, held, name):
        self.state, self.held, self.name = state, held, name

    def _call(self):
        self.state.calls += 1
        return self.held

    def exists(self):
        return self.name in self._call()

    def get(self):
        return self._call()[self.name]

    def update(self, value):
        self._call()[self.name] = value

    put = update

    def clear(self):
        self._call().pop(self.name, None)

    def keys(self):
        return iter(list(self._call()))

    def getValue(self, key):
        return self._call()[key]

    def updateValue(self, key, value):
        self._call()[key] = value

    def removeKey(self, key):
        del self._call()[key]


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_rolling_clean_state_calls_do_not_grow_with_readings():
    """Readings of one station over ten days in two batches: the state is asked by buckets
    of time, not by reading, and the output is that of one ordered pass."""
    import numpy as np
    import pandas as pd
    from gridstream.streaming.processors import FIELDS, LATE, RollingClean, rolled
    rng = np.random.default_rng(7)
    n, day = 20_000, 86_400_000_000
    us = 1_704_067_200_000_000 + rng.integers(0, 10 * day, n)
    d = pd.DataFrame({"event_time": pd.to_datetime(us, unit="us"), "seq": np.arange(n), "kwh": rng.normal(5, 2, n),
                      "time_new": us.astype(str), "ts_us": us})
    again = d.sample(50, random_state=1).assign(kwh=99.0)          # same (time, seq): the later one stays
    middle = int(us.min()) + 5 * day + 12_345_678_000
    early, rest = d[us < middle], d[us >= middle]
    state, proc = FakeState(), RollingClean()
    proc.init(state)
    frames = lambda x: iter([x.iloc[i:i + 3000].drop(columns="ts_us") for i in range(0, len(x), 3000)])
    assert list(proc.handleInputRows(("1",), frames(pd.concat([early, rest.iloc[:4000], again[again.ts_us < middle]])), At(0))) == []
    wm = middle // 1000
    state.timers.clear()                                           # the engine removes a timer that has expired
    out = list(proc.handleExpiredTimer(("1",), At(wm), None))
    late = list(proc.handleInputRows(("1",), frames(pd.concat([rest.iloc[4000:], again[again.ts_us >= middle], early.iloc[:3]])), At(wm)))
    state.timers.clear()
    out += list(proc.handleExpiredTimer(("1",), At(int(us.max()) // 1000 - 60_000), None))
    end = (int(us.max()) // 1000 - 60_000) * 1000
    got = pd.concat(out, ignore_index=True)
    assert state.calls < n // 10
    assert [(len(x), set(x.anomaly_flag)) for x in late] == [(3, {LATE})]
    want = pd.concat([d, again]).drop_duplicates(["ts_us", "seq"], keep="last").sort_values(["ts_us", "seq"])
    want = rolled(pd.DataFrame([], columns=FIELDS), want[want.ts_us < end][FIELDS], proc.rows, proc.k)
    assert got.seq.tolist() == want.seq.tolist()
    for c in ("kwh", "rolling_mean_kwh", "rolling_std_kwh", "anomaly_flag", "corrected_kwh"):
        assert np.array_equal(got[c].to_numpy(float), want[c].to_numpy(float)), c
    assert len(state.timers) == 1 and state.timers[0] * 1000 > end     # what still waits is armed
