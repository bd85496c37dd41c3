"""Scans, message codecs and idempotent sinks."""

import glob
import json
import os
import tempfile

from pyspark.sql import functions as F

from gridstream import schemas as SC
from gridstream.operators import alerts as AL
from gridstream.operators import serving as SV
from gridstream.sources import messages as MS
from gridstream.sources import sinks as SK
from gridstream.sources import telemetry as TL

from conftest import SF_SMALL


def _dir(prefix):
    return tempfile.mkdtemp(prefix=prefix, dir="/tmp") + "/t"


def test_csv_trace_scan_and_clean(spark):
    tel = TL.load_telemetry(spark, SF_SMALL, TL.PROFILE_B).select("station_id", "time_new", "duration", "kwh")
    bad = spark.createDataFrame([(None, "2024-01-01 00:00:00", 1.0, 1.0), ("7", "2024-01-01 00:05:00", None, None),
                                 ("8", "not a time", 0.0, 0.0)], SC.TELEMETRY)
    path = _dir("gs-csv-")
    tel.unionByName(bad).write.option("header", True).csv(path)
    raw = TL.read_trace(spark, path)
    assert dict(raw.dtypes)["kwh"] == "double"
    clean = TL.with_event_time(TL.clean_telemetry(raw))
    assert clean.count() == tel.count() + 1          # null station and junk time dropped
    row = clean.filter("station_id = '7'").filter("time_new = '2024-01-01 00:05:00'").collect()[0]
    assert row.kwh == 0.0 and row.duration == 0.0


def test_decode_rejects_and_tombstones(spark):
    msgs = spark.createDataFrame([
        ("t", "a", json.dumps({"station_id": "1", "time_new": "2024-01-01 00:00:00", "duration": 0.0, "kwh": 2.0})),
        ("t", "b", "{not json"),
        ("t", "c", json.dumps({"time_new": "2024-01-01 00:00:00", "kwh": 1.0})),
        ("t", "d", None),
    ], "topic string, key string, value string")
    ok, rej = MS.decode(msgs, SC.TELEMETRY, required=["station_id", "time_new"])
    assert [r.station_id for r in ok.collect()] == ["1"]
    assert sorted(r.key for r in rej.collect()) == ["b", "c"]


def test_fixture_smoke_messages(spark):
    """The smoke messages: one inference row + one station alert; one data-quality row."""
    price = {"station_id": "1000000001", "time_bin": "2023-06-01 14:00:00", "predicted_kwh": 20.0,
             "price_multiplier": 3.0, "base_price_cad": 0.12, "dynamic_price_cad": 0.36,
             "guaranteed_price_cad": 0.396, "session_status": "session_started", "day_ahead_price_cad": 0.12,
             "alert_level": "critical"}
    dq = {"station_id": "1000000001", "time_bin": "2023-06-01 14:00:00", "original_kwh": 25.0,
          "corrected_kwh": 10.5, "reason": "zscore>3"}
    dq_no_reason = {"station_id": "2", "time_bin": "2023-06-01 14:00:00", "original_kwh": 1.0,
                    "corrected_kwh": 1.0}
    dq_null_reason = dict(dq_no_reason, station_id="3", reason=None)
    msgs = spark.createDataFrame(
        [("dynamic-prices", "k", json.dumps(price)), ("data-quality", "k", json.dumps(dq)),
         ("data-quality", "k", json.dumps(dq_no_reason)), ("data-quality", "k", json.dumps(dq_null_reason)),
         ("dynamic-prices", "k", "garbage")], "topic string, key string, value string")
    frames = MS.route(msgs, {"dynamic-prices": SC.PRICES, "data-quality": SC.DATA_QUALITY_IN})
    inf = MS.inference_rows(frames["dynamic-prices"]).collect()
    assert len(inf) == 1 and str(inf[0].time_bin) == "2023-06-01 14:00:00"
    alerts = AL.station_alerts(frames["dynamic-prices"]).collect()
    assert len(alerts) == 1 and alerts[0].type == "station" and alerts[0].key == "1000000001"
    ev = {r.station_id: r for r in MS.data_quality_events(frames["data-quality"]).collect()}
    assert ev["1000000001"].reason == "zscore>3"
    assert ev["2"].reason == "anomaly_detected"          # absent -> default
    assert ev["3"].reason is None                        # explicit null stays null
    assert json.loads(ev["1000000001"].raw_payload)["original_kwh"] == 25.0


def test_upsert_newest_version_wins(spark):
    path = _dir("gs-upsert-")
    a = spark.createDataFrame([("s1", "2024-01-01 00:00:00", 1.0, 1), ("s2", "2024-01-01 00:15:00", 2.0, 1), ("s9", "no time", 5.0, 1)],
                              "station_id string, time_bin string, v double, ver int").withColumn("time_bin", F.col("time_bin"))
    as_time = lambda d: d.withColumn("dt_text", F.col("time_bin"))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        SK.upsert(as_time(a), path, order="ver")
        b = spark.createDataFrame([("s1", "2024-01-01 00:00:00", 9.0, 3), ("s1", "2024-01-01 00:00:00", 8.0, 2),
                                   ("s3", "2024-01-02 00:00:00", 3.0, 1), ("s8", "no time", 6.0, 1), (None, "2024-01-02 00:00:00", 7.0, 1)],
                                  "station_id string, time_bin string, v double, ver int")
        for batch in (b, b, a):                          # a replay, then an older version again
            SK.upsert(as_time(batch), path, order="ver")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    got = {(r.station_id, r.time_bin): r.v for r in spark.read.parquet(path).collect()}
    assert got == {("s1", "2024-01-01 00:00:00"): 9.0, ("s2", "2024-01-01 00:15:00"): 2.0,
                   ("s3", "2024-01-02 00:00:00"): 3.0, ("s9", "no time"): 5.0, ("s8", "no time"): 6.0}
    assert spark.read.parquet(path + "-rejected").count() == 2      # the row without a station, twice


def test_insert_once_keeps_one_row_of_a_bin(spark):
    path = _dir("gs-once-") + "/t"
    b = spark.createDataFrame([("t1", 2.0), ("t1", 1.0), ("t2", 3.0)], "time_bin string, v double")
    SK.insert_once(b, path)
    SK.insert_once(b.withColumn("v", F.col("v") + 9), path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("t1", 1.0), ("t2", 3.0)}


def test_append_batch_replay_and_ids(spark):
    path = _dir("gs-append-")
    b = spark.createDataFrame([("s1", "2024-01-01 00:00:00"), ("s2", "2024-01-01 00:00:00")],
                              "station_id string, time_bin string")
    SK.append_batch(b, path, 0)
    SK.append_batch(b, path, 0)                          # replayed micro-batch
    SK.append_batch(b, path, 1)
    assert spark.read.parquet(path).count() == 4
    existing = spark.createDataFrame([(10,)], "id long")
    ids = sorted(r.id for r in SK.with_ids(b, existing, "station_id").collect())
    assert ids == [11, 12]
    many = spark.range(1000).repartition(7).withColumn("station_id", F.col("id").cast("string")).drop("id")
    numbered = SK.with_ids(many, existing, "station_id", slices=16)
    first = {r.station_id: r.id for r in numbered.collect()}
    assert sorted(first.values()) == list(range(11, 1011))
    assert first == {r.station_id: r.id for r in SK.with_ids(many.repartition(3), existing, "station_id", slices=16).collect()}


def test_schema_evolution_and_export(spark):
    path = _dir("gs-evolve-")
    spark.createDataFrame([("s1", 1.0)], "station_id string, predicted_kwh double") \
         .write.mode("append").parquet(path)
    spark.createDataFrame([("s2", 2.0, 0.5)], "station_id string, predicted_kwh double, day_ahead_price_cad double") \
         .write.mode("append").parquet(path)
    t = SK.read_table(spark, path)
    got = {r.station_id: r.day_ahead_price_cad for r in t.collect()}
    assert got == {"s1": None, "s2": 0.5}
    out = _dir("gs-csvout-")
    SK.export_csv(t, out)
    assert len(glob.glob(os.path.join(out, "*.csv"))) == 1


def test_heatmap_pivot(spark):
    rows = [("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-02 10:00:00", 3.0), ("b", "2024-01-02 10:15:00", 5.0)]
    df = spark.createDataFrame(rows, "station_id string, time_bin string, predicted_kwh double") \
              .withColumn("time_bin", F.to_timestamp("time_bin"))
    wide = SV.heatmap_pivot(SV.heatmap_long(df)).orderBy("station_id").collect()
    assert wide[0]["10:00"] == 2.0 and wide[0]["10:15"] is None and wide[1]["10:15"] == 5.0


def test_station_cap_and_replay_offsets(spark):
    tel = TL.load_telemetry(spark, SF_SMALL, TL.PROFILE_B)
    capped = TL.cap_stations(tel, 5)
    assert capped.select("station_id").distinct().count() == 5
    off = TL.replay_offsets(tel, 0)
    assert off.agg(F.max("offset_s")).collect()[0][0] == 0.0
    off = TL.replay_offsets(tel, 60.0).groupBy("station_id").agg(F.min("offset_s").alias("m"))
    assert off.agg(F.max("m")).collect()[0][0] == 0.0


def test_cap_rows_is_the_first_n(spark):
    tel = TL.load_telemetry(spark, SF_SMALL, TL.PROFILE_B)
    tel = tel.withColumn("event_time", F.when(F.col("seq") % 97 != 0, F.col("event_time")))      # some rows without a time
    for n in (1, 7, 537, 10 ** 6):
        want = sorted(r.seq for r in tel.orderBy("event_time", "station_id", "seq").limit(n).collect())
        for minutes in (60, 60 * 24 * 60):
            assert sorted(r.seq for r in TL.cap_rows(tel, n, slice_minutes=minutes).collect()) == want
