"""Blocked (hot-key) ordered windows equal the one-partition-per-key plan."""

from pyspark.sql import functions as F

from gridstream.operators import features as FE
from gridstream.operators.series import ordered_window
from gridstream.sources.telemetry import PROFILE_A, load_telemetry

from conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_blocked_rolling_equals_simple(spark):
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A)
    cols = ["station_id", "seq", "rolling_mean_kwh", "rolling_std_kwh"]
    simple = _rows(FE.rolling_stats(tel, mode="simple"), cols)
    blocked = _rows(FE.rolling_stats(tel, mode="blocked", block_rows=37), cols)
    assert len(simple) == len(blocked) == tel.count()
    for a, b in zip(simple, blocked):
        assert a[:2] == b[:2]
        assert abs(a[2] - b[2]) < 1e-9 and abs((a[3] or 0) - (b[3] or 0)) < 1e-9


def test_blocked_lag_halo(spark):
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A)

    def compute(d, w):
        return d.withColumn("p2", F.lag("seq", 2).over(w)).withColumn("p7", F.lag("seq", 7).over(w))

    key, order = "station_id", ["event_time", "seq"]
    a = _rows(ordered_window(tel, key, order, compute, mode="simple"), ["seq", "p2", "p7"])
    for block in (50, 11, 2):          # blocks longer and shorter than the halo
        for minutes in (1, 60, 24 * 60):
            b = _rows(ordered_window(tel, key, order, compute, halo_before=7, block_rows=block,
                                     slice_minutes=minutes), ["seq", "p2", "p7"])
            assert a == b


def test_a_third_in_one_station_is_split_with_two_scans(spark):
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A)
    skew = tel.withColumn("station_id", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("station_id")))
    df = FE.rolling_stats(skew, block_rows=50)
    cols = ["seq", "rolling_mean_kwh", "rolling_std_kwh"]
    a, b = _rows(FE.rolling_stats(skew, mode="simple"), cols), _rows(df, cols)
    assert [x[0] for x in a] == [x[0] for x in b]
    assert all(abs(u - v) < 1e-9 for x, y in zip(a, b) for u, v in zip(x[1:], y[1:]) if u is not None)
    plan = FE.rolling_stats(skew, block_rows=50)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 2       # readings, and keys with times for the counts


def test_blocked_feature_chain_equals_simple(spark):
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A)
    cols = ["station_id", "time_bin", "mean_kwh", "variance_kwh", "rate_of_change", "anomaly_flag",
            "data_completeness"]
    a = _rows(FE.stream_features(tel, 360, 45.0, mode="simple"), cols)
    b = _rows(FE.stream_features(tel, 360, 45.0, mode="blocked", block_rows=23), cols)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:2] == y[:2] and x[5] == y[5]
        assert all(abs(u - v) < 1e-9 for u, v in zip(x[2:5] + x[6:], y[2:5] + y[6:]))


def test_previous_window_lag_equals_self_join(spark):
    from gridstream.sources.telemetry import PROFILE_B
    for p in (PROFILE_A, PROFILE_B):
        tel = load_telemetry(spark, SF_SMALL, p)
        wf = FE.window_features(FE.clean_readings(tel), p.window_minutes, p.capacity)
        cols = ["station_id", "window_start", "rate_of_change"]
        a = _rows(FE.with_previous_window(wf, p.window_minutes), cols)
        b = _rows(FE.with_previous_window(wf, p.window_minutes, self_join=True), cols)
        assert a == b


def test_time_ordered_within_partitions(spark):
    from gridstream.sources.telemetry import time_ordered
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A).repartition(3, "station_id")
    parts = time_ordered(tel).rdd.glom().collect()
    for rows in parts:
        keys = [(r.station_id, r.event_time) for r in rows]
        assert keys == sorted(keys)


def test_sliced_rank(spark):
    from pyspark.sql import Window
    from gridstream.operators.series import sliced_rank
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A).select("station_id").distinct().withColumn("g", F.lit(1))
    want = tel.withColumn("_want", F.row_number().over(Window.partitionBy("g").orderBy("station_id")))
    for n in (1, 2, 9):
        j = sliced_rank(tel, ["g"], "station_id", "_r", n).join(want.select("station_id", "_want"), "station_id")
        assert j.count() == tel.count() and j.filter("_r <> _want").count() == 0
