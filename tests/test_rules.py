"""Hand-computed cases for the row rules and the session lock."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridstream.functions import rules as R
from gridstream.operators import pricing as PR


# CUR -> (multiplier, alert, dynamic, locked price if a session starts)
PRICE_CASES = [
    (0.0, 1.0, "normal", 0.12, 0.132),
    (0.69, 1.0, "normal", 0.12, 0.132),
    (0.70, 1.0, "warning", 0.12, 0.132),
    (0.71, 1.05, "warning", 0.126, 0.1386),
    (0.72, 1.1, "warning", 0.132, 0.1452),
    (0.80, 1.5, "warning", 0.18, 0.198),
    (0.90, 2.0, "critical", 0.24, 0.264),
    (0.91, 3.0, "critical", 0.36, 0.396),
]


def test_price_rules(spark):
    df = spark.createDataFrame([(c,) for c, *_ in PRICE_CASES], "cur double")
    m = R.price_multiplier("cur")
    out = df.select("cur", F.round(m, 4).alias("m"), R.alert_level("cur").alias("a"),
                    R.dynamic_price(m).alias("d"), R.locked_price(R.dynamic_price(m)).alias("l")).collect()
    got = {r.cur: (r.m, r.a, r.d, r.l) for r in out}
    for cur, mult, alert, dyn, lock in PRICE_CASES:
        assert got[cur][0] == pytest.approx(mult, abs=1e-12)
        assert got[cur][1] == alert
        assert got[cur][2] == pytest.approx(dyn, abs=1e-12)
        assert got[cur][3] == pytest.approx(lock, abs=1e-12)


def test_session_lock_sequence(spark):
    curs = [0, .5, .95, .72, 0, 0, .91, .5]
    t0 = dt.datetime(2024, 1, 1)
    rows = [("s1", t0 + dt.timedelta(minutes=15 * i), float(c)) for i, c in enumerate(curs)]
    df = spark.createDataFrame(rows, "station_id string, window_start timestamp, capacity_utilization_ratio double")
    m = R.price_multiplier("capacity_utilization_ratio")
    df = df.withColumn("dynamic_price_cad", R.dynamic_price(m))
    out = PR.with_session(df).orderBy("window_start").collect()
    got = [(round(r.guaranteed_price_cad, 4), r.session_status) for r in out]
    assert got == [(0.132, "idle"), (0.132, "session_started"), (0.132, "session_ongoing"),
                   (0.132, "session_ongoing"), (0.132, "idle"), (0.132, "idle"),
                   (0.396, "session_started"), (0.396, "session_ongoing")]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1),), (dt.datetime(2023, 1, 2),)], "ts timestamp")
    assert [r.d for r in df.select(R.weekday_of("ts").alias("d")).collect()] == [6, 0]


def _flags(spark, values):
    from gridstream.operators.features import clean_readings
    t0 = dt.datetime(2024, 1, 1)
    rows = [("s", t0 + dt.timedelta(minutes=5 * i), float(v), i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "station_id string, event_time timestamp, kwh double, seq long")
    out = clean_readings(df, mode="simple").orderBy("seq").collect()
    return [r.anomaly_flag for r in out], out


def test_three_sigma_cases(spark):
    flags, _ = _flags(spark, [1.0] * 8 + [50.0])
    assert flags[-1] == 0           # 9 points: max z = sqrt(8) < 3
    flags, out = _flags(spark, [1.0] * 30 + [50.0])
    assert flags[-1] == 1           # 31 points: z = sqrt(30) > 3
    assert out[-1].corrected_kwh == pytest.approx(out[-1].rolling_mean_kwh)
    flags, _ = _flags(spark, [2.0] * 40)
    assert sum(flags) == 0          # std 0 never flags


def test_latency_bounds(spark):
    rows = [(-1000.0, 5), (600000.0, 5), (-999.0, 5), (599999.0, 5), (10.0, 0)]
    df = spark.createDataFrame(rows, "latency_ms double, kafka_ts_ms long")
    kept = sorted(r.latency_ms for r in df.filter(R.latency_ok()).collect())
    assert kept == [-999.0, 599999.0]


@pytest.mark.parametrize("n,expect", [(19, None), (20, 19.0)])
def test_p95_rank(spark, n, expect):
    from gridstream.operators.serving import latency_stats
    df = spark.createDataFrame([(float(i + 1), 5) for i in range(n)], "latency_ms double, kafka_ts_ms long")
    r = latency_stats(df, order=("latency_ms",)).collect()[0]
    assert r.p95_latency_ms == expect
    assert r.n_samples == n


def test_stress_band(spark):
    df = spark.createDataFrame([(0.81,), (0.8,), (0.61,), (0.6,)], "stress_score double")
    assert [r.b for r in df.select(R.stress_band().alias("b")).collect()] == \
        ["triggered", "warning", "warning", "normal"]


def test_rounding_is_of_the_binary_value(spark):
    """Prices round as Python's ``round`` does: all locks of 4-place prices,
    all 4-place ties, and values around them."""
    prices = [k / 10000 for k in range(1000, 3700)] + [(2 * k + 1) / 20000 for k in range(0, 20000, 7)]
    values = [x * 1.1 for x in prices] + prices + [0.0, -0.12345, -0.00005, 1e17, 123456.78905, 0.13585]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    got = {r.i: r.y for r in df.select("i", R.round_exact("x", 4).alias("y")).collect()}
    assert [got[i] for i in range(len(values))] == [round(x, 4) for x in values]


def test_limits_are_not_moved_unless_asked(spark):
    df = spark.createDataFrame([(0.6999999997,)], "cur double")
    r = df.select(R.alert_level("cur").alias("a"), R.alert_level("cur", grid=9).alias("b")).collect()[0]
    assert (r.a, r.b) == ("normal", "warning")


def test_rated_power_is_the_interpolated_quantile(spark):
    import numpy as np
    from gridstream.operators.pricing import rated_power
    for n in (1, 2, 3, 40, 401):
        v = np.random.default_rng(n).gamma(2.0, 20.0, n)
        df = spark.createDataFrame([(str(i), float(x)) for i, x in enumerate(v)], "station_id string, kwh double")
        assert rated_power(df).collect()[0][0] == pytest.approx(float(np.quantile(v, 0.95)), abs=1e-9)
