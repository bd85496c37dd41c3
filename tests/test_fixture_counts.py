"""Sanity counts of FIXTURES.md (sf0.01), computed by the Spark operators."""

import pytest
from pyspark.sql import functions as F

from gridstream.operators import alerts as AL
from gridstream.operators import features as FE
from gridstream.operators import pricing as PR
from gridstream.sources.telemetry import PROFILE_A, PROFILE_B, load_telemetry

from conftest import SF_CHECK

# profile -> (windows, flagged, normal, warning, critical, idle, bins, bins > 0.8, started, ongoing)
EXPECT = {
    "A": (1796, 205, 1239, 236, 321, 41, 120, 3, 53, 1702),
    "B": (9895, 166, 8618, 480, 797, 3936, 2780, 89, 2415, 3544),
}


@pytest.mark.parametrize("p", [PROFILE_A, PROFILE_B], ids=["A", "B"])
def test_fixture_counts(spark, p):
    tel = load_telemetry(spark, SF_CHECK, p)
    f = FE.stream_features(tel, p.window_minutes, p.capacity, keep_start=True)
    priced = PR.price_features(f, tel, keep_start=True).cache()
    lv = {r[0]: r[1] for r in priced.groupBy("alert_level").count().collect()}
    ss = {r[0]: r[1] for r in priced.groupBy("session_status").count().collect()}
    grid = priced.groupBy("window_start").agg(F.avg("capacity_utilization_ratio").alias("m"))
    got = (f.count(), f.filter("anomaly_flag = 1").count(), lv["normal"], lv["warning"], lv["critical"],
           f.filter("capacity_utilization_ratio = 0").count(), grid.count(), grid.filter("m > 0.8").count(),
           ss["session_started"], ss["session_ongoing"])
    priced.unpersist()
    assert got == EXPECT[p.name]
    assert ss["idle"] == EXPECT[p.name][5]


def test_grid_stress_latest_is_last_bin(spark):
    p = PROFILE_B
    tel = load_telemetry(spark, SF_CHECK, p)
    pr = PR.price_features(FE.stream_features(tel, p.window_minutes, p.capacity, keep_start=True), tel,
                           keep_start=True)
    last = AL.grid_stress_latest(pr, p.capacity).collect()
    allb = AL.grid_stress_by_bin(pr, p.capacity).orderBy(F.col("time_bin_ts").desc()).limit(1).collect()
    assert len(last) == 1 and last[0].time_bin == allb[0].time_bin
    assert last[0].stress_score == allb[0].stress_score
