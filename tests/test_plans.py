"""Plan properties: one shuffle for the feature chain, pruned scans, and no
cartesian / nested-loop joins in any registered query."""

import pytest

import __spark_entry__ as E
from gridstream.operators import features as FE
from gridstream.sources.telemetry import PROFILE_A, load_telemetry

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_chain_single_exchange(spark):
    tel = load_telemetry(spark, SF_SMALL, PROFILE_A)
    plan = _plan(FE.stream_features(tel, 360, 45.0, mode="simple"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan   # lag, not a self-join


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["a03_grid_stress"](spark, SF_SMALL))
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln]
    assert scans and all("metadata" not in s for s in scans)


def _scans(df) -> int:
    """Scans of a plan without those of exchanges that are used again."""
    return _plan(df).count("FileScan parquet")


def test_prices_scan_the_readings_a_few_times(spark):
    """The rated power stands in the plan once, not in every use of a price."""
    for name in ("p09_priced_features", "d04_latest_per_station"):
        df = E.queries()[name](spark, SF_SMALL)
        assert df._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery") <= 2, name
        assert _scans(df) <= 6, name


def test_picked_thresholds_need_no_second_pass(spark):
    """E14 has no more scans than the metrics that it reads."""
    assert _scans(E.queries()["e14_comparison_table"](spark, SF_SMALL)) <= _scans(E.queries()["e08_detector_metrics"](spark, SF_SMALL))


# these run a job while building: models, sinks and streams that are read back, training-data operators
BUILDING = ("m0", "w", "op", "pipeline", "s11", "s12", "s13", "s14", "s15", "s17", "s19_raw", "s20", "s21", "s22", "s24", "s01",
            "d14_stream", "d15_readings", "d08_latency_sketch", "p04_rated_power_sketch")


def test_building_a_query_starts_no_job(spark, monkeypatch):
    """Apart from the one in which Spark reads a file's schema."""
    from gridstream.sources import telemetry as TL
    reads, load = [], TL.load_table
    monkeypatch.setattr(TL, "load_table", lambda *a: reads.append(a) or load(*a))
    spark.sparkContext.setJobGroup("building", "building")
    for name, q in E.queries().items():
        if not name.startswith(BUILDING):
            q(spark, SF_SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(reads) > 50 and len(jobs) <= len(reads)


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not n.startswith(BUILDING)))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
