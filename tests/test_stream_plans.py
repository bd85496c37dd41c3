"""Registered streams over a table of more than a month, several files to a part."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from gridstream import schemas as SC
from gridstream.operators import alerts as AL
from gridstream.plans import catalog, streams
from gridstream.sources import sinks as SK
from gridstream.streaming import queries as SQ
from gridstream.streaming.processors import ROLLED

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def long_dir(spark, tmp_path_factory):
    """The events moved by -30 to 90 days."""
    folder = str(tmp_path_factory.mktemp("long"))
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    moved = events.withColumn("ts", F.expr("ts + make_dt_interval(cast(event_id % 5 - 1 AS int) * 30)"))
    moved.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def even_events(spark, folder, rows, minutes):
    """Events with one and the same value, which is far from any limit, every so many minutes."""
    at = f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * {minutes} AS int))"
    spark.range(rows).selectExpr("id AS event_id", f"{at} AS ts", "id % 30 AS user_id", "'purchase' AS event_type", "5.0D AS value",
                                 "'{}' AS props").coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def sql_over(folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    res = con.execute(E.oracle_sql()[name])
    return [d[0] for d in res.description], res.fetchall()


def test_no_alerts_with_all_windows_priced(spark, tmp_path, monkeypatch):
    """Of 80 hours nothing is an alert: an empty table, after the job's whole work (its prices equal the SQL)."""
    folder, job, ran = even_events(spark, str(tmp_path), 240, 20), streams.pricing_job, []
    monkeypatch.setattr(streams, "pricing_job", lambda *a: ran.append(job(*a)) or ran[0])
    got = E.queries()["w11_stream_alerts"](spark, folder)
    names, want = sql_over(folder, "w11_stream_alerts")
    assert sorted(got.columns) == sorted(names)
    assert got.collect() == want == []
    names, want = sql_over(folder, "w11_pricing_job")
    prices = streams.rounded(SK.read_written(spark, ran[0][0], SC.PRICES)).select(*names)
    assert sorted(map(tuple, prices.collect())) == sorted(want) != []


# of 80 hours nothing is an anomaly; of 20 minutes no window is closed
@pytest.mark.parametrize("rows, minutes, name", [(240, 20, "s13_data_quality_sink"), (240, 20, "s12_append_batches"),
                                                 (20, 1, "w11_pricing_job"), (20, 1, "w07_feature_job")])
def test_a_sink_without_rows_reads_as_an_empty_table(spark, tmp_path, rows, minutes, name):
    folder = even_events(spark, str(tmp_path), rows, minutes)
    names, want = sql_over(folder, name)
    got = E.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert got.collect() == want == []


def test_declared_schemas_are_those_of_the_sinks(spark):
    types = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    priced = catalog.stored_priced(spark, SF_SMALL)
    alerts = AL.alert_stream(AL.station_alerts(priced), AL.regional_alerts(AL.grid_stress_by_bin(priced)))
    assert types(alerts.schema) == types(SC.ALERT)
    assert types(priced.select(*SC.PRICES.fieldNames()).schema) == types(SC.PRICES)
    rolled = spark.createDataFrame([], ROLLED)
    assert types(SQ.data_quality_rows(rolled).schema) == types(SC.DATA_QUALITY)


def test_messages_hold_all_readings(spark, long_dir, monkeypatch):
    t = streams.tel(spark, long_dir, streams.PROFILE_A)
    parts = sorted(r[0] for r in t.select(streams.part()).distinct().collect())
    assert parts[0] < 0 and parts[-1] > 4
    monkeypatch.setattr(streams, "FILE_ROWS", 20)
    path, files = streams.messages(spark, long_dir, last=1)
    got = spark.read.text(path)
    assert files > 1 and got.count() == t.count()
    assert len(got.inputFiles()) == files * len(parts)


def test_late_readings_of_a_long_table(spark, long_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{long_dir}/events.parquet/*.parquet')")
    want = con.execute(E.oracle_sql()["w02_late_readings"]).fetchall()
    assert [tuple(r) for r in E.queries()["w02_late_readings"](spark, long_dir).collect()] == want


def test_state_partitions_follow_the_cores(spark, tmp_path):
    """200 shuffle partitions don't make 200 state stores; the session keeps its number."""
    from gridstream.streaming.starting import session_conf, start, state_partitions
    spark.range(20).selectExpr("cast(id % 3 AS string) AS k").write.parquet(f"{tmp_path}/in")
    with session_conf(spark, {"spark.sql.shuffle.partitions": "200"}):
        want = state_partitions(spark)
        assert want == max(32, 2 * spark.sparkContext.defaultParallelism) < 200
        counts = spark.readStream.schema("k string").parquet(f"{tmp_path}/in").groupBy("k").count()
        q = start(spark, counts.writeStream.format("noop").outputMode("complete").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True))
        streams.finish(q)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    assert q.lastProgress.stateOperators[0].numShufflePartitions == want
    with session_conf(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert state_partitions(spark) == 3
