"""Registered streams over readings whose ids don't follow their time within a second."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E


@pytest.mark.parametrize("name", ["w03_rolling_clean_stream", "w07_feature_job", "s13_data_quality_sink"])
def test_readings_of_a_second_keep_their_order(spark, tmp_path, name):
    """Ids that don't follow time within a second: the exact time decides, as in the SQL."""
    day = pd.Timestamp("2024-01-02 06:00:00")
    at = lambda i: day + pd.Timedelta(minutes=15 * (i // 4), milliseconds=200 * (i % 4) + 0.25)
    rows = pd.DataFrame([(i + 3 - 2 * (i % 4), at(i), i % 2, "click", 900.0 if i % 41 == 40 else float(i * i % 23)) for i in range(400)],
                        columns=["event_id", "ts", "user_id", "event_type", "value"])
    spark.createDataFrame(rows).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    plain = lambda found: sorted(tuple(repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in found)
    df = E.queries()[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({E.oracle_sql()[name]})").fetchall()
    assert len(want) > 3 and plain(df.collect()) == plain(want)
