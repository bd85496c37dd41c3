"""Registered streaming queries: the events as JSON messages in files, a
streaming job over them with ``availableNow``, the sink read back.

Results cover what the last watermark closed: the newest reading's time, in
milliseconds, less the 30 seconds of allowed lateness.
"""

from __future__ import annotations

import math
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstream import schemas as SC
from gridstream.functions.rules import format_ts
from gridstream.plans.catalog import GRID, grid_of, register, stored_priced, tel
from gridstream.plans.common import rounded
from gridstream.sources import messages as MS
from gridstream.sources import sinks as SK
from gridstream.sources.telemetry import PROFILE_A, PROFILE_B, read_trace
from gridstream.streaming import counting as CT
from gridstream.streaming import jobs
from gridstream.streaming import queries as SQ
from gridstream.streaming.processors import LATE
from gridstream.streaming.starting import start
from gridstream.streaming.state import state_of

ONCE = {"availableNow": True}
DAYS = 8                         # days of readings in one part, a micro-batch
FILE_ROWS = 250_000              # messages in one file, about
MESSAGE = ["station_id", "time_new", "duration", "kwh", "seq"]
TIMED = [*MESSAGE, "event_us"]   # with the exact time: readings of one second are in their order


def place(spark: SparkSession, name: str) -> str:
    return SK.table_path(spark, f"{name}-{uuid.uuid4().hex}")


def part() -> F.Column:
    return F.floor(F.unix_seconds("event_time") / (86400 * DAYS)) - F.floor(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) / (86400 * DAYS))


def message_parts(spark, sf_dir, last: int | None = None):
    """Writers of the parts of the table's time, in order, part ``last`` after the
    others, and the number of files that each leaves: that many are one micro-batch."""
    root, staged = place(spark, "messages"), place(spark, "parts")
    t = tel(spark, sf_dir, PROFILE_A).withColumn("event_us", F.unix_micros("event_time")).select(*TIMED, part().alias("part"))
    t.write.partitionBy("part").parquet(staged)
    t = spark.read.schema(t.schema).parquet(staged)
    rows = {r["part"]: r["count"] for r in t.groupBy("part").count().collect()}
    files = max(1, math.ceil(max(rows.values(), default=0) / FILE_ROWS))

    def write(i: int, p: int) -> None:
        own = t.filter(F.col("part") == p).select(*TIMED).repartition(files, "station_id", "seq")
        MS.encode(own, "ev-telemetry").select("value").write.text(f"{root}/{i}")
        for _ in range(files - len(spark.read.text(f"{root}/{i}").inputFiles())):     # tasks without rows write no file
            spark.createDataFrame([], "value string").coalesce(1).write.mode("append").text(f"{root}/{i}")

    parts = enumerate(sorted(rows, key=lambda p: (p == last, p)) or [0])
    return f"{root}/*", files, [partial(write, i, p) for i, p in parts]


def messages(spark, sf_dir, last: int | None = None) -> tuple[str, int]:
    """A folder of JSON-lines files and the number of files of a part."""
    path, files, writers = message_parts(spark, sf_dir, last)
    for write in writers:
        write()
    return path, files


def run(df: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None):
    """``df`` through an append sink until its input is used up: the sink read back, and the query."""
    spark = df.sparkSession
    out, checkpoint = out or place(spark, name), checkpoint or place(spark, "stream-state")
    q = start(spark, df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(**ONCE))
    finish(q)
    return spark.read.schema(df.schema).parquet(out), q


def finish(*queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def telemetry_stream(spark, sf_dir, last: int | None = None) -> DataFrame:
    path, files = messages(spark, sf_dir, last)
    return SQ.decode_telemetry(SQ.message_stream(spark, path=path, max_files=files))


@register("s01_trace_scan")
def q_trace(spark, sf_dir):
    """The telemetry as a CSV trace, read with its declared schema."""
    path = place(spark, "trace")
    tel(spark, sf_dir, PROFILE_B).select("station_id", "time_new", "duration", "kwh").write.option("header", True).csv(path)
    return rounded(read_trace(spark, path).select("station_id", "time_new", "duration", "kwh"))


def rolled_in_two_runs(spark, sf_dir) -> tuple[DataFrame, str]:
    """The rolling stage over the messages, stopped and started again from its
    checkpoint after half of the parts: its output, and the folder of its
    counts.  The second part from 2024-01-01 comes last: all its readings are late."""
    path, files, writers = message_parts(spark, sf_dir, last=1)
    out, checkpoint, folder = place(spark, "rolled"), place(spark, "stream-state"), place(spark, "counts")
    half = max(1, len(writers) // 2)
    with CT.counting(spark, folder) as counts:
        for some in (writers[:half], writers[half:]):
            for write in some:
                write()
            tel_stream = SQ.decode_telemetry(SQ.message_stream(spark, path=path, max_files=files))
            rolled, q = run(SQ.rolling_clean_stream(SQ.observed(tel_stream)), "rolled", out, checkpoint)
            counts.settle(q)
    return rolled, folder


@register("w02_late_readings")
def q_late(spark, sf_dir):
    """Readings behind the watermark of the batch before are dropped and counted
    by the engine, the others are passed on by the rolling stage."""
    rolled, folder = rolled_in_two_runs(spark, sf_dir)
    dropped = CT.totals(spark, folder).agg(F.coalesce(F.sum("dropped"), F.lit(0))).scalar()
    return rolled.agg((F.count_if(F.col("anomaly_flag") == LATE) + dropped).alias("n_late"), F.count(F.lit(1)).cast("int").alias("n_out"))


@register("d15_readings_seen")
def q_readings_seen(spark, sf_dir):
    """D15 in a stream: the observed readings of all micro-batches of both runs,
    each counted once, and the query ids (a restart keeps the id)."""
    _, folder = rolled_in_two_runs(spark, sf_dir)
    return CT.observed_total(spark, folder, SQ.SEEN).agg(F.sum("total").alias("n_seen"), F.count(F.lit(1)).alias("n_queries"))


@register("w03_rolling_clean_stream")
def q_rolled(spark, sf_dir):
    rolled = SQ.on_time(run(SQ.rolling_clean_stream(telemetry_stream(spark, sf_dir)), "rolled")[0])
    return rounded(rolled.select("station_id", "time_new", "seq", "kwh", "rolling_mean_kwh", "rolling_std_kwh", "anomaly_flag", "corrected_kwh"))


def feature_job(spark, sf_dir) -> tuple[str, str]:
    feats, dq = place(spark, "features"), place(spark, "dq")
    path, files = messages(spark, sf_dir)
    finish(*jobs.start_feature_job(spark, path, feats, dq, place(spark, "stream-state"), PROFILE_A.window_minutes,
                                   PROFILE_A.capacity, trigger=ONCE, max_files=files))
    return feats, dq


@register("w07_feature_job")
def q_feature_job(spark, sf_dir):
    feats, _ = feature_job(spark, sf_dir)
    return rounded(SK.read_written(spark, feats, SC.FEATURES))


@register("s13_data_quality_sink")
def q_dq_sink(spark, sf_dir):
    _, dq = feature_job(spark, sf_dir)
    return rounded(SK.read_written(spark, dq, SC.DATA_QUALITY))


def pricing_job(spark, sf_dir, checkpoint: str | None = None) -> tuple[str, str]:
    prices, alerts = place(spark, "prices"), place(spark, "alerts")
    path, files = messages(spark, sf_dir)
    finish(jobs.start_pricing_job(spark, path, prices, alerts, checkpoint or place(spark, "stream-state"), PROFILE_A.window_minutes,
                                  PROFILE_A.capacity, trigger=ONCE, max_files=files, history=tel(spark, sf_dir, PROFILE_A), grid=GRID))
    return prices, alerts


@register("w11_pricing_job")
def q_pricing_job(spark, sf_dir):
    prices, _ = pricing_job(spark, sf_dir)
    return rounded(SK.read_written(spark, prices, SC.PRICES))


@register("w11_stream_alerts")
def q_stream_alerts(spark, sf_dir):
    _, alerts = pricing_job(spark, sf_dir)
    return rounded(SK.read_written(spark, alerts, SC.ALERT))


@register("w08_session_state")
def q_session_state(spark, sf_dir):
    """The session lock of every station as the pricing job's state store
    holds it after the last closed window."""
    checkpoint = place(spark, "stream-state")
    pricing_job(spark, sf_dir, checkpoint)
    return rounded(state_of(spark, checkpoint, "session").select("station_id", "active", "lock"))


@register("w09_grid_stress_stream")
def q_grid_stream(spark, sf_dir):
    """Stored priced rows as a stream; the regional score of each closed bin."""
    path = place(spark, "stored")
    stored_priced(spark, sf_dir).select("station_id", "window_start", F.col("predicted_kwh").alias("mean_kwh")).write.parquet(path)
    stored = spark.readStream.schema("station_id string, window_start timestamp, mean_kwh double").parquet(path)
    return rounded(run(SQ.grid_stress_stream(stored, PROFILE_B.capacity), "grid")[0])
