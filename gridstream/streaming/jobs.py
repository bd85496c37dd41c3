"""Long-running streaming jobs with durable, idempotent sinks.

* ``start_feature_job``: telemetry messages -> one rolling pass whose batches go
  to the cleaned-readings table, the data-quality table and the late-readings
  table (S13, append by batch id), and a second query that reads the cleaned
  readings as a file stream and upserts the features (S11).
* ``start_pricing_job``: telemetry -> features -> complete priced rows, station
  alerts and regional alerts, in one pass per micro-batch (W11).

* ``start_buffer_job``: rows -> the newest ones, kept in state, as a table (D14).
* ``start_changelog_job``: a changelog with tombstones -> the merged table (W06, S14).
* ``start_router_job``: messages of several topics -> one table by topic with dead letters (S15, S17).

Each job takes its own checkpoint folder; restarting with the same folder
resumes offsets and state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridstream import config as C
from gridstream.operators.pricing import tariff_of
from gridstream.session import materialize
from gridstream.sources import messages as MS
from gridstream.sources.sinks import append_batch, fan_out, merge_changes, upsert
from gridstream.streaming import queries as SQ
from gridstream.streaming.processors import ROLLED
from gridstream.streaming.starting import start


def _start(df: DataFrame, fn, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return start(df.sparkSession, w.trigger(**(trigger or {"processingTime": "30 seconds"})))


def start_feature_job(spark: SparkSession, source: str | None, features_path: str, dq_path: str,
                      checkpoint: str, window_minutes: int = C.WINDOW_MINUTES,
                      capacity: float = C.CAPACITY_KWH, kafka: dict | None = None,
                      trigger: dict | None = None, max_files: int | None = None) -> list[StreamingQuery]:
    """Two queries: the rolling stage runs once and feeds both sinks.  With
    ``trigger={"availableNow": True}`` the second starts when the first is done."""
    rolled_path, late_path = f"{features_path}-rolled", f"{features_path}-late"
    tel = SQ.decode_telemetry(SQ.message_stream(spark, path=source, kafka=kafka, max_files=max_files))

    def write(batch: DataFrame, i: int) -> None:
        fan_out(batch, [lambda b: append_batch(SQ.on_time(b), rolled_path, i),
                        lambda b: append_batch(SQ.late_readings(b), late_path, i),
                        lambda b: append_batch(SQ.data_quality_rows(b), dq_path, i)])

    first = _start(SQ.rolling_clean_stream(tel), write, f"{checkpoint}/rolled", trigger)
    if trigger and trigger.get("availableNow"):
        first.awaitTermination()
        if first.exception() is not None:
            return [first]
    # the folder must be there before the second query lists it
    spark.createDataFrame([], ROLLED).write.mode("append").parquet(f"{rolled_path}/batch_id=-1")
    rolled = spark.readStream.schema(ROLLED).parquet(f"{rolled_path}/*")
    feats = SQ.features_of_rolled(rolled.withWatermark("event_time", C.WATERMARK_DELAY), window_minutes, capacity)
    second = _start(feats, lambda b, _i: upsert(b, features_path, order="window_start"), f"{checkpoint}/features", trigger)
    return [first, second]


def start_pricing_job(spark: SparkSession, source: str | None, prices_path: str, alerts_path: str,
                      checkpoint: str, window_minutes: int = C.WINDOW_MINUTES,
                      capacity: float = C.CAPACITY_KWH, kafka: dict | None = None,
                      trigger: dict | None = None, max_files: int | None = None, history: DataFrame | None = None,
                      model=None, grid: int | None = None) -> StreamingQuery:
    """Telemetry -> features -> window prices + session lock -> stored prices
    and alerts, one query with four chained stateful operators.  ``history``
    (raw telemetry) gives the day-ahead price: its tariff is written once, when
    the job starts; ``model`` the prediction (the window's mean without one)."""
    tel = SQ.decode_telemetry(SQ.message_stream(spark, path=source, kafka=kafka, max_files=max_files))
    feats = SQ.features_stream(tel, window_minutes, capacity)
    priced = SQ.priced_stream(feats.select(*[f.name for f in SQ.FEATURE_ROW.fields], "time_bin"), grid)
    tariff = materialize(tariff_of(history, grid=grid)) if history is not None else None
    write = SQ.price_batch_writer(prices_path, alerts_path, capacity, tariff, model)
    return _start(priced, write, checkpoint, trigger)


def start_buffer_job(rows: DataFrame, path: str, checkpoint: str, keep: int, order: list[str], shards: int = 8,
                     ttl_ms: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """The newest ``keep`` rows of a stream; a shard that a batch changes is replaced as a whole."""
    def write(batch: DataFrame, _i: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    w = SQ.recent_stream(rows, keep, order, shards, ttl_ms).writeStream.outputMode("update").foreachBatch(write)
    w = w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"}))
    return start(rows.sparkSession, w)


def read_buffer(spark: SparkSession, path: str, keep: int, order: list[str]) -> DataFrame:
    return spark.read.parquet(path).drop("shard").orderBy(*[F.desc_nulls_last(c) for c in order]).limit(keep)


def start_changelog_job(msgs: DataFrame, schema, path: str, checkpoint: str, keys=("station_id", "time_bin"),
                        trigger: dict | None = None) -> StreamingQuery:
    """Messages (key, value, offset) of a keyed changelog merged into a table; of a
    key's records the one with the largest offset wins (a key has one partition)."""
    changes = MS.decode_changes(msgs, schema, keys)
    return _start(changes, lambda b, _i: merge_changes(b, path, "offset", keys), checkpoint, trigger)


def start_router_job(msgs: DataFrame, schemas: dict, required: dict, path: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    return _start(MS.routed_rows(msgs, schemas, required), lambda b, i: MS.write_routed(b, path, i), checkpoint, trigger)
