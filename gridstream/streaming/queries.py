"""Streaming query builders.

The batch operators' Column rules are reused unchanged; only the ordered
per-station steps become stateful processors (row frames and lag are not
supported on streams).  Sources are files (parquet / JSON lines) or Kafka
when its connector is on the classpath (the options are plain strings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstream import config as C
from gridstream import schemas as SC
from gridstream.functions.rules import (alert_level, dynamic_price, format_ts, hour_of, locked_price, parse_ts,
                                        price_multiplier, round_exact, snap, utilisation, weekday_of)
from gridstream.sources import message_log
from gridstream.streaming.processors import LATE, ROLLED, PreviousWindow, RecentRows, RollingClean, SessionLock

TELEMETRY_ROW = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("event_time", T.TimestampType()),
    T.StructField("time_new", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("kwh", T.DoubleType()),
])

WINDOW_ROW = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("window_start", T.TimestampType()),
    T.StructField("mean_kwh", T.DoubleType()), T.StructField("variance_kwh", T.DoubleType()),
    T.StructField("anomaly_flag", T.IntegerType()), T.StructField("data_completeness", T.DoubleType()),
    T.StructField("capacity_utilization_ratio", T.DoubleType()), T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
])
FEATURE_ROW = T.StructType(WINDOW_ROW.fields + [T.StructField("rate_of_change", T.DoubleType())])


# Telemetry messages from Kafka (options as strings), from a message
# log (``log``: path, topics, starting, group), or from a folder of JSON lines;
# bad records are skipped, as with ignore-parse-errors.
def message_stream(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                   max_files: int | None = None, log: dict | None = None) -> DataFrame:
    if log:
        return message_log.stream(spark, **log)
    if kafka:
        r = spark.readStream.format("kafka")
        for k, v in {"startingOffsets": "earliest", **kafka}.items():
            r = r.option(k, v)
        return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
    r = spark.readStream.schema("value string")
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.text(path).select(F.lit(None).cast("string").alias("key"), "value")


def decode_telemetry(msgs: DataFrame) -> DataFrame:
    rec = F.from_json("value", SC.TELEMETRY_TIMED, {"mode": "PERMISSIVE"})
    d = msgs.select(rec.alias("r")).select("r.*")
    d = (d.filter(F.col("station_id").isNotNull() & F.col("time_new").isNotNull())
          .fillna(0.0, subset=["duration", "kwh"])
          .withColumn("event_time", F.coalesce(F.timestamp_micros("event_us"), parse_ts("time_new")))        # S10
          .filter(F.col("event_time").isNotNull()))
    if "seq" not in d.columns:
        d = d.withColumn("seq", F.lit(0).cast("long"))
    return d.select("station_id", "event_time", "time_new", F.coalesce("seq", F.lit(0)).cast("long").alias("seq"),
                    "kwh")


# W01 + W03: watermark, then the timer-ordered rolling clean per station.
def rolling_clean_stream(tel: DataFrame, watermark: str = C.WATERMARK_DELAY,
                         rows: int = C.ROLLING_PRECEDING_ROWS, k: float = C.SIGMA_K) -> DataFrame:
    return (tel.withWatermark("event_time", watermark)
               .groupBy("station_id")
               .transformWithStateInPandas(statefulProcessor=RollingClean(rows, k), outputStructType=ROLLED,
                                           outputMode="Append", timeMode="EventTime",
                                           eventTimeColumnName="event_time"))


# Tumbling window, emitted once the watermark closes it (append).
def window_stream(rolled: DataFrame, window_minutes: int = C.WINDOW_MINUTES,
                  capacity: float = C.CAPACITY_KWH) -> DataFrame:
    positive = F.sum(F.when(F.col("original_kwh") > 0, F.lit(1)).otherwise(F.lit(0)))
    agg = (on_time(rolled).groupBy("station_id", F.window("event_time", f"{int(window_minutes)} minutes"))
                 .agg(F.avg("corrected_kwh").alias("mean_kwh"),
                      F.var_pop("corrected_kwh").alias("variance_kwh"),
                      F.max("anomaly_flag").cast("int").alias("anomaly_flag"),
                      (positive.cast("double") / F.count(F.lit(1))).alias("data_completeness")))
    return agg.select("station_id", F.col("window.start").alias("window_start"), "mean_kwh", "variance_kwh",
                      "anomaly_flag", "data_completeness",
                      utilisation("mean_kwh", capacity).alias("capacity_utilization_ratio"),
                      hour_of("window.start").alias("hour_of_day"),
                      weekday_of("window.start").alias("day_of_week"))


# W05 + W07: previous-window rate per station, giving the F14 vector.
def features_of_rolled(rolled: DataFrame, window_minutes: int = C.WINDOW_MINUTES,
                       capacity: float = C.CAPACITY_KWH) -> DataFrame:
    wins = window_stream(rolled, window_minutes, capacity)
    feats = (wins.groupBy("station_id")
                 .transformWithStateInPandas(statefulProcessor=PreviousWindow(window_minutes),
                                             outputStructType=FEATURE_ROW, outputMode="Append",
                                             timeMode="None"))
    return feats.select("station_id", format_ts("window_start").alias("time_bin"), "mean_kwh", "variance_kwh",
                        "rate_of_change", "capacity_utilization_ratio", "hour_of_day", "day_of_week",
                        "anomaly_flag", "data_completeness", "window_start")


def features_stream(tel: DataFrame, window_minutes: int = C.WINDOW_MINUTES,
                    capacity: float = C.CAPACITY_KWH, watermark: str = C.WATERMARK_DELAY) -> DataFrame:
    return features_of_rolled(rolling_clean_stream(tel, watermark), window_minutes, capacity)


# W05 as an interval join: the windows (station_id, window_start, mean_kwh) of one
# stream with those of a second reading of the same table, one width earlier.
# Both sides have a watermark and the time bound is two-sided, so the state holds
# windows of about ``delay`` and a width only.  A window without a predecessor
# leaves once the watermark tells that none can come.
def rate_by_join(windows: DataFrame, again: DataFrame, window_minutes: int = C.WINDOW_MINUTES, delay: str = C.WATERMARK_DELAY) -> DataFrame:
    width = F.expr(f"INTERVAL {int(window_minutes)} MINUTES")
    cur = windows.withWatermark("window_start", delay)
    prev = again.select(F.col("station_id").alias("_station"), F.col("window_start").alias("_start"),
                        F.col("mean_kwh").alias("_mean")).withWatermark("_start", delay)
    met = (F.col("station_id") == F.col("_station")) & (F.col("_start") >= F.col("window_start") - width) & (F.col("_start") <= F.col("window_start") - width)
    return (cur.join(prev, met, "left_outer")
            .withColumn("rate_of_change", F.coalesce(F.col("mean_kwh") - F.col("_mean"), F.lit(0.0))).drop("_station", "_start", "_mean"))


# D14 in a stream: the newest ``keep`` rows by ``order`` in the state of each of
# ``shards`` shards of stations; what a batch changes leaves as whole shards.
# The newest of all are among those of the shards.
def recent_stream(rows: DataFrame, keep: int, order: list[str], shards: int = 8, ttl_ms: int | None = None) -> DataFrame:
    d = rows.withColumn("shard", F.pmod(F.xxhash64("station_id"), F.lit(int(shards))).cast("int"))
    out = T.StructType([T.StructField("shard", T.IntegerType())] + rows.schema.fields)
    return d.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=RecentRows(rows.schema, keep, order, ttl_ms), outputStructType=out, outputMode="Update",
        timeMode="None" if ttl_ms is None else "ProcessingTime")


# F13 on a stream: data-quality side output of the rolling stage.
def data_quality_rows(rolled: DataFrame) -> DataFrame:
    return rolled.filter(F.col("anomaly_flag") == 1).select(
        "station_id", "time_new", "original_kwh", "corrected_kwh", "rolling_mean_kwh", "rolling_std_kwh",
        F.lit(C.ANOMALY_REASON).alias("reason"))


def on_time(rolled: DataFrame) -> DataFrame:
    return rolled.filter(F.col("anomaly_flag") != LATE)


PRICED_ROW = T.StructType(FEATURE_ROW.fields + [
    T.StructField("time_bin", T.StringType()), T.StructField("price_multiplier", T.DoubleType()),
    T.StructField("dynamic_price_cad", T.DoubleType()), T.StructField("alert_level", T.StringType()),
    T.StructField("guaranteed_price_cad", T.DoubleType()), T.StructField("session_status", T.StringType()),
])


# Window rules + the session lock as per-station state.
def priced_stream(features: DataFrame, grid: int | None = None) -> DataFrame:
    m = price_multiplier("capacity_utilization_ratio", grid=grid)
    d = features.select(*[f.name for f in FEATURE_ROW.fields], "time_bin",
                        round_exact(m, 4).alias("price_multiplier"), dynamic_price(m).alias("dynamic_price_cad"),
                        alert_level("capacity_utilization_ratio", grid=grid).alias("alert_level"),
                        locked_price(dynamic_price(m)).alias("lock_offer"),
                        round_exact(F.lit(C.BASE_PRICE_CAD * C.GUARANTEE_PREMIUM), 4).alias("idle_price"))
    return (d.groupBy("station_id")
             .transformWithStateInPandas(statefulProcessor=SessionLock(), outputStructType=PRICED_ROW,
                                         outputMode="Append", timeMode="None"))


# Per micro-batch the complete priced row (prediction, base and day-ahead
# price), station alerts, and regional alerts of the batch's time bins over all
# stored rows; idempotent writes keyed by the batch id.  ``tariff`` (P08) is a
# table made before the stream starts.
def price_batch_writer(prices_path: str, alerts_path: str, capacity: float = C.CAPACITY_KWH, tariff: DataFrame | None = None,
                       model=None):
    from gridstream.operators import pricing as PR
    from gridstream.operators.alerts import alert_stream, grid_stress_by_bin, regional_alerts, station_alerts
    from gridstream.operators.model import score
    from gridstream.sources.sinks import append_batch

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = score(model, batch) if model is not None else batch.withColumn("predicted_kwh", round_exact("mean_kwh", 4))
        rows = rows.withColumn("base_price_cad", F.lit(float(C.BASE_PRICE_CAD)))
        if tariff is not None:
            rows = PR.with_tariff(rows, tariff)
        else:
            rows = rows.withColumn("day_ahead_price_cad", F.lit(None).cast("double"))
        append_batch(rows, prices_path, batch_id)
        stored = spark.read.schema(rows.withColumn("batch_id", F.lit(0)).schema).parquet(prices_path)
        own = stored.filter(F.col("batch_id") == int(batch_id))
        bins = stored.join(own.select("window_start").distinct(), "window_start", "left_semi")
        append_batch(alert_stream(station_alerts(own), regional_alerts(grid_stress_by_bin(bins, capacity))), alerts_path, batch_id)
    return write


# Regional score per bin on the priced stream (event-time group by bin).
def grid_stress_stream(priced: DataFrame, capacity: float = C.CAPACITY_KWH,
                       threshold: float = C.GRID_THRESHOLD, watermark: str = "15 minutes") -> DataFrame:
    cur = round_exact("mean_kwh", 4) / F.lit(float(capacity))
    g = (priced.withWatermark("window_start", watermark)
               .groupBy("window_start").agg(F.avg(cur).alias("stress_score"),
                                            F.count(F.lit(1)).cast("int").alias("station_count")))
    return g.select(format_ts("window_start").alias("time_bin"), "stress_score", "station_count",
                    (snap("stress_score") > F.lit(float(threshold))).alias("triggered_alert"))


# Readings behind the watermark: those that the rolling stage passed on
# with the LATE flag, and those that the engine's own stateful operators dropped
# (counted from the query's progress, see ``counting``).
def late_readings(rolled: DataFrame) -> DataFrame:
    return rolled.filter(F.col("anomaly_flag") == LATE).select("station_id", "event_time", "time_new", "seq", "kwh")


# D15 on a stream: the readings seen, as an observed count of every micro-batch.
SEEN = "seen.readings"


def observed(tel: DataFrame) -> DataFrame:
    return tel.observe("seen", F.count(F.lit(1)).alias("readings"))
