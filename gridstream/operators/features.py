"""Feature operators: cleaning, tumbling aggregates, previous window.

Streaming-parity features (F14) follow the stream job: corrected kWh,
population variance, previous window exactly one width earlier.  Offline
features (F15/F16) follow the training script: raw kWh, sample variance,
difference to the previous *existing* window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.functions.rules import (bin_start, corrected_value, format_ts, hour_of,
                                        three_sigma_flag, utilisation, weekday_of)
from gridstream.operators.series import ordered_window


# F01 + F02: rolling mean and population std over ROWS n PRECEDING..CURRENT,
# per station in event time (ties by ``seq``).  Hot stations are split into
# blocks with an n-row halo (see operators.series).
def rolling_stats(tel: DataFrame, rows: int = C.ROLLING_PRECEDING_ROWS, key: str = "station_id",
                  order=("event_time", "seq"), value: str = "kwh", *,
                  block_rows: int = C.ROLLING_BLOCK_ROWS, mode: str = "blocked") -> DataFrame:
    def compute(d, w):
        frame = w.rowsBetween(-int(rows), 0)
        return (d.withColumn("rolling_mean_kwh", F.avg(value).over(frame))
                 .withColumn("rolling_std_kwh", F.stddev_pop(value).over(frame)))
    return ordered_window(tel, key, list(order), compute, halo_before=int(rows),
                          block_rows=block_rows, mode=mode)


# F03 + F04 on top of F01/F02.
def clean_readings(tel: DataFrame, rows: int = C.ROLLING_PRECEDING_ROWS, k: float = C.SIGMA_K,
                   **kw) -> DataFrame:
    return (rolling_stats(tel, rows, **kw)
            .withColumn("anomaly_flag", three_sigma_flag("kwh", "rolling_mean_kwh", "rolling_std_kwh", k))
            .withColumn("original_kwh", F.col("kwh"))
            .withColumn("corrected_kwh", corrected_value("kwh", "rolling_mean_kwh", "anomaly_flag")))


# Tumbling window per station over cleaned readings.  Grouping on
# an explicit ``window_start`` column keeps the output hash-partitioned on
# (station_id, window_start), which the previous-window join then reuses.
def window_features(cleaned: DataFrame, window_minutes: int = C.WINDOW_MINUTES,
                    capacity: float = C.CAPACITY_KWH, key: str = "station_id") -> DataFrame:
    positive = F.sum(F.when(F.col("original_kwh") > 0, F.lit(1)).otherwise(F.lit(0)))
    agg = (cleaned.withColumn("window_start", bin_start("event_time", window_minutes))
                  .groupBy(key, "window_start")
                  .agg(F.avg("corrected_kwh").alias("mean_kwh"),
                       F.var_pop("corrected_kwh").alias("variance_kwh"),
                       F.max("anomaly_flag").cast("int").alias("anomaly_flag"),
                       (positive.cast("double") / F.count(F.lit(1))).alias("data_completeness"),
                       F.max("event_time").alias("last_event_time")))
    return (agg.withColumn("capacity_utilization_ratio", utilisation("mean_kwh", capacity))
               .withColumn("hour_of_day", hour_of("window_start"))
               .withColumn("day_of_week", weekday_of("window_start")))


# Previous window of the same station exactly one width earlier; a
# gap gives NULL -> rate 0.  Written as lag + exact-gap check rather than the
# reference's self-join: the self-join would re-run the whole rolling plan on
# its build side (pruned differently, so no exchange reuse), while lag runs
# on the aggregate's existing station partitioning.  It orders one row per
# station-window, bounded by the time span, not by the number of readings.
# ``self_join=True`` gives the equi-join form (used by streaming and tests).
def with_previous_window(wf: DataFrame, window_minutes: int = C.WINDOW_MINUTES,
                         key: str = "station_id", self_join: bool = False) -> DataFrame:
    width = F.expr(f"INTERVAL {int(window_minutes)} MINUTES")
    if self_join:
        prv = wf.select(F.col(key).alias("_pk"), F.col("window_start").alias("_ps"),
                        F.col("mean_kwh").alias("_prev_mean"))
        shifted = F.col("window_start") - width
        j = wf.join(prv, (F.col(key) == F.col("_pk")) & (F.col("_ps") == shifted), "left") \
              .drop("_pk", "_ps")
    else:
        w = Window.partitionBy(key).orderBy("window_start")
        hit = F.lag("window_start", 1).over(w) == F.col("window_start") - width
        j = wf.withColumn("_prev_mean", F.when(hit, F.lag("mean_kwh", 1).over(w)))
    return (j.withColumn("previous_mean_kwh", F.coalesce(F.col("_prev_mean"), F.col("mean_kwh")))
             .withColumn("rate_of_change", F.col("mean_kwh") - F.col("previous_mean_kwh"))
             .drop("_prev_mean"))


FEATURE_OUT = ["station_id", "time_bin", "mean_kwh", "variance_kwh", "rate_of_change",
               "capacity_utilization_ratio", "hour_of_day", "day_of_week", "anomaly_flag",
               "data_completeness"]


# the full streaming-parity feature vector, keyed (station_id, time_bin).
def stream_features(tel: DataFrame, window_minutes: int = C.WINDOW_MINUTES,
                    capacity: float = C.CAPACITY_KWH, rows: int = C.ROLLING_PRECEDING_ROWS,
                    k: float = C.SIGMA_K, keep_start: bool = False, **kw) -> DataFrame:
    wf = window_features(clean_readings(tel, rows, k, **kw), window_minutes, capacity)
    out = with_previous_window(wf, window_minutes).withColumn("time_bin", format_ts("window_start"))
    return out.select(*FEATURE_OUT, *(["window_start", "last_event_time"] if keep_start else []))


# data-quality side output: flagged readings with a fixed reason.
def data_quality_rows(cleaned: DataFrame, reason: str = C.ANOMALY_REASON) -> DataFrame:
    return (cleaned.filter(F.col("anomaly_flag") == 1)
                   .select("station_id", "time_new", "original_kwh", "corrected_kwh",
                           "rolling_mean_kwh", "rolling_std_kwh", F.lit(reason).alias("reason")))


# offline feature group (raw kWh, sample variance with NULL -> 0).
def offline_windows(tel: DataFrame, window_minutes: int = C.WINDOW_MINUTES,
                    capacity: float = C.CAPACITY_KWH, key: str = "station_id") -> DataFrame:
    positive = F.sum(F.when(F.col("kwh") > 0, F.lit(1)).otherwise(F.lit(0)))
    agg = (tel.withColumn("window_start", bin_start("event_time", window_minutes))
              .groupBy(key, "window_start")
              .agg(F.avg("kwh").alias("mean_kwh"),
                   F.coalesce(F.var_samp("kwh"), F.lit(0.0)).alias("variance_kwh"),
                   (positive.cast("double") / F.count(F.lit(1))).alias("data_completeness")))
    return (agg.withColumn("capacity_utilization_ratio", utilisation("mean_kwh", capacity))
               .withColumn("hour_of_day", hour_of("window_start"))
               .withColumn("day_of_week", weekday_of("window_start"))
               .withColumn("anomaly_flag", F.lit(0)))


# F16: difference to the previous existing window of the station (0 first).
# The per-station window runs over aggregated windows, whose count per
# station is bounded by the time span, not by the number of readings.
def station_order(key: str = "station_id", ts: str = "window_start"):
    return Window.partitionBy(key).orderBy(ts)


def with_diff(wins: DataFrame, key: str = "station_id") -> DataFrame:
    w = station_order(key)
    return wins.withColumn("rate_of_change",
                           F.coalesce(F.col("mean_kwh") - F.lag("mean_kwh", 1).over(w), F.lit(0.0)))


# target = mean of the window h steps later; rows without one dropped.
def with_target(wins: DataFrame, horizon: int = 1, key: str = "station_id") -> DataFrame:
    w = station_order(key)
    return (wins.withColumn("target", F.lead("mean_kwh", int(horizon)).over(w))
                .filter(F.col("target").isNotNull()))


# F15-F17 composed: the training table of the offline model.
def training_table(tel: DataFrame, horizon: int = 1, window_minutes: int = C.WINDOW_MINUTES,
                   capacity: float = C.CAPACITY_KWH) -> DataFrame:
    wins = offline_windows(tel, window_minutes, capacity)
    w = station_order()
    return (wins.withColumn("rate_of_change",
                            F.coalesce(F.col("mean_kwh") - F.lag("mean_kwh", 1).over(w), F.lit(0.0)))
                .withColumn("target", F.lead("mean_kwh", int(horizon)).over(w))
                .filter(F.col("target").isNotNull()))


# reduced feature set built from a CUR series (evaluation forecaster):
# variance = (0.1 * mean)^2, rate = difference to window t-1 of the dense
# series (a window without a row counts as 0; window 0 has rate 0),
# completeness 1, flag 0.
def reduced_features(series: DataFrame, key=("scenario_id", "station_id"), t: str = "t",
                     cur: str = "cur_obs", capacity: str = "capacity") -> DataFrame:
    w = Window.partitionBy(*key).orderBy(t)
    mean = F.col(cur) * F.col(capacity)
    prev = F.when(F.lag(t, 1).over(w) == F.col(t) - 1, F.lag("mean_kwh", 1).over(w))
    rate = F.when(F.col(t) == 0, F.lit(0.0)).otherwise(F.col("mean_kwh") - F.coalesce(prev, F.lit(0.0)))
    return (series.withColumn("mean_kwh", mean)
                  .withColumn("variance_kwh", F.pow(F.lit(0.1) * F.col("mean_kwh"), 2))
                  .withColumn("rate_of_change", rate)
                  .withColumn("capacity_utilization_ratio", F.col(cur))
                  .withColumn("data_completeness", F.lit(1.0))
                  .withColumn("anomaly_flag", F.lit(0)))
