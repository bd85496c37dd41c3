"""Pricing operators (P04-P09): rated power, history lookup, day-ahead price,
session lock, and the complete priced row.

The per-window rules (P01-P03) are Column builders in
:mod:`gridstream.functions.rules`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.functions.rules import (alert_level, dynamic_price, hour_of, locked_price,
                                        price_multiplier, round_exact, weekday_of)


# Capacity baseline = 95th percentile (linear interpolation) of the
# stations' mean readings.  Stations are counted by ranges of value (on a
# logarithmic scale, 256 to an octave), a running sum over those few ranges
# finds the ones that hold the two neighbouring ranks, and only their stations
# are ordered.
def rated_power(tel: DataFrame, q: float = C.RATED_POWER_QUANTILE, key: str = "station_id",
                value: str = "kwh") -> DataFrame:
    means = tel.groupBy(key).agg(F.avg(value).alias("_m")).where("_m is not null")
    placed = means.withColumn("_r", F.floor(F.signum("_m") * F.log2(F.abs("_m") + F.lit(1.0)) * F.lit(256.0)))
    counts = placed.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))
    every = Window.orderBy("_r")
    summed = counts.select("_r", "_n", F.coalesce(F.sum("_n").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                           (F.lit(float(q)) * (F.sum("_n").over(Window.partitionBy()) - F.lit(1))).alias("_rank"))
    wanted = summed.where((F.col("_off") <= F.ceil("_rank")) & (F.col("_off") + F.col("_n") > F.floor("_rank")))
    at = F.col("_off") + F.row_number().over(Window.partitionBy("_r").orderBy("_m")) - F.lit(1)
    some = placed.join(wanted.drop("_n"), "_r").withColumn("_at", at)
    a = F.max(F.when(F.col("_at") == F.floor("_rank"), F.col("_m")))
    b = F.max(F.when(F.col("_at") == F.ceil("_rank"), F.col("_m")))
    return some.agg((a + (b - a) * (F.max("_rank") - F.floor(F.max("_rank")))).alias("rated_kw"))


# History lookup (station, hour, weekday) -> mean reading.
def history_lookup(tel: DataFrame, key: str = "station_id", ts: str = "event_time",
                   value: str = "kwh") -> DataFrame:
    return (tel.groupBy(F.col(key).alias("station_id"), hour_of(ts).alias("hour_of_day"),
                        weekday_of(ts).alias("day_of_week"))
               .agg(F.avg(value).alias("hist_avg_kwh")))


# P06a + P08: day-ahead price of each station, hour and weekday (at most 168
# rows per station).  Each step is a column of its own, so the rated power, a
# scalar subquery, stands in the plan once.
def day_ahead_tariff(lookup: DataFrame, rated: Column | float, base: float = C.BASE_PRICE_CAD, grid: int | None = None) -> DataFrame:
    rated = F.lit(float(rated)) if isinstance(rated, (int, float)) else rated
    return (lookup.withColumn("_rated", rated).withColumn("_rel", F.col("hist_avg_kwh") / F.col("_rated"))
            .withColumn("_raw", F.lit(float(base)) * price_multiplier("_rel", grid=grid))
            .select("station_id", "hour_of_day", "day_of_week", round_exact("_raw", 4).alias("_da")))


# The rows with the tariff's price; a miss falls back to the base price.  The
# join strategy is left to AQE (broadcast when its runtime size allows).
def with_tariff(rows: DataFrame, tariff: DataFrame, base: float = C.BASE_PRICE_CAD) -> DataFrame:
    j = rows.join(tariff, on=["station_id", "hour_of_day", "day_of_week"], how="left")
    price = F.coalesce(F.col("_da"), round_exact(F.lit(float(base)), 4))
    return j.withColumn("day_ahead_price_cad", price).drop("_da")


def with_day_ahead(rows: DataFrame, lookup: DataFrame, rated: Column | float,
                   base: float = C.BASE_PRICE_CAD, grid: int | None = None) -> DataFrame:
    return with_tariff(rows, day_ahead_tariff(lookup, rated, base, grid), base)


def tariff_of(history: DataFrame, base: float = C.BASE_PRICE_CAD, grid: int | None = None) -> DataFrame:
    """The tariff of raw telemetry."""
    return day_ahead_tariff(history_lookup(history), rated_power(history).scalar(), base, grid)


# Session lock per station in window order.
#   idle -> active : lock = round(dynamic * 1.1, 4), "session_started"
#   active -> active: keep the lock, "session_ongoing"
#   otherwise       : round(base * 1.1, 4), "idle"
# A run of active windows always begins with its start, so the lock of a row
# is the last start price seen so far.  The window runs over one row per
# station and time bin (bounded by the time span, not by readings).
def with_session(rows: DataFrame, cur: str = "capacity_utilization_ratio",
                 dynamic: str = "dynamic_price_cad", order: str = "window_start",
                 key: str = "station_id", base: float = C.BASE_PRICE_CAD,
                 premium: float = C.GUARANTEE_PREMIUM) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    active = F.col(cur) > 0
    prev = F.coalesce(F.lag(active, 1).over(w), F.lit(False))
    d = (rows.withColumn("_active", active).withColumn("_prev", prev)
             .withColumn("_start", F.col("_active") & ~F.col("_prev")))
    lock = F.last(F.when(F.col("_start"), locked_price(dynamic, premium)), ignorenulls=True) \
            .over(w.rowsBetween(Window.unboundedPreceding, 0))
    idle_price = round_exact(F.lit(float(base)) * F.lit(float(premium)), 4)
    return (d.withColumn("guaranteed_price_cad", F.when(F.col("_active"), lock).otherwise(idle_price))
             .withColumn("session_status",
                         F.when(F.col("_start"), F.lit("session_started"))
                          .when(F.col("_active"), F.lit("session_ongoing"))
                          .otherwise(F.lit("idle")))
             .drop("_active", "_prev", "_start"))


PRICE_OUT = ["station_id", "time_bin", "predicted_kwh", "price_multiplier", "base_price_cad",
             "dynamic_price_cad", "guaranteed_price_cad", "session_status",
             "day_ahead_price_cad", "alert_level"]


# Complete priced row from a feature vector.  ``predicted`` is the
# prediction column (M02 output); the default is the persistence forecast
# (this window's mean), which SQL can check.
def price_features(features: DataFrame, history: DataFrame | None, predicted: Column | None = None,
                   base: float = C.BASE_PRICE_CAD, premium: float = C.GUARANTEE_PREMIUM,
                   rated: Column | float | None = None, keep_start: bool = False,
                   lookup: DataFrame | None = None, grid: int | None = None, day_ahead: bool = True) -> DataFrame:
    """``history`` is raw telemetry; a precomputed ``lookup`` (P05) and
    ``rated`` (P04) may be passed instead, as the pricing service builds them
    once at start-up."""
    pred = predicted if predicted is not None else F.col("mean_kwh")
    cur = F.col("capacity_utilization_ratio")
    d = (features.withColumn("predicted_kwh", round_exact(pred, 4))
                 .withColumn("_mult", price_multiplier(cur, grid=grid))
                 .withColumn("price_multiplier", round_exact("_mult", 4))
                 .withColumn("base_price_cad", F.lit(float(base)))
                 .withColumn("dynamic_price_cad", dynamic_price("_mult", base))
                 .withColumn("alert_level", alert_level(cur, grid=grid)))
    d = with_session(d, base=base, premium=premium)
    if day_ahead:
        rated = rated if rated is not None else rated_power(history).scalar()
        d = with_day_ahead(d, lookup if lookup is not None else history_lookup(history), rated, base, grid)
    else:      # for what doesn't read that price: no lookup in the plan
        d = d.withColumn("day_ahead_price_cad", F.lit(None).cast("double"))
    extra = ([c for c in ("window_start", "last_event_time", "capacity_utilization_ratio")
              if c in d.columns] if keep_start else [])
    return d.select(*PRICE_OUT, *extra)
