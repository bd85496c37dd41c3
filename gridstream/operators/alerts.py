"""Alert operators (A01-A05): station alerts, regional grid stress, alert stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.functions.rules import format_ts, snap

STATION_ALERT_COLS = ["type", "station_id", "time_bin", "alert_level", "predicted_kwh",
                      "price_multiplier", "dynamic_price_cad", "guaranteed_price_cad"]


# Critical priced rows become station alerts; message key defaults to
# "unknown" when the station is missing.
def station_alerts(priced: DataFrame, level: str = "critical", keep=()) -> DataFrame:
    return (priced.filter(F.col("alert_level") == F.lit(level))
                  .select(F.lit("station").alias("type"), *STATION_ALERT_COLS[1:],
                          F.coalesce(F.col("station_id"), F.lit("unknown")).alias("key"), *keep))


# Regional score per time bin = mean(predicted / capacity) over rows
# with a prediction; bins without one give no row.  Plain grouped
# aggregation: partial aggregates shuffle, not rows.
def grid_stress_by_bin(priced: DataFrame, capacity: float = C.CAPACITY_KWH,
                       threshold: float = C.GRID_THRESHOLD, bin_col: str = "window_start") -> DataFrame:
    cur = F.col("predicted_kwh") / F.lit(float(capacity))
    g = (priced.filter(F.col("predicted_kwh").isNotNull())
               .groupBy(bin_col)
               .agg(F.avg(cur).alias("stress_score"),
                    F.count(F.lit(1)).cast("int").alias("station_count")))
    return (g.filter(F.col("station_count") > 0)
             .withColumn("triggered_alert", snap("stress_score") > F.lit(float(threshold)))
             .withColumnRenamed(bin_col, "time_bin_ts")
             .withColumn("time_bin", format_ts("time_bin_ts")))


# The same score for the latest bin only (bin = max over all rows,
# taken as a scalar subquery).
def grid_stress_latest(priced: DataFrame, capacity: float = C.CAPACITY_KWH,
                       threshold: float = C.GRID_THRESHOLD, bin_col: str = "window_start") -> DataFrame:
    latest = priced.agg(F.max(bin_col)).scalar()
    return grid_stress_by_bin(priced.filter(F.col(bin_col) == latest), capacity, threshold, bin_col)


# Regional alert records from triggered bins.
def regional_alerts(grid: DataFrame, keep=()) -> DataFrame:
    return (grid.filter(F.col("triggered_alert"))
                .select(F.lit("regional").alias("type"), "time_bin", "stress_score", "station_count",
                        F.lit("regional").alias("key"), *keep))


# One alert stream fed by both kinds (missing columns are NULL).
def alert_stream(station: DataFrame, regional: DataFrame) -> DataFrame:
    return station.unionByName(regional, allowMissingColumns=True)

