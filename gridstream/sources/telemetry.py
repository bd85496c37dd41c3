"""Telemetry scans and their clean-up steps.

All functions return lazily-planned DataFrames; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream import schemas
from gridstream.functions.rules import bin_start, format_ts, parse_ts


# Typed scan of a telemetry trace (csv with header, or parquet/json).
def read_trace(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(schemas.TELEMETRY).option("header", True).csv(path)
    return spark.read.schema(schemas.TELEMETRY).format(fmt).load(path)


# S03 + S04: drop rows without key columns, default-fill measures, key as text.
def clean_telemetry(df: DataFrame) -> DataFrame:
    return (df.dropna(subset=["station_id", "time_new"])
              .withColumn("station_id", F.col("station_id").cast("string"))
              .fillna(0.0, subset=["duration", "kwh"]))


# Computed event-time column; unparsable text becomes NULL and is dropped.
def with_event_time(df: DataFrame, text_col: str = "time_new") -> DataFrame:
    return (df.withColumn("event_time", parse_ts(text_col))
              .filter(F.col("event_time").isNotNull()))


# Time order within each partition (no global sort, no shuffle).
def time_ordered(df: DataFrame, key: str = "station_id",
                 order=("event_time",)) -> DataFrame:
    return df.sortWithinPartitions(key, *order)


# First n rows in a defined order (0 = all rows).  The reference caps by
# file order; a distributed file has no such order, so the order is explicit
# and ends with a unique column.  Rows are counted by time slice; slices wholly
# before the cut are kept by a semi-join, and only the slice that holds the cut
# is ranked, so no task ever holds n rows.  Rows without a time come first.
def cap_rows(df: DataFrame, n: int, order=("event_time", "station_id", "seq"), slice_minutes: int = 60) -> DataFrame:
    if not n or n <= 0:
        return df
    d = df.withColumn("_s", F.coalesce(F.unix_seconds(bin_start(order[0], slice_minutes)), F.lit(-(1 << 62))))
    counts = d.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"))   # one row per time slice
    before = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    cut = counts.withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_b") < F.lit(int(n)))
    whole = d.join(cut.where(F.col("_b") + F.col("_n") <= F.lit(int(n))).select("_s"), "_s", "left_semi")
    part = (d.join(cut.where(F.col("_b") + F.col("_n") > F.lit(int(n))).select("_s", "_b"), "_s")
             .withColumn("_r", F.row_number().over(Window.partitionBy("_s").orderBy(*order)))
             .filter(F.col("_r") <= F.lit(int(n)) - F.col("_b")).drop("_b", "_r"))
    return whole.unionByName(part).drop("_s")


# Keep the first n stations by first appearance (ties by station id).
# The kept-station table holds at most n rows; how it is joined is left to
# Spark, which knows its size.
def cap_stations(df: DataFrame, n: int, key: str = "station_id",
                 ts: str = "event_time") -> DataFrame:
    if not n or n <= 0:
        return df
    first = (df.groupBy(key).agg(F.min(ts).alias("_first"))
               .orderBy("_first", key).limit(int(n)).select(key))
    return df.join(first, on=key, how="left_semi")


# Replay schedule.  gap = positive time step to the station's previous
# reading; offset_s = running sum of gap / speed (speed 0 = no delay).  In
# time order every step is >= 0, so the running sum telescopes to
# (t - first t of the station) / speed: one partial aggregate, no ordered
# pass over a station.
def replay_offsets(df: DataFrame, speed: float, key: str = "station_id",
                   ts: str = "event_time") -> DataFrame:
    first = df.groupBy(key).agg(F.min(ts).alias("_t0"))
    secs = (F.unix_micros(F.col(ts)) - F.unix_micros(F.col("_t0"))) / F.lit(1e6)
    off = F.lit(0.0) if not speed else secs / F.lit(float(speed))
    return df.join(first, on=key, how="inner").withColumn("offset_s", off).drop("_t0")


# ---------------------------------------------------------------------------
# Views over the driver's `events` table (FIXTURES.md profiles A and B).
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Profile:
    name: str
    station_mod: int | None      # station_id = user_id % mod, or user_id
    window_minutes: int
    capacity: float


PROFILE_A = Profile("A", 15, 360, 45.0)     # dense: 15 stations, 6-hour windows
PROFILE_B = Profile("B", None, 15, 100.0)   # sparse: one station per user, 15 min
PROFILE_E = Profile("E", 100, 360, 45.0)    # evaluation: 100 stations (20 per scenario), 6-hour windows
PROFILE_S = Profile("S", 350, 360, 45.0)    # station sweep: 350 stations (70 per scenario), 6-hour windows


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps are zone-less wall-clock values: bins, hours and text
    forms are only stable with a UTC session zone."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def telemetry_view(events: DataFrame, profile: Profile = PROFILE_A) -> DataFrame:
    """events -> (station_id, time_new, duration, kwh, event_time, seq).

    ``ts`` is TIMESTAMP_NTZ in the files; it is cast to TIMESTAMP (session
    zone UTC) because watermarks require it.  ``seq`` (event_id) breaks ties.
    """
    uid = F.col("user_id")
    station = (uid % F.lit(profile.station_mod)) if profile.station_mod else uid
    return (events
            .filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
            .select(
                station.cast("string").alias("station_id"),
                F.col("ts").cast("timestamp").alias("event_time"),
                F.coalesce(F.when(F.col("event_type").isin("view", "signup"), F.lit(0.0))
                            .otherwise(F.col("value")), F.lit(0.0)).alias("kwh"),
                F.lit(0.0).alias("duration"),
                F.col("event_id").alias("seq"))
            .withColumn("time_new", format_ts("event_time")))


def load_telemetry(spark: SparkSession, sf_dir: str, profile: Profile = PROFILE_A) -> DataFrame:
    return telemetry_view(load_table(spark, sf_dir, "events"), profile)
