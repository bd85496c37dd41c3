"""Dashboard queries (D01-D18) over priced messages, stored rows and alerts.

The dashboard works on bounded buffers by design (last 5000 prices, last 500
alerts, 12 hours / 5000 stored rows, 50 grid rows); those limits are the
feature and are taken as distributed top-k (TakeOrderedAndProject) over the
whole input.  Everything else is grouped aggregation or per-key windows
over at most two rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.functions.rules import parse_ts, stress_band

HISTORY_COLS = ["station_id", "time_bin", "predicted_kwh", "price_multiplier", "alert_level",
                "guaranteed_price_cad", "day_ahead_price_cad"]
STATUS_COLS = ["station_id", "time_bin", "predicted_kwh", "price_multiplier",
               "guaranteed_price_cad", "day_ahead_price_cad", "alert_level"]


# Message view of priced windows: stored/emitted when the window closes
# (created_at), Kafka time = last reading of the window, arrival = window end
# plus the watermark delay (the moment an event-time stream emits the row).
def price_messages(priced: DataFrame, width_minutes: int = C.WINDOW_MINUTES,
                   watermark_seconds: int = 30) -> DataFrame:
    end_ms = F.unix_millis("window_start") + F.lit(int(width_minutes) * 60000)
    return (priced
            .withColumn("created_at", F.col("window_start") + F.expr(f"INTERVAL {int(width_minutes)} MINUTES"))
            .withColumn("kafka_ts_ms", F.unix_millis("last_event_time"))
            .withColumn("arrival_ms", end_ms + F.lit(int(watermark_seconds) * 1000)))


# Bounded buffer = newest n messages by arrival (ties by station).
def last_by_arrival(msgs: DataFrame, n: int = C.PRICE_BUFFER_SIZE,
                    order=("arrival_ms", "station_id")) -> DataFrame:
    return msgs.orderBy(*[F.col(c).desc() for c in order]).limit(int(n))


# Stored rows created within `hours` of `now`, newest bins first, capped.
# `now` defaults to the newest created_at (deterministic replays).
def recent_history(stored: DataFrame, now=None, hours: int = C.HISTORY_HOURS,
                   limit: int = C.HISTORY_LIMIT) -> DataFrame:
    now = now if now is not None else stored.agg(F.max("created_at")).scalar()
    now = F.lit(now) if not hasattr(now, "alias") else now
    lo = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    return (stored.filter(F.col("created_at") >= lo)
                  .orderBy(F.col("time_bin").desc(), F.col("station_id").asc())
                  .limit(int(limit))
                  .select(*HISTORY_COLS, "created_at"))


# Union by name, missing columns NULL; tagged with the source.
def union_live_history(live: DataFrame, hist: DataFrame) -> DataFrame:
    return (live.withColumn("_src", F.lit(0))
                .unionByName(hist.withColumn("_src", F.lit(1)), allowMissingColumns=True))


# Station as text, time_bin as timestamp; unparsable rows dropped.
def coerce_keys(df: DataFrame) -> DataFrame:
    tb = F.col("time_bin")
    ts = tb if dict(df.dtypes).get("time_bin", "").startswith("timestamp") else parse_ts(tb)
    return (df.withColumn("station_id", F.col("station_id").cast("string"))
              .withColumn("time_bin", ts).filter(F.col("time_bin").isNotNull()))


# One row per (station, time_bin); the stored (history) row wins.
def dedupe_latest(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("station_id", "time_bin").orderBy(F.col("_src").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def combined(live: DataFrame, hist: DataFrame) -> DataFrame:
    return dedupe_latest(coerce_keys(union_live_history(live, hist)))


# Latest row per station: a max_by aggregate (partial aggregation keeps a
# busy station from landing whole in one task).
def latest_per_station(df: DataFrame, key: str = "station_id", order: str = "time_bin") -> DataFrame:
    others = [c for c in df.columns if c != key]
    top = F.max_by(F.struct(*others), F.col(order)).alias("_r")
    return df.groupBy(key).agg(top).select(key, "_r.*")


# KPI row with the dashboard defaults when empty.
def kpis(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count_distinct("station_id").alias("active_stations"),
        F.coalesce(F.avg("predicted_kwh"), F.lit(0.0)).alias("avg_predicted_kwh"),
        F.coalesce(F.avg("price_multiplier"), F.lit(1.0)).alias("avg_price_multiplier"),
        F.coalesce(F.count_if(F.col("alert_level") == "critical"), F.lit(0)).cast("long")
         .alias("critical_count"))


# Newest n grid rows, shown ascending.
def grid_trend(grid: DataFrame, n: int = C.GRID_TREND_LIMIT, ts: str = "time_bin_ts") -> DataFrame:
    return grid.orderBy(F.col(ts).desc()).limit(int(n)).orderBy(ts)


# D06 + D07: current stress = newest grid row, else mean(predicted)/capacity
# of the latest rows, else 0; with its dashboard band.
def current_stress(grid: DataFrame, latest: DataFrame, capacity: float = C.CAPACITY_KWH,
                   ts: str = "time_bin_ts") -> DataFrame:
    newest = grid.agg(F.max_by("stress_score", ts)).scalar()
    fallback = latest.agg(F.avg("predicted_kwh") / F.lit(float(capacity))).scalar()
    spark = latest.sparkSession
    score = F.coalesce(newest, fallback, F.lit(0.0))
    return (spark.range(1).select(score.alias("grid_stress_score"))
                 .withColumn("band", stress_band("grid_stress_score")))


# The latency buffer holds the newest n samples that count (those outside
# (-1000, 600000) ms or with no positive message time never enter it); mean,
# and p95 = sorted[int(0.95 k) - 1] when k >= 20 samples are there.  The
# buffer is bounded by n, so its order fits one task.
def latency_stats(msgs: DataFrame, latency: str = "latency_ms", msg_ts: str = "kafka_ts_ms",
                  n: int = C.PRICE_BUFFER_SIZE, order=("arrival_ms", "station_id"), q: float = 0.95,
                  min_n: int = C.P95_MIN_SAMPLES) -> DataFrame:
    from gridstream.functions.rules import latency_ok
    kept = last_by_arrival(msgs.filter(latency_ok(latency, msg_ts)), n, order)
    held = kept.agg(F.sort_array(F.collect_list(F.col(latency).cast("double"))).alias("_l"), F.avg(latency).alias("avg_latency_ms"))
    k = F.floor(F.lit(float(q)) * F.size("_l")).cast("int")
    return held.select("avg_latency_ms", F.when(F.size("_l") >= F.lit(int(min_n)), F.get("_l", k - 1)).alias("p95_latency_ms"),
                       F.size("_l").cast("long").alias("n_samples"))


# Heatmap over the newest n distinct bins; label HH:mm (the same label
# on two days merges, as on the dashboard).  Long form; `heatmap_pivot` is
# the wide form.
def heatmap_long(df: DataFrame, n: int = C.HEATMAP_WINDOWS, value: str = "predicted_kwh") -> DataFrame:
    bins = df.select("time_bin").distinct().orderBy(F.col("time_bin").desc()).limit(int(n))
    sel = df.join(F.broadcast(bins), on="time_bin", how="left_semi")
    return (sel.withColumn("time_label", F.date_format("time_bin", "HH:mm"))
               .groupBy("station_id", "time_label").agg(F.avg(value).alias("mean_value")))


def time_labels(width_minutes: int) -> list[str]:
    return [f"{m // 60:02d}:{m % 60:02d}" for m in range(0, 1440, int(width_minutes))]


def heatmap_pivot(long: DataFrame, width_minutes: int = C.WINDOW_MINUTES) -> DataFrame:
    """One column for each window of a day; the labels are known, so no job looks them up."""
    return long.groupBy("station_id").pivot("time_label", time_labels(width_minutes)).agg(F.first("mean_value"))


# The place of each station by multiplier, highest first (ties by station),
# without ordering all stations in one task: stations are counted by multiplier and first characters, the
# counts are summed over those few slices, and places counted per slice.
def multiplier_positions(latest: DataFrame) -> DataFrame:
    d = latest.withColumn("_m", -F.col("price_multiplier")).withColumn("_s", F.substring("station_id", 1, 3))
    counts = d.groupBy("_m", "_s").agg(F.count(F.lit(1)).alias("_n"))
    level = counts.groupBy("_m").agg(F.sum("_n").alias("_n"))
    upto = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.withColumn("_in", upto(Window.partitionBy("_m").orderBy("_s"))).join(
        level.select("_m", upto(Window.orderBy("_m")).alias("_base")), "_m")
    place = F.row_number().over(Window.partitionBy("_m", "_s").orderBy("station_id"))
    return (d.withColumn("_place", place).join(bases.select("_m", "_s", (F.col("_base") + F.col("_in")).alias("_off")), ["_m", "_s"])
            .withColumn("position", (F.col("_off") + F.col("_place")).cast("int")).drop("_m", "_s", "_place", "_off"))


# Status table, 7 columns, by station.
def status_table(latest: DataFrame) -> DataFrame:
    return latest.select(*[c for c in STATUS_COLS if c in latest.columns]).orderBy("station_id")


# Messages seen.
def messages_seen(msgs: DataFrame) -> DataFrame:
    return msgs.agg(F.count(F.lit(1)).alias("messages_seen"))


# Newest n stored rows by id.
def last_rows(stored: DataFrame, n: int = C.LAST_ROWS_LIMIT, order: str = "id") -> DataFrame:
    return stored.orderBy(F.col(order).desc()).limit(int(n))


# Newest n alerts by arrival.
def alert_feed(alerts: DataFrame, n: int = C.ALERT_FEED_LIMIT,
               order=("arrival_ms", "station_id")) -> DataFrame:
    return alerts.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(int(n))
