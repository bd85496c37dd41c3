"""Declared record schemas (no inference anywhere)."""

from pyspark.sql import types as T

TELEMETRY = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("time_new", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("kwh", T.DoubleType()),
])

FEATURES = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("time_bin", T.StringType()),
    T.StructField("mean_kwh", T.DoubleType()),
    T.StructField("variance_kwh", T.DoubleType()),
    T.StructField("rate_of_change", T.DoubleType()),
    T.StructField("capacity_utilization_ratio", T.DoubleType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("anomaly_flag", T.IntegerType()),
    T.StructField("data_completeness", T.DoubleType()),
])

DATA_QUALITY = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("time_new", T.StringType()),
    T.StructField("original_kwh", T.DoubleType()),
    T.StructField("corrected_kwh", T.DoubleType()),
    T.StructField("rolling_mean_kwh", T.DoubleType()),
    T.StructField("rolling_std_kwh", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])

# Data-quality message as consumed downstream (time_bin instead of time_new).
DATA_QUALITY_IN = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("time_bin", T.StringType()),
    T.StructField("time_new", T.StringType()),
    T.StructField("original_kwh", T.DoubleType()),
    T.StructField("corrected_kwh", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])

PRICES = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("time_bin", T.StringType()),
    T.StructField("predicted_kwh", T.DoubleType()),
    T.StructField("price_multiplier", T.DoubleType()),
    T.StructField("base_price_cad", T.DoubleType()),
    T.StructField("dynamic_price_cad", T.DoubleType()),
    T.StructField("guaranteed_price_cad", T.DoubleType()),
    T.StructField("session_status", T.StringType()),
    T.StructField("day_ahead_price_cad", T.DoubleType()),
    T.StructField("alert_level", T.StringType()),
])

STATION_ALERT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("time_bin", T.StringType()),
    T.StructField("alert_level", T.StringType()),
    T.StructField("predicted_kwh", T.DoubleType()),
    T.StructField("price_multiplier", T.DoubleType()),
    T.StructField("dynamic_price_cad", T.DoubleType()),
    T.StructField("guaranteed_price_cad", T.DoubleType()),
])

REGIONAL_ALERT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("time_bin", T.StringType()),
    T.StructField("stress_score", T.DoubleType()),
    T.StructField("station_count", T.IntegerType()),
])

# Alerts of both kinds with their key, as one stored table.
ALERT = T.StructType(STATION_ALERT.fields + [T.StructField("key", T.StringType())] + REGIONAL_ALERT.fields[2:])

# Stored tables (the reference's relational tables, as parquet).
INFERENCE_RESULTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("time_bin", T.TimestampType()),
    T.StructField("predicted_kwh", T.DoubleType()),
    T.StructField("price_multiplier", T.DoubleType()),
    T.StructField("dynamic_price_cad", T.DoubleType()),
    T.StructField("guaranteed_price_cad", T.DoubleType()),
    T.StructField("day_ahead_price_cad", T.DoubleType()),
    T.StructField("session_status", T.StringType()),
    T.StructField("alert_level", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

GRID_STRESS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("time_bin", T.TimestampType()),
    T.StructField("stress_score", T.DoubleType()),
    T.StructField("station_count", T.IntegerType()),
    T.StructField("triggered_alert", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
])

DATA_QUALITY_EVENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("time_bin", T.TimestampType()),
    T.StructField("original_kwh", T.DoubleType()),
    T.StructField("corrected_kwh", T.DoubleType()),
    T.StructField("reason", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# Telemetry message with its tiebreak sequence number.
TELEMETRY_SEQ = T.StructType(TELEMETRY.fields + [T.StructField("seq", T.LongType())])

# The same with the reading's exact time in microseconds; ``time_new`` has whole seconds.
TELEMETRY_TIMED = T.StructType(TELEMETRY_SEQ.fields + [T.StructField("event_us", T.LongType())])
