"""Scalar row rules as Spark Column expressions (no Python UDFs).

Each builder takes Columns or column names and returns a Column, so the
same rule serves batch plans, streaming plans and SQL views alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridstream import config as C

__all__ = [
    "col_", "three_sigma_flag", "corrected_value", "bin_start", "hour_of", "weekday_of",
    "format_ts", "utilisation", "price_multiplier", "alert_level", "dynamic_price",
    "locked_price", "stress_band", "latency_ok", "alert_text", "parse_ts", "round_half_away", "round_exact", "snap",
]


def snap(c, places: int = 9) -> Column:
    """Value on a 1e-9 grid for threshold tests.

    Averages of decimal data land exactly on thresholds (0.35, 0.8) and the
    last bit then depends on summation order, which varies with
    partitioning.  Comparing snapped values makes such ties compare equal,
    run after run and in SQL alike (ROUND(x * 1e9) / 1e9).
    """
    m = float(10 ** places)
    return F.round(col_(c) * F.lit(m), 0) / F.lit(m)


def round_half_away(c, places: int = 6) -> Column:
    """round(x' * 10^p) / 10^p with x' = x nudged up by 1e-10 |x| + 1e-12.

    Sums of doubles differ in the last bits with summation order, and exact
    decimal ties (0.3803855) are common in averaged prices, so plain
    rounding could split equal results; the nudge moves the tie point away
    from such values.  The oracle SQL applies the same arithmetic.
    """
    c = col_(c)
    m = float(10 ** places)
    nudged = c + (F.lit(1e-10) * F.abs(c) + F.lit(1e-12))
    return F.round(nudged * F.lit(m), 0) / F.lit(m)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# anomaly when the reading is more than k rolling deviations from the mean.
def three_sigma_flag(kwh="kwh", mean="rolling_mean_kwh", std="rolling_std_kwh",
                     k: float = C.SIGMA_K) -> Column:
    kwh, mean, std = col_(kwh), col_(mean), col_(std)
    hit = (mean.isNotNull() & std.isNotNull() & (std > 0)
           & (snap(F.abs(kwh - mean)) > snap(F.lit(k) * std)))
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


# flagged readings are replaced by the rolling mean.
def corrected_value(kwh="kwh", mean="rolling_mean_kwh", flag="anomaly_flag") -> Column:
    return F.when(col_(flag) == 1, col_(mean)).otherwise(col_(kwh))


# Tumbling bin start, aligned to the epoch (equal to window(...).start and
# to DuckDB time_bucket for widths dividing a day), in exact integer micros.
def bin_start(ts="event_time", minutes: int = C.WINDOW_MINUTES) -> Column:
    us = F.unix_micros(col_(ts))
    width = F.lit(int(minutes) * 60 * 1_000_000)
    return F.timestamp_micros(us - F.pmod(us, width))


# hour of the window start as INT.
def hour_of(ts) -> Column:
    return F.hour(col_(ts)).cast("int")


# day of week with Monday = 0 (equals MOD(DAYOFWEEK + 5, 7)).
def weekday_of(ts) -> Column:
    return F.weekday(col_(ts)).cast("int")


# timestamp text yyyy-MM-dd HH:mm:ss.
def format_ts(ts) -> Column:
    return F.date_format(col_(ts), C.TIME_FORMAT)


# Zone-less text to timestamp; junk becomes NULL instead of failing.
def parse_ts(text) -> Column:
    return F.try_to_timestamp(col_(text), F.lit(C.TIME_FORMAT))


# capacity utilisation ratio (CUR).
def utilisation(mean="mean_kwh", capacity: float = C.CAPACITY_KWH) -> Column:
    return col_(mean) / F.lit(float(capacity))


def round_exact(c, places: int = 4) -> Column:
    """Rounds the exact binary value half to even, as Python's ``round``.

    ``p = x * 10^k`` is split into its integer part and a rest; the product's
    own rounding error ``e`` (exact: 10^k has few bits, x is split in halves)
    settles on which side of the tie the true product lies.
    """
    x, m = col_(c).cast("double"), F.lit(float(10 ** places))
    p = x * m
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    e = (high * m - p) + (x - high) * m
    down = F.floor(p).cast("double")
    side = (p - down - F.lit(0.5)) + e
    up = (side > 0) | ((side == 0) & (F.pmod(down, F.lit(2.0)) == 1.0))
    return F.when(F.abs(p) < F.lit(float(1 << 52)), F.when(up, down + F.lit(1.0)).otherwise(down) / m).otherwise(x)


def on_grid(c, grid: int | None) -> Column:
    return col_(c) if grid is None else snap(c, grid)


# < 0.7 -> 1; 0.7..0.9 linear 1..2; > 0.9 -> 3.  The span is the
# double (0.9 - 0.7), as in the reference, not the decimal 0.2.  ``grid``
# compares an averaged utilisation on a decimal grid (see ``snap``).
def price_multiplier(cur="capacity_utilization_ratio", warning: float = C.WARNING_CUR,
                     critical: float = C.CRITICAL_CUR,
                     top: float = C.CRITICAL_MULTIPLIER, grid: int | None = None) -> Column:
    cur = col_(cur)
    span = F.lit(float(critical) - float(warning))
    return (F.when(on_grid(cur, grid) < F.lit(float(warning)), F.lit(1.0))
             .when(on_grid(cur, grid) <= F.lit(float(critical)), F.lit(1.0) + (cur - F.lit(float(warning))) / span)
             .otherwise(F.lit(float(top))))


# >= 0.9 critical, >= 0.7 warning, else normal.
def alert_level(cur="capacity_utilization_ratio", warning: float = C.WARNING_CUR,
                critical: float = C.CRITICAL_CUR, grid: int | None = None) -> Column:
    cur = on_grid(cur, grid)
    return (F.when(cur >= F.lit(float(critical)), F.lit("critical"))
             .when(cur >= F.lit(float(warning)), F.lit("warning"))
             .otherwise(F.lit("normal")))


# Dynamic price = round(base * multiplier, 4).
def dynamic_price(multiplier="price_multiplier", base: float = C.BASE_PRICE_CAD) -> Column:
    return round_exact(F.lit(float(base)) * col_(multiplier), 4)


# P07 helper: locked price = round(dynamic * premium, 4).
def locked_price(dynamic="dynamic_price_cad", premium: float = C.GUARANTEE_PREMIUM) -> Column:
    return round_exact(col_(dynamic) * F.lit(float(premium)), 4)


# Dashboard band for the regional score.
def stress_band(score="stress_score", trigger: float = C.GRID_THRESHOLD,
                warning: float = C.GRID_WARNING) -> Column:
    s = snap(score)
    return (F.when(s > F.lit(float(trigger)), F.lit("triggered"))
             .when(s > F.lit(float(warning)), F.lit("warning"))
             .otherwise(F.lit("normal")))


# A latency sample counts when the message time is positive and the
# difference lies strictly inside (-1000, 600000) ms.
def latency_ok(latency_ms="latency_ms", msg_ts_ms="kafka_ts_ms",
               lo: float = C.LATENCY_MIN_MS, hi: float = C.LATENCY_MAX_MS) -> Column:
    lat = col_(latency_ms)
    return (col_(msg_ts_ms).isNotNull() & (col_(msg_ts_ms) > 0)
            & (lat > F.lit(float(lo))) & (lat < F.lit(float(hi))))


# One line of alert text, defaults type=station and level=warning.
def alert_text(type_="type", level="alert_level", station="station_id",
               predicted="predicted_kwh", multiplier="price_multiplier",
               time_bin="time_bin", score="stress_score", count="station_count") -> Column:
    t = F.coalesce(col_(type_), F.lit("station"))
    lvl = F.coalesce(col_(level), F.lit("warning"))
    regional = F.format_string(
        C.REGIONAL_TEXT,
        F.coalesce(col_(score), F.lit(0.0)),
        F.coalesce(col_(count).cast("string"), F.lit("?")),
        F.coalesce(col_(time_bin).cast("string"), F.lit("None")))
    station_line = F.format_string(
        C.STATION_TEXT,
        F.coalesce(col_(station).cast("string"), F.lit("None")), F.upper(lvl),
        F.coalesce(col_(predicted).cast("string"), F.lit("None")),
        F.coalesce(col_(multiplier).cast("string"), F.lit("None")),
        F.coalesce(col_(time_bin).cast("string"), F.lit("None")))
    return F.when(t == F.lit("regional"), regional).otherwise(station_line)
