"""Parameters with the reference behaviour's values as defaults.

Every public operator takes these as keyword arguments; the module-level
names are only defaults.
"""

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference behaviour for equal results.
# ---------------------------------------------------------------------------
ROLLING_PRECEDING_ROWS = 30          # frame: 30 PRECEDING .. CURRENT ROW
SIGMA_K = 3.0                        # 3-sigma anomaly rule
WINDOW_MINUTES = 15                  # tumbling feature window
CAPACITY_KWH = 15.0                  # capacity per window (kWh / 15 min)
WATERMARK_DELAY = "30 seconds"       # bounded out-of-orderness
ANOMALY_REASON = "kwh value exceeded 3 standard deviations from station rolling mean"
DEFAULT_DQ_REASON = "anomaly_detected"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
REGIONAL_TEXT = "REGIONAL stress %.2f across %s stations at %s"
STATION_TEXT = "Station %s -> %s (load %s kWh, multiplier %sx) at %s"

BASE_PRICE_CAD = 0.12
GUARANTEE_PREMIUM = 1.1
WARNING_CUR = 0.7
CRITICAL_CUR = 0.9
CRITICAL_MULTIPLIER = 3.0
RATED_POWER_QUANTILE = 0.95

GRID_THRESHOLD = 0.8                 # regional alert when mean CUR > 0.8
GRID_WARNING = 0.6                   # dashboard band
HEATMAP_WINDOWS = 16
PRICE_BUFFER_SIZE = 5000
ALERT_BUFFER_SIZE = 500
HISTORY_HOURS = 12
HISTORY_LIMIT = 5000
GRID_TREND_LIMIT = 50
ALERT_FEED_LIMIT = 20
LAST_ROWS_LIMIT = 10
LATENCY_MIN_MS = -1000.0             # exclusive
LATENCY_MAX_MS = 600000.0            # exclusive
P95_MIN_SAMPLES = 20

# evaluation
L_TRUE = 0.80                        # regional overload when utilisation >= 0.80
TRAIN_FRACTION = 0.80
LEAD_LOOKBACK_WINDOWS = 8
FALSE_ALARM_BUDGET = 0.05
THRESHOLD_LO, THRESHOLD_HI, THRESHOLD_STEP = 0.10, 1.50, 0.05   # 29 thresholds
STATION_SWEEP = [4, 8, 16, 32, 64]   # subset sizes
PARTICIPATION_SWEEP = [1.0, 0.85, 0.7, 0.55, 0.4]
DETECTORS = ["AGG-FORECAST", "AGG-CURRENT", "IND-FORECAST", "IND-CURRENT"]

# model
GBT_MAX_ITER = 200
GBT_MAX_DEPTH = 6
GBT_STEP_SIZE = 0.1
GBT_SEED = 42
GBT_BINS = 32                        # bins of a feature (the tree library's own default)
FEATURE_COLS = [
    "mean_kwh", "variance_kwh", "rate_of_change", "capacity_utilization_ratio",
    "hour_of_day", "day_of_week", "data_completeness", "anomaly_flag",
]

# ---------------------------------------------------------------------------
# Scale knobs (ours, not the reference's).
# ---------------------------------------------------------------------------
# Rows per ordered block of one station's series in the rolling-window
# operator; a station with more rows is split into blocks with a halo.
ROLLING_BLOCK_ROWS = 1 << 22
# Partitions of a stream's state where the cluster has fewer than half as many
# cores; else two for a core.  Never more than the session's shuffle partitions.
STATE_PARTITIONS = 32
