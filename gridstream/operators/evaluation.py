"""Early-warning detector evaluation (E01-E18, M05) as grouped Spark jobs.

Input is one long table ``(scenario_id, t, station_id, cur_obs, cur_fc,
capacity)``; a station without a row at t counts as 0 there.  The reference
loops over seeds x detectors x thresholds on dense arrays; here every loop is
a grouping key and no dense array is built:

* sums and maxima per (scenario, t) against constants of the scenario (number
  of stations, total capacity)                             -- E03/E04
* window grid per scenario (``sequence``), missing windows 0
* event runs by gaps-and-islands per scenario              -- E05
* warning zones around the events, as lists on the windows  -- E06
* per (scenario, t, detector) the number of thresholds exceeded; counts per
  such number, then running totals over the 29 thresholds  -- E07-E10

so the work is grid x detectors, whatever the number of thresholds.  ``part``
lists the keys that identify one scenario (add sweep keys such as
``n_stations`` to score a sweep in the same job).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.functions.rules import snap
from gridstream.operators.series import sliced_rank

STAT_COLS = {
    "AGG-CURRENT": "agg_current", "AGG-FORECAST": "agg_forecast",
    "IND-CURRENT": "ind_current", "IND-FORECAST": "ind_forecast",
}


def thresholds(lo: float = C.THRESHOLD_LO, hi: float = C.THRESHOLD_HI,
               step: float = C.THRESHOLD_STEP) -> list[float]:
    """The sweep 0.10, 0.15, ..., 1.50 (rounded to 3 places)."""
    n0, n1 = int(round(lo / step)), int(round(hi / step))
    return [round(step * i, 3) for i in range(n0, n1 + 1)]


def bin_index(ts: Column, t0: Column, width_minutes: int) -> Column:
    return ((F.unix_seconds(ts) - F.unix_seconds(t0)) / F.lit(int(width_minutes) * 60)).cast("int")


# A station's scenario: its number mod k, or a hash mod k where its name is no number.
def station_number(station: str, k: int) -> Column:
    number = F.coalesce(F.expr(f"try_cast({station} AS BIGINT)"), F.xxhash64(station))
    return F.pmod(number, F.lit(int(k))).cast("int")


# Long table from windowed features: scenario = station number mod k,
# t = window number from the first window, cur_obs = mean / capacity.
def long_table(features: DataFrame, capacity: float, width_minutes: int = C.WINDOW_MINUTES,
               scenarios: int = 5, t0: Column | None = None) -> DataFrame:
    t0 = t0 if t0 is not None else features.agg(F.min("window_start")).scalar()
    return features.select(
        station_number("station_id", scenarios).alias("scenario_id"),
        bin_index(F.col("window_start"), t0, width_minutes).alias("t"),
        "station_id",
        (F.col("mean_kwh") / F.lit(float(capacity))).alias("cur_obs"),
        F.lit(float(capacity)).alias("capacity"))


# Forecast alignment.  The forecast for window t is the prediction made
# at t-1 (``pred`` column, default persistence = cur_obs); window 0 uses the
# actual value; a station without a row at t-1 forecasts 0 for t.  A station
# with a row at t-1 has a forecast for t even where it has no reading then.
# Each row leaves once for its window and once for the next; they meet in one
# grouping, without a join.
def with_forecast(long: DataFrame, pred: str = "cur_obs", part=("scenario_id",), T: Column | int | None = None) -> DataFrame:
    T = n_windows(long) if T is None else F.lit(T) if isinstance(T, int) else T
    none = F.lit(None).cast("double")
    both = long.select(*part, "station_id", "capacity", F.explode(F.array(
        F.struct(F.col("t").alias("t"), F.col("cur_obs").alias("obs"), none.alias("fc")),
        F.struct((F.col("t") + 1).alias("t"), none.alias("obs"), F.col(pred).alias("fc")))).alias("_x"))
    m = both.where(F.col("_x.t") < T).groupBy(*part, "station_id", F.col("_x.t").alias("t")).agg(
        F.max("_x.obs").alias("_obs"), F.max("_x.fc").alias("_fc"), F.max("capacity").alias("capacity"))
    obs = F.coalesce("_obs", F.lit(0.0))
    return m.select(*part, "t", "station_id", obs.alias("cur_obs"), "capacity",
                    F.when(F.col("t") == 0, obs).otherwise(F.coalesce("_fc", F.lit(0.0))).alias("cur_fc"))


def n_windows(long: DataFrame) -> Column:
    return long.agg((F.max("t") + 1).cast("int")).scalar()


# The stations of each scenario with their capacity: one row each.  A caller
# that has them from elsewhere passes them, which saves a pass over ``long``.
def station_table(long: DataFrame, part=("scenario_id",)) -> DataFrame:
    return long.groupBy(*part, "station_id").agg(F.max("capacity").alias("capacity"))


# E03 + E04: per (scenario, t) the four detector statistics over all stations
# of the scenario, and regional utilisation; windows without rows are 0.
def window_stats(long: DataFrame, T: Column | int, part=("scenario_id",), stations: DataFrame | None = None) -> DataFrame:
    part = list(part)
    constants = (stations if stations is not None else station_table(long, part)).groupBy(*part).agg(
        F.count(F.lit(1)).alias("_stations"), F.sum("capacity").alias("_capacity"))
    T = F.lit(int(T)) if isinstance(T, int) else T
    sums = long.groupBy(*part, "t").agg(
        F.sum("cur_obs").alias("_obs"), F.sum("cur_fc").alias("_fc"),
        F.max("cur_obs").alias("_max_obs"), F.max("cur_fc").alias("_max_fc"),
        F.sum(F.col("cur_obs") * F.col("capacity")).alias("_load"))
    grid = constants.withColumn("t", F.explode(F.sequence(F.lit(0), T - F.lit(1))))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return grid.join(sums, on=[*part, "t"], how="left").select(
        *part, "t", (zero("_obs") / F.col("_stations")).alias("agg_current"),
        (zero("_fc") / F.col("_stations")).alias("agg_forecast"),
        F.greatest(zero("_max_obs"), F.lit(0.0)).alias("ind_current"),
        F.greatest(zero("_max_fc"), F.lit(0.0)).alias("ind_forecast"),
        (zero("_load") / F.col("_capacity")).alias("region_u"))


# The overload line: a fixed utilisation (the reference's 0.80), or for data
# of another level the nearest-rank quantile of the windows' utilisation.
def overload_line(stats: DataFrame, quantile: float) -> Column:
    return stats.agg(F.expr(f"percentile_disc({float(quantile)}) WITHIN GROUP (ORDER BY region_u)")).scalar()


def window_grid(long: DataFrame, T: Column | int, l_true: float | None = C.L_TRUE, part=("scenario_id",),
                quantile: float | None = None, stations: DataFrame | None = None) -> DataFrame:
    g = window_stats(long, T, part, stations)
    line = overload_line(g, quantile) if quantile is not None else F.lit(float(l_true))
    return g.withColumn("overload", snap("region_u") >= snap(line))


def held_out_lo(T: Column | int, fraction: float = C.TRAIN_FRACTION) -> Column:
    T = F.lit(int(T)) if isinstance(T, int) else T
    return F.floor(T * F.lit(float(fraction))).cast("int")


# Maximal overload runs within [lo, hi): (onset, end) per scenario.
def event_runs(grid: DataFrame, lo: Column, part=("scenario_id",)) -> DataFrame:
    part = list(part)
    hot = grid.filter(F.col("overload") & (F.col("t") >= lo)).select(*part, "t")
    w = Window.partitionBy(*part).orderBy("t")
    isl = hot.withColumn("_isl", F.col("t") - F.row_number().over(w))
    return isl.groupBy(*part, "_isl").agg(F.min("t").alias("onset"), F.max("t").alias("end")).drop("_isl")


# Rows of each event's warning zone [max(lo, onset - 8), end].
def zone_rows(events: DataFrame, lo: Column, lookback: int = C.LEAD_LOOKBACK_WINDOWS) -> DataFrame:
    start = F.greatest(lo, F.col("onset") - F.lit(int(lookback)))
    return events.withColumn("zone_start", start).withColumn(
        "t", F.explode(F.sequence(F.col("zone_start"), F.col("end"))))


# Per (scenario, t, detector) the number of thresholds below the statistic.
# Thresholds ascend, so threshold i raises an alarm if and only if level > i.
def alarm_levels(grid: DataFrame, lo: Column, detectors=C.DETECTORS, thr: list[float] | None = None,
                 part=("scenario_id",), keep=()) -> DataFrame:
    thr = sorted(thr or thresholds())
    line = F.array(*[F.lit(float(x)) for x in thr])
    stack = F.explode(F.array(*[F.struct(F.lit(d).alias("detector"), snap(STAT_COLS[d]).alias("stat")) for d in detectors]))
    return (grid.filter(F.col("t") >= lo).select(*part, "t", "overload", *keep, stack.alias("_d"))
            .select(*part, "t", "overload", *keep, "_d.detector",
                    F.size(F.filter(line, lambda x: F.col("_d.stat") > x)).alias("level")))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


# Held-out windows with the onsets of all events whose zone they lie in: the
# own event's where overloaded, and those starting in the next ``lookback``
# windows.  One ordered pass per scenario, no join (a scenario's windows are
# bounded by the time span, whatever the number of readings).
def in_zones(grid: DataFrame, lo: Column, lookback: int = C.LEAD_LOOKBACK_WINDOWS, part=("scenario_id",)) -> DataFrame:
    by = Window.partitionBy(*part).orderBy("t")
    onset = F.col("overload") & ~F.coalesce(F.lag("overload").over(by), F.lit(False))
    d = grid.filter(F.col("t") >= lo).withColumn("onset", F.when(onset, F.col("t")))
    own = F.last("onset", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.collect_list("onset").over(by.rowsBetween(1, int(lookback)))
    none = F.array().cast("array<int>")
    return d.withColumn("_events", F.concat(F.when(F.col("overload"), F.array(own)).otherwise(none), ahead))


# All metrics per (scenario, detector, threshold) over [lo, hi).
def detector_metrics(long: DataFrame, l_true: float | None = C.L_TRUE, fraction: float = C.TRAIN_FRACTION,
                     detectors=C.DETECTORS, thr: list[float] | None = None,
                     lookback: int = C.LEAD_LOOKBACK_WINDOWS, part=("scenario_id",),
                     T: Column | int | None = None, quantile: float | None = None,
                     stations: DataFrame | None = None) -> DataFrame:
    part = list(part)
    thr = sorted(thr or thresholds())
    T = T if T is not None else n_windows(long)
    lo = held_out_lo(T, fraction)
    zoned = in_zones(window_grid(long, T, l_true, part, quantile, stations), lo, lookback, part)
    levels = alarm_levels(zoned, lo, detectors, thr, part, keep=("onset", "_events"))
    steps = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(len(thr) - 1)).alias("i"),
                                   F.array(*[F.lit(float(x)) for x in thr]).alias("threshold"))).alias("_s")

    # Each window counts once under its level, and once for every event whose
    # zone it lies in: the first alarm at threshold i is where the level first
    # passes i, so only a window that raises the running maximum matters.
    by_event = Window.partitionBy(*part, "detector", "event").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max("level").over(by_event), F.lit(0))
    rows = (levels.withColumn("event", F.explode(F.concat(F.array(F.lit(None).cast("int")), "_events")))
            .withColumn("_before", before))
    plain = F.col("event").isNull()
    passed = F.when(F.col("level") > F.col("_before"), F.sequence(F.col("_before"), F.col("level") - 1)).otherwise(F.array().cast("array<int>"))
    counted = (rows.withColumn("_i", F.explode(F.when(plain, F.array("level")).otherwise(passed)))
               .groupBy(*part, "detector", plain.alias("_plain"), "_i").agg(
                   F.count_if("overload").alias("_pos"), F.count_if(~F.col("overload")).alias("_neg"),
                   F.count_if(F.size("_events") == 0).alias("_outside"), F.count("onset").alias("_onsets"),
                   F.sum(F.greatest(F.lit(0), F.col("event") - F.col("t"))).alias("_lead"), F.count(F.lit(1)).alias("_n")))

    # a few dozen rows for each (scenario, detector): running totals over the thresholds
    fired = F.col("_plain") & (F.col("_i") > F.col("_s.i"))
    quiet = F.col("_plain") & (F.col("_i") <= F.col("_s.i"))
    first = ~F.col("_plain") & (F.col("_i") == F.col("_s.i"))
    total = lambda c, cond: F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0)))
    m = counted.select("*", steps).groupBy(*part, "detector", F.col("_s.threshold").alias("threshold")).agg(
        total("_pos", fired).alias("tp"), total("_neg", fired).alias("fp"),
        total("_pos", quiet).alias("fn"), total("_neg", quiet).alias("tn"),
        total("_outside", fired).alias("_fa"), total("_outside", F.col("_plain")).alias("_out"),
        total("_onsets", F.col("_plain")).alias("n_events"),
        total("_lead", first).alias("_lead_sum"), total("_n", first).alias("_detected"))
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return (m.withColumn("precision", prec).withColumn("recall", rec)
             .withColumn("f1", _ratio(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                      F.col("precision") + F.col("recall")))
             .withColumn("fpr", _ratio(F.col("fp"), F.col("fp") + F.col("tn")))
             .withColumn("far", _ratio(F.col("_fa"), F.col("_out")))
             .withColumn("mean_lead_windows", _ratio(F.col("_lead_sum").cast("double"), F.col("n_events")))
             .withColumn("detection_rate", _ratio(F.col("_detected").cast("double"), F.col("n_events")))
             .drop("_fa", "_out", "_lead_sum", "_detected"))


# E11 (fpr, recall) and E12 (far, lead minutes) per threshold.
def roc_points(metrics: DataFrame, part=("scenario_id",)) -> DataFrame:
    return metrics.select(*part, "detector", "threshold", "fpr", "recall")


def operating_points(metrics: DataFrame, width_minutes: int = C.WINDOW_MINUTES,
                     part=("scenario_id",)) -> DataFrame:
    return metrics.select(*part, "detector", "threshold", "far",
                          (F.col("mean_lead_windows") * F.lit(float(width_minutes))).alias("lead_minutes"))


# Lowest threshold with far <= budget, else the largest threshold.
def pick_threshold(metrics: DataFrame, budget: float = C.FALSE_ALARM_BUDGET,
                   part=("scenario_id",)) -> DataFrame:
    return metrics.groupBy(*part, "detector").agg(
        F.coalesce(F.min(F.when(F.col("far") <= F.lit(float(budget)), F.col("threshold"))),
                   F.max("threshold")).alias("threshold"))


# The metrics at the picked threshold, in the same one grouping.
def at_picked(metrics: DataFrame, budget: float = C.FALSE_ALARM_BUDGET,
              part=("scenario_id",)) -> DataFrame:
    by = [*part, "detector"]
    row = F.struct(*[c for c in metrics.columns if c not in by])
    within = F.min_by(row, F.when(F.col("far") <= F.lit(float(budget)), F.col("threshold")))
    picked = metrics.groupBy(*by).agg(F.coalesce(within, F.max_by(row, F.col("threshold"))).alias("_m"))
    return picked.select(*by, "_m.*")


# Detector comparison averaged over scenarios (rounding is the output's).
def comparison_table(metrics: DataFrame, budget: float = C.FALSE_ALARM_BUDGET,
                     width_minutes: int = C.WINDOW_MINUTES, part=("scenario_id",),
                     by=("detector",)) -> DataFrame:
    p = at_picked(metrics, budget, part)
    return p.groupBy(*by).agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
        F.avg("far").alias("false_alarm_rate"),
        (F.avg("mean_lead_windows") * F.lit(float(width_minutes))).alias("mean_lead_min"),
        F.avg("detection_rate").alias("detection_rate"))


# Curves averaged over scenarios per (detector, threshold).
def curves(metrics: DataFrame, width_minutes: int = C.WINDOW_MINUTES, by=("detector", "threshold")) -> DataFrame:
    return metrics.groupBy(*by).agg(
        F.avg("far").alias("far"),
        F.avg(F.col("mean_lead_windows") * F.lit(float(width_minutes))).alias("lead_minutes"),
        F.avg("fpr").alias("fpr"), F.avg("recall").alias("recall"))


# Sweep over station subsets.  Each sweep value keeps the first k
# stations of a scenario (k = n, or ceil(p * stations)); the sweep value joins
# the scenario key so every cell is scored in one job.  Sizes should lie below
# the number of stations of a scenario: larger ones all keep every station.
def station_subsets(stations: DataFrame, sizes=None, fractions=None) -> tuple[DataFrame, str]:
    """(scenario_id, station_id, capacity, sweep value) of every subset, and the sweep column."""
    ranked = sliced_rank(stations, ["scenario_id"], "station_id", "_rank")
    if sizes is not None:
        cells = ranked.withColumn("n_stations", F.explode(F.array(*[F.lit(int(n)) for n in sizes]))) \
                      .filter(F.col("_rank") <= F.col("n_stations"))
        return cells.drop("_rank"), "n_stations"
    total = stations.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("_tot"))
    cells = (ranked.join(total, "scenario_id")
                   .withColumn("participation", F.explode(F.array(*[F.lit(float(p)) for p in fractions])))
                   .filter(F.col("_rank") <= F.ceil(F.col("participation") * F.col("_tot"))))
    return cells.drop("_rank", "_tot"), "participation"


def sweep_table(long: DataFrame, sizes=None, fractions=None, detectors=("AGG-CURRENT", "IND-CURRENT"),
                budget: float = C.FALSE_ALARM_BUDGET, width_minutes: int = C.WINDOW_MINUTES,
                stations: DataFrame | None = None, T: Column | int | None = None, **kw) -> DataFrame:
    stations = stations if stations is not None else station_table(long)
    cells, key = station_subsets(stations, sizes, fractions)
    part = ("scenario_id", key)
    some = long.join(cells.drop("capacity"), ["scenario_id", "station_id"])
    m = detector_metrics(some, detectors=list(detectors), part=part, T=T if T is not None else n_windows(long), stations=cells, **kw)
    p = at_picked(m, budget, part=part)
    return p.groupBy(key, "detector").agg(
        F.avg("recall").alias("recall"),
        F.avg(F.col("mean_lead_windows") * F.lit(float(width_minutes))).alias("mean_lead_min"))


# Raw-trace summary: stations, windows, mean and max regional stress,
# windows above the alert line.
def raw_trace_summary(windows: DataFrame, capacity: float = C.CAPACITY_KWH,
                      threshold: float = C.GRID_THRESHOLD) -> DataFrame:
    per_bin = (windows.withColumn("_cur", F.col("mean_kwh") / F.lit(float(capacity)))
                      .groupBy("window_start").agg(F.avg("_cur").alias("_g")))
    stations = windows.agg(F.count_distinct("station_id")).scalar()
    return per_bin.agg(
        stations.alias("stations"), F.count(F.lit(1)).alias("windows"),
        F.avg("_g").alias("mean_stress"), F.max("_g").alias("max_stress"),
        F.count_if(snap("_g") > F.lit(float(threshold))).alias("windows_above"))


# Normalised hour-of-day shape: mean by station-window, then by hour;
# missing hours 0; circular 1-2-1 smoothing; divided by the max (if > 0);
# 0.3 + 0.7 x.  The hour tables have 24 rows, so they are broadcast.
def hour_profile(windows: DataFrame, floor: float = 0.3, scale: float = 0.7) -> DataFrame:
    spark = windows.sparkSession
    by_hour = (windows.withColumn("hour", F.hour("window_start"))
                      .groupBy("hour").agg(F.avg("mean_kwh").alias("_v")))
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    dense = hours.join(F.broadcast(by_hour), "hour", "left").fillna(0.0, subset=["_v"])
    prv = dense.select(((F.col("hour") + 1) % 24).alias("hour"), F.col("_v").alias("_p"))
    nxt = dense.select(((F.col("hour") + 23) % 24).alias("hour"), F.col("_v").alias("_n"))
    sm = (dense.join(F.broadcast(prv), "hour").join(F.broadcast(nxt), "hour")
               .withColumn("_s", (F.col("_p") + F.lit(2.0) * F.col("_v") + F.col("_n")) / F.lit(4.0)))
    mx = sm.agg(F.max("_s")).scalar()
    norm = F.when(mx > 0, F.col("_s") / mx).otherwise(F.col("_s"))
    return sm.select("hour", (F.lit(float(floor)) + F.lit(float(scale)) * norm).alias("shape"))
