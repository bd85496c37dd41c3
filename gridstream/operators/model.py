"""Load forecaster (F18, M01-M06): split, train, score, evaluate, persist.

Training is Spark ML's distributed gradient-boosted trees (the boosting
library itself is not rebuilt); the reference's hyper-parameters are the
defaults.  Metric-level, not bit-level, parity with the reference model.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.functions.rules import round_exact
from gridstream.session import materialize


# ordered 80/20 split.  Default "time" (a true chronological cut, for
# new work); "row_rank" reproduces the reference.
#   mode="row_rank": the reference's cut - rows sorted by (station, time),
#     first int(n * 0.8) rows train.  The global position is (rows of earlier
#     stations) + (position within the station); rows of earlier stations are
#     a running sum over slices of station names, then within each slice, so
#     no task orders all stations.
#   mode="time": every row before the 80% time quantile trains (cut from a
#     distributed quantile sketch).
def split(table: DataFrame, fraction: float = C.TRAIN_FRACTION, mode: str = "time",
          key: str = "station_id", ts: str = "window_start") -> DataFrame:
    if mode == "time":
        cut = table.agg(F.percentile_approx(F.unix_micros(ts), F.lit(float(fraction)), 10000)).scalar()
        return table.withColumn("is_train", F.unix_micros(ts) < cut)
    counts = table.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_slice", F.substring(key, 1, 3))
    upto = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = counts.groupBy("_slice").agg(F.sum("_n").alias("_n")).select("_slice", upto(Window.orderBy("_slice")).alias("_base"))
    offsets = (counts.withColumn("_in", upto(Window.partitionBy("_slice").orderBy(key))).join(slices, "_slice")
               .select(key, (F.col("_base") + F.col("_in")).alias("_off")))
    total = table.agg(F.count(F.lit(1))).scalar()
    cut = F.floor(total * F.lit(float(fraction)))
    pos = F.row_number().over(Window.partitionBy(key).orderBy(ts)) - F.lit(1)
    return (table.join(offsets, key, "inner")
                 .withColumn("is_train", (F.col("_off") + pos) < cut).drop("_off"))


def assembler(features=C.FEATURE_COLS) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


# Candidate thresholds of each feature by the rule of Spark's trees, over all
# rows where those take a sample of 10,000: every midpoint between neighbouring
# values where a feature has at most ``bins`` of them, else the midpoints nearest
# to equal shares of the rows.  Distinct values are counted, dealt out by range
# and summed up within and across ranges, so no task orders a whole feature; the
# driver gets at most ``bins`` values for each share.
def split_points(rows: DataFrame, features, bins: int = C.GBT_BINS) -> list[list[float]]:
    x = rows.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in features])).alias("f", "x")).where("x IS NOT NULL AND NOT isnan(x)")
    values = x.groupBy("f", "x").agg(F.count(F.lit(1)).alias("n"))
    values = materialize(values.repartitionByRange("f", "x").withColumn("slice", F.spark_partition_id()))
    whole, own = Window.partitionBy("f"), Window.partitionBy("f", "slice").orderBy("x")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (values.groupBy("f", "slice").agg(F.sum("n").alias("n"), F.max("x").alias("last"), F.count(F.lit(1)).alias("d"))
              .select("f", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), F.max("last").over(earlier).alias("before"),
                      F.sum("n").over(whole).alias("total"), F.sum("d").over(whole).alias("distinct")))
    ordered = values.join(slices, ["f", "slice"]).select(
        "f", "x", "total", "distinct", F.coalesce(F.lag("x").over(own), "before").alias("prev"),
        (2 * (F.col("base") + F.sum("n").over(own)) - F.col("n")).alias("mid2"))       # rows below x and half of its own, twice
    shares = ordered.where("prev IS NOT NULL").withColumn("k", F.expr(f"(mid2 * {int(bins)} - 1) div (2 * total)"))     # shares that end below it
    near = F.row_number().over(Window.partitionBy("f", "k").orderBy("x"))
    few = F.col("distinct") <= int(bins)
    picked: list[list[float]] = [[] for _ in features]
    for r in shares.withColumn("nth", near).where(few | ((F.col("k") > 0) & (F.col("nth") <= int(bins)))).orderBy("f", "x").collect():
        if r.distinct <= bins or r.k > len(picked[r.f]):
            picked[r.f].append((r.prev + r.x) / 2.0)
    return picked


# Rows in the same bin of every feature can't be told apart by any tree, and
# with squared loss only their number and mean label count, so a cell of such
# rows is one weighted row: the trees are those of all rows, and the boosting
# loop's input is bounded by the bins, not by the rows.
BIN, WEIGHT = "_bin", "_weight"


def binner(features, cuts: list[list[float]]) -> Bucketizer:
    """Numbers of the bins: x <= cut is below a cut, as in the trees."""
    edges = [[-math.inf, *sorted({math.nextafter(c, math.inf) for c in own} or {0.0}), math.inf] for own in cuts]
    return Bucketizer(inputCols=list(features), outputCols=[c + BIN for c in features], splitsArray=edges, handleInvalid="keep")


def cells(binned: DataFrame, features, label: str) -> DataFrame:
    n = F.count(F.lit(1))
    ordered = [F.col(c + BIN).alias(c + BIN, metadata={}) for c in features]      # the Bucketizer marks its numbers as nominal
    return binned.select(*ordered, label).groupBy(*[c + BIN for c in features]).agg(
        n.cast("double").alias(WEIGHT), F.when(F.count(label) == n, F.avg(label)).alias(label))


# Train the regressor (8 features -> target).
def train_regressor(train: DataFrame, features=C.FEATURE_COLS, label: str = "target",
                    max_iter: int = C.GBT_MAX_ITER, max_depth: int = C.GBT_MAX_DEPTH,
                    step: float = C.GBT_STEP_SIZE, seed: int = C.GBT_SEED, bins: int = C.GBT_BINS) -> PipelineModel:
    bucketizer = binner(features, split_points(train, features, bins))
    rows = materialize(cells(bucketizer.transform(train), features, label))
    # so many bins that Spark's trees take each of ours from all cells, not from a sample of them
    most = max(int(bins) + 2, math.isqrt(rows.count()) + 1)
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", weightCol=WEIGHT, maxBins=most,
                       maxIter=int(max_iter), maxDepth=int(max_depth), stepSize=float(step), seed=int(seed))
    fit = Pipeline(stages=[assembler([c + BIN for c in features]), gbt]).fit(rows)
    return PipelineModel([bucketizer, *fit.stages])


# Score rows; prediction rounded to 4 places.
def score(model: PipelineModel, rows: DataFrame, out: str = "predicted_kwh") -> DataFrame:
    return model.transform(rows).withColumn(out, round_exact("prediction", 4)).select(*[c for c in rows.columns if c != out], out)


# MAE and RMSE of a prediction column.
def regression_metrics(df: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    e = F.col(pred) - F.col(label)
    return df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                  F.count(F.lit(1)).alias("n"))


# M04 + M04b: retrain per horizon; MAE/RMSE on the validation rows and the
# loss relative to the first horizon in percent.  ``model="persistence"``
# predicts the current window's mean (SQL-checkable variant).
def horizon_study(windows: DataFrame, horizons=(1, 2, 3), model: str = "gbt", fraction: float = C.TRAIN_FRACTION,
                  split_mode: str = "row_rank", width_minutes: int = C.WINDOW_MINUTES, **gbt) -> DataFrame:
    from gridstream.operators.features import with_diff, with_target
    base = with_diff(windows)
    tables = [split(with_target(base, h), fraction, split_mode) for h in horizons]
    if model != "persistence":     # each boosting round reads its rows again: they are written once
        tables = [materialize(t) for t in tables]
        models = fitted(windows.sparkSession, [partial(train_regressor, t.filter("is_train"), **gbt) for t in tables])
    parts = []
    for i, h in enumerate(horizons):
        val = tables[i].filter(~F.col("is_train"))
        pred = val.withColumn("prediction", F.col("mean_kwh")) if model == "persistence" else models[i].transform(val)
        parts.append(regression_metrics(pred).select(F.lit(int(h) * int(width_minutes)).alias("horizon_min"),
                                                     "mae", "rmse", "n"))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    first = res.filter(F.col("horizon_min") == min(horizons) * int(width_minutes))
    m0, r0 = first.select(F.max("mae")).scalar(), first.select(F.max("rmse")).scalar()
    return (res.withColumn("mae_vs_first_pct", (F.col("mae") / m0 - F.lit(1.0)) * F.lit(100.0))
               .withColumn("rmse_vs_first_pct", (F.col("rmse") / r0 - F.lit(1.0)) * F.lit(100.0)))


# A registry of saved models.  A model is written to a folder of its own;
# the pointer file CURRENT names it and is moved into place last, so a reader
# finds whole models only, whatever died while writing.
POINTER = "CURRENT"


def save_model(model: PipelineModel, root: str) -> str:
    """Saves a new version and publishes it; older versions stay. Returns its name."""
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    version = f"v-{uuid.uuid4().hex}"
    model.write().save(f"{root}/{version}")
    fs, path = _hadoop(spark, root)
    temporary, current = path(f"{root}/.{version}"), path(f"{root}/{POINTER}")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(version, "utf-8"))
    finally:
        out.close()
    if fs.exists(current):
        fs.delete(current, False)
    fs.rename(temporary, current)
    return version


def published(spark, root: str) -> str | None:
    """The folder of the published model, None where there is none."""
    fs, path = _hadoop(spark, root)
    if not fs.exists(path(f"{root}/{POINTER}")):
        return None
    name = spark.read.text(f"{root}/{POINTER}").first()[0]
    return f"{root}/{name}"


def _hadoop(spark, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def load_or_train(root: str, train: DataFrame, **kw) -> PipelineModel:
    found = published(train.sparkSession, root)
    if found:
        return PipelineModel.load(found)
    model = train_regressor(train, **kw)
    save_model(model, root)
    return model


# Several fits at a time: each runs its jobs from a thread of its own, under a
# pool of its own where the scheduler is fair.
def fitted(spark, fits: list, at_once: int = 4) -> list:
    """Results of functions without arguments, in order."""
    from pyspark import inheritable_thread_target

    def run(i: int, fit):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{i % at_once}")
        return fit()

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), i, fit) for i, fit in enumerate(fits)]]


# Pooled per-scenario forecaster.  Features of window t (F19) predict
# the mean of window t+1; each scenario trains on its windows t < int(T*0.8)-1
# and forecasts every window; M05 then aligns the forecast to t.  A station
# without a row at t+1 has a mean of 0 there, as in a dense array.  Scenarios
# are numbered 0 .. scenarios-1, so none has to be looked up.
def scenario_forecasts(long: DataFrame, T, scenarios: int, width_minutes: int = C.WINDOW_MINUTES,
                       fraction: float = C.TRAIN_FRACTION, **gbt) -> DataFrame:
    from gridstream.operators.evaluation import with_forecast
    from gridstream.operators.features import reduced_features
    minutes = F.col("t") * F.lit(int(width_minutes))
    feats = (reduced_features(long).withColumn("hour_of_day", F.floor(minutes / 60) % 24)
             .withColumn("day_of_week", F.floor(minutes / 1440) % 7))
    nxt = feats.select("scenario_id", "station_id", (F.col("t") - 1).alias("t"), F.col("mean_kwh").alias("target"))
    rows = feats.join(nxt, ["scenario_id", "station_id", "t"], "left").fillna(0.0, subset=["target"])
    split_t = F.floor((F.lit(T) if isinstance(T, int) else T) * F.lit(float(fraction))) - 1
    rows = materialize(rows.withColumn("is_train", F.col("t") < split_t))     # read by every fit, again and again
    mine = [rows.filter(F.col("scenario_id") == s) for s in range(int(scenarios))]
    models = fitted(rows.sparkSession, [partial(train_regressor, m.filter("is_train"), **gbt) for m in mine])
    pred = None
    for own, m in zip(mine, models):
        one = m.transform(own).withColumn("pred_cur", F.col("prediction") / F.col("capacity")).select(
            "scenario_id", "t", "station_id", "cur_obs", "capacity", "pred_cur")
        pred = one if pred is None else pred.unionByName(one)
    return with_forecast(pred, pred="pred_cur")
