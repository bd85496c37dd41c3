"""Forecaster: split parity, training and scoring (small iteration counts)."""

from pyspark.sql import functions as F

from gridstream.operators import evaluation as EV
from gridstream.operators import features as FE
from gridstream.operators import model as MO
from gridstream.sources.telemetry import PROFILE_B, load_telemetry

from conftest import SF_SMALL


def _table(spark):
    p = PROFILE_B
    return FE.training_table(load_telemetry(spark, SF_SMALL, p), 1, p.window_minutes, p.capacity)


def test_split_row_rank_matches_sorted_cut(spark):
    t = MO.split(_table(spark), mode="row_rank")
    rows = sorted((r.station_id, r.window_start, r.is_train) for r in t.collect())
    cut = int(len(rows) * 0.8)
    assert [r[2] for r in rows] == [True] * cut + [False] * (len(rows) - cut)


def test_split_time_mode(spark):
    t = MO.split(_table(spark), mode="time")
    n = t.count()
    share = t.filter("is_train").count() / n
    assert 0.7 < share < 0.9


def test_train_score_metrics(spark, tmp_path):
    t = MO.split(_table(spark))
    m = MO.train_regressor(t.filter("is_train"), max_iter=3, max_depth=3)
    scored = MO.score(m, t.filter(~F.col("is_train")))
    assert scored.filter(F.col("predicted_kwh").isNull()).count() == 0
    r = MO.regression_metrics(m.transform(t.filter(~F.col("is_train")))).collect()[0]
    assert r.mae >= 0 and r.rmse >= r.mae
    path = str(tmp_path / "model")
    MO.save_model(m, path)
    again = MO.load_or_train(path, t.filter("is_train"), max_iter=1)
    a = sorted(x.predicted_kwh for x in MO.score(again, t.limit(50)).collect())
    b = sorted(x.predicted_kwh for x in MO.score(m, t.limit(50)).collect())
    assert a == b


def test_scenario_forecasts(spark):
    p = PROFILE_B
    f = FE.stream_features(load_telemetry(spark, SF_SMALL, p), p.window_minutes, p.capacity, keep_start=True)
    lng = EV.long_table(f, p.capacity, p.window_minutes, scenarios=2)
    T = lng.agg(F.max("t")).collect()[0][0] + 1
    out = MO.scenario_forecasts(lng, T, 2, max_iter=2, max_depth=2)
    assert out.count() == EV.with_forecast(lng).count() > lng.count()
    assert out.filter(F.col("cur_fc").isNull()).count() == 0


def test_horizon_study_persistence(spark):
    p = PROFILE_B
    w = FE.offline_windows(load_telemetry(spark, SF_SMALL, p), p.window_minutes, p.capacity)
    r = MO.horizon_study(w, model="persistence").orderBy("horizon_min").collect()
    assert [x.horizon_min for x in r] == [15, 30, 45]
    assert r[0].mae_vs_first_pct == 0.0


def test_registry_gives_whole_models_only(spark, tmp_path):
    """A model that died while being written is not taken, and an older one stays published."""
    import os
    import shutil
    from pyspark.ml import PipelineModel
    t = spark.createDataFrame([(float(i), float(i % 7), float(2 * i)) for i in range(60)], "a double, b double, target double")
    train = lambda n: MO.train_regressor(t, features=["a", "b"], max_iter=n, max_depth=2)
    root = str(tmp_path / "models")
    assert MO.published(spark, root) is None
    half = f"{root}/v-half"
    train(1).write().save(half)
    shutil.rmtree(f"{half}/stages")                       # metadata/_SUCCESS is there, the stages aren't
    assert os.path.exists(f"{half}/metadata/_SUCCESS") and MO.published(spark, root) is None
    made = MO.load_or_train(root, t, features=["a", "b"], max_iter=2, max_depth=2)
    assert made.stages[-1].getNumTrees == 2
    first = MO.published(spark, root)
    assert MO.load_or_train(root, t, max_iter=9).stages[-1].getNumTrees == 2      # reused
    MO.save_model(train(3), root)
    assert MO.published(spark, root) != first and PipelineModel.load(MO.published(spark, root)).stages[-1].getNumTrees == 3
    assert PipelineModel.load(first).stages[-1].getNumTrees == 2


def test_fits_at_a_time_keep_their_order(spark):
    rows = spark.range(100)
    assert MO.fitted(spark, [lambda k=k: rows.where(f"id < {k}").count() for k in (3, 50, 7, 0, 99)], at_once=3) == [3, 50, 7, 0, 99]


def test_cells_give_the_trees_of_all_rows(spark):
    """A fit on weighted cells predicts what Spark's fit on all rows does, and its input is bounded by the bins."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor
    t = spark.range(6000).selectExpr("cast(pmod(xxhash64(id), 997) AS double) AS a", "cast(id % 7 AS double) AS b",
                                     "CASE WHEN id % 50 = 0 THEN 1.0D ELSE 0.0D END AS c", "5.0D AS d").selectExpr("*", "sin(a / 99) * 10 + b * b + 3 * c AS target")
    names = ["a", "b", "c", "d"]
    gbt = GBTRegressor(labelCol="target", maxIter=8, maxDepth=4, seed=42)
    want = Pipeline(stages=[MO.assembler(names), gbt]).fit(t).transform(t).select("a", "b", "c", F.col("prediction").alias("want"))
    m = MO.train_regressor(t, features=names, max_iter=8, max_depth=4)
    got = m.transform(t).select("a", "b", "c", "prediction").distinct()
    worst = got.join(want.distinct(), ["a", "b", "c"]).agg(F.max(F.abs(F.col("prediction") - F.col("want"))), F.count(F.lit(1))).first()
    assert worst[1] > 4000 and worst[0] < 1e-6
    many = t.crossJoin(spark.range(5).select()).withColumn("a", F.col("a") + F.rand(1) / 10)
    cells = lambda d: MO.cells(MO.binner(names, MO.split_points(d, names)).transform(d), names, "target")
    assert cells(many).count() <= 32 * 7 * 2 and cells(many).agg(F.sum(MO.WEIGHT)).first()[0] == 30000


def test_split_points_by_shares(spark):
    """As Spark's rule picks them, whatever the slices: a heavy value uses up several shares."""
    def plain(values, bins):
        import collections
        v = sorted(collections.Counter(values).items())
        if len(v) <= bins:
            return [(a[0] + b[0]) / 2 for a, b in zip(v, v[1:])]
        out, upto, stride = [], v[0][1], len(values) / bins
        target = stride
        for (p, _), (x, n) in zip(v, v[1:]):
            if abs(upto - target) < abs(upto + n - target):
                out.append((p + x) / 2)
                target += stride
            upto += n
        return out
    import random
    r = random.Random(5)
    cols = [[r.gauss(0, 3) for _ in range(900)], [float(r.choice([0, 0, 0, 0, r.randrange(60)])) for _ in range(900)],
            [float(i % 8) for i in range(900)], [2.5] * 900]
    rows = spark.createDataFrame(list(zip(*cols)), "a double, b double, c double, d double")
    assert MO.split_points(rows.repartition(7), ["a", "b", "c", "d"], 8) == [plain(c, 8) for c in cols]
    assert MO.split_points(rows.withColumn("a", F.lit(None).cast("double")), ["a", "c"], 8) == [[], plain(cols[2], 8)]
