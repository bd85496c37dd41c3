"""The message log and what reads it: offsets, changes with tombstones, routing, buffers, the interval join."""

import json
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstream.operators import sketches as QS
from gridstream.sources import message_log as ML
from gridstream.sources import messages as MS
from gridstream.sources import sinks as SK
from gridstream.streaming import jobs
from gridstream.streaming import queries as SQ
from gridstream.streaming.starting import start

from conftest import SF_SMALL


def msgs(spark, rows):
    return spark.createDataFrame(rows, "key string, value string")


def test_offsets_are_places_in_a_partition(spark, tmp_path, monkeypatch):
    log = str(tmp_path)
    a = [(f"k{i % 50}" if i % 97 else None, f"{i:06d}") for i in range(20000)]
    b = [(f"k{i % 50}", f"{i:06d}") for i in range(20000, 21000)]
    assert ML.append(msgs(spark, a), log, "t", 3, order=("value",)) == 20000
    assert ML.append(msgs(spark, b), log, "t", 3, order=("value",)) == 1000
    assert ML.append(msgs(spark, []), log, "t", 3) == 0
    got = ML.read(spark, log, "t").collect()
    assert Counter((r.key, r.value) for r in got) == Counter(a + b) and {r.topic for r in got} == {"t"}
    parts = {}
    for r in got:
        parts.setdefault(r.partition, []).append((r.offset, r.value, r.key))
    assert len(parts) == 3 and max(map(len, parts.values())) > ML.BATCH_ROWS
    for rows in parts.values():
        rows.sort()
        assert [o for o, *_ in rows] == list(range(len(rows)))
        assert [v for _, v, _ in rows] == sorted(v for _, v, _ in rows)          # appends follow one another
    assert all(len({r.partition for r in got if r.key == k}) == 1 for k in ("k1", "k7"))
    some = {p: len(rows) - 10 for p, rows in parts.items()}
    spark.dataSource.register(ML.MessageLog)
    late = (spark.read.format("message_log").option("subscribe", "t").option("splitRows", 3)
            .option("startingOffsets", json.dumps({"t": {str(p): o for p, o in some.items()}})).load(log))
    assert late.count() == 30 and late.rdd.getNumPartitions() == 12
    assert all(r.offset >= some[r.partition] for r in late.collect())
    assert ML.read(spark, log, "missing").count() == 0


def test_latest_of_a_group_is_kept(spark, tmp_path):
    log = str(tmp_path)
    ML.append(msgs(spark, [("a", "1"), ("b", "2")]), log, "t", 2)
    reader = lambda which, group: ML.StreamReader({"path": log, "subscribe": "t", "startingOffsets": which, **({"group": group} if group else {})})
    first = reader("latest", "g").initialOffset()
    ML.append(msgs(spark, [("a", "3")] * 5), log, "t", 2)
    assert reader("latest", "g").initialOffset() == first != reader("latest", None).initialOffset()
    assert sum(reader("earliest", None).initialOffset().values()) == 0 and sum(reader("earliest", None).latestOffset().values()) == 7
    spans = reader("latest", "g").partitions(first, reader("latest", "g").latestOffset())
    assert sum(s.last - s.first for s in spans) == 5 and reader("earliest", None).partitions(first, first) == []


CHANGES = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("time_bin", T.StringType()), T.StructField("v", T.DoubleType())])


def test_changes_merge_in_any_order(spark, tmp_path):
    """The newest version wins whatever comes when; a marker keeps a deleted key away until it is compacted."""
    rows = [("a", "2024-01-01 00:00:00", 1.0, False, 1), ("a", "2024-01-01 00:00:00", 2.0, False, 3), ("b", "2024-01-01 00:00:00", 5.0, False, 1),
            ("b", "2024-01-01 00:00:00", None, True, 4), ("b", "2024-01-01 00:00:00", 6.0, False, 2), ("c", "2024-01-02 00:00:00", 7.0, False, 5),
            ("c", "2024-01-02 00:00:00", None, True, 5), ("d", "2024-01-02 00:00:00", None, True, 6), ("d", "2024-01-02 00:00:00", 8.0, False, 7),
            (None, "2024-01-02 00:00:00", 9.0, False, 8)]
    schema = "station_id string, time_bin string, v double, deleted boolean, version long"
    for seed in range(3):
        path = str(tmp_path / f"t{seed}")
        shuffled = random.Random(seed).sample(rows, len(rows))
        for i in range(0, len(rows), 4):
            SK.merge_changes(spark.createDataFrame(shuffled[i:i + 4], schema), path, "version")
        SK.merge_changes(spark.createDataFrame(shuffled[:5], schema), path, "version")          # again
        live = lambda: sorted((r.station_id, r.v) for r in SK.live_rows(spark, path).collect())
        assert live() == [("a", 2.0), ("d", 8.0)]
        markers = lambda: spark.read.parquet(path).where(SK.DELETED).count()
        assert markers() == 2 and spark.read.parquet(path + "-rejected").count() >= 1
        SK.compact(spark, path, before=5)
        assert markers() == 1 and live() == [("a", 2.0), ("d", 8.0)]
        SK.compact(spark, path, before=100)
        assert markers() == 0 and live() == [("a", 2.0), ("d", 8.0)]


def test_changes_of_messages(spark):
    d = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1.5, False), ("b|x", "t", 2.0, True)], "station_id string, time_bin string, v double, deleted boolean")
    m = MS.encode_changes(d, "t").withColumn("offset", F.lit(7))
    assert [r.value is None for r in m.orderBy("key").collect()] == [False, True]
    bad = m.limit(1).withColumn("value", F.lit("{broken"))
    got = MS.decode_changes(m.unionByName(bad), CHANGES).collect()
    assert [(r.station_id, r.v, r.deleted, r.offset) for r in got if not r.deleted] == [("a", 1.5, False, 7)]
    assert [(r.station_id, r.v, r.deleted) for r in got if r.deleted] == [("b", None, True)] and len(got) == 2


def test_router_gives_every_message_one_place(spark, tmp_path):
    schemas = {"p-1": CHANGES, "q": T.StructType([T.StructField("n", T.LongType())])}
    rows = [("p-1", "k", '{"station_id":"a","time_bin":"t","v":1.0}'), ("p-1", "k", '{"time_bin":"t"}'), ("p-1", "k", '{"station_id":"a"'),
            ("p-1", "k", '{"station_id":"a","v":"x"}'), ("p-1", "k", None), ("q", None, '{"n":5}'), ("q", None, '{}'), ("q", None, "[]"), ("q", None, ""),
            ("z", "k", '{"n":5}'), (None, "k", '{"n":5}')]
    d = spark.createDataFrame(rows, "topic string, key string, value string")
    path = str(tmp_path / "routed")
    out = MS.routed_rows(d, schemas, {"p-1": ["station_id"], "q": ["n"]})
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2      # each schema once
    for _ in range(2):
        MS.write_routed(out, path, 3)                                                           # again: replaced
    stored = spark.read.parquet(path)
    assert [(r.station_id, r.v) for r in MS.read_topic(stored, schemas, "p-1").collect()] == [("a", 1.0)]
    assert [r.n for r in MS.read_topic(stored, schemas, "q").collect()] == [5]
    dead = Counter((r.topic, r.reason) for r in MS.dead_letters(stored).collect())
    assert dead == {("p-1", "missing station_id"): 1, ("p-1", "undecodable"): 2, ("q", "missing n"): 1 + dead.get(("q", "missing n"), 1) - 1,
                    ("q", "undecodable"): 3 - dead[("q", "missing n")], ("z", "unknown topic"): 1, (None, "unknown topic"): 1}
    assert sum(dead.values()) + 2 == len(rows) - 1


def test_buffer_is_the_top_k_after_every_batch(spark, tmp_path):
    r = random.Random(2)
    schema = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("arrival", T.LongType()), T.StructField("v", T.DoubleType())])
    src, out, state = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "state")
    every = []
    for batch in range(3):
        rows = [(f"s{r.randrange(9)}", r.randrange(10000), None if r.random() < 0.2 else r.random()) for _ in range(120)]
        every += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = jobs.start_buffer_job(spark.readStream.schema(schema).parquet(src), out, state, 25, ["arrival", "station_id"], shards=3, trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None
        got = [tuple(x) for x in jobs.read_buffer(spark, out, 25, ["arrival", "station_id"]).collect()]
        want = sorted(every, key=lambda x: (x[1], x[0]), reverse=True)[:25]
        assert [g[:2][::-1] for g in got] == [(x[1], x[0]) for x in want] and Counter(got) == Counter(want)


def test_interval_join_clears_its_state(spark, tmp_path):
    """Windows of 40 hours in eight batches: the state holds those near the watermark only."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "station_id string, window_start timestamp, mean_kwh double"
    for b in range(8):
        rows = spark.range(20).selectExpr("'a' AS station_id", f"timestamp_seconds(1704067200 + ({b} * 20 + id) * 900) AS window_start", f"CAST({b} * 20 + id AS double) AS mean_kwh")
        rows.where("window_start != timestamp'2024-01-01 05:00:00'").coalesce(1).write.mode("append").parquet(src)
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start(spark, SQ.rate_by_join(read(), read()).writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True))
    q.awaitTermination(300)
    assert q.exception() is None
    rates = {r.mean_kwh: r.rate_of_change for r in spark.read.parquet(out).collect()}
    assert len(rates) == 159 and rates[0.0] == 0.0 and rates[21.0] == 0.0 and all(v == 1.0 for k, v in rates.items() if k not in (0.0, 21.0))
    held = [sum(o.numRowsTotal for o in p.stateOperators) for p in q.recentProgress]
    assert max(held) <= 45 and held[-1] <= 8


def test_merged_sketches_are_near(spark):
    d = spark.range(50000).selectExpr("CAST(pow(id % 1000, 2) AS double) AS v", "timestamp_seconds(1704067200 + id * 60) AS ts")
    sketches = QS.daily_sketches(d, "v", "ts")
    assert sketches.count() == 35
    for q in (0.05, 0.5, 0.95):
        n, x = QS.merged_quantile(sketches, q).first()
        r = QS.rank_of(d, "v", F.lit(x)).first()
        assert n == r.n == 50000 and r.below <= q + 0.01 and r.upto >= q - 0.01
    assert QS.merged_quantile(QS.daily_sketches(d.limit(0), "v", "ts"), 0.5).first().n is None


def test_slices_leave_several_files(spark, monkeypatch):
    """A slice is written by several tasks and is one micro-batch."""
    from gridstream.plans import logs
    monkeypatch.setattr(logs, "FILE_ROWS", 100)
    d = spark.range(1000).select("id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * F.col("id")).alias("at"))
    path, files = logs.in_slices(d, "at", "slices-test")
    got = spark.read.schema(d.schema).parquet(path)
    assert files == 5                                   # of 1000 squares 500 lie in the first quarter
    assert len(got.inputFiles()) == 4 * files
    assert sorted(r.id for r in got.collect()) == list(range(1000))
    rows = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", files).parquet(path)
    seen = []
    q = start(spark, rows.writeStream.foreachBatch(lambda b, i: seen.append((i, b.agg(F.min("id"), F.max("id")).first())))
              .option("checkpointLocation", tempfile.mkdtemp(prefix="gs-slices-", dir="/tmp")).trigger(availableNow=True))
    q.awaitTermination(300)
    assert q.exception() is None
    assert [(i, *r) for i, r in seen] == [(0, 0, 499), (1, 500, 706), (2, 707, 865), (3, 866, 999)]


def test_recent_rows_hold_no_more_than_they_keep():
    """A batch of many frames passes by; what stays is the newest ``keep`` rows, nulls last."""
    import gc
    import pandas as pd
    from gridstream.streaming.processors import RecentRows
    live = []

    class Payload(str):
        def __new__(cls, text):
            live.append(1)
            return super().__new__(cls, text)

        def __del__(self):
            live.pop()

    class Held:
        def __init__(self):
            self.rows = []

        def getListState(self, name, schema, ttl=None):
            return self

        def exists(self):
            return bool(self.rows)

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

    order = [(i * 7919) % 1000 for i in range(1000)]
    most = []

    def frames():
        for i in range(0, 1000, 50):
            gc.collect()
            most.append(len(live))
            yield pd.DataFrame({"at": pd.array([None if x % 100 == 7 else x for x in order[i:i + 50]], dtype="object"),
                                "text": [Payload(f"t{x}") for x in order[i:i + 50]]})

    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("text", T.StringType())])
    state, proc = Held(), RecentRows(schema, 20, ["at", "text"])
    proc.init(state)
    list(proc.handleInputRows((0,), frames(), None))
    assert [r[0] for r in state.rows] == list(range(999, 979, -1))
    assert max(most) <= 20 + 4 * 50
    assert RecentRows(schema, 3, ["at"]).keep == 3


def test_sinks_get_features_computed_once(spark, monkeypatch):
    """The batches of s11 and of the changelog read a written table: none computes the rolling windows again."""
    import __spark_entry__ as E
    q = E.queries()
    from gridstream.plans import catalog, logs
    plans = []
    upsert, encode = catalog.SK.upsert, logs.MS.encode_changes

    def seen(fn):
        def call(df, *a, **k):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return fn(df, *a, **k)
        return call

    monkeypatch.setattr(catalog.SK, "upsert", seen(upsert))
    monkeypatch.setattr(logs.MS, "encode_changes", seen(encode))
    q["s11_upsert_replay"](spark, SF_SMALL)
    q["w06_compacted_changelog"](spark, SF_SMALL)
    assert len(plans) == 7 and not any("Window [" in p for p in plans)
