"""Registered queries over the message log: offset policies, a changelog with
tombstones, topics routed in one pass, buffers in state, the interval join; and
the variant payload and quantile sketches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream import schemas as SC
from gridstream.functions.rules import format_ts, latency_ok
from gridstream.operators import features as FE
from gridstream.operators import pricing as PR
from gridstream.operators import sketches as QS
from gridstream.plans.catalog import features_of, messages_of, priced_of, register, tel
from gridstream.plans.common import rounded
from gridstream.plans.streams import FILE_ROWS, MESSAGE, ONCE, finish, place, run
from gridstream.session import materialize
from gridstream.sources import message_log as ML
from gridstream.sources import messages as MS
from gridstream.sources import sinks as SK
from gridstream.sources.telemetry import PROFILE_A, PROFILE_B
from gridstream.streaming import jobs
from gridstream.streaming import queries as SQ
from gridstream.streaming.starting import start

TOPIC = "ev-telemetry"


# ---------------------------------------------------------------------------
# Where a stream begins, and where it goes on
# ---------------------------------------------------------------------------

def halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The readings of the first and of the second half of their time, as messages."""
    t = tel(spark, sf_dir, PROFILE_A)
    us = F.unix_micros("event_time")
    middle = t.agg(F.floor((F.min(us) + F.max(us)) / 2)).scalar()
    encoded = lambda d: MS.encode(d.select(*MESSAGE), TOPIC)
    return encoded(t.where(us < middle)), encoded(t.where(us >= middle))


def two_runs(spark, sf_dir, starting: str) -> tuple[DataFrame, int]:
    """A stream that runs after the first half is in the log, and again after the
    second: what it has stored, and how much of it after the first run."""
    log, out, checkpoint = place(spark, "log"), place(spark, "stored"), place(spark, "stream-state")
    first = 0
    for half in halves(spark, sf_dir):
        ML.append(half, log, TOPIC, order=("value",))
        msgs = SQ.message_stream(spark, log={"path": log, "topics": TOPIC, "starting": starting, "group": "registered"})
        q = start(spark, msgs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**ONCE))
        finish(q)
        stored = spark.read.schema(msgs.schema).parquet(out) if SK.exists(spark, out) else spark.createDataFrame([], msgs.schema)
        first = first or stored.count()
    return stored, first


def by_station(msgs: DataFrame) -> DataFrame:
    rec = msgs.select("partition", "offset", F.from_json("value", SC.TELEMETRY_SEQ).alias("r"))
    return rec.groupBy("r.station_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("partition", "offset").alias("n_offsets"),
                                           F.sum("r.kwh").alias("kwh"))


@register("w10_earliest")
def q_earliest(spark, sf_dir):
    """A stream from the earliest offset sees all messages of both halves once."""
    return rounded(by_station(two_runs(spark, sf_dir, "earliest")[0]))


@register("w10_latest")
def q_from_latest(spark, sf_dir):
    """A stream that came when the first half was there sees the second only."""
    return rounded(by_station(two_runs(spark, sf_dir, "latest")[0]))


@register("w10_resume")
def q_resume(spark, sf_dir):
    """A restart goes on at the checkpoint's offsets: rows after each run, and offsets without a gap."""
    stored, first = two_runs(spark, sf_dir, "earliest")
    whole = stored.groupBy("partition").agg((F.max("offset") + 1).alias("top"), F.count_distinct("offset").alias("n"))
    gaps = whole.agg(F.sum(F.col("top") - F.col("n"))).scalar()
    return stored.agg(F.lit(first).cast("long").alias("n_first"), F.count(F.lit(1)).alias("n_all"), gaps.alias("n_missing"))


# ---------------------------------------------------------------------------
# W06 + S14: a changelog with tombstones
# ---------------------------------------------------------------------------

CHANGE = SC.T.StructType([SC.T.StructField("station_id", SC.T.StringType()), SC.T.StructField("time_bin", SC.T.StringType()),
                          SC.T.StructField("mean_kwh", SC.T.DoubleType()), SC.T.StructField("anomaly_flag", SC.T.IntegerType())])


def changelog(spark, sf_dir) -> str:
    """Every window inserted, windows with load updated (one kWh more), idle windows
    deleted: in the log one after the other, merged by a job in two runs; then the
    whole log once more through a job of its own, into the same table."""
    log, path, checkpoint = place(spark, "log"), place(spark, "merged"), place(spark, "stream-state")
    f = materialize(features_of(spark, sf_dir, PROFILE_B).select("station_id", "time_bin", "mean_kwh", "anomaly_flag"))     # read three times
    idle = F.col("mean_kwh") == 0
    changes = [f.withColumn("deleted", F.lit(False)), f.where(~idle).withColumn("mean_kwh", F.col("mean_kwh") + 1).withColumn("deleted", F.lit(False)),
               f.where(idle).withColumn("deleted", F.lit(True))]

    def merge(at: str) -> None:
        msgs = SQ.message_stream(spark, log={"path": log, "topics": "features"})
        finish(jobs.start_changelog_job(msgs, CHANGE, path, at, trigger=ONCE))

    for i, some in enumerate(changes):
        ML.append(MS.encode_changes(some, "features"), log, "features")
        if i:
            merge(checkpoint)
    merge(place(spark, "stream-state"))
    return path


@register("s14_changelog")
def q_changelog(spark, sf_dir):
    """S14 + W06: the rows that live after inserts, updates, tombstones and a replay."""
    return rounded(SK.live_rows(spark, changelog(spark, sf_dir)).select("station_id", "time_bin", "mean_kwh", "anomaly_flag"))


@register("w06_compacted_changelog")
def q_compacted(spark, sf_dir):
    """Delete markers before and after compaction, and the live rows, which it leaves."""
    path = changelog(spark, sf_dir)
    count = lambda: spark.read.parquet(path).agg(F.count_if(SK.DELETED).alias("m"), F.count_if(~F.col(SK.DELETED)).alias("n")).first()
    before = count()
    SK.compact(spark, path, before=1 << 62)
    after = count()
    # a day of markers only keeps one
    return spark.createDataFrame([(before.n, before.m, after.n, after.m)], "n_live long, n_markers long, n_live_after long, n_markers_after long")


# ---------------------------------------------------------------------------
# S15 + S17: topics in one pass, with dead letters
# ---------------------------------------------------------------------------

SCHEMAS = {"dynamic-prices": SC.PRICES, "data-quality": SC.DATA_QUALITY_IN}
REQUIRED = {"dynamic-prices": ["station_id", "time_bin"], "data-quality": ["station_id"]}


def routed_table(spark, sf_dir) -> DataFrame:
    """Price and data-quality messages through the router: of seven classes of
    stations one's messages are cut short, one's lack the station, one's come by
    an unknown topic, one's are tombstones."""
    log, path = place(spark, "log"), place(spark, "routed")
    dq = FE.data_quality_rows(FE.clean_readings(tel(spark, sf_dir, PROFILE_A)))
    for topic, rows in (("dynamic-prices", priced_of(spark, sf_dir, day_ahead=False)), ("data-quality", dq)):
        k = F.col("key").cast("int") % 7
        msgs = MS.encode(rows, topic).withColumn("value", F.when(k == 0, F.expr("left(value, length(value) - 3)"))
                                                 .when(k == 1, F.regexp_replace("value", '"station_id":"[0-9]+",', ""))
                                                 .when(k != 3, F.col("value")))
        ML.append(msgs.where(k != 2), log, topic)
        ML.append(msgs.where(k == 2), log, f"old-{topic}")
    msgs = SQ.message_stream(spark, log={"path": log, "topics": ",".join([*SCHEMAS, *(f"old-{t}" for t in SCHEMAS)])})
    finish(jobs.start_router_job(msgs, SCHEMAS, REQUIRED, path, place(spark, "stream-state"), trigger=ONCE))
    return spark.read.parquet(path)


@register("s17_routed_topics")
def q_routed(spark, sf_dir):
    return routed_table(spark, sf_dir).groupBy("topic", "target", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@register("s15_accepted_prices")
def q_accepted(spark, sf_dir):
    """The price records that the router let through, decoded."""
    r = MS.inference_rows(MS.read_topic(routed_table(spark, sf_dir), SCHEMAS, "dynamic-prices"))
    return rounded(r.select("station_id", format_ts("time_bin").alias("time_bin"), "predicted_kwh", "dynamic_price_cad", "session_status", "alert_level"))


@register("s19_raw_variant")
def q_raw_variant(spark, sf_dir):
    """Data-quality events stored with their payload as VARIANT, whose fields are read back from the table."""
    path = place(spark, "variant")
    d = FE.data_quality_rows(FE.clean_readings(tel(spark, sf_dir, PROFILE_A)))
    ok, _ = MS.decode(MS.encode(d, "data-quality"), SC.DATA_QUALITY_IN, ["station_id"])
    MS.data_quality_events(ok, variant=True).write.parquet(path)
    field = lambda name, kind: F.variant_get("raw_payload", f"$.{name}", kind).alias(name)
    return rounded(spark.read.parquet(path).select(field("station_id", "string"), field("time_new", "string"), field("original_kwh", "double"),
                                                   field("rolling_mean_kwh", "double"), field("reason", "string")))


# ---------------------------------------------------------------------------
# D14 and W05 in a stream
# ---------------------------------------------------------------------------

def in_slices(df: DataFrame, ts: str, name: str, slices: int = 4) -> tuple[str, int]:
    """``df`` as files of equal slices of its time, written in order, and the number
    of files that each slice leaves: that many are one micro-batch."""
    spark, path, staged = df.sparkSession, place(df.sparkSession, name), place(df.sparkSession, f"{name}-staged")
    us = F.unix_micros(ts)
    df.write.parquet(staged)
    d = spark.read.schema(df.schema).parquet(staged)
    low, high = d.agg(F.min(us).alias("low"), F.max(us).alias("high")).select("low").scalar(), d.agg(F.max(us)).scalar()
    i = F.least(F.lit(slices - 1), F.floor((us - low) * slices / F.greatest(high - low, F.lit(1))))
    rows = {r["i"]: r["count"] for r in d.groupBy(i.alias("i")).count().collect()}
    files = max(1, math.ceil(max(rows.values(), default=0) / FILE_ROWS))
    for k in range(slices):
        d.where(i == k).repartition(files).write.parquet(f"{path}/{k}")
        written = len(spark.read.schema(df.schema).parquet(f"{path}/{k}").inputFiles())
        for _ in range(files - written):                  # tasks without rows write no file
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(f"{path}/{k}")
    return f"{path}/*", files


ARRIVAL = ["arrival_ms", "station_id"]


@register("d14_stream_buffer")
def q_stream_buffer(spark, sf_dir):
    """The newest price messages by arrival, kept in the state of a stream."""
    msgs = messages_of(spark, sf_dir)
    (path, files), out = in_slices(msgs, "window_start", "priced"), place(spark, "buffer")
    rows = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", files).parquet(path).select(*PR.PRICE_OUT, "arrival_ms")
    finish(jobs.start_buffer_job(rows, out, place(spark, "stream-state"), C.PRICE_BUFFER_SIZE, ARRIVAL, trigger=ONCE))
    return rounded(jobs.read_buffer(spark, out, C.PRICE_BUFFER_SIZE, ARRIVAL).select(*PR.PRICE_OUT))


@register("w05_rate_by_join")
def q_rate_by_join(spark, sf_dir):
    """Rates of change by the interval join of the windows with themselves.  A window
    without a predecessor leaves too: the watermark, 30 seconds behind the last
    window, is later than any predecessor."""
    p = PROFILE_A
    wins = FE.window_features(FE.clean_readings(tel(spark, sf_dir, p)), p.window_minutes, p.capacity).select("station_id", "window_start", "mean_kwh")
    path, files = in_slices(wins, "window_start", "windows")
    read = lambda: spark.readStream.schema(wins.schema).option("maxFilesPerTrigger", files).parquet(path)
    rates = run(SQ.rate_by_join(read(), read(), p.window_minutes), "rates")[0]
    return rounded(rates.select("station_id", format_ts("window_start").alias("time_bin"), "mean_kwh", "rate_of_change"))


# ---------------------------------------------------------------------------
# P04 and D08b on sketches
# ---------------------------------------------------------------------------

def sketch_check(df: DataFrame, value: str, ts: str, q: float) -> DataFrame:
    """Daily sketches written, merged and read; the exact rank of their quantile."""
    spark, path = df.sparkSession, place(df.sparkSession, "sketches")
    QS.daily_sketches(df, value, ts).write.parquet(path)
    got = QS.merged_quantile(spark.read.parquet(path), q)
    rank = QS.rank_of(df, value, got.select("quantile").scalar())
    near = (F.col("below") <= q + RANK_ERROR) & (F.col("upto") >= q - RANK_ERROR)
    return rank.select("n", got.select("n").scalar().alias("n_sketched"), near.alias("near"))


RANK_ERROR = 0.01


@register("d08_latency_sketch")
def q_latency_sketch(spark, sf_dir):
    """D08b over all messages: the 95th percentile of the latencies from daily sketches."""
    msgs = messages_of(spark, sf_dir, day_ahead=False).withColumn("latency_ms", (F.col("arrival_ms") - F.col("kafka_ts_ms")).cast("double"))
    return sketch_check(msgs.where(latency_ok()), "latency_ms", "created_at", 0.95)


@register("p04_rated_power_sketch")
def q_rated_sketch(spark, sf_dir):
    """P04 on sketches: the 95th percentile of the stations' mean readings, by the day of a station's last reading."""
    means = tel(spark, sf_dir, PROFILE_B).groupBy("station_id").agg(F.avg("kwh").alias("mean"), F.max("event_time").alias("last"))
    return sketch_check(means, "mean", "last", C.RATED_POWER_QUANTILE)
