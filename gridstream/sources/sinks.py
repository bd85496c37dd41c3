"""Sinks (S11-S13, S18, S20-S22, S24) as idempotent parquet writes.

Each sink is a function ``(batch DataFrame, path, ...)`` usable directly or
inside ``foreachBatch``; a replayed batch leaves the table unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Read with additive schema evolution (files with fewer columns
    read as NULL in the new ones)."""
    if not exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except Exception as e:      # noqa: BLE001 - a folder without data files yet
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "Unable to infer schema" in str(e):
            return None
        raise


def read_written(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that a job has written, by their declared schema: none where it had
    none to write, as then there are no files (nor perhaps a folder) to infer one from."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


# Upsert keyed (station_id, time_bin); the newest version by ``order``
# wins, in the batch and against what is stored.  Partitioned by day; only the
# days a batch touches are rewritten (dynamic overwrite).  Days compare
# null-safe, so stored rows without a day stay; rows with a null key can't be
# addressed and go to ``<path>-rejected``.
def upsert(batch: DataFrame, path: str, order: str, keys=("station_id", "time_bin"),
           day_col: str = "dt", ts_col: str = "time_bin") -> None:
    from gridstream.session import materialize
    spark = batch.sparkSession
    keys = list(keys)
    batch = materialize(batch)        # every step below reads one and the same batch
    unkeyed = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
    rejected = batch.where(unkeyed)
    if not rejected.isEmpty():
        rejected.write.mode("append").parquet(path + "-rejected")
    batch = batch.where(~unkeyed).withColumn(day_col, F.to_date(F.col(ts_col)))
    if batch.isEmpty():
        return
    old = read_table(spark, path)
    if old is not None:
        days = batch.select(F.col(day_col).alias("_day")).distinct()
        touched = old.join(days, old[day_col].eqNullSafe(F.col("_day")), "left_semi")
        batch = touched.unionByName(batch, allowMissingColumns=True)
    others = [c for c in batch.columns if c not in keys]
    newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r")).select(*keys, "_r.*")
    # the touched partitions are rewritten, so the write must not read them
    (materialize(newest).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_col).parquet(path))


# W06 + S14: a changelog of inserts, updates and deletes merged by key.  The
# newest record of a key by ``order`` wins, a delete before a value of the same
# order.  A delete leaves a marker row, so that older records that come late or
# again don't bring the key back; ``compact`` takes markers away once no
# record older than a point can come any more.
DELETED, VERSION = "_deleted", "_version"


def merge_changes(batch: DataFrame, path: str, order: str, keys=("station_id", "time_bin"), deleted: str = "deleted",
                  day_col: str = "dt", ts_col: str = "time_bin") -> None:
    """``batch`` has the keys, the values, ``deleted`` (true for a tombstone, whose
    values don't count) and ``order``.  Days a batch touches are rewritten, so a
    batch that comes again leaves the table as it is."""
    from gridstream.session import materialize
    spark = batch.sparkSession
    keys = list(keys)
    values = [c for c in batch.columns if c not in (*keys, deleted, order)]
    gone = F.coalesce(F.col(deleted), F.lit(False))
    batch = materialize(batch.select(
        *keys, *[F.when(~gone, F.col(c)).alias(c) for c in values], gone.alias(DELETED), F.col(order).cast("long").alias(VERSION),
        F.to_date(F.col(ts_col)).alias(day_col)))
    unkeyed = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
    if not (rejected := batch.where(unkeyed)).isEmpty():
        rejected.write.mode("append").parquet(path + "-rejected")
    batch = batch.where(~unkeyed)
    if batch.isEmpty():
        return
    old = read_table(spark, path)
    if old is not None:
        days = batch.select(F.col(day_col).alias("_day")).distinct()
        touched = old.join(days, old[day_col].eqNullSafe(F.col("_day")), "left_semi")
        batch = touched.unionByName(batch, allowMissingColumns=True)
    others = [c for c in batch.columns if c not in keys]
    newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(VERSION, DELETED)).alias("_r")).select(*keys, "_r.*")
    (materialize(newest).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_col).parquet(path))


def live_rows(spark: SparkSession, path: str) -> DataFrame:
    """The merged rows without delete markers."""
    return spark.read.option("mergeSchema", "true").parquet(path).where(f"NOT {DELETED}").drop(DELETED, VERSION)


def compact(spark: SparkSession, path: str, before: int, day_col: str = "dt") -> None:
    """Takes the markers of versions below ``before`` away; only days that have one are rewritten."""
    from gridstream.session import materialize
    old = spark.read.option("mergeSchema", "true").parquet(path)
    stale = F.col(DELETED) & (F.col(VERSION) < F.lit(int(before)))
    days = materialize(old.where(stale).select(F.col(day_col).alias("_day")).distinct())
    touched = old.join(days, old[day_col].eqNullSafe(F.col("_day")), "left_semi")
    # a day of nothing but markers keeps one row for the overwrite to write: its newest marker
    alive = F.max(F.when(~stale, 1).otherwise(0)).over(Window.partitionBy(day_col))
    newest = F.row_number().over(Window.partitionBy(day_col).orderBy(F.desc(VERSION)))
    kept = touched.withColumn("_alive", alive).withColumn("_nth", newest).where(~stale | ((F.col("_alive") == 0) & (F.col("_nth") == 1)))
    rows = materialize(kept.drop("_alive", "_nth"))
    if not rows.isEmpty():
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)


# Append idempotent by batch id (a replayed batch rewrites its own
# partition instead of adding rows).
def append_batch(batch: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    (batch.withColumn("batch_id", F.lit(int(batch_id)))
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("batch_id").format(fmt).save(path))


# Surrogate id = max existing id + a dense position, and a created_at
# default.  Positions follow ``key`` (a column distinct in the batch): rows are
# counted by ``slices`` hash slices of the key, the counts summed, and rows
# numbered per slice, so the same row gets the same id whenever it is computed.
def with_ids(batch: DataFrame, existing: DataFrame | None, key: str, slices: int = 1024) -> DataFrame:
    base = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar() if existing is not None else F.lit(0)
    d = batch.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(int(slices))))
    counts = d.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(key))
    return (d.withColumn("_pos", place).join(offsets, "_slice")
             .withColumn("id", (base + F.col("_off") + F.col("_pos")).cast("long"))
             .withColumn("created_at", F.current_timestamp()).drop("_slice", "_pos", "_off"))


# Insert-once guard: bins already stored are not inserted again, and of
# several rows of one bin in a batch the least by its other columns enters.
def insert_once(batch: DataFrame, path: str, key: str = "time_bin") -> DataFrame:
    spark = batch.sparkSession
    old = read_table(spark, path)
    new = batch if old is None else batch.join(old.select(key).distinct(), key, "left_anti")
    others = [c for c in batch.columns if c != key]
    new = new.groupBy(key).agg(F.min(F.struct(*others)).alias("_r")).select(key, "_r.*").select(*batch.columns)
    new.write.mode("append").parquet(path)
    return new


# Two sinks from one source in one pass: the shared input is persisted
# for the duration of the batch only.
def fan_out(batch: DataFrame, writers) -> None:
    batch.persist()
    try:
        for w in writers:
            w(batch)
    finally:
        batch.unpersist()


# Small result tables (comparison tables, sweeps) as one CSV file.
def export_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_text(spark: SparkSession, lines: list[str], path: str) -> None:
    spark.createDataFrame([(ln,) for ln in lines], "value string").coalesce(1) \
         .write.mode("overwrite").text(path)


def table_path(spark: SparkSession, name: str) -> str:
    from gridstream.session import scratch_path
    return scratch_path(spark, name)


__all__ = ["read_table", "read_written", "upsert", "merge_changes", "live_rows", "compact", "append_batch", "with_ids", "insert_once", "fan_out", "export_csv",
           "export_text", "table_path"]
