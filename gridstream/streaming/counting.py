"""Counts of streaming queries that last over restarts.

``recentProgress`` forgets: it holds the last batches of one run.  ``Counts``
listens to the progress of queries and leaves one small JSON file for each
micro-batch, named by the query's id (which a restart keeps) and the batch's
number: input rows, rows that stateful operators dropped behind the watermark,
and what the query observes (``DataFrame.observe``).  A batch that runs again
after a failure overwrites its file, so ``totals`` counts each batch once.  A
driver that dies between a batch's commit and its report loses that report.
"""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

BATCH_COUNTS = "query string, batch_id long, input_rows long, dropped long, observed map<string, long>"


class Counts(StreamingQueryListener):
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self.failed: list[Exception] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {f"{name}.{field}": int(value) for name, row in p.observedMetrics.items()
                    for field, value in row.asDict().items() if value is not None}
        row = {"query": str(p.id), "batch_id": int(p.batchId), "input_rows": int(p.numInputRows),
               "dropped": sum(int(o.numRowsDroppedByWatermark) for o in p.stateOperators), "observed": observed}
        try:
            self._write(f"{self.folder}/{p.id}-{p.batchId}.json", json.dumps(row))
        except Exception as e:      # noqa: BLE001 - told to whoever waits for the counts
            self.failed.append(e)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def _write(self, path: str, text: str) -> None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Waits until all reports of an ended run are written: a run's end is told after its batches."""
        if not self.ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the end of the query was not told")
        if self.failed:
            raise self.failed[0]


@contextmanager
def counting(spark: SparkSession, folder: str):
    """``Counts`` of all queries that run within the block."""
    counts = Counts(spark, folder)
    spark.streams.addListener(counts)
    try:
        yield counts
    finally:
        spark.streams.removeListener(counts)


def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each query and micro-batch."""
    return spark.read.schema(BATCH_COUNTS).json(folder).where("query is not null")


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each query: batches, input_rows, dropped."""
    return batch_counts(spark, folder).groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("dropped").alias("dropped"))


def observed_total(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    """(query, total) of an observed count, ``name.field``."""
    return batch_counts(spark, folder).groupBy("query").agg(F.coalesce(F.sum(F.col("observed")[metric]), F.lit(0)).alias("total"))
