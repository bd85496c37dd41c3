"""Starting streaming queries in any session.

The stateful processors keep several state variables with timers, which needs
the RocksDB state store.  Each partition of a stateful operator is a store of its
own that is opened, committed and kept open in every micro-batch, with or without
keys, and adaptive execution doesn't join them, so their number follows the cores.
A query takes its session's settings when it starts, so they are set for the start
alone and put back: the caller's session stays as it was, and other queries of it
keep their own store.  A restart keeps the number that its checkpoint has.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gridstream import config as C

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_LOCK = threading.RLock()


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """The settings for the time of a block; those not set before are unset again."""
    with _LOCK:
        before = {k: v for k, v in spark.conf.getAll.items() if k in conf}
        try:
            for k, v in conf.items():
                spark.conf.set(k, v)
            yield
        finally:
            for k in conf:
                if k in before:
                    spark.conf.set(k, before[k])
                else:
                    spark.conf.unset(k)


def state_partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions, but not more than two for a core (``C.STATE_PARTITIONS`` on few cores)."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(C.STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism))


def start(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    with _LOCK, session_conf(spark, STREAM_CONF | {"spark.sql.shuffle.partitions": str(state_partitions(spark))}):
        return writer.start()
