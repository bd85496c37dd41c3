"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Settings every job relies on; cluster deployments keep their own sizes.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "gridstream", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(CORE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master may do without: it gets a folder of its own, removed
    when the process ends.  On a cluster a missing setting is an error, as a
    machine-local folder would lose what other machines wrote.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = _OWN.get(sc.applicationId)
        if base is None:
            base = _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="gridstream-ckpt-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


_OWN: dict[str, str] = {}     # local masters only: application id -> its folder


_FOLDERS: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table, in a folder of this application under
    the shared one; the folder goes when the driver's process ends."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridstream/{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove, spark.sparkContext._jvm, folder)
    return f"{folder}/{name}"


def _remove(jvm, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except (Py4JError, OSError):      # the JVM has ended before
        pass


def materialize(df, name: str | None = None):
    """Cut lineage by writing ``df`` as a parquet table under the shared
    ``spark.checkpoint.dir`` and reading it back.

    Used where a plan would otherwise be recomputed several times (scalar
    subqueries plus the main query, or one table feeding two branches).
    Unlike ``checkpoint()`` the input is computed once, the files survive a
    lost executor (never a local checkpoint), and the re-read carries real
    size statistics for AQE.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, name or f"m-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
