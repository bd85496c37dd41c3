"""Command line: run registered queries or start the streaming jobs.

  python -m gridstream list
  python -m gridstream query f14_features --sf /root/testdata/sf0.01 --out /path/out
  python -m gridstream features-job --source '/in/*' --features /t/features --dq /t/dq --checkpoint /c
  python -m gridstream pricing-job --source '/in/*' --prices /t/prices --alerts /t/alerts --checkpoint /c

On a cluster the session comes from spark-submit (master, checkpoint folder
and sizes are the deployment's); ``--local N`` starts a local session.
"""

from __future__ import annotations

import argparse
import os
import sys


def _session(local: str | None):
    from pyspark.sql import SparkSession

    from gridstream.session import CORE_CONF, ensure_checkpoint_dir, local_session
    if local:
        return local_session(local)
    b = SparkSession.builder.appName("gridstream")
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="gridstream")
    ap.add_argument("--local", default=None, help="run on local[N] instead of the submitted master")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf", required=True, help="folder with the input parquet tables")
    q.add_argument("--out", help="write parquet here (default: show 20 rows)")
    f = sub.add_parser("features-job")
    f.add_argument("--source", help="JSON-lines telemetry folder (glob)")
    f.add_argument("--kafka", help="bootstrap servers; reads topic ev-telemetry")
    f.add_argument("--features", required=True)
    f.add_argument("--dq", required=True)
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--window-minutes", type=int, default=15)
    f.add_argument("--capacity", type=float, default=15.0)
    f.add_argument("--once", action="store_true", help="process what is there and stop")
    p = sub.add_parser("pricing-job")
    p.add_argument("--source")
    p.add_argument("--kafka")
    p.add_argument("--prices", required=True)
    p.add_argument("--alerts", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--window-minutes", type=int, default=15)
    p.add_argument("--capacity", type=float, default=15.0)
    p.add_argument("--once", action="store_true")
    a = ap.parse_args(argv)

    sys.path.insert(0, os.getcwd())
    if a.cmd == "list":
        from gridstream.plans.catalog import REGISTRY
        from gridstream.plans.oracle import sql_map
        sql = sql_map()
        for n in sorted(REGISTRY):
            print(n, "(sql)" if n in sql else "")
        return 0
    spark = _session(a.local)
    if a.cmd == "query":
        from gridstream.plans.catalog import REGISTRY
        df = REGISTRY[a.name](spark, a.sf)
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            df.show(20, truncate=False)
        return 0
    from gridstream.streaming import jobs
    kafka = {"kafka.bootstrap.servers": a.kafka, "subscribe": "ev-telemetry"} if a.kafka else None
    trig = {"availableNow": True} if a.once else None
    if a.cmd == "features-job":
        qs = jobs.start_feature_job(spark, a.source, a.features, a.dq, a.checkpoint, a.window_minutes,
                                    a.capacity, kafka=kafka, trigger=trig)
    else:
        qs = [jobs.start_pricing_job(spark, a.source, a.prices, a.alerts, a.checkpoint, a.window_minutes,
                                     a.capacity, kafka=kafka, trigger=trig)]
    for s in qs:
        s.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
