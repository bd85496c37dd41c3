"""The registered streams in a session with Spark's defaults, but for two shuffle partitions (no settings of ours)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
STREAMS = ["w02_late_readings", "w08_session_state"]      # two stateful jobs; the other tests' session has no state store set either
SCRIPT = """
import sys
import duckdb
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
before = dict(spark.conf.getAll)
sf = "/root/testdata/sf0.001"
con = duckdb.connect()
con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
norm = lambda v: repr(round(v, 6)) if isinstance(v, float) else str(v)
for name in sys.argv[1:]:
    df = E.queries()[name](spark, sf)
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    want = sorted("|".join(map(norm, r)) for r in res.fetchall())
    got = sorted("|".join(norm(r[n]) for n in names) for r in df.collect())
    print("SAME" if got == want and sorted(names) == sorted(df.columns) else "DIFFERENT", name, len(got))
after = dict(spark.conf.getAll)
print("KEPT" if all(after.get(k) == v for k, v in before.items()) and not any("stateStore" in k for k in after) else "CHANGED")
"""


def test_streams_in_a_plain_session():
    done = subprocess.run([sys.executable, "-c", SCRIPT, *STREAMS], cwd=ROOT, env=os.environ | {"PYTHONPATH": os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH"))))},
                          capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [x.split()[:2] for x in done.stdout.splitlines() if x.startswith(("SAME", "DIFF"))] == [["SAME", n] for n in STREAMS], done.stdout
    assert "KEPT" in done.stdout
