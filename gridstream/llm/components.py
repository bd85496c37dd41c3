"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstream.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Edges have u > v: every lower neighbour but the least points to the least."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, longs); the root
    is the least node of the component.  Each round is two shuffles of the
    edge table with partial minima, written to the shared folder; the number
    of rounds grows with the logarithm of the largest component's diameter.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct(), "edges")
    before = _signature(e)
    for _ in range(most_rounds):
        if not before[0]:
            break
        e = written(_small_star(_large_star(e)), "edges")
        now = _signature(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
