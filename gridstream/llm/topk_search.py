"""Exact top-k search (operator 4): exhaustive term-at-a-time accumulation.

Vectors become integers floor(256 * x) and lie in blocks: candidate blocks
transposed to postings (one list of (vector, weight) for each dimension that
occurs), query blocks as sparse rows.  A candidate block is copied once for
each group of query blocks; the rows of both are dealt by (candidate block,
group) and sorted, so a task builds a block's postings once and streams the
group's query blocks past them, one after another.  Nothing is broadcast, and
the work is the stated query set against all rows, in blocks.  Each query
scatters its weighted postings term by term into a dense score array over the
block, partition selection takes its k best there, and the blocks' lists are
merged by a ranking window.

Blocks are dealt by a hash of vec_id, their sizes are about the parameters'.
Integer sums are exact: 32-bit where no sum of the query with the block can
leave that range, else 64-bit, for weights up to 2**27 or so.

Edge cases: vectors that are null, hold a null or a non-finite component, or
have a null vec_id take no part; vectors may differ in length, missing
components count as zero and an empty vector scores 0 with all; a vec_id on
several rows counts once, with its least vector; ties go to the smaller
vec_id; fewer than k candidates give all of them; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstream.llm.common import in_batches, shuffle_parts, table, written

BLOCK = 8192                       # candidates of a block
QUERIES = 1024                     # queries of a block
GROUP = 16                         # query blocks that share a copy of a candidate block
SCALE = 256


def quantised(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, w): one row for each id with a whole, finite vector."""
    x = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = x.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & sound)
    return (whole.select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE)).alias("w"))
            .groupBy("vec_id").agg(F.min("w").alias("w")))


def _packed(number: str):
    """Rows (block, n, ids, sizes, weights) of consecutive vectors of a block."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        w = rows["w"].combine_chunks()
        return pa.table({number: rows[number].slice(0, 1), "ids": [rows["vec_id"].to_numpy().astype("<i8").tobytes()],
                         "sizes": [np.asarray(w.value_lengths()).astype("<i4").tobytes()],
                         "weights": [w.flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()]})
    return run


def _blocks(vectors: DataFrame, number: str, size: int) -> tuple[DataFrame, int]:
    n = max(1, -(-vectors.count() // size))
    numbered = vectors.withColumn(number, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
    packed = numbered.groupBy(number).applyInArrow(_packed(number), f"{number} int, ids binary, sizes binary, weights binary")
    return packed, n


class Postings:
    """A candidate block: for each dimension the vectors that have it and their
    weights, or the weights of all where most vectors have it."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        owner = np.repeat(np.arange(sizes.size), sizes)
        term = np.arange(weights.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.ids, self.most = ids, float(np.abs(weights.astype(np.float64)).max(initial=0))
        some = np.flatnonzero(weights)
        order = some[np.argsort(term[some], kind="stable")]
        cut = np.flatnonzero(np.diff(term[order], prepend=-1))
        ends = np.append(cut[1:], order.size)
        kind = np.int32 if self.most < 2**31 else np.int64
        self.lists = {}
        for a, b in zip(cut, ends):
            where, weight = owner[order[a:b]], weights[order[a:b]].astype(kind)
            if 2 * where.size > sizes.size:
                every = np.zeros(sizes.size, kind)
                every[where] = weight
                where, weight = None, every
            self.lists[int(term[order[a]])] = (where, weight)

    def scores(self, own: np.ndarray) -> np.ndarray:
        """Inner products of a query row with all vectors of the block."""
        small = self.most * float(np.abs(own.astype(np.float64)).sum()) < 2**31
        kind = np.int32 if small else np.int64
        out, product = np.zeros(self.ids.size, kind), np.empty(self.ids.size, kind)
        for term in np.flatnonzero(own).tolist():
            if term in self.lists:
                where, weight = self.lists[term]
                part = np.multiply(weight, kind(own[term]), out=product[:weight.size], dtype=kind)
                if where is None:
                    out += part
                else:
                    out[where] += part
        return out


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; of equal ones the first places."""
    if scores.size <= k:
        return np.arange(scores.size)
    least = np.partition(scores, scores.size - k)[scores.size - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate((above, np.flatnonzero(scores == least)[:k - above.size]))


def _vectors(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["sizes"], "<i4").astype(np.int64),
            np.frombuffer(row["weights"], "<i8"))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["qb"] < 0:
                    at, block = (row["cb"], row["qg"]), Postings(*_vectors(row))
                elif at == (row["cb"], row["qg"]):
                    yield _best(block, *_vectors(row), k)
    return run


def _best(block: Postings, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of a candidate block for each query of a query block."""
    out_query, out_id, out_score = [], [], []
    ends = np.cumsum(sizes)
    for query, start, end in zip(ids, ends - sizes, ends):
        scores, others = block.scores(weights[start:end]), block.ids
        place = int(np.searchsorted(others, query))
        if place < others.size and others[place] == query:
            scores, others = np.delete(scores, place), np.delete(others, place)
        best = best_of(scores, k)
        out_query.append(np.full(best.size, query))
        out_id.append(others[best])
        out_score.append(scores[best].astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out_query, out_id, out_score)],
                                      ["query_id", "vec_id", "score"])


def top_k(rows: DataFrame, queries, k: int = 5, block: int = BLOCK, query_block: int = QUERIES, group: int = GROUP,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score; ``queries`` is a condition on vec_id."""
    vectors = written(quantised(rows, id_col, vec_col), "vectors")
    own, n_own = _blocks(vectors.where(queries), "qb", query_block)
    every, n_every = _blocks(vectors, "cb", block)
    groups = -(-n_own // group)
    left = every.select("cb", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("qg"), F.lit(-1).alias("qb"),
                        "ids", "sizes", "weights")
    right = own.select(F.explode(F.sequence(F.lit(0), F.lit(n_every - 1))).alias("cb"), F.pmod("qb", F.lit(groups)).alias("qg"),
                       "qb", "ids", "sizes", "weights")
    # dealt in full, as a block is few bytes but much work; its postings' row comes first
    dealt = left.union(right).repartition(shuffle_parts(rows.sparkSession), "cb", "qg").sortWithinPartitions("cb", "qg", "qb")
    found = in_batches(dealt, _search(k), "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP4_SQL = """
WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
t AS (SELECT vec_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
      FROM t q JOIN t c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
a AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(s.score, 0) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
      LEFT JOIN s ON s.query_id = q.vec_id AND s.vec_id = c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM a)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
