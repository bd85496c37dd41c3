"""Ranked lexical search (operator 13): presence-mask grouping.

Terms are maximal runs of letters, digits and characters beyond ASCII, A-Z
lower-cased.  Items (the queries) are taken in blocks of BLOCK_BYTES of text;
for a block every document is read once and coded: its number of terms, and
the terms of the block that it has with their counts.  From the coded table
come the corpus counts (documents with a term, terms in all, documents of each
term) and with them integer weights.

Then each task scores its share of the coded documents in blocks.  For an item,
the presence rows of its terms are packed into a bit mask for each document;
documents are grouped by their mask.  A mask has a maximum score: the
weights of its terms times the largest share that the term has in a document
of the block.  Distinct masks are evaluated by descending maximum score until
the next one lies under the k-th best score that the task has found for the
item so far, when no document that is left can enter (an equal maximum is
still evaluated, as ties go to the smaller doc_id).  A task gives at most k
rows for an item; a ranking window merges them.

All scores are 64-bit integers and exact.  What a task holds is a block of
documents times the terms of one item; items with many terms get smaller
blocks of documents.

Edge cases: a null or termless item has no rows; a null or termless document is
never found; documents are rows, so several rows of one doc_id may all be
found; a null doc_id sorts first among ties; rows of items are items of their
own, equal ones give equal rows; fewer than k documents above 0 give all of
them; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstream.llm.common import in_batches, slices, table, text_bytes, written

TOP = 20
BLOCK_BYTES = 1 << 20              # text of a block of items
DOCS = 4096                        # documents of a block
CELLS = 1 << 24                    # documents of a block x terms of an item, at most
STEP = 256                         # documents that are evaluated at a time, about
NO_ID = -(1 << 63)                 # a null doc_id

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOWER[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def split_terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a string column, one after the other, and n + 1 offsets."""
    data, bounds = text_bytes(column)
    lowered = _LOWER[data]
    texts = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(lowered))
    lists = pc.ascii_split_whitespace(texts)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(sizes.size), sizes)
    terms = lists.flatten()
    some = pc.greater(pc.binary_length(terms), 0)
    kept = owner[some.to_numpy(zero_copy_only=False)]
    return terms.filter(some), np.concatenate(([0], np.cumsum(np.bincount(kept, minlength=sizes.size)))).astype(np.int64)


_CODED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])


def _code(vocabulary: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_string())
        for part in slices(batches):
            terms, to = split_terms(part["text"])
            place = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            n = np.diff(to)
            owner = np.repeat(np.arange(n.size), n)
            hit = place >= 0
            cells, counts = np.unique(owner[hit] * len(vocabulary) + place[hit], return_counts=True)
            doc, term = np.divmod(cells, max(1, len(vocabulary)))
            ends = pa.array(np.searchsorted(doc, np.arange(n.size + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].combine_chunks(), pa.array(n), pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32)))], schema=_CODED)
    return run


class Postings:
    """A block of documents by term: places of the documents and the term's
    share (10^9 tf div (1000 tf + 12 m)) in each."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, counts: np.ndarray, n_docs: int, n_terms: int):
        m = 75 + 25 * n * n_docs // n_terms
        tf = counts.astype(np.int64)
        share = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        order = np.argsort(term, kind="stable")
        self.doc, self.share, self.size = doc[order], share[order], n.size
        own, starts = np.unique(term[order], return_index=True)
        ends = np.append(starts[1:], order.size)
        most = np.maximum.reduceat(self.share, starts) if order.size else starts
        self.lists = dict(zip(own.tolist(), zip(starts.tolist(), ends.tolist(), most.tolist())))


def masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of a boolean matrix (one bit mask for each
    document), as columns of a matrix, and the number of each document's."""
    bits = np.packbits(present, axis=0)
    wide = np.zeros((bits.shape[1], -(-bits.shape[0] // 8) * 8), np.uint8)
    wide[:, :bits.shape[0]] = bits.T
    words = wide.view(np.uint64)
    group = np.unique(words[:, 0], return_inverse=True)[1]
    for i in range(1, words.shape[1]):
        _, more = np.unique(words[:, i], return_inverse=True)
        group = np.unique(group * np.int64(present.shape[1]) + more, return_inverse=True)[1]
    _, first = np.unique(group, return_index=True)
    return present[:, first], group


def best_in_block(block: Postings, ids: np.ndarray, terms: list[tuple[int, int]], k: int,
                  scores: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, doc_id) of those found before and of the block's, for
    an item of ``terms`` (term, weight)."""
    own = [(*block.lists[t], w) for t, w in terms if t in block.lists]
    if not own:
        return scores, found
    present = np.zeros((len(own), block.size), bool)
    share = np.zeros((len(own), block.size), np.int32)
    for j, (a, b, _, _) in enumerate(own):
        present[j, block.doc[a:b]] = True
        share[j, block.doc[a:b]] = block.share[a:b]
    weights = np.array([w for *_, w in own], np.int64)
    distinct, group = masks(present)
    bound = (weights * np.array([most for _, _, most, _ in own], np.int64)) @ distinct
    ranked = np.argsort(-bound, kind="stable")
    place = np.empty_like(ranked)
    place[ranked] = np.arange(ranked.size)
    docs = np.argsort(place[group], kind="stable")          # documents by descending maximum score
    ends = np.cumsum(np.bincount(place[group], minlength=ranked.size))
    at = 0                                                   # the next mask
    while at < ranked.size:
        least = max(1, int(scores[-1]) if scores.size == k else 1)
        safe = int(np.searchsorted(-bound[ranked], -least, side="right"))     # masks before it may still enter
        if at >= safe:
            break
        begin = int(ends[at - 1]) if at else 0
        to = min(safe, int(np.searchsorted(ends, begin + STEP)) + 1)
        some = docs[begin:int(ends[to - 1])]
        got = weights @ share[:, some].astype(np.int64)
        above = got >= least
        scores, found = np.concatenate((scores, got[above])), np.concatenate((found, ids[some[above]]))
        keep = np.lexsort((found, -scores))[:k]
        scores, found = scores[keep], found[keep]
        at = to
    return scores, found


_FOUND = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _rank(items: list[tuple[int | None, list[tuple[int, int]]]], n_docs: int, n_terms: int, k: int):
    size = max(16, min(DOCS, CELLS // max([1, *(len(t) for _, t in items)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(items)
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column("terms")
                doc = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                block = Postings(part.column("n").to_numpy(), doc, lists.flatten().to_numpy(), part.column("counts").flatten().to_numpy(),
                                 n_docs, n_terms)
                ids = pc.fill_null(part.column("doc_id"), NO_ID).to_numpy()
                best = [best_in_block(block, ids, terms, k, *b) for (_, terms), b in zip(items, best)]
        sizes = [s.size for s, _ in best]
        if sum(sizes):
            found = np.concatenate([f for _, f in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(items)), sizes)),
                 pa.array([i for (i, _), n in zip(items, sizes) for _ in range(n)], pa.int64()),
                 pa.array(found, mask=found == NO_ID), pa.array(np.concatenate([s for s, _ in best]))], schema=_FOUND)
    return run


def _block_ranked(docs: DataFrame, items: list, k: int) -> DataFrame:
    """item_id, rank, doc_id, score of a block of items (item_id, text, copies)."""
    spark = docs.sparkSession
    terms, to = split_terms(pa.array([i["text"] for i in items], pa.string()))
    terms, own = terms.to_pylist(), []
    for a, b in zip(to[:-1], to[1:]):
        own.append(Counter(terms[a:b]))
    vocabulary = sorted(set(terms))
    place = {t: i for i, t in enumerate(vocabulary)}
    coded = written(in_batches(docs, _code(vocabulary), "doc_id long, n long, terms array<int>, counts array<int>")
                    .where("n > 0"), "coded")
    n_docs, n_terms = coded.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = dict(map(tuple, coded.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for t, i in place.items()}
    coded_items = [(i["item_id"], [(place[t], weight[t] * n) for t, n in c.items() if weight[t]]) for i, c in zip(items, own)]
    copies = spark.createDataFrame([(j, int(i["copies"])) for j, i in enumerate(items)], "item long, copies long")
    found = in_batches(coded.where(F.size("terms") > 0), _rank(coded_items, n_docs, n_terms, k),
                       "item long, item_id long, doc_id long, score long")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    if any(i["copies"] > 1 for i in items):
        ranked = ranked.join(copies, "item").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The k documents of the highest scores above 0 for each row of ``items``:
    item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    own = (items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
           .groupBy("item_id", "text").agg(F.count("*").alias("copies")))
    own = written(own, "items")
    n = max(1, -(-(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    numbered = own.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(n):                                       # a block of items is all that the driver holds
        block = numbered.where(F.col("block") == b).collect()
        if block:
            out = out.unionByName(_block_ranked(docs, block, k))
    return out


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
it AS (SELECT item, item_id, t, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS t FROM i) GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
dt AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(terms) AS t FROM d) WHERE t IN (SELECT t FROM it) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM dt, c GROUP BY t, n_docs),
m AS (SELECT row, doc_id, 100 - 25 + (25 * len(terms) * n_docs) // n_terms AS m FROM d, c WHERE len(terms) > 0),
s AS (SELECT it.item, it.item_id, m.row, m.doc_id, CAST(sum(it.times * w.w * ((1000000000 * dt.tf) // (1000 * dt.tf + 12 * m.m))) AS BIGINT) AS score
      FROM it JOIN w USING (t) JOIN dt USING (t) JOIN m USING (row) GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
