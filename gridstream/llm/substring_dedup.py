"""Substring dedup (operator 10): Rabin-Karp hashes of every fixed-length word
window, counted in Spark; repeated windows merge into maximal removal intervals.

Three steps, no step holds more than a slice of text or one hash bucket:

1. every slice of texts hashes all its windows with prefix sums (64 bits),
   keeps the earliest occurrence of each hash (a combiner: a passage that a
   third of all documents share leaves a slice once) and deals those out by
   hash bucket, packed;
2. a bucket sorts its hashes alone, unpacks the windows whose hash repeats, some
   at a time, finds the earliest occurrence of each over all slices and sends
   the later ones, packed by parts of the documents, to their documents;
3. the flagged windows of a document merge to intervals that are cut from it.

Edge cases: null and empty texts have no words and stay as they are; texts
shorter than a window lose nothing; a null doc_id sorts before all others;
repeated rows (same doc_id, same text) are one document and get equal results;
rows with one doc_id (or none) but different texts are told apart and ordered
by a 64-bit hash of the text: for n such texts n*n/2**65 pairs are expected to
be taken for one document (3e-8 at 10**6);
other columns pass through untouched, whatever their names; an empty table
gives an empty result.  Equal windows are recognised by 64-bit hashes: for n
windows n*n/2**65 pairs of different windows are expected to collide (5e-4 at
10**8 windows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstream.llm.common import in_batches, mix, rolling, shuffle_parts, slices, table, windows_of, words_of

WINDOW = 20
FIRST = -(1 << 63)                 # stands for a null doc_id
BUCKET_BYTES, WINDOW_BYTES = 64 << 20, 12
AT_ONCE = 500_000                  # repeated windows of a bucket that are unpacked together

PARTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("flags", T.BooleanType()),
                      T.StructField("body", T.BinaryType())])
SENT = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("body", T.BinaryType())])
FLAGS = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_key", T.LongType()),
                      T.StructField("starts", T.BinaryType())])


def _planes(a: np.ndarray) -> bytes:
    """Bytes of an integer array, all lowest bytes first (they pack better)."""
    return a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()


def _unplanes(raw: memoryview, dtype, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(raw, np.uint8, n * size).reshape(size, n).T.copy().view(dtype).ravel()


def pack(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, hashes: np.ndarray | None) -> bytes:
    """Windows in document order as bytes: one entry for each document's run."""
    cut = np.flatnonzero((np.diff(ids) != 0) | (np.diff(keys) != 0)) + 1
    heads = np.concatenate(([0], cut)).astype(np.int64)
    counts = np.diff(np.concatenate((heads, [ids.size])))
    step = np.diff(starts, prepend=0)
    step[heads] = starts[heads]
    return b"".join((np.array([heads.size, ids.size], np.int64).tobytes(), _planes(np.ascontiguousarray(ids[heads])),
                     _planes(keys[heads].astype(np.int64)), _planes(counts.astype(np.uint32)),
                     _planes(step.astype(np.uint32)), b"" if hashes is None else hashes.tobytes()))


def unpack(body: bytes | pa.Buffer, hashed: bool = True) -> tuple[np.ndarray, ...]:
    raw = memoryview(body)
    docs, n = np.frombuffer(raw, np.int64, 2)
    at = 16
    out = []
    for dtype, size in ((np.int64, docs), (np.int64, docs), (np.uint32, docs), (np.uint32, n)):
        out.append(_unplanes(raw[at:], dtype, size))
        at += int(size) * np.dtype(dtype).itemsize
    ids, keys, counts, step = out
    total = np.cumsum(step.astype(np.int64))
    heads = np.cumsum(counts) - counts
    base = (total[heads.astype(np.int64)] - step[heads.astype(np.int64)])
    starts = total - np.repeat(base, counts)
    hashes = np.frombuffer(raw, np.uint64, int(n), at) if hashed else np.zeros(0, np.uint64)
    return np.repeat(ids, counts), np.repeat(keys, counts), starts, hashes


def later_ones(hashes: np.ndarray, ids: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks (later than the earliest occurrence, the earliest itself) of windows."""
    n = hashes.size
    seen = np.sort(hashes)
    twice = np.unique(seen[1:][seen[1:] == seen[:-1]])
    first = np.ones(n, dtype=bool)
    later = np.zeros(n, dtype=bool)
    if twice.size:
        at = np.minimum(np.searchsorted(twice, hashes), twice.size - 1)
        some = np.flatnonzero(twice[at] == hashes)
        order = some[np.lexsort((starts[some], keys[some], ids[some], hashes[some]))]
        head = np.ones(order.size, dtype=bool)
        head[1:] = hashes[order[1:]] != hashes[order[:-1]]
        lead = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        later[order] = (ids[order] != ids[lead]) | (keys[order] != keys[lead]) | (starts[order] != starts[lead])
        first[order] = head
    return later, first


def windows_by_bucket(buckets: int, window: int):
    """Step 1: rows of packed windows, at most one for a hash and slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(part["text"])
            h, text, start = windows_of(words, window, rolling(window))
            if not h.size:
                continue
            ids = part["_id"].to_numpy()[text]
            keys = part["_key"].to_numpy()[text]
            order = np.lexsort((part["_key"].to_numpy(), part["_id"].to_numpy()))
            rank = np.empty(order.size, np.int64)
            rank[order] = np.arange(order.size)
            later, first = later_ones(h, ids, keys, start)
            where = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            out_bucket, out_flags, out_body = [], [], []
            if later.any():
                x = np.flatnonzero(later)
                x = x[np.argsort(rank[text[x]], kind="stable")]
                out_bucket.append(int(where[x[0]]))
                out_flags.append(True)
                out_body.append(pack(ids[x], keys[x], start[x], None))
            x = np.flatnonzero(first)
            x = x[np.lexsort((rank[text[x]], where[x]))]
            ends = np.flatnonzero(np.diff(where[x], append=-1)) + 1
            begin = 0
            for end in ends:
                y = x[begin:end]
                out_bucket.append(int(where[y[0]]))
                out_flags.append(False)
                out_body.append(pack(ids[y], keys[y], start[y], h[y]))
                begin = end
            yield pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int32()), pa.array(out_flags, pa.bool_()),
                                              pa.array(out_body, pa.binary())], ["bucket", "flags", "body"])
    return run


def hashes_of(body: pa.Buffer) -> np.ndarray:
    """The hashes of packed windows, without the rest."""
    n = int(np.frombuffer(body, np.int64, 2)[1])
    return np.frombuffer(body, np.uint64, n, body.size - 8 * n)


def hash_ranges(bodies: list[pa.Buffer], most: int) -> list[tuple[np.ndarray, np.uint64, np.uint64]]:
    """Of all hashes in ``bodies`` those that occur twice or more, in ranges of about
    ``most`` windows (the repeated hashes, least and largest hash of the range)."""
    seen = np.concatenate([hashes_of(b) for b in bodies])
    seen.sort()
    same = seen[1:] == seen[:-1]
    twice, upto = np.unique(seen[1:][same]), np.flatnonzero(same).size
    if not twice.size:
        return []
    cuts = np.unique(seen[1:][same][::most]) if upto > most else twice[:1]
    at = np.searchsorted(twice, cuts)
    return [(x, x[0], x[-1]) for x in np.split(twice, at[1:])]


def windows_with(body: pa.Buffer, twice: np.ndarray, least: np.uint64, largest: np.uint64) -> tuple[np.ndarray, ...]:
    """The packed windows whose hash is in ``twice``."""
    own = hashes_of(body)
    near = np.flatnonzero((own >= least) & (own <= largest))
    some = near[twice[np.searchsorted(twice, own[near])] == own[near]]
    return tuple(a[some] for a in unpack(body)) if some.size else ()


def dealt(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, parts: int) -> list[tuple[int, bytes]]:
    """Windows packed by part of the documents."""
    part = (mix(ids.view(np.uint64) ^ mix(keys.view(np.uint64), 1), 2) % np.uint64(parts)).astype(np.int32)
    order = np.lexsort((starts, keys, ids, part))
    cut = np.flatnonzero(np.diff(part[order], prepend=-1))
    out = [order[a:b] for a, b in zip(cut, np.append(cut[1:], order.size))]
    return [(int(part[x[0]]), pack(ids[x], keys[x], starts[x], None)) for x in out]


def repeats_of_bucket(parts: int, most: int = AT_ONCE):
    """Step 2: the windows of one bucket that also start earlier, packed by part of
    the documents.  The hashes tell which windows repeat, and only those are
    unpacked, about ``most`` at a time."""
    def run(rows: pa.Table) -> pa.Table:
        out: list[tuple[int, bytes]] = []
        held, bodies, n = [], [], 0
        for flags, body in zip(rows["flags"], rows["body"]):
            if not flags.as_py():
                bodies.append(body.as_buffer())
                continue
            held.append(unpack(body.as_buffer(), False)[:3])
            n += held[-1][0].size
            if n >= most:
                out += dealt(*map(np.concatenate, zip(*held)), parts)
                held, n = [], 0
        if held:
            out += dealt(*map(np.concatenate, zip(*held)), parts)
            held = []
        for twice, least, largest in hash_ranges(bodies, most) if bodies else []:
            ids, keys, starts, hashes = map(np.concatenate, zip(*filter(None, (windows_with(b, twice, least, largest) for b in bodies))))
            later, _ = later_ones(hashes, ids, keys, starts)
            if later.any():
                out += dealt(ids[later], keys[later], starts[later], parts)
        return pa.table({"part": pa.array([p for p, _ in out], pa.int32()), "body": pa.array([b for _, b in out], pa.binary())})
    return run


def flags_of_part(rows: pa.Table) -> pa.Table:
    """All flagged windows of each document of a part, as one row."""
    ids, keys, starts = (np.concatenate(x) for x in zip(*(unpack(b, False)[:3] for b in rows["body"].to_pylist())))
    order = np.lexsort((starts, keys, ids))
    ids, keys, starts = ids[order], keys[order], starts[order].astype(np.uint32)
    cut = np.concatenate(([0], np.flatnonzero((np.diff(ids) != 0) | (np.diff(keys) != 0)) + 1))
    raw = starts.tobytes()
    offsets = pa.py_buffer(np.concatenate((cut * 4, [len(raw)])).astype(np.int32).tobytes())
    bodies = pa.Array.from_buffers(pa.binary(), cut.size, [None, offsets, pa.py_buffer(raw)])
    return pa.table([pa.array(ids[cut], pa.int64()), pa.array(keys[cut], pa.int64()), bodies], ["_id", "_key", "starts"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("_id"),
                       F.xxhash64(text_col).alias("_key"), F.col(text_col).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_rest") if len(docs.columns) > 1 else
                       F.lit(None).cast("struct<none:int>").alias("_rest"))


def bucket_count(docs: DataFrame, text_col: str = "text", most: int = BUCKET_BYTES) -> int:
    """Hash buckets, so that one holds about ``most`` bytes of windows, and at
    least one for each shuffle partition; a word has six bytes, its window WINDOW_BYTES."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(shuffle_parts(docs.sparkSession), -(-size // 6 * WINDOW_BYTES // most))


def flagged_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(_id, _key, packed start words): the windows of each document that also start earlier."""
    buckets = bucket_count(docs, text_col)
    parts = in_batches(_keyed(docs, id_col, text_col).select("_id", "_key", "text"), windows_by_bucket(buckets, window), PARTS)
    sent = parts.groupBy("bucket").applyInArrow(repeats_of_bucket(buckets), SENT)
    return sent.groupBy("part").applyInArrow(flags_of_part, FLAGS)


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as all of them move to their flags."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column(2)
        body = pa.array([None if not t.is_valid else squeeze.compress(t.as_buffer()) for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), body, batch.column(3)],
                                         ["_id", "_key", "text", "_rest"])


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Words of a text inside at least one of the windows."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


def cut_text(raw: bytes, gone: np.ndarray) -> bytes:
    """The text without the words that ``gone`` marks: each removal interval
    goes with the white space up to the next kept word."""
    words = words_of(pa.array([raw], pa.binary()))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    out, at = [], 0
    for a, b in edge.reshape(-1, 2):
        out.append(raw[at:words.starts[a]])
        at = words.starts[b] if b < words.starts.size else len(raw)
    out.append(raw[at:])
    return b"".join(out)


def _removals(window: int, want_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            n_words, n_removed, result = [], [], []
            for body, flags in zip(batch.column(1), batch.column(2)):
                if not body.is_valid:
                    n_words.append(0)
                    n_removed.append(0)
                    result.append(None if want_text else hashlib.sha256(b"").hexdigest())
                    continue
                raw = expand.decompress(body.as_buffer())
                words = raw.split()
                some = flags.is_valid
                gone = covered(len(words), np.frombuffer(flags.as_buffer(), np.uint32).astype(np.int64), window) if some else None
                n_words.append(len(words))
                n_removed.append(int(gone.sum()) if some else 0)
                if want_text:
                    result.append((cut_text(raw, gone) if some else raw).decode())
                else:
                    left = compress(words, (~gone).tolist()) if some else words
                    result.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(result, pa.string())], ["_rest", "n_words", "n_removed", "result"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   digest: bool = False) -> DataFrame:
    """Every row with ``_rest`` (its other columns), ``n_words``, ``n_removed``
    and ``result``: the cut text, or with ``digest`` the SHA-256 of the kept
    words joined by one space."""
    keyed = _keyed(docs, id_col, text_col)
    rest = keyed.schema["_rest"]
    packed = in_batches(keyed, _packed_texts, T.StructType([
        T.StructField("_id", T.LongType()), T.StructField("_key", T.LongType()), T.StructField("text", T.BinaryType()), rest]))
    both = packed.join(flagged_windows(docs, id_col, text_col, window), ["_id", "_key"], "left")
    return in_batches(both.select("_rest", "text", "starts"), _removals(window, not digest), T.StructType([
        rest, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("result", T.StringType())]))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs, digest=True)
    return out.select(F.col("_rest.doc_id").alias("doc_id"), "n_words", "n_removed", F.col("result").alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with repeated passages cut from their texts."""
    out = remove_repeats(docs).withColumn("_text", F.col("result"))
    pick = [F.col("_text").alias("text") if c == "text" else
            F.length("_text").cast("long").alias("n_chars") if c == "n_chars" else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns]
    return out.select(*pick)


OP10_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
i AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
k AS (SELECT doc_id, i, string_agg(word, ' ') OVER f AS key, count(*) OVER f AS n FROM i
      WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
l AS (SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1 AS later FROM k WHERE n = 20),
c AS (SELECT i.doc_id, i.i, word, coalesce(max(CASE WHEN later THEN i.i END) OVER (PARTITION BY i.doc_id ORDER BY i.i) > i.i - 20, false) AS gone
      FROM i LEFT JOIN l USING (doc_id, i)),
r AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)
"""
