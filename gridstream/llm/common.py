"""Shared helpers: tables, the shared folder, and vectorised words of texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gridstream.session import scratch_path

SPACES = " \t\n\x0b\f\r"          # what separates words: \x20 and \x09-\x0D
SLICE_BYTES = 2 << 20              # text a task works on at a time
BLOCK_BYTES = 512 << 10            # bytes hashed at a time
BATCH_BYTES = 4 << 20              # of an Arrow batch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path in the folder that driver and executors share."""
    return scratch_path(spark, f"llm-{kind}-{uuid.uuid4().hex}")


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most BATCH_BYTES: what a Python worker
    holds doesn't grow with the length of the texts."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) > BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df.mapInArrow(function, schema)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- words of texts -----------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds) in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Well-mixed 64-bit values of ``x`` under ``salt``."""
    return _mixed(x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))


BASE = 0x5851F42D4C957F2D          # odd, so it has an inverse modulo 2**64
_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[[ord(c) for c in SPACES]] = False
_BYTE_VALUE = mix(np.arange(256, dtype=np.uint64), 1)
_BYTE_VALUE[~_WORD_BYTE] = 0


@lru_cache(maxsize=4)
def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or BASE**-i) modulo 2**64 for i < n."""
    b = pow(BASE, -1, 1 << 64) if inverse else BASE
    out = np.full(n, b, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def _rounded(n: int, least: int) -> int:
    while least < n:
        least *= 2
    return least


class Words(NamedTuple):
    """Words of consecutive texts: hashes, byte spans and first word per text."""

    hashes: np.ndarray     # uint64 per word
    starts: np.ndarray     # byte position of each word in ``data``
    ends: np.ndarray
    first: np.ndarray      # n_texts + 1 word offsets
    data: np.ndarray       # bytes of all texts
    bounds: np.ndarray     # n_texts + 1 byte offsets in ``data``


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def words_of(column: pa.Array) -> Words:
    """Polynomial (Rabin-Karp) hashes of all words of a string column."""
    data, bounds = text_bytes(column)
    n = data.size
    inside = _WORD_BYTE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    heads = bounds[:-1][bounds[:-1] < n]
    begin[heads] = inside[heads]
    tails = bounds[1:][bounds[1:] > 0] - 1
    finish[tails] = inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    hashes = np.empty(starts.size, dtype=np.uint64)
    at = 0
    while at < starts.size:
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, side="right")))
        size = ends[to - 1] - low
        span = _rounded(size, BLOCK_BYTES)
        values = _BYTE_VALUE[data[low:low + size]]
        values *= powers(span)[:size]
        own = starts[at:to] - low
        part = np.add.reduceat(values, own)
        part *= powers(span, True)[own]
        part += (ends[at:to] - starts[at:to]).astype(np.uint64)
        hashes[at:to] = _mixed(part)
        at = to
    return Words(hashes, starts, ends, np.searchsorted(starts, bounds), data, bounds)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES,
           together: bool = True) -> Iterator[pa.Table]:
    """The batches again, cut and joined to tables of about ``most`` bytes of text."""
    kept, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        upto = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at, n = 0, batch.num_rows
        while at < n:
            done = upto[at - 1] if at else 0
            to = min(n, max(at + 1, int(np.searchsorted(upto, done + most - size, side="right"))))
            kept.append(batch.slice(at, to - at))
            size += int(upto[to - 1] - done)
            at = to
            if size >= most or at < n or not together:
                yield pa.Table.from_batches(kept)
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)


def windows_of(words: Words, length: int, hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, start word in its text) of every window of ``length`` words
    within one text, in order."""
    counts = np.maximum(np.diff(words.first) - length + 1, 0)
    text = np.repeat(np.arange(counts.size), counts)
    begin = np.cumsum(counts) - counts
    start = np.arange(text.size) - begin[text]
    at = words.first[:-1][text] + start
    return hashed(words.hashes)[at] if text.size else np.zeros(0, np.uint64), text, start


def rolling(length: int):
    """Rabin-Karp over word hashes by prefix sums: one value per start word."""
    def run(h: np.ndarray) -> np.ndarray:
        n = h.size
        span = _rounded(n + 1, BLOCK_BYTES // 8)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(h * powers(span)[:n], out=total[1:])
        m = max(0, n - length + 1)
        out = (total[length:length + m] - total[:m]) * powers(span, True)[:m]
        return _mixed(out)
    return run
