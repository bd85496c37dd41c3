"""Token-ID / binary output (operator 2): flat unsigned integer files plus
64-bit document offsets, memory-mapped; partition bases come from prefix sums.

Documents are dealt to shards by ranges of doc_id and sorted inside a shard.
A shard is three flat little-endian files:

* ``<shard>.ids``      all token ids, one after the other (uint16, or uint32
  where the vocabulary has more than 65,536 ids);
* ``<shard>.offsets``  n_docs + 1 uint64 positions in the ids of this shard;
* ``<shard>.docs``     n_docs int64 document ids.

The manifest has a row for each shard; the running sum of the shards' token
counts gives each shard's base, so a document's place among all ids is its
shard's base plus its offset.  A shard is written under a name of the attempt
and then renamed, and its content depends only on its rows, so a task that
runs again leaves the same files.

Texts are encoded by the tokenizers library, each distinct space-separated
word of a slice once: the tokenizer's pattern never matches across white
space, and normalisation doesn't reach across it (checked in the tests).
Plain Latin words go to the library many at a time; what it returns is cut
where tokens close a word.

Edge cases: a null or empty text is the end id alone; a null doc_id sorts
first; rows with equal doc_id follow one another by text; other columns are
not read; an empty table gives an empty manifest and an empty result.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstream.llm.common import in_batches, shared_path, shuffle_parts, slices, table, written

NO_ID = -(1 << 63)                 # a null doc_id in the .docs file
END_ID = 1
CACHE_WORDS = 400_000              # words a Python worker remembers, about 60 MB
_TOKENIZERS: dict = {}


def ragged_take(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``index`` of a ragged array, and the offsets of the result."""
    sizes = np.diff(offsets)[index]
    to = np.concatenate(([0], np.cumsum(sizes)))
    return values[np.repeat(offsets[:-1][index] - to[:-1], sizes) + np.arange(to[-1])], to


# Words of Latin letters, digits and plain signs, without apostrophe and angle
# brackets: the tokenizer's pattern cuts them where letters, single digits and
# other signs meet, and each piece ends in one token that closes a word.
_PLAIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff0-9!-&(-;=?@\[-`{-~]+")
_PIECE = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]|[^A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff0-9]+")
TOGETHER = 256                     # plain words that are encoded as one text


class WordEncoder:
    """Ids of texts by the ids of their words, remembered per worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, int] = {}
        self.values, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and their sizes: plain words many at a time, split
        again where their pieces close, all others one by one."""
        plain = np.fromiter((_PLAIN.fullmatch(w) is not None for w in words), bool, len(words))
        some = [w for w, p in zip(words, plain.tolist()) if p]
        texts = [" ".join(some[i:i + TOGETHER]) for i in range(0, len(some), TOGETHER)]
        flat, _ = self._each(texts)
        pieces = np.fromiter((1 if w.isalpha() else len(_PIECE.findall(w)) for w in some), np.int64, len(some))
        ends = np.flatnonzero(self.closes[flat]) + 1
        if ends.size != pieces.sum():               # not cut as expected: encode them one by one
            return self._each(words)
        upto = np.concatenate(([0], ends[np.cumsum(pieces) - 1] if pieces.size else [])).astype(np.int64)
        rest, rest_sizes = self._each([w for w, p in zip(words, plain.tolist()) if not p])
        sizes = np.empty(len(words), np.int64)
        sizes[plain], sizes[~plain] = np.diff(upto), rest_sizes
        order = np.empty(len(words), np.int64)
        order[plain], order[~plain] = np.arange(len(some)), len(some) + np.arange(rest_sizes.size)
        both = np.concatenate((flat, rest))
        offsets = np.concatenate((upto, upto[-1] + np.cumsum(rest_sizes)))
        return ragged_take(both, offsets, order)[0], sizes

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id``, and n_texts + 1 offsets."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        place = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(place < 0)
        new = [words[i] for i in missing.tolist()]
        flat, sizes = self._words(new)
        place[missing] = self.offsets.size - 1 + np.arange(missing.size)
        values = np.concatenate((self.values, flat, np.array([end_id], np.uint32)))
        offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(sizes), [values.size]))
        room = max(0, CACHE_WORDS - len(self.known))
        if room and new:
            n = self.offsets.size - 1 + min(room, len(new))
            self.known.update(zip(new[:room], range(self.offsets.size - 1, n)))
            self.offsets = offsets[:n + 1].copy()
            self.values = values[:self.offsets[-1]].copy()
        first = np.concatenate(([0], np.cumsum(counts)))
        index = np.insert(place[coded.indices.to_numpy()], first[1:], offsets.size - 2)
        out, to = ragged_take(values, offsets, index)
        return out, to[first + np.arange(first.size)]


def _encoder(path: str) -> WordEncoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordEncoder(path)
    return _TOKENIZERS[path]


def _write_shards(folder: str, tokenizer: str, end_id: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        names = ("ids", "offsets", "docs")
        attempt = f"{base}/.{shard}-{uuid.uuid4().hex}"
        out = None
        docs = total = 0
        for part in slices(batches):
            if out is None:
                out = {n: fs.open_output_stream(f"{attempt}.{n}") for n in names}
                out["offsets"].write(np.zeros(1, "<u8").tobytes())
            ids, to = _encoder(tokenizer).encode(part["text"].combine_chunks(), end_id)
            out["ids"].write(ids.astype(dtype).tobytes())
            out["offsets"].write((to[1:] + total).astype("<u8").tobytes())
            out["docs"].write(pc.fill_null(part["doc_id"], NO_ID).to_numpy().astype("<i8").tobytes())
            docs += part.num_rows
            total += ids.size
        if out is None:
            return
        for n in names:
            out[n].close()
            fs.move(f"{attempt}.{n}", f"{base}/{shard}.{n}")
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [docs], "n_tokens": [total]})
    return run


def id_type(tokenizer: str, end_id: int = END_ID) -> str:
    """The least unsigned type that holds every id of a vocabulary and the end id."""
    from tokenizers import Tokenizer
    most = max([end_id, *Tokenizer.from_file(tokenizer).get_vocab().values()])
    return "<u2" if most < 1 << 16 else "<u4"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, dtype: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards to ``folder`` (which driver and executors share, on a
    file system that pyarrow can write) and returns the manifest: shard,
    n_docs, n_tokens, dtype, base.  ``dtype`` is the vocabulary's, or a wider one."""
    spark = docs.sparkSession
    least = id_type(tokenizer, end_id)
    dtype = dtype or least
    if np.dtype(dtype).itemsize < np.dtype(least).itemsize:
        raise ValueError(f"{dtype} doesn't hold all ids: {least} does")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = own.repartitionByRange(shuffle_parts(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    # The manifest is one small file, so the tasks that encode write the shards alone.
    shards = written(in_batches(ordered, _write_shards(folder, tokenizer, end_id, dtype),
                                "shard long, n_docs long, n_tokens long").repartition(1), "manifest")
    # One row for each shard, so a single window orders them.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("dtype", F.lit(dtype)).withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def mapped(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the file system is local."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def _read_shards(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{base}/{row['shard']}"
                ids = mapped(fs, f"{path}.ids", row["dtype"])
                to = mapped(fs, f"{path}.offsets", "<u8").astype(np.int64)
                docs = mapped(fs, f"{path}.docs", "<i8")
                for at in range(0, docs.size, 4096):
                    cut = to[at:at + 4097]
                    some = memoryview(ids[cut[0]:cut[-1]].astype("<u4").tobytes())
                    ends = (cut - cut[0]) * 4
                    sums = [zlib.crc32(some[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    own = np.array(docs[at:at + 4096])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, mask=own == NO_ID), pa.array(cut[:-1] + row["base"]), pa.array(np.diff(cut)),
                         pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """A row for each document, from the files alone."""
    n = shuffle_parts(manifest.sparkSession)
    return manifest.select("shard", "dtype", "base").repartition(n, "shard").mapInArrow(
        _read_shards(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = shared_path(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest, folder)
