"""A message log in files with real offsets (W10): topics, partitions, positions.

``append`` adds keyed messages to a topic: a message's partition is a hash of
its key, its offset its place in the partition.  A partition is a folder of
segments, Arrow files named ``<first offset>-<messages>``; a segment is
written under another name first, so a reader sees whole ones only.  The data
source ``message_log`` reads topics in batch and as a stream:

* ``startingOffsets``: ``earliest``, ``latest``, or JSON of the first offset of
  each partition (``{"topic": {"0": 5}}``; partitions left out start at 0);
* a stream's progress is in its checkpoint, which decides after a restart;
* ``group``: the first position is also kept in the log under this name, so that
  ``latest`` means the end of the log when the group first came, also where
  nothing was there to read and so nothing to checkpoint;
* ``splitRows``: messages a task reads at most.

The folder must be on a file system that pyarrow opens on driver and executors.
An append is not a transaction: its partitions appear one after the other, and
one that is repeated adds its messages again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "message_log"
BATCH_ROWS = 4096                       # messages of an Arrow batch in a segment
SPLIT_ROWS = 1 << 18
MESSAGE = pa.schema([("key", pa.string()), ("value", pa.string())])
READ = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string())])
_SEGMENT = re.compile(r"(\d+)-(\d+)\.arrow$")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    fs, base = pafs.FileSystem.from_uri(path)
    return fs, base.rstrip("/")


def _children(fs: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    return sorted(fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)), key=lambda f: f.base_name)


def segments(path: str, topic: str) -> dict[int, list[tuple[int, int, str]]]:
    """(first offset, messages, file) of the segments of each partition, in order."""
    fs, base = _open(path)
    out = {}
    for folder in _children(fs, f"{base}/{topic}"):
        if folder.base_name.isdigit():
            found = [(m, f.path) for f in _children(fs, folder.path) if (m := _SEGMENT.match(f.base_name))]
            out[int(folder.base_name)] = sorted((int(m[1]), int(m[2]), p) for m, p in found)
    return out


def ends(path: str, topic: str) -> dict[int, tuple[int, int]]:
    """The first offset there is and the next one to come, of each partition."""
    return {p: (s[0][0], s[-1][0] + s[-1][1]) if s else (0, 0) for p, s in segments(path, topic).items()}


class _Segment:
    """A segment in the making, in batches of equal length so that an offset finds its batch."""

    def __init__(self, fs: pafs.FileSystem, folder: str):
        self.fs, self.folder, self.n, self.held, self.rows = fs, folder, 0, [], 0
        fs.create_dir(folder, recursive=True)
        self.temporary = f"{folder}/.{uuid.uuid4().hex}"
        self.sink = fs.open_output_stream(self.temporary)
        self.writer = pa.ipc.new_file(self.sink, MESSAGE)

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.rows += batch.num_rows
        self.n += batch.num_rows
        if self.rows >= BATCH_ROWS:
            self._write(self.rows // BATCH_ROWS * BATCH_ROWS)

    def _write(self, rows: int) -> None:
        table = pa.Table.from_batches(self.held, MESSAGE).combine_chunks()
        self.writer.write_table(table.slice(0, rows), BATCH_ROWS)
        self.held, self.rows = table.slice(rows).to_batches(), self.rows - rows

    def close(self, first: int) -> int:
        if self.rows:
            self._write(self.rows)
        self.writer.close()
        self.sink.close()
        self.fs.move(self.temporary, f"{self.folder}/{first:020d}-{self.n}.arrow")
        return self.n


def _write_segments(path: str, topic: str, first: dict[int, int]):
    """One segment for each partition; rows come partition by partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(path)
        segment, own, done = None, None, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), parts.size] if parts.size else []
            for a, b in zip(cut[:-1], cut[1:]):
                if int(parts[a]) != own:
                    if segment:
                        done.append((own, segment.close(first.get(own, 0))))
                    own = int(parts[a])
                    segment = _Segment(fs, f"{base}/{topic}/{own}")
                segment.add(pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a)], schema=MESSAGE))
        if segment:
            done.append((own, segment.close(first.get(own, 0))))
        yield pa.RecordBatch.from_pydict({"partition": pa.array([p for p, _ in done], pa.int32()), "messages": pa.array([m for _, m in done], pa.int64())})
    return run


def append(msgs: DataFrame, path: str, topic: str, partitions: int = 8, order: tuple[str, ...] = ()) -> int:
    """Adds messages (key, value) to a topic and returns how many.  ``order``:
    columns that put the messages of a partition in order."""
    old = ends(path, topic)
    n = max([partitions, *(p + 1 for p in old)])
    part = F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(n)).cast("int")
    dealt = (msgs.withColumn("partition", part).repartition(n, "partition").sortWithinPartitions("partition", *order)
             .select("partition", F.col("key").cast("string"), F.col("value").cast("string")))
    run = _write_segments(path, topic, {p: end for p, (_, end) in old.items()})
    return dealt.mapInArrow(run, "partition int, messages long").agg(F.coalesce(F.sum("messages"), F.lit(0))).first()[0]


class Span(InputPartition):
    """Offsets ``first`` to ``last`` (not included) of a segment."""

    def __init__(self, topic: str, partition: int, path: str, base: int, first: int, last: int):
        super().__init__(None)
        self.topic, self.partition, self.path, self.base, self.first, self.last = topic, partition, path, base, first, last


def read_span(log: str, s: Span) -> Iterator[pa.RecordBatch]:
    fs, _ = _open(log)
    with fs.open_input_file(s.path) as f:
        reader = pa.ipc.open_file(f)
        at = s.first
        while at < s.last:
            i, skip = divmod(at - s.base, BATCH_ROWS)
            batch = reader.get_batch(i).slice(skip, s.last - at)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([s.topic] * n), pa.array([s.partition] * n, pa.int32()),
                                              pa.array(range(at, at + n), pa.int64()), batch.column(0), batch.column(1)], schema=READ)
            at += n


class _Log:
    """Positions of topics: {"topic/partition": offset}."""

    def __init__(self, options):
        self.path = options["path"]
        self.topics = [t.strip() for t in options["subscribe"].split(",")]
        self.start = options.get("startingOffsets", "latest")
        self.split = int(options.get("splitRows", SPLIT_ROWS))
        self.group = options.get("group")

    def position(self, which: str) -> dict:
        """The ``earliest`` or ``latest`` offsets, or those of a JSON text."""
        out = {}
        given = {} if which in ("earliest", "latest") else json.loads(which)
        for topic in self.topics:
            for p, (low, high) in ends(self.path, topic).items():
                at = {"earliest": low, "latest": high}.get(which, given.get(topic, {}).get(str(p), low))
                out[f"{topic}/{p}"] = min(max(int(at), low), high)
        return out

    def first(self) -> dict:
        """Where a new stream begins: the group's kept position, else ``startingOffsets``."""
        if not self.group:
            return self.position(self.start)
        fs, base = _open(self.path)
        kept = f"{base}/.groups/{self.group}.json"
        if fs.get_file_info(kept).type == pafs.FileType.NotFound:
            fs.create_dir(f"{base}/.groups", recursive=True)
            temporary = f"{kept}.{uuid.uuid4().hex}"
            with fs.open_output_stream(temporary) as f:
                f.write(json.dumps(self.position(self.start)).encode())
            fs.move(temporary, kept)
        with fs.open_input_stream(kept) as f:
            return json.loads(f.read())

    def spans(self, start: dict, end: dict) -> list[Span]:
        out = []
        for topic in self.topics:
            for p, found in segments(self.path, topic).items():
                low, high = int(start.get(f"{topic}/{p}", 0)), int(end.get(f"{topic}/{p}", 0))
                for base, n, file in found:
                    a, b = max(low, base), min(high, base + n)
                    out += [Span(topic, p, file, base, i, min(i + self.split, b)) for i in range(a, b, self.split)]
        return out


class BatchReader(DataSourceReader):
    def __init__(self, options):
        self.log = _Log(options)

    def partitions(self):
        return self.log.spans(self.log.position("earliest" if self.log.start == "latest" else self.log.start), self.log.position("latest"))

    def read(self, partition):
        if isinstance(partition, Span):           # an empty log has one partition that is none
            yield from read_span(self.log.path, partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.log = _Log(options)

    def initialOffset(self) -> dict:
        return self.log.first()

    def latestOffset(self) -> dict:
        return self.log.position("latest")

    def partitions(self, start: dict, end: dict):
        return self.log.spans(start, end)

    def read(self, partition):
        yield from read_span(self.log.path, partition)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "topic string, partition int, offset long, key string, value string"

    def reader(self, schema):
        return BatchReader(self.options)

    def streamReader(self, schema):
        return StreamReader(self.options)


def read(spark: SparkSession, path: str, topics: str) -> DataFrame:
    """All messages of topics (a comma between them)."""
    spark.dataSource.register(MessageLog)
    return spark.read.format(NAME).option("subscribe", topics).option("startingOffsets", "earliest").load(path)


def stream(spark: SparkSession, path: str, topics: str, starting: str = "earliest", group: str | None = None) -> DataFrame:
    spark.dataSource.register(MessageLog)
    r = spark.readStream.format(NAME).option("subscribe", topics).option("startingOffsets", starting)
    return (r.option("group", group) if group else r).load(path)
