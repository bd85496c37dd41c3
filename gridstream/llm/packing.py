"""Packing (operator 12): documents into sequences of at most SIZE tokens, by
bounded-space online packing.

Each task reads its share of the documents in order, encodes them and keeps a
fixed number of open windows.  A document of SIZE tokens or more gives whole
windows first; what is left of it goes into the open window that it fills
best.  Where it fits none, a new window opens as long as fewer than OPEN are;
then the fullest one leaves: as it is where at most SLACK tokens are free,
else filled with the head of the document, whose tail is placed anew.  So
no document is shuffled, a task holds OPEN windows whatever its input, and a
window that leaves is short of at most SLACK tokens.

The windows that are open at the end are leftovers: only they travel (with
their ids, as they may be cut again), to as many tasks as they fill with
MERGE_TOKENS each.  Such a task packs their pieces the same way, joins the
windows it has left over end to end into whole ones, and hands on the last
one.  Rounds follow until one task is left; it cuts its last window into
lengths that are powers of two, which need no padding.

Results depend only on how Spark deals the documents to the tasks, so a
task that runs again gives the same pieces.  Sequence ids are built from the
round, the task and a number in the task.

Edge cases: a null or empty text is the end id alone; a null doc_id stays
null; rows of one doc_id are documents of their own; a text of any length
is encoded at once and cut as often as needed; other columns are not read; an
empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstream.llm.common import in_batches, slices, table, written
from gridstream.llm.token_files import END_ID, _encoder

SIZE = 2048                        # tokens of a sequence
OPEN = 64                          # windows that a task keeps open
SLACK = 16                         # free tokens that may stay free
MERGE_TOKENS = 1 << 22             # leftover tokens for a task
TASK_BITS, OWN_BITS = 24, 32       # of a sequence id: round, task, number in the task
BATCH = 1 << 14                    # pieces of an Arrow batch

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


class Piece(NamedTuple):
    """Ids (little-endian uint32) of a document from ``start`` on."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


class Windows:
    """At most ``most`` open windows; ``done`` gets the windows that leave."""

    def __init__(self, size: int, most: int, slack: int):
        self.size, self.most, self.slack = size, most, slack
        self.room: list[tuple[int, int]] = []          # (free tokens, window), in order
        self.open: dict[int, list[Piece]] = {}
        self.next = 0
        self.done: list[list[Piece]] = []

    def place(self, piece: Piece) -> None:
        while piece.ids.size >= self.size:
            whole, piece = piece.cut(self.size)
            self.done.append([whole])
        while piece.ids.size:
            n = piece.ids.size
            at = bisect_left(self.room, (n, -1))
            if at < len(self.room):                    # the least room that is enough
                self._put(at, piece)
                return
            if len(self.open) >= self.most:            # none fits: the fullest leaves
                free, window = self.room[0]
                if free > self.slack:
                    head, piece = piece.cut(free)
                    self._put(0, head)
                    continue
                self.room.pop(0)
                self.done.append(self.open.pop(window))
            self.open[self.next] = []
            insort(self.room, (self.size, self.next))
            self._put(bisect_left(self.room, (self.size, self.next)), piece)
            self.next += 1
            return

    def _put(self, at: int, piece: Piece) -> None:
        free, window = self.room.pop(at)
        self.open[window].append(piece)
        if free == piece.ids.size:
            self.done.append(self.open.pop(window))
        else:
            insort(self.room, (free - piece.ids.size, window))

    def taken(self) -> list[list[Piece]]:
        done, self.done = self.done, []
        return done

    def leftovers(self) -> list[list[Piece]]:
        """The open windows, the fullest first; none is open afterwards."""
        left = [self.open[w] for _, w in self.room]
        self.room, self.open = [], {}
        return left

    def joined(self) -> list[Piece]:
        """The open windows end to end: whole ones are done, the rest is returned."""
        row: list[Piece] = []
        free = self.size
        for piece in (p for window in self.leftovers() for p in window):
            while piece.ids.size >= free:
                head, piece = piece.cut(free)
                self.done.append(row + [head])
                row, free = [], self.size
            if piece.ids.size:
                row.append(piece)
                free -= piece.ids.size
        return row


def by_powers(row: list[Piece]) -> list[list[Piece]]:
    """The pieces of a window cut into sequences whose lengths are powers of two."""
    out: list[list[Piece]] = []
    rest, at = sum(p.ids.size for p in row), 0
    queue = list(row)
    while rest:
        length = 1 << (rest.bit_length() - 1)
        own, free = [], length
        while free:
            piece = queue[at]
            if piece.ids.size > free:
                head, queue[at] = piece.cut(free)
                own.append(head)
                break
            own.append(piece)
            free -= piece.ids.size
            at += 1
        out.append(own)
        rest -= length
    return out


class _Rows:
    """Rows of windows, numbered within a round and a task."""

    def __init__(self, turn: int, task: int):
        self.base, self.n, self.held = (turn << (TASK_BITS + OWN_BITS)) + (task << OWN_BITS), 0, []

    def add(self, windows: list[list[Piece]], keep: bool = False) -> None:
        for window in windows:
            offset = 0
            for p in window:
                raw = p.ids.tobytes()
                self.held.append((p.doc_id, p.start, p.ids.size, zlib.crc32(raw), p.doc_tokens, self.base + self.n, offset,
                                  raw if keep else None))
                offset += p.ids.size
            self.n += 1

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.held and len(self.held) >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.held), _PIECES)], schema=_PIECES)
            self.held = []


def _pack(tokenizer: str, end_id: int, size: int, most: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, rows = Windows(size, most, slack), _Rows(0, TaskContext.get().partitionId())
        for part in slices(batches):
            ids, to = _encoder(tokenizer).encode(part["text"].combine_chunks(), end_id)
            ids = ids.astype("<u4", copy=False)
            for doc, a, b in zip(part["doc_id"].to_pylist(), to[:-1].tolist(), to[1:].tolist()):
                windows.place(Piece(doc, 0, ids[a:b].copy(), b - a))
            rows.add(windows.taken())
            yield from rows.batches(BATCH)
        rows.add(windows.leftovers(), keep=True)
        yield from rows.batches(1)
    return run


def _merge(turn: int, last: bool, size: int, most: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, rows = Windows(size, most, slack), _Rows(turn, TaskContext.get().partitionId())
        for batch in batches:
            for doc, start, total, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))):
                windows.place(Piece(doc, start, np.frombuffer(raw, "<u4"), total))
            rows.add(windows.taken())
            yield from rows.batches(BATCH)
        row = windows.joined()
        rows.add(windows.taken())
        if last:
            rows.add(by_powers(row))
        elif row:
            rows.add([row], keep=True)
        yield from rows.batches(1)
    return run


def packed(docs: DataFrame, tokenizer: str, end_id: int = END_ID, size: int = SIZE, most: int = OPEN, slack: int = SLACK,
           merge_tokens: int = MERGE_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece of a document: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(in_batches(own, _pack(tokenizer, end_id, size, most, slack), f"{PIECE}, ids binary"), "pieces")
    done = pieces.where("ids IS NULL").drop("ids")
    turn = 0
    while True:
        left = pieces.where("ids IS NOT NULL")
        turn += 1
        # a task hands on less than a window, so the tokens shrink from round to round
        tasks = max(1, -(-(left.agg(F.sum("length")).first()[0] or 0) // max(merge_tokens, 4 * size)))
        dealt = left.repartition(tasks, "sequence_id").sortWithinPartitions("sequence_id", "offset")
        last = tasks == 1
        pieces = written(dealt.select("doc_id", "start", "doc_tokens", "ids")
                         .mapInArrow(_merge(turn, last, size, most, slack), f"{PIECE}, ids binary"), "pieces")
        done = done.unionByName(pieces.where("ids IS NULL").drop("ids"))
        if last:
            return done


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
