"""Ordered per-key windows that stay parallel when one key is huge.

``Window.partitionBy(key)`` sends every row of a key to one task.  A station
can hold a third of all readings, so for row-count frames (ROWS n PRECEDING,
lag) the series of a large key is cut into blocks of consecutive time slices,
and each block gets copies of the preceding slices that its frames reach
("halo").  Frames then see exactly the rows they would see unsplit.

There is one plan for all keys and sizes:

1. count rows per (key, time slice): partial aggregation, one scan without values;
2. a running sum per key turns the counts into block numbers; only slices of
   keys with more than ``block_rows`` rows are kept, so the table is small;
3. readings meet that table on (key, slice): rows of other keys find nothing
   and are block 0, rows of large keys get their block, and once more each
   block whose frames reach back to them;
4. the window is partitioned by (key, block) and the copies are dropped.

Blocks are cut by counts, so an uneven spread in time makes more blocks, not
larger ones.  What one station reads within one slice stays together.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridstream import config as C
from gridstream.functions.rules import bin_start

Compute = Callable[[DataFrame, WindowSpec], DataFrame]


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def block_map(df: DataFrame, key: str, halo_before: int, block_rows: int) -> DataFrame:
    """(key, _slice, _blk, _halo) of the slices of keys with more than
    ``block_rows`` rows: each slice's own block, and later blocks that reach it."""
    counts = df.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy(key)
    before = by.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    large = (counts.withColumn("_all", F.sum("_n").over(by))
             .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .filter(F.col("_all") > F.lit(int(block_rows))))
    b = F.lit(int(block_rows))
    own = F.floor(F.col("_off") / b)
    last = F.floor((F.col("_off") + F.col("_n") + F.lit(int(halo_before) - 1)) / b)
    return (large.withColumn("_own", own).withColumn("_blk", F.explode(F.sequence(own, F.greatest(own, last))))
            .select(key, "_slice", "_blk", (F.col("_blk") != F.col("_own")).alias("_halo")))


def ordered_window(df: DataFrame, key: str, order: Sequence, compute: Compute, *,
                   ts: str | None = None, halo_before: int = 0, block_rows: int = C.ROLLING_BLOCK_ROWS,
                   mode: str = "blocked", slice_minutes: int = 60) -> DataFrame:
    """Evaluate ``compute(df, window)`` with ``window`` ordered per key.

    ``compute`` must only use row frames reaching at most ``halo_before`` rows
    back.  ``mode``: ``"blocked"`` (keys above ``block_rows`` rows are split) or
    ``"simple"`` (one partition per key; the reference point of the tests).
    ``order`` starts with ``ts``, so that slices are ordered too.
    """
    if mode == "simple":
        return compute(df, Window.partitionBy(key).orderBy(*_order_cols(order)))
    ts = ts or (order[0] if isinstance(order[0], str) else None)
    if ts is None:
        raise ValueError("a timestamp column is needed to slice on")
    d = df.withColumn("_slice", bin_start(ts, slice_minutes))
    placed = (d.join(block_map(d, key, halo_before, block_rows), [key, "_slice"], "left")
              .withColumn("_blk", F.coalesce("_blk", F.lit(0))))
    w = Window.partitionBy(key, "_blk").orderBy(*_order_cols(order))
    return compute(placed, w).filter(~F.coalesce("_halo", F.lit(False))).drop("_slice", "_blk", "_halo")


def sliced_rank(df: DataFrame, part: Sequence[str], order: str, name: str, slice_chars: int = 3) -> DataFrame:
    """``name``: 1-based position of each row's ``order`` (a text, distinct
    within ``part``) without one task per part: rows are counted by the first
    characters, counts summed over the few slices, rows numbered per slice."""
    d = df.withColumn("_slice", F.substring(order, 1, slice_chars))
    counts = d.groupBy(*part, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(*part, "_slice").orderBy(order)
    return (d.withColumn("_pos", F.row_number().over(within)).join(offsets, [*part, "_slice"])
            .withColumn(name, F.col("_off") + F.col("_pos")).drop("_slice", "_pos", "_off"))
