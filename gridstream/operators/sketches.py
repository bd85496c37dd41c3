"""Quantiles from mergeable sketches (P04, D08b at scale).

An exact rank orders values; a KLL sketch of ``k`` is a few kilobytes whatever
it has seen, merges with others, and gives a quantile whose rank is off by
about 1.33 % of all values for k = 200 (0.13 % for k = 2400), with 99 %
confidence.  A day's sketch is made once and stored; any span of days is read by
merging theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 800


def daily_sketches(df: DataFrame, value: str, ts: str, k: int = K) -> DataFrame:
    """(day, n, sketch): one row for each day that has values."""
    return (df.where(F.col(value).isNotNull()).groupBy(F.to_date(ts).alias("day"))
            .agg(F.count(value).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")))


def merged_quantile(sketches: DataFrame, q: float, k: int = K) -> DataFrame:
    """(n, quantile) of all values behind the sketches; nulls where there are none."""
    both = sketches.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("_s"))
    return both.select("n", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_s", F.lit(float(q)))).alias("quantile"))


def rank_of(df: DataFrame, value: str, x: Column) -> DataFrame:
    """(n, below, upto): shares of the values below ``x`` and not above it."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).agg(F.count(F.lit(1)).alias("n"), (F.count_if(v < x) / F.count(F.lit(1))).alias("below"),
                                       (F.count_if(v <= x) / F.count(F.lit(1))).alias("upto"))
