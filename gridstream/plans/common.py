"""Helpers shared by registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstream.functions.rules import round_half_away

PLACES = 6


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Round every DOUBLE column (presentation step for value comparison)."""
    cols = [round_half_away(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)
