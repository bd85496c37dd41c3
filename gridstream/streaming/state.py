"""What the streaming queries keep: their state stores as tables.

Spark's ``statestore`` reader opens the state of an ended (or running) query
from its checkpoint; ``state-metadata`` tells which operator holds a variable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operator_of(spark: SparkSession, checkpoint: str, variable: str) -> int:
    """The number of the stateful operator that has a state variable."""
    found = (spark.read.format("state-metadata").load(checkpoint)
             .where(F.contains(F.coalesce("operatorProperties", F.lit("")), F.lit(f'"{variable}"'))).select("operatorId").distinct().collect())
    if len(found) != 1:
        raise ValueError(f"{len(found)} operators have the state variable {variable!r}")
    return int(found[0][0])


def state_of(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """A row for each key: the grouping key's columns and the variable's. A
    list or map gives one row for each of its entries."""
    rows = (spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator_of(spark, checkpoint, variable))
            .option("stateVarName", variable).load())
    names = [c for c in rows.columns if c in ("value", "list_element", "user_map_key", "user_map_value")]
    return rows.select("key.*", *[F.col(f"{c}.*") for c in names])
