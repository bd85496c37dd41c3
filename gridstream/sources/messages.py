"""Keyed JSON messages: encode, decode with validation, route by topic
(S07, S09, S14-S17, S19).

A "message frame" is ``(topic string, key string, value string)`` - the
shape of a Kafka source - so the same functions serve batch replays and
``readStream.format("kafka")`` alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstream import config as C
from gridstream.functions.rules import parse_ts

CORRUPT = "_corrupt"


# (key, value) JSON encoding; key defaults when the field is NULL.
def encode(df: DataFrame, topic: str, key_col: str | None = "station_id",
           cols: list[str] | None = None, default_key: str = "unknown") -> DataFrame:
    cols = cols or list(df.columns)
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(default_key)) if key_col else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), key.alias("key"),
                     F.to_json(F.struct(*cols)).alias("value"))


# Tombstones (NULL values) carry no record.
def drop_tombstones(msgs: DataFrame) -> DataFrame:
    return msgs.filter(F.col("value").isNotNull())


# Decode with a declared schema (PERMISSIVE); undecodable records
# and records missing a required field go to the reject side.
def decode(msgs: DataFrame, schema: T.StructType, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    s = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = drop_tombstones(msgs).withColumn(
        "_rec", F.from_json("value", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col(f"_rec.{CORRUPT}").isNotNull() | F.col("_rec").isNull()
    for r in required:
        bad = bad | F.col(f"_rec.{r}").isNull()
    ok = parsed.filter(~bad).select("value", "_rec.*").drop(CORRUPT)
    rejects = parsed.filter(bad).select("topic", "key", "value")
    return ok, rejects


# One frame carrying several topics -> one decoded frame per topic.
def route(msgs: DataFrame, schemas: dict[str, T.StructType],
          required: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    required = required or {}
    return {t: decode(msgs.filter(F.col("topic") == t), s, required.get(t, []))[0]
            for t, s in schemas.items()}


# A keyed changelog.  The message key holds the record's keys, ``SEP``
# between them; a null value is a tombstone that deletes the record.
SEP = "|"


def encode_changes(df: DataFrame, topic: str, keys=("station_id", "time_bin"), deleted: str = "deleted") -> DataFrame:
    """Messages of changes: the row as JSON, or null where ``deleted``."""
    cols = [c for c in df.columns if c != deleted]
    return df.select(F.lit(topic).alias("topic"), F.concat_ws(SEP, *keys).alias("key"),
                     F.when(~F.col(deleted), F.to_json(F.struct(*cols))).alias("value"))


def decode_changes(msgs: DataFrame, schema: T.StructType, keys=("station_id", "time_bin"), keep=("offset",)) -> DataFrame:
    """Rows of ``schema`` with ``deleted``; the keys are the message key's.  An
    undecodable value is neither a record nor a tombstone: it is left out here
    and told by ``routed_rows``."""
    s = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parts = F.split("key", "\\" + SEP)
    rec = (msgs.withColumn("_rec", F.from_json("value", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
           .where(F.col("value").isNull() | F.col(f"_rec.{CORRUPT}").isNull()))
    return rec.select(*[F.get(parts, i).alias(k) for i, k in enumerate(keys)],
                      *[F.col(f"_rec.{f.name}").alias(f.name) for f in schema.fields if f.name not in keys],
                      F.col("value").isNull().alias("deleted"), *keep)


# S15 + S17 in one pass: every message is parsed once, by its topic's schema, and
# leaves with its topic or, where it can't be used, with a reason for the dead
# letters.  Tombstones carry no record and are dropped.
DEAD = "dead-letter"


def routed_rows(msgs: DataFrame, schemas: dict[str, T.StructType], required: dict[str, list[str]] | None = None) -> DataFrame:
    """(topic, key, value, one struct column for each topic, reason, target)."""
    required = required or {}
    d = drop_tombstones(msgs).select("topic", "key", "value")
    reason = F.when(~F.coalesce(F.col("topic").isin(list(schemas)), F.lit(False)), F.lit("unknown topic"))
    for i, (topic, schema) in enumerate(schemas.items()):
        s = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        parsed = F.from_json("value", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        own = F.col("topic") == topic
        d = d.withColumn(f"r{i}", F.when(own, parsed))
        reason = reason.when(own & (F.col(f"r{i}").isNull() | F.col(f"r{i}.{CORRUPT}").isNotNull()), F.lit("undecodable"))
        for field in required.get(topic, []):
            reason = reason.when(own & F.col(f"r{i}.{field}").isNull(), F.lit(f"missing {field}"))
    d = d.withColumn("reason", reason)
    return d.withColumn("target", F.when(F.col("reason").isNull(), F.col("topic")).otherwise(F.lit(DEAD)))


def write_routed(rows: DataFrame, path: str, batch_id: int = 0) -> None:
    """All topics and the dead letters in one write; a batch that comes again replaces its own rows."""
    (rows.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "target").parquet(path))


def read_topic(stored: DataFrame, schemas: dict[str, T.StructType], topic: str) -> DataFrame:
    """The decoded records of a topic (with ``value``): only its files and columns are read."""
    i = list(schemas).index(topic)
    return (stored.where(F.col("target") == topic)
            .select("value", *[F.col(f"r{i}.{f.name}").alias(f.name) for f in schemas[topic].fields]))


def dead_letters(stored: DataFrame) -> DataFrame:
    return stored.where(F.col("target") == DEAD).select("topic", "key", "value", "reason")


# Inference rows: required station_id/time_bin, time_bin as TIMESTAMP.
def inference_rows(prices: DataFrame) -> DataFrame:
    d = prices.filter(F.col("station_id").isNotNull() & F.col("time_bin").isNotNull())
    return d.select("station_id", parse_ts("time_bin").alias("time_bin"), "predicted_kwh",
                    "price_multiplier", "dynamic_price_cad", "guaranteed_price_cad",
                    "day_ahead_price_cad", "session_status", "alert_level")


# Data-quality events.  The default reason applies only when the field
# is absent from the payload (an explicit null stays null); the raw payload
# is kept; time_bin falls back to the emitted time_new (documented fix).
# With ``variant`` the payload is stored as a VARIANT, whose fields are read
# without parsing text again; a payload that is no JSON is null there.
def data_quality_events(dq: DataFrame, default_reason: str = C.DEFAULT_DQ_REASON, variant: bool = False) -> DataFrame:
    has_reason = F.array_contains(F.json_object_keys("value"), F.lit("reason"))
    tb = F.coalesce(parse_ts("time_bin"), parse_ts("time_new")) if "time_new" in dq.columns \
        else parse_ts("time_bin")
    return dq.select("station_id", tb.alias("time_bin"), "original_kwh", "corrected_kwh",
                     F.when(has_reason, F.col("reason")).otherwise(F.lit(default_reason)).alias("reason"),
                     (F.try_parse_json("value") if variant else F.col("value")).alias("raw_payload"))
