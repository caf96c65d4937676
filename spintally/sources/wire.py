"""JSON wire records: encoding, decoding with a fixed schema, and the validity split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.functions.times import event_time
from spintally.schema import EVENT_TYPES, PLAY_EVENT_FIELDS, wire_schema

BROKEN_JSON = "broken_json"
MISSING_FIELD = "missing_field"
UNKNOWN_TYPE = "unknown_type"


def to_wire(fields) -> Column:
    """The record as a JSON text with its wire field names, in wire order."""
    return F.to_json(F.struct(*[F.col(column).alias(name) for name, column, _ in fields]))


def from_wire(value: str, fields) -> Column:
    return F.from_json(F.col(value), wire_schema(fields))


def encode(records: DataFrame, fields, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keyed messages: the song is the key, so that one song stays in one partition."""
    return records.select(*keep, F.col("song_id").alias("key"), to_wire(fields).alias("value"))


def decode(
    messages: DataFrame, fields, value: str = "value", zero_for_absent: bool = False
) -> DataFrame:
    """Parse every message into the record's columns and say why it is unusable, if it is.

    ``from_json`` lets absent fields pass, so they are checked here. All other columns of
    ``messages`` are kept. With ``zero_for_absent`` a number that is absent or null counts
    as zero, as in lenient JSON bindings.

    The record is expanded as a generator's output: a filter on it stays above the parse,
    so a message is parsed once whatever is asked of the result.
    """
    corrupt = "_corrupt"
    schema = T.StructType([*wire_schema(fields).fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(F.col(value), schema, {"columnNameOfCorruptRecord": corrupt})
    blank = F.coalesce(F.trim(value), F.lit("")) == ""
    broken = blank | F.col(corrupt).isNotNull()
    absent = F.lit(False)
    made = []
    for name, column, dtype in fields:
        field = F.col(name)
        if zero_for_absent and isinstance(dtype, T.LongType):
            field = F.coalesce(field, F.lit(0).cast(dtype))
        absent = absent | field.isNull()
        made.append(field.alias(column))
    kept = [c for c in messages.columns if c != value]
    reason = F.when(broken, BROKEN_JSON).when(absent, MISSING_FIELD)
    return messages.select(*kept, value, F.inline(F.array(parsed))).select(
        *kept, value, *made, reason.alias("reject_reason")
    )


def decode_play_events(
    messages: DataFrame, value: str = "value", zero_for_absent: bool = False
) -> DataFrame:
    """Parse play events; an event type that does not exist is a reason for rejection too."""
    decoded = decode(messages, PLAY_EVENT_FIELDS, value, zero_for_absent)
    unknown = F.when(~F.col("event_type").isin(*EVENT_TYPES), UNKNOWN_TYPE)
    return decoded.withColumn("reject_reason", F.coalesce("reject_reason", unknown))


def valid_records(decoded: DataFrame) -> DataFrame:
    """Usable records."""
    return decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason", "value")


def valid_events(decoded: DataFrame) -> DataFrame:
    """Usable events with their event time."""
    return valid_records(decoded).withColumn("ts", event_time())


def quarantine(decoded: DataFrame, value: str = "value") -> DataFrame:
    """Everything else, as received, with the reason."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(value, "reject_reason")
