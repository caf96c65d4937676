"""Streams and topics. The broker connector is not part of Spark and must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.schema import EVENTS_TOPIC
from spintally.sources.wire import decode_play_events, encode


def kafka_source_options(
    servers: str, topic: str, max_offsets: int | None = None, starting: str = "earliest"
) -> dict[str, str]:
    """``starting`` is a place or, as JSON, the offsets that a stopped query has handed over."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    stream: bool = True,
    starting: str = "earliest",
) -> DataFrame:
    """Messages of a topic, from its beginning unless told otherwise, with key and value as text.

    The broker's partition and offset give the arrival order that a replay needs; for
    one, read the topic as a table (``stream=False``).
    """
    options = kafka_source_options(servers, topic, max_offsets if stream else None, starting)
    reader = spark.readStream if stream else spark.read
    return (
        reader.format("kafka")
        .options(**options)
        .load()
        .select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            F.col("partition").alias("part"),
            F.col("offset").alias("seq"),
            F.unix_millis("timestamp").alias("arrival_ms"),
        )
    )


def read_event_topic(
    spark: SparkSession,
    servers: str,
    max_offsets: int | None = None,
    stream: bool = True,
    starting: str = "earliest",
) -> DataFrame:
    """Decoded play events with the reason for rejection, if any."""
    return decode_play_events(
        read_topic(spark, servers, EVENTS_TOPIC, max_offsets, stream, starting)
    )


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_topic(records: DataFrame, fields, servers: str, topic: str, checkpoint: str):
    """Writer that publishes records keyed by song; call ``start`` on it.

    The broker's partitioner spreads the keys, so one song stays in one partition.
    """
    return (
        encode(records, fields)
        .writeStream.format("kafka")
        .options(**kafka_sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
    )


def read_event_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of JSON lines, decoded and checked."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode_play_events(reader.text(path))
