"""The streaming aggregations and how they are started.

Both use the operators of the batch side; the watermark is the grace period. Each
is a query of its own with its own watermark, state and checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spintally.operators.aggregates import completion_stats, hourly_counts, play_starts
from spintally.operators.latest import HISTORY_KEY, latest_per_key
from spintally.schema import (
    COMPLETION_FIELDS,
    COMPLETION_GRACE_MS,
    COMPLETION_WINDOW_MS,
    HOURLY_FIELDS,
    RANKING_GRACE_MS,
    RANKING_WINDOW_MS,
    columns,
    table_schema,
)
from spintally.sources.wire import quarantine, valid_records
from spintally.streaming import handover
from spintally.streaming.metrics import observed
from spintally.streaming.sinks import history_sink
from spintally.streaming.state import COMPLETION_COUNTERS, HOURLY_COUNTERS

COMPLETION_QUERY = "completion-stats"
HOURLY_QUERY = "hourly-play-counts"
CONSUMER_QUERY = "result-consumer"
FLUSH_INTERVAL = "1 second"


def completion_updates(events: DataFrame) -> DataFrame:
    """Changed completion records; late events count until the window's grace is over."""
    return completion_stats(events.withWatermark("ts", f"{COMPLETION_GRACE_MS} milliseconds"))


def hourly_updates(events: DataFrame) -> DataFrame:
    """Changed hourly records; only start events advance the watermark."""
    starts = play_starts(events).withWatermark("ts", f"{RANKING_GRACE_MS} milliseconds")
    return hourly_counts(starts)


def triggered(writer, available_now: bool, every: str):
    """``writer`` with its trigger: what is there now and stop, or a batch per interval."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def start(
    updates: DataFrame,
    sink,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    every: str = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Run in update mode: every batch emits the records it changed, nothing is held back."""
    writer = (
        updates.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
    )
    return triggered(writer, available_now, every).start()


def start_completion(
    events: DataFrame,
    root: str,
    available_now: bool = False,
    writers: int | None = None,
    every: str = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Completion records into ``root/history`` and ``root/latest``; arrivals are observed."""
    last = handover.latest(events.sparkSession, root)
    sink = history_sink(COMPLETION_FIELDS, root, writers)
    sink = handover.continued(sink, last, COMPLETION_FIELDS, COMPLETION_COUNTERS)
    taken = handover.still_open(observed(events), COMPLETION_WINDOW_MS, last)
    checkpoint = handover.checkpoint(root, last)
    return start(
        completion_updates(taken), sink, checkpoint, COMPLETION_QUERY, available_now, every
    )


def start_hourly(
    events: DataFrame,
    root: str,
    available_now: bool = False,
    writers: int | None = None,
    every: str = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Hourly records into ``root/history`` and ``root/latest``; arrivals are observed."""
    last = handover.latest(events.sparkSession, root)
    sink = history_sink(HOURLY_FIELDS, root, writers)
    sink = handover.continued(sink, last, HOURLY_FIELDS, HOURLY_COUNTERS)
    taken = handover.still_open(observed(events), RANKING_WINDOW_MS, last)
    checkpoint = handover.checkpoint(root, last)
    return start(hourly_updates(taken), sink, checkpoint, HOURLY_QUERY, available_now, every)


def start_consumer(
    decoded: DataFrame,
    fields,
    root: str,
    available_now: bool = False,
    writers: int | None = None,
    every: str = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Decoded result messages of a topic into ``root/history`` and the views.

    For a processor and a read side that run apart, with a topic in between. A batch may
    hold many messages of one window; the one with the highest ``seq`` counts. Rejected
    messages are left out here and belong to ``start_quarantine``.
    """
    store = history_sink(fields, root, writers, arrival=True)

    def last_of_each(records: DataFrame, batch_id: int) -> None:
        store(latest_per_key(records, HISTORY_KEY, "seq"), batch_id)

    records = valid_records(decoded).select(*columns(fields), "seq")
    return start(records, last_of_each, f"{root}/checkpoint", CONSUMER_QUERY, available_now, every)


def start_quarantine(
    decoded: DataFrame,
    root: str,
    available_now: bool = False,
    every: str = FLUSH_INTERVAL,
    checkpoint: str = "checkpoint",
) -> StreamingQuery:
    """Rejected messages, as received and with the reason, into ``root/rejected``."""
    writer = (
        quarantine(decoded)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{root}/rejected")
        .option("checkpointLocation", f"{root}/{checkpoint}")
    )
    return triggered(writer, available_now, every).start()


def read_results(spark: SparkSession, root: str, fields, retry_span: str = "1 hour") -> DataFrame:
    """Stream of the stored result records from the earliest batch on.

    A batch that was retried has been written twice, and a stream over files may have
    seen both; the second one is left out if it came within ``retry_span``.
    """
    schema = table_schema(fields).add("updated_at", "timestamp").add("batch_id", "long")
    stored = spark.readStream.schema(schema.add("window_date", "date")).parquet(f"{root}/history")
    return (
        stored.withWatermark("updated_at", retry_span)
        .dropDuplicatesWithinWatermark([*HISTORY_KEY, "batch_id"])
        .select(*columns(fields))
    )
