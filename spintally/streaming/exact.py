"""Streaming aggregation under the exact late rule, without a watermark.

The watermark queries follow one global clock that moves between micro-batches.
Here every stream partition has its own clock that moves with each event, so the
result is that of the replay, however the events are cut into batches. The input
needs ``part`` and ``seq``, as a topic provides them.

A batch is an ordinary job over the batch's events and two small tables left by the
batch before: the clocks, one row per partition, and the open windows, one row per
song and window that can still change. A batch reads only its predecessor's folders
and overwrites its own, so a repeated batch gives the same result; older folders are
dropped. Every batch writes all open windows, so its cost has a part that grows with the
songs that are live, not with the batch; the default trigger is a minute, and where that
part weighs more than the events, a longer one or the watermark queries are the choice.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spintally.operators.aggregates import play_starts
from spintally.operators.latest import completion_records, hourly_records
from spintally.operators.replay import (
    accepted,
    closing_arrivals,
    completion_counters,
    first_arrivals,
    ranking_counters,
    with_lateness,
)
from spintally.schema import (
    COMPLETION_FIELDS,
    COMPLETION_GRACE_MS,
    COMPLETION_WINDOW_MS,
    HOURLY_FIELDS,
    RANKING_GRACE_MS,
    RANKING_WINDOW_MS,
)
from spintally.streaming.sinks import batch_path, drop_batch, history_sink
from spintally.streaming.watermarked import COMPLETION_QUERY, HOURLY_QUERY, start

# A batch function gets the whole rows of its stream, so these are picked before.
EVENT_COLUMNS = ("part", "seq", "song_id", "event_type", "ts_ms", "position_ms", "duration_ms")
WINDOW_KEY = ("part", "song_id", "window_start")
EXACT_INTERVAL = "1 minute"


@dataclass(frozen=True)
class Aggregation:
    fields: tuple
    size_ms: int
    grace_ms: int
    pick: Callable[[DataFrame], DataFrame]
    counters: Callable[[], dict[str, Column]]
    records: Callable[..., DataFrame]


COMPLETION = Aggregation(
    COMPLETION_FIELDS,
    COMPLETION_WINDOW_MS,
    COMPLETION_GRACE_MS,
    lambda events: events,
    completion_counters,
    completion_records,
)
RANKING = Aggregation(
    HOURLY_FIELDS,
    RANKING_WINDOW_MS,
    RANKING_GRACE_MS,
    play_starts,
    ranking_counters,
    hourly_records,
)


CLOCKS = "part int, stream_ms bigint"
CLOSING = "part int, window_start bigint, closer bigint"


def exact_sink(rule: Aggregation, root: str, writers: int | None = None):
    """``foreachBatch`` function that keeps clocks, open windows, history and the views."""
    publish = history_sink(rule.fields, root, writers, arrival=True)
    counted = list(rule.counters())
    windows = ", ".join(
        ["part int, song_id string, window_start bigint"]
        + [f"{name} bigint" for name in counted]
        + ["changed boolean", "seq bigint"]
    )
    # Tables a batch leaves behind, each with one folder per batch.
    tables = {"closing": CLOSING, "clocks": CLOCKS, "windows": windows}

    def read(spark: SparkSession, table: str, batch_id: int) -> DataFrame:
        """What a batch left behind; nothing before the first one."""
        if batch_id < 0:
            return spark.createDataFrame([], tables[table])
        return spark.read.schema(tables[table]).parquet(batch_path(f"{root}/{table}", batch_id))

    def keep(rows: DataFrame, table: str, batch_id: int) -> DataFrame:
        rows.write.mode("overwrite").parquet(batch_path(f"{root}/{table}", batch_id))
        return read(rows.sparkSession, table, batch_id)

    def store(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        picked = rule.pick(events)
        clock = read(spark, "clocks", batch_id - 1)
        # a few rows per partition and minute, read by two plans; an executor that is lost
        # with some of them costs their part of the batch again
        first = first_arrivals(picked).drop("start").persist()
        times = first.select("part", F.col("newest_ms").alias("stream_ms")).unionByName(clock)
        times = times.groupBy("part").agg(F.max("stream_ms").alias("stream_ms"))
        try:
            with ThreadPoolExecutor(1) as beside:
                moved = beside.submit(keep, times, "clocks", batch_id)
                updates = merged(picked, first, clock, batch_id)
                moved.result()
        finally:
            first.unpersist()
        publish(rule.records(updates, "seq"), batch_id)
        for table in tables:
            drop_batch(spark, f"{root}/{table}", batch_id - 2)

    def merged(
        picked: DataFrame, first: DataFrame, clock: DataFrame, batch_id: int
    ) -> DataFrame:
        """Write the open windows of a batch; those it has changed."""
        spark = picked.sparkSession

        # The clocks act as events that came before all others of the batch.
        before = F.lit(-1).cast("bigint")
        carried = clock.select(
            "part", F.col("stream_ms").alias("ts_ms"), before.alias("seq"), before.alias("last_seq")
        )
        arrived = first.select("part", "ts_ms", "seq", "last_seq").unionByName(carried)
        closing = closing_arrivals(arrived, rule.size_ms, rule.grace_ms, "last_seq")
        closing = keep(closing, "closing", batch_id)
        fresh = (
            accepted(with_lateness(picked, closing, rule.size_ms))
            .groupBy(*WINDOW_KEY)
            .agg(
                *[F.count_if(hit).alias(name) for name, hit in rule.counters().items()],
                F.max("seq").alias("seq"),
            )
            .withColumn("changed", F.lit(True))
        )

        still_open = (
            read(spark, "windows", batch_id - 1)
            .join(clock, "part")
            .filter(F.col("window_start") + rule.size_ms + rule.grace_ms > F.col("stream_ms"))
            .drop("stream_ms")
            .withColumns({"changed": F.lit(False), "seq": F.lit(None).cast("bigint")})
        )
        windows_now = (
            fresh.unionByName(still_open)
            .groupBy(*WINDOW_KEY)
            .agg(
                *[F.sum(name).alias(name) for name in counted],
                F.max("changed").alias("changed"),
                F.max("seq").alias("seq"),
            )
        )
        return keep(windows_now, "windows", batch_id).filter("changed")

    return store


def start_exact_completion(
    events: DataFrame,
    root: str,
    available_now: bool = False,
    writers: int | None = None,
    every: str = EXACT_INTERVAL,
) -> StreamingQuery:
    """Completion records under the exact rule into ``root/history`` and the views."""
    sink, needed = exact_sink(COMPLETION, root, writers), events.select(*EVENT_COLUMNS)
    return start(needed, sink, f"{root}/checkpoint", COMPLETION_QUERY, available_now, every)


def start_exact_hourly(
    events: DataFrame,
    root: str,
    available_now: bool = False,
    writers: int | None = None,
    every: str = EXACT_INTERVAL,
) -> StreamingQuery:
    """Hourly records under the exact rule into ``root/history`` and the views."""
    sink, needed = exact_sink(RANKING, root, writers), play_starts(events).select(*EVENT_COLUMNS)
    return start(needed, sink, f"{root}/checkpoint", HOURLY_QUERY, available_now, every)
