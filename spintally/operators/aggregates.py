"""The two windowed aggregates and the plain counts.

All of them are hash aggregates with a partial step before the shuffle, so one
song holding a third of the rows reaches the final step as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.functions.plays import completion_rate, is_completed_play, is_start
from spintally.functions.times import floor_to_window, tumbling
from spintally.schema import (
    COMPLETION_FIELDS,
    COMPLETION_WINDOW_MS,
    HOURLY_FIELDS,
    RANKING_WINDOW_MS,
    columns,
)


def _per_window(
    events: DataFrame, size_ms: int, counts: list[Column], also: tuple[str, ...] = ()
) -> DataFrame:
    """Counts by song and window, with the window bounds in milliseconds.

    A stream has to group by Spark's window column, which carries the watermark. A
    table groups by the window start alone, a plain number that hashes faster.
    """
    if events.isStreaming:
        counted = events.groupBy("song_id", *also, tumbling(size_ms).alias("w")).agg(*counts)
        start = F.unix_millis("w.start").alias("window_start")
        return counted.select("*", start, F.unix_millis("w.end").alias("window_end"))
    start = floor_to_window("ts_ms", size_ms).alias("window_start")
    counted = events.groupBy("song_id", *also, start).agg(*counts)
    return counted.withColumn("window_end", F.col("window_start") + size_ms)


def play_starts(events: DataFrame) -> DataFrame:
    return events.filter(is_start())


def completed_plays(events: DataFrame) -> DataFrame:
    return events.filter(is_completed_play())


def completion_counts(events: DataFrame, *also: str) -> DataFrame:
    """Starts and completed plays by song and five-minute window, and by ``also`` if given."""
    counts = [
        F.count_if(is_start()).alias("starts"),
        F.count_if(is_completed_play()).alias("completes"),
    ]
    return _per_window(events, COMPLETION_WINDOW_MS, counts, also)


def completion_stats(events: DataFrame) -> DataFrame:
    """Starts, completed plays and their ratio by song and five-minute window.

    Every event opens its window: one with only skips or progress yields 0/0/0.0.
    """
    return (
        completion_counts(events)
        .withColumn("completion_rate", completion_rate())
        .select(*columns(COMPLETION_FIELDS))
    )


def hourly_counts(events: DataFrame) -> DataFrame:
    """Play starts by song and hour."""
    counts = [F.count("*").alias("play_count")]
    return _per_window(play_starts(events), RANKING_WINDOW_MS, counts).select(
        *columns(HOURLY_FIELDS)
    )


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"))


def song_totals(events: DataFrame) -> DataFrame:
    """Starts, completed plays and ratio by song over all time."""
    return (
        events.groupBy("song_id")
        .agg(
            F.count_if(is_start()).alias("starts"),
            F.count_if(is_completed_play()).alias("completes"),
        )
        .withColumn("completion_rate", completion_rate())
    )


def partition_spread(events: DataFrame) -> DataFrame:
    """Events and songs by stream partition."""
    per_song = events.groupBy("part", "song_id").agg(F.count("*").alias("n"))
    return per_song.groupBy("part").agg(
        F.sum("n").alias("events"), F.count("*").alias("songs")
    )
