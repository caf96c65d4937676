"""Latest value per key: upserted history, the latest view, and the ranking scores.

``max_by`` over BIGINT columns keeps every step a hash aggregate with a partial
step; ranking rows in a sorted window would pull a hot key into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.functions.plays import completion_rate
from spintally.schema import COMPLETION_WINDOW_MS, RANKING_WINDOW_MS

HISTORY_KEY = ("song_id", "window_start")


def latest_per_key(rows: DataFrame, keys, order: str) -> DataFrame:
    """For every key the row with the highest ``order``; ``order`` is unique per key."""
    values = [c for c in rows.columns if c not in keys and c != order]
    return rows.groupBy(*keys).agg(
        *[F.max_by(c, order).alias(c) for c in values], F.max(order).alias(order)
    )


def _latest_completion(stats: DataFrame, order: str) -> DataFrame:
    rows = stats.groupBy("song_id").agg(
        *[F.max_by(c, order).alias(c) for c in ("window_start", "starts", "completes")]
    )
    return rows.select(
        "song_id",
        "window_start",
        (F.col("window_start") + COMPLETION_WINDOW_MS).alias("window_end"),
        "starts",
        "completes",
        completion_rate().alias("completion_rate"),
    )


def latest_completion(stats: DataFrame) -> DataFrame:
    """The newest window of every song."""
    return _latest_completion(stats, "window_start")


def latest_completion_by_arrival(emissions: DataFrame) -> DataFrame:
    """The window of every song that was written last; after a late event an older one."""
    return _latest_completion(emissions, "seq")


def _scores(counts: DataFrame, order: str) -> DataFrame:
    return counts.groupBy("song_id").agg(F.max_by("play_count", order).alias("play_count"))


def song_scores(counts: DataFrame) -> DataFrame:
    """Score of every song: the count of its newest hour, however long ago that was."""
    return _scores(counts, "window_start")


def song_scores_by_arrival(emissions: DataFrame) -> DataFrame:
    """Score of every song as last written; a late event brings an older hour back."""
    return _scores(emissions, "seq")


def window_end(window_ms: int) -> Column:
    return F.col("window_start") + window_ms


def completion_records(emissions: DataFrame, *keep: str) -> DataFrame:
    """Emitted counts as completion records, with the columns ``keep`` after them."""
    return emissions.select(
        "song_id",
        "window_start",
        window_end(COMPLETION_WINDOW_MS).alias("window_end"),
        "starts",
        "completes",
        completion_rate().alias("completion_rate"),
        *keep,
    )


def hourly_records(emissions: DataFrame, *keep: str) -> DataFrame:
    """Emitted counts as hourly records, with the columns ``keep`` after them."""
    return emissions.select(
        "song_id",
        "window_start",
        window_end(RANKING_WINDOW_MS).alias("window_end"),
        "play_count",
        *keep,
    )


def read_model(completion_history: DataFrame, hourly_history: DataFrame) -> DataFrame:
    """The serving rows rebuilt from the two histories: latest completion and score by song."""
    latest = latest_completion(completion_history)
    return latest.join(song_scores(hourly_history), "song_id", "full")
