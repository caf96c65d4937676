"""Record schemas and the fixed values every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these decide the results and must not be changed. ---

EVENT_TYPES = ("PLAY_START", "PLAY_PROGRESS", "PLAY_END", "SKIP")
PLAY_START = "PLAY_START"
PLAY_END = "PLAY_END"

COMPLETION_WINDOW_MS = 5 * 60 * 1000
COMPLETION_GRACE_MS = 60 * 1000
RANKING_WINDOW_MS = 60 * 60 * 1000
RANKING_GRACE_MS = 5 * 60 * 1000
COMPLETED_SHARE = 0.9

DEFAULT_TOP_N = 10
DEFAULT_LOOKBACK_MS = 24 * 3600 * 1000
MAX_LOOKBACK_MS = 720 * 3600 * 1000

REPORT_MIN_PLAYS = 20
REPORT_TOP_N = 12
REPORT_BAR_WIDTH = 24

EVENT_PARTITIONS = 6
EVENTS_TOPIC = "play-events"
COMPLETION_TOPIC = "song-completion-stats"
HOURLY_TOPIC = "song-hourly-counts"
COMPLETION_KEY_PREFIX = "completion:"

COMPLETION_METRIC = "completion_rate"
RANKING_METRIC = "top_songs"

RATE_SPAN_MS = 60 * 1000
RATE_STEP_MS = 15 * 1000

# --- Wire records: (JSON field, column, type), in wire order. ---

PLAY_EVENT_FIELDS = (
    ("eventId", "event_id", T.StringType()),
    ("userId", "user_id", T.StringType()),
    ("songId", "song_id", T.StringType()),
    ("eventType", "event_type", T.StringType()),
    ("timestamp", "ts_ms", T.LongType()),
    ("positionMs", "position_ms", T.LongType()),
    ("durationMs", "duration_ms", T.LongType()),
)
COMPLETION_FIELDS = (
    ("songId", "song_id", T.StringType()),
    ("windowStart", "window_start", T.LongType()),
    ("windowEnd", "window_end", T.LongType()),
    ("starts", "starts", T.LongType()),
    ("completes", "completes", T.LongType()),
    ("completionRate", "completion_rate", T.DoubleType()),
)
HOURLY_FIELDS = (
    ("songId", "song_id", T.StringType()),
    ("windowStart", "window_start", T.LongType()),
    ("windowEnd", "window_end", T.LongType()),
    ("count", "play_count", T.LongType()),
)


def wire_schema(fields) -> T.StructType:
    """Schema of the JSON object."""
    return T.StructType([T.StructField(name, dtype) for name, _, dtype in fields])


def table_schema(fields) -> T.StructType:
    """Schema of the same record as a flat table."""
    return T.StructType([T.StructField(column, dtype) for _, column, dtype in fields])


def columns(fields) -> list[str]:
    return [column for _, column, _ in fields]
