"""Play events derived from the clickstream ``events`` table.

The table spreads its rows thinly over thirty days; event time is compressed so
that windows fill up. Every column is a built-in expression, so the adapter adds
no stage of its own and only the columns a query uses are read.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.functions.times import event_time
from spintally.schema import EVENT_PARTITIONS

# --- Fixed values of the adapter. ---
TIME_ORIGIN_MS = 1704067200000
TIME_COMPRESSION = 144
SPAN_MS = 5 * 3600 * 1000
TYPE_OF_ACTION = {
    "view": "PLAY_START",
    "click": "PLAY_START",
    "purchase": "PLAY_END",
    "signup": "PLAY_PROGRESS",
    "error": "SKIP",
}
TRACK_PATTERN = r'"k"\s*:\s*(\d+)'
SHORT_DELAY_MS = 200_000
LONG_DELAY_MS = 600_000

BY_RANK, BY_TRACK, BY_LISTENER = "rank", "track", "listener"


def read_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream. A pattern, as a file stream takes no single file."""
    schema = read_actions(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")


def _event_type() -> Column:
    cases = None
    for action, event_type in TYPE_OF_ACTION.items():
        hit = F.col("event_type") == action
        cases = F.when(hit, event_type) if cases is None else cases.when(hit, event_type)
    return cases


def raw_time(ms: int) -> Column:
    """The first raw timestamp whose event time is ``ms`` or later."""
    raw = TIME_ORIGIN_MS + (ms - TIME_ORIGIN_MS) * TIME_COMPRESSION
    return F.lit(datetime.fromtimestamp(raw / 1000, UTC).replace(tzinfo=None)).cast("timestamp_ntz")


def play_events(
    actions: DataFrame,
    types: tuple[str, ...] | None = None,
    songs: str = BY_RANK,
    from_ms: int | None = None,
    to_ms: int | None = None,
) -> DataFrame:
    """Map action rows to play events.

    ``types`` keeps only those play-event types. The restriction is put on the raw
    column, where the scan can use it; a filter on the mapped column could not be
    pushed down. ``songs`` says how songs are told apart: ten of them by popularity, a
    hundred by track, or the many that a load test leaves behind, by listener and track.
    ``from_ms <= ts_ms < to_ms`` restricts event time, again on the raw column, of which it
    is a growing function.
    """
    if from_ms is not None:
        actions = actions.filter(F.col("ts") >= raw_time(from_ms))
    if to_ms is not None:
        actions = actions.filter(F.col("ts") < raw_time(to_ms))
    if types is not None:
        wanted = [action for action, mapped in TYPE_OF_ACTION.items() if mapped in types]
        actions = actions.filter(F.col("event_type").isin(wanted))
    since_origin = F.unix_millis(F.col("ts").cast("timestamp")) - F.lit(TIME_ORIGIN_MS)
    # One flat field is wanted; a pattern costs a quarter of parsing the JSON text.
    # An action without it belongs to the null track.
    k = F.regexp_extract("props", TRACK_PATTERN, 1).try_cast("int")
    rank = F.lit(9) - F.floor(F.sqrt(F.col("k").cast("double")))
    names = {
        BY_RANK: [F.col("song_rank")],
        BY_TRACK: [F.col("k")],
        BY_LISTENER: [F.col("user_id"), F.lit("-"), F.col("k")],
    }[songs]
    share = F.least(F.col("value") / F.lit(50.0), F.lit(1.0))
    reached = share * F.col("duration_ms").cast("double")
    return (
        actions.select(
            "event_id",
            "user_id",
            _event_type().alias("event_type"),
            "value",
            k.alias("k"),
            (F.lit(TIME_ORIGIN_MS) + F.floor(since_origin / TIME_COMPRESSION)).alias("ts_ms"),
        )
        .withColumn("song_rank", rank)
        .withColumn("duration_ms", F.lit(168000) + F.lit(20000) * F.col("song_rank"))
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            F.concat(F.lit("user-"), F.col("user_id")).alias("user_id"),
            F.concat(F.lit("song-"), *names).alias("song_id"),
            "event_type",
            "ts_ms",
            F.floor(reached).alias("position_ms"),
            "duration_ms",
            F.col("event_id").cast("bigint").alias("seq"),
            (F.col("song_rank") % F.lit(EVENT_PARTITIONS)).cast("int").alias("part"),
            F.col("ts_ms").alias("arrival_ms"),
            event_time().alias("ts"),
        )
    )


def load_play_events(
    spark: SparkSession,
    sf_dir: str,
    types: tuple[str, ...] | None = None,
    songs: str = BY_RANK,
    from_ms: int | None = None,
    to_ms: int | None = None,
) -> DataFrame:
    return play_events(read_actions(spark, sf_dir), types, songs, from_ms, to_ms)


def delayed(events: DataFrame) -> DataFrame:
    """The same arrivals with some event times moved back, so that windows see late events."""
    step = F.col("seq") % 10
    delay = (
        F.when(step == 0, F.lit(SHORT_DELAY_MS)).when(step == 5, F.lit(LONG_DELAY_MS)).otherwise(0)
    )
    return events.withColumn("ts_ms", F.col("ts_ms") - delay).withColumn("ts", event_time())
