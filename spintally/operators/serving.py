"""The read side: point lookup, top songs, and history by time range."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spintally.functions.text import bar_length, completion_key
from spintally.functions.times import utc_date
from spintally.operators.sizing import sized, stored
from spintally.schema import (
    COMPLETION_FIELDS,
    DEFAULT_LOOKBACK_MS,
    DEFAULT_TOP_N,
    HOURLY_FIELDS,
    MAX_LOOKBACK_MS,
    REPORT_TOP_N,
    columns,
)
from spintally.sources.wire import from_wire, to_wire

#: Songs of one score that a task orders; those of a score that more share are ordered in ranges.
TIED = 1_000_000


def resolve_range(
    from_ms: int | None = None, to_ms: int | None = None, now_ms: int | None = None
) -> tuple[int, int]:
    """The requested range, by default the day up to now; raises on an empty or too long one."""
    if to_ms is None:
        to_ms = int(time.time() * 1000) if now_ms is None else now_ms
    if from_ms is None:
        from_ms = to_ms - DEFAULT_LOOKBACK_MS
    if from_ms >= to_ms:
        raise ValueError(f"empty range: {from_ms} to {to_ms}")
    if to_ms - from_ms > MAX_LOOKBACK_MS:
        raise ValueError(f"range too long: {to_ms - from_ms} ms, at most {MAX_LOOKBACK_MS}")
    return from_ms, to_ms


def _in_range(history: DataFrame, song_id: str, from_ms: int, to_ms: int) -> DataFrame:
    wanted = (
        (F.col("song_id") == song_id)
        & (F.col("window_start") >= from_ms)
        & (F.col("window_start") < to_ms)
    )
    if "window_date" in history.columns:
        # Stored histories are partitioned by day, so whole days can be skipped.
        first, last = (utc_date(F.lit(ms)) for ms in (from_ms, to_ms))
        wanted = wanted & F.col("window_date").between(first, last)
    return history.filter(wanted)


def completion_history(
    history: DataFrame,
    song_id: str,
    from_ms: int | None = None,
    to_ms: int | None = None,
    now_ms: int | None = None,
) -> DataFrame:
    """Completion records of one song with ``from <= window_start < to``, oldest first."""
    rows = _in_range(history, song_id, *resolve_range(from_ms, to_ms, now_ms))
    return rows.select(*columns(COMPLETION_FIELDS)).orderBy("window_start")


def play_history(
    history: DataFrame,
    song_id: str,
    from_ms: int | None = None,
    to_ms: int | None = None,
    now_ms: int | None = None,
) -> DataFrame:
    """Hourly counts of one song with ``from <= window_start < to``, oldest first."""
    rows = _in_range(history, song_id, *resolve_range(from_ms, to_ms, now_ms))
    return rows.select(*columns(HOURLY_FIELDS)).orderBy("window_start")


def completion_lookup(latest: DataFrame, song_id: str) -> DataFrame:
    """The latest completion record of one song; no row if there is none."""
    return latest.filter(F.col("song_id") == song_id)


def completion_json(latest: DataFrame) -> DataFrame:
    """The latest view as keyed JSON texts."""
    return latest.select(completion_key().alias("key"), to_wire(COMPLETION_FIELDS).alias("value"))


def read_completion_json(entries: DataFrame) -> DataFrame:
    """Back from keyed JSON texts to records."""
    record = from_wire("value", COMPLETION_FIELDS).alias("record")
    return entries.select("key", "value", record).select(
        "key", "value", *[F.col(f"record.{name}").alias(c) for name, c, _ in COMPLETION_FIELDS]
    )


def ranking(scores: DataFrame) -> DataFrame:
    """The whole ranking, best first; equal scores by song id, descending."""
    return scores.orderBy(F.desc("play_count"), F.desc("song_id"))


def top_songs(scores: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """The first ``n`` of the ranking, for any ``n`` from one on."""
    if n < 1:
        raise ValueError(f"n must be at least 1, not {n}")
    return ranking(scores).limit(n)


def score_places(scores: DataFrame) -> DataFrame:
    """Every score with its number of songs and the ranking position its songs begin at.

    A histogram of the scores, summed up from the best one on: its rows are the distinct
    scores, cut into ranges of which each begins after the songs of those before it.
    ``large_before`` counts the songs of better scores that more than ``TIED`` songs share.
    """
    spark = scores.sparkSession
    large = F.when(F.col("songs") > TIED, F.col("songs")).otherwise(0)
    cut = (
        scores.groupBy("play_count")
        .agg(F.count("*").alias("songs"))
        .repartitionByRange(F.desc("play_count"))
        .withColumns({"range": F.spark_partition_id(), "large": large})
    )
    cut = stored(cut)
    sums = cut.groupBy("range").agg(F.sum("songs"), F.sum("large")).collect()  # a row per range
    before, before_large, starts = 0, 0, []
    for part, songs, many in sorted(sums):
        starts.append((part, before, before_large))
        before, before_large = before + songs, before_large + many
    begins = spark.createDataFrame(starts, "range int, before bigint, before_large bigint")
    better = (
        Window.partitionBy("range")
        .orderBy(F.desc("play_count"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def above(start: str, counted: str):
        return F.col(start) + F.coalesce(F.sum(counted).over(better), F.lit(0))

    places = cut.join(F.broadcast(begins), "range").select(
        "play_count",
        "songs",
        (above("before", "songs") + 1).alias("first"),
        above("before_large", "large").alias("large_before"),
    )
    return sized(places, "places")


def _numbered_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` with their ``number`` in the ranking, from 1, counted where they are.

    They are cut into sorted ranges and kept; a range's first number follows from the
    sizes of those before it, of which there is one per range.
    """
    cut = rows.repartitionByRange(F.desc("play_count"), F.desc("song_id"))
    placed = cut.sortWithinPartitions(F.desc("play_count"), F.desc("song_id"))
    # The place holds the range above bit 33 and the row within it below.
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()))
    placed = placed.select(
        *rows.columns,
        F.shiftright("place", 33).alias("range"),
        (F.col("place") % (1 << 33)).alias("row"),
    )
    before, starts = 0, []
    for part, size in sorted(placed.groupBy("range").count().collect()):
        starts.append((part, before))
        before += size
    first = rows.sparkSession.createDataFrame(starts, "range bigint, before bigint")
    return placed.join(F.broadcast(first), "range").select(  # one row per range
        *rows.columns, (F.col("before") + F.col("row") + 1).alias("number")
    )


def _positions(scores: DataFrame, places: DataFrame) -> DataFrame:
    """Songs of the scores in ``places`` with their position; only equal scores are ordered.

    A score that more than ``TIED`` songs share would be one large sort, so the songs of
    such scores are ordered in ranges instead.
    """
    listed = scores.join(places, "play_count")
    position = (F.col("first") + F.col("row") - 1).alias("position")
    tied = Window.partitionBy("play_count").orderBy(F.desc("song_id"))
    few = listed.filter(F.col("songs") <= TIED).withColumn("row", F.row_number().over(tied))
    few = few.select(*scores.columns, position)
    if not places.filter(F.col("songs") > TIED).limit(1).count():
        return few
    many = _numbered_ranges(listed.filter(F.col("songs") > TIED))
    many = many.withColumn("row", F.col("number") - F.col("large_before"))
    return few.union(many.select(*scores.columns, position))


def ranking_positions(scores: DataFrame) -> DataFrame:
    """All songs with their position in the ranking."""
    kept = stored(scores)
    return stored(_positions(kept, score_places(kept)))


def _listing(scores: DataFrame, n: int) -> tuple[DataFrame, int | None]:
    """The first ``n`` songs with their position, best first, and the best score."""
    if n < 1:
        raise ValueError(f"n must be at least 1, not {n}")
    kept = stored(scores)
    places = score_places(kept).filter(F.col("first") <= n)
    best = places.filter(F.col("first") == 1).first()
    listing = _positions(kept, places).filter(F.col("position") <= n)
    return listing.orderBy("position"), best and best["play_count"]


def ranked_songs(scores: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """Top songs with their position, best first, for any ``n`` from one on.

    Only songs whose score begins within the listing are ordered.
    """
    return _listing(scores, n)[0]


def ranked_relative(scores: DataFrame, n: int = REPORT_TOP_N) -> DataFrame:
    """Ranked songs with a bar relative to the best score, which is known before the listing."""
    listing, best = _listing(scores, n)
    top = listing.withColumn("top_score", F.lit(best).cast("bigint"))
    return top.withColumn("bar", bar_length("play_count", "top_score")).drop("top_score")


def top_songs_relative(scores: DataFrame, n: int = REPORT_TOP_N) -> DataFrame:
    """Position, song, score and bar of the top songs."""
    return ranked_relative(scores, n).select("position", "song_id", "play_count", "bar")
