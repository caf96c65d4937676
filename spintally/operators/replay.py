"""Replay of an arrival-ordered event table with the exact late-data rule.

Rows carry ``part`` (stream partition) and ``seq`` (arrival number, unique within a
partition). A partition's stream time is the highest event time that has arrived,
and an event is dropped once ``window_end + grace <= stream time``.

Neither the drop rule nor the running counts sort a partition or a song as a
whole, so the work spreads beyond the number of partitions and a hot song is cut
into bounded pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spintally.functions.plays import completion_rate, is_completed_play, is_start
from spintally.functions.times import floor_to_window
from spintally.operators.aggregates import play_starts
from spintally.operators.latest import window_end
from spintally.operators.rates import as_rates, spread_over_windows, step_start
from spintally.operators.sizing import sized, stored
from spintally.schema import (
    COMPLETION_GRACE_MS,
    COMPLETION_METRIC,
    COMPLETION_WINDOW_MS,
    RANKING_GRACE_MS,
    RANKING_METRIC,
    RANKING_WINDOW_MS,
)

CHUNK_ROWS = 1 << 22
WHOLE_MINUTE_MS = 60_000


def closing_arrivals(
    events: DataFrame, size_ms: int, grace_ms: int, last: str = "seq"
) -> DataFrame:
    """The windows of each partition in which something came late, with their closing arrival.

    An event closes every window that ends at or before its time minus grace. It is
    noted at the newest such window; the earliest note at a window or any newer one
    is the window's closing arrival. Before any shuffle the events shrink to two rows
    per partition and window at most, whatever their number. A window whose last arrival
    came before its closing one drops no event and is left out, so the table grows with
    the windows that are late, not with time. ``last`` is the column of the highest
    arrival number, where the rows stand for several events.
    """
    first = events.groupBy(
        "part",
        floor_to_window("ts_ms", size_ms).alias("held"),
        (floor_to_window(F.col("ts_ms") - grace_ms, size_ms) - size_ms).alias("closed"),
    ).agg(F.min("seq").alias("seq"), F.max(last).alias("last"))
    none = F.lit(None).cast("bigint")
    notes = F.array(
        F.struct(F.col("held").alias("window_start"), none.alias("closer"), F.col("last")),
        F.struct(
            F.col("closed").alias("window_start"), F.col("seq").alias("closer"), none.alias("last")
        ),
    )
    # The few rows left are moved by partition once, which serves both steps below.
    per_window = (
        first.repartition("part")
        .select("part", F.inline(notes))
        .groupBy("part", "window_start")
        .agg(F.min("closer").alias("closer"), F.max("last").alias("last"))
    )
    newer = (
        Window.partitionBy("part")
        .orderBy(F.desc("window_start"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    closed = per_window.withColumn("closer", F.min("closer").over(newer))
    return closed.filter(F.col("last") > F.col("closer")).select("part", "window_start", "closer")


def with_lateness(
    events: DataFrame,
    closing: DataFrame,
    size_ms: int,
    window: str = "window_start",
    late: str = "late",
) -> DataFrame:
    """Look up the closing arrival of each event's window and compare."""
    return (
        events.withColumn(window, floor_to_window("ts_ms", size_ms))
        .join(closing.withColumnRenamed("window_start", window), ["part", window], "left")
        .withColumn(late, F.coalesce(F.col("seq") > F.col("closer"), F.lit(False)))
        .drop("closer")
    )


def mark_late(events: DataFrame, size_ms: int, grace_ms: int) -> DataFrame:
    """Add ``window_start`` and ``late``, whether the event came after its window was closed."""
    closing = sized(closing_arrivals(events, size_ms, grace_ms), "closing")
    return with_lateness(events, closing, size_ms)


def completion_arrivals(events: DataFrame) -> DataFrame:
    """All events, marked for the five-minute windows."""
    return mark_late(events, COMPLETION_WINDOW_MS, COMPLETION_GRACE_MS)


def ranking_arrivals(starts: DataFrame) -> DataFrame:
    """Start events, marked for the hourly windows; only starts advance this stream time."""
    return mark_late(play_starts(starts), RANKING_WINDOW_MS, RANKING_GRACE_MS)


def accepted(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col("late")).drop("late")


def first_arrivals(events: DataFrame) -> DataFrame:
    """The first arrival of every partition, minute of event time and kind (start or not).

    All window bounds and graces are whole minutes, so the closing arrivals of both
    aggregations can be told from these few rows as from the events themselves.
    ``last_seq`` and ``newest_ms`` keep the last arrival and the highest exact time of each.
    """
    minutes = events.groupBy(
        "part",
        is_start().alias("start"),
        floor_to_window("ts_ms", WHOLE_MINUTE_MS).alias("minute"),
    ).agg(
        F.min("seq").alias("seq"),
        F.max("seq").alias("last_seq"),
        F.max("ts_ms").alias("newest_ms"),
    )
    return minutes.withColumnRenamed("minute", "ts_ms")


def arrivals(events: DataFrame) -> DataFrame:
    """Events marked for both aggregations at once, reading them twice in all.

    Adds ``window_start`` and ``late`` for the five-minute windows, and ``hour_start``
    and ``late_play`` for the hourly ones, the latter two meaningful for starts only.
    """
    first = stored(first_arrivals(events))
    closing = closing_arrivals(first, COMPLETION_WINDOW_MS, COMPLETION_GRACE_MS, "last_seq")
    closing_hours = closing_arrivals(
        first.filter("start"), RANKING_WINDOW_MS, RANKING_GRACE_MS, "last_seq"
    )
    marked = with_lateness(events, sized(closing, "closing"), COMPLETION_WINDOW_MS)
    return with_lateness(
        marked, sized(closing_hours, "closing"), RANKING_WINDOW_MS, "hour_start", "late_play"
    )


def late_events(events: DataFrame) -> DataFrame:
    """The dropped events of both aggregations."""

    def entry(metric: str, window: str, dropped: Column):
        return F.when(
            dropped, F.struct(F.lit(metric).alias("metric"), F.col(window).alias("window_start"))
        )

    entries = F.array(
        entry(COMPLETION_METRIC, "window_start", F.col("late")),
        entry(RANKING_METRIC, "hour_start", is_start() & F.col("late_play")),
    )
    return (
        arrivals(events)
        .filter(F.col("late") | (is_start() & F.col("late_play")))
        .select("seq", "part", "song_id", "ts_ms", F.inline(F.array_compact(entries)))
        .select("metric", "seq", "part", "song_id", "ts_ms", "window_start")
    )


def _updates() -> list[Column]:
    """Number of updates each aggregation emits: one per accepted event."""
    return [
        F.count_if(~F.col("late")).alias(COMPLETION_METRIC),
        F.count_if(is_start() & ~F.col("late_play")).alias(RANKING_METRIC),
    ]


def _by_metric(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    metrics = [COMPLETION_METRIC, RANKING_METRIC]
    return counts.unpivot(keys, metrics, "metric", name)


def windows_emitted(events: DataFrame) -> DataFrame:
    """Number of updates emitted by each aggregation."""
    return _by_metric(arrivals(events).agg(*_updates()), [], "updates")


def emit_rate(events: DataFrame) -> DataFrame:
    """Updates per second of each aggregation over a sliding minute of arrival time."""
    panes = arrivals(events).groupBy(step_start("arrival_ms").alias("pane")).agg(*_updates())
    counts = _by_metric(panes, ["pane"], "n").filter(F.col("n") > 0)
    return as_rates(spread_over_windows(counts, "metric"), "metric")


def running_counts(
    events: DataFrame, counters: dict[str, Column], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Counts of a song and window after each of its events, as prefix sums.

    The events move once, to be summed up in order where they land. A song and window of
    more than ``chunk_rows`` events is hot: it is cut into chunks of so many arrival
    numbers that are summed up apart, and each starts with the totals of those before it.
    Only hot groups have such totals, so there are at most as many of them as chunks
    of ``chunk_rows`` events or arrivals; without one nothing is looked up.
    """
    group = ["song_id", "window_start"]
    counted = events.select(
        *group,
        "seq",
        "arrival_ms",
        *[hit.cast("bigint").alias(name) for name, hit in counters.items()],
    )
    hot = counted.groupBy(*group).count().filter(F.col("count") > chunk_rows).select(*group)
    hot = sized(hot, "hot")
    chunk = floor_to_window("seq", chunk_rows)
    cut = bool(hot.limit(1).count())
    if cut:
        marked = hot.withColumn("hot", F.lit(True))
        counted = counted.join(marked, group, "left").withColumn("chunk", F.when(F.col("hot"), chunk))
    inside = (
        Window.partitionBy(*group, *["chunk"] * cut)
        .orderBy("seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = [F.sum(n).over(inside).alias(n) for n in counters]
    summed = counted.select(*group, *["chunk"] * cut, "seq", "arrival_ms", *running)
    if not cut:
        return summed
    carried = sized(_carried(counted.filter("hot").drop("hot"), counters), "carried")
    return summed.join(carried, [*group, "chunk"], "left").select(
        *group,
        "seq",
        "arrival_ms",
        *[(F.col(n) + F.coalesce(f"{n}_before", F.lit(0))).alias(n) for n in counters],
    )


def _carried(hot_events: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """Totals of the chunks before each chunk of the hot groups."""
    group = ["song_id", "window_start"]
    before = (
        Window.partitionBy(*group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = hot_events.groupBy(*group, "chunk").agg(*[F.sum(n).alias(n) for n in counters])
    return totals.select(
        *group,
        "chunk",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in counters],
    )


def last_emissions(events: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """The last row of ``running_counts`` of every song and window, by plain aggregation.

    Counts only grow, so the last emission holds the totals and the highest arrival
    number; no ordering of the events is needed.
    """
    return events.groupBy("song_id", "window_start").agg(
        *[F.count_if(hit).alias(name) for name, hit in counters.items()],
        F.max("seq").alias("seq"),
    )


def completion_counters() -> dict[str, Column]:
    return {"starts": is_start(), "completes": is_completed_play()}


def ranking_counters() -> dict[str, Column]:
    return {"play_count": F.lit(True)}


def completion_changelog(events: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One completion record per accepted event: every event re-emits its window."""
    kept = accepted(completion_arrivals(events))
    counts = running_counts(kept, completion_counters(), chunk_rows)
    return counts.select(
        "seq",
        "arrival_ms",
        "song_id",
        "window_start",
        window_end(COMPLETION_WINDOW_MS).alias("window_end"),
        "starts",
        "completes",
        completion_rate().alias("completion_rate"),
    )


def hourly_changelog(starts: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One hourly record per accepted start."""
    kept = accepted(ranking_arrivals(starts))
    counts = running_counts(kept, ranking_counters(), chunk_rows)
    return counts.select(
        "seq",
        "arrival_ms",
        "song_id",
        "window_start",
        window_end(RANKING_WINDOW_MS).alias("window_end"),
        "play_count",
    )


def completion_emissions(events: DataFrame) -> DataFrame:
    return last_emissions(accepted(completion_arrivals(events)), completion_counters())


def hourly_emissions(starts: DataFrame) -> DataFrame:
    return last_emissions(accepted(ranking_arrivals(starts)), ranking_counters())
