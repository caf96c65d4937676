"""Every query by name. Each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.functions.plays import completion_rate, is_start
from spintally.functions.text import song_slug
from spintally.functions.times import floor_to_window, window_remaining
from spintally.operators import aggregates, latest, rates, reconcile, replay, serving
from spintally.operators.sizing import stored
from spintally.schema import (
    COMPLETION_FIELDS,
    COMPLETION_METRIC,
    COMPLETION_WINDOW_MS,
    HOURLY_FIELDS,
    PLAY_EVENT_FIELDS,
    PLAY_START,
    RANKING_METRIC,
    RANKING_WINDOW_MS,
    columns,
)
from spintally.session import drop_folder, run_dir, streaming_session
from spintally.sources import tables, wire
from spintally.streaming import exact, live_rates, metrics, sinks, state, watermarked

Query = Callable[[SparkSession, str], DataFrame]

LOOKUP_SONG = "song-0"
EXTREMES_MIN_PLAYS = 100

# The adapter's time span, its last window and hour, and the moment inside that
# window at which the reconciled run begins.
END_MS = tables.TIME_ORIGIN_MS + tables.SPAN_MS
TARGET_WINDOW_MS = END_MS - COMPLETION_WINDOW_MS
RUN_START_MS = END_MS - COMPLETION_WINDOW_MS // 2
LAST_HOUR_MS = END_MS - RANKING_WINDOW_MS

COUNTED = ("starts", "completes")
LOST_SONG = "song-16"

# The streaming queries get the arrivals in so many slices of so many files, and restart
# before the slice RESTART.
SLICES = 5
SLICE_FILES = 2
RESTART = 3

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_play_events(spark, sf_dir)


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_play_events(spark, sf_dir, types=(PLAY_START,))


def _late_view(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events and the starts alone, both with delayed arrivals."""
    return tables.delayed(_events(spark, sf_dir)), tables.delayed(_starts(spark, sf_dir))


def _late_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delayed arrivals of many songs: for some the last one belongs to an older window."""
    return tables.delayed(tables.load_play_events(spark, sf_dir, songs=tables.BY_TRACK))


# --- Events ---


@query
def play_events(spark, sf_dir):
    return _events(spark, sf_dir).select(
        *columns(PLAY_EVENT_FIELDS), "seq", "part", F.unix_millis("ts").alias("event_time_ms")
    )


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as wire messages, some of them damaged."""
    text = F.col("value")
    case = F.col("seq") % 50
    damaged = (
        F.when(case == 7, F.substring(text, 1, 40))
        .when(case == 17, F.replace(text, F.lit('"eventType":"'), F.lit('"eventType":"X_')))
        .when(case == 27, F.replace(text, F.lit('"userId"'), F.lit('"listener"')))
        .when(case == 37, F.replace(text, F.lit('"positionMs"'), F.lit('"offsetMs"')))
        .otherwise(text)
    )
    return (
        _events(spark, sf_dir)
        .select("seq", wire.to_wire(PLAY_EVENT_FIELDS).alias("value"))
        .withColumn("value", damaged)
    )


@query
def decode_events(spark, sf_dir):
    """Wire messages, some of them damaged, decoded and checked."""
    decoded = wire.decode_play_events(_messages(spark, sf_dir))
    usable = F.col("reject_reason").isNull()
    return decoded.select(
        "seq",
        F.coalesce("reject_reason", F.lit("")).alias("reject_reason"),
        *[F.when(usable, F.col(c)).alias(c) for c in columns(PLAY_EVENT_FIELDS)],
    )


@query
def rejected_messages(spark, sf_dir):
    """Messages that cannot be used, as received, with the reason."""
    return wire.quarantine(wire.decode_play_events(_messages(spark, sf_dir)))


@query
def play_starts(spark, sf_dir):
    return aggregates.play_starts(_starts(spark, sf_dir)).select(
        "seq", "song_id", "event_type", "ts_ms"
    )


@query
def completed_plays(spark, sf_dir):
    ends = tables.load_play_events(spark, sf_dir, types=("PLAY_END",))
    return aggregates.completed_plays(ends).select(
        "seq", "song_id", "event_type", "ts_ms", "position_ms", "duration_ms"
    )


@query
def window_remaining_(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "seq",
        floor_to_window("ts_ms", COMPLETION_WINDOW_MS).alias("window_start"),
        window_remaining("ts_ms", COMPLETION_WINDOW_MS).alias("remaining_ms"),
    )


@query
def song_slug_(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select("p_partkey", song_slug("p_name").alias("slug"))


# --- Aggregates ---


@query
def completion_stats(spark, sf_dir):
    return aggregates.completion_stats(_events(spark, sf_dir))


@query
def completion_stats_many_songs(spark, sf_dir):
    return aggregates.completion_stats(
        tables.load_play_events(spark, sf_dir, songs=tables.BY_LISTENER)
    )


@query
def hourly_counts(spark, sf_dir):
    return aggregates.hourly_counts(_starts(spark, sf_dir))


@query
def events_by_type(spark, sf_dir):
    return aggregates.events_by_type(_events(spark, sf_dir))


@query
def song_totals(spark, sf_dir):
    return aggregates.song_totals(_events(spark, sf_dir))


@query
def partition_spread(spark, sf_dir):
    return aggregates.partition_spread(_events(spark, sf_dir))


# --- Serving ---


@query
def latest_completion(spark, sf_dir):
    return latest.latest_completion(completion_stats(spark, sf_dir))


@query
def song_scores(spark, sf_dir):
    return latest.song_scores(hourly_counts(spark, sf_dir))


@query
def top_songs(spark, sf_dir):
    return serving.ranked_songs(song_scores(spark, sf_dir))


@query
def ranking_positions(spark, sf_dir):
    """All of many songs with their position."""
    starts = tables.load_play_events(spark, sf_dir, (PLAY_START,), tables.BY_LISTENER)
    return serving.ranking_positions(latest.song_scores(aggregates.hourly_counts(starts)))


@query
def top_songs_relative(spark, sf_dir):
    return serving.top_songs_relative(song_scores(spark, sf_dir))


@query
def completion_lookup(spark, sf_dir):
    return serving.completion_lookup(latest_completion(spark, sf_dir), LOOKUP_SONG)


@query
def completion_json(spark, sf_dir):
    entries = serving.completion_json(latest_completion(spark, sf_dir))
    return serving.read_completion_json(entries)


@query
def completion_history(spark, sf_dir):
    """Records of one song and range, from the events whose windows start within it."""
    events = tables.load_play_events(
        spark, sf_dir, from_ms=LAST_HOUR_MS, to_ms=END_MS + COMPLETION_WINDOW_MS
    )
    stats = aggregates.completion_stats(events)
    return serving.completion_history(stats, LOOKUP_SONG, LAST_HOUR_MS, END_MS)


@query
def play_history(spark, sf_dir):
    from_ms, to_ms = serving.resolve_range(now_ms=END_MS)
    starts = tables.load_play_events(
        spark, sf_dir, (PLAY_START,), from_ms=from_ms, to_ms=to_ms + RANKING_WINDOW_MS
    )
    return serving.play_history(
        aggregates.hourly_counts(starts), LOOKUP_SONG, from_ms, to_ms
    )


# --- Replay with late arrivals ---


@query
def late_events(spark, sf_dir):
    return replay.late_events(_late_view(spark, sf_dir)[0])


@query
def completion_changelog(spark, sf_dir):
    events, _ = _late_view(spark, sf_dir)
    return replay.completion_changelog(events).drop("arrival_ms")


@query
def hourly_changelog(spark, sf_dir):
    _, starts = _late_view(spark, sf_dir)
    return replay.hourly_changelog(starts).drop("arrival_ms")


@query
def completion_history_upsert(spark, sf_dir):
    events, _ = _late_view(spark, sf_dir)
    return latest.completion_records(replay.completion_emissions(events))


@query
def hourly_history_upsert(spark, sf_dir):
    _, starts = _late_view(spark, sf_dir)
    return latest.hourly_records(replay.hourly_emissions(starts))


@query
def latest_completion_replayed(spark, sf_dir):
    events, _ = _late_view(spark, sf_dir)
    return latest.latest_completion(replay.completion_emissions(events))


@query
def latest_completion_by_arrival(spark, sf_dir):
    events, _ = _late_view(spark, sf_dir)
    return latest.latest_completion_by_arrival(replay.completion_emissions(events))


@query
def latest_tracks_replayed(spark, sf_dir):
    return latest.latest_completion(replay.completion_emissions(_late_tracks(spark, sf_dir)))


@query
def latest_tracks_by_arrival(spark, sf_dir):
    return latest.latest_completion_by_arrival(
        replay.completion_emissions(_late_tracks(spark, sf_dir))
    )


@query
def song_scores_by_arrival(spark, sf_dir):
    _, starts = _late_view(spark, sf_dir)
    return latest.song_scores_by_arrival(replay.hourly_emissions(starts))


def _consumed(changelog: DataFrame, fields) -> DataFrame:
    """Emitted records sent as messages, read again, and upserted."""
    messages = wire.encode(changelog, fields, keep=("seq",))
    records = wire.valid_records(wire.decode(messages, fields)).select(*columns(fields), "seq")
    return latest.latest_per_key(records, latest.HISTORY_KEY, "seq").select(*columns(fields))


@query
def consumed_completion_history(spark, sf_dir):
    events, _ = _late_view(spark, sf_dir)
    return _consumed(replay.completion_changelog(events), COMPLETION_FIELDS)


@query
def consumed_hourly_history(spark, sf_dir):
    _, starts = _late_view(spark, sf_dir)
    return _consumed(replay.hourly_changelog(starts), HOURLY_FIELDS)


def _read_from(spark: SparkSession, root: str, answer: DataFrame) -> DataFrame:
    """Keep an answer, small against the tables it was read from, and drop those."""
    kept = stored(answer)
    drop_folder(spark, root)
    return kept


@query
def stored_completion_history(spark, sf_dir):
    """The replayed history, stored and read by song and time."""
    root = run_dir(spark, "completion")
    sinks.store_history(completion_history_upsert(spark, sf_dir), root)
    rows = sinks.read_completion_history(spark, root)
    answer = serving.completion_history(rows, LOOKUP_SONG, LAST_HOUR_MS, END_MS)
    return _read_from(spark, root, answer)


@query
def stored_play_history(spark, sf_dir):
    """The replayed hours, stored and read by song and time."""
    root = run_dir(spark, "hourly")
    sinks.store_history(hourly_history_upsert(spark, sf_dir), root)
    rows = sinks.read_hourly_history(spark, root)
    return _read_from(spark, root, serving.play_history(rows, LOOKUP_SONG, now_ms=END_MS))


@query
def rebuild_read_model(spark, sf_dir):
    """Latest completion and score by song, from the stored histories alone.

    Both histories come from events that are marked for both late rules at once.
    """
    root = run_dir(spark, "model")
    events, _ = _late_view(spark, sf_dir)
    marked = replay.arrivals(events)
    five = marked.filter(~F.col("late"))
    hours = aggregates.play_starts(marked).filter(~F.col("late_play"))
    hours = hours.withColumn("window_start", F.col("hour_start"))
    completion = replay.last_emissions(five, replay.completion_counters())
    plays = replay.last_emissions(hours, replay.ranking_counters())
    sinks.store_history(latest.completion_records(completion), f"{root}/completion")
    sinks.store_history(latest.hourly_records(plays), f"{root}/hourly")
    model = latest.read_model(
        sinks.read_completion_history(spark, f"{root}/completion"),
        sinks.read_hourly_history(spark, f"{root}/hourly"),
    )
    return _read_from(spark, root, model)


@query
def windows_emitted(spark, sf_dir):
    return replay.windows_emitted(_late_view(spark, sf_dir)[0])


# --- Rates ---


@query
def ingest_rate(spark, sf_dir):
    return rates.sliding_rate(_events(spark, sf_dir), "event_type", "arrival_ms")


@query
def peak_ingest_rate(spark, sf_dir):
    return rates.peak_rate(_events(spark, sf_dir), "event_type", "arrival_ms")


@query
def emit_rate(spark, sf_dir):
    return replay.emit_rate(_late_view(spark, sf_dir)[0])


# --- Reconciliation: what a run sent, counted plainly, against what the replay serves ---


def _run_by_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per song: what the run sent, and the latest view before and after it.

    The run is the arrivals from ``RUN_START_MS`` on. What it sent is counted whether or
    not it came late; the views hold accepted events only. One pass over the events.
    """
    marked = replay.completion_arrivals(_late_tracks(spark, sf_dir))
    sent = F.col("arrival_ms") >= RUN_START_MS
    kept, hits = ~F.col("late"), replay.completion_counters()
    windows = marked.groupBy("song_id", "window_start").agg(
        F.count_if(sent).alias("sent"),
        F.count_if(kept).alias("kept"),
        F.count_if(kept & ~sent).alias("found"),
        *[F.count_if(sent & hit).alias(f"sent_{c}") for c, hit in hits.items()],
        *[F.count_if(kept & hit).alias(f"kept_{c}") for c, hit in hits.items()],
        *[F.count_if(kept & ~sent & hit).alias(f"found_{c}") for c, hit in hits.items()],
    )

    def newest(view):
        record = F.struct("window_start", *[F.col(f"{view}_{c}").alias(c) for c in COUNTED])
        return F.max_by(record, F.when(F.col(view) > 0, F.col("window_start"))).alias(view)

    return (
        windows.groupBy("song_id")
        .agg(
            F.sum("sent").alias("sent"),
            *[F.sum(f"sent_{c}").alias(f"sent_{c}") for c in COUNTED],
            newest("kept"),
            newest("found"),
        )
        .filter(F.col("sent") > 0)
    )


def _expected(songs: DataFrame) -> DataFrame:
    """What the run sent on top of what it found."""
    injected = songs.select("song_id", *[F.col(f"sent_{c}").alias(c) for c in COUNTED])
    found = songs.filter("found is not null").select("song_id", "found.*")
    return reconcile.expected_totals(injected, found, TARGET_WINDOW_MS)


def _served(songs: DataFrame) -> DataFrame:
    """The latest view, of which one song got lost."""
    view = songs.filter("kept is not null").select("song_id", "kept.*")
    lost = F.col("song_id") == LOST_SONG
    return view.filter(~lost).withColumn("completion_rate", completion_rate())


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = _run_by_song(spark, sf_dir)
    return reconcile.reconcile(_expected(songs), _served(songs))


@query
def expected_with_baseline(spark, sf_dir):
    return _expected(_run_by_song(spark, sf_dir))


@query
def reconcile_(spark, sf_dir):
    return _reconciled(spark, sf_dir).withColumn("direction", F.coalesce("direction", F.lit("")))


@query
def completion_report(spark, sf_dir):
    return reconcile.completion_report(_reconciled(spark, sf_dir))


@query
def reconcile_summary(spark, sf_dir):
    return reconcile.reconcile_summary(_reconciled(spark, sf_dir))


def _crowded_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking with the many entries that load tests left behind."""
    leftovers = tables.load_play_events(
        spark, sf_dir, types=(PLAY_START,), songs=tables.BY_LISTENER
    )
    return song_scores(spark, sf_dir).union(
        latest.song_scores(aggregates.hourly_counts(leftovers))
    )


@query
def ranking_expected(spark, sf_dir):
    return reconcile.ranking_expected(
        _crowded_ranking(spark, sf_dir), song_totals(spark, sf_dir)
    )


@query
def ranking_leftover(spark, sf_dir):
    return reconcile.ranking_leftover(
        _crowded_ranking(spark, sf_dir), song_totals(spark, sf_dir)
    )


def _hour_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking after the replay of delayed arrivals."""
    starts = aggregates.play_starts(_late_tracks(spark, sf_dir))
    return latest.song_scores(latest.hourly_records(replay.hourly_emissions(starts)))


def _hour_injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts that a run sent from shortly after the last hour began, however late they are."""
    in_run = F.col("arrival_ms") >= LAST_HOUR_MS + COMPLETION_WINDOW_MS
    starts = aggregates.play_starts(_late_tracks(spark, sf_dir))
    return starts.groupBy("song_id").agg(F.count_if(in_run).alias("starts"))


@query
def ranking_check(spark, sf_dir):
    return reconcile.ranking_check(_hour_scores(spark, sf_dir), _hour_injected(spark, sf_dir))


@query
def ranking_report(spark, sf_dir):
    return reconcile.ranking_report(_hour_scores(spark, sf_dir), _hour_injected(spark, sf_dir))


@query
def completion_extremes(spark, sf_dir):
    totals = song_totals(spark, sf_dir)
    expected = totals.withColumn("baseline_starts", F.lit(0).cast("bigint"))
    return reconcile.completion_extremes(
        reconcile.reconcile(expected, totals), song_scores(spark, sf_dir), EXTREMES_MIN_PLAYS
    )


# --- Streaming, read back from what the sinks stored ---


def _slices(spark: SparkSession, events: DataFrame, folder: str, first: int, last: int) -> None:
    """Add slices ``first`` to ``last - 1`` of the arrivals to the folder of a stream.

    Slices follow the arrival numbers. Each is ``SLICE_FILES`` files, which is what one
    micro-batch takes, so every slice is a batch of its own.
    """
    total = events.agg(F.max("seq")).first()[0]
    for number in range(first, last):
        low, high = (total + 1) * number // SLICES, (total + 1) * (number + 1) // SLICES
        part = events.filter((F.col("seq") >= low) & (F.col("seq") < high))
        part.repartition(SLICE_FILES).write.mode("append").parquet(folder)


def _run_streams(spark: SparkSession, sf_dir: str, *starters) -> list[str]:
    """Run streaming queries side by side over the same slices, with a stop and a restart midway.

    Returns their roots, beside which the metrics of both runs are recorded.
    """
    root = run_dir(spark, "stream")
    roots = [f"{root}/{i}" for i in range(len(starters))]
    arrivals = stored(tables.delayed(_events(spark, sf_dir)))
    for first, last in ((0, RESTART), (RESTART, SLICES)):
        _slices(spark, arrivals, f"{root}/in", first, last)
        running = []
        for start, own in zip(starters, roots):
            reader = streaming_session(spark).readStream.schema(arrivals.schema)
            events = reader.option("maxFilesPerTrigger", SLICE_FILES).parquet(f"{root}/in")
            running.append(start(events, own, available_now=True))
        for query_, own in zip(running, roots):
            query_.awaitTermination()
            metrics.record(spark, query_, own)
    return roots


def _run_stream(spark: SparkSession, sf_dir: str, start) -> str:
    return _run_streams(spark, sf_dir, start)[0]


@query
def stream_completion_history(spark, sf_dir):
    root = _run_stream(spark, sf_dir, watermarked.start_completion)
    history = sinks.read_completion_history(spark, f"{root}/history")
    return _read_from(spark, root, history.select(*columns(COMPLETION_FIELDS)))


@query
def stream_latest_completion(spark, sf_dir):
    root = _run_stream(spark, sf_dir, watermarked.start_completion)
    return _read_from(spark, root, sinks.read_latest_completion(spark, f"{root}/latest"))


@query
def stream_hourly_history(spark, sf_dir):
    root = _run_stream(spark, sf_dir, watermarked.start_hourly)
    history = sinks.read_hourly_history(spark, f"{root}/history")
    return _read_from(spark, root, history.select(*columns(HOURLY_FIELDS)))


@query
def stream_top_songs(spark, sf_dir):
    root = _run_stream(spark, sf_dir, watermarked.start_hourly)
    scores = sinks.read_song_scores(spark, f"{root}/latest")
    return _read_from(spark, root, serving.ranked_songs(scores))


def _stream_metrics(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, DataFrame]]:
    """Name, root and batches of both streaming queries, of one run each."""
    roots = _run_streams(spark, sf_dir, watermarked.start_completion, watermarked.start_hourly)
    kinds = (
        (COMPLETION_METRIC, COMPLETION_FIELDS, "starts"),
        (RANKING_METRIC, HOURLY_FIELDS, "play_count"),
    )
    return [
        (name, root, metrics.batch_metrics(spark, root, fields, counted))
        for root, (name, fields, counted) in zip(roots, kinds)
    ]


@query
def stream_late_events(spark, sf_dir):
    """Starts that each streaming query dropped for coming after its watermark."""
    answers = []
    for name, root, batches in _stream_metrics(spark, sf_dir):
        answer = batches.agg(F.sum("late_starts").alias("late_starts"))
        answers.append(
            _read_from(spark, root, answer.select(F.lit(name).alias("metric"), "late_starts"))
        )
    return answers[0].union(answers[1])


@query
def stream_batch_metrics(spark, sf_dir):
    """Starts that arrived, were added and came late, and the records emitted, batch by batch.

    Batches without events, which only move the watermark, are left out of the numbering.
    """
    answers = []
    for name, root, batches in _stream_metrics(spark, sf_dir):
        numbers = {n: i for i, (n,) in enumerate(sorted(batches.select("batch_id").collect()))}
        place = F.create_map(*[F.lit(x).cast("bigint") for pair in numbers.items() for x in pair])
        answer = batches.select(
            F.lit(name).alias("metric"), F.element_at(place, F.col("batch_id")).alias("slice"),
            "starts", "added", "late_starts", "emitted",
        )
        answers.append(_read_from(spark, root, answer))
    return answers[0].union(answers[1])


@query
def stream_open_windows(spark, sf_dir):
    """The windows that the completion query still holds in its state."""
    root = _run_stream(spark, sf_dir, watermarked.start_completion)
    return _read_from(spark, root, state.open_completion(spark, root).drop("state_partition"))


@query
def stream_ingest_rate(spark, sf_dir):
    root = _run_stream(spark, sf_dir, live_rates.start_rates)
    return _read_from(spark, root, live_rates.live_rate(spark, root))


@query
def stream_peak_ingest_rate(spark, sf_dir):
    root = _run_stream(spark, sf_dir, live_rates.start_rates)
    return _read_from(spark, root, live_rates.live_peak(spark, root))


@query
def exact_stream_completion_history(spark, sf_dir):
    root = _run_stream(spark, sf_dir, exact.start_exact_completion)
    history = sinks.read_completion_history(spark, f"{root}/history")
    return _read_from(spark, root, history.select(*columns(COMPLETION_FIELDS)))


@query
def exact_stream_hourly_history(spark, sf_dir):
    root = _run_stream(spark, sf_dir, exact.start_exact_hourly)
    history = sinks.read_hourly_history(spark, f"{root}/history")
    return _read_from(spark, root, history.select(*columns(HOURLY_FIELDS)))


@query
def exact_stream_latest_by_arrival(spark, sf_dir):
    root = _run_stream(spark, sf_dir, exact.start_exact_completion)
    view = sinks.read_latest_completion_by_arrival(spark, f"{root}/latest_by_arrival")
    return _read_from(spark, root, view)


@query
def exact_stream_scores_by_arrival(spark, sf_dir):
    root = _run_stream(spark, sf_dir, exact.start_exact_hourly)
    view = sinks.read_song_scores_by_arrival(spark, f"{root}/latest_by_arrival")
    return _read_from(spark, root, view)


@query
def published_spread(spark, sf_dir):
    """Events stored by stream partition, counted from the stored table."""
    root = run_dir(spark, "published")
    sinks.publish_events(_events(spark, sf_dir), root)
    published = spark.read.parquet(root)
    songs = published.groupBy("part", "song_id").agg(
        F.count("*").alias("events"), F.count_if(is_start()).alias("starts")
    )
    # A song lies in one partition only, whichever the hash chose.
    spread = songs.groupBy("song_id").agg(
        F.count("*").alias("partitions"),
        F.sum("events").alias("events"),
        F.sum("starts").alias("starts"),
    )
    return _read_from(spark, root, spread)
