"""Command-line jobs: run a stream, ask a stored result, keep the tables.

    python -m spintally.jobs stream completion --servers broker:9092 --root /data/completion
    python -m spintally.jobs top --root /data/hourly --n 10

A root holds ``history``, ``latest`` and, where arrivals are numbered, ``latest_by_arrival``;
``--also`` names more roots that are read along, such as a compacted one. Messages that
cannot be used are kept under ``quarantine``. Answers are printed as JSON lines. The same
file can be given to ``spark-submit`` with the package in ``--py-files``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spintally.operators import latest, replay, serving
from spintally.operators.sizing import sized
from spintally.schema import (
    COMPLETION_FIELDS,
    COMPLETION_TOPIC,
    DEFAULT_TOP_N,
    EVENTS_TOPIC,
    HOURLY_FIELDS,
    HOURLY_TOPIC,
    PLAY_EVENT_FIELDS,
    columns,
)
from spintally.session import build_session, streaming_session
from spintally.sources import streams, wire
from spintally.streaming import exact, handover, metrics, sinks, watermarked
from spintally.streaming.state import COMPLETION_COUNTERS, HOURLY_COUNTERS

COMPLETION, HOURLY = "completion", "hourly"
STARTERS = {
    (COMPLETION, False): watermarked.start_completion,
    (HOURLY, False): watermarked.start_hourly,
    (COMPLETION, True): exact.start_exact_completion,
    (HOURLY, True): exact.start_exact_hourly,
}
READERS = {COMPLETION: sinks.read_completion_history, HOURLY: sinks.read_hourly_history}
UPDATES = {COMPLETION: watermarked.completion_updates, HOURLY: watermarked.hourly_updates}
TOPICS = {COMPLETION: COMPLETION_TOPIC, HOURLY: HOURLY_TOPIC}
FIELDS = {COMPLETION: COMPLETION_FIELDS, HOURLY: HOURLY_FIELDS}
COUNTERS = {COMPLETION: COMPLETION_COUNTERS, HOURLY: HOURLY_COUNTERS}
#: Well within the batches that Spark remembers at one a second.
RECORD_SECONDS = 30


def _beside(
    decoded: DataFrame, main: StreamingQuery, args, every: str, first_batch: int = 0
) -> None:
    """Keep rejected messages under ``root/quarantine`` while the main query runs.

    Without an end of their own, both run until one of them stops or fails. What the main
    query observes is stored as it runs.
    """
    # a topic goes on from its offsets; the new folder after a hand-over needs a new checkpoint
    checkpoint = "checkpoint" if args.servers or not first_batch else f"checkpoint-{first_batch}"
    side = watermarked.start_quarantine(
        decoded, f"{args.root}/quarantine", args.once, every, checkpoint
    )
    spark = decoded.sparkSession
    if not args.once:
        while not spark.streams.awaitAnyTermination(RECORD_SECONDS):
            metrics.record(spark, main, args.root, first_batch)
        main.stop()
        side.stop()
    main.awaitTermination()
    metrics.record(spark, main, args.root, first_batch)
    side.awaitTermination()


def _event_stream(spark: SparkSession, args, last: handover.Handover | None) -> DataFrame:
    session = streaming_session(spark)
    if args.servers:
        starting = "earliest" if last is None else last.offsets
        return streams.read_event_topic(session, args.servers, starting=starting)
    return streams.read_event_lines(session, args.lines)


def stream(spark: SparkSession, args) -> None:
    """Aggregate a topic or a folder of JSON lines into ``root`` until stopped, or once.

    With ``--hand-over`` the run is followed by a hand-over: the next one starts with the
    number of state partitions that its session sets. A folder must then be a new one.
    """
    if args.exact and not args.servers:
        raise ValueError("the exact rule needs the partitions and offsets of a topic")
    if args.hand_over and (args.exact or not args.once):
        raise ValueError("only a run by watermark that ends can hand over: use --once")
    last = handover.latest(spark, args.root)
    decoded = _event_stream(spark, args, last)
    every = args.every or (exact.EXACT_INTERVAL if args.exact else watermarked.FLUSH_INTERVAL)
    main = STARTERS[args.kind, args.exact](
        wire.valid_events(decoded), args.root, args.once, args.writers, every
    )
    _beside(decoded, main, args, every, 0 if last is None else last.first_batch)
    if args.hand_over:
        handover.hand_over(spark, main, args.root, FIELDS[args.kind], COUNTERS[args.kind])


def ingest(spark: SparkSession, args) -> None:
    """Accept events from JSON lines and publish them, keyed by song.

    With ``--servers`` they go to the event topic, else by stream partition into
    ``root/events``.
    """
    decoded = streams.read_event_lines(streaming_session(spark), args.lines)
    events = wire.valid_records(decoded).select(*columns(PLAY_EVENT_FIELDS))
    every, checkpoint = args.every or watermarked.FLUSH_INTERVAL, f"{args.root}/checkpoint"
    if args.servers:
        writer = streams.write_topic(
            events, PLAY_EVENT_FIELDS, args.servers, EVENTS_TOPIC, checkpoint
        )
        main = watermarked.triggered(writer, args.once, every).start()
    else:
        sink = sinks.event_sink(f"{args.root}/events")
        main = watermarked.start(events, sink, checkpoint, "ingest", args.once, every)
    _beside(decoded, main, args, every)


def backfill(spark: SparkSession, args) -> DataFrame:
    """Replay stored events, a topic or a table with ``part`` and ``seq``, into a new root.

    Rejected messages of a topic go to ``target/quarantine``. Answers how many there were.
    """
    rejected = 0
    if args.servers:
        # the topic is read once, so that all that follows sees the same end of it
        decoded = sized(streams.read_event_topic(spark, args.servers, stream=False), "topic")
        events = wire.valid_events(decoded)
        wire.quarantine(decoded).write.parquet(f"{args.target}/quarantine")
        rejected = spark.read.parquet(f"{args.target}/quarantine").count()
    else:
        events = spark.read.parquet(args.table)
    if args.kind == COMPLETION:
        records = latest.completion_records(replay.completion_emissions(events))
    else:
        records = latest.hourly_records(replay.hourly_emissions(events))
    sinks.store_history(records, f"{args.target}/history")
    return spark.createDataFrame([(rejected,)], "rejected bigint")


def publish(spark: SparkSession, args) -> None:
    """Aggregate the event topic and send the changed records to the result topic."""
    decoded = streams.read_event_topic(streaming_session(spark), args.servers)
    updates = UPDATES[args.kind](wire.valid_events(decoded))
    writer = streams.write_topic(
        updates, FIELDS[args.kind], args.servers, TOPICS[args.kind], f"{args.root}/checkpoint"
    )
    every = args.every or watermarked.FLUSH_INTERVAL
    _beside(decoded, watermarked.triggered(writer, args.once, every).start(), args, every)


def consume(spark: SparkSession, args) -> None:
    """Keep history and views from the result topic."""
    messages = streams.read_topic(streaming_session(spark), args.servers, TOPICS[args.kind])
    decoded = wire.decode(messages, FIELDS[args.kind])
    every = args.every or watermarked.FLUSH_INTERVAL
    main = watermarked.start_consumer(
        decoded, FIELDS[args.kind], args.root, args.once, args.writers, every
    )
    _beside(decoded, main, args, every)


def _roots(args, table: str) -> list[str]:
    return [f"{root}/{table}" for root in (args.root, *args.also)]


def lookup(spark: SparkSession, args) -> DataFrame:
    """The latest completion of one song."""
    view = sinks.read_latest_completion(spark, *_roots(args, sinks.LATEST))
    return serving.completion_lookup(view, args.song)


def top(spark: SparkSession, args) -> DataFrame:
    """The best songs with their position."""
    scores = sinks.read_song_scores(spark, *_roots(args, sinks.LATEST))
    return serving.ranked_songs(scores, args.n)


def history(spark: SparkSession, args) -> DataFrame:
    """The records of one song within a time range."""
    find = serving.completion_history if args.kind == COMPLETION else serving.play_history
    rows = READERS[args.kind](spark, *_roots(args, sinks.HISTORY))
    return find(rows, args.song, args.from_ms, args.to_ms)


def compact(spark: SparkSession, args) -> None:
    """Write history and views with one row per key to a new root."""
    sinks.compact(spark, FIELDS[args.kind], args.target, args.root, *args.also)


def retire(spark: SparkSession, args) -> DataFrame:
    """Drop the batches that a compacted root stands in for, once readers use both."""
    gone = sinks.retire(spark, args.root, args.compacted)
    return spark.createDataFrame([(n,) for n in gone], "batch_id bigint")


def clear(spark: SparkSession, args) -> None:
    """Drop the views of a root; its history stays."""
    sinks.clear_latest(spark, args.root)


def rebuild(spark: SparkSession, args) -> None:
    """Write the latest view anew from the history, to a new root or a cleared one."""
    stored = READERS[args.kind](spark, *_roots(args, sinks.HISTORY))
    sinks.rebuild_latest(stored, FIELDS[args.kind], f"{args.target or args.root}/{sinks.LATEST}")


def parser() -> argparse.ArgumentParser:
    main_parser = argparse.ArgumentParser(prog="spintally.jobs")
    commands = main_parser.add_subparsers(required=True)

    def command(name, run, kind=True, place="--root"):
        sub = commands.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        if kind:
            sub.add_argument("kind", choices=[COMPLETION, HOURLY])
        sub.add_argument(place, required=True)
        return sub

    def running(sub):
        sub.add_argument("--once", action="store_true")
        sub.add_argument("--every", help="interval between batches, such as '30 seconds'")
        return sub

    sub = running(command("stream", stream))
    source = sub.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers")
    source.add_argument("--lines")
    sub.add_argument("--exact", action="store_true")
    sub.add_argument("--hand-over", action="store_true")
    sub.add_argument("--writers", type=int)

    sub = running(command("ingest", ingest, kind=False))
    sub.add_argument("--lines", required=True)
    sub.add_argument("--servers")

    sub = command("backfill", backfill, place="--target")
    source = sub.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers")
    source.add_argument("--table")

    running(command("publish", publish)).add_argument("--servers", required=True)

    sub = running(command("consume", consume))
    sub.add_argument("--servers", required=True)
    sub.add_argument("--writers", type=int)

    sub = command("lookup", lookup, kind=False)
    sub.add_argument("--song", required=True)
    sub.add_argument("--also", nargs="*", default=[])

    sub = command("top", top, kind=False)
    sub.add_argument("--n", type=int, default=DEFAULT_TOP_N)
    sub.add_argument("--also", nargs="*", default=[])

    sub = command("history", history)
    sub.add_argument("--song", required=True)
    sub.add_argument("--from", dest="from_ms", type=int)
    sub.add_argument("--to", dest="to_ms", type=int)
    sub.add_argument("--also", nargs="*", default=[])

    sub = command("compact", compact)
    sub.add_argument("--target", required=True)
    sub.add_argument("--also", nargs="*", default=[])

    sub = command("rebuild", rebuild)
    sub.add_argument("--target")
    sub.add_argument("--also", nargs="*", default=[])

    command("retire", retire, kind=False).add_argument("--compacted", required=True)
    command("clear", clear, kind=False)
    return main_parser


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    answer = args.run(spark, args)
    if answer is not None:
        for row in answer.selectExpr("to_json(struct(*)) AS line").toLocalIterator():
            print(row.line)


if __name__ == "__main__":
    run(build_session())
