"""Versioned result tables written batch by batch.

A micro-batch holds each song and window at most once, so the batch number orders
the versions of a key. Every batch owns the folder ``batch_id=N`` and overwrites it
when it is retried; readers take the highest version per key. Nothing is updated in
place, and a lost executor or a repeated batch leaves the table as it was.
"""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.functions.times import utc_date
from spintally.operators.latest import HISTORY_KEY, latest_per_key
from spintally.schema import (
    COMPLETION_FIELDS,
    EVENT_PARTITIONS,
    HOURLY_FIELDS,
    columns,
    table_schema,
)
from spintally.session import drop_folder, folder_names

BEFORE_ALL_BATCHES = -1
#: A batch is written by as many tasks as it has this many rows.
ROWS_PER_FILE = 500_000
BATCH = re.compile(r"batch_id=(-?\d+)")
HISTORY, LATEST, ARRIVED = "history", "latest", "latest_by_arrival"
#: A view is compacted by the sink after so many batches, beside the batches themselves.
COMPACT_EVERY = 100
COMPACTED = "-compacted"
#: Song ids get a Bloom filter in each row group, so that a lookup skips those without the song.
SONG_FILTER = {"parquet.bloom.filter.enabled#song_id": "true"}
DAY_KEY = ("window_date", *HISTORY_KEY)


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def drop_batch(spark: SparkSession, root: str, batch_id: int) -> None:
    """Delete the folder of a batch that nothing reads any more."""
    drop_folder(spark, batch_path(root, batch_id))


def batches(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches whose folders are there."""
    found = (BATCH.fullmatch(name) for name in folder_names(spark, root))
    return sorted(int(match[1]) for match in found if match)


def _write_days(rows: DataFrame, root: str, batch_id: int, mode: str) -> None:
    """Write rows by day, in each file sorted by song, so that readers can skip files."""
    (
        rows.sortWithinPartitions("window_date", "song_id", "window_start")
        .write.mode(mode)
        .options(**SONG_FILTER)
        .partitionBy("window_date")
        .parquet(batch_path(root, batch_id))
    )


def _dated(records: DataFrame) -> DataFrame:
    return records.withColumn("window_date", utc_date("window_start")).withColumn(
        "updated_at", F.current_timestamp()
    )


def write_history_batch(
    updates: DataFrame, root: str, batch_id: int, writers: int | None = None
) -> None:
    """Store one batch of updates.

    The rows are spread by song over ``writers`` tasks, by default as many as the batch's
    rows fill files: a batch holds one row per song and window, so no song is large. They
    are not gathered by day, as nearly all of a batch belongs to the same one. Counting
    keeps the rows, so that the plan above them runs once.
    """
    if writers is not None:
        _write_days(_dated(updates.repartition(writers, "song_id")), root, batch_id, "overwrite")
        return
    held = updates.persist()
    try:
        writers = max(1, math.ceil(held.count() / ROWS_PER_FILE))
        _write_days(_dated(held.repartition(writers, "song_id")), root, batch_id, "overwrite")
    finally:
        held.unpersist()


def stored_versions(spark: SparkSession, roots, fields) -> DataFrame:
    """All stored versions of the windows, as the batches wrote them."""
    ddl = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in table_schema(fields).fields
    )
    schema = f"{ddl}, updated_at timestamp, batch_id bigint, window_date date"
    versions = None
    for root in roots:
        part = spark.read.schema(schema).parquet(root)
        versions = part if versions is None else versions.unionByName(part)
    return versions


def _history(spark: SparkSession, roots, fields) -> DataFrame:
    rows = stored_versions(spark, roots, fields)
    return latest_per_key(rows, DAY_KEY, "batch_id")


def read_completion_history(spark: SparkSession, *roots: str) -> DataFrame:
    """Completion history: the last version of every song and window.

    Several roots are read as one table, such as a compacted one and the live one.
    A filter on song, window or day reaches the scan through the grouping keys.
    """
    return _history(spark, roots, COMPLETION_FIELDS)


def read_hourly_history(spark: SparkSession, *roots: str) -> DataFrame:
    """Hourly history: the last version of every song and hour."""
    return _history(spark, roots, HOURLY_FIELDS)


def _write_whole(rows: DataFrame, target: str, batch_id: int) -> None:
    """Write a whole history to a new root.

    Rebalancing gathers a day's rows and, under adaptive execution, still splits a day
    that is too large for one task.
    """
    _write_days(rows.hint("rebalance", "window_date"), target, batch_id, "errorifexists")


def store_history(records: DataFrame, target: str) -> None:
    """Write a whole history to a new root, such as one replayed from stored events.

    It counts as older than any batch, so a stream that goes on from there can write to
    a root of its own and both are read together.
    """
    _write_whole(_dated(records), target, BEFORE_ALL_BATCHES)


def compact_history(spark: SparkSession, fields, target: str, *roots: str) -> None:
    """Write one row per key to a new root; the old ones stay until the caller drops them.

    All rows get the newest batch number found, so they stand in for every batch up to
    it, whether or not some of those are still there to be read along.
    """
    versions = stored_versions(spark, roots, fields)
    upto = versions.agg(F.max("batch_id")).first()[0]
    if upto is None:
        raise ValueError("there is no history to compact")
    rows = latest_per_key(versions.filter(F.col("batch_id") <= upto), DAY_KEY, "batch_id")
    _write_whole(rows.drop("batch_id"), target, upto)


def _write_view(rows: DataFrame, root: str, batch_id: int, mode: str) -> None:
    """One row per song; sorted by song within files, so that a lookup can skip them."""
    sorted_rows = rows.sortWithinPartitions("song_id")
    sorted_rows.write.mode(mode).options(**SONG_FILTER).parquet(batch_path(root, batch_id))


def write_latest_batch(
    spark: SparkSession, fields, root: str, batch_id: int, arrival: bool = False
) -> None:
    """Store the newest window of every song that the history batch touched.

    The rows come from the history batch just written, not from the query's plan,
    so the stateful part runs once and the view never runs ahead of the history. With
    ``arrival`` the batch also holds arrival numbers (``seq``), and the window of every
    song that was written last goes to a view of its own.
    """
    names = columns(fields)
    schema = table_schema(fields).add("seq", "long")
    stored = spark.read.schema(schema).parquet(batch_path(f"{root}/{HISTORY}", batch_id))
    newest = latest_per_key(stored.select(*names), ("song_id",), "window_start")
    views = {LATEST: newest.select(*names)}
    if arrival:
        last = latest_per_key(stored.select(*names, "seq"), ("song_id",), "seq")
        views[ARRIVED] = last.select(*names)
    with ThreadPoolExecutor(len(views)) as side_by_side:
        written = [
            side_by_side.submit(_write_view, rows, f"{root}/{view}", batch_id, "overwrite")
            for view, rows in views.items()
        ]
    for one in written:
        one.result()


def _views(spark: SparkSession, roots, fields, before: int | None = None) -> DataFrame:
    """Rows of views: of each the newest compaction and the batches after it.

    ``before`` leaves compactions from that batch on aside.
    """
    schema = table_schema(fields).add("batch_id", "long")
    rows = None

    def add(reader, *paths):
        nonlocal rows
        part = reader.schema(schema).parquet(*paths)
        rows = part if rows is None else rows.unionByName(part)

    for root in roots:
        done = [n for n in batches(spark, root + COMPACTED) if before is None or n < before]
        if not done:
            add(spark.read, root)
            continue
        after = [batch_path(root, n) for n in batches(spark, root) if n > done[-1]]
        compacted = batch_path(root + COMPACTED, done[-1])
        add(spark.read.option("basePath", root + COMPACTED), compacted)
        if after:
            add(spark.read.option("basePath", root), *after)
    return rows


def compact_views(spark: SparkSession, fields, root: str, batch_id: int) -> None:
    """Gather the views of ``root`` up to a batch into one row per song.

    What the compaction before this one stands in for is dropped, so a reader has
    ``COMPACT_EVERY`` batches' time before the files it has listed go. A compaction cut
    short is written again by the retried batch.
    """
    for view, pick in ((LATEST, _newest), (ARRIVED, _last)):
        path = f"{root}/{view}"
        if batch_id not in batches(spark, path):
            continue
        rows = _views(spark, [path], fields, batch_id).filter(F.col("batch_id") <= batch_id)
        _write_view(pick(rows, fields), path + COMPACTED, batch_id, "overwrite")
        older = [n for n in batches(spark, path + COMPACTED) if n < batch_id]
        for number in batches(spark, path):
            if older and number <= older[-1]:
                drop_batch(spark, path, number)
        for number in older[:-1]:
            drop_batch(spark, path + COMPACTED, number)


def _newest(rows: DataFrame, fields) -> DataFrame:
    names = columns(fields)
    versions = latest_per_key(rows, HISTORY_KEY, "batch_id").select(*names)
    return latest_per_key(versions, ("song_id",), "window_start").select(*names)


def _last(rows: DataFrame, fields) -> DataFrame:
    """A batch holds a song's last arrival only, so the batch number orders them."""
    return latest_per_key(rows, ("song_id",), "batch_id").select(*columns(fields))


def read_latest_completion(spark: SparkSession, *roots: str) -> DataFrame:
    """Latest completion of every song: its newest window.

    Several views are read as one, such as a compacted or rebuilt one and the live one.
    """
    return _newest(_views(spark, roots, COMPLETION_FIELDS), COMPLETION_FIELDS)


def read_song_scores(spark: SparkSession, *roots: str) -> DataFrame:
    """Ranking scores: the count of every song's newest hour."""
    rows = _newest(_views(spark, roots, HOURLY_FIELDS), HOURLY_FIELDS)
    return rows.select("song_id", "play_count")


def read_latest_completion_by_arrival(spark: SparkSession, *roots: str) -> DataFrame:
    """The window of every song that was written last; kept where arrivals are numbered."""
    return _last(_views(spark, roots, COMPLETION_FIELDS), COMPLETION_FIELDS)


def read_song_scores_by_arrival(spark: SparkSession, *roots: str) -> DataFrame:
    """The score of every song that was written last; kept where arrivals are numbered."""
    rows = _last(_views(spark, roots, HOURLY_FIELDS), HOURLY_FIELDS)
    return rows.select("song_id", "play_count")


def compact(spark: SparkSession, fields, target: str, *roots: str) -> None:
    """Write history and views of ``roots`` to a new root, one row per key.

    What is written stands in for every batch up to the newest one found in the history;
    ``retire`` then drops those batches where they came from.
    """
    compact_history(spark, fields, f"{target}/{HISTORY}", *[f"{r}/{HISTORY}" for r in roots])
    (upto,) = batches(spark, f"{target}/{HISTORY}")
    for view, pick in ((LATEST, _newest), (ARRIVED, _last)):
        held = [f"{r}/{view}" for r in roots if batches(spark, f"{r}/{view}")]
        if held:
            rows = _views(spark, held, fields).filter(F.col("batch_id") <= upto)
            _write_view(pick(rows, fields), f"{target}/{view}", upto, "errorifexists")


def retire(spark: SparkSession, root: str, compacted: str) -> list[int]:
    """Drop the batches of ``root`` that ``compacted`` stands in for; returns their numbers.

    To be called once readers read both roots. Each folder goes by itself, history last,
    so that a retirement that was cut short is finished by the next one.
    """
    upto = max(batches(spark, f"{compacted}/{HISTORY}"))
    for table in (ARRIVED + COMPACTED, LATEST + COMPACTED, ARRIVED, LATEST, HISTORY):
        gone = [n for n in batches(spark, f"{root}/{table}") if n <= upto]
        for batch_id in gone:
            drop_batch(spark, f"{root}/{table}", batch_id)
    return gone


def clear_latest(spark: SparkSession, root: str) -> None:
    """Drop the views; the history stays, and ``rebuild_latest`` can write them anew."""
    for view in (LATEST + COMPACTED, ARRIVED + COMPACTED, LATEST, ARRIVED):
        for batch_id in batches(spark, f"{root}/{view}"):
            drop_batch(spark, f"{root}/{view}", batch_id)


def rebuild_latest(history: DataFrame, fields, target: str) -> None:
    """Write the latest view anew from the history, as older than any batch.

    ``target`` is a fresh view or one that was cleared; later batches go on top.
    """
    names = columns(fields)
    newest = latest_per_key(history.select(*names), ("song_id",), "window_start")
    _write_view(newest.select(*names), target, BEFORE_ALL_BATCHES, "errorifexists")


def history_sink(
    fields,
    root: str,
    writers: int | None = None,
    arrival: bool = False,
    compact_every: int = COMPACT_EVERY,
):
    """``foreachBatch`` function: history first, then the latest view, both retry-safe.

    After every ``compact_every`` batches the views are compacted, so that a lookup opens a
    bounded number of files however long the query has run.
    """

    def store(updates: DataFrame, batch_id: int) -> None:
        write_history_batch(updates, f"{root}/{HISTORY}", batch_id, writers)
        write_latest_batch(updates.sparkSession, fields, root, batch_id, arrival)
        if (batch_id + 1) % compact_every == 0:
            compact_views(updates.sparkSession, fields, root, batch_id)

    return store


def publish_events(events: DataFrame, root: str, partitions: int = EVENT_PARTITIONS) -> None:
    """Store events by stream partition, the song deciding the partition.

    Rebalancing under adaptive execution splits a partition that a hot song has made
    large into several tasks, so that the number of stream partitions does not limit
    the writers.
    """
    _by_song(events, partitions).hint("rebalance", "part").write.mode(
        "errorifexists"
    ).partitionBy("part").parquet(root)


def _by_song(events: DataFrame, partitions: int) -> DataFrame:
    return events.withColumn("part", F.pmod(F.hash("song_id"), F.lit(partitions)))


def event_sink(root: str, partitions: int = EVENT_PARTITIONS):
    """``foreachBatch`` function: accepted events by stream partition, a folder per batch."""

    def store(events: DataFrame, batch_id: int) -> None:
        rows = _by_song(events, partitions)
        rows.write.mode("overwrite").partitionBy("part").parquet(batch_path(root, batch_id))

    return store
