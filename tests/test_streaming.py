import json
import os
import random

import pandas as pd
import pyarrow.parquet as pq
import pytest
from cases import (
    ALIGNED,
    BASE,
    FIVE_MIN,
    HOUR,
    event,
    late_arrivals,
    numbered,
    sessions,
    table,
    ten_and_eight,
    totals,
    wire_text,
)
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spintally.operators import aggregates, rates, serving
from spintally.schema import COMPLETION_FIELDS, HOURLY_FIELDS, columns, table_schema
from spintally.session import streaming_session
from spintally.sources import streams, wire
from spintally.streaming import handover, live_rates, metrics, sinks, state, watermarked


class Feed:
    """A folder of JSON-line files, one per micro-batch, in order of arrival."""

    def __init__(self, folder):
        self.folder = str(folder)
        self.files = 0
        os.makedirs(self.folder, exist_ok=True)

    def add(self, *lines):
        path = f"{self.folder}/{self.files:04d}.txt"
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def add_events(self, events):
        self.add(*[wire_text(e) for e in numbered(events)])

    def decoded(self, spark):
        return streams.read_event_lines(streaming_session(spark), self.folder, 1)

    def events(self, spark):
        return wire.valid_events(self.decoded(spark))


def run_completion(spark, feed, root):
    query = watermarked.start_completion(feed.events(spark), str(root), available_now=True)
    query.awaitTermination()
    return query


def run_hourly(spark, feed, root):
    query = watermarked.start_hourly(feed.events(spark), str(root), available_now=True)
    query.awaitTermination()
    return query


def history(spark, root):
    rows = sinks.read_completion_history(spark, f"{root}/history").collect()
    return {(r.song_id, r.window_start): (r.starts, r.completes) for r in rows}


def test_ten_starts_eight_completes(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add_events(ten_and_eight())
    feed.add_events([event("song-A", "PLAY_START", BASE + 7 * 60_000)])
    run_completion(spark, feed, tmp_path / "out")
    assert history(spark, tmp_path / "out")["song-A", ALIGNED] == (10, 8)
    latest = sinks.read_latest_completion(spark, f"{tmp_path}/out/latest")
    (row,) = serving.completion_lookup(latest, "song-A").collect()
    assert (row.window_start, row.starts) == (ALIGNED + FIVE_MIN, 1)
    assert serving.completion_lookup(latest, "song-unknown").collect() == []


@pytest.mark.parametrize("base,first_window", [(BASE, 1), (ALIGNED, 2)])
def test_late_arrivals_one_per_batch(spark, tmp_path, base, first_window):
    feed = Feed(tmp_path / "in")
    for e in late_arrivals(base):
        feed.add_events([e])
    query = run_completion(spark, feed, tmp_path / "out")
    assert history(spark, tmp_path / "out")["song-E", base // FIVE_MIN * FIVE_MIN] == (first_window, 0)
    dropped = sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
    assert dropped == 3 - first_window


@pytest.mark.parametrize("ahead,starts", [(0, 1), (-1, 2)])
def test_window_closes_exactly_at_end_plus_grace(spark, tmp_path, ahead, starts):
    feed = Feed(tmp_path / "in")
    for ts in (ALIGNED, ALIGNED + FIVE_MIN + 60_000 + ahead, ALIGNED + 1):
        feed.add_events([event("a", "PLAY_START", ts)])
    run_completion(spark, feed, tmp_path / "out")
    assert history(spark, tmp_path / "out")["a", ALIGNED] == (starts, 0)


def test_window_with_only_skips_is_emitted(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add_events([event("a", "SKIP", BASE)])
    run_completion(spark, feed, tmp_path / "out")
    assert history(spark, tmp_path / "out") == {("a", ALIGNED): (0, 0)}


def test_hourly_stream_ranking(spark, tmp_path):
    hour = ALIGNED // HOUR * HOUR
    feed = Feed(tmp_path / "in")
    feed.add_events([event("a", "PLAY_START", hour + i) for i in range(3)])
    feed.add_events([event("b", "PLAY_START", hour + 9), event("c", "SKIP", hour + 2 * HOUR)])
    feed.add_events([event("a", "PLAY_START", hour + HOUR)])
    feed.add_events([event("a", "PLAY_START", hour + HOUR - 1)])
    run_hourly(spark, feed, tmp_path / "out")
    rows = sinks.read_hourly_history(spark, f"{tmp_path}/out/history").collect()
    counts = {(r.song_id, r.window_start): r.play_count for r in rows}
    assert counts == {("a", hour): 4, ("b", hour): 1, ("a", hour + HOUR): 1}
    scores = sinks.read_song_scores(spark, f"{tmp_path}/out/latest")
    assert {r.song_id: r.play_count for r in scores.collect()} == {"a": 1, "b": 1}


def test_restart_resumes_with_state(spark, tmp_path):
    events = sessions(120, seed=3)
    feed, root = Feed(tmp_path / "in"), tmp_path / "out"
    feed.add_events(events[:100])
    feed.add_events(events[100:150])
    run_completion(spark, feed, root)
    feed.add_events(events[150:])
    query = run_completion(spark, feed, root)
    assert sum(p.numInputRows for p in query.recentProgress) == len(events) - 150
    assert history(spark, root) == totals(events, FIVE_MIN)


def test_both_queries_run_side_by_side_on_a_clock(spark, tmp_path):
    events = sessions(60, seed=11)
    feed = Feed(tmp_path / "in")
    feed.add_events(events[:60])
    running = [
        watermarked.start_completion(feed.events(spark), f"{tmp_path}/five", writers=2),
        watermarked.start_hourly(feed.events(spark), f"{tmp_path}/hour", writers=2),
    ]
    for query in running:
        query.processAllAvailable()
    feed.add_events(events[60:])
    for query in running:
        query.processAllAvailable()
        query.stop()
    assert history(spark, f"{tmp_path}/five") == totals(events, FIVE_MIN)
    rows = sinks.read_hourly_history(spark, f"{tmp_path}/hour/history").collect()
    assert sum(r.play_count for r in rows) == 60


def test_bad_messages_go_to_quarantine(spark, tmp_path):
    good = wire_text(numbered([event("a", "PLAY_START", BASE)])[0])
    unknown = json.dumps({**json.loads(good), "eventType": "PAUSE"})
    feed = Feed(tmp_path / "in")
    feed.add(good, "{broken", unknown)
    run_completion(spark, feed, tmp_path / "out")
    assert history(spark, tmp_path / "out") == {("a", ALIGNED): (1, 0)}
    watermarked.start_quarantine(feed.decoded(spark), f"{tmp_path}/bad", True).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/bad/rejected").collect()
    assert {r.value: r.reject_reason for r in rows} == {
        "{broken": wire.BROKEN_JSON,
        unknown: wire.UNKNOWN_TYPE,
    }


STATS = (
    "song_id string, window_start bigint, window_end bigint, starts bigint, "
    "completes bigint, completion_rate double"
)


def stats(spark, *rows):
    return spark.createDataFrame(
        [(s, w, w + FIVE_MIN, a, c, c / a) for s, w, a, c in rows], STATS
    )


def store_two_batches(spark, root):
    store = sinks.history_sink(COMPLETION_FIELDS, str(root))
    store(stats(spark, ("song-H", BASE, 10, 5), ("song-I", BASE, 1, 1)), 0)
    store(stats(spark, ("song-H", BASE, 12, 9), ("song-H", BASE + FIVE_MIN, 4, 4)), 1)
    return store


def test_upsert_keeps_the_last_version(spark, tmp_path):
    store_two_batches(spark, tmp_path)
    stored = sinks.read_completion_history(spark, f"{tmp_path}/history")
    rows = serving.completion_history(stored, "song-H", BASE, BASE + FIVE_MIN + 1).collect()
    assert [(r.starts, r.completes, r.completion_rate) for r in rows] == [(12, 9, 0.75), (4, 4, 1.0)]
    assert rows[0].__fields__ == columns(COMPLETION_FIELDS)
    assert stored.filter("updated_at IS NULL").count() == 0


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = store_two_batches(spark, tmp_path)
    before = history(spark, tmp_path)
    latest = set(sinks.read_latest_completion(spark, f"{tmp_path}/latest").collect())
    store(stats(spark, ("song-H", BASE, 12, 9), ("song-H", BASE + FIVE_MIN, 4, 4)), 1)
    assert history(spark, tmp_path) == before
    assert set(sinks.read_latest_completion(spark, f"{tmp_path}/latest").collect()) == latest


def test_writers_limit_the_files_of_a_batch(spark, tmp_path):
    rows = stats(spark, *[(f"song-{i}", BASE, 2, 1) for i in range(50)]).repartition(10)
    sinks.write_history_batch(rows, f"{tmp_path}/history", 0, writers=2)
    stored = spark.read.parquet(f"{tmp_path}/history")
    assert (stored.count(), len(stored.inputFiles())) == (50, 2)


def test_late_batch_leaves_the_newest_window_in_the_view(spark, tmp_path):
    store = store_two_batches(spark, tmp_path)
    store(stats(spark, ("song-H", BASE, 13, 9)), 2)
    newest = sinks.read_latest_completion(spark, f"{tmp_path}/latest")
    assert {r.song_id: r.starts for r in newest.collect()} == {"song-H": 4, "song-I": 1}


def test_view_by_arrival_follows_the_arrivals_of_a_batch(spark, tmp_path):
    """An older window that is written after a newer one of the same batch is the last one."""
    store = sinks.history_sink(COMPLETION_FIELDS, str(tmp_path), arrival=True)
    first = stats(spark, ("song-H", BASE + FIVE_MIN, 5, 5), ("song-H", BASE, 9, 9), ("song-I", BASE, 1, 1))
    store(first.selectExpr("*", "CASE starts WHEN 5 THEN 1L WHEN 9 THEN 2L ELSE 3L END AS seq"), 0)
    view = f"{tmp_path}/latest_by_arrival"
    last = sinks.read_latest_completion_by_arrival(spark, view)
    assert {r.song_id: r.starts for r in last.collect()} == {"song-H": 9, "song-I": 1}
    newest = sinks.read_latest_completion(spark, f"{tmp_path}/latest")
    assert {r.song_id: r.starts for r in newest.collect()} == {"song-H": 5, "song-I": 1}
    store(stats(spark, ("song-H", BASE + FIVE_MIN, 6, 5)).selectExpr("*", "9L AS seq"), 1)
    last = sinks.read_latest_completion_by_arrival(spark, view)
    assert {r.song_id: r.starts for r in last.collect()} == {"song-H": 6, "song-I": 1}


def test_many_batches_are_compacted_and_retired(spark, tmp_path):
    """Two hundred batches: the same rows before and after, and a lookup reads few files."""
    root, whole = f"{tmp_path}/live", f"{tmp_path}/whole"
    songs = [f"song-{i:03d}" for i in range(40)]
    for batch in range(200):
        rows = [(songs[(batch * 7 + i) % 40], BASE + (batch // 50) * FIVE_MIN, batch + i + 1, batch) for i in range(3)]
        path = f"{root}/history/batch_id={batch}/window_date=2024-06-05"
        os.makedirs(path)
        frame = pd.DataFrame(
            [(s, w, w + FIVE_MIN, a, c, c / a, batch * 10 + i) for i, (s, w, a, c) in enumerate(rows)],
            columns=[*columns(COMPLETION_FIELDS), "seq"],
        )
        frame.assign(updated_at=pd.Timestamp("2024-06-05", tz="UTC")).to_parquet(
            f"{path}/part-0.parquet", coerce_timestamps="us"
        )
        os.makedirs(f"{root}/latest/batch_id={batch}")
        frame[columns(COMPLETION_FIELDS)].to_parquet(f"{root}/latest/batch_id={batch}/part-0.parquet")

    def answers(*roots):
        stored = sinks.read_completion_history(spark, *[f"{r}/history" for r in roots])
        view = sinks.read_latest_completion(spark, *[f"{r}/latest" for r in roots])
        return (
            sorted(map(tuple, stored.select(*columns(COMPLETION_FIELDS)).collect())),
            sorted(map(tuple, view.collect())),
        )

    before = answers(root)
    sinks.compact(spark, COMPLETION_FIELDS, whole, root)
    assert answers(root, whole) == before
    assert sinks.retire(spark, root, whole) == list(range(200))
    assert sinks.batches(spark, f"{root}/history") == [] == sinks.batches(spark, f"{root}/latest")
    assert answers(root, whole) == before
    view = sinks.read_latest_completion(spark, f"{root}/latest", f"{whole}/latest")
    assert len(view.inputFiles()) <= 4
    store = sinks.history_sink(COMPLETION_FIELDS, root)
    store(stats(spark, ("song-000", BASE + 9 * FIVE_MIN, 7, 7)), 200)
    rows = answers(root, whole)[1]
    assert [r for r in rows if r[0] == "song-000"][0][1] == BASE + 9 * FIVE_MIN
    assert sinks.retire(spark, root, whole) == []


def test_an_empty_history_cannot_be_compacted(spark, tmp_path):
    os.makedirs(tmp_path / "live" / "history")
    with pytest.raises(ValueError):
        sinks.compact(spark, COMPLETION_FIELDS, f"{tmp_path}/whole", f"{tmp_path}/live")


def test_writers_follow_the_size_of_a_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 20)
    rows = stats(spark, *[(f"song-{i}", BASE, 2, 1) for i in range(50)]).repartition(10)
    sinks.write_history_batch(rows, f"{tmp_path}/history", 0)
    stored = spark.read.parquet(f"{tmp_path}/history")
    assert stored.count() == 50 and 1 < len(stored.inputFiles()) <= 3


def test_compaction_and_rebuild(spark, tmp_path):
    store = store_two_batches(spark, tmp_path)
    before = history(spark, tmp_path)
    sinks.compact_history(spark, COMPLETION_FIELDS, f"{tmp_path}/compacted", f"{tmp_path}/history")
    compacted = sinks.read_completion_history(spark, f"{tmp_path}/compacted")
    assert {(r.song_id, r.window_start): (r.starts, r.completes) for r in compacted.collect()} == before
    stored = spark.read.parquet(f"{tmp_path}/compacted")
    assert (stored.count(), len(stored.inputFiles())) == (len(before), 1)
    store(stats(spark, ("song-I", BASE, 7, 7)), 2)
    roots = (f"{tmp_path}/compacted", f"{tmp_path}/history")
    both = sinks.read_completion_history(spark, *roots)
    now = {(r.song_id, r.window_start): (r.starts, r.completes) for r in both.collect()}
    assert now == {**before, ("song-I", BASE): (7, 7)}
    sinks.compact_history(spark, COMPLETION_FIELDS, f"{tmp_path}/again", *roots)
    again = sinks.read_completion_history(spark, f"{tmp_path}/again")
    assert {(r.song_id, r.window_start): (r.starts, r.completes) for r in again.collect()} == now
    sinks.rebuild_latest(both, COMPLETION_FIELDS, f"{tmp_path}/rebuilt")
    rebuilt = sinks.read_latest_completion(spark, f"{tmp_path}/rebuilt").collect()
    served = sinks.read_latest_completion(spark, f"{tmp_path}/latest").collect()
    assert set(rebuilt) == set(served)


def test_stored_files_are_sorted_by_song(spark, tmp_path):
    rows = [(f"song-{i * 37 % 100:02d}", BASE + i % 3 * 86_400_000, 2, 1) for i in range(300)]
    records = stats(spark, *dict.fromkeys(rows)).repartition(4)
    sinks.write_history_batch(records, f"{tmp_path}/live", 0, writers=2)
    sinks.store_history(records, f"{tmp_path}/whole")
    sinks.compact_history(spark, COMPLETION_FIELDS, f"{tmp_path}/compacted", f"{tmp_path}/live")
    files = list(tmp_path.rglob("*.parquet"))
    assert len(files) >= 9
    for path in files:
        songs = pq.ParquetFile(path).read(columns=["song_id"])["song_id"].to_pylist()
        assert songs == sorted(songs)


def test_history_filters_reach_the_scan(spark, tmp_path):
    store_two_batches(spark, tmp_path)
    stored = sinks.read_completion_history(spark, f"{tmp_path}/history")
    found = serving.completion_history(stored, "song-H", BASE, BASE + FIVE_MIN)
    text = found._jdf.queryExecution().executedPlan().toString()
    partition_filters = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "window_date" in partition_filters
    assert "EqualTo(song_id,song-H)" in text


def test_history_days_do_not_depend_on_the_time_zone(spark, tmp_path):
    store_two_batches(spark, tmp_path)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stored = sinks.read_completion_history(spark, f"{tmp_path}/history")
        rows = serving.completion_history(stored, "song-H", BASE, BASE + 1).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.starts for r in rows] == [12]


def test_lookup_reaches_the_scan_of_the_view(spark, tmp_path):
    store_two_batches(spark, tmp_path)
    view = sinks.read_latest_completion(spark, f"{tmp_path}/latest")
    text = serving.completion_lookup(view, "song-H")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(song_id,song-H)" in text


def test_consumer_keeps_the_last_message_of_each_window(spark, tmp_path):
    sent = [
        stats(spark, ("song-H", BASE, 10, 5)),
        stats(spark, ("song-H", BASE, 12, 9)),
        stats(spark, ("song-H", BASE + FIVE_MIN, 4, 4)),
    ]
    for seq, records in enumerate(sent):
        messages = wire.encode(records, COMPLETION_FIELDS).selectExpr("key", "value", f"{seq}L AS seq")
        messages.coalesce(1).write.mode("append").parquet(f"{tmp_path}/topic")
    source = streaming_session(spark).readStream.schema("key string, value string, seq bigint")
    decoded = wire.decode(source.parquet(f"{tmp_path}/topic"), COMPLETION_FIELDS)
    query = watermarked.start_consumer(decoded, COMPLETION_FIELDS, f"{tmp_path}/out", True)
    query.awaitTermination()
    assert history(spark, f"{tmp_path}/out") == {
        ("song-H", BASE): (12, 9),
        ("song-H", BASE + FIVE_MIN): (4, 4),
    }


def test_results_can_be_read_as_a_stream(spark, tmp_path):
    store_two_batches(spark, tmp_path)
    sibling = streaming_session(spark)
    rows = watermarked.read_results(sibling, str(tmp_path), COMPLETION_FIELDS)
    query = (
        rows.writeStream.format("memory").queryName("results").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sibling.table("results").count() == 4


def test_published_events_are_split_by_song(spark, tmp_path):
    events = table(spark, sessions(50, seed=5)).drop("part")
    sinks.publish_events(events, f"{tmp_path}/published")
    stored = spark.read.parquet(f"{tmp_path}/published")
    assert stored.count() == 100
    assert stored.selectExpr("part", "song_id").distinct().groupBy("song_id").count().filter("count > 1").count() == 0
    assert set(stored.select("part").distinct().toPandas().part) <= set(range(6))


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """One song holds all rows; adaptive execution splits its stream partition."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64kb")
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr(
            "uuid() AS event_id", "'song-hot' AS song_id", "id AS seq"
        )
        sinks.publish_events(rows, f"{tmp_path}/published")
    finally:
        spark.conf.set(size, before)
    stored = spark.read.parquet(f"{tmp_path}/published")
    assert stored.select("part").distinct().count() == 1
    assert len(stored.inputFiles()) > 4
    assert stored.count() == 60_000


@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.integers(0, 10**6), st.sets(st.integers(1, 59), max_size=3))
def test_any_split_of_ordered_events_gives_the_batch_result(spark, tmp_path_factory, seed, cuts):
    events = sorted(sessions(30, seed, spread_ms=20 * 60_000), key=lambda e: e["ts_ms"])
    feed, root = Feed(tmp_path_factory.mktemp("in")), tmp_path_factory.mktemp("out")
    bounds = [0, *sorted(cuts), len(events)]
    for start, stop in zip(bounds, bounds[1:]):
        feed.add_events(events[start:stop])
    run_completion(spark, feed, root)
    run_hourly(spark, feed, f"{root}/hourly")
    assert history(spark, root) == totals(events, FIVE_MIN)
    stored = sinks.read_hourly_history(spark, f"{root}/hourly/history").select(*columns(HOURLY_FIELDS))
    batch = aggregates.hourly_counts(table(spark, events))
    assert set(stored.collect()) == set(batch.collect())


def test_metrics_are_observed_batch_by_batch(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    for e in late_arrivals(BASE):
        feed.add_events([e, event("song-Z", "SKIP", e["ts_ms"])])
    query = run_completion(spark, feed, tmp_path / "out")
    root = str(tmp_path / "out")
    assert metrics.record(spark, query, root) == 5
    assert metrics.record(spark, query, root) == 5  # recorded again, counted once
    rows = metrics.batch_metrics(spark, root, COMPLETION_FIELDS, "starts").orderBy("batch_id").collect()
    assert [(r.starts, r.added, r.late_starts) for r in rows] == [
        (1, 1, 0), (1, 1, 0), (1, 0, 1), (1, 1, 0), (1, 0, 1)
    ]
    kept = sum(starts for starts, _ in history(spark, root).values())
    assert sum(r.added for r in rows) == kept
    assert [r.emitted for r in rows] == [2, 2, 0, 2, 0]
    assert sum(r.dropped_groups for r in rows) == 4


def test_metrics_go_on_after_a_restart(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), str(tmp_path / "out")
    for ts in (ALIGNED, ALIGNED + HOUR):
        feed.add_events([event("a", "PLAY_START", ts), event("a", "PLAY_START", ALIGNED + 1)])
        metrics.record(spark, run_hourly(spark, feed, root), root)
    feed.add_events([event("a", "PLAY_START", ALIGNED + 2)])
    metrics.record(spark, run_hourly(spark, feed, root), root)
    rows = metrics.batch_metrics(spark, root, HOURLY_FIELDS, "play_count").orderBy("batch_id").collect()
    assert [(r.starts, r.added, r.late_starts) for r in rows] == [(2, 2, 0), (2, 2, 0), (1, 0, 1)]


def test_open_windows_are_read_from_the_named_state(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), str(tmp_path / "out")
    feed.add_events([event("a", "PLAY_START", ALIGNED + i) for i in range(3)])
    feed.add_events(
        [event("a", "PLAY_START", ALIGNED + HOUR), event("b", "PLAY_END", ALIGNED + HOUR, 230_000)]
    )
    run_completion(spark, feed, root)
    rows = state.open_completion(spark, root).collect()
    assert {(r.song_id, r.window_start, r.starts, r.completes, r.completion_rate) for r in rows} == {
        ("a", ALIGNED + HOUR, 1, 0, 0.0), ("b", ALIGNED + HOUR, 0, 1, 0.0)
    }
    assert history(spark, root)["a", ALIGNED] == (3, 0)  # closed, and only in the history
    assert state.state_partitions(spark, f"{root}/checkpoint") == 4

    run_hourly(spark, feed, f"{root}2")
    rows = state.open_hourly(spark, f"{root}2").collect()
    hour = ALIGNED // HOUR * HOUR
    assert [(r.song_id, r.window_start, r.window_end, r.play_count) for r in rows] == [
        ("a", hour + HOUR, hour + 2 * HOUR, 1)
    ]


def test_live_rates_equal_those_of_the_table(spark, tmp_path):
    rng = random.Random(2)
    arrivals = sorted(rng.randrange(0, 200_000) for _ in range(400))
    types = ["PLAY_START", "SKIP", "PLAY_END"]
    rows = [(types[rng.randrange(3)], ALIGNED + ms) for ms in arrivals]
    table = spark.createDataFrame(rows, "event_type string, arrival_ms bigint")
    folder, root = str(tmp_path / "in"), str(tmp_path / "rates")
    for first in range(0, 400, 80):
        part = spark.createDataFrame(rows[first : first + 80], table.schema).coalesce(1)
        part.write.mode("append").parquet(folder)
        reader = streaming_session(spark).readStream.schema(table.schema)
        live_rates.start_rates(reader.parquet(folder), root, available_now=True).awaitTermination()
    got = sorted(tuple(r) for r in live_rates.live_rate(spark, root).collect())
    assert got == sorted(tuple(r) for r in rates.sliding_rate(table, "event_type", "arrival_ms").collect())
    peak = rates.peak_rate(table, "event_type", "arrival_ms").first()
    assert live_rates.live_peak(spark, root).first() == peak


def with_partitions(spark, count):
    session = streaming_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", str(count))
    return session


@pytest.mark.parametrize("kind", ["completion", "hourly"])
def test_state_partitions_change_without_losing_or_doubling(spark, tmp_path, kind):
    rng = random.Random(5)
    first_of = {"completion": watermarked.start_completion, "hourly": watermarked.start_hourly}
    read_of = {"completion": sinks.read_completion_history, "hourly": sinks.read_hourly_history}
    fields = {"completion": COMPLETION_FIELDS, "hourly": HOURLY_FIELDS}[kind]
    counters = {"completion": state.COMPLETION_COUNTERS, "hourly": state.HOURLY_COUNTERS}[kind]
    step = {"completion": FIVE_MIN, "hourly": HOUR}[kind]
    batches = []
    for number in range(6):  # each goes on in the windows of the one before, and has late events
        own = []
        for _ in range(60):
            back = rng.choice([0, 0, 0, 1, 4])
            ts = ALIGNED // HOUR * HOUR + (number * step) // 2 + rng.randrange(step) - back * step
            kind_of = rng.choice(["PLAY_START", "PLAY_START", "PLAY_END", "SKIP"])
            own.append(event(f"s{rng.randrange(7)}", kind_of, ts, 230_000))
        batches.append(own)

    def run(folder, root, count, some):
        feed = Feed(folder)
        for own in some:
            feed.add_events(own)
        lines = streams.read_event_lines(with_partitions(spark, count), feed.folder, 1)
        query = first_of[kind](wire.valid_events(lines), root, available_now=True)
        query.awaitTermination()
        return query

    whole, split = str(tmp_path / "whole"), str(tmp_path / "split")
    run(tmp_path / "all", whole, 4, batches)
    for number, (count, some) in enumerate([(4, batches[:2]), (8, batches[2:4]), (3, batches[4:])]):
        query = run(tmp_path / f"part{number}", split, count, some)
        last = handover.latest(spark, split)
        assert state.state_partitions(spark, handover.checkpoint(split, last)) == count
        if number < 2:
            made = handover.hand_over(spark, query, split, fields, counters)
            assert handover.latest(spark, split) == made

    def rows(root):
        table = read_of[kind](spark, f"{root}/history")
        return sorted(tuple(r) for r in table.select(*columns(fields)).collect())

    assert rows(split) == rows(whole)
    found = sinks.batches(spark, f"{split}/history")
    assert len(found) == len(set(found)) >= 6
    late = 60 * 6 - sum(r[3] for r in rows(whole))
    assert kind == "completion" or late > 0


def test_only_a_stopped_query_hands_over(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add_events([event("a", "PLAY_START", ALIGNED)])
    root = str(tmp_path / "out")
    query = watermarked.start_completion(feed.events(spark), root)
    try:
        with pytest.raises(ValueError):
            handover.hand_over(spark, query, root, COMPLETION_FIELDS, state.COMPLETION_COUNTERS)
    finally:
        query.stop()
    assert handover.latest(spark, root) is None


def files_read(df):
    """Files that the scans of a plan have opened, by their own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if "numFiles" in node.metrics().keySet().mkString(","):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_lookup_opens_few_files_after_many_batches(spark, tmp_path):
    root = str(tmp_path / "out")
    names = columns(COMPLETION_FIELDS)
    many = 2000
    for batch in range(many - 1):
        os.makedirs(f"{root}/latest/batch_id={batch}")
        song = f"s{batch % 300}"
        frame = pd.DataFrame([(song, ALIGNED + batch * FIVE_MIN, ALIGNED + (batch + 1) * FIVE_MIN, batch, 0, 0.0)], columns=names)
        frame.to_parquet(f"{root}/latest/batch_id={batch}/part-0.parquet")
    store = sinks.history_sink(COMPLETION_FIELDS, root, compact_every=100)

    def add(batch, song, starts):
        start = ALIGNED + batch * FIVE_MIN
        row = (song, start, start + FIVE_MIN, starts, 0, 0.0)
        store(spark.createDataFrame([row], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(COMPLETION_FIELDS))), batch)

    before = {r.song_id: tuple(r) for r in sinks.read_latest_completion(spark, f"{root}/latest").collect()}
    add(many - 1, "s7", 77)  # the batch that compacts
    for batch in range(many, many + 3):
        add(batch, "s8", batch)
    view = sinks.read_latest_completion(spark, f"{root}/latest")
    after = {r.song_id: r.starts for r in view.collect()}
    expected = {song: row[3] for song, row in before.items()} | {"s7": 77, "s8": many + 2}
    assert after == expected
    compacted = len(list((tmp_path / "out" / "latest-compacted").rglob("*.parquet")))
    assert files_read(serving.completion_lookup(view, "s7")) <= compacted + 3 < 20

    for batch in range(many + 3, many + 200):
        os.makedirs(f"{root}/latest/batch_id={batch}", exist_ok=True)
        pd.DataFrame([("s9", ALIGNED, ALIGNED + FIVE_MIN, 1, 0, 0.0)], columns=names).to_parquet(f"{root}/latest/batch_id={batch}/part-0.parquet")
        if (batch + 1) % 100 == 0:
            sinks.compact_views(spark, COMPLETION_FIELDS, root, batch)
    assert sinks.batches(spark, f"{root}/latest-compacted") == [many + 99, many + 199]
    assert sinks.batches(spark, f"{root}/latest") == list(range(many + 100, many + 200))
    sinks.compact_views(spark, COMPLETION_FIELDS, root, many + 199)  # as a retried batch does
    view = sinks.read_latest_completion(spark, f"{root}/latest")
    assert {r.song_id: r.starts for r in view.collect()} == expected
    assert files_read(serving.completion_lookup(view, "s7")) < 20
    sinks.clear_latest(spark, root)
    assert sinks.batches(spark, f"{root}/latest-compacted") == []


def test_files_have_a_filter_of_the_songs(spark, tmp_path):
    many = spark.range(200_000).selectExpr(
        "sha1(cast(id as string)) AS song_id", "0L AS window_start", "1L AS window_end",
        "1L AS starts", "0L AS completes", "0.0D AS completion_rate",
    ).coalesce(1)
    sinks.rebuild_latest(many, COMPLETION_FIELDS, f"{tmp_path}/view")
    read = spark.read.parquet(f"{tmp_path}/view").drop("batch_id").coalesce(1)
    read.sortWithinPartitions("song_id").write.parquet(f"{tmp_path}/plain")

    def size(folder):
        return sum(p.stat().st_size for p in (tmp_path / folder).rglob("*.parquet"))

    assert size("view") > size("plain") + 100_000
