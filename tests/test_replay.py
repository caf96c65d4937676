import pytest
from cases import ALIGNED, BASE, FIVE_MIN, HOUR, event, late_arrivals, replay, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_aggregates import kinds

from spintally.operators import latest
from spintally.operators import replay as rp
from spintally.schema import COMPLETION_GRACE_MS, RANKING_GRACE_MS


def test_late_arrivals_unaligned_base(spark):
    events = late_arrivals(BASE)
    kept, dropped, _ = replay(events, FIVE_MIN, COMPLETION_GRACE_MS)
    marked = rp.completion_arrivals(table(spark, events))
    assert sorted(r.seq for r in marked.filter("late").collect()) == dropped == [2, 4]


def test_late_arrivals_aligned_base(spark):
    events = late_arrivals(ALIGNED)
    marked = rp.completion_arrivals(table(spark, events))
    assert [r.seq for r in marked.filter("late").collect()] == [4]
    first = rp.completion_emissions(table(spark, events)).filter(f"window_start = {ALIGNED}")
    assert first.first().starts == 2


@pytest.mark.parametrize("ahead,late", [(0, True), (-1, False)])
def test_window_closes_exactly_at_end_plus_grace(spark, ahead, late):
    closing = ALIGNED + FIVE_MIN + COMPLETION_GRACE_MS + ahead
    events = [event("a", "PLAY_START", t) for t in (ALIGNED, closing, ALIGNED + 1)]
    marked = rp.completion_arrivals(table(spark, events))
    assert {r.seq: r.late for r in marked.collect()}[2] is late


def test_other_partitions_do_not_close_windows(spark):
    events = [
        event("a", "PLAY_START", ALIGNED, part=0),
        event("b", "PLAY_START", ALIGNED + HOUR, part=1),
        event("a", "PLAY_START", ALIGNED + 1, part=0),
    ]
    assert rp.completion_arrivals(table(spark, events)).filter("late").count() == 0


def test_only_starts_advance_the_ranking(spark):
    base = ALIGNED // HOUR * HOUR
    events = [
        event("a", "PLAY_START", base),
        event("a", "SKIP", base + 3 * HOUR),
        event("a", "PLAY_START", base + 1),
    ]
    assert rp.ranking_arrivals(table(spark, events)).filter("late").count() == 0
    assert rp.completion_arrivals(table(spark, events)).filter("late").count() == 1


def test_late_event_brings_an_older_hour_back(spark):
    hour = ALIGNED // HOUR * HOUR
    times = [hour, hour + HOUR, hour + HOUR - 1]
    emitted = rp.hourly_emissions(table(spark, [event("a", "PLAY_START", t) for t in times]))
    assert latest.song_scores(emitted).first().play_count == 1
    assert latest.song_scores_by_arrival(emitted).first().play_count == 2


def test_late_event_brings_an_older_window_back(spark):
    times = [ALIGNED, ALIGNED + FIVE_MIN, ALIGNED + 9]
    emitted = rp.completion_emissions(table(spark, [event("a", "PLAY_START", t) for t in times]))
    newest = latest.latest_completion(emitted).first()
    written_last = latest.latest_completion_by_arrival(emitted).first()
    assert (newest.window_start, newest.starts) == (ALIGNED + FIVE_MIN, 1)
    assert (written_last.window_start, written_last.starts) == (ALIGNED, 2)


arrivals = st.lists(
    st.builds(
        lambda song, kind, ts, reached: event(
            song, kind, ts, reached, 1000, part={"a": 0, "b": 0, "c": 1}[song]
        ),
        st.sampled_from("abc"),
        kinds,
        st.integers(ALIGNED - HOUR, ALIGNED + 3 * HOUR),
        st.sampled_from([0, 899, 900, 1000]),
    ),
    min_size=1,
    max_size=60,
)
fast = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@fast
@given(arrivals, st.integers(1, 7))
def test_replay_matches_row_by_row(spark, events, chunk_rows):
    df = table(spark, events)
    kept, dropped, log = replay(events, FIVE_MIN, COMPLETION_GRACE_MS)
    rows = rp.completion_changelog(df, chunk_rows).collect()
    assert sorted((r.seq, r.song_id, r.window_start, r.starts, r.completes) for r in rows) == log
    last = {(song, start): (seq, s, c) for seq, song, start, s, c in log}
    emitted = rp.completion_emissions(df).collect()
    assert {(r.song_id, r.window_start): (r.seq, r.starts, r.completes) for r in emitted} == last

    kept60, dropped60, log60 = replay(events, HOUR, RANKING_GRACE_MS, starts_only=True)
    rows = rp.hourly_changelog(df, chunk_rows).collect()
    assert sorted((r.seq, r.song_id, r.window_start, r.play_count) for r in rows) == [
        entry[:4] for entry in log60
    ]
    counted = {r.metric: r.updates for r in rp.windows_emitted(df).collect()}
    assert counted.get("completion_rate", 0) == len(kept)
    assert counted.get("top_songs", 0) == len(kept60)
    late = rp.late_events(df).collect()
    assert sorted((r.metric, r.seq) for r in late) == sorted(
        [("completion_rate", s) for s in dropped] + [("top_songs", s) for s in dropped60]
    )


@fast
@given(arrivals)
def test_large_closing_tables_take_the_shuffled_join(spark, events):
    df = table(spark, events)
    _, dropped, _ = replay(events, FIVE_MIN, COMPLETION_GRACE_MS)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        marked = rp.mark_late(df, FIVE_MIN, COMPLETION_GRACE_MS)
        assert marked.count() == len(events)
        assert sorted(r.seq for r in marked.filter("late").collect()) == dropped
    finally:
        spark.conf.set(key, before)


def test_closing_table_holds_late_windows_only(spark):
    """Far more windows than late events: what is joined grows with the latter."""
    windows = 700_000
    events = spark.range(windows).selectExpr(
        "0 AS part", "id AS seq", f"{ALIGNED} + id * {FIVE_MIN} AS ts_ms"
    )
    late = spark.range(3).selectExpr(
        "0 AS part", f"{windows} + id AS seq", f"{ALIGNED} + id * {FIVE_MIN} AS ts_ms"
    )
    closing = rp.closing_arrivals(events.union(late), FIVE_MIN, COMPLETION_GRACE_MS)
    assert closing.count() == 3
    marked = rp.mark_late(events.union(late), FIVE_MIN, COMPLETION_GRACE_MS)
    text = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted(r.seq for r in marked.filter("late").collect()) == [windows, windows + 1, windows + 2]


def test_upsert_by_generic_latest_row(spark):
    changes = spark.createDataFrame(
        [
            ("song-H", BASE, 10, 5, 0.5, 1),
            ("song-H", BASE, 12, 9, 0.75, 2),
            ("song-H", BASE + FIVE_MIN, 4, 4, 1.0, 3),
        ],
        "song_id string, window_start bigint, starts bigint, completes bigint, completion_rate double, seq bigint",
    )
    rows = latest.latest_per_key(changes, latest.HISTORY_KEY, "seq").orderBy("window_start")
    assert [(r.starts, r.completes, r.completion_rate) for r in rows.collect()] == [
        (12, 9, 0.75),
        (4, 4, 1.0),
    ]
