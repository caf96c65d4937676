import pytest
from cases import ALIGNED, BASE, FIVE_MIN, HOUR, event, sessions, table, ten_and_eight, totals
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spintally.operators import aggregates


def stats_of(spark, events):
    rows = aggregates.completion_stats(table(spark, events)).collect()
    return {(r.song_id, r.window_start): r for r in rows}


@pytest.mark.parametrize("base", [BASE, BASE + 1000])
def test_ten_starts_eight_completes(spark, base):
    later = event("song-A", "PLAY_START", BASE + 7 * 60_000)
    rows = stats_of(spark, ten_and_eight(base) + [later])
    first = rows["song-A", ALIGNED]
    assert (first.starts, first.completes, first.completion_rate) == (10, 8, 0.8)
    assert first.window_end == ALIGNED + FIVE_MIN
    assert len(rows) == 2


def test_completion_threshold_is_inclusive(spark):
    events = [
        event("a", "PLAY_START", BASE),
        event("a", "PLAY_END", BASE, 216_000, 240_000),
        event("a", "PLAY_END", BASE, 215_999, 240_000),
    ]
    (row,) = stats_of(spark, events).values()
    assert (row.starts, row.completes, row.completion_rate) == (1, 1, 1.0)


def test_zero_duration_completes(spark):
    (row,) = stats_of(spark, [event("a", "PLAY_END", BASE, 0, 0)]).values()
    assert (row.starts, row.completes, row.completion_rate) == (0, 1, 0.0)


def test_window_with_only_other_events_has_a_row(spark):
    events = [event("a", "SKIP", BASE), event("a", "PLAY_PROGRESS", BASE)]
    (row,) = stats_of(spark, events).values()
    assert (row.starts, row.completes, row.completion_rate) == (0, 0, 0.0)


def test_rate_may_exceed_one(spark):
    events = [event("a", "PLAY_START", BASE)]
    events += [event("a", "PLAY_END", BASE, 240_000) for _ in range(2)]
    (row,) = stats_of(spark, events).values()
    assert row.completion_rate == 2.0


def test_window_edges_are_half_open(spark):
    events = [event("a", "PLAY_START", ALIGNED + o) for o in (0, FIVE_MIN - 1, FIVE_MIN)]
    rows = stats_of(spark, events)
    assert rows["a", ALIGNED].starts == 2
    assert rows["a", ALIGNED + FIVE_MIN].starts == 1


def test_duplicate_ids_count_twice(spark):
    events = [event("a", "PLAY_START", BASE, event_id="same") for _ in range(2)]
    (row,) = stats_of(spark, events).values()
    assert row.starts == 2


def test_mixed_songs(spark):
    events = []
    for song in "ABCDE":
        events.append(event(f"song-{song}", "PLAY_START", BASE))
        events.append(event(f"song-{song}", "PLAY_END", BASE, 220_000 if song < "D" else 60_000))
    rates = {k[0]: r.completion_rate for k, r in stats_of(spark, events).items()}
    assert [rates[f"song-{s}"] for s in "ABCDE"] == [1.0, 1.0, 1.0, 0.0, 0.0]


def test_skewed_sessions(spark):
    events = sessions(300, seed=7)
    expected = totals(events, FIVE_MIN)
    rows = stats_of(spark, events)
    assert {k: (r.starts, r.completes) for k, r in rows.items()} == expected


def test_hourly_counts_take_starts_only(spark):
    events = [event("a", "PLAY_START", BASE), event("a", "SKIP", BASE)]
    events.append(event("b", "PLAY_END", BASE, 240_000))
    (row,) = aggregates.hourly_counts(table(spark, events)).collect()
    start = BASE // HOUR * HOUR
    assert tuple(row) == ("a", start, start + HOUR, 1)


def test_partition_spread(spark):
    events = [event("a", "PLAY_START", BASE, part=1) for _ in range(3)]
    events += [event("b", "SKIP", BASE, part=1), event("c", "SKIP", BASE, part=4)]
    rows = aggregates.partition_spread(table(spark, events)).collect()
    assert sorted(map(tuple, rows)) == [(1, 4, 2), (4, 1, 1)]


kinds = st.sampled_from(["PLAY_START", "PLAY_PROGRESS", "PLAY_END", "SKIP"])
some_events = st.lists(
    st.builds(
        event,
        st.sampled_from("abc"),
        kinds,
        st.integers(ALIGNED - FIVE_MIN, ALIGNED + 3 * FIVE_MIN),
        st.integers(0, 1000),
        st.integers(0, 1000),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(some_events)
def test_any_events_match_row_by_row_counts(spark, events):
    rows = stats_of(spark, events)
    assert {k: (r.starts, r.completes) for k, r in rows.items()} == totals(events, FIVE_MIN)
    overall = {r.song_id: r.starts for r in aggregates.song_totals(table(spark, events)).collect()}
    for song, starts in overall.items():
        assert starts == sum(r.starts for k, r in rows.items() if k[0] == song)
