import json

import pytest
from cases import BASE, FIVE_MIN

from spintally.functions.text import bar_length, percent_text, song_slug
from spintally.operators import serving

HOUR = 3_600_000
STATS = (
    "song_id string, window_start bigint, window_end bigint, starts bigint, "
    "completes bigint, completion_rate double"
)


def stats(spark):
    rows = [
        ("song-H", BASE + FIVE_MIN, BASE + 2 * FIVE_MIN, 4, 4, 1.0),
        ("song-H", BASE, BASE + FIVE_MIN, 12, 9, 0.75),
        ("song-X", BASE, BASE + FIVE_MIN, 10, 8, 0.8),
    ]
    return spark.createDataFrame(rows, STATS)


def test_history_is_ordered_and_half_open(spark):
    rows = serving.completion_history(stats(spark), "song-H", BASE, BASE + FIVE_MIN + 1).collect()
    assert [r.starts for r in rows] == [12, 4]
    rows = serving.completion_history(stats(spark), "song-H", BASE, BASE + FIVE_MIN).collect()
    assert [r.starts for r in rows] == [12]


@pytest.mark.parametrize(
    "given", [dict(from_ms=200, to_ms=100), dict(from_ms=5, to_ms=5), dict(from_ms=0, to_ms=720 * HOUR + 1)]
)
def test_bad_ranges_are_rejected(spark, given):
    with pytest.raises(ValueError):
        serving.completion_history(stats(spark), "song-H", **given)


def test_range_defaults():
    assert serving.resolve_range(now_ms=100 * HOUR) == (76 * HOUR, 100 * HOUR)
    assert serving.resolve_range(to_ms=50 * HOUR) == (26 * HOUR, 50 * HOUR)
    assert serving.resolve_range(0, 720 * HOUR) == (0, 720 * HOUR)
    start, end = serving.resolve_range()
    assert end - start == 24 * HOUR


def test_lookup(spark):
    found = serving.completion_lookup(stats(spark), "song-X").collect()
    assert [tuple(r) for r in found] == [("song-X", BASE, BASE + FIVE_MIN, 10, 8, 0.8)]
    assert serving.completion_lookup(stats(spark), "song-unknown").collect() == []


def test_json_view_round_trip(spark):
    entries = serving.completion_json(serving.completion_lookup(stats(spark), "song-X"))
    row = serving.read_completion_json(entries).first()
    assert row.key == "completion:song-X"
    assert json.loads(row.value) == {
        "songId": "song-X",
        "windowStart": BASE,
        "windowEnd": BASE + FIVE_MIN,
        "starts": 10,
        "completes": 8,
        "completionRate": 0.8,
    }
    assert (row.song_id, row.starts, row.completion_rate) == ("song-X", 10, 0.8)


def scores(spark, *rows):
    return spark.createDataFrame(list(rows), "song_id string, play_count bigint")


def test_top_songs_break_ties_by_song_descending(spark):
    ranked = scores(spark, ("a", 5), ("b", 9), ("c", 5), ("d", 1))
    assert [r.song_id for r in serving.top_songs(ranked, 3).collect()] == ["b", "c", "a"]
    rows = serving.ranked_songs(ranked).orderBy("position").collect()
    assert [(r.position, r.song_id) for r in rows] == [(1, "b"), (2, "c"), (3, "a"), (4, "d")]


def test_listing_length_is_checked(spark):
    for n in (0, -1):
        with pytest.raises(ValueError):
            serving.top_songs(scores(spark, ("a", 1)), n)


def test_listings_have_no_upper_limit(spark):
    many = spark.range(150_000).selectExpr("concat('s-', id) AS song_id", "id % 700 AS play_count")
    rows = serving.ranked_songs(many, 100_001).collect()
    assert [r.position for r in rows] == list(range(1, 100_002))
    listed = [(r.play_count, r.song_id) for r in rows]
    assert listed == sorted(((i % 700, f"s-{i}") for i in range(150_000)), reverse=True)[:100_001]


def test_positions_are_numbered_where_the_rows_are(spark):
    many = spark.range(20_000).selectExpr("concat('s-', id) AS song_id", "id % 7 AS play_count")
    placed = serving.ranking_positions(many)
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "Window" not in text
    found = {r.song_id: r.position for r in placed.collect()}
    order = sorted(((i % 7, f"s-{i}") for i in range(20_000)), reverse=True)
    assert found == {song: i + 1 for i, (_, song) in enumerate(order)}
    assert serving.ranking_positions(many.limit(0)).collect() == []


def test_scores_that_many_songs_share_are_ordered_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(serving, "TIED", 500)
    many = spark.range(9_000).selectExpr(
        "concat('s-', id) AS song_id", "if(id % 3 = 0, 1L, if(id % 50 = 1, 7L, id % 900)) AS play_count"
    )
    order = sorted(((r.play_count, r.song_id) for r in many.collect()), reverse=True)
    placed = {r.song_id: r.position for r in serving.ranking_positions(many).collect()}
    assert placed == {song: i + 1 for i, (_, song) in enumerate(order)}
    listed = serving.ranked_songs(many, 8_500).collect()
    assert [(r.position, r.play_count, r.song_id) for r in listed] == [
        (i + 1, *row) for i, row in enumerate(order[:8_500])
    ]


def test_places_come_from_distinct_scores(spark):
    ranked = scores(spark, ("a", 5), ("b", 9), ("c", 5), ("d", 1), ("e", 5))
    rows = serving.score_places(ranked).orderBy("first").collect()
    assert [(r.play_count, r.songs, r.first) for r in rows] == [(9, 1, 1), (5, 3, 2), (1, 1, 5)]
    assert serving.score_places(ranked.limit(0)).collect() == []


def test_no_listing_passes_through_one_task(spark):
    many = spark.range(2_000).selectExpr("concat('s-', id) AS song_id", "id % 70 AS play_count")
    for made in (serving.ranked_songs(many, 1_500), serving.top_songs_relative(many, 1_500)):
        text = made._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in text


def test_whole_ranking(spark):
    ranked = scores(spark, ("a", 5), ("b", 9), ("c", 5), ("d", 1))
    assert [r.song_id for r in serving.ranking(ranked).collect()] == ["b", "c", "a", "d"]


def test_bars_are_relative_to_the_best(spark):
    listing = serving.top_songs_relative(scores(spark, ("a", 96), ("b", 50), ("c", 1), ("d", 0)))
    assert {r.song_id: r.bar for r in listing.collect()} == {"a": 24, "b": 12, "c": 1, "d": 1}


def test_bar_rounds_half_to_even(spark):
    df = spark.createDataFrame([(p, 48) for p in range(49)], "plays bigint, top bigint")
    for row in df.select("plays", bar_length("plays", "top").alias("bar")).collect():
        assert row.bar == max(1, round(row.plays / 48 * 24))


def test_percentages_match_python_formatting(spark):
    rates = [a / b for b in range(1, 90) for a in range(0, b + 5)] + [i / 2000 for i in range(4000)]
    df = spark.createDataFrame([(r,) for r in rates], "rate double")
    for row in df.select("rate", percent_text("rate").alias("text")).collect():
        assert row.text == f"{row.rate:.1%}"


def test_slug(spark):
    df = spark.createDataFrame([("Green Kettle",), ("Old  Mill",)], "name string")
    assert [r[0] for r in df.select(song_slug("name")).collect()] == ["green-kettle", "old--mill"]
