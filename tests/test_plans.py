"""The physical plans hold what the scale claims rest on."""

import pytest

from spintally.operators import aggregates, serving
from spintally.operators import replay as rp
from spintally.plans.catalog import QUERIES
from spintally.sources import tables, wire

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_columns(text):
    schemas = [part.split("ReadSchema: struct<")[1].split(">")[0] for part in text.split("FileScan")[1:]]
    return [sorted(c.split(":")[0] for c in s.split(",")) for s in schemas]


def test_scans_read_only_needed_columns(spark):
    assert scan_columns(plan(QUERIES["events_by_type"](spark, SF))) == [["event_type"]]
    assert scan_columns(plan(QUERIES["ingest_rate"](spark, SF))) == [["event_type", "ts"]]
    assert scan_columns(plan(QUERIES["hourly_counts"](spark, SF))) == [["event_type", "props", "ts"]]


# A listing starts from stored scores, so the events are read once; the scores' plan is the one to ask.
@pytest.mark.parametrize("name", ["play_starts", "hourly_counts", "song_scores", "completed_plays"])
def test_event_type_reaches_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    pushed = text.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "event_type" in pushed


@pytest.mark.parametrize("name", ["completion_stats", "hourly_counts", "song_totals", "ingest_rate"])
def test_aggregates_shrink_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "partial_" in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_one_shuffle_per_windowed_aggregate(spark):
    events = tables.load_play_events(spark, SF)
    assert plan(aggregates.completion_stats(events)).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["latest_completion", "song_scores", "completion_history_upsert"])
def test_latest_values_need_no_sort(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Sort" not in text and "Window" not in text


def test_top_songs_keep_only_the_best_per_task(spark):
    text = plan(serving.top_songs(QUERIES["song_scores"](spark, SF)))
    assert "TakeOrderedAndProject" in text


def test_late_rule_scans_without_shuffling_events(spark):
    events = tables.delayed(tables.load_play_events(spark, SF))
    text = plan(rp.completion_arrivals(events))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("name", ["completion_changelog", "hourly_changelog"])
def test_changelog_moves_events_once_and_joins_nothing_back(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("Exchange hashpartitioning(song_id") == 1
    assert text.count("Exchange") == 1 + text.count("BroadcastExchange") == 2  # of closing arrivals
    assert text.count("Join") == 1


@pytest.mark.parametrize("name", ["completion_history", "play_history"])
def test_time_range_reaches_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    pushed = text.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed


def test_a_message_is_parsed_once(spark, tmp_path):
    QUERIES["rejected_messages"](spark, SF).select("value").write.parquet(f"{tmp_path}/messages")
    messages = spark.read.parquet(f"{tmp_path}/messages")
    decoded = wire.decode_play_events(messages)
    for made in (wire.valid_events(decoded), wire.quarantine(decoded)):
        optimized = made._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("from_json") == 1


def test_sliding_rate_spreads_counts_not_rows(spark):
    text = plan(QUERIES["ingest_rate"](spark, SF))
    assert text.index("Expand") < text.index("partial_count")


# The streams have run by the time their answer is returned; it is a scan of what was kept.
PLANNED = sorted(name for name in QUERIES if "stream_" not in name)


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert banned not in text
