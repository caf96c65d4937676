import json

import pytest
from cases import BASE, event, numbered, table, wire_text

from spintally.schema import COMPLETION_FIELDS, HOURLY_FIELDS, PLAY_EVENT_FIELDS
from spintally.sources import streams, wire


def decoded(spark, *texts):
    return wire.decode_play_events(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_one_event_becomes_one_keyed_message(spark):
    sent = event("song-X", "PLAY_START", 0, 0, 240_000, event_id="test-1")
    (row,) = wire.encode(table(spark, [sent]), PLAY_EVENT_FIELDS).collect()
    assert row.key == "song-X"
    assert row.value == json.dumps(
        {
            "eventId": "test-1",
            "userId": "u1",
            "songId": "song-X",
            "eventType": "PLAY_START",
            "timestamp": 0,
            "positionMs": 0,
            "durationMs": 240000,
        },
        separators=(",", ":"),
    )


def test_round_trip(spark):
    events = [event("a", k, BASE + i) for i, k in enumerate(("PLAY_START", "PLAY_PROGRESS", "PLAY_END", "SKIP"))]
    texts = [wire_text(e) for e in numbered(events)]
    valid = wire.valid_events(decoded(spark, *texts)).orderBy("ts_ms").collect()
    assert [r.event_type for r in valid] == [e["event_type"] for e in events]
    assert [r.ts.timestamp() * 1000 for r in valid[:1]] == [BASE]


def good(**changes):
    record = {
        "eventId": "e",
        "userId": "u",
        "songId": "s",
        "eventType": "SKIP",
        "timestamp": BASE,
        "positionMs": 1,
        "durationMs": 2,
    }
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v != "drop"})


@pytest.mark.parametrize(
    "text,reason",
    [
        (good(), None),
        (good(extra="ignored"), None),
        (good(eventType="PAUSE"), wire.UNKNOWN_TYPE),
        (good(songId=None), wire.MISSING_FIELD),
        (good(userId="drop"), wire.MISSING_FIELD),
        (good(timestamp="drop"), wire.MISSING_FIELD),
        (good(timestamp="soon"), wire.BROKEN_JSON),
        (good()[:30], wire.BROKEN_JSON),
        ("not json", wire.BROKEN_JSON),
        ("", wire.BROKEN_JSON),
        (None, wire.BROKEN_JSON),
    ],
)
def test_validity(spark, text, reason):
    rows = decoded(spark, text, good(eventId="marker"))
    assert [r.reject_reason for r in rows.filter("event_id <> 'marker' OR event_id IS NULL").collect()] == [reason]
    assert wire.quarantine(rows).count() == (reason is not None)
    assert wire.valid_events(rows).count() == 1 + (reason is None)


def test_absent_numbers_may_count_as_zero(spark):
    texts = [good(positionMs="drop"), good(durationMs=None), good(userId="drop"), good()[:30]]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = wire.decode_play_events(messages, zero_for_absent=True).collect()
    assert [r.reject_reason for r in rows] == [None, None, wire.MISSING_FIELD, wire.BROKEN_JSON]
    assert (rows[0].position_ms, rows[0].duration_ms) == (0, 2)
    assert (rows[1].position_ms, rows[1].duration_ms) == (1, 0)


def sent_and_read(records, fields):
    decoded = wire.decode(wire.encode(records, fields).select("value"), fields)
    return wire.valid_records(decoded).collect()


def test_unusable_result_records_are_told_apart(spark):
    texts = ["not json", '{"songId":"a"}', "", None, "  ", "{}", "[]", '"x"', "null"]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = wire.decode(messages, COMPLETION_FIELDS).collect()
    assert len(rows) == len(texts) and all(r.reject_reason for r in rows)
    assert [r.reject_reason for r in rows[:6]] == [
        wire.BROKEN_JSON, wire.MISSING_FIELD, wire.BROKEN_JSON,
        wire.BROKEN_JSON, wire.BROKEN_JSON, wire.MISSING_FIELD,
    ]


def test_result_records_round_trip(spark):
    stats = spark.createDataFrame(
        [("s", BASE, BASE + 1, 3, 1, 1 / 3)],
        "song_id string, window_start bigint, window_end bigint, starts bigint, completes bigint, completion_rate double",
    )
    assert sent_and_read(stats, COMPLETION_FIELDS) == stats.collect()
    counts = spark.createDataFrame(
        [("s", BASE, BASE + 1, 3)],
        "song_id string, window_start bigint, window_end bigint, play_count bigint",
    )
    (message,) = wire.encode(counts, HOURLY_FIELDS).collect()
    assert json.loads(message.value)["count"] == 3
    assert sent_and_read(counts, HOURLY_FIELDS) == counts.collect()
    assert [f[1] for f in COMPLETION_FIELDS] == stats.columns
    assert [f[1] for f in HOURLY_FIELDS] == counts.columns


def test_topic_options():
    assert streams.kafka_source_options("host:1", "play-events", 10) == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "play-events",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }
    assert streams.kafka_sink_options("host:1", "play-events") == {
        "kafka.bootstrap.servers": "host:1",
        "topic": "play-events",
    }
