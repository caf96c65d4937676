"""Event fixtures and row-by-row restatements of the rules, for comparison."""

from __future__ import annotations

import json
import random
from collections import defaultdict

from spintally.functions.times import event_time
from spintally.schema import PLAY_EVENT_FIELDS

BASE = 1717600000000
ALIGNED = 1717599900000
FIVE_MIN = 300_000
HOUR = 3_600_000

#: Songs of the play fixtures: id, seconds, and plays of every eight.
SONGS = (("track-1", 240, 5), ("track-2", 180, 2), ("track-3", 300, 1))

#: How plays end, in turn: to the end, at exactly nine tenths, just short of that, early on,
#: by a skip, and not at all. Each is the type of one event and the share reached.
ENDINGS = (
    ("PLAY_END", 1.0),
    ("PLAY_END", 0.9),
    ("PLAY_END", 0.8999),
    ("PLAY_END", 0.1),
    ("SKIP", 0.25),
    ("PLAY_PROGRESS", 0.5),
)

SCHEMA = (
    "event_id string, user_id string, song_id string, event_type string, "
    "ts_ms bigint, position_ms bigint, duration_ms bigint, seq bigint, part int"
)


def event(song, kind, ts_ms, position_ms=0, duration_ms=240_000, part=0, event_id=None, user="u1"):
    return {
        "event_id": event_id,
        "user_id": user,
        "song_id": song,
        "event_type": kind,
        "ts_ms": ts_ms,
        "position_ms": position_ms,
        "duration_ms": duration_ms,
        "part": part,
    }


def numbered(events):
    """Events in arrival order get their number, and an id where they have none."""
    return [{**e, "seq": i, "event_id": e["event_id"] or f"e-{i}"} for i, e in enumerate(events)]


def table(spark, events):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    rows = [tuple(e[n] for n in names) for e in numbered(events)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("arrival_ms", df.ts_ms).withColumn("ts", event_time())


def wire_text(e):
    return json.dumps({name: e[column] for name, column, _ in PLAY_EVENT_FIELDS})


def ten_and_eight(base=BASE):
    starts = [event("song-A", "PLAY_START", base + i * 1000) for i in range(10)]
    ends = [event("song-A", "PLAY_END", base + i * 1000, 230_000) for i in range(8)]
    return starts + ends


def late_arrivals(base):
    offsets = (0, 330_000, 30_000, 600_000, 40_000)
    return [event("song-E", "PLAY_START", base + o) for o in offsets]


def sessions(count, seed, base_ts=ALIGNED, spread_ms=30_000):
    """Plays of few songs, one of them most of all, each a start and one later event."""
    rng = random.Random(seed)
    turns = [(song, seconds) for song, seconds, share in SONGS for _ in range(share)]
    out = []
    for number in range(count):
        song, seconds = turns[number % len(turns)]
        kind, share = ENDINGS[number % len(ENDINGS)]
        at, length = base_ts + rng.randrange(spread_ms), seconds * 1000
        out.append(event(song, "PLAY_START", at, 0, length))
        out.append(event(song, kind, at + 1 + rng.randrange(5), int(length * share), length))
    return out


def is_done(e):
    return e["event_type"] == "PLAY_END" and e["position_ms"] >= e["duration_ms"] * 0.9


def replay(events, size, grace, starts_only=False):
    """Row by row: (kept, dropped, log), the log holding running starts and completes."""
    stream_time, counts = {}, defaultdict(lambda: [0, 0])
    kept, dropped, log = [], [], []
    for e in numbered(events):
        if starts_only and e["event_type"] != "PLAY_START":
            continue
        now = stream_time[e["part"]] = max(stream_time.get(e["part"], e["ts_ms"]), e["ts_ms"])
        start = e["ts_ms"] // size * size
        if start + size + grace <= now:
            dropped.append(e["seq"])
            continue
        kept.append(e["seq"])
        cell = counts[e["song_id"], start]
        cell[0] += e["event_type"] == "PLAY_START"
        cell[1] += is_done(e)
        log.append((e["seq"], e["song_id"], start, *cell))
    return kept, dropped, log


def totals(events, size):
    """(song, window) -> (starts, completes) without any late rule."""
    counts = defaultdict(lambda: [0, 0])
    for e in events:
        cell = counts[e["song_id"], e["ts_ms"] // size * size]
        cell[0] += e["event_type"] == "PLAY_START"
        cell[1] += is_done(e)
    return {key: tuple(cell) for key, cell in counts.items()}
