"""The registered queries in plain SQL, written from the definitions rather than from the plans.

The replay ones follow the rules literally, with a running maximum per partition
and running sums per window, so that they check the aggregation the library uses.
"""

from __future__ import annotations

PLAY = """
raw AS (
  SELECT event_id AS seq, user_id, event_type AS action, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 144 AS ts_ms
  FROM events),
ranked AS (
  SELECT *, 9 - CAST(floor(sqrt(k)) AS BIGINT) AS sidx FROM raw),
play AS (
  SELECT CAST(seq AS VARCHAR) AS event_id,
         'user-' || user_id AS user_id,
         'song-' || sidx AS song_id,
         'song-' || k AS track_song,
         'song-' || user_id || '-' || k AS listener_song,
         CASE action WHEN 'view' THEN 'PLAY_START' WHEN 'click' THEN 'PLAY_START'
              WHEN 'purchase' THEN 'PLAY_END' WHEN 'signup' THEN 'PLAY_PROGRESS'
              WHEN 'error' THEN 'SKIP' END AS event_type,
         ts_ms,
         CAST(floor(least(value / CAST(50.0 AS DOUBLE), CAST(1.0 AS DOUBLE))
              * CAST(168000 + 20000 * sidx AS DOUBLE)) AS BIGINT) AS position_ms,
         168000 + 20000 * sidx AS duration_ms,
         CAST(seq AS BIGINT) AS seq,
         CAST(sidx % 6 AS INTEGER) AS part,
         ts_ms AS arrival_ms
  FROM ranked),
marked AS (
  SELECT *, CASE WHEN event_type = 'PLAY_START' THEN 1 ELSE 0 END AS is_start,
         CASE WHEN event_type = 'PLAY_END'
               AND position_ms >= duration_ms * CAST(0.9 AS DOUBLE) THEN 1 ELSE 0 END AS is_done
  FROM play)
"""

RATE = "CASE WHEN starts > 0 THEN CAST(completes AS DOUBLE) / starts ELSE CAST(0 AS DOUBLE) END"

STATS = f"""
stats AS (
  SELECT *, {RATE} AS completion_rate FROM (
    SELECT song_id, ts_ms // 300000 * 300000 AS window_start,
           ts_ms // 300000 * 300000 + 300000 AS window_end,
           CAST(sum(is_start) AS BIGINT) AS starts, CAST(sum(is_done) AS BIGINT) AS completes
    FROM marked GROUP BY ALL))
"""

HOURS = """
hours AS (
  SELECT song_id, ts_ms // 3600000 * 3600000 AS window_start,
         ts_ms // 3600000 * 3600000 + 3600000 AS window_end, count(*) AS play_count
  FROM marked WHERE is_start = 1 GROUP BY ALL)
"""

TOTALS = f"""
totals AS (
  SELECT *, {RATE} AS completion_rate FROM (
    SELECT song_id, CAST(sum(is_start) AS BIGINT) AS starts,
           CAST(sum(is_done) AS BIGINT) AS completes
    FROM marked GROUP BY song_id))
"""

LATEST = """
latest AS (
  SELECT song_id, window_start, window_end, starts, completes, completion_rate FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn FROM stats)
  WHERE rn = 1)
"""

SCORES = """
scores AS (
  SELECT song_id, play_count FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn FROM hours)
  WHERE rn = 1)
"""

LATE = """
shifted AS (
  SELECT * REPLACE (ts_ms - CASE seq % 10 WHEN 0 THEN 200000 WHEN 5 THEN 600000 ELSE 0 END AS ts_ms)
  FROM marked),
timed5 AS (
  SELECT *, ts_ms // 300000 * 300000 AS window_start,
         max(ts_ms) OVER (PARTITION BY part ORDER BY seq ROWS UNBOUNDED PRECEDING) AS stream_time
  FROM shifted),
timed60 AS (
  SELECT *, ts_ms // 3600000 * 3600000 AS window_start,
         max(ts_ms) OVER (PARTITION BY part ORDER BY seq ROWS UNBOUNDED PRECEDING) AS stream_time
  FROM shifted WHERE is_start = 1),
kept5 AS (SELECT * FROM timed5 WHERE window_start + 300000 + 60000 > stream_time),
kept60 AS (SELECT * FROM timed60 WHERE window_start + 3600000 + 300000 > stream_time),
log5 AS (
  SELECT *, CASE WHEN starts > 0 THEN CAST(completes AS DOUBLE) / starts
                 ELSE CAST(0 AS DOUBLE) END AS completion_rate FROM (
    SELECT seq, song_id, window_start, window_start + 300000 AS window_end,
           CAST(sum(is_start) OVER w AS BIGINT) AS starts,
           CAST(sum(is_done) OVER w AS BIGINT) AS completes
    FROM kept5
    WINDOW w AS (PARTITION BY song_id, window_start ORDER BY seq ROWS UNBOUNDED PRECEDING))),
log60 AS (
  SELECT seq, song_id, window_start, window_start + 3600000 AS window_end,
         count(*) OVER (PARTITION BY song_id, window_start ORDER BY seq
                        ROWS UNBOUNDED PRECEDING) AS play_count
  FROM kept60),
hist5 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id, window_start ORDER BY seq DESC) AS rn
    FROM log5) WHERE rn = 1),
hist60 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id, window_start ORDER BY seq DESC) AS rn
    FROM log60) WHERE rn = 1)
"""

LATE_TRACKS = LATE.replace(
    "SELECT * REPLACE (", "SELECT * REPLACE (track_song AS song_id, "
)

# The reconciled run: arrivals from 17850000 ms after the origin on, in the window that
# starts 17700000 ms after it.
EXPECTED = f"""
injected AS (
  SELECT song_id, CAST(sum(is_start) AS BIGINT) AS injected_starts,
         CAST(sum(is_done) AS BIGINT) AS injected_completes
  FROM shifted WHERE arrival_ms >= 1704085050000 GROUP BY song_id),
before5 AS (
  SELECT song_id, window_start, CAST(sum(is_start) AS BIGINT) AS baseline_starts,
         CAST(sum(is_done) AS BIGINT) AS baseline_completes,
         row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn
  FROM kept5 WHERE arrival_ms < 1704085050000 GROUP BY song_id, window_start),
held AS (SELECT * FROM before5 WHERE rn = 1 AND window_start = 1704084900000),
expected AS (
  SELECT *, {RATE} AS completion_rate FROM (
    SELECT i.song_id, injected_starts, injected_completes,
           coalesce(baseline_starts, 0) AS baseline_starts,
           coalesce(baseline_completes, 0) AS baseline_completes,
           injected_starts + coalesce(baseline_starts, 0) AS starts,
           injected_completes + coalesce(baseline_completes, 0) AS completes
    FROM injected i LEFT JOIN held h ON i.song_id = h.song_id)),
served AS (
  SELECT song_id, starts, completes, completion_rate FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn FROM hist5)
  WHERE rn = 1 AND song_id <> 'song-16'),
reconciled AS (
  SELECT e.song_id, e.baseline_starts, e.starts AS expected_starts,
         e.completes AS expected_completes, e.completion_rate AS expected_rate,
         s.starts AS actual_starts, s.completes AS actual_completes,
         s.completion_rate AS actual_rate,
         CASE WHEN s.song_id IS NULL THEN 'missing'
              WHEN s.starts = e.starts AND s.completes = e.completes THEN 'ok'
              ELSE 'mismatch' END AS status,
         CASE WHEN s.starts < e.starts THEN 'short' WHEN s.starts > e.starts THEN 'over'
              ELSE '' END AS direction
  FROM expected e LEFT JOIN served s ON e.song_id = s.song_id)
"""

CHECKED = """
hour_injected AS (
  SELECT song_id, CAST(sum(CASE WHEN arrival_ms >= 1704081900000 THEN 1 ELSE 0 END) AS BIGINT)
           AS injected_starts
  FROM shifted WHERE is_start = 1 GROUP BY song_id),
late_scores AS (
  SELECT song_id, play_count FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn FROM hist60)
  WHERE rn = 1),
checked AS (
  SELECT *, CASE WHEN play_count > injected_starts THEN 'accumulated'
                 WHEN play_count = injected_starts THEN 'ok' ELSE 'short' END AS note
  FROM (SELECT s.song_id, play_count, injected_starts
        FROM late_scores s JOIN hour_injected i ON s.song_id = i.song_id))
"""

# The streaming queries get the delayed arrivals in five slices; a window is closed for a
# slice once it ended, with its grace, by the newest event of the slices before.
SLICED = """
numbered AS (SELECT *, (SELECT max(seq) + 1 FROM shifted) AS n FROM shifted),
sliced AS (
  SELECT *, CASE WHEN seq < n * 1 // 5 THEN 0 WHEN seq < n * 2 // 5 THEN 1
                 WHEN seq < n * 3 // 5 THEN 2 WHEN seq < n * 4 // 5 THEN 3 ELSE 4 END AS slice
  FROM numbered),
taken5 AS (
  SELECT s.* FROM sliced s LEFT JOIN
    (SELECT o.slice, max(i.ts_ms) AS newest
     FROM (SELECT DISTINCT slice FROM sliced) o JOIN sliced i ON i.slice < o.slice GROUP BY o.slice) b
    ON s.slice = b.slice
  WHERE newest IS NULL OR ts_ms // 300000 * 300000 + 300000 + 60000 > newest),
taken60 AS (
  SELECT s.* FROM sliced s LEFT JOIN
    (SELECT o.slice, max(i.ts_ms) AS newest
     FROM (SELECT DISTINCT slice FROM sliced) o JOIN sliced i ON i.slice < o.slice
     WHERE i.is_start = 1 GROUP BY o.slice) b
    ON s.slice = b.slice
  WHERE is_start = 1
    AND (newest IS NULL OR ts_ms // 3600000 * 3600000 + 3600000 + 300000 > newest))
"""

CROWDED = """
all_plays AS (
  SELECT song_id, ts_ms FROM marked WHERE is_start = 1
  UNION ALL SELECT listener_song, ts_ms FROM marked WHERE is_start = 1),
crowded AS (
  SELECT song_id, play_count FROM (
    SELECT song_id, ts_ms // 3600000 AS h, count(*) AS play_count,
           row_number() OVER (PARTITION BY song_id ORDER BY ts_ms // 3600000 DESC) AS rn
    FROM all_plays GROUP BY song_id, ts_ms // 3600000)
  WHERE rn = 1)
"""

STREAM_STATS = STATS.replace("FROM marked", "FROM taken5")
STREAM_HOURS = HOURS.replace("FROM marked", "FROM taken60")

# Bars: rounded half to even, at least one.
BAR = """greatest(1, CAST(round_even(
    play_count / CAST(greatest(max(play_count) OVER (), 1) AS DOUBLE) * 24, 0) AS BIGINT))"""

RANKED = """
  SELECT row_number() OVER (ORDER BY play_count DESC, song_id DESC) AS position, song_id, play_count
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(part.strip() for part in parts) + "\n"


def _rate_sql(rows: str, series: str) -> str:
    return f"""
  SELECT {series}, (arrival_ms // 15000) * 15000 - o.i * 15000 AS window_start,
         count(*) / CAST(60 AS DOUBLE) AS per_second
  FROM {rows} CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS i) o
  GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "play_events": _with(PLAY)
    + """SELECT event_id, user_id, song_id, event_type, ts_ms, position_ms, duration_ms, seq, part,
         ts_ms AS event_time_ms FROM play""",
    "decode_events": _with(PLAY)
    + """SELECT seq, reason AS reject_reason,
         CASE WHEN reason = '' THEN event_id END AS event_id,
         CASE WHEN reason = '' THEN user_id END AS user_id,
         CASE WHEN reason = '' THEN song_id END AS song_id,
         CASE WHEN reason = '' THEN event_type END AS event_type,
         CASE WHEN reason = '' THEN ts_ms END AS ts_ms,
         CASE WHEN reason = '' THEN position_ms END AS position_ms,
         CASE WHEN reason = '' THEN duration_ms END AS duration_ms
       FROM (SELECT *, CASE seq % 50 WHEN 7 THEN 'broken_json' WHEN 17 THEN 'unknown_type'
                    WHEN 27 THEN 'missing_field' WHEN 37 THEN 'missing_field' ELSE '' END AS reason
             FROM play)""",
    "rejected_messages": _with(PLAY)
    + """, texts AS (
           SELECT seq, '{"eventId":"' || event_id || '","userId":"' || user_id || '","songId":"'
             || song_id || '","eventType":"' || event_type || '","timestamp":' || ts_ms
             || ',"positionMs":' || position_ms || ',"durationMs":' || duration_ms || '}' AS t
           FROM play)
         SELECT CASE seq % 50 WHEN 7 THEN substr(t, 1, 40)
                  WHEN 17 THEN replace(t, '"eventType":"', '"eventType":"X_')
                  WHEN 27 THEN replace(t, '"userId"', '"listener"')
                  ELSE replace(t, '"positionMs"', '"offsetMs"') END AS value,
                CASE seq % 50 WHEN 7 THEN 'broken_json' WHEN 17 THEN 'unknown_type'
                  ELSE 'missing_field' END AS reject_reason
         FROM texts WHERE seq % 50 IN (7, 17, 27, 37)""",
    "play_starts": _with(PLAY)
    + "SELECT seq, song_id, event_type, ts_ms FROM play WHERE event_type = 'PLAY_START'",
    "completed_plays": _with(PLAY)
    + """SELECT seq, song_id, event_type, ts_ms, position_ms, duration_ms
       FROM marked WHERE is_done = 1""",
    "window_remaining": _with(PLAY)
    + """SELECT seq, ts_ms // 300000 * 300000 AS window_start,
         300000 - ts_ms % 300000 AS remaining_ms FROM play""",
    "song_slug": "SELECT p_partkey, replace(lower(p_name), ' ', '-') AS slug FROM part",
    "completion_stats": _with(PLAY, STATS) + "SELECT * FROM stats",
    "completion_stats_many_songs": _with(
        PLAY, STATS.replace("song_id, ts_ms", "listener_song AS song_id, ts_ms")
    )
    + "SELECT * FROM stats",
    "hourly_counts": _with(PLAY, HOURS) + "SELECT * FROM hours",
    "events_by_type": _with(PLAY)
    + "SELECT event_type, count(*) AS events FROM play GROUP BY event_type",
    "song_totals": _with(PLAY, TOTALS) + "SELECT * FROM totals",
    "partition_spread": _with(PLAY)
    + """SELECT part, count(*) AS events, count(DISTINCT song_id) AS songs
       FROM play GROUP BY part""",
    "latest_completion": _with(PLAY, STATS, LATEST) + "SELECT * FROM latest",
    "song_scores": _with(PLAY, HOURS, SCORES) + "SELECT * FROM scores",
    "top_songs": _with(PLAY, HOURS, SCORES)
    + RANKED
    + "FROM scores ORDER BY play_count DESC, song_id DESC LIMIT 10",
    "ranking_positions": _with(
        PLAY, HOURS.replace("SELECT song_id", "SELECT listener_song AS song_id"), SCORES
    )
    + RANKED
    + "FROM scores",
    "top_songs_relative": _with(PLAY, HOURS, SCORES)
    + RANKED.rstrip()
    + f", {BAR} AS bar FROM (SELECT * FROM scores ORDER BY play_count DESC, song_id DESC LIMIT 12)",
    "completion_lookup": _with(PLAY, STATS, LATEST)
    + "SELECT * FROM latest WHERE song_id = 'song-0'",
    "completion_json": _with(PLAY, STATS, LATEST)
    + """SELECT 'completion:' || song_id AS key,
         '{"songId":"' || song_id || '","windowStart":' || window_start || ',"windowEnd":'
         || window_end || ',"starts":' || starts || ',"completes":' || completes
         || ',"completionRate":' || CAST(completion_rate AS VARCHAR) || '}' AS value,
         * FROM latest""",
    "completion_history": _with(PLAY, STATS)
    + """SELECT * FROM stats WHERE song_id = 'song-0'
         AND window_start >= 1704081600000 AND window_start < 1704085200000""",
    "play_history": _with(PLAY, HOURS)
    + """SELECT * FROM hours WHERE song_id = 'song-0'
         AND window_start >= 1703998800000 AND window_start < 1704085200000""",
    "late_events": _with(PLAY, LATE)
    + """SELECT 'completion_rate' AS metric, seq, part, song_id, ts_ms, window_start
       FROM timed5 WHERE window_start + 300000 + 60000 <= stream_time
       UNION ALL
       SELECT 'top_songs', seq, part, song_id, ts_ms, window_start
       FROM timed60 WHERE window_start + 3600000 + 300000 <= stream_time""",
    "completion_changelog": _with(PLAY, LATE) + "SELECT * FROM log5",
    "hourly_changelog": _with(PLAY, LATE) + "SELECT * FROM log60",
    "completion_history_upsert": _with(PLAY, LATE) + "SELECT * EXCLUDE (seq) FROM hist5",
    "hourly_history_upsert": _with(PLAY, LATE) + "SELECT * EXCLUDE (seq) FROM hist60",
    "latest_completion_replayed": _with(PLAY, LATE)
    + """SELECT * EXCLUDE (seq, rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn
         FROM hist5) WHERE rn = 1""",
    "latest_completion_by_arrival": _with(PLAY, LATE)
    + """SELECT * EXCLUDE (seq, rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY seq DESC) AS rn
         FROM log5) WHERE rn = 1""",
    "latest_tracks_replayed": _with(PLAY, LATE_TRACKS)
    + """SELECT * EXCLUDE (seq, rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn
         FROM hist5) WHERE rn = 1""",
    "latest_tracks_by_arrival": _with(PLAY, LATE_TRACKS)
    + """SELECT * EXCLUDE (seq, rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY seq DESC) AS rn
         FROM log5) WHERE rn = 1""",
    "song_scores_by_arrival": _with(PLAY, LATE)
    + """SELECT song_id, play_count FROM (
         SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY seq DESC) AS rn
         FROM log60) WHERE rn = 1""",
    "consumed_completion_history": _with(PLAY, LATE) + "SELECT * EXCLUDE (seq) FROM hist5",
    "consumed_hourly_history": _with(PLAY, LATE) + "SELECT * EXCLUDE (seq) FROM hist60",
    "stored_completion_history": _with(PLAY, LATE)
    + """SELECT * EXCLUDE (seq) FROM hist5 WHERE song_id = 'song-0'
         AND window_start >= 1704081600000 AND window_start < 1704085200000""",
    "stored_play_history": _with(PLAY, LATE)
    + """SELECT * EXCLUDE (seq) FROM hist60 WHERE song_id = 'song-0'
         AND window_start >= 1703998800000 AND window_start < 1704085200000""",
    "rebuild_read_model": _with(PLAY, LATE)
    + """, l AS (SELECT * EXCLUDE (seq, rn) FROM (
           SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn
           FROM hist5) WHERE rn = 1),
         s AS (SELECT song_id, play_count FROM (
           SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY window_start DESC) AS rn
           FROM hist60) WHERE rn = 1)
         SELECT coalesce(l.song_id, s.song_id) AS song_id, window_start, window_end, starts,
                completes, completion_rate, play_count
         FROM l FULL JOIN s ON l.song_id = s.song_id""",
    "windows_emitted": _with(PLAY, LATE)
    + """SELECT 'completion_rate' AS metric, count(*) AS updates FROM log5
       UNION ALL SELECT 'top_songs', count(*) FROM log60""",
    "ingest_rate": _with(PLAY) + _rate_sql("play", "event_type"),
    "peak_ingest_rate": _with(PLAY)
    + """, t AS (
           SELECT (arrival_ms // 15000) * 15000 - o.i * 15000 AS window_start, count(*) AS n
           FROM play CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS i) o GROUP BY ALL)
         SELECT max(n) / CAST(60 AS DOUBLE) AS peak_per_second FROM t""",
    "emit_rate": _with(PLAY, LATE)
    + """, u AS (SELECT 'completion_rate' AS metric, arrival_ms FROM kept5
                UNION ALL SELECT 'top_songs', arrival_ms FROM kept60)"""
    + _rate_sql("u", "metric"),
    "expected_with_baseline": _with(PLAY, LATE_TRACKS, EXPECTED) + "SELECT * FROM expected",
    "reconcile": _with(PLAY, LATE_TRACKS, EXPECTED) + "SELECT * FROM reconciled",
    "completion_report": _with(PLAY, LATE_TRACKS, EXPECTED)
    + """SELECT song_id, actual_starts, actual_completes,
         CASE WHEN actual_rate IS NOT NULL
              THEN printf('%.1f%%', actual_rate * CAST(100 AS DOUBLE)) END AS actual_percent,
         printf('%.1f%%', expected_rate * CAST(100 AS DOUBLE)) AS expected_percent, status
       FROM reconciled""",
    "reconcile_summary": _with(PLAY, LATE_TRACKS, EXPECTED)
    + """SELECT count(*) AS songs,
         count(*) FILTER (status = 'ok') AS matched,
         count(*) FILTER (status = 'missing') AS missing,
         count(*) FILTER (status = 'mismatch') AS mismatched,
         count(*) FILTER (direction = 'short') AS short,
         count(*) FILTER (direction = 'over') AS "over",
         count(*) FILTER (status <> 'missing' AND expected_starts < 20) AS excluded,
         CAST(sum(baseline_starts) AS BIGINT) AS carried_over_starts,
         count(*) FILTER (status <> 'ok') = 0 AS passed
       FROM reconciled""",
    "ranking_expected": _with(PLAY, CROWDED)
    + "SELECT * FROM crowded WHERE song_id IN (SELECT song_id FROM marked)",
    "ranking_leftover": _with(PLAY, CROWDED)
    + "SELECT * FROM crowded WHERE song_id NOT IN (SELECT song_id FROM marked)",
    "ranking_check": _with(PLAY, LATE_TRACKS, CHECKED) + "SELECT * FROM checked",
    "ranking_report": _with(PLAY, LATE_TRACKS, CHECKED)
    + RANKED.rstrip()
    + f""", injected_starts, {BAR} AS bar, note
       FROM (SELECT * FROM checked ORDER BY play_count DESC, song_id DESC LIMIT 12)""",
    "completion_extremes": _with(PLAY, HOURS, SCORES, TOTALS)
    + """, enough AS (SELECT * FROM totals WHERE starts >= 100),
         hot AS (SELECT * FROM scores ORDER BY play_count DESC, song_id DESC LIMIT 1),
         best AS (SELECT * FROM enough ORDER BY completion_rate DESC, starts DESC, song_id LIMIT 1),
         worst AS (SELECT * FROM enough ORDER BY completion_rate, starts DESC, song_id LIMIT 1)
         SELECT hot.song_id AS most_played, hot.play_count AS most_played_plays,
                best.song_id AS best_song, best.completion_rate AS best_rate,
                best.starts AS best_plays, worst.song_id AS worst_song,
                worst.completion_rate AS worst_rate, worst.starts AS worst_plays,
                (SELECT count(*) FROM totals WHERE starts < 100) AS excluded,
                hot.song_id = best.song_id AS same_song
         FROM hot, best, worst""",
    "stream_completion_history": _with(PLAY, LATE, SLICED, STREAM_STATS) + "SELECT * FROM stats",
    "stream_latest_completion": _with(PLAY, LATE, SLICED, STREAM_STATS, LATEST)
    + "SELECT * FROM latest",
    "stream_hourly_history": _with(PLAY, LATE, SLICED, STREAM_HOURS) + "SELECT * FROM hours",
    "stream_top_songs": _with(PLAY, LATE, SLICED, STREAM_HOURS, SCORES)
    + RANKED
    + "FROM scores ORDER BY play_count DESC, song_id DESC LIMIT 10",
    "stream_late_events": _with(PLAY, LATE, SLICED)
    + """SELECT 'completion_rate' AS metric, CAST((SELECT sum(is_start) FROM marked)
           - (SELECT sum(is_start) FROM taken5) AS BIGINT) AS late_starts
       UNION ALL SELECT 'top_songs', CAST((SELECT sum(is_start) FROM marked)
           - (SELECT count(*) FROM taken60) AS BIGINT)""",
    "stream_open_windows": _with(PLAY, LATE, SLICED, STREAM_STATS)
    + """SELECT * FROM stats
         WHERE window_end + 60000 > (SELECT max(ts_ms) FROM sliced)""",
    "stream_ingest_rate": _with(PLAY) + _rate_sql("play", "event_type"),
    "stream_peak_ingest_rate": _with(PLAY)
    + """, t AS (
           SELECT (arrival_ms // 15000) * 15000 - o.i * 15000 AS window_start, count(*) AS n
           FROM play CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS i) o GROUP BY ALL)
         SELECT max(n) / CAST(60 AS DOUBLE) AS peak_per_second FROM t""",
    "stream_batch_metrics": _with(PLAY, LATE, SLICED)
    + """, per_slice AS (
         SELECT slice, CAST(sum(is_start) AS BIGINT) AS starts FROM sliced GROUP BY slice),
       kept AS (
         SELECT 'completion_rate' AS metric, slice, CAST(sum(is_start) AS BIGINT) AS added,
                count(DISTINCT (song_id, ts_ms // 300000)) AS emitted
         FROM taken5 GROUP BY slice
         UNION ALL
         SELECT 'top_songs', slice, count(*), count(DISTINCT (song_id, ts_ms // 3600000))
         FROM taken60 GROUP BY slice)
       SELECT metric, CAST(p.slice AS BIGINT) AS slice, starts, coalesce(added, 0) AS added,
              starts - coalesce(added, 0) AS late_starts, coalesce(emitted, 0) AS emitted
       FROM per_slice p CROSS JOIN (SELECT DISTINCT metric FROM kept) m
       LEFT JOIN kept k USING (metric, slice)""",
    "exact_stream_latest_by_arrival": _with(PLAY, LATE)
    + """SELECT * EXCLUDE (seq, rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY seq DESC) AS rn
         FROM log5) WHERE rn = 1""",
    "exact_stream_scores_by_arrival": _with(PLAY, LATE)
    + """SELECT song_id, play_count FROM (
         SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY seq DESC) AS rn
         FROM log60) WHERE rn = 1""",
    "exact_stream_completion_history": _with(PLAY, LATE) + "SELECT * EXCLUDE (seq) FROM hist5",
    "exact_stream_hourly_history": _with(PLAY, LATE) + "SELECT * EXCLUDE (seq) FROM hist60",
    "published_spread": _with(PLAY)
    + """SELECT song_id, CAST(1 AS BIGINT) AS partitions, count(*) AS events,
         CAST(sum(is_start) AS BIGINT) AS starts FROM marked GROUP BY song_id""",
}
