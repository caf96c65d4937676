"""Comparison of served results with independently counted totals.

All joins are equi-joins of tables with one row per song, so no key can be hot;
the join strategy is left to the measured sizes at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.functions.plays import completion_rate
from spintally.functions.text import bar_length, percent_text
from spintally.operators.serving import ranked_relative
from spintally.schema import REPORT_MIN_PLAYS, REPORT_TOP_N

OK = "ok"
MISSING = "missing"
MISMATCH = "mismatch"
SHORT = "short"
OVER = "over"
ACCUMULATED = "accumulated"


def expected_totals(injected: DataFrame, latest: DataFrame, window_start: int) -> DataFrame:
    """Injected counts plus what the target window already held.

    ``injected`` has ``song_id, starts, completes``. The latest record of a song
    counts only if it belongs to the target window.
    """
    baseline = latest.filter(F.col("window_start") == window_start).select(
        "song_id",
        F.col("starts").alias("baseline_starts"),
        F.col("completes").alias("baseline_completes"),
    )
    held = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("baseline_starts", "baseline_completes")}
    return (
        injected.select(
            "song_id",
            F.col("starts").alias("injected_starts"),
            F.col("completes").alias("injected_completes"),
        )
        .join(baseline, "song_id", "left")
        .withColumns(held)
        .withColumn("starts", F.col("injected_starts") + F.col("baseline_starts"))
        .withColumn("completes", F.col("injected_completes") + F.col("baseline_completes"))
        .withColumn("completion_rate", completion_rate())
    )


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected against served counts, one row per expected song, most played first."""
    wanted = expected.select(
        "song_id",
        "baseline_starts",
        F.col("starts").alias("expected_starts"),
        F.col("completes").alias("expected_completes"),
        F.col("completion_rate").alias("expected_rate"),
    )
    served = actual.select(
        "song_id",
        F.col("starts").alias("actual_starts"),
        F.col("completes").alias("actual_completes"),
        F.col("completion_rate").alias("actual_rate"),
    )
    same = (F.col("actual_starts") == F.col("expected_starts")) & (
        F.col("actual_completes") == F.col("expected_completes")
    )
    status = F.when(F.col("actual_starts").isNull(), MISSING).when(same, OK).otherwise(MISMATCH)
    direction = F.when(F.col("actual_starts") < F.col("expected_starts"), SHORT).when(
        F.col("actual_starts") > F.col("expected_starts"), OVER
    )
    return (
        wanted.join(served, "song_id", "left")
        .withColumn("status", status)
        .withColumn("direction", direction)
        .orderBy(F.desc("expected_starts"), "song_id")
    )


def completion_report(reconciled: DataFrame) -> DataFrame:
    """The reconciliation as shown to a reader, with rates as percentages."""
    return reconciled.select(
        "song_id",
        "actual_starts",
        "actual_completes",
        percent_text("actual_rate").alias("actual_percent"),
        percent_text("expected_rate").alias("expected_percent"),
        "status",
    )


def reconcile_summary(reconciled: DataFrame, min_plays: int = REPORT_MIN_PLAYS) -> DataFrame:
    """Counts over the reconciliation, the carried-over plays, and the verdict."""
    served = F.col("status") != MISSING
    return reconciled.agg(
        F.count("*").alias("songs"),
        F.count_if(F.col("status") == OK).alias("matched"),
        F.count_if(F.col("status") == MISSING).alias("missing"),
        F.count_if(F.col("status") == MISMATCH).alias("mismatched"),
        F.count_if(F.col("direction") == SHORT).alias("short"),
        F.count_if(F.col("direction") == OVER).alias("over"),
        F.count_if(served & (F.col("expected_starts") < min_plays)).alias("excluded"),
        F.sum("baseline_starts").alias("carried_over_starts"),
    ).withColumn("passed", (F.col("missing") + F.col("mismatched")) == 0)


def ranking_expected(ranking: DataFrame, expected: DataFrame) -> DataFrame:
    """Ranking entries of expected songs."""
    return ranking.join(expected.select("song_id"), "song_id", "left_semi")


def ranking_leftover(ranking: DataFrame, expected: DataFrame) -> DataFrame:
    """Ranking entries nobody expects: the ranking is never trimmed."""
    return ranking.join(expected.select("song_id"), "song_id", "left_anti")


def ranking_check(ranking: DataFrame, injected: DataFrame) -> DataFrame:
    """Ranked plays against injected starts; more than injected means earlier runs this hour."""
    plays = injected.select("song_id", F.col("starts").alias("injected_starts"))
    note = (
        F.when(F.col("play_count") > F.col("injected_starts"), ACCUMULATED)
        .when(F.col("play_count") == F.col("injected_starts"), OK)
        .otherwise(SHORT)
    )
    return ranking.join(plays, "song_id").withColumn("note", note)


def ranking_report(ranking: DataFrame, injected: DataFrame, n: int = REPORT_TOP_N) -> DataFrame:
    """The best expected songs with position, bar and check, as shown to a reader.

    The bar is relative to the best expected song.
    """
    checked = ranked_relative(ranking_check(ranking, injected), n)
    return checked.select("position", "song_id", "play_count", "injected_starts", "bar", "note")


def completion_extremes(
    reconciled: DataFrame, ranking: DataFrame, min_plays: int = REPORT_MIN_PLAYS
) -> DataFrame:
    """Most played song, and the best and worst completion among songs with enough plays.

    Equal rates go to the song with more expected starts, as listed first in the
    report, and then to the smaller id. No row if no song qualifies.
    """
    served = F.col("actual_starts").isNotNull()
    enough = served & (F.col("expected_starts") >= min_plays)
    listed = [
        (-F.col("expected_starts")).alias("plays"),
        F.col("song_id"),
        F.col("actual_rate").alias("rate"),
    ]
    highest_first = F.struct((-F.col("actual_rate")).alias("order"), *listed)
    lowest_first = F.struct(F.col("actual_rate").alias("order"), *listed)
    ranked = F.when(F.col("play_count").isNotNull(), F.struct("play_count", "song_id"))
    return (
        reconciled.join(ranking.select("song_id", "play_count"), "song_id", "left")
        .agg(
            F.max(ranked).alias("top"),
            F.min(F.when(enough, highest_first)).alias("best"),
            F.min(F.when(enough, lowest_first)).alias("worst"),
            F.count_if(served & ~enough).alias("excluded"),
        )
        .filter(F.col("top").isNotNull() & F.col("best").isNotNull())
        .select(
            F.col("top.song_id").alias("most_played"),
            F.col("top.play_count").alias("most_played_plays"),
            F.col("best.song_id").alias("best_song"),
            F.col("best.rate").alias("best_rate"),
            (-F.col("best.plays")).alias("best_plays"),
            F.col("worst.song_id").alias("worst_song"),
            F.col("worst.rate").alias("worst_rate"),
            (-F.col("worst.plays")).alias("worst_plays"),
            "excluded",
            (F.col("top.song_id") == F.col("best.song_id")).alias("same_song"),
        )
    )
