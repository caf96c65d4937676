"""What counts as a start, a completed play, and their ratio."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spintally.schema import COMPLETED_SHARE, PLAY_END, PLAY_START


def is_start() -> Column:
    return F.col("event_type") == PLAY_START


def is_completed_play() -> Column:
    """An end event at or past the completion share of the track, compared as doubles."""
    reached = F.col("position_ms") >= F.col("duration_ms") * F.lit(COMPLETED_SHARE)
    return (F.col("event_type") == PLAY_END) & reached


def completion_rate(starts: str = "starts", completes: str = "completes") -> Column:
    """Completes per start, 0.0 without starts; may exceed 1 when a play crosses windows."""
    ratio = F.col(completes).cast("double") / F.col(starts)
    return F.when(F.col(starts) > 0, ratio).otherwise(F.lit(0.0))
