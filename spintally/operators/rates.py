"""Per-second rates over a sliding minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.functions.times import floor_to_window
from spintally.schema import RATE_SPAN_MS, RATE_STEP_MS


def step_start(ms: str, step_ms: int = RATE_STEP_MS) -> Column:
    """Start of the step that holds ``ms``; rates are given once per step."""
    return floor_to_window(ms, step_ms)


def spread_over_windows(
    counts: DataFrame, series: str, span_ms: int = RATE_SPAN_MS, step_ms: int = RATE_STEP_MS
) -> DataFrame:
    """Counts per window from counts per step (``pane``, ``n``)."""
    sliding = F.window(
        F.timestamp_millis("pane"), f"{span_ms} milliseconds", f"{step_ms} milliseconds"
    )
    return (
        counts.groupBy(series, sliding.alias("w"))
        .agg(F.sum("n").alias("n"))
        .select(series, F.unix_millis("w.start").alias("window_start"), "n")
    )


def per_second(count, span_ms: int = RATE_SPAN_MS) -> Column:
    return count / F.lit(span_ms / 1000.0)


def sliding_counts(rows: DataFrame, series: str, ms: str) -> DataFrame:
    """Rows of each series in the last minute, every step.

    Rows are counted per step first, and only those counts are spread over the
    windows they belong to: the sliding window multiplies a few counts, not the rows.
    """
    counts = rows.groupBy(series, step_start(ms).alias("pane")).agg(F.count("*").alias("n"))
    return spread_over_windows(counts, series)


def as_rates(counts: DataFrame, series: str) -> DataFrame:
    return counts.select(series, "window_start", per_second(F.col("n")).alias("per_second"))


def sliding_rate(rows: DataFrame, series: str, ms: str) -> DataFrame:
    """Rows per second of each series over the last minute, every step."""
    return as_rates(sliding_counts(rows, series, ms), series)


def peak_of(counts: DataFrame) -> DataFrame:
    """The highest rate of all series together; counts are added, as those are exact."""
    totals = counts.groupBy("window_start").agg(F.sum("n").alias("n"))
    return totals.agg(per_second(F.max("n")).alias("peak_per_second"))


def peak_rate(rows: DataFrame, series: str, ms: str) -> DataFrame:
    return peak_of(sliding_counts(rows, series, ms))
