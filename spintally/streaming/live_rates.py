"""Ingest rates of a running stream.

Arrivals are counted per series and step in a stream of its own, whose watermark follows
the arrival time. A sliding window covers several steps, but the state holds each step
once; the few counts are spread over the windows when the rates are read, as for tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spintally.operators import rates
from spintally.schema import RATE_SPAN_MS, RATE_STEP_MS
from spintally.streaming.sinks import batch_path
from spintally.streaming.watermarked import FLUSH_INTERVAL, start

SERIES = "event_type"
RATES_QUERY = "ingest-rates"
PANES = "panes"


def pane_updates(events: DataFrame, series: str = SERIES) -> DataFrame:
    """Changed counts of arrivals by series and step: ``series``, ``pane``, ``n``."""
    arrived = F.timestamp_millis("arrival_ms")
    step = F.window("arrived", f"{RATE_STEP_MS} milliseconds").alias("step")
    counted = (
        events.select(series, arrived.alias("arrived"))
        .withWatermark("arrived", f"{RATE_SPAN_MS} milliseconds")
        .groupBy(series, step)
        .agg(F.count("*").alias("n"))
    )
    return counted.select(series, F.unix_millis("step.start").alias("pane"), "n")


def start_rates(
    events: DataFrame,
    root: str,
    available_now: bool = False,
    every: str = FLUSH_INTERVAL,
    series: str = SERIES,
) -> StreamingQuery:
    """Counts per step into ``root/panes``, a folder per batch that a retry overwrites."""

    def store(updates: DataFrame, batch_id: int) -> None:
        rows = updates.hint("rebalance")
        rows.write.mode("overwrite").parquet(batch_path(f"{root}/{PANES}", batch_id))

    updates = pane_updates(events, series)
    return start(updates, store, f"{root}/checkpoint", RATES_QUERY, available_now, every)


def read_panes(spark: SparkSession, root: str, series: str = SERIES) -> DataFrame:
    """The last count of every series and step."""
    schema = f"{series} string, pane bigint, n bigint, batch_id bigint"
    rows = spark.read.schema(schema).parquet(f"{root}/{PANES}")
    return rows.groupBy(series, "pane").agg(F.max_by("n", "batch_id").alias("n"))


def live_rate(spark: SparkSession, root: str, series: str = SERIES) -> DataFrame:
    """Arrivals per second of each series over the last minute, every step."""
    counts = rates.spread_over_windows(read_panes(spark, root, series), series)
    return rates.as_rates(counts, series)


def live_peak(spark: SparkSession, root: str, series: str = SERIES) -> DataFrame:
    """The highest rate of all series together."""
    return rates.peak_of(rates.spread_over_windows(read_panes(spark, root, series), series))
