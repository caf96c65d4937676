"""What a running aggregation took in, emitted and dropped, batch by batch.

The counts of arrived events are observed inside the query itself, as its batches run, and
come with its progress; no second pass over the input is needed. ``record`` stores the
progress of a query in a table beside its history. What a batch added to the windows is
read off the history's versions, so arrived minus added is what came too late.

Spark counts an observed row once per task that saw it and succeeded. A stage that is run
again after an executor was lost may count its rows twice, so ``late`` is then too high for
that batch; the history is not affected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spintally.functions.plays import is_start
from spintally.operators.latest import HISTORY_KEY
from spintally.streaming.sinks import HISTORY, stored_versions

ARRIVED = "arrived"
METRICS = "metrics"
SCHEMA = (
    "batch_id bigint, events bigint, starts bigint, updated_windows bigint, "
    "dropped_groups bigint, watermark string"
)


def observed(events: DataFrame) -> DataFrame:
    """``events``, of which each batch's number and starts are reported with its progress."""
    return events.observe(
        ARRIVED, F.count(F.lit(1)).alias("events"), F.count_if(is_start()).alias("starts")
    )


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """One row for each batch that Spark still remembers and that took in events."""
    rows = {}
    for progress in query.recentProgress:
        seen = progress.observedMetrics.get(ARRIVED)
        if seen is None or not seen["events"]:
            continue
        states = progress.stateOperators
        rows[progress.batchId] = (
            progress.batchId,
            seen["events"],
            seen["starts"],
            sum(s.numRowsUpdated for s in states),
            sum(s.numRowsDroppedByWatermark for s in states),
            progress.eventTime.get("watermark"),
        )
    return [rows[batch] for batch in sorted(rows)]


def record(spark: SparkSession, query: StreamingQuery, root: str, first_batch: int = 0) -> int:
    """Store the progress of ``query`` under ``root/metrics``; the number of batches stored.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` batches of a run,
    so a long run is recorded from time to time. A batch recorded again counts once. After a
    hand-over, ``first_batch`` is the number in the history of the query's batch 0.
    """
    rows = [(first_batch + batch, *rest) for batch, *rest in progress_rows(query)]
    if rows:
        table = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        table.write.mode("overwrite").parquet(f"{root}/{METRICS}/upto={rows[-1][0]}")
    return len(rows)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The recorded batches of a query, one row each."""
    rows = spark.read.schema(SCHEMA).parquet(f"{root}/{METRICS}")
    names = [c for c in rows.columns if c != "batch_id"]
    return rows.groupBy("batch_id").agg(*[F.max_by(c, "events").alias(c) for c in names])


def added_by_batch(spark: SparkSession, root: str, fields, counted: str) -> DataFrame:
    """What each batch added to ``counted`` over all windows, and the records it emitted.

    A version of a window holds its count so far; the version before it is subtracted. To be
    read before the history is compacted, which leaves one version of each window.
    """
    versions = stored_versions(spark, [f"{root}/{HISTORY}"], fields)
    before = Window.partitionBy(*HISTORY_KEY).orderBy("batch_id")
    step = F.col(counted) - F.coalesce(F.lag(counted).over(before), F.lit(0))
    return (
        versions.select("batch_id", step.alias("step"))
        .groupBy("batch_id")
        .agg(F.sum("step").alias("added"), F.count("*").alias("emitted"))
    )


def batch_metrics(spark: SparkSession, root: str, fields, counted: str) -> DataFrame:
    """Every recorded batch: starts that arrived, were added and came late; records emitted."""
    added = added_by_batch(spark, root, fields, counted)
    metrics = read_metrics(spark, root).join(added, "batch_id", "left")
    kept = F.coalesce("added", F.lit(0))
    return metrics.select(
        "batch_id",
        "starts",
        kept.alias("added"),
        (F.col("starts") - kept).alias("late_starts"),
        F.coalesce("emitted", F.lit(0)).alias("emitted"),
        "dropped_groups",
        "watermark",
    )
