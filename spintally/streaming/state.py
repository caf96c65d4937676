"""The open windows of a running or stopped aggregation, read from its named state.

The state of a stateful query lies in its checkpoint, a version for each committed batch.
Reading it touches neither the query nor its sinks: it can be asked while the query runs,
and gives the windows as of the last committed batch. A window is there from its first
event until the watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.functions.plays import completion_rate
from spintally.schema import COMPLETION_FIELDS, HOURLY_FIELDS, columns

#: Counters in the order in which the state holds them.
COMPLETION_COUNTERS = ("starts", "completes")
HOURLY_COUNTERS = ("play_count",)


def open_windows(spark: SparkSession, checkpoint: str, counters: tuple[str, ...]) -> DataFrame:
    """``song_id``, ``window_start``, ``window_end``, the counters and the state partition."""
    held = spark.read.format("statestore").load(checkpoint)
    # the counts have no names of their own in the state, only their order
    named = F.col("value").cast("struct<" + ",".join(f"{c}:bigint" for c in counters) + ">")
    return held.select("key", "partition_id", named.alias("counts")).select(
        "key.song_id",
        F.unix_millis("key.window.start").alias("window_start"),
        F.unix_millis("key.window.end").alias("window_end"),
        "counts.*",
        F.col("partition_id").alias("state_partition"),
    )


def open_completion(spark: SparkSession, root: str) -> DataFrame:
    """Open five-minute windows of the completion query under ``root``, as completion records."""
    rows = open_windows(spark, f"{root}/checkpoint", COMPLETION_COUNTERS)
    return rows.withColumn("completion_rate", completion_rate()).select(
        *columns(COMPLETION_FIELDS), "state_partition"
    )


def open_hourly(spark: SparkSession, root: str) -> DataFrame:
    """Open hours of the hourly query under ``root``, as hourly records."""
    rows = open_windows(spark, f"{root}/checkpoint", HOURLY_COUNTERS)
    return rows.select(*columns(HOURLY_FIELDS), "state_partition")


def state_partitions(spark: SparkSession, checkpoint: str) -> int:
    """The number of state partitions that a checkpoint was started with."""
    return spark.read.format("state-metadata").load(checkpoint).first()["numPartitions"]


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the state of a checkpoint has a version of."""
    return spark.read.format("state-metadata").load(checkpoint).first()["maxBatchId"]
