"""Going on with another number of state partitions.

A checkpoint keeps the number of state partitions it was started with. To change it, a
stopped query hands over: its open windows are read from its state and stored, together
with its last batch, its watermark and the end of its source. The next start under the
same root takes a checkpoint of its own, whose state begins empty and has as many partitions
as the session's ``spark.sql.shuffle.partitions`` says. From then on

* the sink adds what was handed over to the windows the new query emits, so that a record
  holds both parts of its window,
* events of windows that the old watermark had closed are dropped, as the new query has no
  watermark before its first batch is done, and
* batch numbers go on after the old ones, so the versions of a window stay in order.

The source has to go on where the old query stopped: a topic from the offsets handed over
(``Handover.offsets``), a folder with files that the old query has not seen.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spintally.functions.plays import completion_rate
from spintally.functions.times import floor_to_window
from spintally.operators.latest import HISTORY_KEY
from spintally.schema import columns, table_schema
from spintally.session import folder_names
from spintally.streaming.state import last_batch, open_windows

FOLDER = "handover"
INFO = "batch_id bigint, watermark_ms bigint, offsets string"


@dataclass(frozen=True)
class Handover:
    """What a query leaves to the next one under the same root."""

    path: str
    batch_id: int
    watermark_ms: int
    offsets: str

    @property
    def first_batch(self) -> int:
        return self.batch_id + 1

    def carried(self, spark: SparkSession, fields) -> DataFrame:
        return spark.read.schema(table_schema(fields)).parquet(f"{self.path}/windows")


def latest(spark: SparkSession, root: str) -> Handover | None:
    """The last hand-over under a root, if there was one."""
    found = [int(name) for name in folder_names(spark, f"{root}/{FOLDER}") if name.isdigit()]
    for number in sorted(found, reverse=True):
        path = f"{root}/{FOLDER}/{number}"
        if "info" in folder_names(spark, path):  # written last, so the windows are whole
            row = spark.read.schema(INFO).parquet(f"{path}/info").first()
            return Handover(path, row["batch_id"], row["watermark_ms"], row["offsets"])
    return None


def checkpoint(root: str, last: Handover | None) -> str:
    """The checkpoint that a query under ``root`` runs on after a hand-over, if any."""
    return f"{root}/checkpoint" if last is None else f"{root}/checkpoint-{last.first_batch}"


def added_up(rows: DataFrame, carried: DataFrame, fields, counters, how: str = "left") -> DataFrame:
    """``rows`` with what was handed over of the same windows added, and rates anew."""
    key = [*HISTORY_KEY, "window_end"]
    before = carried.select(*key, *[F.col(c).alias(f"{c}_before") for c in counters])
    both = rows.select(*key, *counters).join(before, key, how)
    sums = {c: F.coalesce(c, F.lit(0)) + F.coalesce(f"{c}_before", F.lit(0)) for c in counters}
    made = both.withColumns(sums)
    if "completion_rate" in columns(fields):
        made = made.withColumn("completion_rate", completion_rate())
    return made.select(*columns(fields))


def hand_over(
    spark: SparkSession, query: StreamingQuery, root: str, fields, counters: tuple[str, ...]
) -> Handover:
    """Store what the next query needs of a stopped one; ``counters`` as in its state.

    Cut short, it can be repeated: a hand-over counts once its last file is written.
    """
    if query.isActive:
        raise ValueError("a running query cannot hand over: stop it first")
    if query.lastProgress is None:
        raise ValueError("a query without a batch has nothing to hand over")
    before = latest(spark, root)
    own = checkpoint(root, before)
    progress = query.lastProgress
    text = progress.eventTime.get("watermark", "1970-01-01T00:00:00.000Z")
    watermark_ms = round(datetime.fromisoformat(text).timestamp() * 1000)
    rows = open_windows(spark, own, counters)
    if before is not None:
        watermark_ms = max(watermark_ms, before.watermark_ms)
        open_still = before.carried(spark, fields).filter(F.col("window_end") > watermark_ms)
        rows = added_up(rows, open_still, fields, counters, "full")
    elif "completion_rate" in columns(fields):
        rows = rows.withColumn("completion_rate", completion_rate())
    first = 0 if before is None else before.first_batch
    batch_id = first + max(last_batch(spark, own), progress.batchId)
    made = Handover(
        f"{root}/{FOLDER}/{batch_id}", batch_id, watermark_ms, progress.sources[0].endOffset
    )
    rows.select(*columns(fields)).write.mode("overwrite").parquet(f"{made.path}/windows")
    info = spark.createDataFrame([(batch_id, watermark_ms, made.offsets)], INFO)
    info.coalesce(1).write.mode("overwrite").parquet(f"{made.path}/info")
    return made


def still_open(events: DataFrame, size_ms: int, last: Handover | None) -> DataFrame:
    """Events of windows that were open at the hand-over, or of newer ones."""
    if last is None:
        return events
    return events.filter(floor_to_window("ts_ms", size_ms) + size_ms > last.watermark_ms)


def continued(sink, last: Handover | None, fields, counters):
    """``sink`` with batch numbers that go on and windows that hold both parts."""
    if last is None:
        return sink

    def store(updates: DataFrame, batch_id: int) -> None:
        carried = last.carried(updates.sparkSession, fields)
        sink(added_up(updates, carried, fields, counters), last.first_batch + batch_id)

    return store
