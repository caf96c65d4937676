"""Reduced tables kept in the shared folder between the steps of a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spintally.session import run_dir, shared_dir


def stored(narrow: DataFrame) -> DataFrame:
    """Keep a reduced table in the shared folder: computed once, and safe from lost executors.

    Spark removes it when the frame is no longer used.
    """
    shared_dir(narrow.sparkSession)
    return narrow.checkpoint()


def sized(reduced: DataFrame, name: str) -> DataFrame:
    """The same as files, whose size the planner knows.

    A join then broadcasts the table if its bytes are within
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    path = run_dir(reduced.sparkSession, name)
    reduced.write.parquet(path)
    return reduced.sparkSession.read.schema(reduced.schema).parquet(path)
