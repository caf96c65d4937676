"""Session settings, the shared scratch folder, and the folders of single runs in it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Masters whose tasks run in the driver's process and see its local files.
IN_PROCESS = re.compile(r"local(\[[^\]]*\])?")

_runs: dict[str, list[str]] = {}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "spintally", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for; sizing stays with the caller."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a session whose executors run in the driver's process gets a folder of its own
    if it names none. Elsewhere it must name one, and a path without a scheme is taken as
    the cluster's file system has it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not IN_PROCESS.fullmatch(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spintally-")
        sc.setCheckpointDir(named)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    """File system and path; there is no public way from Python to a file system of the cluster."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    files, target = _hadoop(spark, path)
    files.delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one for the tables of one run.

    It goes when ``clear_runs`` is called or, at the latest, when the driver ends.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, target = _hadoop(spark, path)
    files.mkdirs(target)
    files.deleteOnExit(target)
    _runs.setdefault(spark.sparkContext.applicationId, []).append(path)
    return f"{path}/run"


def clear_runs(spark: SparkSession) -> None:
    """Delete the folders of all runs so far; results read from them must be read before."""
    for path in _runs.pop(spark.sparkContext.applicationId, []):
        drop_folder(spark, path)


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for the stateful queries.

    Each of them has one stateful operator, so the late filter may use the same
    watermark as state eviction instead of the one from the batch before. The
    sibling keeps these settings away from the caller's batch queries.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sibling.conf.set(
        "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    )
    return sibling
