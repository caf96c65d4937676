"""Row-wise work on texts inside Arrow batches, and the package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
#: Spark hands a Python worker batches of so many bytes, a row at least. By rows alone, as
#: it would by itself, ten thousand long texts would have to fit into memory together.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not share the driver's path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, files in os.walk(os.path.join(root, package)):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def bounded(spark: SparkSession) -> None:
    """Bound the bytes of a batch where the session leaves them at a larger size.

    The setting is read when a plan runs, after the operator has returned, so it stays lowered
    for the session; it bounds batches and changes no result.
    """
    if int(spark.conf.get(BATCH_SETTING).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def strings(column: pa.Array) -> list[str]:
    """Texts of a column; null reads as empty, bytes that are not UTF-8 are replaced."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [(x or b"").decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose values in ``column`` hold about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = held = 0
    for row, size in enumerate(sizes):
        if row > begin and held + size > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def map_column(
    df: DataFrame,
    compute: Callable[[pa.Array], Sequence[pa.Array]],
    fields: str,
    value_col: str,
    keep: Iterable[str],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Columns ``keep`` and then those of ``fields``, which ``compute`` makes from ``value_col``.

    ``compute`` sees whole values, a few MB at a time, so memory is bounded by the
    slice and the longest value. A kept column named like a new one gives way to it.
    """
    bounded(df.sparkSession)
    ship(df.sparkSession)
    new = T.StructType.fromDDL(fields)
    kept = [c for c in dict.fromkeys(keep) if c not in new.names]
    read = kept if value_col in kept else [*kept, value_col]
    value = read.index(value_col)
    source = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(read)])
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in kept] + new.fields)
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in slices(batch, value, slice_bytes):
                made = compute(part.column(value))
                own = part.columns[: len(kept)]
                yield pa.RecordBatch.from_arrays([*own, *made], names=names)
                del part, made, own
            pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)


def map_texts(
    df: DataFrame,
    compute: Callable[[list[str]], Sequence[pa.Array]],
    fields: str,
    text_col: str,
    keep: Iterable[str],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``map_column`` over texts: a column of any other type is read as its string form."""
    typed = df.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return map_column(
        typed, lambda column: compute(strings(column)), fields, text_col, keep, slice_bytes
    )
