"""Spans ``(kind, start, end)`` in code points, end exclusive, as columns and digests."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD = "array<struct<kind:string,start:int,end:int>>"
TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

Span = tuple[str, int, int]


def column(found: list[list[Span]]) -> pa.Array:
    rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found]
    return pa.array(rows, TYPE)


def of_kinds(spans: str, kinds: Sequence[str]) -> Column:
    return F.filter(F.col(spans), lambda s: s["kind"].isin(*kinds))


def count(spans: str, kind: str) -> Column:
    return F.size(of_kinds(spans, [kind])).cast("long")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span in order, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )
