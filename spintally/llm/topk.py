"""Exact top-k search by inner product: norm-bucketed retrieval with local cosine thresholds.

Vectors are ordered by decreasing length and cut into cells and, inside a cell, into
buckets of similar length. With a lower bound ``b`` on a query's k-th score, a vector of a
bucket whose longest has length ``l`` must reach the cosine ``b / (|q| l)``. A bucket that
asks for more than 1 is passed over. From ``COORDINATE_FROM`` on, the bucket is pruned by
coordinates: the query's largest one allows a range, read off the bucket's sorted column,
and the next ones shrink what is left by what the remaining coordinates can still add.
Below it, pruning by length keeps the vectors that are long enough. Products of what is
left are computed exactly, in integers, and raise the bound for the next bucket.

Queries meet vectors in blocks: a task takes one block of queries and one cell. Cells come
in rounds, the longest vectors first and each round ``GROWTH`` times the cells before it, so
that the bounds of the earlier rounds prune whole cells before they are moved, and a query
keeps a few times ``k`` rows of a round, not ``k`` for each cell. With Q queries, N vectors,
``N * Q * (1 / QUERIES + 1 / VECTORS)`` rows are shuffled at most.

Defined results: rows without an id, and vectors that are null or hold a null, NaN or
infinity (also after scaling), take no part; missing components of shorter vectors
count as zero; all rows with a query's id are its own and no candidates for it; a repeated
row is a candidate as often as it stands, and a repeated query row gives its results
again; equal scores go to the smaller id; scores beyond a long are cut off at its ends;
an empty table or query set gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spintally.llm.ragged import offsets_of
from spintally.llm.rows import bounded, ship
from spintally.llm.tables import numbered, saved

K = 10
SCALE = 1024
#: Queries of a block and vectors of a cell; a task holds one of each.
QUERIES = 16_384
VECTORS = 4_096
#: Vectors of a bucket, and queries multiplied with it at a time.
BUCKET = 1_024
ROWS = 256
#: Local cosine from which a bucket is pruned by coordinates instead of lengths.
COORDINATE_FROM = 0.6
#: Coordinates that shrink the range of the largest one.
FOCUS = 4
GROWTH = 8
#: Relative error allowed for in comparisons of floating-point bounds.
SLACK = 1e-9

LONG = np.iinfo(np.int64)
HITS = "q long, query_id long, vec_id long, score long"


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of lists without nulls, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    if len(values) == width * len(sizes):
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - offsets_of(sizes)[row]] = values
    return out


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``(id, vector, norm)`` of the rows that take part; components are floored multiples."""
    source = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).filter("id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = offsets_of(sizes)
            with np.errstate(over="ignore"):
                values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
            bad = offsets_of(~np.isfinite(values))[bounds]
            good = np.flatnonzero(bad[1:] == bad[:-1])
            finite = np.where(np.isfinite(values), values, 0.0)
            with np.errstate(over="ignore"):
                squares = np.append(finite * finite, 0.0)
            sums = np.add.reduceat(squares, bounds[:-1]) if len(sizes) else np.zeros(0)
            norm = np.sqrt(np.where(sizes > 0, sums, 0.0))
            made = pa.ListArray.from_arrays(bounds.astype(np.int32), finite)
            out = pa.RecordBatch.from_arrays(
                [batch.column("id"), made, pa.array(norm)], names=["id", "vector", "norm"]
            )
            yield out.take(pa.array(good))

    return source.mapInArrow(run, "id long, vector array<double>, norm double")


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integral rows as longs, those beyond a long cut off."""
    if not (queries.size and vectors.size):
        return np.zeros((len(queries), len(vectors)), np.int64)
    most = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if most < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    if most < 2.0**62:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(queries) @ whole(vectors).T
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


class Bucket:
    """Vectors of similar length, longest first, with sorted columns once they are asked for."""

    def __init__(self, vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray):
        self.vectors, self.norms, self.ids = vectors, norms, ids
        self.longest = norms[0]
        self._columns = None

    @property
    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors, the order of each coordinate, and its sorted values."""
        if self._columns is None:
            unit = self.vectors / np.where(self.norms > 0, self.norms, 1.0)[:, None]
            order = np.argsort(unit, axis=0, kind="stable")
            self._columns = unit, order, np.take_along_axis(unit, order, axis=0)
        return self._columns

    def long_enough(self, least: np.ndarray) -> np.ndarray:
        """How many vectors have at least the lengths ``least``."""
        return np.searchsorted(-self.norms, -least, "right")

    def by_coordinates(self, direction: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors that may reach the cosine with a unit query, by its largest coordinates."""
        unit, order, values = self.columns
        focus = np.argsort(-np.abs(direction), kind="stable")[: FOCUS + 1]
        main = focus[0]
        angle, reach = np.arccos(np.clip(direction[main], -1, 1)), np.arccos(min(cosine, 1.0))
        low = np.cos(min(np.pi, angle + reach)) - SLACK
        high = np.cos(max(0.0, angle - reach)) + SLACK
        begin, end = np.searchsorted(values[:, main], [low, high + SLACK])
        own = order[begin:end, main]
        if not len(own):
            return own
        part = unit[own[:, None], focus]
        rest = np.sqrt(max(0.0, 1.0 - float(direction[focus] @ direction[focus])))
        left = np.sqrt(np.maximum(0.0, 1.0 - (part * part).sum(axis=1)))
        return own[part @ direction[focus] + rest * left >= cosine - SLACK]


class Best:
    """The best scores of each query so far, and what a further one must reach."""

    def __init__(self, bounds: np.ndarray, own_ids: np.ndarray, k: int):
        self.bounds, self.own_ids, self.k = bounds, own_ids, k
        self.rows = self.ids = self.scores = np.zeros(0, np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take in scores; of each query the ``k`` best stay, smaller ids first among equals."""
        fit = (scores >= self.bounds[rows]) & (ids != self.own_ids[rows])
        if not fit.any():
            return
        rows = np.concatenate([self.rows, rows[fit]])
        ids = np.concatenate([self.ids, ids[fit]])
        scores = np.concatenate([self.scores, scores[fit]])
        order = np.lexsort((ids, ~scores, rows))  # ~ turns the order round without overflow
        rows, ids, scores = rows[order], ids[order], scores[order]
        first = np.searchsorted(rows, rows, "left")
        place = np.arange(len(rows)) - first
        last = place == self.k - 1
        self.bounds[rows[last]] = np.maximum(self.bounds[rows[last]], scores[last])
        stay = place < self.k
        self.rows, self.ids, self.scores = rows[stay], ids[stay], scores[stay]


def search_bucket(bucket: Bucket, queries: np.ndarray, norms: np.ndarray, best: Best) -> None:
    """Scores of one bucket's vectors that may be among the best of each query."""
    bounds = best.bounds.astype(np.float64)
    asked = np.where(bounds > 0, bounds, 0.0) * (1 - SLACK)
    # zero asked: anything may count. Else the length a vector must have at least
    least = np.divide(asked, norms, out=np.where(asked > 0, np.inf, 0.0), where=norms > 0)
    cosine = np.divide(
        least, bucket.longest, out=np.where(least > 0, np.inf, 0.0), where=bucket.longest > 0
    )
    for row in np.flatnonzero((cosine >= COORDINATE_FROM) & (cosine <= 1.0)):
        own = bucket.by_coordinates(queries[row] / norms[row], float(cosine[row]))
        if len(own):
            scores = products(queries[row : row + 1], bucket.vectors[own])[0]
            best.add(np.full(len(own), row), bucket.ids[own], scores)
    rows = np.flatnonzero(cosine < COORDINATE_FROM)
    reach = bucket.long_enough(least[rows])
    for first in range(0, len(rows), ROWS):
        part, most = rows[first : first + ROWS], reach[first : first + ROWS]
        if not most.max():
            continue
        scores = products(queries[part], bucket.vectors[: most.max()])
        hit = (np.arange(scores.shape[1]) < most[:, None]) & (scores >= best.bounds[part][:, None])
        row, column = np.nonzero(hit)
        best.add(part[row], bucket.ids[column], scores[row, column])


def _search_cell(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        vectors = vectors.sort_by("place")
        x, y = _matrix(queries["vector"]), _matrix(vectors["vector"])
        width = max(x.shape[1], y.shape[1])
        x, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, y))
        query_ids, ids = queries["id"].to_numpy(), vectors["id"].to_numpy()
        norms, lengths = queries["norm"].to_numpy(), vectors["norm"].to_numpy()
        known = queries["bound"].combine_chunks().fill_null(int(LONG.min)).to_numpy()
        best = Best(np.array(known), query_ids, k)
        for first in range(0, len(ids), BUCKET):
            own = slice(first, first + BUCKET)
            search_bucket(Bucket(y[own], lengths[own], ids[own]), x, norms, best)
        return pa.table(
            {
                "q": queries["q"].to_numpy()[best.rows],
                "query_id": query_ids[best.rows],
                "vec_id": best.ids,
                "score": best.scores,
            }
        )

    return run


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    queries_per_block: int = QUERIES,
    vectors_per_cell: int = VECTORS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of ``vectors`` for every query row.

    Both tables have ``id_col`` and ``vector_col``; ranks count from 1.
    """
    spark = vectors.sparkSession
    bounded(spark)
    ship(spark)
    ordered = numbered(
        scaled(vectors, id_col, vector_col, scale), F.col("norm").desc(), F.col("id").asc()
    )
    cells = ordered.withColumn("cell", F.floor(F.col("place") / vectors_per_cell))
    lengths = saved(cells.groupBy("cell").agg(F.max("norm").alias("longest")))
    asked = numbered(scaled(queries, id_col, vector_col, scale), F.col("id").asc())
    asked = asked.withColumnRenamed("place", "q")
    asked = asked.withColumn("block", F.floor(F.col("q") / queries_per_block))
    best = spark.createDataFrame([], HITS)
    total = lengths.count()
    done = 0
    while done < total:
        until = min(total, max(1, done * (1 + GROWTH)))
        bounds = best.groupBy("q").agg(
            F.when(F.count("*") >= k, F.min("score")).alias("bound")
        )
        bounded_queries = asked.join(bounds, "q", "left")
        least = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm"))
        blocks = bounded_queries.groupBy("block").agg(
            F.min(F.coalesce(least, F.lit(0.0))).alias("least")
        )
        # longs as in ``cells``: an int and a long that are equal hash to different partitions,
        # and groups of different ones never meet
        first, last = (F.lit(cell).cast("long") for cell in (done, until - 1))
        spread = blocks.withColumn("cell", F.explode(F.sequence(first, last)))
        pairs = saved(
            spread.join(lengths, "cell")
            .filter(F.col("longest") >= F.col("least") * (1 - SLACK))
            .select("block", "cell")
        )
        left = bounded_queries.join(pairs, "block").select(
            "block", "cell", "q", "id", "vector", "norm", "bound"
        )
        right = cells.join(pairs, "cell").select("block", "cell", "place", "id", "vector", "norm")
        found = left.groupBy("block", "cell").cogroup(right.groupBy("block", "cell"))
        hits = best.union(found.applyInArrow(_search_cell(k), HITS))
        best = saved(_ranked(hits).filter(F.col("rank") <= k).drop("rank"))
        done = until
    return _ranked(best).select("query_id", "rank", "vec_id", "score")


def _ranked(hits: DataFrame) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order))
