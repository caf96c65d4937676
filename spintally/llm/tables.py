"""Intermediate tables in the folder all executors share, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.session import shared_dir


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; Spark removes it with the frame."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``df`` kept in the shared folder with its rows' numbers in ``order``, from 0.

    Ranges are sorted apart, and a range starts after the rows of those before it; only
    the number of rows of each range reaches the driver.
    """
    spark = df.sparkSession
    part = F.spark_partition_id()
    inside = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = saved(ranges.withColumns({"_range": part, "_inside": inside}))
    firsts, first = [], 0
    for row in sorted(kept.groupBy("_range").count().collect()):
        firsts.append((row["_range"], first))
        first += row["count"]
    begins = F.broadcast(spark.createDataFrame(firsts, "_range int, _first long"))
    return kept.join(begins, "_range").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_first") + F.col("_inside")).alias(name)
    )


def normalised(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, smaller node first, without loops."""
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.filter("a != b").distinct()


def compressed(parents: DataFrame) -> DataFrame:
    """``(node, root)``: every node of a forest with its tree's root, by doubling jumps."""
    while True:
        up = parents.select(F.col("node").alias("via"), F.col("root").alias("far"))
        jumped = saved(
            parents.join(up, F.col("root") == F.col("via")).select(
                "node", F.col("far").alias("root"), (F.col("far") != F.col("root")).alias("moved")
            )
        )
        parents = jumped.select("node", "root")
        if not jumped.filter("moved").limit(1).count():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of undirected ``(a, b)`` edges; root is the smallest node.

    Every node hangs on its smallest neighbour if that is smaller; the trees shrink to
    their roots, and only edges between different roots go on, each once. The nodes
    left at least halve every round. Hubs shrink before each shuffle.
    """
    live = saved(normalised(edges))
    labels = None
    while True:
        both = live.union(live.select(F.col("b"), F.col("a"))).toDF("node", "near")
        tree = both.groupBy("node").agg(F.least("node", F.min("near")).alias("root"))
        roots = compressed(saved(tree))
        if labels is None:
            labels = roots
        else:
            then = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = saved(
                labels.join(then, "root", "left").select(
                    "node", F.coalesce("next", "root").alias("root")
                )
            )
        moved = live.join(roots.toDF("a", "root_a"), "a").join(roots.toDF("b", "root_b"), "b")
        moved = moved.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        live = saved(normalised(moved))
        if not live.limit(1).count():
            return labels
