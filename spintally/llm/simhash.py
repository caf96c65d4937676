"""SimHash near-duplicates: word-shingle fingerprints linked by pigeonring filtering.

A fingerprint is cut into ``max_bits + 1`` segments on a ring. If two fingerprints
differ in at most ``max_bits`` bits, some segment starts a chain in which the first
1, 2, ... segments together differ by no more than their share of the allowed bits,
rounded down: none in the first segment, at most one in the first two, and so on.
The first conditions make a join key, the longer chains prune what the key brings
together, and the full Hamming distance decides.

Defined results: null and blank texts have fingerprint zero and link like any
other; repeated rows are rows of their own with the same fingerprint; a component
made of null ids only has a null id; an empty table gives an empty result. Texts are
read whole, their shingles a piece at a time; ``keep`` columns named ``fp``, ``root`` or
``component_id`` give way to the new ones, and ``deduplicated`` keeps all columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spintally.llm.rows import map_texts
from spintally.llm.tables import components, saved

BITS = 64
SEED = 42  # the seed of Spark's own xxhash64
SHINGLE = 4
MAX_BITS = 4
#: Shingles of a text that are hashed and counted at a time.
PIECE = 1 << 16
#: Segments of a chain that make the join key. Two of five hold 26 of 64 bits and cost 75 rows
#: for each distinct fingerprint; three hold 39 and cost about 1,370, which pays once buckets
#: of two grow beyond some dozens, at billions of fingerprints. The links are the same.
KEY_SEGMENTS = 2
#: A bucket of more distinct fingerprints than this costs less by shared neighbours than by pairs.
DENSE_BUCKET = 4096


def shingle_hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all runs of ``shingle`` words, or of the whole sequence if it is shorter.

    They come in pieces of bounded size.
    """
    words = text.encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    if len(words) <= shingle:
        yield np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
        return
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    del words
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(sizes) - shingle + 1], ends[shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    for first in range(0, len(starts), PIECE):
        bounds = zip(starts[first : first + PIECE].tolist(), ends[first : first + PIECE].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in bounds], np.uint64)


def fingerprint(hashes: Iterable[np.ndarray]) -> int:
    """Bits set in more than half of the hashes, as an unsigned number; zero for none."""
    counts, total = np.zeros(BITS, np.int64), 0
    for piece in hashes:
        rows = piece.astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(piece)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    text_col: str = "text",
    keep: Iterable[str] = ("doc_id",),
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per input row: ``keep`` and the 64-bit ``fp`` (as Spark's signed long)."""

    def compute(texts):
        made = [fingerprint(shingle_hashes(text, shingle)) for text in texts]
        return [pa.array(np.array(made, dtype=np.uint64).view(np.int64), pa.int64())]

    return map_texts(docs, compute, "fp long", text_col, keep)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """Offset and width of the ring's segments."""
    edges = [BITS * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def chain(difference: Column, start: int, max_bits: int) -> Column:
    """Whether the chain from segment ``start`` stays within its share at every length."""
    ring = segments(max_bits)
    mask, held = 0, []
    for length in range(1, len(ring) + 1):
        offset, width = ring[(start + length - 1) % len(ring)]
        mask |= ((1 << width) - 1) << offset
        allowed = length * max_bits // len(ring)
        held.append(F.bit_count(difference.bitwiseAND(F.lit(signed(mask)))) <= allowed)
    return reduce(lambda a, b: a & b, held)


def segment(fp: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1))


def chain_flips(start: int, max_bits: int, key_segments: int) -> list[int]:
    """All ways to flip bits of a key of ``key_segments`` segments within the chain's shares.

    The key's highest bits are the chain's first segment.
    """
    ring = segments(max_bits)
    widths = [ring[(start + i) % len(ring)][1] for i in range(key_segments)]
    ways = [(0, 0)]  # flips so far and their number
    for place, width in enumerate(widths):
        allowed, grown = (place + 1) * max_bits // len(ring), []
        for flips, used in ways:
            for more in range(allowed - used + 1):
                for bits in combinations(range(width), more):
                    grown.append((flips << width | sum(1 << bit for bit in bits), used + more))
        ways = grown
    return [flips for flips, _ in ways]


def ring_keys(fps: DataFrame, max_bits: int, key_segments: int, variants: bool) -> DataFrame:
    """``(start, key, fp)``: a chain of segments from every start, with its flips if asked for."""
    ring = segments(max_bits)
    keys = []
    for start in range(len(ring)):
        key = F.lit(0).cast("long")
        for place in range(key_segments):
            offset, width = ring[(start + place) % len(ring)]
            key = F.shiftleft(key, width).bitwiseOR(segment(F.col("fp"), offset, width))
        keys.append(F.struct(F.lit(start).alias("start"), key.alias("key")))
    made = fps.select("fp", F.inline(F.array(*keys)))
    if not variants:
        return made
    flips = [
        F.array(*[F.lit(f).cast("long") for f in chain_flips(start, max_bits, key_segments)])
        for start in range(len(ring))
    ]
    made = made.select("fp", "start", "key", F.explode(F.get(F.array(*flips), "start")).alias("flip"))
    return made.select("fp", "start", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))


def sparse_links(
    fps: DataFrame, max_bits: int, key_segments: int, dense: DataFrame | None
) -> DataFrame:
    """Links found through the buckets of the ring keys, each once, as ``(a, b)``."""
    index = ring_keys(fps, max_bits, key_segments, variants=False).withColumnRenamed("fp", "b")
    probe = ring_keys(fps, max_bits, key_segments, variants=True).withColumnRenamed("fp", "a")
    if dense is not None:
        index = index.join(dense, ["start", "key"], "left_anti")
    difference = F.col("p.a").bitwiseXOR(F.col("i.b"))
    chains = [chain(difference, s, max_bits) for s in range(max_bits + 1)]
    first = reduce(
        lambda a, b: a | b,
        [
            reduce(lambda x, y: x & y, [~c for c in chains[:s]], F.col("i.start") == s) & chains[s]
            for s in range(max_bits + 1)
        ],
    )
    if dense is not None:  # an earlier start may lie in a dense bucket, so any start counts
        first = reduce(
            lambda a, b: a | b,
            [(F.col("i.start") == s) & chains[s] for s in range(max_bits + 1)],
        )
    return (
        probe.alias("p")
        .join(
            index.alias("i"),
            (F.col("p.start") == F.col("i.start"))
            & (F.col("p.key") == F.col("i.key"))
            & (F.col("p.a") < F.col("i.b"))
            & first
            & (F.bit_count(difference) <= max_bits),
        )
        .select("p.a", "i.b")
    )


def neighbour_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Edges that join the same components as all links among ``fps``, without pairs.

    Two fingerprints differ in at most ``max_bits`` bits exactly if some value lies
    within half of that (rounded up) from one and half (rounded down) from the other.
    Each value's fingerprints are tied to one of them: rows grow with the fingerprints.
    """
    up, down = (max_bits + 1) // 2, max_bits // 2
    around = fps.select(
        "fp", F.col("fp").alias("middle"), F.lit(-1).alias("last"), F.lit(0).alias("reach")
    )
    for _ in range(up):  # flip one more bit above the last, or (bit 64) none any more
        bits = F.when(F.col("last") < BITS, F.sequence(F.col("last") + 1, F.lit(BITS)))
        bit = F.col("bit")
        around = around.withColumn("bit", F.explode(F.coalesce(bits, F.array(F.lit(BITS))))).select(
            "fp",
            F.when(bit < BITS, F.col("middle").bitwiseXOR(F.expr("shiftleft(1L, bit)")))
            .otherwise(F.col("middle"))
            .alias("middle"),
            bit.alias("last"),
            (F.col("reach") + (bit < BITS).cast("int")).alias("reach"),
        )
    # a middle has as many fingerprints around it as there are ways to flip, at most
    shared = Window.partitionBy("middle")
    near = F.min(F.when(F.col("reach") <= down, F.col("fp"))).over(shared)
    return around.select(near.alias("a"), F.col("fp").alias("b")).filter("a != b").distinct()


def links(
    fps: DataFrame,
    max_bits: int = MAX_BITS,
    dense_bucket: int = DENSE_BUCKET,
    key_segments: int = KEY_SEGMENTS,
) -> DataFrame:
    """Edges ``(a, b)`` between distinct ``fp`` values with the components of all links.

    Buckets up to ``dense_bucket`` give every link they hold. A larger bucket holds
    so many fingerprints around the same segments that pairs would grow with its
    square; its members are tied through shared neighbours, which is exact as well.
    """
    # a row here becomes dozens of keys, so the rows are dealt to all tasks
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    sizes = ring_keys(fps, max_bits, key_segments, variants=False).groupBy("start", "key").count()
    dense = saved(sizes.filter(F.col("count") > dense_bucket).select("start", "key"))
    if dense.limit(1).count() == 0:
        return sparse_links(fps, max_bits, key_segments, None)
    # a link into a dense bucket may come from a fingerprint some flips off it
    near = ring_keys(fps, max_bits, key_segments, variants=True).join(dense, ["start", "key"], "left_semi")
    inside = saved(near.select("fp").distinct())
    return sparse_links(fps, max_bits, key_segments, dense).union(neighbour_links(inside, max_bits))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    dense_bucket: int = DENSE_BUCKET,
    key_segments: int = KEY_SEGMENTS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, ``fp``, ``root``, ``component_id``.

    Copies share a fingerprint, so links are sought between distinct fingerprints only,
    however many rows a group of copies has. ``component_id`` is the smallest id that
    can be reached over links of at most ``max_bits`` differing bits, ``root`` the
    smallest fingerprint.
    """
    columns = list(dict.fromkeys([id_col, *keep]))
    marked = saved(fingerprints(docs, text_col, columns, shingle))
    classes = saved(marked.groupBy("fp").agg(F.min(f"`{id_col}`").alias("first_id")))
    edges = saved(links(classes.select("fp"), max_bits, dense_bucket, key_segments))
    roots = components(edges)
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    ids = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(ids, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select(
        *[F.col(f"`{c}`") for c in columns], "fp", "root", "component_id"
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row of each group, all columns: that of the smallest id (null last) and text hash.

    Rows that repeat both are one document. They are told apart only where they occur,
    so no other text is shuffled for their sake.
    """
    text_hash = F.xxhash64(F.col(f"`{text_col}`"))
    keyed = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("value"),
        text_hash.alias("text_hash"),
    )
    found = near_duplicates(keyed, "id", "value", keep=["text_hash"], **options)
    copies = found.groupBy("root", "id", "text_hash").agg(F.count("*").alias("copies"))
    first = copies.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "text_hash", "copies")).alias("first")
    )
    chosen = first.select("first.id", "first.text_hash", "first.copies").alias("chosen")
    own = docs.alias("own")
    kept = own.join(
        chosen,
        F.col(f"own.`{id_col}`").eqNullSafe(F.col("chosen.id"))
        & (F.xxhash64(F.col(f"own.`{text_col}`")) == F.col("chosen.text_hash")),
    )
    columns = [F.col(f"own.`{c}`") for c in docs.columns]
    single = kept.filter("chosen.copies = 1").select(*columns)
    repeated = kept.filter("chosen.copies > 1").select(*columns).dropDuplicates([id_col, text_col])
    return single.union(repeated)
