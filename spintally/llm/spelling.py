"""Spelling variants: words one edit apart, compared block by block in dense tiles.

Two words differ by one inserted, deleted or replaced code point exactly if their common
prefix and common suffix together reach the longer length minus one. A word of ``s``
code points is cut into three pieces; an edit hits one of them, so the pair shares what
is left of the word without that piece. Words meet in buckets of such remainders, once
as the shorter and once as the longer one of a pair. Inside a bucket every shorter word
is compared with all that follow it, many buckets at a time, on padded matrices of code
points read from the left and from the right; only the pairs one edit apart leave the
task, each from the first bucket it meets in.

A bucket of more than ``dense`` words is cut finer, into one bucket for each place the
edit may have within its piece. Words of such a bucket agree but for one or two code
points, so the alphabet bounds its size, and no pair is lost or found twice.

Defined results: a null, empty or wordless text gives no words; a null id counts as an
empty one where words are damaged (``damaged``); repeated rows count as often as they
stand; of near words with equal counts the first in code-point order is the form; an
empty table gives an empty result. Texts of any length are read whole, words of any
length compared a few columns at a time; other columns of ``docs`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.llm.rows import bounded, ship
from spintally.llm.tables import compressed, saved

#: Letters of a word: ASCII and Latin-1.
LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_CHARS = 5
MIN_COUNT = 3
#: A word's form occurs at least so many times as often as the word.
FORM_RATIO = 2
PIECES = 3
#: Larger buckets are cut finer. A worker holds one bucket and one Arrow batch.
DENSE = 2048
#: Pairs compared at a time, and the columns of the padded matrices they are compared on.
TILE = 1 << 17
COLUMNS = 16

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PLACE = ["s", "piece", "at", "bucket"]
PAIRS = "word string, near string, near_n long"


def damaged(run: Column, number: Column) -> Column:
    """``run`` without one letter wherever 97 divides ``h``, the CRC-32 of ``number:run``.

    The letter at ``h % length``, counted from 0, is the one that goes.
    """
    text = F.concat_ws(":", F.coalesce(number.cast("string"), F.lit("")), run)
    h = F.crc32(text.cast("binary"))
    size = F.length(run)
    at = (h % size).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    return F.when(h % 97 == 0, shorter).otherwise(run)


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    damage: bool = False,
) -> DataFrame:
    """``(word, n)``: runs of letters, A-Z in lower case, with their number in all texts."""
    found = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(LETTERS), F.lit(0))
    runs = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(found).alias("run"))
    runs = runs.filter(F.length("run") >= min_chars)  # damage only shortens
    lower = F.translate("run", UPPER, UPPER.lower())
    runs = runs.select("id", F.when(F.col("run").rlike("[A-Z]"), lower).otherwise(F.col("run")).alias("run"))
    word = damaged(F.col("run"), F.col("id")) if damage else F.col("run")
    counted = runs.select(word.alias("word")).filter(F.length("word") >= min_chars)
    counted = counted.groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _cut(s: Column, piece: int | Column) -> Column:
    """Where a piece of a word of ``s`` code points begins."""
    return F.floor(s * piece / PIECES).cast("int")


def _remainder(s: Column, low: Column, high: Column) -> Column:
    """Hash of a word without the piece ``[low, high)`` of its form of ``s`` code points."""
    size = F.length("word")
    head = F.substring(F.col("word"), F.lit(1), low)
    tail = F.substring(F.col("word"), size - (s - high) + 1, size)
    return F.xxhash64(s, low, high, head, tail)


def _keyed(words: DataFrame, min_chars: int) -> DataFrame:
    """A row of each word for every piece that may hold the edit, as shorter and as longer word."""
    size = F.length("word")
    roles = F.array(*[F.struct((size - d).alias("s"), F.lit(p).alias("piece"))
                      for d in (0, 1) for p in range(PIECES)])
    made = words.select("word", "n", F.inline(roles)).filter(F.col("s") >= min_chars)
    s, piece = F.col("s"), F.col("piece")
    return made.select(
        "word", "n", "s", "piece", F.lit(-1).alias("at"),
        _remainder(s, _cut(s, piece), _cut(s, piece + 1)).alias("bucket"),
    )


def _finer(keyed: DataFrame) -> DataFrame:
    """A row for each place within the piece instead of one for the piece."""
    s, piece, at = F.col("s"), F.col("piece"), F.col("at")
    places = F.sequence(_cut(s, piece), _cut(s, piece + 1) - 1)
    placed = keyed.withColumn("at", F.explode(places))
    return placed.withColumn("bucket", _remainder(s, at, at + 1)).select(keyed.columns)


def _padded(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: int, back: bool):
    """Code points ``first`` to ``first + COLUMNS`` of every word, from its end if ``back``.

    Cells beyond a word hold zero.
    """
    steps = np.arange(first, first + COLUMNS)
    inside = steps < sizes[:, None]
    place = (starts + sizes - 1)[:, None] - steps if back else starts[:, None] + steps
    return np.where(inside, flat[np.where(inside, place, 0)], 0)


def _common(flat, starts, sizes, left, right, back: bool) -> np.ndarray:
    """Common prefix (suffix if ``back``) of the words ``left`` and ``right``, pair by pair."""
    shorter = np.minimum(sizes[left], sizes[right])
    held = np.zeros(len(left), np.int64)
    live = np.arange(len(left))
    first = 0
    while len(live):
        a, b = left[live], right[live]
        low, high = a.min(), b.max() + 1  # neighbours in the order, so hardly a row too many
        tile = _padded(flat, starts[low:high], sizes[low:high], first, back)
        unlike = tile[a - low] != tile[b - low]
        run = np.where(unlike.any(axis=1), unlike.argmax(axis=1), COLUMNS)
        held[live] += run
        first += COLUMNS
        live = live[(run == COLUMNS) & (shorter[live] > first)]
    return np.minimum(held, shorter)


def _one_edit(flat, starts, sizes, left, right) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs of a shorter and a longer word are one edit apart; their prefix and suffix."""
    prefix = _common(flat, starts, sizes, left, right, back=False)
    suffix = _common(flat, starts, sizes, left, right, back=True)
    near = np.flatnonzero(prefix + suffix >= sizes[right] - 1)
    return near, prefix[near], suffix[near]


def _single_edits(rows: pa.Table) -> pa.RecordBatch:
    """Both directions of the pairs one edit apart in whole buckets, shorter words first in each."""
    words = rows["word"].to_pylist()
    s, piece, at, bucket = (rows[c].to_numpy() for c in PLACE)
    count = len(words)
    sizes = np.fromiter(map(len, words), np.int64, count)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(sizes) - sizes
    fresh = np.ones(count, bool)
    fresh[1:] = _changes(rows)
    ends = np.append(np.flatnonzero(fresh)[1:], count)[np.cumsum(fresh) - 1]
    partners = np.where(sizes == s, ends - np.arange(count) - 1, 0)
    total = np.cumsum(partners)
    lefts, rights = [], []
    for begin in range(0, int(total[-1]), TILE):
        # pairs are numbered row by row; a tile takes the next of them
        pairs = np.arange(begin, min(begin + TILE, int(total[-1])))
        left = np.searchsorted(total, pairs, "right")
        right = left + 1 + pairs - (total[left] - partners[left])
        near, prefix, suffix = _one_edit(flat, starts, sizes, left, right)
        left, right = left[near], right[near]
        size = s[left]
        cuts = np.stack([size * p // PIECES for p in range(PIECES + 1)])
        first = np.argmax((prefix >= cuts[:-1]) & (suffix >= size - cuts[1:]), axis=0)
        place = np.maximum(np.take_along_axis(cuts, first[None], 0)[0], size - 1 - suffix)
        own = (first == piece[left]) & ((at[left] < 0) | (at[left] == place))
        lefts.append(left[own])
        rights.append(right[own])
    left, right = np.concatenate(lefts), np.concatenate(rights)
    column, n = rows["word"].combine_chunks(), rows["n"].to_numpy()
    one, two = np.concatenate([left, right]), np.concatenate([right, left])
    return pa.RecordBatch.from_arrays(
        [column.take(pa.array(one)), column.take(pa.array(two)), pa.array(n[two])],
        names=["word", "near", "near_n"],
    )


def _changes(rows: pa.Table) -> np.ndarray:
    """Whether each row but the first lies in another bucket than the one before it."""
    values = [rows[c].to_numpy() for c in PLACE]
    return np.any([v[1:] != v[:-1] for v in values], axis=0)


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a sorted partition; the bucket that a batch ends in waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        changed = np.flatnonzero(_changes(rows))
        if not len(changed):
            continue
        whole = int(changed[-1]) + 1
        made = _paired_rows(rows.slice(0, whole))
        held = rows.slice(whole).combine_chunks().to_batches()
        if made is not None:
            yield made
    if held:
        made = _paired_rows(pa.Table.from_batches(held))
        if made is not None:
            yield made


def _paired_rows(rows: pa.Table) -> pa.RecordBatch | None:
    """Pairs of whole buckets, or nothing if no bucket has a partner for a shorter word."""
    sizes = np.append(_changes(rows), True)
    alone = sizes & np.append(True, sizes[:-1])
    rows = rows.filter(pa.array(~alone))
    if rows.num_rows < 2:
        return None
    short = rows["size"].to_numpy() == rows["s"].to_numpy()
    if not (short[:-1] & ~_changes(rows)).any():
        return None
    return _single_edits(rows)


def near_pairs(words: DataFrame, min_chars: int = MIN_CHARS, dense: int = DENSE) -> DataFrame:
    """``(word, near, near_n)``: every word with each word one edit away and that one's ``n``.

    ``words`` are distinct, with their number ``n``.
    """
    spark = words.sparkSession
    bounded(spark)
    ship(spark)
    keyed = _keyed(words, min_chars)
    large = saved(keyed.groupBy(*PLACE).count().filter(F.col("count") > dense).select(*PLACE))
    if large.limit(1).count():
        fine = _finer(keyed.join(large, PLACE, "left_semi").select(keyed.columns))
        keyed = keyed.join(large, PLACE, "left_anti").select(keyed.columns).union(fine)
    dealt = (
        keyed.withColumn("size", F.length("word"))
        .repartition(*PLACE)
        .sortWithinPartitions(*PLACE, "size")
    )
    return dealt.mapInArrow(_paired, PAIRS)


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    ratio: int = FORM_RATIO,
    damage: bool = False,
    dense: int = DENSE,
) -> DataFrame:
    """Every word with its form and root: ``word, form, root, n, n_near, form_n``.

    A word's form is the near word of greatest ``n`` if that is ``ratio`` times its own
    or more. Forms grow by that factor from step to step, so following them ends after a
    few steps, at the root. With ``damage`` the rule of ``damaged`` is applied first.
    """
    if ratio < 2:
        raise ValueError("a form occurs at least twice as often as the word")
    words = saved(vocabulary(docs, id_col, text_col, min_chars, min_count, damage))
    pairs = near_pairs(words, min_chars, dense)
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"),
    )
    joined = words.join(best, "word", "left")
    form_n = -F.col("best.rank")
    chosen = form_n >= ratio * F.col("n")
    placed = saved(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(chosen, F.col("best.near")).alias("form"),
            F.when(chosen, form_n).alias("form_n"),
        )
    )
    parents = placed.select(F.col("word").alias("node"), F.coalesce("form", "word").alias("root"))
    roots = compressed(saved(parents))
    return placed.join(roots, F.col("word") == F.col("node")).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )
