"""Quality rules: counts per text and repeated passages found by a suffix array.

The suffixes of all texts of a slice are sorted together by prefix doubling over
their words, each text apart from the others. Neighbours in that order share their
longest common prefix with each other; the intervals of neighbours that share at
least ``min_repeat`` words are the text's maximal repeated passages. Their spans are
united, and a text is turned down if they cover too much of it or one is too long.
Suffixes whose next words occur once leave the sort early, so clean text is cheap.

Defined results: a null, empty or blank text has no words and fails the base rule;
repeated rows are judged alike, one by one; an empty table gives an empty result; kept
columns named like a new one give way to it. Texts are judged whole; besides the words a
few arrays of their length are held, however long the longest repetition is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spintally.llm import ragged, suffixes
from spintally.llm.rows import map_texts

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_WINDOW_PERCENT = 30
#: Shortest passage that counts as repeated, in words.
MIN_REPEAT = 5
#: Largest share of a text's words within repeated passages.
MAX_COVERED = 0.4
#: Longest repeated passage, in words.
MAX_LONGEST = 100

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered long, longest_repeat long"
)


class SortedSuffixes:
    """The suffixes of several word sequences that recur, sorted, with their common prefixes.

    ``least`` is the shortest repetition that will be asked for.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray, least: int = 1):
        self.at = suffixes.repeated_suffixes(words, bounds, least)
        shared = suffixes.common_prefixes(words, bounds, self.at)
        # a suffix shares most with one of its two neighbours in the order
        self.longest = np.maximum(shared, np.append(shared[1:], 0)[: len(shared)])

    def repeated(self, length: int) -> np.ndarray:
        """Positions at which ``length`` words stand that recur in the same text."""
        return self.at[self.longest >= length]

    def longest_repeats(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and lengths of the longest repeated passage from each, from ``least`` words.

        The length is the deepest interval of common prefixes that the suffix lies in.
        """
        keep = self.longest >= least
        return self.at[keep], self.longest[keep]


def covered(starts: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` positions lies in one of the spans."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + sizes, -1)
    return np.cumsum(edges[:-1]) > 0


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    return np.diff(ragged.offsets_of(values)[bounds])


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def counts(texts: list[str], min_repeat: int = MIN_REPEAT) -> list[pa.Array]:
    raw = [text.encode() for text in texts]
    split = [text.split() for text in raw]  # bytes split at \x09-\x0D and \x20 only
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    bounds = ragged.offsets_of(sizes)
    pieces = [word for words in split for word in words]
    bytes_bounds = ragged.offsets_of(np.fromiter(map(len, raw), np.int64, len(raw)))
    data = np.frombuffer(b"".join(raw), np.uint8)
    symbols = per_text(_SYMBOL[data], bytes_bounds)
    following = per_text((data & 0xC0) == 0x80, bytes_bounds)
    word_bytes = per_text(np.fromiter(map(len, pieces), np.int64, len(pieces)), bounds)
    dup_lines = []
    for text in raw:
        lines = [line for line in text.split(b"\n") if line.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    repeat = np.zeros(len(texts), np.int64)
    cover, longest = repeat.copy(), repeat.copy()
    if pieces:
        codes = pa.array(pieces, pa.large_binary()).dictionary_encode().indices.to_numpy()
        least = min(WINDOW, min_repeat)
        ordered = SortedSuffixes(codes.astype(np.int64), bounds, least)
        windows = ordered.repeated(WINDOW)
        repeat = per_text(covered(windows, np.full(len(windows), WINDOW), len(codes)), bounds)
        starts, lengths = ordered.longest_repeats(min_repeat)
        cover = per_text(covered(starts, lengths, len(codes)), bounds)
        np.maximum.at(longest, np.searchsorted(bounds, starts, "right") - 1, lengths)
    made = (sizes, word_bytes - following, symbols, np.array(dup_lines), repeat, cover, longest)
    return [pa.array(values, pa.int64()) for values in made]


def quality(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """``keep`` columns, the counts, ``base_failed`` and ``kept``, one row per input row."""
    made = map_texts(docs, lambda texts: counts(texts, min_repeat), FIELDS, text_col, keep)
    made = made.withColumn(
        "base_failed",
        (made.n_words < MIN_WORDS)
        | (made.n_repeat_words * 100 > made.n_words * MAX_WINDOW_PERCENT),
    )
    repetitive = (made.n_covered > made.n_words * max_covered) | (made.longest_repeat > max_longest)
    return made.withColumn("kept", ~made.base_failed & ~repetitive)
