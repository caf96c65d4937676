"""Texts cut into pre-tokens, each distinct one encoded once per slice of rows.

The tokenizer libraries know an older Unicode version than ``regex``. Texts with
characters that only the newer one counts as letters or numbers are cut by a pattern
that leaves those out. Texts of early code points only, most of the Latin ones, are cut
by the standard library's faster engine, with the classes written out as ranges.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from itertools import repeat

import numpy as np
import regex
import tiktoken

from spintally.llm import ragged

#: How the patterns of byte-level vocabularies begin, and the same with the frequent case first.
ENDINGS_FIRST = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+|"
WORDS_FIRST = r" ?\p{L}+|'(?:s|t|re|ve|m|ll|d)|"
CLASSES = (r"\p{L}", r"\p{N}")
#: No character below this one differs between the Unicode versions.
SETTLED = 0x0530


@lru_cache(maxsize=1)
def unsettled() -> str:
    """Ranges of characters that are in a class for ``regex`` but not for the libraries."""
    every = "".join(chr(c) for c in range(SETTLED, 0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([byte]): byte for byte in range(256)}
    newer: set[str] = set()
    for name in CLASSES:
        theirs = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={})
        newer |= set(regex.findall(name, every))
        newer -= set(bytes(theirs.encode_ordinary(every)).decode())
    points = np.array(sorted(map(ord, newer)))
    return ranges(points)


def ranges(points: list[int]) -> str:
    runs = np.split(np.array(points), np.flatnonzero(np.diff(points) > 1) + 1)
    return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs if len(run))


@lru_cache(maxsize=4)
def compiled_early(pattern: str) -> re.Pattern | None:
    """The pattern for texts below ``SETTLED``; None if it has classes other than these."""
    early = [chr(c) for c in range(SETTLED)]
    inside = {
        name: ranges([ord(c) for c in early if regex.match(name, c)]) for name in (*CLASSES, r"\s")
    }
    if pattern.startswith(ENDINGS_FIRST):  # no piece can begin both ways, and words are far more
        pattern = WORDS_FIRST + pattern[len(ENDINGS_FIRST) :]
    out, at, in_set = [], 0, False
    while at < len(pattern):
        name = next((n for n in (*inside, r"\S") if pattern.startswith(n, at)), None)
        if name == r"\S" and not in_set:
            out.append(f"[^{inside[r'\s']}]")
        elif name in inside:
            out.append(inside[name] if in_set else f"[{inside[name]}]")
        elif name or pattern[at] == "\\":
            return None
        else:
            out.append(pattern[at])
            in_set = pattern[at] == "[" or in_set and pattern[at] != "]"
        at += len(name or " ")
    return re.compile("".join(out))


def is_early(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return ord(max(text)) < SETTLED
    return True


@lru_cache(maxsize=4)
def compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


@lru_cache(maxsize=4)
def compiled_older(pattern: str) -> regex.Pattern:
    if unsettled():
        for name in CLASSES:
            pattern = pattern.replace(name, f"[{name}--[{unsettled()}]]")
    return regex.compile(pattern, regex.V1)


def cut(texts: list[str], pattern: str) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of all texts and their number per text."""
    early = compiled_early(pattern) or compiled(pattern)
    pieces, counts = [], np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        found = (early if is_early(text) else compiled_older(pattern)).findall(text)
        counts[row] = len(found)
        pieces += found
    return pieces, counts


class PieceTable:
    """A worker's ids of the pieces it has met; starts anew once it holds ``limit`` of them.

    ``encode`` gets distinct pieces and gives their ids and how many each has.
    """

    def __init__(self, limit: int, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.limit, self.encode = limit, encode
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def places(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))

    def learn(self, pieces: list[str]) -> None:
        ids, sizes = self.encode(pieces)
        first = len(self.starts)
        self.place.update(zip(pieces, range(first, first + len(pieces))))
        self.starts = np.append(self.starts, len(self.ids) + ragged.offsets_of(sizes)[:-1])
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, ids)

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and the number of each."""
        if len(self.place) >= self.limit:
            self.clear()
        distinct, which = ragged.distinct(pieces)
        at = self.places(distinct)
        missed = np.flatnonzero(at < 0)
        if len(missed):
            first = len(self.starts)
            self.learn([distinct[i] for i in missed.tolist()])
            at[missed] = np.arange(first, len(self.starts))
        at = at[which]
        sizes = self.sizes[at]
        return ragged.take(self.ids, self.starts[at], sizes), sizes


def encode_slice(
    texts: list[str], pattern: str, table: PieceTable
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and their number per text."""
    pieces, counts = cut(texts, pattern)
    ids, sizes = table.ids_of(pieces)
    return ids, np.diff(ragged.offsets_of(sizes)[ragged.offsets_of(counts)])
