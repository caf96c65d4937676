"""Periodic runs of words: descending-LCP Kruskal over the suffixes of each text.

The suffixes of a text are sorted, and neighbours in that order are edges weighted by
the words they share. The edges are taken by decreasing weight; each unites two classes
of positions at which the same words stand, kept as ordered position sets under a
union-find, the smaller one entered into the larger. Two positions that become adjacent
in a united set at a distance within the weight are the start of a repetition with that
distance as its period: no third occurrence lies between them, so the period is the
smallest one. A seed whose neighbouring word on the left breaks the period begins a run.

A run of ``length`` words shares ``length - period`` of them with itself one period on,
so edges lighter than the lightest run allows are never sorted, and text that repeats no
such passage costs the first doublings of the sort only.

Defined results: a null, empty or blank text has no words and no runs, its digests are
those of the empty string; a null id leaves a text as it is (``rewritten``); repeated
rows get equal results, one row each; of runs with equal exponent the first, then the
shortest period, is reported; columns of ``docs`` named like a new one give way to it;
an empty table gives an empty result. A text is worked on whole, with memory in
proportion to its words.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.llm import ragged, suffixes
from spintally.llm.rows import map_texts

#: A run is at least so many words long ...
MIN_LENGTH = 24
#: ... and at least so many times its period.
MIN_EXPONENT = 3

FIELDS = (
    "n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, "
    "collapsed_sha256 string"
)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Run = tuple[int, int, int]


class Classes:
    """Positions united to classes, each an ordered list under its union-find root."""

    def __init__(self):
        self.above: dict[int, int] = {}
        self.members: dict[int, list[int]] = {}

    def root(self, position: int) -> int:
        above = self.above
        top = position
        while (up := above.get(top, top)) != top:
            top = up
        while position != top:  # the next search from here is one step
            above[position], position = top, above.get(position, top)
        return top

    def unite(self, a: int, b: int) -> list[tuple[int, int]]:
        """Unite the classes of two positions; the pairs that thereby became adjacent."""
        a, b = self.root(a), self.root(b)
        large = self.members.pop(a, None) or [a]
        small = self.members.pop(b, None) or [b]
        if len(large) < len(small):
            large, small, a, b = small, large, b, a
        adjacent = []
        entered = -1  # place of the position that was entered last
        for k, position in enumerate(small, 1):
            at = bisect_left(large, position, entered + 1)
            if at > entered + 1:
                adjacent.append((large[at - 1], position))
            if at < len(large) and (k == len(small) or small[k] > large[at]):
                adjacent.append((position, large[at]))
            large.insert(at, position)
            entered = at
        self.above[b] = a
        self.members[a] = large
        return adjacent


def find_runs(
    words: np.ndarray,
    bounds: np.ndarray,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> list[Run]:
    """``(start, length, period)`` of every run, by start and then period.

    ``words`` are codes of several texts one after the other, ``bounds`` where the texts
    begin and the last one ends; runs do not cross them. A run needs ``min_exponent``,
    3 at least: below it, a seed's distance need not be its smallest period.
    """
    if min_exponent < 3:
        raise ValueError("runs are found from three periods on")
    # length >= min_length and length >= e * period leave this many words shared, or more
    least = max(1, min_length - min_length // min_exponent)
    at = suffixes.repeated_suffixes(words, bounds, least)
    shared = suffixes.common_prefixes(words, bounds, at)
    heavy = np.flatnonzero(shared >= least)
    heavy = heavy[np.argsort(-shared[heavy], kind="stable")]
    first = bounds[np.searchsorted(bounds, at[heavy], "right") - 1]
    classes, found = Classes(), []
    edges = zip(
        at[heavy - 1].tolist(), at[heavy].tolist(), shared[heavy].tolist(), first.tolist()
    )
    for a, b, weight, begin in edges:
        for i, j in classes.unite(a, b):
            period = j - i
            if (
                weight >= (min_exponent - 1) * period
                and weight + period >= min_length
                and (i == begin or words[i - 1] != words[j - 1])
            ):
                found.append((i, weight + period, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length over period; the first, then the shortest period, of equals."""
    best = None
    for run in runs:  # by start and then period, so only a greater exponent displaces one
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def dropped(runs: list[Run], n: int) -> np.ndarray:
    """Whether each of ``n`` words lies in a run after that run's first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def analysed(texts: list[str], min_length: int, min_exponent: int) -> list[pa.Array]:
    split = [text.encode().split() for text in texts]  # bytes split at \x09-\x0D and \x20 only
    bounds = ragged.offsets_of(np.fromiter(map(len, split), np.int64, len(split)))
    pieces = [word for words in split for word in words]
    codes = pa.array(pieces, pa.large_binary()).dictionary_encode().indices.to_numpy()
    codes = codes.astype(np.int64)
    of_text: list[list[Run]] = [[] for _ in texts]
    begins = bounds[:-1]
    for start, length, period in find_runs(codes, bounds, min_length, min_exponent):
        text = int(np.searchsorted(bounds, start, "right")) - 1
        of_text[text].append((start - int(begins[text]), length, period))
    best = [strongest(runs) for runs in of_text]
    columns = [pa.array([len(runs) for runs in of_text], pa.int64())]
    for value in (
        lambda run: run[0], lambda run: run[1], lambda run: run[2],
        lambda run: 1000 * run[1] // run[2],
    ):
        columns.append(pa.array([run and value(run) for run in best], pa.int64()))
    columns.append(
        pa.array([[dict(zip(RUN.names, run)) for run in runs] for runs in of_text], pa.list_(RUN))
    )
    lines = ["".join(f"{a},{n},{q}\n" for a, n, q in runs) for runs in of_text]
    columns.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines]))
    digests = []
    for words, runs in zip(split, of_text):
        if runs:
            gone = dropped(runs, len(words)).tolist()
            words = [word for word, out in zip(words, gone) if not out]
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    columns.append(pa.array(digests))
    return columns


def periodic_runs(
    docs: DataFrame,
    text_col: str = "text",
    keep: Iterable[str] = ("doc_id",),
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``keep`` and, of each row's text, all its ``runs``, the strongest one and two digests.

    Words are what stands between ASCII white space, numbered from 0. ``start``,
    ``length``, ``period`` and ``exponent_milli`` are those of the strongest run, null if
    there is none. ``collapsed_sha256`` is of the words that no run drops, joined by one
    space; a run drops its words after the first period.
    """
    return map_texts(
        docs, lambda texts: analysed(texts, min_length, min_exponent), FIELDS, text_col, keep
    )


def collapsed(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each run cut to its first period; a text without runs stays as it is."""

    def cut(texts):
        split = [text.encode().split() for text in texts]
        bounds = ragged.offsets_of(np.fromiter(map(len, split), np.int64, len(split)))
        pieces = [word for words in split for word in words]
        codes = pa.array(pieces, pa.large_binary()).dictionary_encode().indices.to_numpy()
        runs = find_runs(codes.astype(np.int64), bounds, **options)
        gone = dropped(runs, len(pieces))
        out = []
        for text, words, a, b in zip(texts, split, bounds, bounds[1:]):
            own = gone[a:b]
            if own.any():
                text = b" ".join(w for w, x in zip(words, own.tolist()) if not x).decode()
            out.append(text)
        return [pa.array(out, pa.string())]

    others = [c for c in docs.columns if c != text_col]
    return map_texts(docs, cut, f"`{text_col}` string", text_col, others).select(*docs.columns)


def rewritten(text: Column, number: Column) -> Column:
    """``text``, periodic from some word on in the rows whose ``number`` asks for it.

    With ``h`` the CRC-32 of the number's decimal form, ``g = h div 10`` and ``n`` words:
    where ``h % 10 = 0``, each word ``i`` from ``a = g % n`` on becomes word
    ``a + (i - a) % p``, ``p = 1 + (n - a) div (3 + g % 8)``, and words are joined by one space.
    """
    h = F.crc32(number.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words).cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    again = F.flatten(F.array_repeat(_part(words, a, p), F.ceil((n - a) / p).cast("int")))
    made = F.concat(_part(words, F.lit(0), a), _part(again, F.lit(0), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(made, " ")).otherwise(text)


def _part(array: Column, first: Column, size: Column) -> Column:
    return F.slice(array, (first + 1).cast("int"), size.cast("int"))
