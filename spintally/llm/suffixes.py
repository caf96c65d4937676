"""Sorted suffixes of several word sequences, and the prefixes that neighbours share.

Prefix doubling ranks the suffixes by their first 1, 2, 4, ... words, the sequences
apart from each other; suffixes whose next words occur once leave the sort early.
One rank array is held at a time, and common prefixes come from comparing words:
where a suffix and its neighbour are preceded by the same word, the prefix is one
shorter than that of the position before, so only the other positions are compared.
"""

from __future__ import annotations

import numpy as np

#: Words compared at a time when common prefixes are measured.
COMPARED = 1 << 18


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, whether each in order begins a group, and the group's first place."""
    order = np.argsort(key, kind="stable")
    by_key = key[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = by_key[1:] != by_key[:-1]
    return order, fresh, np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))


def repeated_suffixes(words: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Positions in the order of their suffixes, those with ``least`` words that recur.

    ``words`` are codes, ``bounds`` the places where the sequences begin and the last one
    ends. A suffix is compared with suffixes of its own sequence only; a sequence's
    positions stand together. ``least`` is rounded down to a power of two, so a few
    positions more may come, but none is missing.
    """
    n = len(words)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ends = bounds[1:][text]
    rank = np.zeros(n, np.int64)
    order, fresh, group = _ranked(text * (int(words.max(initial=0)) + 1) + words)
    rank[order] = group
    active = order[~(fresh & np.append(fresh[1:], True))] if n else order
    length = 1
    kept = active
    while len(active):
        then = active + length
        inside = then < ends[active]
        second = np.where(inside, rank[np.minimum(then, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order, fresh, group = _ranked(key)
        old = rank[active][order]
        turn = np.ones(len(order), bool)
        turn[1:] = old[1:] != old[:-1]
        at = active[order]
        rank[at] = old + group - np.maximum.accumulate(np.where(turn, np.arange(len(at)), 0))
        active = at[~(fresh & np.append(fresh[1:], True))]
        length *= 2
        if length <= least:
            kept = active
    return kept[np.argsort(rank[kept], kind="stable")]


def _matching(words: np.ndarray, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal words from ``left`` and ``right`` on, at most ``most``, pair by pair."""
    held = np.zeros(len(left), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        width = max(8, COMPARED // len(live))
        for first in range(0, len(live), max(1, COMPARED // width)):
            own = live[first : first + max(1, COMPARED // width)]
            reach = min(width, int((most[own] - held[own]).max()))
            steps = np.arange(reach)
            room = steps < (most[own] - held[own])[:, None]
            a = np.minimum((left[own] + held[own])[:, None] + steps, len(words) - 1)
            b = np.minimum((right[own] + held[own])[:, None] + steps, len(words) - 1)
            same = room & (words[a] == words[b])
            run = np.where(same.all(axis=1), reach, same.argmin(axis=1))
            held[own] += run
            # a pair goes on if all it had room for was equal and words are left
            most[own] = np.where(run == reach, most[own], held[own])
        live = live[held[live] < most[live]]
    return held


def common_prefixes(words: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words that each of the ordered suffixes ``at`` shares with the one before it.

    Zero where the two belong to different sequences. Words beyond the first that two
    suffixes do not share are never read, and a prefix known from the position before
    is not measured again.
    """
    n = len(words)
    shared = np.zeros(len(at), np.int64)
    if len(at) < 2:
        return shared
    text = np.searchsorted(bounds, at, "right") - 1
    before = np.full(n, -1, np.int64)  # of each position, the suffix before it in the order
    same_text = text[1:] == text[:-1]
    before[at[1:][same_text]] = at[:-1][same_text]
    here = np.sort(at[1:][same_text])
    there = before[here]
    # one less than at the position before, where the pair there is this one moved back by a word
    follows = np.append(False, (here[1:] == here[:-1] + 1) & (there[1:] == there[:-1] + 1))
    known = follows & (words[here - 1] == words[there - 1])
    ends = bounds[np.searchsorted(bounds, here, "right")]
    most = ends - np.maximum(here, there)
    measured = np.flatnonzero(~known)
    values = np.zeros(len(here), np.int64)
    values[measured] = _matching(words, here[measured], there[measured], most[measured])
    base = np.maximum.accumulate(np.where(known, 0, np.arange(len(here))))
    values = values[base] - (np.arange(len(here)) - base)
    prefix = np.zeros(n, np.int64)
    prefix[here] = values
    shared[1:][same_text] = prefix[at[1:][same_text]]
    return shared
