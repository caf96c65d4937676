"""Byte-level BPE encoding and decoding with a rank file.

A pre-token that is in the vocabulary resolves through a minimal perfect hash over
the vocabulary's byte strings, for all pre-tokens of a slice at once. The rest is
merged over linked bytes, the lowest rank first and the leftmost of equals, with a
heap of candidate pairs. A worker remembers the pre-tokens it has met.

Defined results: a null or empty text has no ids and decodes to no bytes; every row
is encoded by itself, so repeated rows and ids, ties and extra columns change nothing;
kept columns named like a new one give way to it; an empty table gives an empty result.
Texts are encoded whole; memory grows with the longest text.
"""

from __future__ import annotations

import base64
from array import array
from dataclasses import dataclass
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spintally.llm import ragged
from spintally.llm.pretokens import PieceTable, encode_slice
from spintally.llm.rows import map_column, map_texts

#: Pre-tokens that a worker remembers before it starts anew.
MEMO_PIECES = 250_000
EMPTY_SLOT = -1
#: From this many bytes on, links are kept in arrays, which are small but slower.
LONG_PIECE = 1 << 12


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser of splitmix64 (its constants are fixed values)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hash_pieces(data: np.ndarray, offsets: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each non-empty byte string, by a polynomial over its bytes."""
    sizes = np.diff(offsets)
    longest = int(sizes.max(initial=1))
    base = np.uint64(2 * seed + 0x9E3779B97F4A7C15 | 1)
    powers = np.cumprod(np.full(longest, base, np.uint64), dtype=np.uint64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    terms = mixed(data.astype(np.uint64) + np.uint64(1)) * powers[place]
    return mixed(np.add.reduceat(terms, offsets[:-1]) + sizes.astype(np.uint64))


@dataclass(frozen=True)
class PerfectHash:
    """Slots 0..n-1 for n keys: a key's bucket says how to displace it, or names its slot."""

    seed: int
    displaced: np.ndarray

    @staticmethod
    def build(data: np.ndarray, offsets: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The hash and the slot of every key."""
        n = len(offsets) - 1
        seed = 0
        while len(np.unique(hashes := hash_pieces(data, offsets, seed))) < n:
            seed += 1
        buckets: dict[int, list[int]] = {}
        for key, bucket in enumerate((hashes % np.uint64(n)).tolist()):
            buckets.setdefault(bucket, []).append(key)
        displaced, slots, taken = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        order = sorted(buckets.items(), key=lambda item: -len(item[1]))
        free: list[int] | None = None
        for bucket, keys in order:
            if len(keys) == 1:
                if free is None:
                    free = np.flatnonzero(~taken).tolist()
                slot = free.pop()
                displaced[bucket], slots[keys[0]] = -slot - 1, slot
                continue
            shift, own = 0, hashes[keys]
            while True:
                shift += 1
                tried = PerfectHash.moved(own, np.uint64(shift), n)
                if len(np.unique(tried)) == len(keys) and not taken[tried].any():
                    break
            displaced[bucket], slots[keys] = shift, tried
            taken[tried] = True
        return PerfectHash(seed, displaced), slots

    @staticmethod
    def moved(hashes: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
        step = np.atleast_1d(shift) * np.uint64(0xD1B54A32D192ED03)
        return (mixed(hashes + step) % np.uint64(n)).astype(np.int64)

    def slots(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The only slot in which each string can be; the caller compares the bytes."""
        n = len(self.displaced)
        hashes = hash_pieces(data, offsets, self.seed)
        shift = self.displaced[(hashes % np.uint64(n)).astype(np.int64)]
        moved = self.moved(hashes, np.maximum(shift, 0).astype(np.uint64), n)
        return np.where(shift < 0, -shift - 1, moved)


class Vocabulary:
    """Ranks of byte strings, their perfect hash, and the byte strings by id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        keys = list(ranks)
        data = np.frombuffer(b"".join(keys), np.uint8)
        offsets = ragged.offsets_of(np.fromiter(map(len, keys), np.int64, len(keys)))
        self.hash, slots = PerfectHash.build(data, offsets)
        by_slot = np.argsort(slots)
        self.sizes = np.diff(offsets)[by_slot]
        self.data = ragged.take(data, offsets[:-1][by_slot], self.sizes)
        self.starts = ragged.offsets_of(self.sizes)[:-1]
        self.ids = np.fromiter(ranks.values(), np.int64, len(keys))[by_slot]
        self.slot_of_id = np.full(int(self.ids.max()) + 1, EMPTY_SLOT)
        self.slot_of_id[self.ids] = np.arange(len(keys))
        self.table = PieceTable(MEMO_PIECES, self.encode_pieces)

    @staticmethod
    def parse(rank_file: bytes) -> Vocabulary:
        lines = (line.split() for line in rank_file.splitlines() if line)
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in lines})

    def whole(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Id of each string that is in the vocabulary as it stands, else -1."""
        slots = self.hash.slots(data, offsets)
        sizes = np.diff(offsets)
        same = self.sizes[slots] == sizes
        near = np.flatnonzero(same)
        own = ragged.take(data, offsets[:-1][near], sizes[near])
        known = ragged.take(self.data, self.starts[slots[near]], sizes[near])
        if len(near):
            begins = ragged.offsets_of(sizes[near])[:-1]
            same[near] = np.logical_and.reduceat(own == known, begins)
        return np.where(same, self.ids[slots], -1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by merging neighbours, lowest rank first."""
        rank, size = self.ranks.get, len(piece)
        linked = list if size < LONG_PIECE else partial(array, "q")
        after = linked(range(1, size + 1))  # start of the next part; 0 once merged away
        before = linked(range(-1, size - 1))
        # A candidate is one number, ordered by rank and then by place: rank, left part, end.
        bits = size.bit_length()
        high, mask = 2 * bits, (1 << bits) - 1
        heap = [
            found << high | i << bits | i + 2
            for i in range(size - 1)
            if (found := rank(piece[i : i + 2])) is not None
        ]
        heapify(heap)
        while heap:
            candidate = heappop(heap)
            left, end = candidate >> bits & mask, candidate & mask
            right = after[left]
            if not right or right >= size or after[right] != end:
                continue  # one of the two has since been merged with another part
            after[left], after[right] = end, 0
            if end < size:
                before[end] = left
                if (found := rank(piece[left : after[end]])) is not None:
                    heappush(heap, found << high | left << bits | after[end])
            if (first := before[left]) >= 0 and (found := rank(piece[first:end])) is not None:
                heappush(heap, found << high | first << bits | end)
        ids, at = [], 0
        while at < size:
            ids.append(self.ranks[piece[at : after[at]]])
            at = after[at]
        return ids

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens and the number of each."""
        data, offsets = ragged.flat(pa.array(pieces, pa.large_string()))
        ids = self.whole(data, offsets)
        raw, sizes, parts = data.tobytes(), np.ones(len(ids), np.int64), []
        missed = np.flatnonzero(ids < 0)
        for i, begin, end in zip(missed.tolist(), offsets[missed].tolist(), offsets[missed + 1].tolist()):
            merged = self.merge(raw[begin:end])
            sizes[i] = len(merged)
            parts += merged
        out = np.empty(int(sizes.sum()), np.uint32)
        inside = np.repeat(ids < 0, sizes)
        out[inside] = parts
        out[~inside] = ids[ids >= 0]
        return out, sizes

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids and the size of each; an id without a string raises."""
        if len(ids) and (ids.max() >= len(self.slot_of_id) or self.slot_of_id[ids].min() < 0):
            raise ValueError("an id is not in the vocabulary")
        slots = self.slot_of_id[ids]
        return ragged.take(self.data, self.starts[slots], self.sizes[slots]), self.sizes[slots]


@lru_cache(maxsize=2)
def vocabulary(rank_file: bytes) -> Vocabulary:
    """One per worker: the file has a fixed size and is part of the task."""
    return Vocabulary.parse(rank_file)


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    held = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def compute(texts):
        ids, counts = encode_slice(texts, pattern, vocabulary(held.value).table)
        return [
            pa.array(counts, pa.int64()),
            ragged.binaries(ids.astype("<u4"), 4 * ragged.offsets_of(counts)),
        ]

    return map_texts(docs, compute, "n_tokens long, ids binary", text_col, keep)


def decode(
    encoded: DataFrame,
    rank_path: str,
    ids_col: str = "ids",
    keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids"),
) -> DataFrame:
    """``keep`` columns and ``decoded``, the bytes the ids stand for (null ids: no bytes)."""
    held = encoded.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def compute(column):
        data, offsets = ragged.flat(column.fill_null(b""))
        ids = np.frombuffer(data.tobytes(), "<u4")
        out, sizes = vocabulary(held.value).bytes_of(ids)
        ends = ragged.offsets_of(sizes)
        return [ragged.binaries(out, ends[offsets // 4])]

    return map_column(encoded, compute, "decoded binary", ids_col, keep)
