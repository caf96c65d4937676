"""Arrays of arrays as flat values plus offsets, in numpy and Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def offsets_of(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def take(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + size]`` one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0]
    index = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
    return values[index]


def distinct(pieces: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct strings, and which of them each piece is."""
    known = pa.array(pieces, pa.large_string()).dictionary_encode()
    return known.dictionary.to_numpy(zero_copy_only=False).tolist(), known.indices.to_numpy()


def binaries(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column of the pieces of ``data`` between byte ``offsets``."""
    if len(offsets) and offsets[-1] > np.iinfo(np.int32).max:
        raise ValueError("a slice of rows holds over 2 GB")
    return pa.BinaryArray.from_buffers(
        pa.binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)],
    )


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Memo(dict):
    """A worker's results for repeated pieces; starts anew once it holds ``limit`` of them."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def __setitem__(self, key, value):
        if len(self) >= self.limit:
            self.clear()
        super().__setitem__(key, value)
