"""UTF-8 texts of Arrow batches as flat numpy arrays: chunks, words, hashes and sums per text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII characters other than letters and digits.
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
#: The same with A-Z read as a-z.
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of a string array; null counts as empty."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(batches, name: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of record batches with the bytes and offsets of their texts."""
    for batch in batches:
        data, offsets = utf8(batch.column(name))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the slices between offsets; an empty slice gives 0."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind in "fu" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def words(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than separators (ASCII white space by default), and the
    words' offsets per text."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~between[data]
    begin = inside[:-1].copy()
    begin[1:] &= ~inside[:-2]
    stop = inside[:-1] & ~inside[1:]
    edges = offsets[1:-1]
    first = edges[edges < len(data)]
    begin[first] = inside[first]
    last = edges[edges > 0] - 1
    stop[last] = inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class PrefixHash:
    """Polynomial hash, modulo 2**64, of any slice of the bytes from one pass over them."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES):
        size = 1 << max(16, (len(data) + 1).bit_length())
        self.up, self.down = _powers(size)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * self.up[: len(data)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def grams(self, width: int) -> np.ndarray:
        """Hashes of all slices of ``width`` bytes, in order."""
        n = len(self.total) - 1
        if n < width:
            return np.zeros(0, np.uint64)
        return mix((self.total[width:] - self.total[:-width]) * self.down[: n - width + 1])


def owners(offsets: np.ndarray) -> np.ndarray:
    """Number of the text that each element between offsets belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts and their offsets."""
    lead = (data & 0xC0) != 0x80
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=before[1:])
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, before[offsets]
