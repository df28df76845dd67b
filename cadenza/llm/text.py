"""Words of an Arrow string column as numpy arrays (helpers that run inside tasks).

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``.  All work is vectorised
over a whole column of documents: no Python object is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Polynomial hash over 64 bits: a random value per byte times a power of an odd base.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}
STRETCH = 1 << 18


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n-1)`` modulo 2**64; kept per worker and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.ones(max(1024, n), np.uint64)
        size = 1
        while size < len(out):
            step = min(size, len(out) - size)
            out[size:size + step] = out[:step] * np.uint64(pow(base, size, 1 << 64))
            size += step
        _POWERS[base] = have = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is a text without bytes."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` for bytes; several times faster than by index."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), np.uint8)


class Words:
    """Word boundaries of every text of a column.

    ``starts`` / ``ends``: byte positions in ``data``; words of document ``d`` are
    ``ptr[d]:ptr[d + 1]``.  ``lower`` folds A-Z only.
    """

    def __init__(self, column, lower: bool = False):
        self.data, self.offsets = utf8_buffer(column)
        if lower:
            self.data = _mapped(self.data, _LOWER)
        n = len(self.data)
        solid = ~_mapped(self.data, _SPACE).view(bool)
        cut = np.zeros(n + 1, bool)               # a text begins here (or the buffer ends)
        cut[self.offsets] = True
        before = np.ones(n, bool)                 # nothing solid of this text stands before
        after = np.ones(n, bool)
        if n:
            before[1:] = ~solid[:-1]
            before |= cut[:-1]
            after[:-1] = ~solid[1:]
            after |= cut[1:]
        self.starts = np.flatnonzero(solid & before)
        self.ends = np.flatnonzero(solid & after) + 1
        self.ptr = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def docs(self) -> np.ndarray:
        """Document index of each word."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def hashes(self, fold: bool = False) -> np.ndarray:
        """64-bit hash of each word (with ``fold`` as if A-Z were folded); equal words have equal hashes in every task."""
        value, out = _BYTE_VALUE[_LOWER] if fold else _BYTE_VALUE, np.empty(len(self), np.uint64)
        i = 0
        while i < len(self):                          # runs of words of about STRETCH bytes keep the arrays small
            base = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, base + STRETCH, "right")))
            starts, ends = self.starts[i:j] - base, self.ends[i:j] - base
            n = int(ends[-1])
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(value[self.data[base:base + n]] * powers(_BASE, n), out=sums[1:])
            out[i:j] = (sums[ends] - sums[starts]) * powers(_BASE_INV, n)[starts]
            i = j
        return mix(out + (self.ends - self.starts).astype(np.uint64))

    def text(self, d: int) -> list[bytes]:
        """The words of one document."""
        return self.data[self.offsets[d]:self.offsets[d + 1]].tobytes().split()

    def slices(self, d: int, gone: np.ndarray) -> bytes:
        """The text of one document without the words marked ``gone``: a space at each cut, else as it was."""
        whole = self.data[self.offsets[d]:self.offsets[d + 1]].tobytes()
        if not gone.any():
            return whole
        edge = np.diff(np.concatenate([[0], (~gone).view(np.int8), [0]]))
        a, b, base = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), int(self.offsets[d])
        starts, ends = self.starts[self.ptr[d]:self.ptr[d + 1]], self.ends[self.ptr[d]:self.ptr[d + 1]]
        return b" ".join(whole[int(starts[x]) - base:int(ends[y - 1]) - base] for x, y in zip(a, b))


_GRAM = 0xD1B54A32D192ED03
_GRAM_INV = pow(_GRAM, -1, 1 << 64)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words from each position (ignoring document ends)."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * powers(_GRAM, n), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * powers(_GRAM_INV, n)[:n - k + 1])


def inside(ptr: np.ndarray, k: int) -> np.ndarray:
    """For each start of ``k`` consecutive words: whether they lie in one document."""
    n = int(ptr[-1])
    if n < k:
        return np.zeros(0, bool)
    left = np.repeat(ptr[1:], np.diff(ptr)) - np.arange(n)   # words left in the document
    return left[:n - k + 1] >= k
