"""Vectorised hashing of texts inside tasks: whole Arrow batches, no loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are hashed at once; a longer document is hashed alone.
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """The finalizer of the public splitmix64 generator: a bijection that spreads all bits."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, CHUNK_BYTES + 1)
            inverse = pow(_BASE, -1, 1 << 64)
            factors = [np.full(size, f, dtype=np.uint64) for f in (_BASE, inverse)]
            for f in factors:
                f[0] = 1
            self.up, self.down = (np.multiply.accumulate(f) for f in factors)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class RangeHash:
    """Hashes of any byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = _POWERS.upto(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[data] * up[: len(data)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start])


def text_buffers(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``first row, bytes, offsets`` of consecutive pieces of a string column without NULLs.

    A piece holds about ``CHUNK_BYTES``, or one longer document.
    """
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        part = offsets[row : last + 1].astype(np.int64)
        yield row, data[part[0] : part[-1]], part - part[0]
        row = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the white-space separated words of all documents."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | border[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | border[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``words before each document (and all), hash of each word``."""
    starts, ends = word_spans(data, offsets)
    return np.searchsorted(starts, offsets), RangeHash(data).of(starts, ends)


def shingles(before: np.ndarray, words: np.ndarray, size: int = 3) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its windows of ``size`` words.

    A document with fewer words has one, for the whole sequence; one without words has none.
    """
    salts = mix(np.arange(1, size + 1, dtype=np.uint64))
    chain = [words]
    for n in range(1, size):
        # chain[n][i] is the hash of n + 1 words from word i on.
        chain.append(mix(chain[-1][:-1] * np.uint64(3) + words[n:] + salts[n]))
    found = []
    for a, b in zip(before[:-1], before[1:], strict=True):
        n = int(min(b - a, size))
        found.append(np.unique(chain[n - 1][a : b - n + 1]) if n else np.empty(0, dtype=np.uint64))
    return found
