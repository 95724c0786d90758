"""Vectorised words of Arrow text columns, as byte positions and 64-bit hashes.

Used inside tasks (``mapInArrow``). Texts are handled in blocks of whole documents of
about ``BLOCK_BYTES`` so that memory is bounded by the block or one document, whichever
is larger. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SLICE_ROWS = 512
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_SEED = np.uint64(0x51ED270B0F1D3C61)

# [^\x20\x09-\x0D]+ on UTF-8 bytes: every byte but the six ASCII spaces.
SPACE_SPLIT = np.ones(256, bool)
SPACE_SPLIT[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, letters, every non-ASCII byte.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_P))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((_P, _P_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


@dataclass
class Block:
    """Words of the documents ``first`` .. ``first + n_docs - 1`` of a batch."""

    first: int
    data: np.ndarray  # bytes of the block
    offsets: np.ndarray  # n_docs + 1 byte offsets
    starts: np.ndarray  # byte position of each word
    ends: np.ndarray
    bounds: np.ndarray  # n_docs + 1 word offsets
    lower: bool

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        """One hash for each word; with ``lower`` A-Z hash as a-z."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        power, inverse = _powers(len(self.data) + 1)
        total = np.cumsum((_BYTE_LOWER if self.lower else _BYTE)[self.data] * power[: len(self.data)], dtype=np.uint64)
        before = np.where(self.starts > 0, total[self.starts - 1], np.uint64(0))
        length = (self.ends - self.starts).astype(np.uint64)
        return mix((total[self.ends - 1] - before) * inverse[self.starts] + length * _SEED)

    def grams(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` words that start at each word; meaningful where ``fits(k)``."""
        out = np.zeros(len(hashes), np.uint64)
        n = len(hashes) - k + 1
        if n > 0:
            acc = np.zeros(n, np.uint64)
            for j in range(k):
                acc = acc * np.uint64(_P) + hashes[j : j + n]
            out[:n] = mix(acc)
        return out

    def fits(self, k: int) -> np.ndarray:
        """Whether ``k`` words of the same document start at each word."""
        n = np.diff(self.bounds)
        return np.arange(len(self.starts)) + k <= np.repeat(self.bounds[1:], n)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string() if pa.types.is_string(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(batches) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``SLICE_ROWS`` rows, so that what is made of a piece doesn't grow with Spark's batch."""
    for batch in batches:
        for at in range(0, len(batch), SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def blocks(column, word_bytes: np.ndarray = SPACE_SPLIT, lower: bool = False) -> Iterator[Block]:
    """The documents of a column, in blocks."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        word = word_bytes[part]
        starts, ends = word.copy(), word.copy()
        if len(part):
            edge = np.zeros(len(part) + 1, bool)
            edge[own] = True
            starts[1:] &= ~word[:-1] | edge[1:-1]
            ends[:-1] &= ~word[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        yield Block(first, part, own, starts, ends, np.searchsorted(starts, own), lower)
        first = last
