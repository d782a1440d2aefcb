"""Words of many texts at once, as spans and 64-bit hashes over one UTF-8 buffer.

Python loops over words would dominate every operator that reads whole texts. These
helpers work on the byte buffer of an Arrow string column with numpy instead. Memory is
bounded by the chunk of texts handled at a time; a text longer than a chunk is a chunk of
its own and never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1

#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets that bound them; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi`` of about ``limit`` bytes at a time, with their bytes and offsets."""
    data, offsets = text_buffer(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(kept: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of kept bytes within each text: starts, ends, and the n + 1 run numbers per text."""
    n = len(kept)
    bounds = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = kept[:-1]
    before[bounds] = False
    after = np.zeros(n, bool)
    after[:-1] = kept[1:]
    after[bounds - 1] = False
    starts = np.flatnonzero(kept & ~before)
    ends = np.flatnonzero(kept & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    full = np.full(n, _BASE, np.uint64)
    inverse = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    full[0] = inverse[0] = 1
    return np.cumprod(full, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


class SpanHasher:
    """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand."""

    def __init__(self, seed: int = 7) -> None:
        self.of_byte = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.up, self.down = _powers(_BLOCK + 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Spans must not overlap and must be in order."""
        out = np.empty(len(starts), np.uint64)
        lo = 0
        while lo < len(starts):
            base = int(starts[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, base + _BLOCK, "right")))
            size = int(ends[hi - 1]) - base
            if size >= len(self.up):
                self.up, self.down = _powers(size + 1)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(self.of_byte[data[base : base + size]] * self.up[:size], out=sums[1:])
            at = starts[lo:hi] - base
            out[lo:hi] = (sums[ends[lo:hi] - base] - sums[at]) * self.down[at]
            lo = hi
        return mix(out)
