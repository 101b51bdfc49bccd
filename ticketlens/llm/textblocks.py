"""Words and rolling hashes of whole texts, as arrays over Arrow's own buffers.

Everything here works on the UTF-8 bytes of many documents at once, in blocks
of a few megabytes, so a task's memory does not depend on the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1024

_SEED = np.random.default_rng(20_240_229)
#: A random odd number for each byte value, and the base of the polynomial.
BYTE_CODE = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_SEED.integers(1 << 61, 1 << 63)) | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)

#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: True for every byte that is not white space: 0x20 and 0x09-0x0D separate words.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


@dataclass
class Block:
    """Some consecutive rows of an Arrow batch: their bytes joined, and where each row begins and ends."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def blocks(texts: pa.Array, most: int = BLOCK_BYTES, most_rows: int = BLOCK_ROWS) -> Iterator[Block]:
    """The rows of a text column in blocks of about `most` bytes; a longer text has a block of its own. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        to = min(to, len(texts), at + most_rows)
        yield Block(at, whole[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
        at = to


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of SplitMix64)."""
    out = values ^ (values >> np.uint64(30))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


class Hasher:
    """Polynomial hashes of any pieces of a byte array, from prefix sums modulo 2 ** 64."""

    def __init__(self) -> None:
        self._up = powers(BASE, 1)
        self._down = powers(BASE_INVERSE, 1)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self._up) <= len(data):
            self._up, self._down = powers(BASE, len(data) + 1), powers(BASE_INVERSE, len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODE[data] * self._up[: len(data)], out=sums[1:], dtype=np.uint64)
        return sums

    def pieces(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash per piece [start, end); equal bytes have equal hashes wherever they stand."""
        raw = (sums[ends] - sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def spans(block: Block, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and the word count of each row. No word crosses rows."""
    mask = inside[block.data]
    n = len(mask)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(block.rows, dtype=np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[block.bounds] = True
    begins, stops = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1] | edge[1:n]
    stops[:-1] &= ~mask[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    counts = np.diff(np.searchsorted(starts, block.bounds))
    return starts, ends, counts


def sum_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive runs of `counts` values, 0 for an empty run."""
    sums = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]
