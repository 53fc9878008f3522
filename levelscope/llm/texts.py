"""Texts of Arrow batches as flat byte arrays: words, word hashes, hashes of runs of words.

All functions work on a ``Block``: the bytes of some whole texts, one after the other. Nothing is
cut; a text longer than the block size is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
U64 = np.uint64
#: Odd multipliers of the polynomial hashes (any would do).
BYTE_BASE = 0x9E3779B97F4A7C15
RUN_BASES = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
MASK = (1 << 64) - 1

#: Bytes of words that end at a blank, tab or line break.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words made of ASCII letters and digits and of all that is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Block:
    """Whole texts: rows ``first`` to ``first + len(bounds) - 1`` of a batch."""

    first: int
    data: np.ndarray  # uint8
    bounds: np.ndarray  # int64, one more than texts

    def __len__(self) -> int:
        return len(self.bounds) - 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its texts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    n, at = len(column), column.offset
    bounds = np.frombuffer(offsets, np.int64)[at : at + n + 1] if n else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat, bounds


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    data, bounds = utf8(column)
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        yield Block(i, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    shifted = x >> U64(30)
    x = x ^ shifted
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, U64(27), out=shifted)
    x *= U64(0x94D049BB133111EB)
    x ^= np.right_shift(x, U64(31), out=shifted)
    return x


@lru_cache(maxsize=16)
def _powers(base: int, log_size: int) -> np.ndarray:
    out = np.full(1 << log_size, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64. Tables of usual sizes are kept."""
    log_size = max(10, (max(n, 1) - 1).bit_length())
    if log_size > 21:
        return _powers.__wrapped__(base, log_size)[:n]
    return _powers(base, log_size)[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of ``values[start:end]`` for each span, equal for equal contents."""
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    out = (sums[ends] - sums[starts]) * powers(inverse(base), len(values) + 1)[starts]
    return mix(out + (ends - starts).astype(U64) * U64(RUN_BASES[1]))


def run_values(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """As :func:`span_hashes`, of every run of ``size`` values."""
    n = max(0, len(values) - size + 1)
    out = values[size - 1 :].copy()
    for k in range(size - 2, -1, -1):
        out *= U64(base)
        out += values[k : k + n]
    out += U64(size * RUN_BASES[1] & MASK)
    return mix(out)


def row_hashes(values: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """As :func:`span_hashes`, of rows of ``sizes`` (none is 0) values, which follow each other."""
    if not len(sizes):
        return np.zeros(0, U64)
    firsts = np.cumsum(sizes) - sizes
    sums = np.add.reduceat(values * powers(base, len(values)), firsts)
    return mix(sums * powers(inverse(base), len(values))[firsts] + sizes.astype(U64) * U64(RUN_BASES[1]))


@dataclass(frozen=True)
class Words:
    """The words of a block: byte spans, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # text t has the words bounds[t] to bounds[t + 1] - 1

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(block: Block, kind: np.ndarray) -> Words:
    inside = np.zeros(len(block.data) + 1, bool)
    inside[:-1] = kind[block.data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    ends = inside[:-1] & ~inside[1:]
    cuts = block.bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(block.data))]
    begins[cuts] = inside[cuts]  # a word does not go on from one text to the next
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, block.bounds))


def word_hashes(block: Block, found: Words, fold: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word; ``fold`` maps bytes first, for example to lower case."""
    data = block.data if fold is None else fold[block.data]
    return span_hashes(data.astype(U64) + U64(1), found.starts, found.ends, BYTE_BASE)


def runs(found: Words, length: int) -> np.ndarray:
    """The first word of every run of ``length`` words within one text."""
    n = len(found)
    if n < length:
        return np.zeros(0, np.int64)
    left = np.repeat(found.bounds[1:], found.counts) - np.arange(n)
    return np.flatnonzero(left >= length)


def run_hashes(
    hashes: np.ndarray, starts: np.ndarray, length: int, base: int = RUN_BASES[0]
) -> np.ndarray:
    """A hash of the ``length`` word hashes from each of ``starts`` on."""
    return span_hashes(hashes, starts, starts + length, base)


def covered(marks: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie within ``length`` places from a mark on."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, marks, 1)
    np.add.at(steps, np.minimum(marks + length, n), -1)
    return np.cumsum(steps[:-1]) > 0


def distinct(values: np.ndarray) -> np.ndarray:
    """The values sorted, each once. Sorting is much faster here than the hashing of ``np.unique``."""
    out = np.sort(values)
    if len(out) < 2:
        return out
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)


def members(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each value its place in the sorted ``keys``, -1 where it is not among them."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)
