"""Vectorised words, word hashes and window hashes over Arrow text buffers.

A *word* is a maximal run of bytes outside ``\\x20 \\x09-\\x0D`` (all separators are ASCII, so
working on UTF-8 bytes is exact).  Hashing costs a few nanoseconds a byte: every byte is
replaced by a random 64-bit number, weighted by a power of an odd base and summed by one
running sum over the whole buffer; the difference of two sums, divided by the base's power at
the word's start, is the word's polynomial hash modulo 2**64, finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASES = (0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4F | 5)  # odd, and 5 modulo 8 below
_BASES = tuple((b & ~7) | 5 for b in _BASES)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (shifts and odd multiplications)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


@lru_cache(maxsize=4)
def byte_values(lane: int, lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U) * U(0x9FB21C651E98DF25) + U(lane * 7919 + 17))
    if lower:
        values = values.copy()
        values[65:91] = values[97:123]
    return values


STEP = 2048


def _two_levels(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**(STEP * i) up to n, and base**j below STEP: together any power, with small tables."""
    out = []
    for b, size in ((pow(base, STEP, 1 << 64), n // STEP + 1), (base, STEP)):
        steps = np.full(size, U(b))
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def powers(lane: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n."""
    high, low = _two_levels(_BASES[lane], n)
    return (high[:, None] * low).ravel()[:n]


def inverse_powers(lane: int, at: np.ndarray, n: int) -> np.ndarray:
    """base**-i modulo 2**64 for the given i, all below n."""
    high, low = _two_levels(pow(_BASES[lane], -1, 1 << 64), n)
    return high[at // STEP] * low[at % STEP]


class Words:
    """Words of a slice of documents: byte spans, and the words' range of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = np.empty(n + 1, bool)
        inside[:n] = ~separator[data]
        inside[n] = False
        first = np.zeros(n + 1, bool)
        first[offsets[:-1]] = True
        before = np.empty(n + 1, bool)
        before[0] = False
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | first))
        first[offsets[-1]] = True
        self.ends = np.flatnonzero(before & (~inside | first))
        #: bounds[d]:bounds[d + 1] are document d's words
        self.bounds = np.searchsorted(self.starts, offsets)
        self.count = np.diff(self.bounds)

    def hashes(self, lane: int = 0, lower: bool = False, first: int | None = None) -> np.ndarray:
        """Of whole words, or of their first so many bytes."""
        if not len(self.starts):
            return np.zeros(0, U)
        n = len(self.data)
        sums = np.empty(n + 1, U)
        sums[0] = 0
        weighted = powers(lane, n)
        weighted *= byte_values(lane, lower)[self.data]
        np.cumsum(weighted, out=sums[1:])
        del weighted
        ends = self.ends if first is None else np.minimum(self.ends, self.starts + first)
        return mix((sums[ends] - sums[self.starts]) * inverse_powers(lane, self.starts, n + 1))

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def windows(hashes: np.ndarray, words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words, and hashes, of all windows of ``length`` words within one document."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    sums = np.zeros(n, U)
    for j in range(length):
        sums *= U(0xA0761D6478BD642F | 1)
        sums += hashes[j : j + n]
    last = np.repeat(words.bounds[1:], words.count)[:n]
    at = np.flatnonzero(np.arange(n) + length <= last)
    return at, mix(sums[at])


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Whole documents in slices of about ``most`` bytes (a longer document is a slice of its
    own): the rows, the text's bytes and n + 1 offsets.  Null text counts as empty."""
    held: list[pa.Table] = []
    size = 0

    def out():
        table = pa.concat_tables(held).combine_chunks()
        return table, *buffers(table[column])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        # lengths only: the bytes are not copied before they are sliced
        offsets = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(table[column]), 0).to_numpy())))
        at = 0
        while at < table.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most - size, "right")) - 1
            end = min(max(end, at + (not held)), table.num_rows)
            if end > at:
                held.append(table.slice(at, end - at))
                size += int(offsets[end] - offsets[at])
                at = end
            if at < table.num_rows or size >= most:
                if held:
                    yield out()
                held, size = [], 0
    if held:
        yield out()


def buffers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks()
    array = pa.concat_arrays(array.chunks) if isinstance(array, pa.ChunkedArray) else array
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(ordered: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the length at the end."""
    if not len(ordered):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]))
