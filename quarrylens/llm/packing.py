"""Packing of token ids into windows by Karmarkar-Karp multiway differencing.

A document's ids (with an end id) fill whole windows as far as they go; the remainders of a
group of documents are dealt into k windows, k at first the least number that could hold them.
Differencing starts with one partition a remainder (one filled window, the others empty), always
takes the two partitions of the largest spread and joins the fullest windows of one with the
emptiest of the other, until one partition is left whose windows are nearly equal.  Where a
window exceeds the capacity, the remainders of up to a quarter of a window are dealt once more,
the largest first, each into the fullest window that has room for it; if one finds none, the
count rises by one and the group is dealt again.  Only documents longer than a window are cut,
at whole windows.

A group is a bounded number of neighbouring documents of one task: nothing is shuffled and no
task holds more than a slice of documents and one group's remainders.

Defined results: a null text counts as empty and gives the end id alone; rows with equal ids and
repeated rows are packed each for itself; a long text without white space is encoded whole; other
columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.packed import frugal, small_batches
from quarrylens.llm.bpe import byte_symbols

#: Remainders dealt together.
GROUP = 600
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class ByteCodec:
    """Encodes as a byte-level ``tokenizers`` file with the usual pattern does, several times faster.

    Merges of such a file are in the order of their ids, so ids serve as ranks; special tokens
    in a text are split off first, as that library does."""

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError("merges are not in the order of their ids")
        value = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(value[c] for c in s): i for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.plain = tiktoken.Encoding("bytes", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        for s, i in self.special.items():
            if s in text:
                out: list[int] = []
                for k, part in enumerate(text.split(s)):
                    out += ([i] if k else []) + self.encode(part)
                return out
        return self.plain.encode_ordinary(text)


@lru_cache(maxsize=2)
def byte_codec(path: str) -> ByteCodec:
    return ByteCodec(path)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Multiway differencing: items' places in k subsets of nearly equal sums."""
    if k == 1:
        return [list(range(len(sizes)))]
    # a partition: spread, sums (largest first, empty windows left out), their items
    heap = [(-s, i, [s], [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, sums, items = heapq.heappop(heap)
        _, _, other, more = heapq.heappop(heap)
        free = k - len(sums)
        # the other's smallest windows meet the fullest here, its fullest the empty ones
        pairs = [(s, x) for s, x in zip(other[:free], more[:free], strict=True)]
        for j in range(free, len(other)):
            at = len(sums) - 1 - (j - free)
            sums[at] += other[j]
            items[at] = items[at] + more[j]
        pairs += zip(sums, items, strict=True)
        pairs.sort(key=lambda p: -p[0])
        sums, items = [p[0] for p in pairs], [p[1] for p in pairs]
        spread = sums[0] - (sums[-1] if len(sums) == k else 0)
        turn += 1
        heapq.heappush(heap, (-spread, turn, sums, items))
    items = heap[0][3] if heap else []
    return items + [[] for _ in range(k - len(items))]


def refilled(sizes: list[int], parts: list[list[int]], capacity: int) -> list[list[int]] | None:
    """The windows with their items of up to a quarter of the capacity dealt anew; None if one finds no room."""
    small = capacity // 4
    windows = [[i for i in p if sizes[i] > small] for p in parts]
    rooms = sorted((capacity - sum(sizes[i] for i in own), w) for w, own in enumerate(windows))
    if rooms[0][0] < 0:
        return None
    for i in sorted((i for p in parts for i in p if sizes[i] <= small), key=lambda i: (-sizes[i], i)):
        at = bisect_left(rooms, (sizes[i], -1))
        if at == len(rooms):
            return None
        room, w = rooms.pop(at)
        windows[w].append(i)
        insort(rooms, (room - sizes[i], w))
    return windows


def deal(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length) that hold all items, each of ``capacity`` at most; items are
    cut only at multiples of the capacity."""
    windows = [[(i, at, capacity)] for i, s in enumerate(sizes) for at in range(0, s - s % capacity, capacity)]
    items = [i for i, s in enumerate(sizes) if s % capacity]
    rest = [sizes[i] % capacity for i in items]
    k = -(-sum(rest) // capacity)
    parts: list[list[int]] | None = None
    while rest and parts is None:
        parts = differencing(rest, k)
        if max(sum(rest[i] for i in p) for p in parts) > capacity:
            parts = refilled(rest, parts, capacity)
        k += 1
    return windows + [[(items[j], sizes[items[j]] - rest[j], rest[j]) for j in p] for p in parts or [] if p]


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens (with
    the end id), sequence_id and offset (place in the window)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []

        def rows(out: list[tuple]) -> pa.RecordBatch:
            kinds = (*[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 3)
            columns = list(zip(*out, strict=True)) or [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def dealt() -> list[tuple]:
            nonlocal sequence
            out = []
            for window in deal([len(ids) // 4 for _, _, ids, _ in waiting], capacity):
                offset = 0
                for i, start, length in window:
                    doc, base, ids, total = waiting[i]
                    out.append((doc, base + start, length, ids[4 * start : 4 * (start + length)], total, sequence, offset))
                    offset += length
                sequence += 1
            waiting.clear()
            return out

        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            size = 0
            for doc, text in zip(ids, batch.column(1), strict=True):
                found = np.array(byte_codec(path).encode(text.as_py() or "") + [end_id], np.uint32).tobytes()
                total = len(found) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    out.append((doc, start, capacity, found[4 * start : 4 * (start + capacity)], total, sequence, 0))
                    sequence += 1
                if whole < total:
                    waiting.append((doc, whole, found[4 * whole :], total))
                size += total
                if len(waiting) >= GROUP:
                    out += dealt()
                if size > 1 << 20:
                    yield rows(out)
                    out, size = [], 0
            if out:
                yield rows(out)
        if waiting:
            yield rows(dealt())

    return small_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))).mapInArrow(frugal(run), PIECES)
