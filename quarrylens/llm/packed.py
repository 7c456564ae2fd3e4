"""Exchange of packed arrays: many small keyed records travel as few large binary rows.

A map task handles a *chunk* of whole documents and sends, for each hash bucket, one row that
holds all its records as raw arrays; a reduce task handles one bucket with numpy.  What a
reduce task finds goes back to the chunk that sent it.  Rows for buckets (``dest`` >= 0) and
rows that only wait for their chunk (``dest`` < 0) share one shuffle, so that the map side
runs once.  Everything lives in Spark's shuffle and is recomputed if an executor is lost.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes of a chunk: bounds what a task holds at once (about 25 times as much memory).
CHUNK_BYTES = 1 << 20
ROW = "dest long, src long, kind int, blob binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, each by planes: all first bytes, all second bytes and so on,
    so that high bytes that are mostly zero compress in the shuffle."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        parts.append(a.dtype.str.encode().ljust(8))
        parts.append(np.array([len(a)], np.int64).tobytes())
        a = np.ascontiguousarray(a)
        parts.append(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 and len(a) else a.tobytes())
    return b"".join(parts)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 8
    for _ in range(int(np.frombuffer(blob, np.int64, 1)[0])):
        kind = np.dtype(blob[at : at + 8].strip().decode())
        n = int(np.frombuffer(blob, np.int64, 1, at + 8)[0])
        plane = np.frombuffer(blob, np.uint8, n * kind.itemsize, at + 16).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(plane.T).reshape(-1).view(kind))
        at += 16 + n * kind.itemsize
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    """Ascending positions as differences, in two bytes each where they fit."""
    d = np.diff(ascending, prepend=0)
    return d.astype(np.uint16 if not len(d) or d.max() < 1 << 16 else np.uint32)


def unsteps(differences: np.ndarray) -> np.ndarray:
    return np.cumsum(differences, dtype=np.int64)


def text_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def bucket_count(total: int, per_bucket: int = 8 << 20) -> int:
    """Buckets for so many bytes of text: each stands for 8 MB, at most 32 MB of a large corpus."""
    each = min(max(total // 512, per_bucket), 4 * per_bucket)
    return max(8, -(-total // each))


#: Rows of whole texts that go to Python in one Arrow batch.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches lowered to BATCH_ROWS rows: the default of 10,000
    is meant for narrow rows, and a batch of texts is held several times outside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(key))
    if not 0 < now <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


def rows(*groups: tuple) -> pd.DataFrame:
    return pd.DataFrame(list(groups), columns=["dest", "src", "kind", "blob"])


def trim() -> None:
    """Gives freed memory back to the system: Python workers outlive their tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A partition function that trims memory when it ends."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def frugal_group(run: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A group function that trims memory after a group of some size."""

    @wraps(run)
    def wrapped(group: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(group)
        finally:
            if sum(map(len, group["blob"])) > 1 << 20:
                trim()

    return wrapped
