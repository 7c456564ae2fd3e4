"""Removal of repeated passages by level-wise doubling.

A window of ``min_words`` words is removed from a document if the same word sequence also
starts in a document with a smaller id.  Windows are found by levels: at the first level all
windows of ``first`` words are named (a 48-bit key within a hash bucket) and only those
repeated anywhere go on; a window of the next level, twice as long, exists only where two
repeated windows of the level below overlap or adjoin within one document, and its name is
made of their two names.  The last level has ``min_words`` words.  Texts are not read again
between levels, and levels after the first hold only repeated passages.

Skew: a chunk sends each distinct window once, so the most common window reaches its bucket
once per chunk, never once per row.

Defined results: a null text has no words; a null id counts as larger than all ids; rows
with equal ids do not remove each other's words; output columns replace input columns of
the same name; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm.packed import CHUNK_BYTES, ROW, bucket_count, frugal, frugal_group, pack, rows, small_batches, steps, text_bytes, unpack, unsteps
from quarrylens.llm.words import U, Words, mix, runs, text_slices, windows

NONE = np.iinfo(np.int64).max
#: Kinds of packed rows: records for a bucket; documents of a chunk; its windows; a bucket's answer.
RECORDS, DOCUMENTS, LOCAL, ANSWER = range(4)


def _first_level(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (table, data, offsets) in enumerate(text_slices(batches, "__text", CHUNK_BYTES)):
            src = (TaskContext.get().partitionId() << 32) | k
            words = Words(data, offsets)
            at, found = windows(words.hashes(), words, length)
            out = [(-src - 1, src, DOCUMENTS, pack(_ids(table["__id"]), _ids(table["__row"]), words.count.astype(np.int32)))]
            if len(at):
                order = np.argsort(found)
                edge = runs(found[order])
                size = np.diff(edge)
                again = np.repeat(size > 1, size)
                bucket = ((found >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
                here = np.sort(order[again])
                out.append((-src - 1, src, LOCAL, pack(steps(at[here]), _names(bucket[here].astype(U), found[here]))))
                once = np.sort(order[edge[:-1]])
                by = once[np.argsort(bucket[once], kind="stable")]
                edge = runs(bucket[by])
                for a, b in zip(edge[:-1], edge[1:], strict=True):
                    own = found[by[a:b]]
                    out.append((int(bucket[by[a]]), src, RECORDS, pack(own.astype(np.uint32), (own >> U(32)).astype(np.uint16), steps(at[by[a:b]]))))
            yield _batch(out)

    return run


def _names(bucket: np.ndarray | np.uint64, key: np.ndarray) -> np.ndarray:
    """Names of windows: their bucket, which stands for the high bits of their hash, and its low 48 bits."""
    return (bucket << U(48)) | (key & U((1 << 48) - 1))


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NONE).to_numpy().astype(np.int64)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["dest", "src", "kind", "blob"])


def _repeated(group: pd.DataFrame) -> pd.DataFrame:
    """First level: a bucket's windows that occur in two records or more go back to their chunks."""
    if group.dest.iloc[0] < 0:
        return group
    bucket = U(group.dest.iloc[0])
    blobs = [unpack(b) for b in group.blob]
    keys = np.concatenate([b[0].astype(U) | (b[1].astype(U) << U(32)) for b in blobs])
    order = np.argsort(keys, kind="stable")
    size = np.diff(runs(keys[order]))
    again = np.zeros(len(keys), bool)
    again[order[np.repeat(size > 1, size)]] = True
    out, at = [], 0
    for src, (_, _, where) in zip(group.src, blobs, strict=True):
        hit, key = again[at : at + len(where)], keys[at : at + len(where)]
        at += len(where)
        if hit.any():
            out.append((-src - 1, src, LOCAL, pack(steps(unsteps(where)[hit]), _names(bucket, key[hit]))))
    return rows(*out)


def _extend(shift: int, buckets: int, last: bool):
    """A chunk's repeated windows, by place and name, to windows longer by ``shift`` words."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        src = int(group.src.iloc[0])
        ids, keys, count = unpack(group.blob[group.kind == DOCUMENTS].iloc[0])
        found = [unpack(b) for b in group.blob[group.kind == LOCAL]]
        out = [(-src - 1, src, DOCUMENTS, pack(ids, keys, count))]
        n = int(count.sum())
        name, have = np.zeros(n, U), np.zeros(n, bool)
        for where, names in found:
            where = unsteps(where)
            name[where], have[where] = names, True
        owner = np.repeat(np.arange(len(count)), count)
        at = np.flatnonzero(have[: max(0, n - shift)] & have[shift:] & (owner[: max(0, n - shift)] == owner[shift:]))
        if not len(at):
            return rows(*out)
        a, b = name[at], name[at + shift]
        one = mix(a * U(0x9E3779B97F4A7C15) + mix(b))
        two = mix(b * U(0xC2B2AE3D27D4EB4F) + mix(a)).astype(np.uint16)
        order = np.lexsort((two, one))
        new = np.ones(len(at), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = np.flatnonzero(new)
        least = np.minimum.reduceat(ids[owner[at]][order], first)
        # distinct windows are numbered by their first place, so that a passage's numbers are consecutive
        place = np.empty(len(first), np.int64)
        place[np.argsort(np.minimum.reduceat(order, first))] = np.arange(len(first))
        entry = np.empty(len(at), np.int64)
        entry[order] = place[np.cumsum(new) - 1]
        one, two = one[order][first], two[order][first]
        names = np.empty(0 if last else len(first), U)
        if not last:
            names[place] = one
        out.append((-src - 1, src, LOCAL, pack(steps(at), np.diff(entry, prepend=0).astype(np.int32), names)))
        bucket = ((one >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
        order = np.lexsort((place, bucket))
        edge = runs(bucket[order])
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            own = order[x:y]
            low = least[own].min()
            small = np.uint32 if least[own].max() - low < 1 << 32 else np.int64
            out.append((int(bucket[own[0]]), src, RECORDS, pack(one[own], two[own], (least[own] - low).astype(small), np.array([low]), steps(place[own]))))
        return rows(*out)

    return run


def _answers(last: bool):
    """A bucket's windows: at the last level those that a smaller id has too, else those that another chunk has too."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        if group.dest.iloc[0] < 0:
            return group
        blobs = [unpack(b) for b in group.blob]
        one, two = (np.concatenate([b[i] for b in blobs]) for i in range(2))
        least = np.concatenate([b[2].astype(np.int64) + b[3][0] for b in blobs])
        order = np.lexsort((two, one))
        new = np.ones(len(one), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(one)))
        hit = np.zeros(len(one), bool)
        hit[order] = least[order] > np.repeat(np.minimum.reduceat(least[order], first), size) if last else np.repeat(size > 1, size)
        out, at = [], 0
        for src, b in zip(group.src, blobs, strict=True):
            found = unsteps(b[4])[hit[at : at + len(b[0])]]
            at += len(b[0])
            if len(found):
                out.append((-src - 1, src, ANSWER, pack(steps(found))))
        return rows(*out)

    return run


def _state(group: pd.DataFrame):
    ids, keys, count = unpack(group.blob[group.kind == DOCUMENTS].iloc[0])
    local = group.blob[group.kind == LOCAL]
    if not len(local):
        return ids, keys, count, None
    where, entry, names = unpack(local.iloc[0])
    entry = unsteps(entry)
    told = np.zeros(entry.max() + 1, bool)
    for b in group.blob[group.kind == ANSWER]:
        told[unsteps(unpack(b)[0])] = True
    return ids, keys, count, (unsteps(where), entry, names, told)


def _survivors(group: pd.DataFrame) -> pd.DataFrame:
    src = int(group.src.iloc[0])
    ids, keys, count, state = _state(group)
    out = [(-src - 1, src, DOCUMENTS, pack(ids, keys, count))]
    if state is not None:
        where, entry, names, told = state
        keep = (told | (np.bincount(entry) > 1))[entry]
        out.append((-src - 1, src, LOCAL, pack(steps(where[keep]), names[entry[keep]])))
    return rows(*out)


def _spans(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, keys, count, state = _state(group)
        names = ["__id", "__row", "__spans"]
        if state is None:
            return pd.DataFrame([], columns=names)
        where, entry, _, told = state
        owner = np.repeat(np.arange(len(count)), count)
        mine = ids[owner[where]]
        least = np.full(len(told), NONE)
        np.minimum.at(least, entry, mine)
        hit = where[told[entry] | (mine > least[entry])]
        cover = np.zeros(len(owner) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        new = np.ones(len(owner) + 1, bool)
        new[1:-1] = owner[1:] != owner[:-1]
        starts = np.flatnonzero(gone & (new[:-1] | ~np.append(False, gone[:-1])))
        stops = np.flatnonzero(gone & (new[1:] | ~np.append(gone[1:], False))) + 1
        base = np.cumsum(count) - count
        out = []
        mark = runs(owner[starts])
        for a, b in zip(mark[:-1], mark[1:], strict=True):
            d = owner[starts[a]]
            pairs = np.stack([starts[a:b] - base[d], stops[a:b] - base[d]], 1).astype(np.int32)
            out.append((ids[d] if ids[d] != NONE else None, keys[d], pairs.tobytes()))
        return pd.DataFrame(out, columns=names).astype({"__id": "Int64"})

    return run


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, min_words: int = 13, first: int = 7) -> DataFrame:
    """(__id, __row, __spans): word ranges to remove, as pairs of 32-bit numbers; ``__row`` is xxhash64 of the text."""
    if not 0 < first <= min_words:
        raise ValueError("first must be from 1 to min_words")
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(text_col).alias("__row"), F.col(text_col).cast("string").alias("__text"))
    buckets = bucket_count(text_bytes(docs, text_col))
    length = first
    state = small_batches(texts).mapInArrow(frugal(_first_level(length, buckets)), ROW).groupBy("dest").applyInPandas(frugal_group(_repeated), ROW)
    while True:
        longer = min(2 * length, min_words)
        last = longer == min_words
        state = state.groupBy("src").applyInPandas(frugal_group(_extend(longer - length, buckets, last)), ROW)
        length = longer
        state = state.groupBy("dest").applyInPandas(frugal_group(_answers(last)), ROW)
        if last:
            break
        state = state.groupBy("src").applyInPandas(frugal_group(_survivors), ROW)
    return state.groupBy("src").applyInPandas(frugal_group(_spans(min_words)), "__id long, __row long, __spans binary").dropDuplicates(["__id", "__row"])


def _deflated(docs: DataFrame, text_col: str) -> DataFrame:
    """Texts as zstd frames, so that they take less of the join's shuffle."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == text_col else f for f in docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [None if t is None else press(t) for t in batch.column(at).cast(pa.large_binary()).to_pylist()]
            columns = [pa.array(texts, pa.binary()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(frugal(run), schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 13, first: int = 7) -> DataFrame:
    """``docs`` with n_words, n_removed, removed (word ranges) and kept_text (kept words joined by a space)."""
    spans = repeated_spans(docs, id_col, text_col, min_words, first)
    new = ["n_words", "n_removed", "removed", "kept_text"]
    base = docs.drop(*new).withColumns({"__id": F.col(id_col).cast("long"), "__row": F.xxhash64(text_col)})
    base = _deflated(base, text_col)
    left, right = base.alias("l"), spans.alias("r")
    both = left.join(right, F.col("l.__id").eqNullSafe(F.col("r.__id")) & (F.col("l.__row") == F.col("r.__row")), "left").select("l.*", "r.__spans").drop("__id", "__row")
    kept = T.StructType([T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in both.schema.fields if f.name != "__spans"])
    kept = kept.add("n_words", T.LongType()).add("n_removed", T.LongType()).add("removed", T.ArrayType(T.StructType().add("first", T.IntegerType()).add("stop", T.IntegerType()))).add("kept_text", T.StringType())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts, spans = batch.column(batch.schema.get_field_index(text_col)), batch.column(batch.schema.get_field_index("__spans"))
            words, removed, ranges, left = [], [], [], []
            plain = [t and inflate(t) for t in texts.to_pylist()]
            for text, span in zip(plain, spans.to_pylist(), strict=True):
                own = (text or b"").split()
                words.append(len(own))
                gone = 0
                pairs = []
                if span:
                    pairs = np.frombuffer(span, np.int32).reshape(-1, 2).tolist()
                    for a, b in reversed(pairs):
                        del own[a:b]
                        gone += b - a
                removed.append(gone)
                ranges.append([{"first": a, "stop": b} for a, b in pairs])
                left.append(b" ".join(own))
            at = [i for i, name in enumerate(batch.schema.names) if name != "__spans"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(plain, pa.binary()).cast(pa.string()) if batch.schema.names[i] == text_col else batch.column(i) for i in at] + [pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(ranges, pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))), pa.array(left, pa.binary()).cast(pa.string())],
                [batch.schema.names[i] for i in at] + new,
            )

    return both.mapInArrow(frugal(finish), kept)
