"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``tables`` pseudo-rotations (three rounds of random signs and a fast Hadamard
transform) sends a vector's direction to the nearest signed axis: its bucket.  Vectors are banded
by length, each band ``BAND`` times as long as the next; a band is an index of its own, in which
the order of directions is nearly that of inner products.  A query looks in every table into
``probes`` buckets a band on average, those of the largest coordinate on their axis times length
of their band; all vectors found there are scored exactly in double precision and the ``k`` best
are kept.  This is the same at every size of a table and of a band.  Queries for which fewer than ``k`` others were found although there are more are searched
again, exactly, over all vectors.

Equal vectors are one numbered entry of the index with their smallest ``k + 1`` ids, which is all that
any list of k can show.  A bucket of more than ``BLOCK`` vectors or queries is dealt into
blocks, and a task scores one block of queries against one block of vectors; each query keeps
k + 1 entries a block, and blocks and tables are merged by query.

Recall against brute force is measured in the tests.

Defined results: vectors that are null, zero or hold a null or non-finite component take no
part, nor do rows with a null id or vectors of another dimension than most (of dimensions
equally frequent, the largest); ties go to the smaller id; rows that share id and vector count
once, an id with several vectors asks and is found with each, and no list holds its own id; the
list is shorter only where there are fewer than k others; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm.packed import frugal
from quarrylens.llm.storage import written

BLOCK = 4096
#: The greatest ratio of lengths in a band.
BAND = 1.05


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, -1, 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), 2)
        h *= 2
    return x.reshape(n, d) / math.sqrt(d)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    d = 1 << (x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, d))
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Rows' coordinates on the signed axes: i for +i, i + d for -i.  The largest is the bucket."""
    x = rotated(x, table, seed)
    return np.concatenate((x, -x), 1)


def likeliest(near: np.ndarray, lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, band, axis) of each row's ``most`` buckets of the largest coordinate times length of the band."""
    rank = (lengths[None, :, None] * near[:, None, :]).reshape(len(near), -1)
    most = min(most, rank.shape[1])
    best = np.argpartition(-rank, most - 1, axis=1)[:, :most].ravel()
    return np.repeat(np.arange(len(near)), most), best // near.shape[1], best % near.shape[1]


def _matrix(column, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(-1, width).astype(np.float64)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, tables: int = 8, probes: int = 16, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest others of each row whose id is divisible by ``every``."""
    double = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), double.alias("v")).filter("id is not null and v is not null")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).filter(F.exists("v", lambda x: x != 0))
    widths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    out = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return vectors.sparkSession.createDataFrame([], out)
    width = widths["n"]
    rows = rows.filter(F.size("v") == width).withColumn("key", F.md5(F.concat_ws(",", F.transform("v", lambda x: x.cast("string")))))

    first = rows.withColumn("n", F.dense_rank().over(Window.partitionBy("key").orderBy("id"))).filter(F.col("n") <= k + 1)
    entries = first.groupBy("key").agg(F.min("v").alias("v"), F.sort_array(F.collect_set("id")).alias("ids"))
    # numbers that stay as they were written
    entries = written(entries.select(F.monotonically_increasing_id().alias("entry"), "key", "v", "ids"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = entries.agg(F.max(norm).alias("high"), F.sum(F.size("ids")).alias("ids")).first()
    # bands by what their lengths fall short of the greatest; a row for each that is there
    band = F.coalesce(F.floor((F.lit(math.log(facts["high"])) - F.log(norm)) / math.log(BAND)), F.lit(-1)).alias("band")
    place = {r["band"]: i for i, r in enumerate(entries.select(band).distinct().orderBy("band").collect())}
    queries = rows.filter(F.col("id") % every == 0).select("key", F.col("id").alias("query_id")).join(entries.select("key", "entry"), "key").select("entry", "query_id").distinct()
    asking = entries.join(queries.select("entry").distinct(), "entry", "left_semi")
    # components of a float column are exact in 32 bits
    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"

    def rows_of(slot: np.ndarray, bucket: np.ndarray, entry: pa.Array, raw: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(bucket.astype(np.int32)), entry, raw], ["slot", "bucket", "entry", "raw"])

    lengths = np.array([BAND ** -float(b) for b in place])
    # a query's probes are dealt over all bands; slices bound the ranks and the rows held at once
    slices = {False: 1024, True: max(1, min(1024, (1 << 21) // (len(place) * 4 * width), (1 << 16) // (probes * len(place))))}

    def hashed(probe: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, slices[probe]):
                    part = batch.slice(at, slices[probe])
                    x, bands = part.column(1).flatten().to_numpy().reshape(-1, width), part.column(2).to_numpy()
                    entry, raw = part.column(0), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    for table in range(tables):
                        near = axes(unit, table, seed)
                        if probe:
                            row, band, axis = likeliest(near, lengths, probes * len(place))
                            yield rows_of(band * tables + table, axis, entry.take(pa.array(row)), raw.take(pa.array(row)))
                        else:
                            yield rows_of(np.array([place[b] for b in bands.tolist()]) * tables + table, near.argmax(axis=1), entry, raw)

        return run

    def unhashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, width)
            yield rows_of(np.zeros(len(x)), np.zeros(len(x)), batch.column(0), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()))

    schema = "slot int, bucket int, entry long, raw binary"
    index = written(entries.select("entry", "v", band).mapInArrow(frugal(hashed(False)), schema))
    # probes of empty buckets are not written; there are at most tables times axes times bands buckets
    there = F.broadcast(index.select("slot", "bucket").distinct())
    probing = written(asking.select("entry", "v", band).mapInArrow(frugal(hashed(True)), schema).join(there, ["slot", "bucket"], "left_semi"))

    def score(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        entry, found, scores = [], [], []
        if len(asked) and len(held):
            x, names = _matrix(held["raw"], width, kind).T, held["entry"].to_numpy()
            asker, raw = asked["entry"].to_numpy(), asked["raw"].to_numpy()
            most = min(k + 1, len(names))
            for at in range(0, len(asker), 512):
                s = _matrix(raw[at : at + 512], width, kind) @ x
                last = -np.partition(-s, most - 1, axis=1)[:, most - 1]
                for i in range(len(s)):
                    # entries as good as the last one are kept too
                    own = np.flatnonzero(s[i] >= last[i] - 1e-12)
                    entry.append(asker[at + i])
                    found.append(names[own].tobytes())
                    scores.append(s[i, own].tobytes())
        return pd.DataFrame({"entry": np.array(entry, np.int64), "found": found, "scores": scores})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        names, scores = (np.frombuffer(b"".join(group[c]), t) for c, t in (("found", np.int64), ("scores", np.float64)))
        names, at = np.unique(names, return_index=True)
        scores = scores[at]
        last = np.sort(scores)[-min(k + 1, len(scores))]
        return pd.DataFrame({"entry": group["entry"].iloc[0], "other": names[scores >= last - 1e-12]})

    def search(index: DataFrame, probing: DataFrame) -> DataFrame:
        # a row for each bucket of each table: as many as tables times axes
        parts = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
        sizes = index.groupBy("slot", "bucket").agg(F.count("*").alias("n")).join(probing.groupBy("slot", "bucket").agg(F.count("*").alias("m")), ["slot", "bucket"])
        sizes = F.broadcast(written(sizes.select("slot", "bucket", parts("n").alias("n"), parts("m").alias("m"))))
        block = lambda n: F.pmod(F.xxhash64("entry"), F.col(n)).cast("int")
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        index = index.join(sizes, ["slot", "bucket"]).select("slot", "bucket", "entry", "raw", block("n").alias("i"), upto("m").alias("j"))
        probing = probing.join(sizes, ["slot", "bucket"]).select("slot", "bucket", "entry", "raw", block("m").alias("j"), upto("n").alias("i"))

        by = ["slot", "bucket", "i", "j"]
        partial = probing.groupBy(*by).cogroup(index.groupBy(*by)).applyInPandas(score, "entry long, found binary, scores binary")
        return partial.groupBy("entry").applyInPandas(merge, "entry long, other long")

    best = written(search(index, probing))
    # an entry finds itself too
    found = best.join(entries.select(F.col("entry").alias("other"), F.size("ids").alias("n")), "other").groupBy("entry").agg(F.sum("n").alias("n"))
    short = written(asking.join(found, "entry", "left").filter(F.coalesce("n", F.lit(0)) < min(k + 1, facts["ids"])).select("entry", "v"))
    if not short.isEmpty():
        again = search(written(entries.select("entry", "v").mapInArrow(frugal(unhashed), schema)), written(short.mapInArrow(frugal(unhashed), schema)))
        best = best.join(short, "entry", "left_anti").unionByName(again)
    # exact scores of the few kept, in one order of summation
    mine = asking.select("entry", F.col("v").alias("q"))
    theirs = entries.select(F.col("entry").alias("other"), F.col("v").alias("x"), "ids")
    exact = best.join(mine, "entry").join(theirs, "other").withColumn("score", F.aggregate(F.zip_with("q", "x", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x))
    listed = exact.groupBy("entry").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    pairs = queries.join(listed, "entry").withColumn("f", F.explode("found")).select("query_id", "entry", F.col("f.score").alias("score"), F.explode("f.ids").alias("vec_id")).filter("query_id <> vec_id")
    # a list for each vector that an id asks with
    rank = F.row_number().over(Window.partitionBy("query_id", "entry").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
