"""Sinks: refuse to overwrite, sorted and sharded files, sidecars, checkpoints to resume from."""

from __future__ import annotations

import csv
import json
import os
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("errorifexists").option("compression", compression).parquet(path)


def convert_json(spark: SparkSession, staged: str, path: str, schema: str) -> DataFrame:
    """A staging folder of NDJSON as Parquet; lines that don't fit the schema fail."""
    write_parquet(spark.read.schema(schema).option("mode", "FAILFAST").json(staged), path)
    return spark.read.parquet(path)


def write_npy(df: DataFrame, path: str, order_col: str, vector_col: str, most: int = 1_000_000) -> tuple[int, int]:
    """One .npy matrix of 32-bit numbers, rows by ``order_col``, for exchange; returns its shape.

    Rows are streamed through the driver; a larger table is refused, not cut."""
    rows = df.count()
    if rows > most:
        raise ValueError(f"more than {most} rows")
    width = df.select(F.size(vector_col).alias("n")).agg(F.min("n"), F.max("n")).first()
    if width[0] != width[1]:
        raise ValueError("vectors of several lengths")
    out = np.lib.format.open_memmap(path, mode="w+", dtype=np.float32, shape=(rows, width[0] or 0))
    for n, row in enumerate(df.orderBy(order_col).select(vector_col).toLocalIterator()):
        out[n] = row[0]
    out.flush()
    return out.shape


def write_sorted(df: DataFrame, path: str, *keys: str) -> None:
    """Files in order of the keys, across and within."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("errorifexists").option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_review_csv(df: DataFrame, path: str, most: int = 100_000) -> int:
    """One CSV file with a byte order mark, for people; a larger result is refused, not cut."""
    rows = 0
    with open(path, "x", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for row in df.limit(most + 1).toLocalIterator():
            rows += 1
            if rows > most:
                raise ValueError(f"more than {most} rows")
            out.writerow(row)
    return rows


def write_shards(df: DataFrame, path: str, key: str, shards: int) -> None:
    """NDJSON files by a hash of the key, sorted within: as many as asked for, where each has a key."""
    df.repartition(shards, key).sortWithinPartitions(key).write.mode("errorifexists").json(path)


def write_by(df: DataFrame, path: str, key: str, records_per_file: int = 0) -> None:
    """NDJSON in a folder for each value of the key; files of at most so many records."""
    writer = df.write.mode("errorifexists").partitionBy(key)
    (writer.option("maxRecordsPerFile", records_per_file) if records_per_file else writer).json(path)


def write_sidecar(path: str, content: dict) -> None:
    """A JSON file that appears whole or not at all."""
    temporary = f"{path}.tmp"
    Path(temporary).write_text(json.dumps(content, ensure_ascii=False, indent=2, sort_keys=True), encoding="utf-8")
    os.replace(temporary, path)


def _stored(path: str) -> tuple:
    """The file system that Spark uses for a path, and the path on it."""
    spark = SparkSession.active()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def publish(folder: str, fill: Callable[[str], None]) -> None:
    """Fills a temporary folder and renames it, in any store that Spark writes to; on an error nothing is left."""
    store, target = _stored(folder)
    if store.exists(target):
        raise FileExistsError(folder)
    _, temporary = _stored(f"{folder}.tmp")
    if store.exists(temporary):
        raise FileExistsError(f"{folder}.tmp")
    store.mkdirs(temporary)
    try:
        fill(f"{folder}.tmp")
        if not store.rename(temporary, target):
            raise OSError(f"{folder}.tmp can't be renamed")
    except BaseException:
        store.delete(temporary, True)
        raise


def append_new(done_path: str, work: DataFrame, key: str, step: Callable[[DataFrame], DataFrame], only_status: str | None = None, status_col: str = "status") -> int:
    """Runs ``step`` on the rows whose key has no record yet and appends its records.

    With ``only_status`` records of another status are tried again."""
    spark = work.sparkSession
    store, at = _stored(done_path)
    resumed = store.exists(at)
    if resumed:
        done = spark.read.parquet(done_path)
        if only_status is not None:
            done = done.filter(F.col(status_col) == only_status)
        work = work.join(done.select(key).distinct(), key, "left_anti")
    before = spark.read.parquet(done_path).count() if resumed else 0
    step(work).write.mode("append").parquet(done_path)
    return spark.read.parquet(done_path).count() - before


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """Written and reread: a lineage cut."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert_mongo(df: DataFrame, uri: str, database: str, collection: str) -> None:
    """Idempotent by _id; needs the connector on the class path."""
    df.write.format("mongodb").mode("append").options(**{"connection.uri": uri, "database": database, "collection": collection, "operationType": "replace", "idFieldList": "_id"}).save()
