"""Sources: gated gzip NDJSON, strict NDJSON, parquet, vectors, event logs, small JSON files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import random
from itertools import islice
from pathlib import Path

import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Lines of a file that are unpacked at once.
LINES = 10_000


def read_manifest(path: str) -> dict:
    """A JSON manifest, with or without a byte order mark."""
    return json.loads(Path(path).read_text(encoding="utf-8-sig"))


def gate_file(path: str, expected: dict) -> dict:
    """Size, SHA-256 and line count of a gzip file against its manifest entry; raises where they differ."""
    whole, lines = hashlib.sha256(), 0
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            whole.update(block)
    size = Path(path).stat().st_size
    if size != expected["bytes"] or whole.hexdigest() != expected["sha256"].lower():
        raise ValueError(f"{Path(path).name}: size or SHA-256 differ from the manifest")
    with gzip.open(path, "rb") as f:
        lines = sum(1 for _ in f)  # to the end, so that a cut file fails
    if lines != expected["records"]:
        raise ValueError(f"{Path(path).name}: {lines} lines, the manifest has {expected['records']}")
    return {"source_file": Path(path).name, "bytes": size, "sha256": whole.hexdigest(), "records": lines}


def sample_lines(total: int, size: int, seed: int) -> list[int]:
    """Line numbers of a seeded sample without replacement."""
    return sorted(random.Random(seed).sample(range(1, total + 1), min(size, total)))


def read_envelopes(spark: SparkSession, path: str, lines: list[int] | None = None) -> DataFrame:
    """One gzip file's lines as (source_file, source_line_number, raw_json, raw_bytes_base64).

    A gzip file is one partition in file order, so the running id is the line number; only a line
    feed ends a line.  Lines that are no UTF-8 keep their bytes as base64."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.lit(Path(path).name).alias("source_file"), (F.monotonically_increasing_id() + 1).alias("source_line_number"), "value")
    good = F.is_valid_utf8("value")
    rows = rows.select("source_file", "source_line_number", F.when(good, F.col("value")).alias("raw_json"), F.when(~good, F.base64(F.col("value").cast("binary"))).alias("raw_bytes_base64"))
    if lines is None:
        return rows
    chosen = spark.createDataFrame([(n,) for n in lines], "source_line_number long")
    return rows.join(F.broadcast(chosen), "source_line_number", "left_semi")


def read_many_envelopes(spark: SparkSession, glob: str) -> DataFrame:
    """The same over many files: lines are numbered where each file is read whole, and unpacked a block of lines at a time."""

    def kept(line: bytes) -> tuple[str | None, str | None]:
        try:
            return line.decode(), None
        except UnicodeDecodeError:
            return None, base64.b64encode(line).decode()

    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                name, packed = path.rsplit("/", 1)[-1], io.BytesIO(content)
                lines = enumerate(gzip.open(packed) if name.endswith(".gz") else packed, 1)
                while block := [(name, n, *kept(line.removesuffix(b"\n"))) for n, line in islice(lines, LINES)]:
                    yield pd.DataFrame(block, columns=["source_file", "source_line_number", "raw_json", "raw_bytes_base64"])

    return spark.read.format("binaryFile").load(glob).select("path", "content").mapInPandas(run, "source_file string, source_line_number long, raw_json string, raw_bytes_base64 string")


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str, pattern: str = "*", strict: bool = False) -> DataFrame:
    """NDJSON with a declared schema; strict: a line that is no JSON object fails with file and text. No file is an error."""
    reader = spark.read.option("pathGlobFilter", pattern)
    if not strict:
        found = reader.schema(schema).json(path)
    else:
        lines = reader.option("lineSep", "\n").text(path).filter(F.trim("value") != "")
        value = F.expr("try_parse_json(value)")
        is_object = F.coalesce(F.expr("schema_of_variant(try_parse_json(value))").startswith("OBJECT"), F.lit(False))
        text = F.when(value.isNotNull() & is_object, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("_metadata.file_path"), F.lit(": "), F.left("value", F.lit(80)))))
        found = lines.select(F.from_json(text, schema).alias("r")).select("r.*")
    if not found.inputFiles():
        raise FileNotFoundError(f"no file {pattern} in {path}")
    return found


def unique_file(root: str, name: str) -> str:
    """The only file of that name below a folder."""
    found = sorted(str(p) for p in Path(root).rglob(name))
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} files {name} below {root}, not one")
    return found[0]


def read_vectors(spark: SparkSession, path: str, id_col: str, vector_col: str, width: int) -> DataFrame:
    """Vectors by id; a vector of another width fails."""
    fits = F.assert_true(F.size(vector_col) == width, F.lit(f"vectors must have {width} components"))
    return spark.read.parquet(path).select(id_col, vector_col).filter(fits.isNull())


def require_columns(df: DataFrame, needed: set[str]) -> DataFrame:
    missing = needed - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df


def first_available(df: DataFrame, *names: str) -> Column:
    """The first of several columns that the frame has."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of {names} is there")


def read_overlay(spark: SparkSession, path: str) -> DataFrame:
    """Corrections of one JSON file; entries without keys or with another sentiment fall away."""
    schema = "corrections array<struct<product_id: string, taxonomy_id: string, to_sentiment: string>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("corrections").alias("c")).select("c.*")
    return rows.filter(F.col("product_id").isNotNull() & F.col("taxonomy_id").isNotNull() & F.col("to_sentiment").isin("positive", "negative"))


def read_improvements(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Successful records with all their keys."""
    rows = spark.read.schema(schema).json(path).filter("generation_status = 'success'")
    for key in ("input_id", "product_id", "taxonomy_id"):
        rows = rows.filter(F.col(key).isNotNull() & (F.trim(key) != ""))
    return rows


def synthetic(spark: SparkSession, rows: int, partitions: int = 4) -> DataFrame:
    """Rows of every type that a connector must carry, from their number alone."""
    n = F.col("id")
    return spark.range(rows, numPartitions=partitions).select(
        F.concat(F.lit("row-"), F.lpad(n.cast("string"), 6, "0")).alias("_id"), n, (n % 5 + 1).cast("double").alias("rating"), (n % 2 == 0).alias("verified"),
        F.when(n % 3 != 0, F.concat(F.lit("text "), n.cast("string"))).alias("text"), F.array(F.lit("tag"), (n % 7).cast("string")).alias("tags"),
        F.struct(F.lit("synthetic").alias("source"), F.lit("run").alias("run_id")).alias("metadata"), F.timestamp_millis(n * 1000).alias("created_at"),
    )


def summarize_event_log(events: DataFrame) -> DataFrame:
    """One row about a Spark event log: executors, tasks, failures, peaks.

    ``events`` has the log's lines as ``value``."""
    line = lambda path: F.get_json_object("value", path)
    kind = line("$.Event")
    is_ = lambda name: kind == name
    task = is_("SparkListenerTaskEnd")
    peak = lambda metric: F.max(F.when(task, line(f"$['Task Metrics']['{metric}']").try_cast("long")))
    return events.agg(
        F.countDistinct(F.when(is_("SparkListenerExecutorAdded"), line("$['Executor ID']"))).alias("executors_added"),
        F.countDistinct(F.when(is_("SparkListenerExecutorRemoved"), line("$['Executor ID']"))).alias("executors_removed"),
        F.count_if(task).alias("tasks"),
        F.count_if(task & F.coalesce(line("$['Task Info']['Failed']") == "true", F.lit(False))).alias("failed_tasks"),
        F.count_if(is_("SparkListenerStageCompleted") & line("$['Stage Info']['Failure Reason']").isNotNull()).alias("failed_stages"),
        F.countDistinct(F.when(task, line("$['Task Info']['Executor ID']"))).alias("executors_used"),
        peak("Peak Execution Memory").alias("peak_execution_memory"),
        F.sum(F.when(task, line("$['Task Metrics']['Disk Bytes Spilled']").try_cast("long"))).alias("disk_bytes_spilled"),
    )


def read_mongo(spark: SparkSession, uri: str, database: str, collection: str, schema: T.StructType) -> DataFrame:
    """Needs the connector on the class path; a document that breaks the schema fails."""
    return spark.read.format("mongodb").schema(schema).option("mode", "FAILFAST").options(**{"connection.uri": uri, "database": database, "collection": collection}).load()
