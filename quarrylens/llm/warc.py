"""WARC archives of web pages, and a two-level capture index over them.

``write_archives`` turns pages into WARC 1.1 records: of pages with equal payloads the one of
the largest id is a response, the others are revisits that refer to it.  A file is a run of
gzip members, one for each record and one for the blank lines that end it, so every record
can be read alone.  Spark's own text writer and committer write the files (the members are
the "lines", the end-of-record member is the separator), so a lost executor leaves no half
file and any store that Spark writes to will do.  Archives are cut at ``archive_bytes``.

``read_archives`` parses the files again and returns each record with its file, offset and
length.  ``build_index`` sorts captures by reversed-host URL key into compressed blocks and
keeps a sparse directory: the first and last key of each block, its number and its lines.  A
``CaptureIndex`` finds a URL by binary search in the directory, reads one block, searches in
it, and reads the record's range; ``fetch`` does so for a table of URLs, in batches: each block
is opened once for all keys that the directory sends to it, and the ranges found are read file
by file in the order of their offsets, near ones in one read.  ``round_trip`` writes archives,
indexes all their captures and gets every row through the index.

Ranges are read in tasks by pyarrow's file systems (local, HDFS, S3, GCS, ABFS).

Skew: pages of one payload meet only as (digest, id) pairs, summed before they are shuffled;
the page rows themselves are joined by digest, which Spark splits where one digest is hot.

Defined results: a null html counts as an empty payload; a null or unparsable URL is kept as
text, its key is the text itself; rows with a null id are written with an empty id and read
back with a null id (and are the smallest, so a revisit of one refers to null); of rows with equal payloads and the same largest id, that with the
smallest URL is the response; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrylens.llm.packed import frugal, small_batches
from quarrylens.llm.storage import shared_folder, written

CAPTURE = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary, file string, offset long, length long"
#: The gzip member that ends a record: two blank lines.
END = gzip.compress(b"\r\n\r\n", mtime=0)
#: What a line of the index holds.
LINE = ("key", "page_id", "url", "file", "offset", "length", "record_type", "payload_digest")
#: Bytes of a file that one task reads, and of one read.
UNIT = 4 << 20


def url_key(url: str) -> str:
    """The URL with its host reversed: http://www.Example.com/a?b -> com,example)/a?b."""
    m = re.match(r"(?i)[a-z][a-z0-9+.-]*://([^/?#]*)([^#]*)", url)
    if not m:
        return url
    host = m[1].rpartition("@")[2].lower()
    host, _, port = host.partition(":")
    host = re.sub(r"^www\d*\.", "", host)
    return ",".join(reversed(host.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (m[2] or "/")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page: int | None, url: str, payload: bytes, own: str, revisit: bool, target: int | None, target_url: str) -> bytes:
    kind = "revisit" if revisit else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if revisit else payload)
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{own}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{'' if target is None else target}>", "WARC-Refers-To-Target-URI": target_url}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def _line(text: str | None) -> str:
    """A header's value on one line; null is told from empty by a lone percent sign."""
    return "%" if text is None else re.sub(r"[%\r\n]", lambda m: f"%{ord(m[0]):02X}", text)


def _unline(text: str) -> str | None:
    return None if text == "%" else re.sub("%(25|0D|0A)", lambda m: chr(int(m[1], 16)), text)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = 32 << 20) -> None:
    """Writes ``pages`` below ``path``, as gzip members in files ``archive=N/*``."""
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    own = own.withColumn("sha", F.sha1("payload"))
    # descending by id: null last; then the smaller URL
    best = F.max(F.struct(F.col("id").isNotNull().alias("some"), F.col("id").alias("target"))).alias("best")
    top = own.groupBy("sha").agg(best, F.count("*").alias("n")).filter("n > 1").select("sha", F.col("best.target").alias("target"))
    first = own.join(top.withColumnRenamed("sha", "s"), (F.col("sha") == F.col("s")) & F.col("id").eqNullSafe(F.col("target"))).groupBy("sha", "target").agg(F.min(F.struct(F.col("url").isNotNull(), F.col("url").alias("target_url"))).alias("u")).select("sha", "target", F.col("u.target_url").alias("target_url"), F.lit(True).alias("many"))
    joined = own.join(first, "sha", "left").withColumn("revisit", F.coalesce(F.col("many") & ~(F.col("id").eqNullSafe(F.col("target")) & F.col("url").eqNullSafe(F.col("target_url"))), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = TaskContext.get().partitionId() << 24
        size = 0
        for batch in batches:
            numbers, members = [], []
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                page, url, payload, revisit, target, target_url = (columns[c][i].as_py() for c in ("id", "url", "payload", "revisit", "target", "target_url"))
                record = _record(page, _line(url), payload, digest(payload), revisit, target, _line(target_url))
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                members.append(press.compress(record) + press.flush())
                numbers.append(archive)
                size += len(members[-1]) + len(END)
                if size >= archive_bytes:
                    archive, size = archive + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary()), pa.array(numbers, pa.int64())], ["member", "archive"])

    out = small_batches(joined).mapInArrow(frugal(run), "member binary, archive long").select(F.col("member").cast("string").alias("value"), "archive")
    out.write.partitionBy("archive").option("encoding", "ISO-8859-1").option("lineSep", END.decode("latin-1")).text(path)


def _members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of a file's records, each with the member that ends it."""
    at = 0
    while at < len(data):
        start, parts = at, []
        for _ in range(2):
            unpress = zlib.decompressobj(31)
            parts.append(unpress.decompress(memoryview(data)[at:]) if len(data) - at < 1 << 16 else b"")
            if not parts[-1]:
                unpress = zlib.decompressobj(31)
                chunks, step = [], at
                while not unpress.eof and step < len(data):
                    chunks.append(unpress.decompress(data[step : step + (1 << 16)]))
                    step += 1 << 16
                parts[-1] = b"".join(chunks)
                at = min(step, len(data)) - len(unpress.unused_data)
            else:
                at = len(data) - len(unpress.unused_data)
        yield start, at - start, parts[0]


def parse(record: bytes) -> dict:
    """A record's fields and payload, with what its header says held against its content."""
    head, _, block = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    if lines[0] != "WARC/1.1" or int(fields["Content-Length"]) != len(block):
        raise ValueError("not a whole WARC record")
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    own = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and digest(payload) != own:
        raise ValueError("payload and digest differ")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:page:").removesuffix(">")) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": _unline(fields["WARC-Target-URI"]), "record_type": fields["WARC-Type"], "payload_digest": own,
        "payload_bytes": int(fields["X-Payload-Length"]), "refers_to": number(fields["WARC-Refers-To"]) if revisit else None, "payload": payload,
    }


def _batch(rows: list[dict]) -> pa.RecordBatch:
    """Rows of CAPTURE."""
    names, kinds = zip(*(f.split() for f in CAPTURE.split(", ")), strict=True)
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types[k]) for n, k in zip(names, kinds, strict=True)], list(names))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records below ``path``: fields, payload (null for revisits), file, offset and length.

    Without ``payloads`` they are checked against their digests, but null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, size = [], 0
                for offset, length, record in _members(content.as_py()):
                    rows.append(parse(record) | {"file": file.as_py(), "offset": offset, "length": length} | ({} if payloads else {"payload": None}))
                    size += len(record) if payloads else 256
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(frugal(run), CAPTURE)


def _keys(url: str):
    return F.udf(lambda u: url_key(u or ""), "string")(F.col(url))


def build_index(captures: DataFrame, path: str, block_lines: int = 3000) -> None:
    """Writes the two levels below ``path``: ``blocks`` (sorted lines, compressed) and
    ``directory`` (first key, block number, lines) sorted by key."""
    # written, as range partitioning reads its input twice
    lines = written(captures.select(_keys("url").alias("key"), *LINE[1:]))
    ordered = lines.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str]] = []
        number = TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            data = zlib.compress("\n".join(x for _, x in held).encode(), 6)
            columns = [pa.array([x], t) for x, t in ((held[0][0], pa.string()), (held[-1][0], pa.string()), (number, pa.int64()), (len(held), pa.int32()), (data, pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["first", "last", "block", "lines", "data"])

        for batch in batches:
            for row in batch.to_pylist():
                held.append((row["key"], json.dumps([row[c] for c in LINE], ensure_ascii=False)))
                if len(held) == block_lines:
                    yield block()
                    held.clear()
                    number += 1
        if held:
            yield block()

    blocks = ordered.mapInArrow(frugal(run), "first string, last string, block long, lines int, data binary")
    blocks.write.option("parquet.block.size", 1 << 20).parquet(f"{path}/blocks")
    stored = captures.sparkSession.read.parquet(f"{path}/blocks")
    stored.select("first", "last", "block", "lines").write.parquet(f"{path}/directory")


def _blocks(directory: list[tuple[str, str, int]], firsts: list[str], key: str) -> list[int]:
    at, out = max(0, bisect.bisect_left(firsts, key) - 1), []
    while at < len(directory) and firsts[at] <= key:
        if directory[at][1] >= key:
            out.append(directory[at][2])
        at += 1
    return out


def _within(data: bytes, wanted: list[str]) -> Iterator[list]:
    """A block's lines with one of the keys, found by binary search."""
    rows = [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]
    keys = [r[0] for r in rows]
    for key in wanted:
        yield from rows[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]


class CaptureIndex:
    """Point lookups: a binary search in the sparse directory, one block, one record's range.

    The directory (a line for each ``block_lines`` captures) is held by the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.directory = sorted((r["first"], r["last"], r["block"]) for r in spark.read.parquet(f"{path}/directory").collect())
        self.firsts = [d[0] for d in self.directory]

    def blocks(self, key: str) -> list[int]:
        """The blocks that may hold a key."""
        return _blocks(self.directory, self.firsts, key)

    def lookup(self, url: str) -> list[dict]:
        """Captures of a URL (of all URLs with its key), in the order of their ids."""
        key = url_key(url)
        found = []
        for block in self.blocks(key):
            data = self.spark.read.parquet(f"{self.path}/blocks").filter(F.col("block") == block).select("data").first()["data"]
            found += [dict(zip(LINE, r, strict=True)) for r in _within(bytes(data), [key])]
        return found

    def record(self, capture: dict) -> dict:
        """The record of a capture, by a read of its range alone."""
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(capture["file"])
        stream = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(where)
        try:
            stream.seek(capture["offset"])
            data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, capture["length"])))
        finally:
            stream.close()
        return parse(next(_members(data))[2])


def _ranges(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Ascending (offset, length) as reads: start, bytes and the ranges in them. What lies
    between two ranges of a read is less than 64 kB."""
    held: list[tuple[int, int]] = []
    for at, n in ranges:
        if held and (at - sum(held[-1]) >= 1 << 16 or at + n - held[0][0] > UNIT):
            yield held[0][0], sum(held[-1]) - held[0][0], held
            held = []
        held.append((at, n))
    if held:
        yield held[0][0], sum(held[-1]) - held[0][0], held


def fetch(spark: SparkSession, path: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records of all captures whose key is that of one of ``urls``, each once, by the index
    below ``path``: directory, blocks, and the records' ranges."""
    index = CaptureIndex(spark, path)
    shared = spark.sparkContext.broadcast((index.directory, index.firsts))
    keys = urls.select(_keys(url_col).alias("key")).distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory, firsts = shared.value
        for batch in batches:
            found = [(b, k) for k in batch.column(0).to_pylist() for b in _blocks(directory, firsts, k)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int64()), pa.array([k for _, k in found], pa.string())], ["block", "key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, wanted in zip(batch.column(0), batch.column(1), strict=True):
                rows = list(_within(data.as_py(), wanted.as_py()))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], list(LINE))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, opened, name = None, None, None
        for batch in batches:
            lines = batch.to_pylist()
            for file, own in groupby(lines, lambda r: r["file"]):
                if file != name:
                    store, where = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", file))
                    opened, name = store.open_input_file(where), file
                own = list(own)
                by = {r["offset"]: r for r in own}
                for start, size, inside in _ranges([(r["offset"], r["length"]) for r in own]):
                    data, rows = opened.read_at(size, start), []
                    for at, n in inside:
                        row = parse(next(_members(data[at - start : at - start + n]))[2])
                        if any(row[c] != by[at][c] for c in ("page_id", "url", "record_type", "payload_digest")):
                            raise ValueError("index and record differ")
                        rows.append(row | {"file": file, "offset": at, "length": n})
                    yield _batch(rows)

    asked = keys.mapInArrow(frugal(route), "block long, key string").groupBy("block").agg(F.collect_list("key").alias("keys"))
    blocks = spark.read.parquet(f"{path}/blocks").select("block", "data")
    line = "key string, page_id long, url string, file string, offset long, length long, record_type string, payload_digest string"
    found = small_batches(blocks.join(asked, "block").select("data", "keys")).mapInArrow(frugal(search), line).drop("key")
    dealt = found.repartition("file", F.floor(F.col("offset") / UNIT)).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(frugal(read), CAPTURE)


def round_trip(pages: DataFrame, url_col: str = "url", **columns: str) -> DataFrame:
    """Archives of ``pages`` in the shared folder, indexed, and read back through the index."""
    spark, path = pages.sparkSession, shared_folder(pages.sparkSession)
    write_archives(pages, path, url_col=url_col, **columns)
    build_index(read_archives(spark, path, payloads=False), f"{path}-index")
    return fetch(spark, f"{path}-index", pages, url_col)


def revisits_resolved(captures: DataFrame) -> DataFrame:
    """Captures with the payload of the response that a revisit refers to."""
    told = captures.filter("record_type = 'response'").select(F.col("page_id").alias("__target"), F.col("payload").alias("__payload"))
    one = told.withColumn("__n", F.row_number().over(Window.partitionBy("__target").orderBy(F.sha1("__payload")))).filter("__n = 1").drop("__n")
    return captures.join(one, captures["refers_to"] == F.col("__target"), "left").withColumn("payload", F.coalesce("payload", "__payload")).drop("__target", "__payload")


def as_pandas(captures: DataFrame) -> pd.DataFrame:
    """A small set of captures, for reports."""
    return captures.drop("payload").toPandas()
