import base64
import gzip
import hashlib

import pytest

from quarrylens.llm import warc
from quarrylens.llm.queries import QUERIES
from quarrylens.llm.storage import shared_folder

PAGES = [
    (1, "http://www.Example.com/a?b=1#c", "<p>same</p>"), (2, "https://example.com/a?b=1", "<p>same</p>"), (3, "http://b.example.org:8080/x", None), (4, "", ""),
    (5, None, "é日本\r\n\r\nWARC/1.1\r\n\r\n"), (6, "not a url %\r\n", "x" * 300_000), (7, "http://user@Host.net", "<p>same</p>"), (None, "http://null.id/", "<p>own</p>"), (None, "http://null.id/2", "<p>own</p>"),
    (7, "http://twice.net/", "<p>same</p>"), (8, "%", "e"),
]


def brute(pages):
    top = {}
    for i, u, h in pages:
        key = (h or "").encode()
        rank = (i is not None, i or 0)
        top.setdefault(key, []).append((rank, i, u))
    out = []
    for i, u, h in pages:
        payload = (h or "").encode()
        best = max(r for r, _, _ in top[payload])
        first = min((x[2] is not None, x[2] or "") for x in top[payload] if x[0] == best)
        own = ((i is not None, i or 0) == best and (u is not None, u or "") == first) or len(top[payload]) == 1
        target = None if own else next(x[1] for x in top[payload] if x[0] == best)
        out.append((i, u, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if own else "revisit", target))
    return sorted(out, key=str)


def rows(df):
    return sorted([(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 9) for p in PAGES], "page_id long, url string, html string, payload int")


def test_round_trip(spark, pages):
    out = warc.round_trip(pages)
    assert rows(out) == brute(PAGES)
    texts = {(i, u): (h or "").encode() for i, u, h in PAGES}
    for r in out.collect():
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == texts[r.page_id, r.url]
    for r in warc.revisits_resolved(out.filter("page_id is not null")).collect():
        assert bytes(r.payload) == texts[r.page_id, r.url]


def test_archives_are_plain_gzip_of_warc(spark, pages):
    path = shared_folder(spark)
    warc.write_archives(pages, path, archive_bytes=1000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()
    assert len(files) > 1
    seen = 0
    for f in files:
        data = gzip.decompress(bytes(f.content))
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int([x for x in head.decode().split("\r\n") if x.startswith("Content-Length")][0].split()[1])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            data = rest[size + 4 :]
            seen += 1
    assert seen == len(PAGES)


def test_index_and_range_reads(spark, pages, tmp_path):
    path = shared_folder(spark)
    warc.write_archives(pages, path)
    captures = warc.read_archives(spark, path).cache()
    warc.build_index(captures, f"{path}-index", block_lines=2)
    index = warc.CaptureIndex(spark, f"{path}-index")
    assert len(index.directory) >= 5
    assert [c["page_id"] for c in index.lookup("http://example.com/a?b=1")] == [1, 2]
    for r in captures.collect():
        found = [c for c in index.lookup(r.url or "") if (c["page_id"], c["url"]) == (r.page_id, r.url)]
        assert len(found) == 1
        record = index.record(found[0])
        assert (record["page_id"], record["url"], record["payload"]) == (r.page_id, r.url, r.payload and bytes(r.payload))
    assert index.lookup("http://nowhere.example/") == []


def test_round_trip_goes_through_the_index(spark, pages, monkeypatch):
    built, build = [], warc.build_index
    monkeypatch.setattr(warc, "build_index", lambda captures, path: (built.append(path), build(captures, path, block_lines=2)))
    hot = [(100 + i, "http://hot.example/", f"<p>{i % 4}</p>") for i in range(9)] + [(100, "http://hot.example/", "<p>0</p>")]
    every = spark.createDataFrame([*PAGES, *hot], "page_id long, url string, html string")
    # equal rows of a hot URL, and more blocks of it than one
    got = rows(warc.round_trip(every))
    assert sorted({x for x in got}, key=str) == sorted({x for x in brute([*PAGES, *hot])}, key=str) and len(got) == len(PAGES) + len(hot)
    assert sum(r.lines for r in spark.read.parquet(f"{built[0]}/directory").collect()) == len(PAGES) + len(hot)
    some = warc.fetch(spark, built[0], spark.createDataFrame([("http://b.example.org:8080/x",), ("http://nowhere.example/",), (None,)], "url string"))
    assert sorted(r.page_id for r in some.collect()) == [3, 4, 5]


def test_url_keys():
    assert warc.url_key("http://www.Example.com/a?b#c") == "com,example)/a?b"
    assert warc.url_key("https://u:p@B.example.org:8080") == "org,example,b:8080)/"
    assert warc.url_key("nonsense") == "nonsense"


def test_empty_table(spark, pages):
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_whole_query(spark, sf):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = sorted([tuple(r) for r in QUERIES["op4_warc"](spark, sf).collect()], key=str)
    assert got == sorted([(i, n, d, t, x) for i, _, n, d, t, x in brute(pages)], key=str)
