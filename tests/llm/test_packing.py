import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarrylens.llm import packing
from quarrylens.llm.packing import ByteCodec, deal, differencing, pack_documents
from quarrylens.llm.queries import BYTE_BPE, QUERIES

TEXTS = [None, "", " ", "Hello  world\n\n it's 12 o'clock", "a<|endoftext|>b", "é日本👍", "x" * 20000, "word " * 5000]


def test_codec_is_the_librarys():
    own, library = ByteCodec(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for t in TEXTS:
        assert own.encode(t or "") == library.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 99), min_size=1, max_size=40), st.integers(1, 8))
def test_differencing_is_a_partition(sizes, k):
    parts = differencing(sizes, k)
    assert len(parts) == k and sorted(i for p in parts for i in p) == list(range(len(sizes)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 250), max_size=60))
def test_deal_holds_everything(sizes):
    windows = deal(sizes, 100)
    seen = [[] for _ in sizes]
    for w in windows:
        assert 0 < sum(n for _, _, n in w) <= 100
        for i, a, n in w:
            seen[i].append((a, n))
    for size, pieces in zip(sizes, seen, strict=True):
        at = 0
        for a, n in sorted(pieces):
            assert a == at
            at += n
        assert at == size


def test_differencing_is_near_equal():
    rng = random.Random(3)
    sizes = [rng.randrange(1, 2048) for _ in range(600)]
    sums = [sum(sizes[i] for i in p) for p in differencing(sizes, 100)]
    assert max(sums) - min(sums) < 0.05 * np.mean(sums)


def check(rows, texts, capacity=2048):
    library = Tokenizer.from_file(BYTE_BPE)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = np.array(library.encode(texts[doc] or "", add_special_tokens=False).ids + [1], np.uint32)
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    total = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= capacity
        total += at
    # only documents longer than a sequence are cut, into whole sequences and a rest
    assert all(len(own) == -(-own[0]["doc_tokens"] // capacity) for own in pieces.values())
    return total / (len(sequences) * capacity)


def test_the_count_rises_until_all_fit(monkeypatch):
    tried = []
    plain = packing.differencing
    monkeypatch.setattr(packing, "differencing", lambda sizes, k: tried.append(k) or plain(sizes, k))
    # three items of six tenths fit into no two windows
    assert sorted(deal([60, 60, 60], 100)) == [[(0, 0, 60)], [(1, 0, 60)], [(2, 0, 60)]] and tried == [2, 3]
    tried.clear()
    rng = random.Random(4)
    sizes = [min(2047, 1 + int(rng.lognormvariate(6, 0.9))) for _ in range(600)]
    windows = deal(sizes, 2048)
    assert tried == list(range(-(-sum(sizes) // 2048), len(windows) + 1))
    assert all(start == 0 and n == sizes[i] for w in windows for i, start, n in w)
    assert sum(sizes) / (len(windows) * 2048) > 0.98


def test_refilling_keeps_all_items():
    rng = random.Random(6)
    for _ in range(100):
        sizes = [rng.randrange(1, 100) for _ in range(40)]
        k = -(-sum(sizes) // 100) + rng.randrange(3)
        parts = packing.refilled(sizes, differencing(sizes, k), 100)
        if parts is not None:
            assert sorted(i for p in parts for i in p) == list(range(40)) and max(sum(sizes[i] for i in p) for p in parts) <= 100


def test_rows(spark):
    texts = dict(enumerate(TEXTS)) | {None: "null id"}
    df = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, start int")
    rows = pack_documents(df, BYTE_BPE).collect()
    check([r.asDict() | {"ids_crc32": zlib.crc32(r.ids)} for r in rows], texts)
    assert pack_documents(df.limit(0), BYTE_BPE).collect() == []
    # repeated rows are packed each for itself
    twice = pack_documents(df.filter("doc_id = 3").union(df.filter("doc_id = 3")), BYTE_BPE).collect()
    assert len(twice) == 2 and len({r.doc_id for r in twice}) == 1


def test_whole_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    filled = check([r.asDict() for r in QUERIES["op3_packing"](spark, sf).collect()], texts)
    assert filled > 0.99
