import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarrylens.llm import bpe
from quarrylens.llm.queries import QUERIES, WORD_BPE

TEXTS = [
    None, "", " ", "Hello World's  it'S 123 naïve Ünï é", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|end", "日本語\x85 a b　c", "İstanbul ẞ ﬁ Å ΟΔΟΣ Σ ς",
    "aaaaaaaaaaaa aaa aa", "!!!...???", "é i̇", "x" * 3000, "lower lowest newer wider", "\x1c\x1d", "👍🏽 ok", "don't 'll we've",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.no_truncation()
    t.no_padding()
    return t


def check(library, texts):
    own = bpe.codec(WORD_BPE)
    for text, raw in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(raw).cast("i")) == want, text


def test_cases(library):
    check(library, [t or "" for t in TEXTS])


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FF), max_size=40))
def test_property(library, text):
    check(library, [text])


def test_small_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 5)
    check(library, ["one two three four five six seven", "seven six <|endoftext|> nine", "one"])


def test_rows(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS * 2)] + [(None, "x", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.decode(bpe.encode(df, WORD_BPE), WORD_BPE).collect()
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(df.limit(0), WORD_BPE), WORD_BPE).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "i int, ids array<int>")
    assert sorted((r.i, r.decoded) for r in bpe.decode(nulls, WORD_BPE).collect()) == [(1, None), (2, "")]


def test_whole_query(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in random.Random(1).sample(got, 300):
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
