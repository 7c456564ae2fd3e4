import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarrylens.llm import tokencount
from quarrylens.llm.queries import BYTE_BPE, QUERIES


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTE_BPE)
    t.encode_special_tokens = True
    return t


ALPHABET = st.text("ab' 1\n.!é srelv<|endoftext>", max_size=60)


@settings(max_examples=300, deadline=None)
@given(ALPHABET, st.lists(st.tuples(st.integers(-2, 70), st.integers(-2, 70), st.text("ab' 1\n.é slv", max_size=12)), max_size=6))
def test_edits_give_the_counts_of_the_whole_text(library, text, edits):
    tree = tokencount.TokenTree(text, tokencount.counter(BYTE_BPE))
    for a, b, new in edits:
        a = min(max(a, 0), len(text))
        b = min(max(b, a), len(text))
        text = text[:a] + new + text[b:]
        tree.edit(a, b, new)
        assert tree.text == text
        assert tree.total == len(library.encode(text, add_special_tokens=False).ids)
        assert tree.chars[1] == len(text)


def test_long_text_is_not_encoded_again(library):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) + rng.choice(["", ",", ".", "\n"]) for _ in range(20000))
    tree = tokencount.TokenTree(text, tokencount.counter(BYTE_BPE))
    before = tree.encoded
    for k in range(400):
        a = rng.randrange(len(text))
        b, new = a + rng.randrange(30), " ".join(["new"] * rng.randrange(60 if k % 50 else 600))
        text = text[:a] + new + text[b:]
        tree.edit(a, b, new)
    assert tree.text == text and tree.total == len(library.encode(text, add_special_tokens=False).ids)
    assert tree.encoded - before < 400 * 60 + 8 * 600 + 400 * 30


def test_rows(spark, library):
    texts = [None, "", "one two three", "x" * 4000, " \n "]
    edits = [None, [], [(0, 3, "ONE"), (None, None, None), None], [(100000, 5, "end")]]
    rows = [(i, t, e, 7) for i, t in enumerate(texts) for e in edits]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>, n_tokens int")
    for r in tokencount.recount(df, BYTE_BPE).collect():
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert r.n_tokens_edited == len(library.encode(r.edited, add_special_tokens=False).ids)
    assert tokencount.recount(df.limit(0), BYTE_BPE).collect() == []


def test_whole_query(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op10_token_counts"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in random.Random(2).sample(got, 200):
        text = texts[r.doc_id]
        n = len(text)
        a = n // 3
        new = text[:a] + f"An edited passage, number {r.doc_id}." + text[min(n, int(n / 3 + 40)) :]
        new = "Note: " + new
        new = new[: n // 2] + new[int(n / 2 + 25) :]
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert r.n_tokens_edited == len(library.encode(new, add_special_tokens=False).ids)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
