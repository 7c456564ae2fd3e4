import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarrylens.llm import omh
from quarrylens.llm.queries import QUERIES


def edited(rows):
    """(id, text): edited text and next text, ids descending."""
    order = sorted(rows, reverse=True)
    out = {}
    for k, i in enumerate(order):
        text, other = rows[i] or "", rows[order[(k + 1) % len(order)]] or ""
        half = len(text) // 2
        out[i] = (text[: len(text) - half] + other[:half], other)
    return out


def words_fingerprint(hash_of, text, bins=omh.BINS, k=omh.WORDS):
    """The definition, with the engine's hash given: pairs by bin of numbered word sequences."""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    if not words:
        return ""
    seen, items = {}, []
    for i in range(max(1, len(words) - k + 1)):
        key = tuple(words[i : i + k])
        items.append((hash_of(key, seen.get(key, 0)), i))
        seen[key] = seen.get(key, 0) + 1
    out = {}
    for h, i in items:
        out.setdefault((h & (1 << 64) - 1) >> 64 - (bins - 1).bit_length(), []).append((h, i))
    return {b: [i for _, i in sorted(sorted(x)[:2], key=lambda p: p[1])] for b, x in out.items()}


def test_pairs_are_the_two_least_of_each_bin_in_text_order(spark):
    rng = random.Random(1)
    texts = ["a b c a b c a b c d", "one", "one two", " x  y\tz ", " ".join(rng.choice("abcd") for _ in range(300)), " ".join(f"w{rng.randrange(500)}" for _ in range(500))]
    df = omh.with_fingerprint(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "f").collect()
    low = (1 << 40) - 1

    def hashed(*args):
        key = tuple(args)
        if key not in cache:
            cache[key] = spark.range(1).select(F.expr("xxhash64(" + ", ".join(args) + ")")).first()[0]
        return cache[key]

    cache = {}
    for r in df[:4]:

        def hash_of(key, n):
            first = hashed(*[f"'{w}'" for w in key], *["cast(null as string)"] * (omh.WORDS - len(key))) & low
            first = first - (1 << 40) if first >> 39 else first
            own = hashed(f"{first}L", str(n)) & low
            return (own - (1 << 40) if own >> 39 else own) << 24

        want = words_fingerprint(hash_of, r.text)
        assert [int(r.f[i : i + 2], 16) for i in range(0, len(r.f), 10)] == sorted(want, key=lambda b: b - 32 if b >= 16 else b)


def test_likeness_falls_with_edits_and_order(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    few = list(words)
    for _ in range(4):
        few[rng.randrange(400)] = "new"
    turned = words[200:] + words[:200]
    other = [f"v{rng.randrange(5000)}" for _ in range(400)]
    df = spark.createDataFrame([(" ".join(words), " ".join(x)) for x in (words, few, turned, other)], "a string, b string")
    df = omh.with_fingerprint(omh.with_fingerprint(df, "a", "fa"), "b", "fb").select(omh.likeness("fa", "fb").alias("s"))
    same, near, moved, far = [r.s for r in df.collect()]
    assert same == 1.0 and 0.6 < near < 1 and far < 0.05
    # the same content in another order is less alike than a few edits, and more than nothing
    assert 0.2 < moved < near


@pytest.mark.parametrize("rows", [{5: "abcdef", 9: "12345", 7: None, 1: ""}, {3: "only one"}])
def test_edited_text(spark, rows):
    df = spark.createDataFrame([(i, t, 3) for i, t in rows.items()], "doc_id long, text string, id int")
    want = edited(rows)
    for r in omh.with_half_replaced(df).collect():
        assert r.edited == want[r.id][0]


def test_defined_results(spark):
    schema = "doc_id long, text string, part int"
    rows = [(None, "a null id", 1), (1, None, 1), (2, "", 1), (3, " \n", 1), (3, "é👍" * 4000, 1), (4, "same text here", 1), (5, "same text here", 1)]
    got = omh.fingerprints(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_chars): r for r in got}
    assert by[1, 0].fingerprint == by[2, 0].fingerprint == "" and by[2, 0].near_next == 1.0
    assert by[4, 14].fingerprint == by[5, 14].fingerprint and by[5, 14].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert omh.fingerprints(spark.createDataFrame([], schema)).collect() == []


def test_whole_query(spark, sf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = edited(rows)
    got = {r.doc_id: r for r in QUERIES["op6_order_minhash"](spark, sf).collect()}
    assert set(got) == set(rows)
    for i, r in got.items():
        assert r.n_chars == len(rows[i] or "") and r.edited_sha256 == hashlib.sha256(want[i][0].encode()).hexdigest()
    prints = {}
    for i, r in got.items():
        assert prints.setdefault(rows[i] or "", r.fingerprint) == r.fingerprint
    long = [r for i, r in got.items() if len(rows[i] or "") > 500]
    assert sum(r.near_edited for r in long) > 3 * sum(r.near_next for r in long)
