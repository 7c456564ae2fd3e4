import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarrylens.llm import substring
from quarrylens.llm.queries import QUERIES
from quarrylens.llm.substring import remove_repeats

SEPS = " \t\n\x0b\x0c\r"


def brute(rows, length):
    words = [(i, [w for w in "".join(" " if c in SEPS else c for c in t or "").split(" ") if w]) for i, t in rows]
    least = {}
    for i, ws in words:
        for a in range(len(ws) - length + 1):
            key = tuple(ws[a : a + length])
            least[key] = min(least.get(key, float("inf")), float("inf") if i is None else i)
    out = []
    for i, ws in words:
        gone = set()
        for a in range(len(ws) - length + 1):
            if least[tuple(ws[a : a + length])] < (float("inf") if i is None else i):
                gone.update(range(a, a + length))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=str)


def got(spark, rows, length, first):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df, min_words=length, first=first).collect()], key=str)


@pytest.mark.parametrize("length,first", [(13, 7), (5, 2), (3, 3), (1, 1), (9, 2)])
def test_against_brute_force(spark, length, first):
    rng = random.Random(length)
    passage = [rng.choice("abcdef") + str(rng.randrange(50)) for _ in range(60)]
    rows = [(None, None), (1000, ""), (1001, " \t\n"), (1002, "x" * 5000), (None, " ".join(passage[:30]))]
    for i in range(60):
        ws = [rng.choice("abc") for _ in range(rng.randrange(40))]
        a = rng.randrange(50)
        ws[10:10] = passage[a : a + rng.randrange(30)]
        rows.append((rng.randrange(40), rng.choice(SEPS).join(ws)))
    rows += rows[-3:]
    assert got(spark, rows, length, first) == brute(rows, length)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.text("ab \n", max_size=30)), min_size=1, max_size=12))
def test_property(spark, rows):
    assert got(spark, rows, 3, 2) == brute(rows, 3)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, kept_text int, dest string")
    assert remove_repeats(df).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, "q")], "doc_id long, text string, kept_text int, dest string")
    assert remove_repeats(df).select("kept_text", "dest").collect() == [("a b", "q")]


def test_whole_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(rows, 13)]
    assert sorted([tuple(r) for r in QUERIES["op2_substring_dedup"](spark, sf).collect()], key=str) == want


def test_windows_that_share_all_but_the_high_bits_stay_apart():
    """Names keep 48 bits of a window's hash besides its bucket."""
    keys = np.array([5, 5 + (1 << 32), 5 + (1 << 47), 5 + (1 << 60)], np.uint64)
    names = substring._names(np.uint64(3), keys)
    assert len(set(names[:3].tolist())) == 3 and names[3] == names[0]
    assert substring._names(np.uint64(4), keys[:1])[0] != names[0]
