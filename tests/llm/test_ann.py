import math

import numpy as np
import pytest

from quarrylens.llm import ann
from quarrylens.llm.queries import QUERIES


def brute(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids = np.array([i for i, _ in ok])
    x = np.stack([v for _, v in ok]) if ok else np.zeros((0, 1))
    out = {}
    for n, (i, v) in enumerate(ok):
        if i % every == 0:
            s = np.array([math.fsum(a) for a in x * v])
            order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    hits = total = 0
    for i, own in want.items():
        last = own[-1][1]
        hits += sum(s >= last - 1e-12 for _, s in got.get(i, []))
        total += len(own)
    return hits / total


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 60))
    assert np.allclose(np.linalg.norm(ann.rotated(x, 3, 1), axis=1), np.linalg.norm(x, axis=1))


def test_small_table_is_exact_with_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]
    rows += [(200, None), (201, [0.0] * 6), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (None, [1.0] * 6), (204, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got, want = lists(ann.nearest(df, every=10, k=20)), brute(rows, 10, 20)
    assert {i: [j for j, _ in x] for i, x in got.items()} == {i: [int(j) for j, _ in x] for i, x in want.items()}
    for i in want:
        assert np.allclose([s for _, s in got[i]], [s for _, s in want[i]], rtol=0, atol=1e-14)
    assert ann.nearest(df.limit(0)).collect() == []


def test_blocks_and_unequal_lengths(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] * rng.uniform(0.5, 2) + rng.normal(size=16) * 0.3).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = lists(ann.nearest(df, every=20, k=5)), brute(rows, 20, 5)
    assert set(got) == set(want) and recall(got, want) > 0.9


def test_whole_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = lists(QUERIES["op7_cross_polytope"](spark, sf)), brute(rows, 20, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_recall_on_a_larger_table(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    assert recall(lists(QUERIES["op7_cross_polytope"](spark, path)), brute(rows, 20, 20)) >= 0.9


@pytest.mark.parametrize("lengths", ["outlier", "uniform", "lognormal"])
def test_recall_with_unequal_lengths(spark, lengths):
    vectors = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(3)
    factor = {"outlier": np.where(np.arange(len(vectors)) == 7, 10.0, 1.0), "uniform": rng.uniform(0.9, 1.1, len(vectors)), "lognormal": rng.lognormal(0, 1, len(vectors))}[lengths]
    rows = [(i, (v * x).tolist()) for (i, v), x in zip(vectors, factor, strict=True)]
    assert len(rows) > 1000
    got, want = lists(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=20)), brute(rows, 20, 20)
    assert all(len(got[i]) == 20 for i in want) and recall(got, want) >= 0.95


def test_a_small_table_goes_through_the_buckets(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, 20, 20)
    few = lists(ann.nearest(df, every=20, k=1, tables=1, probes=4))
    many = lists(ann.nearest(df, every=20, k=1, tables=8, probes=16))
    best = {i: x[:1] for i, x in want.items()}
    # four buckets of 128 don't hold all of the nearest
    assert recall(few, best) < 1 and recall(many, best) >= 0.9


def test_other_dimensions_and_ids_with_several_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    odd = [(0, rng.normal(size=4).tolist()), (0, rows[0][1]), (7, rows[20][1]), (60, [1.0, 2.0]), (80, [1.0] * 5), (81, [])]
    got = [tuple(r) for r in ann.nearest(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), every=20, k=3).collect()]
    # two vectors ask as 0, one as 20; 7 is found by either vector; 60 and 80 take no part
    assert sorted((q, r) for q, r, _, _ in got) == sorted([(0, r) for r in (1, 2, 3)] * 2 + [(20, r) for r in (1, 2, 3)])
    assert all(q != v and v < 60 for q, _, v, _ in got)
    every = {i: [np.array(v) for j, v in rows + odd[:3] if j == i] for i in range(40)}
    for q, _, v, s in got:
        assert any(abs(float(a @ b) - s) < 1e-12 for a in every[q] for b in every[v])


def test_lists_are_whole_where_buckets_hold_too_few(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = lists(ann.nearest(df, every=20, k=20, tables=1, probes=1)), brute(rows, 20, 20)
    # found in one bucket of 128, lists would have about 9: all are searched again
    assert all(len(got[i]) == 20 for i in want) and recall(got, want) > 0.9
