import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarrylens.llm import toxicity
from quarrylens.llm.queries import QUERIES


def sample(rng, n, of=60):
    out = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        words = [f"w{rng.integers(of)}".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(rng.integers(5, 60))]
        words += [f"bad{'abcdefgh'[rng.integers(8)]}" for _ in range(rng.integers(1, 4) * y)]
        out.append((i, y, " ".join(words)))
    return out


def counted(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    return toxicity.term_counts(np.frombuffer(b"".join(raw), np.uint8), offsets)


def from_texts(examples, fresh, k=15, sure_chi=16.0):
    """Plain statement of the definition: of each fresh text (vote, cosine to each example)."""
    count = lambda text: Counter(re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)})))
    held = [count(t) for _, _, t in examples]
    labels = [y for _, y, _ in examples]
    n, pos = len(examples), sum(labels)
    weight = {}
    for word in set().union(*held):
        df = sum(word in h for h in held)
        a = sum(y for h, y in zip(held, labels, strict=True) if word in h)
        b, c = df - a, pos - a
        d = n - pos - b
        chi = n * (a * d - b * c) ** 2 / max(1e-9, (a + b) * (c + d) * (a + c) * (b + d))
        weight[word] = (math.log((1 + n) / (1 + df)) + 1) * (0.3 + 0.7 * min(1, chi / sure_chi) ** 2 * (df >= 5))

    def vector(words):
        v = {w: (1 + math.log(c)) * weight.get(w, (math.log(1 + n) + 1) * 0.3) for w, c in words.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    held = [vector(h) for h in held]
    out = []
    for text in fresh:
        v = vector(count(text))
        cosines = [sum(x * h.get(w, 0.0) for w, x in v.items()) for h in held]
        best = [i for i in sorted(range(n), key=lambda i: -cosines[i])[:k] if cosines[i] > 1e-12]
        out.append((sum(cosines[i] * labels[i] for i in best) / (sum(cosines[i] for i in best) + 0.5), cosines))
    return out


@pytest.fixture(scope="module")
def built():
    rows = sample(np.random.default_rng(4), 400)
    owner, terms, counts = counted([t for _, _, t in rows])
    cut = lambda x, i: x[np.searchsorted(owner, i) : np.searchsorted(owner, i + 1)]
    return rows, toxicity.build([(i, y, cut(terms, i), cut(counts, i)) for i, y, _ in rows], 0.1, block=16)


def searched(index, texts):
    owner, place, q = index.vectors(*counted(texts))
    return [index.nearest(place[owner == i], q[owner == i]) for i in range(len(texts))]


@pytest.mark.parametrize("frequent", [0.0, 1 / 16, 2.0])
def test_block_max_search_is_exact(built, frequent):
    rows, _ = built
    owner, terms, counts = counted([t for _, _, t in rows])
    index = toxicity.build([(i, y, terms[owner == i], counts[owner == i]) for i, y, _ in rows], 0.1, block=16, frequent=frequent)
    kept = [r for r in rows if r[0] in set(index.ids.tolist())]
    fresh = [t + " unheard of" for _, _, t in sample(np.random.default_rng(5), 60)] + ["", "unheard", rows[3][2]]
    for (seats, scores), (vote, cosines) in zip(searched(index, fresh), from_texts(kept, fresh), strict=True):
        best = sorted((c for c in cosines if c > 1e-12), reverse=True)[: index.k]
        by_id = {i: c for (i, _, _), c in zip(kept, cosines, strict=True)}
        assert np.allclose(scores, best, atol=1e-6) and np.allclose(scores, [by_id[i] for i in index.ids[seats]], atol=1e-6)
        assert abs(index.vote(seats, scores) - vote) < 1e-5


def test_near_copies_are_one_example(built):
    rows, _ = built
    owner, terms, counts = counted([t for _, _, t in rows[:50]] * 3)
    index = toxicity.build([(i, rows[i % 50][1], terms[owner == i], counts[owner == i]) for i in range(150)], 0.1)
    assert sorted(index.ids.tolist()) == sorted(set(index.ids.tolist())) and set(index.ids.tolist()) <= set(range(50))


def test_scores_rank_toxic_higher(built):
    _, index = built
    fresh = sample(np.random.default_rng(6), 200)
    y = np.array([y for _, y, _ in fresh])
    p = index.probability(np.array([index.vote(*found) for found in searched(index, [t for _, _, t in fresh])]))
    assert p[y == 1].mean() > p[y == 0].mean() + 0.3


def test_query_against_cosines_from_texts(spark, tmp_path):
    # words enough that no two examples are near copies, which would count as one
    rows = sample(np.random.default_rng(7), 240, of=600)
    spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y) for i, y, _ in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, str(tmp_path)).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in rows}
    examples = [r for r in rows if not held[r[0]]]
    want = from_texts(examples, [t for _, _, t in rows])
    assert all(not held[e] for r in got.values() for e in r.evidence)
    for (i, _, _), (_, cosines) in zip(rows, want, strict=True):
        by_id = {e: c for (e, _, _), c in zip(examples, cosines, strict=True)}
        assert np.allclose([by_id[e] for e in got[i].evidence], sorted(by_id.values(), reverse=True)[:15], atol=1e-6)
        assert got[i].held_out == held[i] and got[i].predicted == int(got[i].score >= 0.7)
    # a score grows with the vote
    order = sorted(range(len(rows)), key=lambda j: want[j][0])
    assert (np.diff([got[rows[j][0]].score for j in order]) > -1e-5).all()


def test_defined_results(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    index = toxicity.train(docs, labels)
    rows = [(1, None, 5), (2, "", 5), (3, "12 !", 5), (None, "trash idiot worthless " * 5000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = {r.doc_id: r for r in toxicity.score(df, index).collect()}
    assert got[1].score == got[2].score == got[3].score < 0.3 and got[1].evidence == []
    assert got[None].score > 0.7 and len(got[None].evidence) == index.k
    assert toxicity.score(df.limit(0), index).collect() == []
    nothing = toxicity.train(docs, labels.limit(0))
    assert nothing is None and {r.score for r in toxicity.score(df, nothing).collect()} == {0.0}


def test_held_out_quality(spark, sf):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op8_toxicity"](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    clean = [p for p, y in held if y == 0]
    toxic = [p for p, y in held if y == 1]
    assert np.mean(clean) < 0.05 and np.mean(toxic) > 0.6
