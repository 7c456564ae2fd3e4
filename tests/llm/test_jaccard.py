import random

import numpy as np
import pytest

from quarrylens.llm import jaccard
from quarrylens.llm.queries import QUERIES


def brute(rows, n, num, den):
    sets = []
    for _, t in rows:
        ws = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in (t or "").encode().split()]
        sets.append({tuple(ws[a : a + n]) for a in range(max(1, len(ws) - n + 1))} if ws else set())
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, s in enumerate(sets):
        seen = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, both in seen.items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                group[find(i)] = find(j)
    big = float("inf")
    least = {}
    for i, (k, _) in enumerate(rows):
        g = find(i)
        least[g] = min(least.get(g, big), big if k is None else k)
    return sorted([(k, len(s), None if least[find(i)] == big else least[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))], key=str)


def got(spark, rows, n, num, den):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([(r["__id"], r.n_shingles, r.component_id) for r in jaccard.near_duplicate_groups(df, n=n, num=num, den=den).collect()], key=str)


def copies(rng, size, n, edits, vocabulary=300):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(size)]
    out = []
    for _ in range(n):
        ws = list(base)
        for _ in range(rng.randrange(edits + 1)):
            ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in ws))
    return out


@pytest.mark.parametrize("n,num,den,weak", [(4, 85, 100, 40), (5, 80, 100, 3)])
def test_against_brute_force(spark, monkeypatch, n, num, den, weak):
    monkeypatch.setattr(jaccard, "WEAK", weak)
    rng = random.Random(n)
    texts = [None, "", " \n", "One", "one", "two words", "Two  words", "a b c d", "x" * 3000]
    for size in (3, 4, 6, 9, 15, 40, 80, 200, 600):
        texts += copies(rng, size, 12, max(1, size // 15))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(20))) for _ in range(60)]
    texts += copies(rng, 120, 90, 4)
    rows = [(k if k != 20 else None, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += rows[:3]
    assert got(spark, rows, n, num, den) == brute(rows, n, num, den)


def test_signatures_meet_the_guarantee():
    rng = np.random.default_rng(1)
    for num, den in ((85, 100), (80, 100)):
        bands = jaccard.Bands(num, den, 5000)
        for size in (7, 8, 9, 12, 20, 33, 70, 150, 400, 1500):
            for _ in range(30):
                a = rng.integers(0, 2**63, size, dtype=np.uint64)
                gone = rng.integers(0, size * (den - num) // den + 1)
                b = np.concatenate((a[gone:], rng.integers(0, 2**63, rng.integers(0, size // 4 + 1), dtype=np.uint64)))
                both = size - gone
                if den * both < num * (size + len(b) - both) or (gone == 0 and len(b) == size):
                    continue
                s, holder, _ = jaccard._signatures([a, b], bands)
                assert set(s[holder == 0]) & set(s[holder == 1])


def test_forests_join_what_all_pairs_join():
    rng = np.random.default_rng(5)
    for forests in (1, 2, 16):
        for _ in range(20):
            group = np.sort(rng.integers(0, 4, 60))
            group = np.unique(group, return_inverse=True)[1]
            part, own = rng.integers(0, 12, 60), rng.integers(0, 2, 60)
            same = np.isin(group, [0, 2])
            kind = rng.integers(0, 5, 60)
            marks = np.zeros((60, jaccard.BITS // 64), np.uint64)
            marks[np.arange(60), kind] = np.uint64(2**64 - 1)
            n = np.full(60, 100)
            x, y, more = jaccard._spanning(marks, group, own, same, part, n, 80, 100, forests)
            pairs = [(a, b) for a in range(60) for b in range(a + 1, 60) if group[a] == group[b] and part[a] != part[b] and kind[a] == kind[b] and (same[a] or own[a] != own[b])]
            got = set(zip(x.tolist(), y.tolist(), strict=True))
            assert len(got) == len(x) and got <= set(pairs) and len(x) <= forests * 60
            label = [(g, p) for g, p in zip(group, part, strict=True)]

            def trees(links):
                root = {k: k for k in label}

                def find(k):
                    while root[k] != k:
                        k = root[k]
                    return k

                for a, b in links:
                    root[find(label[a])] = find(label[b])
                return {frozenset(j for j in label if find(j) == find(k)) for k in label}

            assert trees(got) == trees(pairs)
            for g in set(group.tolist()):
                if not more[g]:
                    assert {p for p in pairs if group[p[0]] == g} <= got


def test_a_long_chain_and_a_group_without_a_centre(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"c{i}" for i in range(1500)]
    texts = [" ".join(words[i : i + 90]) for i in range(1400)]
    # copies with one word changed each: few of them are near one another, all are near the original
    base = [f"b{i}" for i in range(70)]
    for _ in range(600):
        ws = list(base)
        ws[rng.randrange(70)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(ws))
    rows = list(enumerate(texts))
    made, whole = [], jaccard._across_groups

    def counted(open_rows, num, den, forests):
        out = jaccard.written(whole(open_rows, num, den, forests))
        made.append((out.count(), forests * open_rows.count()))
        return out

    monkeypatch.setattr(jaccard, "_across_groups", counted)
    monkeypatch.setattr(jaccard, "FORESTS", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 200)
    assert got(spark, rows, 5, 80, 100) == brute(rows, 5, 80, 100)
    assert made and all(pairs <= most for pairs, most in made)


def test_empty_table_and_kept_rows(spark):
    schema = "doc_id long, text string, component string, node int"
    assert jaccard.keep_one_of_each_group(spark.createDataFrame([], schema)).collect() == []
    rows = [(3, "a b c d e f", "x", 1), (2, "A b c d e f", "y", 2), (9, "", "z", 3), (8, None, "z", 4)]
    kept = jaccard.keep_one_of_each_group(spark.createDataFrame(rows, schema))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 8, 9] and kept.columns == ["doc_id", "text", "component", "node"]


def test_whole_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted([tuple(r) for r in QUERIES["op9_ngram_jaccard"](spark, sf).collect()], key=str) == brute(rows, 4, 85, 100)
