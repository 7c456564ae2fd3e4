"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, with block-max pruning.

A bounded sample of labelled texts is the index.  Its terms are all lower-case words of the
examples; a term weighs (1 + ln tf) * idf, times a factor between ``FLOOR`` and 1 that grows with
its dependence on the label (chi-squared with one degree of freedom), so that subjects and
languages don't drown what tells the labels apart.  A text's vector has length one over all its
words, those of no example included.  The index is inverted: a term's list is cut by blocks of
examples and keeps each block's greatest weight; the lists of frequent terms are stored with a
place for every example.  A query sums the maxima of its terms into a bound for each block, reads
blocks from the highest bound on and stops when no bound can change the ``k`` nearest found, so
they are exact.  The neighbours vote with their cosines against a constant vote for "not toxic"; a
logistic curve fitted on left-one-out votes of the sample, weighted to the labels' true shares,
turns votes into probabilities.  Near copies among the sampled texts count as one example.

The sample takes at most ``per_label`` texts of each label by the order of a hash of their
ids; texts over ``longest`` bytes are not taken.  Scoring reads whole texts.

Defined results: a null or empty text, or one without a word of any example, has no
neighbours and gets the probability of no evidence; without labels every score is 0.  Each row
is scored for itself, repeated ids and repeated rows too; of rows that share an id the sample
takes one for each label that the id has, that of the smallest text hash.  Examples of equal
cosine come in the order of their places in the index.  Output columns replace input columns of
the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm.packed import frugal, small_batches
from quarrylens.llm.sampling import one_text_each, smallest_hashes
from quarrylens.llm.words import Words, mix, runs, text_slices

SLICE = 1 << 20
#: Only letters make words: ASCII letters and all beyond ASCII.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False


#: The least factor of a term, of one that says nothing about the label.
FLOOR = 0.3


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash of a lower-case word, count), by text and hash."""
    words = Words(data, offsets, NOT_LETTER)
    terms, place = np.unique(words.hashes(lower=True), return_inverse=True)
    pairs, counts = np.unique(words.owner() * max(1, len(terms)) + place, return_counts=True)
    return pairs // max(1, len(terms)), terms[pairs % max(1, len(terms))], counts


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for ``size[0]`` numbers, then those from first[1] on, and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


@dataclass
class Index:
    #: of each term its hash, its weight and its row among the frequent ones (or -1); then the weight of any other word
    vocabulary: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    other: float
    #: frequent terms: weights by block, row, example of the block, and maxima by row, block
    dense: np.ndarray
    dense_highest: np.ndarray
    #: other terms: a term's first entry; an entry's block, maximum and first posting; a posting's example and weight
    entries: np.ndarray
    block: np.ndarray
    highest: np.ndarray
    postings: np.ndarray
    seats: np.ndarray
    weights: np.ndarray
    #: of each example
    ids: np.ndarray
    toxic: np.ndarray
    k: int = 15
    slope: float = 1.0
    shift: float = 0.0

    def vectors(self, owner: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place of a term, its share in the text's vector of length one) of the terms that the index holds."""
        place = np.searchsorted(self.vocabulary, terms)
        place[place == len(self.vocabulary)] = 0
        hit = self.vocabulary[place] == terms
        w = (1 + np.log(counts)) * np.where(hit, self.weight[place], self.other)
        length = np.sqrt(np.bincount(owner, w * w))
        return owner[hit], place[hit], (w / length[owner])[hit]

    def nearest(self, place: np.ndarray, q: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above 0, ties to the smaller seat, and the cosines."""
        blocks, size = self.dense.shape[0], self.dense.shape[2]
        frequent = self.row[place] >= 0
        rows, q_rows = self.row[place[frequent]], q[frequent]
        rare, q_rare = place[~frequent], q[~frequent]
        number = self.entries[rare + 1] - self.entries[rare]
        entry, q_entry = ranges(self.entries[rare], number), np.repeat(q_rare, number)
        at_block = self.block[entry]
        bound = q_rows @ self.dense_highest[rows] + np.bincount(at_block, q_entry * self.highest[entry], minlength=blocks)
        order = np.argsort(-bound, kind="stable")
        seats, scores = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 8
        while at < blocks:
            least = scores[self.k - 1] if len(scores) >= self.k else 0.0
            # a bound equal to the least may still win a tie
            some = order[at : at + step]
            some = some[(bound[some] >= least - 1e-9) & (bound[some] > 0)]
            if not len(some):
                break
            chosen = np.zeros(blocks, bool)
            chosen[some] = True
            read = np.flatnonzero(chosen[at_block])
            first = self.postings[entry[read]]
            number = self.postings[entry[read] + 1] - first
            posting = ranges(first, number)
            found = np.bincount(self.seats[posting], self.weights[posting] * np.repeat(q_entry[read], number), minlength=blocks * size).astype(float)
            if len(rows):
                for b in some.tolist():
                    found[b * size : (b + 1) * size] += q_rows @ self.dense[b, rows]
            seat = np.flatnonzero((found > 1e-12) & np.repeat(chosen, size))
            seat = seat[seat != without]
            seats, scores = np.append(seats, seat), np.append(scores, found[seat])
            best = np.lexsort((seats, -scores.round(12)))[: self.k]
            seats, scores = seats[best], scores[best]
            at, step = at + step, step * 2
        return seats, scores

    def vote(self, seats: np.ndarray, scores: np.ndarray) -> float:
        return float((scores * self.toxic[seats]).sum() / (scores.sum() + 0.5))

    def probability(self, vote: np.ndarray | float) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * np.asarray(vote) + self.shift)))


def without_copies(texts: list[tuple[int, int, np.ndarray, np.ndarray]], hashes: int = 16, least: int = 10) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Examples without near copies of earlier ones (``least`` of so many minimal hashes of their
    words agree): a family of copies would make its rare words look as if they went with its label."""
    kept, marks = [], np.zeros((len(texts), hashes), np.uint64)
    seeds = mix(np.arange(1, hashes + 1, dtype=np.uint64))
    for example in texts:
        own = mix(example[2][:, None] ^ seeds).min(axis=0) if len(example[2]) else np.zeros(hashes, np.uint64)
        if not (len(example[2]) and ((marks[: len(kept)] == own).sum(axis=1) >= least).any()):
            marks[len(kept)] = own
            kept.append(example)
    return kept


def build(texts: list[tuple[int, int, np.ndarray, np.ndarray]], share: float, k: int = 15, block: int = 64, sure_chi: float = 16.0, least_df: int = 5, frequent: float = 1 / 16) -> Index:
    """From (id, label, word hashes, counts) of each example; share: of toxic among all labels.

    A term's factor is 1 from a chi-squared of ``sure_chi`` on; it stays at FLOOR for terms of fewer
    than ``least_df`` examples, where chance looks like dependence.  Terms of at least the share
    ``frequent`` of the examples have a place for every example, which is at most 1 / frequent times
    as much memory as postings."""
    texts = without_copies(texts)
    n = len(texts)
    toxic = np.array([y for _, y, _, _ in texts])
    owner = np.repeat(np.arange(n), [len(t) for _, _, t, _ in texts])
    terms, counts = (np.concatenate([t[i] for t in texts]) for i in (2, 3))
    vocabulary, place = np.unique(terms, return_inverse=True)
    pos = toxic.sum()
    df = np.bincount(place, minlength=len(vocabulary)).astype(float)
    hit = np.bincount(place, toxic[owner], minlength=len(vocabulary))
    a, b, c, d = hit, df - hit, pos - hit, n - pos - (df - hit)
    chi = n * (a * d - b * c) ** 2 / np.maximum(1e-9, (a + b) * (c + d) * (a + c) * (b + d))
    factor = FLOOR + (1 - FLOOR) * np.minimum(1, chi / sure_chi) ** 2 * (df >= least_df)
    idf = np.log((1 + n) / (1 + df)) + 1
    weight, other = idf * factor, (np.log(1 + n) + 1) * FLOOR
    w = (1 + np.log(counts)) * weight[place]
    w /= np.sqrt(np.bincount(owner, w * w, minlength=n))[owner]
    # examples with like words share blocks, which keeps the maxima apart
    lead = np.zeros(n, np.int64)
    best = np.lexsort((-w, owner))
    first = best[runs(owner[best])[:-1]]
    lead[owner[first]] = place[first] + 1
    order = np.lexsort((np.arange(n), lead, toxic))
    seat = np.empty(n, np.int64)
    seat[order] = np.arange(n)
    blocks = -(-n // block)
    often = df >= max(2, frequent * n)
    row = np.where(often, np.cumsum(often) - 1, -1)
    dense = np.zeros((blocks, int(often.sum()), block), np.float32)
    mine = often[place]
    dense[seat[owner[mine]] // block, row[place[mine]], seat[owner[mine]] % block] = w[mine]
    # postings of the others by term and seat, entries by term and block
    mine = np.flatnonzero(~mine)
    mine = mine[np.lexsort((seat[owner[mine]], place[mine]))]
    seats, weights = seat[owner[mine]], w[mine].astype(np.float32)
    postings = runs(place[mine] * blocks + seats // block)
    heads = postings[:-1]
    ids = np.array([i for i, _, _, _ in texts], np.int64)
    index = Index(
        vocabulary, weight, row, other, dense, dense.max(axis=2).T.copy(),
        np.searchsorted(place[mine][heads], np.arange(len(vocabulary) + 1)), (seats[heads] // block).astype(np.int32),
        np.maximum.reduceat(weights, heads) if len(heads) else weights, postings, seats.astype(np.int32), weights,
        ids[order], toxic[order], k,
    )
    votes = np.zeros(n)
    edge = np.searchsorted(owner, np.arange(n + 1))
    for i in range(n):
        own = slice(edge[i], edge[i + 1])
        votes[i] = index.vote(*index.nearest(place[own], w[own], int(seat[i])))
    _calibrate(index, votes, toxic, share)
    return index


def _calibrate(index: Index, votes: np.ndarray, toxic: np.ndarray, share: float) -> None:
    """A logistic curve by Newton's method, with a weak prior on its slope."""
    x = np.stack([votes, np.ones(len(votes))], 1)
    weight = np.where(toxic == 1, share / max(toxic.mean(), 1e-9), (1 - share) / max(1 - toxic.mean(), 1e-9))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        slope = x.T @ (weight * (toxic - p)) - 0.05 * beta * [1, 0]
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag([0.05, 1e-6])
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    index.slope, index.shift = float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = 1200, longest: int = 200_000, k: int = 15) -> Index | None:
    """An index from a bounded sample of the labelled texts (see above), or None without any."""
    able = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    count = {r["__y"]: r["n"] for r in able.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    if not count:
        return None
    ids = smallest_hashes(able, per_label).select("__id", "__y").distinct()
    chosen = docs.filter(F.octet_length(text_col) <= longest).join(F.broadcast(ids), F.col(id_col) == F.col("__id"))
    chosen = one_text_each(chosen.select("__id", "__y", F.col(text_col).alias("__t")), "__id", "__y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, data, offsets in text_slices(batches, "__t", SLICE):
            owner, terms, counts = term_counts(data, offsets)
            edge = np.searchsorted(owner, np.arange(table.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [table["__id"].combine_chunks().cast(pa.int64()), table["__y"].combine_chunks(), *(pa.array([x[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]) for x in (terms, counts.astype(np.int32)))],
                ["id", "y", "terms", "counts"],
            )

    found = sorted((r.id, r.y, bytes(r.terms), bytes(r.counts)) for r in small_batches(chosen).mapInArrow(frugal(run), "id long, y int, terms binary, counts binary").collect())
    if not found:
        return None
    texts = [(i, y, np.frombuffer(t, np.uint64), np.frombuffer(c, np.int32)) for i, y, t, c in found]
    return build(texts, count.get(1, 0) / sum(count.values()), k)


def score(docs: DataFrame, index: Index | None, text_col: str = "text") -> DataFrame:
    """``docs`` with score (probability of being toxic) and evidence (ids of the nearest examples)."""
    new = ["score", "evidence"]
    own = docs.drop(*new)
    schema = T.StructType(list(own.schema.fields)).add("score", T.DoubleType()).add("evidence", T.ArrayType(T.LongType()))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        known: dict[bytes, tuple[float, list[int]]] = {}
        for table, data, offsets in text_slices(batches, text_col, SLICE):
            votes, evidence = np.zeros(table.num_rows), [[] for _ in range(table.num_rows)]
            if index is not None and len(index.vocabulary):
                owner, place, q = index.vectors(*term_counts(data, offsets))
                edge = runs(owner)
                for a, b in zip(edge[:-1], edge[1:], strict=True):
                    key = blake2b(place[a:b].tobytes() + q[a:b].tobytes(), digest_size=16).digest()
                    if key not in known:
                        if len(known) > 20_000:
                            known.clear()
                        seats, scores = index.nearest(place[a:b], q[a:b])
                        known[key] = index.vote(seats, scores), index.ids[seats].tolist()
                    votes[owner[a]], evidence[owner[a]] = known[key]
            chance = index.probability(votes) if index is not None else votes
            table = table.append_column("score", pa.array(chance)).append_column("evidence", pa.array(evidence, pa.list_(pa.int64())))
            yield from table.to_batches()

    return small_batches(own).mapInArrow(frugal(run), schema)
