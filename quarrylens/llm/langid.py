"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's features are its byte n-grams (2 to 4 bytes, ASCII letters in lower case, other ASCII
as a space) hashed into ``2**BITS`` rows of an embedding table; the mean of their rows goes
through a linear softmax.  Both are trained by stochastic gradient descent in numpy on a
bounded sample.  As the softmax's input is linear in the embeddings, prediction uses the
product of the two tables, one number for each hash row and language, which is exact and
needs one lookup a feature.  A temperature and a rejection threshold are fitted on a fifth of
the sample that training does not see: the threshold lies half way, in log-odds, between the
scores of made-up words of random letters and the least of the texts labelled rightly there (the
sample is too small to show either tail); where they overlap it rejects one in 500 of the
latter, and up to one in 100 if the former ask for it.

The sample takes at most ``per_language`` labelled texts of each language and ``most`` in all,
by the order of a hash of their ids; texts over ``longest`` bytes are not taken, nor languages
beyond the ``languages`` most frequent ones.  Prediction reads whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and not
accepted; rows with null labels only get predictions; without labelled rows all is ``und``.
Each row is predicted for itself, repeated ids and repeated rows too; of rows that share an id
the sample takes one, that of the smallest text hash.  Languages of equal probability go to the
first by name.
Output columns replace input columns of the same name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm.packed import frugal, small_batches
from quarrylens.llm.sampling import one_text_each, smallest_hashes
from quarrylens.llm.words import U, byte_values, text_slices

BITS = 15
WIDTH = 16
GRAMS = (2, 3, 4)
SLICE = 1 << 20


@dataclass
class Model:
    languages: list[str]
    #: hash rows x languages
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: a lower score is rejected
    threshold: float = 0.0


def _fold() -> np.ndarray:
    """Random values of bytes; all ASCII but letters has one value."""
    values = byte_values(0, True).copy()
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = letter[128:] = True
    values[~letter] = values[32]
    # the second bytes of Latin capitals with marks count as those of their small letters
    values[0x80:0x9F] = values[0xA0:0xBF]
    return values


def grams(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each length, the hash row of the n-gram that starts at each byte."""
    value = _fold()[data]
    total = value.copy()
    for n in range(2, max(GRAMS) + 1):
        total = total[:-1] * U(0xD1342543DE82EF95)
        total += value[n - 1 :]
        if n in GRAMS:
            yield n, ((total ^ (total >> U(29))) * U(0x9FB21C651E98DF25 | 1) >> U(64 - BITS)).astype(np.int32)


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's hash rows and their shares."""
    count = np.zeros(1 << BITS, np.int64)
    for _, rows in grams(data) if len(data) >= 2 else ():
        count += np.bincount(rows, minlength=1 << BITS)
    rows = np.flatnonzero(count)
    return rows, (count[rows] / max(1, count.sum())).astype(np.float32)


def logits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text in a slice."""
    n = len(offsets) - 1
    out = np.zeros((n, len(model.languages)))
    length = np.diff(offsets)
    some = np.flatnonzero(length >= 2)
    if len(some):
        for size, rows in grams(data):
            inside = np.ones(len(rows) + 1, bool)
            for back in range(1, size):
                at = offsets[1:] - back
                inside[at[(at >= 0) & (at < len(rows))]] = False
            inside[-1] = False
            rows = np.append(rows, 0)
            at = np.minimum(offsets[some], len(rows) - 1)
            for c in range(len(model.languages)):
                out[some, c] += np.add.reduceat(np.where(inside, model.table[rows, c], 0).astype(np.float64), at)
        count = sum(np.maximum(0, length - size + 1) for size in GRAMS)
        out /= np.maximum(1, count)[:, None]
    return out + model.bias


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def made_up(text: str, size: int = 200) -> str:
    """Words of random letters of a text."""
    letters = sorted({c for c in text if c.isalpha()}) or ["a"]
    rng = np.random.default_rng(zlib.crc32(text.encode()))
    drawn = [letters[i] for i in rng.integers(0, len(letters), size)]
    for at in np.cumsum(rng.integers(3, 10, size)):
        if at < size:
            drawn[at] = " "
    return "".join(drawn)


def fit(samples: list[tuple[np.ndarray, np.ndarray, str]], epochs: int = 8, rate: float = 3.0, seed: int = 7, negatives: list[tuple[np.ndarray, np.ndarray]] = ()) -> Model:
    """From (hash rows, shares, language) of each text, and (hash rows, shares) of made-up ones."""
    languages = sorted({y for _, _, y in samples})
    rng = np.random.default_rng(seed)
    label = np.array([languages.index(y) for _, _, y in samples])
    order = rng.permutation(len(samples))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    embedding = rng.normal(0, 0.1, (1 << BITS, WIDTH)).astype(np.float32)
    weight = np.zeros((WIDTH, len(languages)), np.float32)
    weight += rng.normal(0, 0.1, weight.shape)
    bias = np.zeros(len(languages), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(train):
            rows, share, _ = samples[i]
            if not len(rows):
                continue
            own = embedding[rows]
            hidden = share @ own
            error = softmax(hidden @ weight + bias)
            error[label[i]] -= 1
            back = weight @ error
            weight -= step * 0.1 * np.outer(hidden, error)
            bias -= step * 0.01 * error
            embedding[rows] = own - (step * share)[:, None] * len(rows) ** 0.5 * back
    # rows of features that training never saw say nothing
    unseen = np.ones(1 << BITS, bool)
    for i in train:
        unseen[samples[i][0]] = False
    embedding[unseen] = 0
    model = Model(languages, (embedding @ weight).astype(np.float32), bias.astype(np.float64))
    if len(held):
        raw = np.array([samples[i][1] @ model.table[samples[i][0]] if len(samples[i][0]) else np.zeros(len(languages)) for i in held]) + model.bias
        loss = [(-np.log(np.maximum(softmax(raw / t)[np.arange(len(held)), label[held]], 1e-12)).mean(), t) for t in np.geomspace(0.05, 5, 40)]
        # the highest temperature that is about as good as the best: no more sure than the texts ask for
        model.temperature = float(max(t for x, t in loss if x <= min(loss)[0] + 0.01))
        chance = softmax(raw / model.temperature)
        right = chance.max(axis=1)[chance.argmax(axis=1) == label[held]]
        if len(right):
            # at most one in 500 of the texts labelled rightly, or one in 100 to reject made-up ones
            low, high = np.quantile(right, [0.002, 0.01], method="lower")
            odd = [softmax((share @ model.table[rows] + model.bias) / model.temperature).max() for rows, share in negatives if len(rows)]
            made = np.quantile(odd, 0.99) if odd else low
            odds = lambda x: np.log(x / max(1 - x, 1e-12))
            model.threshold = float(1 / (1 + np.exp(-(odds(made) + odds(low)) / 2)) if made < low else max(low, min(high, made)))
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = 500, most: int = 5000, longest: int = 200_000, languages: int = 2000) -> Model | None:
    """A model from a bounded sample of ``docs`` (see above), or None without labelled rows."""
    able = docs.filter(F.col(label_col).isNotNull() & F.col(text_col).rlike("\\p{L}") & (F.octet_length(text_col) <= longest))
    ids = able.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y"))
    ids = smallest_hashes(ids, per_language, languages).orderBy("__n", "__h", "__id", "__y").limit(most).select("__id").distinct()
    chosen = able.join(F.broadcast(ids), F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    chosen = one_text_each(chosen.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"), F.col(label_col).cast("string").alias("__y")), "__id").select("__t", "__y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, data, offsets in text_slices(batches, "__t", SLICE):
            found = [features(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            odd = [features(np.frombuffer(made_up(data[a:b].tobytes().decode(errors="replace")).encode(), np.uint8)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            labels = pa.array(table["__y"].to_pylist() + [None] * len(odd), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.int32).tobytes() for x, _ in found + odd], pa.binary()), pa.array([x.tobytes() for _, x in found + odd], pa.binary()), labels], ["rows", "share", "y"])

    samples = small_batches(chosen).mapInArrow(frugal(run), "rows binary, share binary, y string").collect()
    pair = lambda a, b: (np.frombuffer(a, np.int32), np.frombuffer(b, np.float32))
    odd = [pair(bytes(r.rows), bytes(r.share)) for r in samples if r.y is None]
    samples = sorted((r.y, bytes(r.rows), bytes(r.share)) for r in samples if r.y is not None)
    return fit([(*pair(a, b), y) for y, a, b in samples], negatives=odd) if samples else None


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (calibrated probability) and accepted."""
    new = ["lang_pred", "score", "accepted"]
    own = docs.drop(*new)
    schema = T.StructType(list(own.schema.fields)).add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("accepted", T.BooleanType())
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = own.withColumn("__letters", F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for table, data, offsets in text_slices(batches, text_col, SLICE):
            letters = table["__letters"].to_numpy()
            if model is None:
                names, score = np.full(len(letters), "und", object), np.zeros(len(letters))
            else:
                chance = softmax(logits(model, data, offsets) / model.temperature)
                names = np.where(letters, np.array(model.languages, object)[chance.argmax(axis=1)], "und")
                score = np.where(letters, chance.max(axis=1), 0.0)
            accepted = letters & (score >= (model.threshold if model else 2))
            table = table.drop_columns(["__letters"])
            for name, column in zip(new, (pa.array(names, pa.string()), pa.array(score), pa.array(accepted)), strict=True):
                table = table.append_column(name, column)
            yield from table.to_batches()

    return small_batches(own).mapInArrow(frugal(run), schema)
