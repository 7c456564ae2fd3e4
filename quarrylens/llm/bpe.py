"""Byte-pair encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a slice of texts lie one after another in one array of symbols,
linked to their neighbours.  The index maps the rank of each pair that occurs to all its
places.  Ranks are taken in ascending order; a rank's places are merged from left to right,
and the pairs that a merge makes are added to their ranks' lists.  (A merged symbol exists
only from its rank on, so a rank never comes up again; an outdated place is recognised by its
symbols.)  Each pre-token is encoded once a worker, and texts are joined from the results.

The vocabulary file is read from its path, a parameter; it must be present on the executors.
It is a ``tokenizers`` file with a BPE model over byte symbols, an optional end-of-word
suffix, NFC, white space and lower-case normalisers, and a pattern that keeps its matches.

Defined results: a null text counts as empty and gives no ids; decoding no ids gives an empty
text; null ids decode to null.  Each row is encoded for itself, repeated ids and repeated rows
too; a long text without white space is one pre-token or few, which a slice holds whole.  Output
columns replace input columns of the same name.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarrylens.llm.packed import frugal, small_batches

#: White space as the tokenizers' regular expressions have it.
SPACE = "[\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
#: Pre-tokens that a worker keeps encoded, and the characters of texts encoded together.
KEPT = 600_000
SLICE = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is visible, else the next from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocabulary = dict(model["vocab"])
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: rank by pair (left id * 2**16 + right id), pair and merged id by rank, pairs in ascending order with their ranks
        self.pair = [vocabulary[a] << 16 | vocabulary[b] for a, b in merges]
        self.rank = {p: r for r, p in enumerate(self.pair)}
        self.merged = [vocabulary[a + b] for a, b in merges]
        self.ranked = np.argsort(self.pair)
        self.pairs = np.array(self.pair)[self.ranked]
        symbols = byte_symbols()
        self.inner = [vocabulary[s] for s in symbols]
        self.final = [vocabulary[s + self.suffix] for s in symbols]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {**{i: s for s, i in vocabulary.items()}, **{i: s for s, i in self.special.items()}}
        self.names = pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())
        (split,) = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.split = regex.compile(split.replace("\\s", SPACE[1:-1]), flags=regex.V0)
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.known: dict[str, bytes] = {s: np.array([i], np.int32).tobytes() for s, i in self.special.items()}

    def normal(self, text: str) -> str:
        # white space needs no normal form: the pattern drops it, and no match spans it
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # without the context rule for a final sigma
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens, and special tokens as they stand."""
        if "<|" not in text:
            return self.split.findall(self.normal(text))
        out: list[str] = []
        for k, part in enumerate(self.specials.split(text)):
            out += [part] if k % 2 else self.split.findall(self.normal(part))
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Encodes these pre-tokens together."""
        words = list(words)
        raw = [w.encode() for w in words]
        edges = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        data = np.frombuffer(b"".join(raw), np.uint8)
        first = np.array(self.inner)[data]
        first[edges[1:] - 1] = np.array(self.final)[data[edges[1:] - 1]]
        n = len(first)
        # the index: places of each pair that has a rank, by rank
        inside = np.ones(n, bool)
        inside[edges[1:] - 1] = False
        at = np.flatnonzero(inside)
        code = first[at] << 16 | first[at + 1]
        slot = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        hit = self.pairs[slot] == code
        at, ranks = at[hit], self.ranked[slot[hit]]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cut = np.flatnonzero(np.diff(ranks, prepend=-1))
        places = {r: p.tolist() for r, p in zip(ranks[cut].tolist(), np.split(at, cut[1:]), strict=True)} if len(at) else {}
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[edges[1:] - 1] = -1
        before[edges[:-1]] = -1
        symbol, after, before = first.tolist(), after.tolist(), before.tolist()
        rank, pair, merged = self.rank.get, self.pair, self.merged
        active = list(places)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            left, right = pair[r] >> 16, pair[r] & 0xFFFF
            new = merged[r]
            high = new << 16
            spots = places.pop(r)
            spots.sort()
            for i in spots:
                j = after[i]
                if j < 0 or symbol[i] != left or symbol[j] != right:
                    continue
                symbol[i], symbol[j] = new, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    x = rank(high | symbol[k])
                    if x is not None:
                        if x in places:
                            places[x].append(i)
                        else:
                            places[x] = [i]
                            heapq.heappush(active, x)
                h = before[i]
                if h >= 0:
                    x = rank(symbol[h] << 16 | new)
                    if x is not None:
                        if x in places:
                            places[x].append(h)
                        else:
                            places[x] = [h]
                            heapq.heappush(active, x)
        ids = np.array(symbol, np.int32)
        live = ids >= 0
        stops = np.concatenate(([0], np.cumsum(live)))[edges] * 4
        data = ids[live].tobytes()
        for w, a, b in zip(words, stops[:-1].tolist(), stops[1:].tolist(), strict=True):
            self.known[w] = data[a:b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as 32-bit numbers."""
        split = [self.pieces(t) for t in texts]
        fresh = set().union(*split).difference(self.known)
        if fresh:
            if len(self.known) + len(fresh) > KEPT:
                keep = {s: self.known[s] for s in self.special}
                self.known = keep
                fresh = set().union(*split).difference(keep)
            self.learn(sorted(fresh))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text, without added special tokens."""
    own = docs.drop(ids_col)
    schema = T.StructType(list(own.schema.fields)).add(ids_col, T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE, "right")))
                part = batch.slice(at, end - at)
                found = codec(path).encode([t or "" for t in part.column(text_col).to_pylist()])
                edge = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(edge), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield _with_column(part, ids_col, ids)
                at = end

    return small_batches(own).mapInArrow(frugal(run), schema)


def decode(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of each row's ids: the file has no decoder, so tokens are joined by spaces."""
    own = docs.drop(text_col)
    schema = T.StructType(list(own.schema.fields)).add(text_col, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids = batch.column(ids_col)
                offsets = np.asarray(ids.offsets)
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
                part = batch.slice(at, end - at)
                ids = part.column(ids_col)
                tokens = codec(path).names.take(ids.flatten())
                sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                edge = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                text = pc.binary_join(pa.ListArray.from_arrays(edge, tokens), " ")
                yield _with_column(part, text_col, pc.if_else(pc.is_valid(ids), text, None))
                at = end

    return own.mapInArrow(frugal(run), schema)
