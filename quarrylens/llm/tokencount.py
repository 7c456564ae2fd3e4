"""Token counts that follow edits.

Each document keeps a segment tree over its pre-tokens: a leaf holds a run of pre-tokens with
their characters and token counts, an inner node the sums of its two children.  An edit finds
its place by character sums, re-splits the text from a few characters before it (no match of
the pattern looks further ahead) until a new boundary falls on an old one behind the edit,
encodes the new pre-tokens only, and updates the sums on the paths of the leaves it touched.

Counts are those of the ``tokenizers`` file without added special tokens, whose strings in a
text count as ordinary text.  The file's path is a parameter and must exist on the executors.

Defined results: a null text counts as empty and has 0 tokens; null edits mean no edit; an
edit's range is cut to the text (a negative or null start is 0, a stop before the start is the
start) and a null replacement is empty; edits apply in order, each to the text left by the
one before.  Each row is counted for itself, repeated ids and repeated rows too.  Output columns
replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarrylens.llm.packed import frugal, small_batches
from quarrylens.llm.packing import ByteCodec, byte_codec

#: Pre-tokens of a new leaf, and of a leaf that has grown so far that the tree is built anew.
LEAF = 16
GROWN = 256
#: Characters before an edit that a match can look ahead to.
CONTEXT = 3
KEPT = 500_000


class Counter:
    """Token counts of pre-tokens, each encoded once a worker."""

    def __init__(self, codec: ByteCodec):
        self.plain = codec.plain
        self.split = regex.compile(codec.PATTERN)
        self.known: dict[str, int] = {}

    def counts(self, words: list[str]) -> list[int]:
        known = self.known
        fresh = set(words).difference(known)
        if len(known) + len(fresh) > KEPT:
            known.clear()
            fresh = set(words)
        for w in fresh:
            known[w] = len(self.plain.encode_ordinary(w))
        return [known[w] for w in words]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(byte_codec(path))


class TokenTree:
    def __init__(self, text: str, counter: Counter):
        self.counter, self.text = counter, text
        self.encoded = 0
        words = counter.split.findall(text)
        self._build([len(w) for w in words], self._count(words))

    def _count(self, words: list[str]) -> list[int]:
        self.encoded += len(words)
        return self.counter.counts(words)

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.lengths = [lengths[i : i + LEAF] for i in range(0, len(lengths), LEAF)] or [[]]
        self.counts = [counts[i : i + LEAF] for i in range(0, len(counts), LEAF)] or [[]]
        self.width = 1 << (len(self.lengths) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (n, c) in enumerate(zip(self.lengths, self.counts, strict=True)):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(n), sum(c)
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character's place (the last one for the end), and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        if leaf >= len(self.lengths):
            leaf = len(self.lengths) - 1
            start = self.chars[1] - self.chars[self.width + leaf]
        return leaf, start

    def _update(self, first: int, last: int) -> None:
        touched = set()
        for leaf in range(first, last + 1):
            node = self.width + leaf
            self.chars[node], self.tokens[node] = sum(self.lengths[leaf]), sum(self.counts[leaf])
            touched.add(node // 2)
        while touched - {0}:
            for node in touched:
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            touched = {n // 2 for n in touched} - {0}

    def edit(self, start: int, stop: int, new: str) -> None:
        text = self.text
        start = min(max(start, 0), len(text))
        stop = min(max(stop, start), len(text))
        self.text = after = text[:start] + new + text[stop:]
        shift = len(after) - len(text)
        # the first pre-token that ends near the edit or behind it
        first, at = self._leaf(max(0, start - CONTEXT))
        head = 0
        lengths = self.lengths[first]
        while head < len(lengths) and at + lengths[head] <= start - CONTEXT:
            at += lengths[head]
            head += 1
        # old boundaries from there on, found as the new split goes on
        leaf, place, bound = first, head, at
        words: list[str] = []
        for match in self.counter.split.finditer(after, at):
            if match.start() >= start + len(new):
                while bound < match.start() - shift and leaf < len(self.lengths):
                    if place < len(self.lengths[leaf]):
                        bound += self.lengths[leaf][place]
                        place += 1
                    else:
                        leaf, place = leaf + 1, 0
                if bound == match.start() - shift and bound >= stop:
                    break
            words.append(match.group())
        else:
            leaf, place = len(self.lengths), 0
        if leaf >= len(self.lengths):
            leaf, place = len(self.lengths) - 1, len(self.lengths[-1])
        own, counts = [len(w) for w in words], self._count(words)
        for rows, fresh in ((self.lengths, own), (self.counts, counts)):
            if leaf == first:
                rows[first] = rows[first][:head] + fresh + rows[first][place:]
            else:
                rows[first] = rows[first][:head] + fresh
                rows[leaf] = rows[leaf][place:]
                for i in range(first + 1, leaf):
                    rows[i] = []
        if len(self.lengths[first]) > GROWN:
            self._build([n for x in self.lengths for n in x], [c for x in self.counts for c in x])
        else:
            self._update(first, leaf)


def recount(docs: DataFrame, path: str, text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """``docs`` with n_tokens, n_pretokens, edited (the text after its edits: structs of start,
    stop and text), n_tokens_edited and n_reencoded (pre-tokens that the edits re-encoded)."""
    new = {"n_tokens": T.LongType(), "n_pretokens": T.LongType(), "edited": T.StringType(), "n_tokens_edited": T.LongType(), "n_reencoded": T.LongType()}
    own = docs.drop(*new)
    schema = T.StructType(list(own.schema.fields) + [T.StructField(n, t) for n, t in new.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out: list[list] = [[] for _ in new]
                texts, edits = (batch.column(batch.schema.get_field_index(c)) for c in (text_col, edits_col))
                for text, steps in zip(texts.to_pylist(), edits.to_pylist(), strict=True):
                    tree = TokenTree(text or "", counter(path))
                    before, pieces = tree.total, tree.encoded
                    for step in steps or []:
                        if step is not None:
                            tree.edit(step["start"] or 0, step["stop"] or 0, step["text"] or "")
                    for column, value in zip(out, (before, pieces, tree.text, tree.total, tree.encoded - pieces), strict=True):
                        column.append(value)
                kinds = [pa.string() if isinstance(t, T.StringType) else pa.int64() for t in new.values()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], [*batch.schema.names, *new])

    return small_batches(own).mapInArrow(frugal(run), schema)
