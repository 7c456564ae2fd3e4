"""Similarity join of shingle sets by PartEnum signatures, and the groups that its links form.

A document's set holds its distinct n-word shingles (hashes of 64 bits).  Sets are put into
size bands; two sets that reach the similarity lie in one band or in neighbouring ones, and
then differ in at most ``k`` elements, a number that the bands fix.  For each pair of bands
the feature domain is dealt into ``groups`` parts of three cells each.  A signature is the
content of two of the three cells of a part (all subsets of that size are enumerated), so one
differing element spoils two signatures of a part and a second one the third: sets that
differ in at most k elements agree in ``spare + 1`` signatures or more, by counting.

That surplus is what makes hot signatures harmless, and exactly so: whether a signature is
common (held by over ``weak`` sets) or empty depends on its content alone, so both sides of
an agreement see it alike; a set may drop its common and empty signatures as long as these
are ``spare`` at most, and the two sides still agree in one that both keep.  A set with more
of them (a member of a large group of near copies) keeps all.

Groups are found without listing all pairs within a bucket: equal sets are one node, each
bucket is first linked to its smallest node, and only buckets whose nodes are then still in
different groups are compared further, in blocks of bounded size and across groups only.
Candidates pass an exact filter before sets are fetched: each set has a mark of 2,048 bits,
the parities of its elements by hash, and two marks never differ in more bits than the sets
differ in elements.  Of the pairs that pass, a block gives only those that join groups which
are still apart in it: 16 spanning forests that share no pair, each of fewer pairs than there are
nodes.  Every link used is verified on whole sets.  If all pairs of a bucket's forests are
links, the pairs left out add nothing; where one is not, the bucket comes again with 16 times
as many forests, until no pair was left out or all that were given are links.  So two sets
that reach the similarity always end in one group, and a round emits at most nodes times
forests.

Defined results: null text, empty text and text without words have an empty set, no links
and their own id; a null id counts as larger than all ids; rows with equal ids are documents
of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.llm.components import components
from quarrylens.llm.packed import CHUNK_BYTES, ROW, bucket_count, frugal, frugal_group, pack, small_batches, unpack
from quarrylens.llm.storage import written
from quarrylens.llm.words import U, Words, mix, runs, text_slices, windows

NONE = np.iinfo(np.int64).max
FACTS, RECORDS, LOCAL = range(3)
FOUND = "kind int, a long, b long, c long, d long, e long, mark binary"
#: A signature held by more sets than this is common.
WEAK = 40
#: Sets to verify are sent to all tasks by key only if there are no more keys than this.
SMALL = 200_000
#: Bits of a mark, and nodes of a bucket that one task compares with as many others.
BITS = 2048
BLOCK = 1500
#: Forests of pairs that a block gives at first, and times as many whenever that was not enough.
FORESTS = 16


class Bands:
    """Size bands for a similarity of ``num`` / ``den``; pair g joins bands g - 1 and g."""

    def __init__(self, num: int, den: int, most: int):
        self.ends = [1]
        while self.ends[-1] < most:
            self.ends.append(max(self.ends[-1] + 1, self.ends[-1] * den // num))
        self.ends.append(max(self.ends[-1] + 1, self.ends[-1] * den // num))
        self.k = [0] + [(den - num) * (a + b) // (den + num) for a, b in zip(self.ends[:-1], self.ends[1:], strict=True)]
        self.groups = [-(-5 * (k + 1) // 8) if k else 0 for k in self.k]
        spoilt = [2 * min(k, n) + max(0, min(k - n, n)) for k, n in zip(self.k, self.groups, strict=True)]
        #: signatures that a set may drop
        self.spare = [max(0, 3 * n - s - 1) for n, s in zip(self.groups, spoilt, strict=True)]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.ends), sizes)


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Each document's distinct shingles; a document of fewer words is one shingle as a whole."""
    hashes = words.hashes(lower=True)
    at, found = windows(hashes, words, n)
    edge = np.searchsorted(at, words.bounds)
    out = [np.unique(found[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    for length in range(1, n):
        short = np.flatnonzero(words.count == length)
        if len(short):
            at, found = windows(hashes, words, length)
            whole = mix(found[np.searchsorted(at, words.bounds[short])] + U(length))
            for d, x in zip(short, whole, strict=True):
                out[d] = np.array([x])
    return out


def _node(shingles: np.ndarray) -> np.int64:
    return mix(np.array([mix(shingles).sum(dtype=U) + U(len(shingles) * 2 + 1)]))[0].astype(np.int64)


def _mark(shingles: np.ndarray) -> np.ndarray:
    return np.packbits((np.bincount((shingles & U(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8))


def _may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """Of rows of marks and of sizes: False only if the sets can't reach the similarity."""
    apart = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    return (apart <= (den - num) * (n + m) // (den + num)) & (np.minimum(n, m) * den >= np.maximum(n, m) * num)


def _signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, index of the set, 0 for the set's own pair of bands or 1 for the next)."""
    sizes = np.array([len(s) for s in sets])
    band = bands.of(sizes)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    part, cell, value = (every >> U(33)).astype(np.int64), (mix(every + U(1)) >> U(40)).astype(np.int64) % 3, mix(every ^ U(0x5851F42D4C957F2D))
    out = []
    for upper in (0, 1):
        pair = band + upper
        groups = np.array(bands.groups)[pair]
        base = np.concatenate(([0], np.cumsum(groups * 3)))
        use = groups[owner] > 0
        if not use.any():
            continue
        o = owner[use]
        where = base[o] + part[use] % groups[o] * 3 + cell[use]
        cells = np.zeros(base[-1], U)
        np.add.at(cells, where, value[use])
        cells = cells.reshape(-1, 3)
        holder = np.repeat(np.arange(len(sets)), groups)
        salt = mix((np.arange(len(holder)) - np.repeat(base[:-1] // 3, groups)).astype(U) * U(3) + (pair[holder].astype(U) << U(40)))
        for skip in range(3):
            x, y = cells[:, (skip + 1) % 3], cells[:, (skip + 2) % 3]
            signature = mix(mix(x + salt + U(skip)) + y * U(0x9FB21C651E98DF25 | 1))
            empty = (x == 0) & (y == 0)
            out.append((signature, holder, np.full(len(holder), upper), empty))
    if not out:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    signature, holder, upper, empty = (np.concatenate(x) for x in zip(*out, strict=True))
    spare = np.array(bands.spare)[band[holder] + upper]
    blank = np.bincount(holder * 2 + upper, empty, minlength=2 * len(sets))[holder * 2 + upper]
    keep = ~empty | (blank > spare // 2)
    return signature[keep], holder[keep], upper[keep]


def _chunks(n: int, bands: Bands, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (table, data, offsets) in enumerate(text_slices(batches, "__text", CHUNK_BYTES)):
            src = (TaskContext.get().partitionId() << 32) | k
            sets = shingle_sets(Words(data, offsets), n)
            ids, keys = table["__id"].fill_null(NONE).to_numpy(), table["__row"].to_numpy()
            sizes = np.array([len(s) for s in sets])
            nodes = np.array([_node(s) if len(s) else 0 for s in sets])
            marks = np.concatenate([_mark(s) for s in sets])
            out = [(-src - 1, src, FACTS, pack(ids, keys, nodes, sizes, marks))]
            first = np.unique(nodes, return_index=True)[1]
            first = first[sizes[first] > 0]
            if len(first):
                own, band = nodes[first], bands.of(sizes[first])
                signature, holder, upper = _signatures([sets[i] for i in first], bands)
                order = np.lexsort((holder, signature))
                signature, holder, upper = signature[order], holder[order], upper[order]
                edge = runs(signature)
                held = np.diff(edge)
                many = np.repeat(held > 1, held)
                bucket = (signature >> U(32)) * U(buckets) >> U(32)
                name = ((bucket << U(32)) | (signature & U(0xFFFFFFFF))).astype(np.int64)
                if many.any():
                    out.append((-src - 1, src, LOCAL, pack(name[many], own[holder[many]], (band[holder] + upper)[many].astype(np.int16))))
                lead = edge[:-1]
                bucket = bucket[lead].astype(np.int64)
                edge = runs(bucket)
                for a, b in zip(edge[:-1], edge[1:], strict=True):
                    at = lead[a:b]
                    those, index = np.unique(holder[at], return_inverse=True)
                    index = index * 2 + upper[at]
                    index = index.astype(np.uint16 if len(those) < 1 << 15 else np.uint32)
                    out.append((int(bucket[a]), src, RECORDS, pack(signature[at].astype(np.uint32), index, held[a:b].astype(np.uint16), own[those], band[those].astype(np.int16))))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["dest", "src", "kind", "blob"])

    return run


def _frame(kind: int, a, b, c, d, e, mark=None) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.full(len(a), kind, np.int32), "a": a, "b": b, "c": c, "d": d, "e": e, "mark": mark})


def _shared(group: pd.DataFrame) -> pd.DataFrame:
    """A bucket's signatures that two nodes or more hold, with the number of holders."""
    if group.dest.iloc[0] < 0:
        out = []
        for kind, blob in zip(group.kind, group.blob, strict=True):
            x = unpack(blob)
            out.append(_frame(FACTS, x[0], x[2], x[3], x[1], 0, [m.tobytes() for m in x[4].reshape(len(x[0]), -1)]) if kind == FACTS else _frame(LOCAL, x[0], x[1], 0, x[2].astype(np.int64), 1))
        return pd.concat(out)
    blobs = [unpack(b) for b in group.blob]
    key = np.concatenate([b[0] for b in blobs])
    held = np.concatenate([b[2] for b in blobs]).astype(np.int64)
    node = np.concatenate([b[3][b[1] >> 1] for b in blobs])
    pair = np.concatenate([b[4][b[1] >> 1] + (b[1] & 1).astype(np.int16) for b in blobs]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    edge = runs(key[order])
    size = np.diff(edge)
    total = np.repeat(np.add.reduceat(held[order], edge[:-1]), size)
    order = order[total > 1]
    name = (np.int64(group.dest.iloc[0]) << 32) | key[order].astype(np.int64)
    return _frame(RECORDS, name, node[order], total[total > 1], pair[order], held[order])


def linked_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, weak: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with their classes, and the verified links between classes.

    The first frame has __id, __row (xxhash64 of the text), node (the set; equal sets are one
    node), n_shingles and component (the smallest node reachable; null for an empty set), a row
    per document; the second frame has u and v, nodes of verified links that join all groups.
    """
    weak = WEAK if weak is None else weak
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(text_col).alias("__row"), F.col(text_col).cast("string").alias("__text"))
    sizes = docs.agg(F.sum(F.octet_length(text_col)).alias("total"), F.max(F.octet_length(text_col)).alias("longest")).first()
    # a word and its separator take two bytes or more, so no set is larger than this
    bands = Bands(num, den, max(2, (sizes["longest"] or 0) // 2 + 2))
    buckets = bucket_count(sizes["total"] or 0)
    found = written(small_batches(texts).mapInArrow(frugal(_chunks(n, bands, buckets)), ROW).groupBy("dest").applyInPandas(frugal_group(_shared), FOUND))
    facts = found.filter(F.col("kind") == FACTS).select(F.when(F.col("a") != NONE, F.col("a")).alias("__id"), F.col("d").alias("__row"), F.col("b").alias("node"), F.col("c").alias("n_shingles"))

    held = found.filter(F.col("kind") == RECORDS).select(F.col("a").alias("name"), F.col("b").alias("node"), F.col("c").alias("f"), F.col("d").alias("pair"), F.col("e").alias("own"))
    count = held.groupBy("name").agg(F.max("f").alias("f"))
    local = found.filter(F.col("kind") == LOCAL).select(F.col("a").alias("name"), F.col("b").alias("node"), F.col("d").alias("pair")).join(count, "name")
    rows = held.filter("own = 1").select("name", "node", "pair", "f").unionByName(local)
    spare = F.element_at(F.array(*[F.lit(s - s // 2) for s in bands.spare]), (F.col("pair") + 1).cast("int"))
    common = F.when(F.col("f") > weak, 1).otherwise(0)
    # a set that many chunks hold counts once
    rows = rows.distinct().withColumn("weak", F.sum(common).over(Window.partitionBy("node", "pair"))).filter((F.col("f") <= weak) | (F.col("weak") > spare))
    rows = written(rows.select("name", "node"))

    marks = found.filter(F.col("kind") == FACTS).select(F.col("b").alias("node"), F.col("c").alias("n"), "mark")
    marks = written(marks.join(rows.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.max("n").alias("n"), F.max("mark").alias("mark")))

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among candidate pairs (u, v), which are few enough past their marks that their sets can be fetched."""
        nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
        sets = _sets(texts, facts, nodes, n)
        u = sets.select(F.col("node").alias("u"), F.col("shingles").alias("x"))
        v = sets.select(F.col("node").alias("v"), F.col("shingles").alias("y"))
        enough = F.size(F.array_intersect("x", "y")) * (num + den) >= (F.size("x") + F.size("y")) * num
        return written(pairs.join(v, "v").join(u, "u").filter(enough).select("u", "v"))

    centre = rows.groupBy("name").agg(F.min("node").alias("u"))
    pairs = rows.join(centre, "name").filter("u <> node").select("u", F.col("node").alias("v")).distinct()
    tested = written(_past_marks(pairs, marks, num, den))
    links = verified(tested)
    groups = components(links)
    forests = FORESTS
    while True:
        left = rows.join(groups, "node", "left").select("name", "node", F.coalesce("component", "node").alias("component"))
        mixed = left.groupBy("name").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).filter("low <> high").select("name", "size")
        found_pairs = written(_across_groups(left.join(mixed, "name").join(marks, "node"), num, den, forests))
        new = written(found_pairs.select("u", "v").distinct().join(tested, ["u", "v"], "left_anti"))
        if not new.isEmpty():
            links = written(links.unionByName(verified(new)))
            groups = components(links)
        # buckets that left pairs out because of a pair that is no link
        failed = found_pairs.filter("more").join(links, ["u", "v"], "left_anti").select("name").distinct()
        rows = written(rows.join(failed, "name", "left_semi"))
        if rows.isEmpty():
            break
        tested, forests = written(tested.unionByName(new)), forests * FORESTS
    documents = facts.join(groups, "node", "left").withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")))
    return documents, links


def _past_marks(pairs: DataFrame, marks: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (u, v) whose marks allow the similarity."""
    u = marks.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("mark").alias("m_u"))
    v = marks.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("mark").alias("m_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, BITS // 64) for i in (2, 3))
            n, m = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(_may_link(x, y, n, m, num, den)))

    return pairs.join(v, "v").join(u, "u").select("u", "v", "m_u", "m_v", "n_u", "n_v").mapInArrow(frugal(run), "u long, v long")


class Forests:
    """Edge-disjoint forests over labels: a pair goes into the first one in which it joins two trees."""

    def __init__(self, labels: int, most: int):
        self.labels = np.arange(labels)
        self.most = most
        self.parents: list[np.ndarray] = []

    def add(self, a: int, b: int) -> bool:
        for parent in self.parents:
            x, y = self._root(parent, a), self._root(parent, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                return True
        if len(self.parents) == self.most:
            return False
        self.parents.append(self.labels.copy())
        self.parents[-1][max(a, b)] = min(a, b)
        return True

    @staticmethod
    def _root(parent: np.ndarray, x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def trees(self) -> np.ndarray:
        """The label of each label's tree in the last forest there may be, whose trees lie within those of the others."""
        if len(self.parents) < self.most:
            return self.labels
        parent = self.parents[-1]
        while True:
            up = parent[parent]
            if (up == parent).all():
                return parent
            self.parents[-1] = parent = up


def _spanning(marks: np.ndarray, group: np.ndarray, own: np.ndarray, same: np.ndarray, part: np.ndarray, n: np.ndarray, num: int, den: int, forests: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (x, y) of the pairs of each group's forests, and for each group whether pairs were left out.

    ``group`` ascends from 0; pairs of one ``part`` and, unless ``same``, of one ``own`` don't count."""
    edge = runs(group)
    stop = np.repeat(edge[1:], np.diff(edge))
    label = np.unique(np.stack((group, part), 1), axis=0, return_inverse=True)[1].ravel()
    trees = Forests(int(label.max()) + 1, forests)
    tree, omitted, whole = label, np.zeros(len(edge) - 1, bool), np.zeros(len(edge) - 1, bool)
    us, vs, apart = [], [], 1
    one = np.arange(len(group))
    while len(one := one[(one + apart < stop[one]) & ~whole[group[one]]]):
        a = one[(label[one] != label[one + apart]) & (same[one] | (own[one] != own[one + apart]))]
        # joined in all forests already
        known = tree[a] == tree[a + apart]
        omitted[group[a[known]]] = True
        a = a[~known]
        before = len(us)
        for k in range(0, len(a), 1 << 14):
            x = a[k : k + (1 << 14)]
            x = x[_may_link(marks[x], marks[x + apart], n[x], n[x + apart], num, den)]
            for i in x.tolist():
                if trees.add(label[i], label[i + apart]):
                    us.append(i)
                    vs.append(i + apart)
                else:
                    omitted[group[i]] = True
        if len(us) > before:
            tree = trees.trees()[label]
            # a group that is one tree in all forests takes no more
            whole = np.maximum.reduceat(tree, edge[:-1]) == np.minimum.reduceat(tree, edge[:-1])
            omitted |= whole & (np.diff(edge) > apart + 1)
        apart += 1
    return np.array(us, np.int64), np.array(vs, np.int64), omitted


def _across_groups(rows: DataFrame, num: int, den: int, forests: int) -> DataFrame:
    """Forests of pairs (u, v) of a bucket's nodes in different groups whose marks allow the
    similarity; ``more`` where the block left pairs out.

    A bucket of more than BLOCK nodes is dealt into blocks, and a task compares two of them."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("name", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component", "n", "mark")

    def compare(held: pa.Table) -> pa.RecordBatch:
        """Whole groups of rows."""
        marks = np.frombuffer(b"".join(held["mark"].to_pylist()), np.uint64).reshape(-1, BITS // 64)
        name, i, j, own, node, part, n = (held[c].to_numpy() for c in ("name", "i", "j", "own", "node", "component", "n"))
        new = np.zeros(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        group = np.cumsum(new)
        x, y, omitted = _spanning(marks, group, own, i == j, part, n, num, den, forests)
        u, v = node[x], node[y]
        return pa.RecordBatch.from_arrays([pa.array(name[x]), pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(omitted[group[x]])], ["name", "u", "v", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            keys = [table[c].to_numpy() for c in ("name", "i", "j")]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            # the last group may go on in the next batch; the others are whole
            split = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if split or (held and any(held[-1][c][-1].as_py() != table[c][0].as_py() for c in ("name", "i", "j"))):
                whole = pa.concat_tables([*held, table.slice(0, split)])
                yield compare(whole)
                held = []
            held.append(table.slice(split))
        if held:
            yield compare(pa.concat_tables(held))

    # by node: buckets that share nodes tend to give the same pairs
    rows = rows.repartition("name", "i", "j").sortWithinPartitions("name", "i", "j", "node")
    return rows.mapInArrow(frugal(run), "name long, u long, v long, more boolean")


def _sets(texts: DataFrame, facts: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """The sets of those nodes, each from one of its documents."""
    chosen = facts.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("__id", "__row")).alias("d")).select("d.__id", "d.__row").distinct()
    chosen = written(chosen)
    count = chosen.count()
    key = F.broadcast(chosen).alias("k") if count <= SMALL else chosen.alias("k")
    texts = texts.alias("t").join(key, F.col("t.__id").eqNullSafe(F.col("k.__id")) & (F.col("t.__row") == F.col("k.__row")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in text_slices(batches, "__text", CHUNK_BYTES):
            sets = [s for s in shingle_sets(Words(data, offsets), n) if len(s)]
            if sets:
                every = pa.array(np.concatenate(sets).view(np.int64))
                edge = pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(edge, every)], ["node", "shingles"])

    sets = written(texts.select("__text").mapInArrow(frugal(run), "node long, shingles array<long>"))
    # a row chosen by its id and text comes more than once only if the whole row is repeated
    return sets if sets.count() == count else written(sets.dropDuplicates(["node"]))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """__id, __row, n_shingles and component_id (the smallest id of the group; own id for an empty set)."""
    facts, _ = linked_classes(docs, id_col, text_col, n, num, den)
    least = facts.filter("component is not null").groupBy("component").agg(F.min("__id").alias("least"))
    return facts.join(least, "component", "left").select("__id", "__row", F.col("n_shingles").cast("long").alias("n_shingles"), F.when(F.col("component").isNull(), F.col("__id")).otherwise(F.col("least")).alias("component_id"))


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without the documents whose group has a smaller id; rows without words stay.

    Of rows that share the smallest id of a group, those with the smallest text hash stay."""
    groups = near_duplicate_groups(docs, id_col, text_col, n, num, den)
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("__id"), F.col("__row"))).alias("k"))
    kept = groups.join(first, F.col("k.__id").eqNullSafe(groups["__id"]) & (F.col("k.__row") == groups["__row"]) & first["component_id"].eqNullSafe(groups["component_id"]), "left_semi").select("__id", "__row").distinct()
    own = docs.withColumns({"__k_id": F.col(id_col).cast("long"), "__k_row": F.xxhash64(text_col)})
    return own.join(kept, F.col("__k_id").eqNullSafe(F.col("__id")) & (F.col("__k_row") == F.col("__row")), "left_semi").drop("__k_id", "__k_row")
