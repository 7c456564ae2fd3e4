"""Document fingerprints by Order MinHash, in built-in functions only.

A text's elements are its k-word sequences (word runs between white space; a text of fewer
words is one sequence), each numbered by its occurrence in the text, so that repeats count.
A hash deals the numbered elements into ``bins`` bins; in each bin the two elements of the
smallest hashes are kept, put back into the order of the text, and hashed as a pair.  The
pairs of all bins are the fingerprint.  Moving or replacing a passage changes the pairs that
it takes part in or whose order it turns round, so the likeness of two fingerprints (bins
that agree, of bins that either text fills) falls with edit distance and not only with the
overlap of content.

Occurrence numbers come from one sort: elements sorted by hash and place form runs, and an
element's number is its distance from its run's start.  All of it is arithmetic on arrays
within a row: no shuffle, no Python, one pass.

Defined results: null and empty texts, and texts of white space, have an empty fingerprint;
two empty fingerprints have likeness 1, an empty and another 0.  A text of fewer words than a
sequence, a long one without white space too, is one element, and any edit gives it likeness 0.
Beyond 2**24 words a place reaches into the bits of the hash: the fingerprint is still one of the
text alone, but its order there is no longer that of the text.  Repeated rows each get their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.llm.storage import written

BINS = 32
WORDS = 3
#: Bits of a place in the text, below the bits of the hash.
PLACE = 24


def with_fingerprint(df: DataFrame, text_col: str, name: str, bins: int = BINS, words: int = WORDS) -> DataFrame:
    """``df`` with the fingerprint of a text column: for each filled bin, two hex digits and eight of its pair's hash."""
    w, e, r, o, s = (f"__{name}_{x}" for x in "weros")
    low = (1 << PLACE) - 1
    text = f"coalesce(`{text_col}`, '')"
    steps = [
        # words; an empty text gives none
        (w, f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')"),
        # hash of each sequence above its place, ascending
        (e, f"sort_array(transform(sequence(0, greatest(size(`{w}`) - {words}, 0)), i -> shiftleft(xxhash64(" + ", ".join(f"get(`{w}`, i + {j})" for j in range(words)) + f"), {PLACE}) | cast(i as bigint)))"),
        # starts of runs of equal hashes
        (r, f"filter(sequence(0, size(`{e}`) - 1), i -> i = 0 or shiftright(get(`{e}`, i), {PLACE}) <> shiftright(get(`{e}`, i - 1), {PLACE}))"),
        # bin and hash of (sequence, occurrence number) above the place, ascending
        (o, f"sort_array(flatten(transform(`{r}`, (b, j) -> transform(sequence(b, coalesce(get(`{r}`, j + 1), size(`{e}`)) - 1), i -> shiftleft(xxhash64(shiftright(get(`{e}`, i), {PLACE}), i - b), {PLACE}) | (get(`{e}`, i) & {low}L)))))"),
        # the first element of each bin, as its index
        (s, f"filter(sequence(0, size(`{o}`) - 1), i -> i = 0 or {_bin(f'get(`{o}`, i)', bins)} <> {_bin(f'get(`{o}`, i - 1)', bins)})"),
    ]
    out = df
    for column, expression in steps:
        out = out.withColumn(column, F.expr(expression))
    first, second = f"get(`{o}`, i)", f"get(`{o}`, i + 1)"
    paired = f"i + 1 < size(`{o}`) and {_bin(second, bins)} = {_bin(first, bins)}"
    place = lambda x: f"({x} & {low}L)"
    mark = lambda x: f"shiftright({x}, {PLACE})"
    pair = (
        f"case when not ({paired}) then xxhash64({mark(first)}) when {place(first)} < {place(second)} then xxhash64({mark(first)}, {mark(second)}) else xxhash64({mark(second)}, {mark(first)}) end"
    )
    made = f"array_join(transform(`{s}`, i -> concat(lpad(hex({_bin(first, bins)}), 2, '0'), lpad(hex({pair} & 4294967295L), 8, '0'))), '')"
    return out.withColumn(name, F.when(F.size(w) == 0, F.lit("")).otherwise(F.expr(made))).drop(w, e, r, o, s)


def _bin(x: str, bins: int) -> str:
    """The bin is the top bits of the hash, so that sorting puts a bin's elements together."""
    return f"shiftrightunsigned({x}, {64 - (bins - 1).bit_length()})"


def likeness(a: Column | str, b: Column | str) -> Column:
    """Bins of equal pairs, of the bins that either fingerprint fills; 0 to 1."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    parts = lambda c: F.filter(F.split(c, "(?<=\\G.{10})"), lambda x: x != "")
    x, y = parts(a), parts(b)
    bins = lambda z: F.transform(z, lambda v: F.substring(v, 1, 2))
    filled = F.size(F.array_union(bins(x), bins(y)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / filled)


def neighbours(ids: DataFrame, id_col: str) -> DataFrame:
    """(id, next_id): the next smaller id, and for the smallest the largest.

    Ids are range-partitioned and written once, so that partition numbers stay; within a
    partition a window looks one row ahead, and across partitions a table of one row each."""
    spread = ids.select(F.col(id_col).alias("id")).distinct().repartitionByRange(F.col("id").desc())
    spread = written(spread.withColumn("part", F.spark_partition_id()))
    inner = spread.withColumn("next_id", F.lead("id").over(Window.partitionBy("part").orderBy(F.desc("id"))))
    tops = spread.groupBy("part").agg(F.max("id").alias("top"))
    # one row for each partition of the ids: their order is one small window
    bounds = tops.withColumn("below", F.lead("top").over(Window.orderBy("part"))).withColumn("all", F.max("top").over(Window.partitionBy(F.lit(0))))
    return inner.join(F.broadcast(bounds), "part").select("id", F.coalesce("next_id", "below", "all").alias("next_id"))


def with_half_replaced(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (text null: empty) with n_chars, next_id and edited: the last floor(n_chars / 2)
    code points replaced by the first as many of the next document, in descending order of ids.

    A null id comes last, as the smallest; of rows with equal ids the smallest text counts as
    the next document's."""
    # an id that stands for null: below all that occur
    none = F.lit(-(1 << 63)).cast("long")
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), none).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sizes = base.groupBy("id").agg(F.max(F.length("text")).alias("n"))
    takes = sizes.join(neighbours(base, "id"), "id").select(F.col("next_id").alias("id"), F.floor(F.col("n") / 2).cast("int").alias("take"), F.col("id").alias("for_id"))
    # both joins read the same shuffle of the texts by id
    heads = base.join(takes, "id").groupBy("for_id").agg(F.min(F.expr("substring(text, 1, take)")).alias("head"), F.first("id").alias("next_id"))
    out = base.join(heads, base["id"] == heads["for_id"], "left").withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"), F.substring(F.col("head"), F.lit(1), half))
    return out.select("id", "text", "n_chars", "next_id", edited.alias("edited")).withColumn("none", F.col("id") == none)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the edited text's and to the next document's)."""
    both = with_fingerprint(with_fingerprint(with_half_replaced(docs, id_col, text_col), "text", "fingerprint"), "edited", "edited_fingerprint")
    table = written(both.select("id", "none", "n_chars", "next_id", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint"))
    other = table.groupBy(F.col("id").alias("other")).agg(F.min("fingerprint").alias("next_fingerprint"))
    out = table.join(other, table["next_id"] == other["other"], "left")
    return out.select(
        F.when(~F.col("none"), F.col("id")).alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
