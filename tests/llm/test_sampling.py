from pyspark.sql import functions as F

from quarrylens.llm.sampling import one_text_each, smallest_hashes


def test_sample_is_the_smallest_hashes(spark):
    df = spark.range(20000).select(F.col("id").alias("__id"), F.when(F.col("id") % 10 == 0, "a").when(F.col("id") % 1000 == 1, "b").otherwise("c").alias("__y"))
    got = {}
    for r in smallest_hashes(df, 50).collect():
        got.setdefault(r["__y"], set()).add(r["__id"])
    every = df.select("*", F.pmod(F.xxhash64("__id", F.lit(2)), F.lit(1 << 40)).alias("h")).collect()
    for y in "abc":
        assert got[y] == {r["__id"] for r in sorted((r for r in every if r["__y"] == y), key=lambda r: r.h)[:50]}
    assert smallest_hashes(df.limit(0), 5).collect() == []


def test_labels_beyond_the_bound_are_left_out(spark):
    df = spark.createDataFrame([(i, y) for i, y in enumerate("aaabbc")], "__id long, __y string")
    assert {r["__y"] for r in smallest_hashes(df, 5, labels=2).collect()} == {"a", "b"}


def test_one_text_of_each_id(spark):
    rows = [(1, "x", "p"), (1, "y", "p"), (1, "y", "q"), (2, "z", "p"), (None, "w", "p"), (None, None, "p")]
    df = spark.createDataFrame(rows, "__id long, __t string, __y string")
    hashes = {r["__t"]: r.h for r in df.select("__t", F.xxhash64("__t").alias("h")).collect()}
    got = {r["__id"]: (r["__t"], r["__y"]) for r in one_text_each(df, "__id").collect()}
    first = min("xy", key=hashes.get)
    assert got[1] == (first, "p") and got[2] == ("z", "p") and set(got) == {1, 2, None}
    assert sorted(r["__t"] for r in one_text_each(df.filter("__id = 1"), "__id", "__y").collect()) == sorted([first, "y"])
