"""The thin queries over the driver's tables: each derives its contract's columns from its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.llm import ann, bpe, jaccard, langid, omh, packing, substring, tokencount, toxicity, warc
from quarrylens.llm.oracle import ORACLE  # noqa: F401  for the driver's entry

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=13, first=7)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard.near_duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), n=4, num=85, den=100)
    return out.select(F.col("__id").alias("doc_id"), "n_shingles", "component_id")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = langid.train(docs.filter(~held_out).select("doc_id", "text", "lang"))
    out = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE, capacity=2048, end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE), WORD_BPE)
    ids = F.array_join("ids", " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), every=20, k=20)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    index = toxicity.train(docs, labels.filter(~held_out))
    out = toxicity.score(docs, index)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every whole text before and after three edits: a passage replaced in its first
    third, a note put at its start, and 25 characters taken from its middle."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.coalesce(F.length("text"), F.lit(0))
    step = lambda a, b, t: F.struct(F.floor(a).cast("int").alias("start"), F.floor(b).cast("int").alias("stop"), t.alias("text"))
    edits = F.array(
        step(n / 3, n / 3 + 40, F.concat(F.lit("An edited passage, number "), F.col("doc_id").cast("string"), F.lit("."))),
        step(F.lit(0), F.lit(0), F.lit("Note: ")),
        step(n / 2, n / 2 + 25, F.lit("")),
    )
    out = tokencount.recount(docs.withColumn("edits", edits), BYTE_BPE)
    return out.select("doc_id", "n_tokens", "n_pretokens", "n_tokens_edited", "n_reencoded", F.sha2("edited", 256).alias("edited_sha256"))
