"""A training-corpus pipeline over ``documents``: five stages, each one operator of quarrylens.llm.

Every stage reads what the one before wrote.  The first four return the columns of documents:

* language: documents whose language is not recognised with enough confidence go (null texts,
  texts without a letter, scores below the fitted threshold);
* toxicity: documents with a probability of 0.7 or more of being toxic go;
* near_duplicates: of each group of documents linked by a similarity of 0.8 or more on
  five-word shingles the one with the smallest id stays;
* passages: words covered by a window of 13 words that also starts in a document with a smaller
  id are removed (kept words are joined by a space, n_chars follows); a document all of whose
  words go stays as an empty text;
* packing: the remaining texts as windows of 2048 tokens, a row for each piece.

Nulls, ties and repeated rows: a null text goes in the first stage; a null id counts as larger than
all others in the third and fourth; of documents that share the smallest id of a group the one with
the smallest text hash stays, as often as its row is repeated; rows with equal ids don't remove each
other's passages and are packed each for itself.  Columns besides those of documents are left out.

SQL cannot express the learned stages, so ORACLE_SQL is None; tests/llm/test_pipeline.py holds
the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.llm import jaccard, langid, packing, substring, toxicity
from quarrylens.llm.queries import BYTE_BPE, table
from quarrylens.llm.storage import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.7


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    return langid.predict(docs, model).filter("accepted").select(*COLUMNS)


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, index).filter(F.col("score") < TOXIC).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_of_each_group(docs, n=5, num=80, den=100).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(docs, min_words=13, first=7)
    # a text that loses nothing stays as it is
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, BYTE_BPE, capacity=2048, end_id=1)


STAGES = [("language", language), ("toxicity", non_toxic), ("near_duplicates", near_duplicates), ("passages", passages), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
