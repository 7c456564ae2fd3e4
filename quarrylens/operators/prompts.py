"""Texts for generators and people: packets of clusters, prompt blocks, audits, checked replies."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.operators.trends import nearest_rank


def compact_clusters(clusters: DataFrame, topics: int = 12) -> DataFrame:
    """Clusters (cluster_id, category, review_count, product_count, top_topic_raw) with non-blank topics only."""
    kept = F.filter(F.slice(F.coalesce("top_topic_raw", F.array().cast("array<struct<topic_raw:string,count:bigint>>")), 1, topics), lambda t: F.coalesce(F.trim(t["topic_raw"]), F.lit("")) != "")
    return clusters.withColumn("topics", F.transform(kept, lambda t: F.concat(F.trim(t["topic_raw"]), F.lit(" ("), t["count"].cast("string"), F.lit(")")))).drop("top_topic_raw")


def packets(clusters: DataFrame, topics: int = 12) -> DataFrame:
    """A packet for each category: its clusters as JSON lines, largest first, and their number."""
    line = F.to_json(F.struct("cluster_id", "review_count", "product_count", "topics"))
    rows = compact_clusters(clusters, topics).select("category", "review_count", "cluster_id", line.alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("review_count")).alias("a"), F.col("cluster_id").alias("b"), "line")))
    return rows.groupBy("category").agg(F.count("*").alias("cluster_count"), F.sum("review_count").alias("review_count"), F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("packet"))


def block_prompts(rows: DataFrame, key_cols: list[str], text_col: str, order_col: str, instructions: str) -> DataFrame:
    """One prompt for each block: instructions, then its numbered texts in order."""
    numbered = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key_cols).orderBy(order_col)))
    lines = F.array_sort(F.collect_list(F.struct("__n", F.concat(F.col("__n").cast("string"), F.lit(". "), F.col(text_col)).alias("line"))))
    return numbered.groupBy(*key_cols).agg(F.concat(F.lit(instructions + "\n"), F.array_join(F.transform(lines, lambda x: x["line"]), "\n")).alias("prompt"))


def improvement_prompt() -> Column:
    """A group's insights as lines for a generator; needs name and insights."""
    line = lambda i: F.concat(F.lit("- ["), i["polarity"], F.lit("] "), i["evidence"])
    return F.concat(F.lit("Theme: "), F.col("name"), F.lit("\n"), F.array_join(F.transform("insights", line), "\n"))


def check_reply(text: str | None, field: str) -> tuple[str | None, str | None]:
    """(value, None) of a reply that is an object with that one non-blank text, or (None, what is wrong)."""
    try:
        value = json.loads(text or "")
    except ValueError:
        return None, "not JSON"
    if not isinstance(value, dict) or set(value) != {field}:
        return None, f"the reply must hold only {field}"
    if not isinstance(value[field], str) or not value[field].strip():
        return None, f"{field} must not be empty"
    return value[field].strip(), None


def checked_replies(df: DataFrame, id_col: str, reply_col: str, field: str) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [check_reply(t, field) for t in pdf[reply_col]]
            yield pd.DataFrame({id_col: pdf[id_col], field: [v for v, _ in found], "error_message": [e for _, e in found]})

    return df.select(id_col, reply_col).mapInPandas(run, f"{id_col} {kind}, {field} string, error_message string")


def token_lengths(df: DataFrame, id_col: str, text_col: str, load: Callable[[], Callable[[list[str]], list[int]]]) -> DataFrame:
    """(id, token_count) by a tokenizer loaded once a partition."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = load()
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "token_count": count(pdf[text_col].fillna("").tolist())})

    return df.select(id_col, text_col).mapInPandas(run, f"{id_col} {kind}, token_count long")


def token_report(lengths: DataFrame, budget: int) -> DataFrame:
    """One row: groups within and over a budget, and percentiles of the lengths."""
    return lengths.agg(
        F.count("*").alias("group_count"), F.count_if(F.col("token_count") <= budget).alias("direct_group_count"), F.count_if(F.col("token_count") > budget).alias("chunked_group_count"),
        F.min("token_count").alias("min"), *nearest_rank("token_count", 0.5, 0.95, 0.99), F.max("token_count").alias("max"),
    )


def member_export(members: DataFrame, most: int = 5) -> DataFrame:
    """For people: each cluster with its nearest members on one line."""
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("center_similarity"), "candidate_id"))
    top = members.withColumn("__n", rank).filter(F.col("__n") <= most)
    lines = F.array_sort(F.collect_list(F.struct("__n", F.concat("topic_raw", F.lit(": "), "evidence").alias("line"))))
    return top.groupBy("cluster_id").agg(F.array_join(F.transform(lines, lambda x: x["line"]), " | ").alias("members"), F.count("*").alias("shown"))
