"""Improvement groups: negative insights trigger a group, mixed ones only support it."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.operators.gold import mapped_insights
from quarrylens.sources.storage import written


def improvement_groups(insights: DataFrame) -> DataFrame:
    """A row for each product and theme with a negative insight; its insights negative first, then by id.

    Insights need candidate_id besides the usual columns."""
    used = mapped_insights(insights).filter(F.col("polarity").isin("negative", "mixed"))
    rank = F.when(F.col("polarity") == "negative", 0).otherwise(1)
    groups = used.groupBy("product_id", "taxonomy_id").agg(
        F.min("theme_name").alias("name"),
        F.count_if(F.col("polarity") == "negative").alias("negative_insight_count"),
        F.count_if(F.col("polarity") == "mixed").alias("mixed_insight_count"),
        F.count("*").alias("support_insight_count"),
        F.countDistinct("review_id").alias("support_review_count"),
        F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "candidate_id", "review_id", "polarity", "evidence"))).alias("insights"),
    )
    key = F.concat(F.col("product_id").cast("string"), F.lit("\0"), F.col("taxonomy_id"))
    return groups.filter("negative_insight_count > 0").withColumn("input_id", F.left(F.sha2(key, 256), F.lit(24)))


def _cuts(sizes: list[int | None], budget: int) -> list[tuple[int, int | None]]:
    """(number, sum) of each run of sizes within the budget; a larger or unknown size is a run of its own."""
    out, count, n = [], 0, None
    for k in sizes:
        if count and n is not None and k is not None and n + k <= budget:
            count, n = count + 1, n + k
        else:
            if count:
                out.append((count, n))
            count, n = 1, k
    return [*out, (count, n)] if count else out


def _chunked(groups: DataFrame, keep: list[str], budget: int, tokens: str, item: str) -> DataFrame:
    """``keep`` of the groups with chunk_index, token_count and items (strings, by the SQL ``item`` over an insight x).

    One pass over a group's token counts finds the cuts; a fold in SQL would copy all chunks so far
    for each insight."""
    rows = groups.filter("insights is not null").select(*keep, F.expr(f"transform(insights, x -> {tokens})").alias("__sizes"), F.expr(f"transform(insights, x -> {item})").alias("items"))
    schema = T.StructType([*rows.select(*keep).schema, T.StructField("chunk_index", T.IntegerType()), T.StructField("token_count", T.IntegerType()), T.StructField("items", T.ArrayType(T.StringType()))])

    def run(batches):
        for b in batches:
            cuts = [_cuts(x, budget) for x in b.column("__sizes").to_pylist()]
            own = pa.array([i for i, c in enumerate(cuts) for _ in c], pa.int32())
            index = pa.array([i for c in cuts for i in range(len(c))], pa.int32())
            total = pa.array([n for c in cuts for _, n in c], pa.int32())
            ends = pa.array(accumulate((count for c in cuts for count, _ in c), initial=0), pa.int32())
            # the chunks of a group are its items in order, so only the lists' ends are new
            items = pa.ListArray.from_arrays(ends, b.column("items").flatten())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(own) for k in keep), index, total, items], names=schema.names)

    return rows.mapInArrow(run, schema)


#: Words of an insight's evidence.
TOKENS = "size(split(x.evidence, ' '))"


def insight_chunks(groups: DataFrame, budget: int, tokens: str = TOKENS) -> DataFrame:
    """Order-preserving chunks of a group's insights within a token budget; a larger insight is a chunk of its own."""
    chunks = _chunked(groups, ["input_id", "product_id", "taxonomy_id"], budget, tokens, "cast(x.candidate_id as string)")
    return chunks.select("input_id", "product_id", "taxonomy_id", "chunk_index", "token_count", F.col("items").alias("candidate_ids"))


def _reply(model: Callable[[str], str | None], prompt: str, tries: int, check: Callable[[str], str | None] | None) -> tuple[str | None, str | None]:
    """(text, None) or (None, the last problem)."""
    problem = "no try"
    for _ in range(tries):
        try:
            text = (model(prompt) or "").strip()
            problem = "empty response" if not text else check(text) if check else None
        except Exception as error:  # noqa: BLE001  each record keeps its own failure
            problem = str(error) or type(error).__name__
        if problem is None:
            return text, None
    return None, problem


def generate(
    groups: DataFrame, done: DataFrame, generator: Callable[[str], str] | None = None, prompt_col: str = "prompt", retries: int = 0,
    load: Callable[[], Callable[[str], str]] | None = None, check: Callable[[str], str | None] | None = None,
) -> DataFrame:
    """Runs a generator over the groups that have no successful record yet; a failure is a record, not an error.

    ``load`` makes the generator once a partition.  An error, an empty reply or one in which
    ``check`` finds a problem is tried again up to ``retries`` times."""
    open_groups = groups.join(done.filter("generation_status = 'success'").select("input_id"), "input_id", "left_anti")

    def run(batches):
        model = load() if load else generator
        for pdf in batches:
            replies = [_reply(model, prompt, retries + 1, check) for prompt in pdf[prompt_col]]
            out = [(i, text, "failed" if problem else "success", problem) for i, (text, problem) in zip(pdf["input_id"], replies, strict=True)]
            yield pd.DataFrame(out, columns=["input_id", "improvement_suggestion", "generation_status", "error_message"])

    return open_groups.select("input_id", prompt_col).mapInPandas(run, "input_id string, improvement_suggestion string, generation_status string, error_message string")


def generate_by_size(
    groups: DataFrame, done: DataFrame, load: Callable[[], Callable[[str], str]], budget: int, instructions: tuple[str, str, str],
    retries: int = 2, check: Callable[[str], str | None] | None = None, tokens: str = TOKENS,
) -> DataFrame:
    """Suggestions for groups of any size, with ``generation_mode``: a group within the token budget is
    one prompt (direct); of a larger one each chunk is summed up, and the summaries are the last
    prompt (map_reduce).  A chunk that fails fails its group, and no other.

    ``instructions`` open the prompts of whole groups, of chunks and of summaries; groups are those
    of improvement_groups()."""
    direct, of_chunk, of_summaries = instructions
    line = "concat('- [', x.polarity, '] ', x.evidence)"
    prompt = lambda head, lines: F.concat(F.lit(head + "\nTheme: "), F.col("name"), F.lit("\n"), F.array_join(lines, "\n"))
    size = F.expr(f"aggregate(insights, 0, (a, x) -> a + {tokens})")
    left = groups.join(done.filter("generation_status = 'success'").select("input_id"), "input_id", "left_anti")
    none = done.limit(0)
    small = left.filter(size <= budget).select("input_id", prompt(direct, F.expr(f"transform(insights, x -> {line})")).alias("prompt"))
    first = generate(small, none, retries=retries, load=load, check=check).withColumn("generation_mode", F.lit("direct"))
    chunks = _chunked(left.filter(size > budget), ["input_id", "name"], budget, tokens, line)
    chunks = chunks.select(F.concat_ws("#", "input_id", F.col("chunk_index").cast("string")).alias("input_id"), prompt(of_chunk, F.col("items")).alias("prompt"))
    parts = generate(chunks, none, retries=retries, load=load).select(
        F.substring_index("input_id", "#", 1).alias("input_id"), F.substring_index("input_id", "#", -1).cast("int").alias("at"), "improvement_suggestion", "error_message"
    )
    whole = parts.groupBy("input_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "improvement_suggestion"))).alias("summaries"), F.min(F.when(F.col("error_message").isNotNull(), F.struct("at", "error_message"))).alias("failure")
    ).join(left.select("input_id", "name"), "input_id")
    # replies are read twice but asked for once
    whole = written(whole)
    failed = whole.filter("failure is not null").select("input_id", F.lit(None).cast("string").alias("improvement_suggestion"), F.lit("failed").alias("generation_status"), F.concat(F.lit("chunk "), F.col("failure.at").cast("string"), F.lit(": "), F.col("failure.error_message")).alias("error_message"))
    last = whole.filter("failure is null").select("input_id", prompt(of_summaries, F.transform("summaries", lambda s: F.concat(F.lit("- "), s["improvement_suggestion"]))).alias("prompt"))
    second = generate(last, none, retries=retries, load=load, check=check).unionByName(failed).withColumn("generation_mode", F.lit("map_reduce"))
    return first.unionByName(second)
