"""Attribution of aspects to products, and theme candidates from aspects and suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attributed_aspects(aspects: DataFrame, decisions: DataFrame) -> DataFrame:
    """Aspects whose sentence is decided to be about the product.

    Both need review_id, product_id and sentence_id; decisions need is_about_product."""
    keys = ["review_id", "product_id", "sentence_id"]
    return aspects.join(decisions.filter("is_about_product").select(*keys).distinct(), keys)


def theme_candidates(aspects: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Evaluation and improvement candidates with the attributes and sources of equal sentences put together.

    Aspects need review_id, product_id, sentence_text, aspect_text and aspect_sentiment; a
    negative aspect is an evaluation and an improvement.  Suggestions have no aspects."""
    base = ["product_id", "review_id", "sentence_text"]
    kinds = F.when(F.col("aspect_sentiment") == "positive", F.array(F.struct(F.lit("evaluation").alias("t"), F.lit("positive").alias("s"), F.lit("absa_positive").alias("o")))).when(
        F.col("aspect_sentiment") == "negative",
        F.array(F.struct(F.lit("evaluation").alias("t"), F.lit("negative").alias("s"), F.lit("absa_negative").alias("o")), F.struct(F.lit("improvement").alias("t"), F.lit(None).cast("string").alias("s"), F.lit("implicit_problem").alias("o"))),
    )
    from_aspects = aspects.withColumn("k", F.explode(kinds)).select(*base, F.col("k.t").alias("theme_type"), F.col("k.s").alias("sentiment"), F.array("aspect_text").alias("attributes"), F.col("k.o").alias("source"))
    explicit = suggestions.select(*base, F.lit("improvement").alias("theme_type"), F.lit(None).cast("string").alias("sentiment"), F.array().cast("array<string>").alias("attributes"), F.lit("explicit_suggestion").alias("source"))
    key = F.concat_ws("|", F.col("product_id").cast("string"), "theme_type", F.coalesce("sentiment", F.lit("none")), F.col("review_id").cast("string"), "sentence_text")
    merged = from_aspects.unionByName(explicit).groupBy(*base, "theme_type", "sentiment").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("attributes")))).alias("attributes"), F.sort_array(F.collect_set("source")).alias("sources")
    )
    return merged.withColumn("candidate_id", F.md5(key.cast("binary")))


def matched_improvements(items: DataFrame, themes: DataFrame) -> DataFrame:
    """Each improvement with the theme that shows it: by theme_id where it has one, else by taxonomy."""
    by_id = themes.select("product_id", F.col("theme_id").alias("__id"), F.col("review_count").alias("__by_id"))
    by_taxonomy = themes.filter("sentiment = 'negative'").select("product_id", "taxonomy_id", F.col("theme_id").alias("__theme"), F.col("review_count").alias("__by_taxonomy"))
    joined = items.join(by_id, (items["product_id"] == by_id["product_id"]) & (items["theme_id"] == by_id["__id"]), "left").drop(by_id["product_id"])
    joined = joined.join(by_taxonomy, ["product_id", "taxonomy_id"], "left")
    return joined.withColumn("shown_theme_id", F.coalesce("__id", "__theme")).withColumn("shown_review_count", F.coalesce("__by_id", "__by_taxonomy")).drop("__id", "__theme", "__by_id", "__by_taxonomy")
