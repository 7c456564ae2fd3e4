"""Product x theme x sentiment aggregates.

Inputs: *insights* (review_id, product_id, taxonomy_id, theme_name, polarity, evidence,
mapping_status) and *reviews* (review_id, product_id, review_month, rating, ...).  Ratios are
over all reviews of a product (or product and month), not only those with insights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAPPED = "mapped_by_cluster"
SENTIMENTS = ("positive", "negative")
FACETS = (("positive_evaluation", "positive"), ("negative_evaluation", "negative"), ("improvement", None))


def guarded_ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def mapped_insights(insights: DataFrame) -> DataFrame:
    return insights.filter(F.col("mapping_status") == MAPPED).withColumn("polarity", F.lower("polarity"))


def review_themes(insights: DataFrame) -> DataFrame:
    """One row for each review, product and theme: its sentiments collapse into one.

    A native mixed, or positive beside negative, is mixed; else negative, positive, neutral."""
    has = lambda p: F.bool_or(F.col("polarity") == p)
    sentiment = (
        F.when(has("mixed") | (has("positive") & has("negative")), "mixed").when(has("negative"), "negative").when(has("positive"), "positive").otherwise("neutral")
    )
    grouped = mapped_insights(insights).groupBy("review_id", "product_id", "taxonomy_id")
    return grouped.agg(
        F.min("theme_name").alias("theme_name"),
        sentiment.alias("sentiment"),
        F.count("*").alias("insight_count"),
        F.array_join(F.sort_array(F.collect_set("evidence")), " || ").alias("evidence_text"),
    )


def product_table(reviews: DataFrame, meta: DataFrame) -> DataFrame:
    """Products with their review counts and active months; meta: product_id, title, category."""
    one = meta.groupBy("product_id").agg(F.min("title").alias("title"), F.min("category").alias("category"))
    counts = reviews.groupBy("product_id").agg(
        F.countDistinct("review_id").alias("review_count"),
        F.countDistinct("review_month").alias("active_month_count"),
        F.min("review_month").alias("first_review_month"),
        F.max("review_month").alias("last_review_month"),
    )
    return counts.join(one, "product_id", "left").withColumn("analysis_status", F.lit("ready"))


def theme_metrics(themes: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews of each product and theme, in all and by sentiment.

    ``themes`` has one row for each review, product and theme (review_themes), so counts are
    plain sums made before the shuffle, not distinct counts."""
    by = lambda s: F.count_if(F.col("sentiment") == s)
    total = products.select("product_id", "category", F.col("review_count").alias("eligible_review_count"))
    return (
        themes.groupBy("product_id", "taxonomy_id")
        .agg(F.min("theme_name").alias("name"), F.count("*").alias("total_review_count"), *[by(s).alias(f"{s}_review_count") for s in ("positive", "negative", "neutral", "mixed")])
        .join(total, "product_id")
    )


def themes_long(metrics: DataFrame) -> DataFrame:
    """A row for each product, theme and sentiment with reviews, in one pass over the metrics."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("sentiment"), F.col(f"{s}_review_count").alias("review_count")) for s in SENTIMENTS]))
    return (
        metrics.withColumn("s", each)
        .select("*", "s.sentiment", "s.review_count")
        .drop("s")
        .filter("review_count > 0")
        .withColumn("theme_id", F.concat(F.col("product_id").cast("string"), F.lit("::"), F.col("taxonomy_id"), F.lit("::"), F.col("sentiment")))
        .withColumn("ratio_value", guarded_ratio(F.col("review_count"), F.col("eligible_review_count")))
        .withColumn("ratio_status", F.lit("ready"))
        .withColumn("ratio_definition_id", F.lit("all_product_reviews"))
    )


def product_facets(products: DataFrame, themes: DataFrame) -> DataFrame:
    """Three rows a product; a facet without themes is empty, improvements are not yet assessed."""
    grid = products.select("product_id").withColumn("f", F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.lit(s).cast("string").alias("sentiment")) for f, s in FACETS]))).select("product_id", "f.*")
    counts = themes.groupBy("product_id", "sentiment").agg(F.count("*").alias("n"))
    joined = grid.join(counts, ["product_id", "sentiment"], "left")
    scored = F.col("sentiment").isNotNull()
    n = F.coalesce("n", F.lit(0))
    return joined.select(
        "product_id",
        "facet",
        F.when(~scored, "not_available").when(n == 0, "empty").otherwise("ready").alias("status"),
        F.when(scored, n).cast("long").alias("theme_count"),
        F.when(scored & (n == 0), "no_qualified_theme").alias("empty_reason"),
        F.lit(None).cast("string").alias("error_summary"),
    )


def month_denominator(reviews: DataFrame) -> DataFrame:
    return reviews.filter("review_month is not null").groupBy("product_id", "review_month").agg(F.countDistinct("review_id").alias("eligible_review_count"))


def theme_timeseries(themes: DataFrame, reviews: DataFrame) -> DataFrame:
    """Monthly review counts of positive and negative themes; reviews without a month drop out.

    A review is one row of a theme and of a month, so counts are plain sums."""
    dated = reviews.filter("review_month is not null").select("review_id", "product_id", "review_month").distinct()
    counts = (
        themes.filter(F.col("sentiment").isin(*SENTIMENTS))
        .join(dated, ["review_id", "product_id"])
        .groupBy("product_id", "taxonomy_id", "sentiment", "review_month")
        .agg(F.count("*").alias("review_count"))
    )
    return counts.join(month_denominator(reviews), ["product_id", "review_month"]).withColumn("ratio_value", guarded_ratio(F.col("review_count"), F.col("eligible_review_count")))


def theme_reviews(themes: DataFrame, reviews: DataFrame) -> DataFrame:
    """Evidence: the reviews behind positive and negative themes."""
    return (
        themes.filter(F.col("sentiment").isin(*SENTIMENTS))
        .join(reviews.select("review_id", "product_id", "rating", "review_month"), ["review_id", "product_id"])
        .select("product_id", "taxonomy_id", "sentiment", "review_id", "evidence_text", "rating", "review_month", "insight_count")
    )


def category_summary(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(
        F.count("*").alias("product_count"), F.sum("review_count").alias("review_count"), F.min("review_count").alias("minimum_product_reviews"), F.max("review_count").alias("maximum_product_reviews")
    )
