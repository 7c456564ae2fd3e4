"""Queries over the aggregates and the read repository."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.operators import gold, improve, repository
from quarrylens.plans import surrogate as s
from quarrylens.plans.registry import query

CTE = s.CTE


def _review_themes(spark: SparkSession, d: str) -> DataFrame:
    return gold.review_themes(s.insights(spark, d))


def _products(spark: SparkSession, d: str) -> DataFrame:
    return gold.product_table(s.reviews(spark, d), s.meta(spark, d))


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return gold.theme_metrics(_review_themes(spark, d), _products(spark, d))


def _themes(spark: SparkSession, d: str) -> DataFrame:
    return gold.themes_long(_metrics(spark, d))


def _items(spark: SparkSession, d: str) -> DataFrame:
    found = s.insights(spark, d).withColumn("candidate_id", F.sha2(F.concat_ws("|", "review_id", "evidence", "polarity"), 256))
    return improve.improvement_groups(found)


@query(f"{CTE} SELECT product_id, sentiment, count(*) AS groups, sum(insight_count)::BIGINT AS insights, max(evidence_text) AS last_evidence, min(theme_name) AS theme_name FROM review_theme GROUP BY product_id, sentiment")
def review_theme(spark, d):
    return _review_themes(spark, d).groupBy("product_id", "sentiment").agg(F.count("*").alias("groups"), F.sum("insight_count").alias("insights"), F.max("evidence_text").alias("last_evidence"), F.min("theme_name").alias("theme_name"))


@query(f"{CTE} SELECT review_id, product_id, taxonomy_id, sentiment, insight_count, evidence_text FROM review_theme")
def review_theme_rows(spark, d):
    return _review_themes(spark, d).drop("theme_name")


@query(f"{CTE} SELECT * FROM products")
def products(spark, d):
    return _products(spark, d)


@query(f"{CTE} SELECT * FROM metrics")
def theme_metrics(spark, d):
    return _metrics(spark, d)


@query(f"{CTE} SELECT theme_id, product_id, category, taxonomy_id, name, sentiment, review_count, eligible_review_count, ratio_value, ratio_status, ratio_definition_id FROM themes")
def themes_long(spark, d):
    return _themes(spark, d).select("theme_id", "product_id", "category", "taxonomy_id", "name", "sentiment", "review_count", "eligible_review_count", "ratio_value", "ratio_status", "ratio_definition_id")


@query(
    f"""{CTE}, grid AS (SELECT product_id, f.facet, f.sentiment FROM products, (VALUES ('positive_evaluation', 'positive'), ('negative_evaluation', 'negative'), ('improvement', NULL)) f(facet, sentiment)),
    counts AS (SELECT product_id, sentiment, count(*) AS n FROM themes_kept GROUP BY ALL)
    SELECT g.product_id, facet, CASE WHEN g.sentiment IS NULL THEN 'not_available' WHEN n IS NULL THEN 'empty' ELSE 'ready' END AS status,
           CASE WHEN g.sentiment IS NOT NULL THEN coalesce(n, 0) END AS theme_count, CASE WHEN g.sentiment IS NOT NULL AND n IS NULL THEN 'no_qualified_theme' END AS empty_reason, CAST(NULL AS VARCHAR) AS error_summary
    FROM grid g LEFT JOIN counts c ON g.product_id = c.product_id AND g.sentiment = c.sentiment"""
)
def product_facets(spark, d):
    return gold.product_facets(_products(spark, d), s.kept_themes(_themes(spark, d)))


@query(f"{CTE} SELECT * FROM denominator")
def month_denominator(spark, d):
    return gold.month_denominator(s.reviews(spark, d))


@query(f"{CTE} SELECT * FROM series")
def theme_timeseries(spark, d):
    return gold.theme_timeseries(_review_themes(spark, d), s.reviews(spark, d))


@query(f"{CTE} SELECT t.product_id, taxonomy_id, sentiment, t.review_id, evidence_text, r.rating, r.review_month, insight_count FROM review_theme t JOIN reviews r ON t.review_id = r.review_id AND t.product_id = r.product_id WHERE sentiment IN ('positive', 'negative')")
def theme_reviews(spark, d):
    return gold.theme_reviews(_review_themes(spark, d), s.reviews(spark, d))


@query(f"{CTE} SELECT category, count(*) AS product_count, sum(review_count)::BIGINT AS review_count, min(review_count) AS minimum_product_reviews, max(review_count) AS maximum_product_reviews FROM products GROUP BY category")
def category_summary(spark, d):
    return gold.category_summary(_products(spark, d))


@query(f"{CTE} SELECT DISTINCT category FROM products WHERE category IS NOT NULL")
def api_categories(spark, d):
    return repository.categories(_products(spark, d))


@query(f"{CTE} SELECT * FROM products WHERE (lower(title) LIKE '%n_2%' OR lower(CAST(product_id AS VARCHAR)) LIKE '%n_2%') AND category = 'ASIA'")
def api_product_search(spark, d):
    return repository.search_products(_products(spark, d), "N_2", category="ASIA")


@query(f"{CTE} SELECT product_id, title, review_count FROM products ORDER BY review_count DESC, product_id LIMIT 5 OFFSET 5")
def api_product_page(spark, d):
    return repository.page(repository.search_products(_products(spark, d)), 2, 5).select("product_id", "title", "review_count")


@query(f"{CTE} SELECT theme_id, product_id, taxonomy_id, sentiment, effective_sentiment, corrected, review_count, ratio_value FROM effective")
def api_themes_effective(spark, d):
    themes = _themes(spark, d)
    return repository.effective_themes(s.kept_themes(themes), s.overlay(themes)).select("theme_id", "product_id", "taxonomy_id", "sentiment", "effective_sentiment", "corrected", "review_count", "ratio_value")


@query(f"{CTE} SELECT i.*, t.theme_id, t.ratio_value, coalesce(t.review_count, i.support_review_count, 0) AS review_count FROM improve i LEFT JOIN themes t ON t.sentiment = 'negative' AND t.product_id = i.product_id AND t.taxonomy_id = i.taxonomy_id WHERE NOT EXISTS (SELECT 1 FROM overlay o WHERE o.product_id = i.product_id AND o.taxonomy_id = i.taxonomy_id)")
def api_improvements(spark, d):
    themes = _themes(spark, d)
    return repository.improvements(_items(spark, d).drop("insights"), themes, s.overlay(themes))


@query(
    f"""{CTE}, shown AS (SELECT product_id, effective_sentiment || '_evaluation' AS facet, count(*) AS n FROM effective GROUP BY ALL
      UNION ALL SELECT product_id, 'improvement', count(*) FROM improve i WHERE NOT EXISTS (SELECT 1 FROM overlay o WHERE o.product_id = i.product_id AND o.taxonomy_id = i.taxonomy_id) GROUP BY product_id)
    SELECT p.product_id, p.title, p.category, f.facet, coalesce(n, 0) AS theme_count, CASE WHEN coalesce(n, 0) > 0 THEN 'ready' ELSE 'empty' END AS status, CASE WHEN coalesce(n, 0) = 0 THEN 'no_items' END AS empty_reason
    FROM products p CROSS JOIN (VALUES ('positive_evaluation'), ('negative_evaluation'), ('improvement')) f(facet) LEFT JOIN shown s ON s.product_id = p.product_id AND s.facet = f.facet"""
)
def api_overview(spark, d):
    themes = _themes(spark, d)
    return repository.overview(_products(spark, d), s.kept_themes(themes), _items(spark, d), s.overlay(themes))


@query(
    f"""{CTE} SELECT t.theme_id, t.review_count, count(x.review_month) AS months, string_agg(x.review_month || '=' || x.review_count, ',' ORDER BY x.review_month) AS trend
    FROM themes t LEFT JOIN series x ON t.product_id = x.product_id AND t.taxonomy_id = x.taxonomy_id AND t.sentiment = x.sentiment GROUP BY t.theme_id, t.review_count"""
)
def api_theme_trend(spark, d):
    out = repository.theme_trend(_themes(spark, d), gold.theme_timeseries(_review_themes(spark, d), s.reviews(spark, d)))
    points = F.transform("trend", lambda x: F.concat(x["review_month"], F.lit("="), x["review_count"].cast("string")))
    return out.select("theme_id", "review_count", F.coalesce(F.size("trend"), F.lit(0)).cast("long").alias("months"), F.array_join(points, ",").alias("trend"))


@query(f"{CTE} SELECT t.product_id, taxonomy_id, sentiment, t.review_id, evidence_text, r.rating, r.review_month, insight_count FROM review_theme t JOIN reviews r ON t.review_id = r.review_id AND t.product_id = r.product_id WHERE sentiment = 'negative' AND t.product_id = 3 AND taxonomy_id = 'PROMO' ORDER BY r.review_month DESC NULLS LAST, t.review_id LIMIT 10 OFFSET 10")
def api_evidence_page(spark, d):
    evidence = gold.theme_reviews(_review_themes(spark, d), s.reviews(spark, d))
    return repository.evidence_page(evidence, 3, "PROMO", "negative", 2, 10)


@query(f"{CTE} SELECT * FROM improve")
def improvement_groups(spark, d):
    return _items(spark, d).drop("insights")


@query(
    f"""{CTE}, x AS (SELECT *, sha256(CAST(review_id AS VARCHAR) || '|' || evidence || '|' || polarity) AS candidate_id FROM insights WHERE mapping_status = 'mapped_by_cluster' AND lower(polarity) IN ('negative', 'mixed'))
    SELECT g.input_id, string_agg(lower(polarity) || ':' || left(candidate_id, 8), ',' ORDER BY CASE WHEN lower(polarity) = 'negative' THEN 0 ELSE 1 END, candidate_id) AS members
    FROM x JOIN improve g ON x.product_id = g.product_id AND x.taxonomy_id = g.taxonomy_id GROUP BY g.input_id"""
)
def improvement_members(spark, d):
    return _items(spark, d).select("input_id", F.array_join(F.transform("insights", lambda x: F.concat(x["polarity"], F.lit(":"), F.left(x["candidate_id"], F.lit(8)))), ",").alias("members"))


@query()
def improvement_chunks(spark, d):
    return improve.insight_chunks(_items(spark, d), 400).select("input_id", "chunk_index", "token_count", F.size("candidate_ids").alias("insights"))


@query(
    f"""{CTE}, months AS (SELECT DISTINCT review_month FROM series), keys AS (SELECT DISTINCT product_id, taxonomy_id, sentiment FROM series)
    SELECT k.*, m.review_month, x.review_count FROM keys k CROSS JOIN months m LEFT JOIN series x ON x.product_id = k.product_id AND x.taxonomy_id = k.taxonomy_id AND x.sentiment = k.sentiment AND x.review_month = m.review_month"""
)
def trend_grid(spark, d):
    from quarrylens.operators.trends import month_grid

    series = gold.theme_timeseries(_review_themes(spark, d), s.reviews(spark, d))
    return month_grid(series, ["product_id", "taxonomy_id", "sentiment"], "review_month", "review_count")


@query(
    f"""{CTE}, ranked AS (SELECT product_id, taxonomy_id, sentiment, review_count, row_number() OVER (PARTITION BY product_id ORDER BY review_count DESC, theme_id) AS rank FROM themes)
    SELECT product_id, taxonomy_id, sentiment, rank, review_count, CAST(18 + floor(24.0 * review_count / max(review_count) OVER (PARTITION BY product_id) + 0.5) AS INT) AS size FROM ranked WHERE rank <= 8"""
)
def word_cloud(spark, d):
    from quarrylens.operators.trends import word_sizes

    return word_sizes(_themes(spark, d), "product_id", "theme_id", "review_count", 8).select("product_id", "taxonomy_id", "sentiment", "rank", "review_count", "size")
