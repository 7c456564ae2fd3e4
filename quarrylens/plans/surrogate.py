"""Reviews, products and insights made of the driver's tables, in Spark and as SQL.

A review is an order, a product a nation, a theme a part type, an insight a line item, its
evidence the part's name.  Return flags are polarities, a large open returned line is natively
mixed, a discount of 8 % or more leaves an insight unmapped, and one order in 97 has no month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.operators.gold import MAPPED
from quarrylens.plans.registry import table

CTE = f"""
WITH meta AS (
  SELECT n_nationkey AS product_id, n_name AS title, r_name AS category FROM nation JOIN region ON n_regionkey = r_regionkey),
reviews AS (
  SELECT o_orderkey AS review_id, c_nationkey AS product_id, o_orderstatus AS status, o_totalprice AS price,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m') END AS review_month,
         CAST(1 + o_orderkey % 5 AS DOUBLE) AS rating
  FROM orders JOIN customer ON o_custkey = c_custkey),
insights AS (
  SELECT r.review_id, r.product_id, p_type AS taxonomy_id, p_type || ' parts' AS theme_name, p_name AS evidence,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 40 THEN 'Mixed'
              WHEN l_returnflag = 'R' THEN 'negative' WHEN l_returnflag = 'A' THEN 'positive' ELSE 'neutral' END AS polarity,
         CASE WHEN l_discount >= 0.08 THEN 'unmapped' ELSE '{MAPPED}' END AS mapping_status
  FROM lineitem JOIN reviews r ON l_orderkey = r.review_id JOIN part ON l_partkey = p_partkey),
review_theme AS (
  SELECT review_id, product_id, taxonomy_id, min(theme_name) AS theme_name,
         CASE WHEN bool_or(p = 'mixed') OR (bool_or(p = 'positive') AND bool_or(p = 'negative')) THEN 'mixed'
              WHEN bool_or(p = 'negative') THEN 'negative' WHEN bool_or(p = 'positive') THEN 'positive' ELSE 'neutral' END AS sentiment,
         count(*) AS insight_count, string_agg(DISTINCT evidence, ' || ' ORDER BY evidence) AS evidence_text
  FROM (SELECT *, lower(polarity) AS p FROM insights WHERE mapping_status = '{MAPPED}') m GROUP BY ALL),
products AS (
  SELECT r.product_id, count(DISTINCT review_id) AS review_count, count(DISTINCT review_month) AS active_month_count,
         min(review_month) AS first_review_month, max(review_month) AS last_review_month, m.title, m.category, 'ready' AS analysis_status
  FROM reviews r LEFT JOIN meta m ON r.product_id = m.product_id GROUP BY r.product_id, m.title, m.category),
metrics AS (
  SELECT t.product_id, taxonomy_id, min(theme_name) AS name, count(DISTINCT review_id) AS total_review_count,
         count(DISTINCT review_id) FILTER (WHERE sentiment = 'positive') AS positive_review_count,
         count(DISTINCT review_id) FILTER (WHERE sentiment = 'negative') AS negative_review_count,
         count(DISTINCT review_id) FILTER (WHERE sentiment = 'neutral') AS neutral_review_count,
         count(DISTINCT review_id) FILTER (WHERE sentiment = 'mixed') AS mixed_review_count,
         p.category, p.review_count AS eligible_review_count
  FROM review_theme t JOIN products p ON t.product_id = p.product_id GROUP BY t.product_id, taxonomy_id, p.category, p.review_count),
themes AS (
  SELECT m.*, s.sentiment, s.review_count, m.product_id || '::' || taxonomy_id || '::' || s.sentiment AS theme_id,
         s.review_count / CAST(eligible_review_count AS DOUBLE) AS ratio_value, 'ready' AS ratio_status, 'all_product_reviews' AS ratio_definition_id
  FROM metrics m, LATERAL (SELECT 'positive' AS sentiment, positive_review_count AS review_count UNION ALL SELECT 'negative', negative_review_count) s
  WHERE s.review_count > 0),
denominator AS (
  SELECT product_id, review_month, count(DISTINCT review_id) AS eligible_review_count FROM reviews WHERE review_month IS NOT NULL GROUP BY ALL),
overlay AS (
  SELECT DISTINCT product_id, taxonomy_id, CASE WHEN product_id % 2 = 0 THEN 'positive' ELSE 'negative' END AS to_sentiment
  FROM themes WHERE sentiment = 'negative' AND product_id % 5 = 0 AND taxonomy_id IN ('PROMO', 'SMALL')),
positives AS (SELECT product_id, taxonomy_id FROM themes WHERE sentiment = 'positive' AND product_id % 10 <> 0),
themes_kept AS (SELECT t.* FROM themes t WHERE NOT (sentiment = 'positive' AND product_id % 10 = 0)),
effective AS (
  SELECT t.*, CASE WHEN t.sentiment = 'negative' THEN coalesce(o.to_sentiment, t.sentiment) ELSE t.sentiment END AS effective_sentiment,
         t.sentiment = 'negative' AND coalesce(o.to_sentiment <> 'negative', false) AS corrected
  FROM themes_kept t LEFT JOIN overlay o ON t.product_id = o.product_id AND t.taxonomy_id = o.taxonomy_id
  WHERE NOT (t.sentiment = 'negative' AND coalesce(o.to_sentiment <> 'negative', false)
             AND EXISTS (SELECT 1 FROM positives p WHERE p.product_id = t.product_id AND p.taxonomy_id = t.taxonomy_id))),
improve AS (
  SELECT product_id, taxonomy_id, min(theme_name) AS name,
         count(*) FILTER (WHERE lower(polarity) = 'negative') AS negative_insight_count, count(*) FILTER (WHERE lower(polarity) = 'mixed') AS mixed_insight_count,
         count(*) AS support_insight_count, count(DISTINCT review_id) AS support_review_count,
         left(sha256(CAST(product_id AS VARCHAR) || chr(0) || taxonomy_id), 24) AS input_id
  FROM insights WHERE mapping_status = '{MAPPED}' AND lower(polarity) IN ('negative', 'mixed') GROUP BY product_id, taxonomy_id
  HAVING count(*) FILTER (WHERE lower(polarity) = 'negative') > 0),
series AS (
  SELECT t.product_id, taxonomy_id, sentiment, r.review_month, count(DISTINCT t.review_id) AS review_count, d.eligible_review_count,
         count(DISTINCT t.review_id) / CAST(d.eligible_review_count AS DOUBLE) AS ratio_value
  FROM review_theme t JOIN reviews r ON t.review_id = r.review_id AND t.product_id = r.product_id
  JOIN denominator d ON d.product_id = t.product_id AND d.review_month = r.review_month
  WHERE sentiment IN ('positive', 'negative') GROUP BY t.product_id, taxonomy_id, sentiment, r.review_month, d.eligible_review_count)
"""


def meta(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_nationkey").alias("product_id"), F.col("n_name").alias("title"), F.col("r_name").alias("category"))


def reviews(spark: SparkSession, d: str) -> DataFrame:
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    month = F.when(F.col("o_orderkey") % 97 != 0, F.date_format("o_orderdate", "yyyy-MM"))
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("review_id"), F.col("c_nationkey").alias("product_id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        month.alias("review_month"), (F.lit(1) + F.col("o_orderkey") % 5).cast("double").alias("rating"),
    )


def insights(spark: SparkSession, d: str) -> DataFrame:
    lines, part = table(spark, d, "lineitem"), table(spark, d, "part").select("p_partkey", "p_type", "p_name")
    native = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O") & (F.col("l_quantity") > 40)
    polarity = F.when(native, "Mixed").when(F.col("l_returnflag") == "R", "negative").when(F.col("l_returnflag") == "A", "positive").otherwise("neutral")
    own = reviews(spark, d).select("review_id", "product_id")
    return lines.join(own, lines["l_orderkey"] == own["review_id"]).join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "review_id", "product_id", F.col("p_type").alias("taxonomy_id"), F.concat("p_type", F.lit(" parts")).alias("theme_name"), F.col("p_name").alias("evidence"),
        polarity.alias("polarity"), F.when(F.col("l_discount") >= 0.08, "unmapped").otherwise(MAPPED).alias("mapping_status"),
    )


def overlay(themes: DataFrame) -> DataFrame:
    """Corrections of some negative themes: to positive for even products, confirmed for odd ones."""
    chosen = themes.filter((F.col("sentiment") == "negative") & (F.col("product_id") % 5 == 0) & F.col("taxonomy_id").isin("PROMO", "SMALL"))
    return chosen.select("product_id", "taxonomy_id", F.when(F.col("product_id") % 2 == 0, "positive").otherwise("negative").alias("to_sentiment")).distinct()


def kept_themes(themes: DataFrame) -> DataFrame:
    """Without the positive themes of some products, so that both outcomes of a correction occur."""
    return themes.filter(~((F.col("sentiment") == "positive") & (F.col("product_id") % 10 == 0)))
