"""Queries over prompts, attribution, cross-checks and bound parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrylens.operators import attribution, gold, prompts, quality, trends
from quarrylens.plans import surrogate as s
from quarrylens.plans.registry import query, table


@query("SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) > 0 AS some FROM orders WHERE o_totalprice >= 50000 AND o_orderpriority = '1-URGENT' GROUP BY o_orderstatus")
def bound_parameters(spark, d):
    sql = "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) > 0 AS some FROM {orders} WHERE o_totalprice >= :least AND o_orderpriority = :priority GROUP BY o_orderstatus"
    return spark.sql(sql, args={"least": 50000, "priority": "1-URGENT"}, orders=table(spark, d, "orders"))


ASPECTS = "SELECT l_orderkey AS review_id, l_suppkey AS product_id, l_linenumber AS sentence_id, 'line ' || l_partkey AS sentence_text, 'a' || l_partkey % 9 AS aspect_text, CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END AS aspect_sentiment FROM lineitem"


def _aspects(spark, d):
    sentiment = F.when(F.col("l_returnflag") == "A", "positive").when(F.col("l_returnflag") == "R", "negative").otherwise("neutral")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("review_id"), F.col("l_suppkey").alias("product_id"), F.col("l_linenumber").alias("sentence_id"), F.concat(F.lit("line "), F.col("l_partkey").cast("string")).alias("sentence_text"),
        F.concat(F.lit("a"), (F.col("l_partkey") % 9).cast("string")).alias("aspect_text"), sentiment.alias("aspect_sentiment"),
    )


@query(f"WITH a AS ({ASPECTS}), d AS (SELECT DISTINCT l_orderkey AS review_id, l_suppkey AS product_id, l_linenumber AS sentence_id FROM lineitem WHERE l_tax > 0.03) SELECT a.* FROM a JOIN d ON a.review_id = d.review_id AND a.product_id = d.product_id AND a.sentence_id = d.sentence_id")
def attribution_join(spark, d):
    decisions = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("review_id"), F.col("l_suppkey").alias("product_id"), F.col("l_linenumber").alias("sentence_id"), (F.col("l_tax") > 0.03).alias("is_about_product"))
    return attribution.attributed_aspects(_aspects(spark, d), decisions).select("review_id", "product_id", "sentence_id", "sentence_text", "aspect_text", "aspect_sentiment")


@query(
    f"""WITH a AS ({ASPECTS}), g AS (SELECT product_id, review_id, sentence_text, 'evaluation' AS theme_type, aspect_sentiment AS sentiment, aspect_text AS x, 'absa_' || aspect_sentiment AS o FROM a WHERE aspect_sentiment <> 'neutral'
      UNION ALL SELECT product_id, review_id, sentence_text, 'improvement', NULL, aspect_text, 'implicit_problem' FROM a WHERE aspect_sentiment = 'negative'
      UNION ALL SELECT l_suppkey, l_orderkey, 'line ' || l_partkey, 'improvement', NULL, NULL, 'explicit_suggestion' FROM lineitem WHERE l_orderkey % 25 = 0)
    SELECT product_id, review_id, sentence_text, theme_type, sentiment, coalesce(string_agg(DISTINCT x, ',' ORDER BY x), '') AS attributes, string_agg(DISTINCT o, ',' ORDER BY o) AS sources,
      md5(product_id || '|' || theme_type || '|' || coalesce(sentiment, 'none') || '|' || review_id || '|' || sentence_text) AS candidate_id FROM g GROUP BY ALL"""
)
def theme_candidates(spark, d):
    explicit = table(spark, d, "lineitem").filter("l_orderkey % 25 = 0").select(F.col("l_suppkey").alias("product_id"), F.col("l_orderkey").alias("review_id"), F.concat(F.lit("line "), F.col("l_partkey").cast("string")).alias("sentence_text"))
    out = attribution.theme_candidates(_aspects(spark, d), explicit)
    return out.withColumn("attributes", F.array_join("attributes", ",")).withColumn("sources", F.array_join("sources", ","))


@query(
    f"""{s.CTE}, i AS (SELECT product_id, taxonomy_id, CASE WHEN product_id % 2 = 0 THEN product_id || '::' || taxonomy_id || '::positive' END AS theme_id FROM improve)
    SELECT i.product_id, i.taxonomy_id, i.theme_id, coalesce(t.theme_id, n.theme_id) AS shown_theme_id, coalesce(t.review_count, n.review_count) AS shown_review_count
    FROM i LEFT JOIN themes t ON t.theme_id = i.theme_id AND t.product_id = i.product_id LEFT JOIN themes n ON n.product_id = i.product_id AND n.taxonomy_id = i.taxonomy_id AND n.sentiment = 'negative'"""
)
def matched_improvements(spark, d):
    from quarrylens.plans.gold_queries import _items, _themes

    theme_id = F.when(F.col("product_id") % 2 == 0, F.concat(F.col("product_id").cast("string"), F.lit("::"), "taxonomy_id", F.lit("::positive")))
    items = _items(spark, d).select("product_id", "taxonomy_id", theme_id.alias("theme_id"))
    return attribution.matched_improvements(items, _themes(spark, d).select("product_id", "taxonomy_id", "sentiment", "theme_id", "review_count"))


@query(
    f"""{s.CTE}, counts AS (SELECT product_id, sentiment, count(*) AS n FROM themes_kept GROUP BY ALL)
    SELECT 'review_in_two_products' AS name, (SELECT count(*) FROM (SELECT review_id, taxonomy_id FROM review_theme GROUP BY ALL HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'duplicate_theme', (SELECT count(*) FROM (SELECT theme_id FROM themes GROUP BY theme_id HAVING count(*) > 1))
    UNION ALL SELECT 'ratio_out_of_range', (SELECT count(*) FROM themes WHERE ratio_value NOT BETWEEN 0 AND 1)
    UNION ALL SELECT 'unknown_product', (SELECT count(*) FROM themes t WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = t.product_id))
    UNION ALL SELECT 'facet_mismatch', (SELECT count(*) FROM (SELECT p.product_id, f.s, (SELECT count(*) FROM themes t WHERE t.product_id = p.product_id AND t.sentiment = f.s) AS theme_count FROM products p, (VALUES ('positive'), ('negative')) f(s)) x
        LEFT JOIN (SELECT product_id, sentiment, count(*) AS n FROM themes GROUP BY ALL) c ON c.product_id = x.product_id AND c.sentiment = x.s WHERE x.theme_count IS DISTINCT FROM coalesce(c.n, 0))"""
)
def gold_checks(spark, d):
    """The aggregates' own checks, all collected before a caller decides."""
    from quarrylens.plans.gold_queries import _products, _review_themes, _themes

    themes, products, review_themes = _themes(spark, d), _products(spark, d), _review_themes(spark, d)
    checks = quality.Checks()
    checks.unique("review_in_two_products", review_themes, "review_id", "taxonomy_id")
    checks.unique("duplicate_theme", themes, "theme_id")
    checks.within("ratio_out_of_range", themes, "ratio_value", 0, 1)
    checks.references("unknown_product", themes, products, "product_id")
    facets = gold.product_facets(products, themes).filter("status <> 'not_available'").withColumn("sentiment", F.substring_index("facet", "_", 1))
    counted = themes.groupBy("product_id", "sentiment").agg(F.count("*").alias("n"))
    joined = facets.join(counted, ["product_id", "sentiment"], "left")
    checks.none("facet_mismatch", joined.filter(~F.col("theme_count").eqNullSafe(F.coalesce("n", F.lit(0)))))
    return spark.createDataFrame(list(checks.found.items()), "name string, violations long")


@query(
    """WITH c AS (SELECT p_type AS category, p_brand AS cluster_id, count(*) AS review_count FROM part GROUP BY ALL)
    SELECT category, count(*) AS cluster_count, sum(review_count)::BIGINT AS review_count, arg_min(cluster_id, (-review_count, cluster_id)) AS first_cluster FROM c GROUP BY category"""
)
def taxonomy_packets(spark, d):
    clusters = table(spark, d, "part").groupBy(F.col("p_type").alias("category"), F.col("p_brand").alias("cluster_id")).agg(F.count("*").alias("review_count"), F.countDistinct("p_size").alias("product_count"))
    clusters = clusters.withColumn("top_topic_raw", F.array(F.struct(F.lit("topic").alias("topic_raw"), F.col("review_count").alias("count")), F.struct(F.lit(" ").alias("topic_raw"), F.lit(1).cast("long").alias("count"))))
    out = prompts.packets(clusters)
    return out.select("category", "cluster_count", "review_count", F.get_json_object(F.substring_index("packet", "\n", 1), "$.cluster_id").alias("first_cluster"))


@query(
    """WITH n AS (SELECT r_name, n_name, row_number() OVER (PARTITION BY r_name ORDER BY n_name) AS i FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT r_name, 'Group these:' || chr(10) || string_agg(i || '. ' || n_name, chr(10) ORDER BY i) AS prompt FROM n GROUP BY r_name"""
)
def block_prompts(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name")
    return prompts.block_prompts(rows, ["r_name"], "n_name", "n_name", "Group these:")


@query("SELECT count(*) AS group_count, count(*) FILTER (WHERE n <= 400) AS direct_group_count, count(*) FILTER (WHERE n > 400) AS chunked_group_count, min(n) AS min, CAST(quantile_disc(n, 0.5) AS DOUBLE) AS p50, CAST(quantile_disc(n, 0.95) AS DOUBLE) AS p95, CAST(quantile_disc(n, 0.99) AS DOUBLE) AS p99, max(n) AS max FROM (SELECT len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n FROM documents)")
def token_report(spark, d):
    lengths = prompts.token_lengths(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", lambda: lambda texts: [len(t.split()) for t in texts])
    return prompts.token_report(lengths, 400)


@query(
    """WITH m AS (SELECT p_type AS cluster_id, p_partkey, p_brand || ': ' || p_name AS line, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) SELECT cluster_id, string_agg(line, ' | ' ORDER BY n) AS members, count(*) AS shown FROM m WHERE n <= 5 GROUP BY cluster_id"""
)
def member_export(spark, d):
    return prompts.member_export(table(spark, d, "part").select(F.col("p_type").alias("cluster_id"), F.col("p_partkey").alias("candidate_id"), F.col("p_brand").alias("topic_raw"), F.col("p_name").alias("evidence"), F.col("p_retailprice").alias("center_similarity")))


@query()
def approximate_percentiles(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(*trends.approximate_percentiles("l_extendedprice", 0.5, 0.9, 0.95, 0.99))


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_pairs(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderpriority").dropDuplicates(["o_custkey", "o_orderpriority"])


@query("SELECT k, count(*) AS events, avg(value) IS NOT NULL AS has_value FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events) GROUP BY k")
def json_props(spark, d):
    return table(spark, d, "events").select(F.get_json_object("props", "$.k").try_cast("long").alias("k"), "value").groupBy("k").agg(F.count("*").alias("events"), F.avg("value").isNotNull().alias("has_value"))
