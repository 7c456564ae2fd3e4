"""Queries of operators that other queries don't run, over rows made out of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrylens.functions import scalars
from quarrylens.operators import cleaning, insights, quality, scope, taxonomy
from quarrylens.plans.registry import query, table
from quarrylens.plans.text_queries import PATHS


@query(
    r"""SELECT p_partkey, to_base64(encode(p_name)) AS packed, regexp_replace(array_to_string(string_split(trim(regexp_replace('"' || p_name || ' a  b, c', '\s+', ' ', 'g')), ' ')[1:3], ' '), '^[\s[:punct:]]+|[\s[:punct:]]+$', '', 'g') AS phrase,
    CASE p_size % 3 WHEN 0 THEN 'Praise: ' WHEN 1 THEN 'Concern: ' ELSE 'Improve: ' END || p_type AS title,
    CASE WHEN p_size / 25.0 - 1 >= 0.05 THEN 'positive' WHEN p_size / 25.0 - 1 <= -0.05 THEN 'negative' ELSE 'neutral' END AS label,
    p_size / 50.0 > (p_partkey % 5) / 5.0 AND p_size / 50.0 > (p_partkey % 7) / 7.0 AS entailed FROM part"""
)
def part_texts(spark, d):
    size, key = F.col("p_size"), F.col("p_partkey")
    sentiment = F.when(size % 3 == 0, "positive").when(size % 3 == 1, "negative").otherwise("other")
    return table(spark, d, "part").select(
        "p_partkey", F.base64(F.col("p_name").cast("binary")).alias("packed"), scalars.phrase(F.concat(F.lit('"'), "p_name", F.lit(" a  b, c")), 3).alias("phrase"),
        scalars.theme_title(sentiment, F.col("p_type")).alias("title"), scalars.sentiment_label(size / 25.0 - 1).alias("label"),
        scalars.entails(size / 50.0, (key % 5) / 5.0, (key % 7) / 7.0).alias("entailed"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN epoch(o_orderdate)::BIGINT END AS seconds, round_even(o_totalprice / 7, 2) AS price FROM orders"""
)
def order_stamps(spark, d):
    text = F.when(F.col("o_orderkey") % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("no date")
    return table(spark, d, "orders").select("o_orderkey", F.unix_timestamp(scalars.timestamp(text)).alias("seconds"), scalars.round_even(F.col("o_totalprice") / 7).alias("price"))


METRICS = """SELECT c_nationkey AS group_id, count(*) AS review_count, count(DISTINCT c_custkey) AS product_count, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS eligible_text_rate,
    count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS active_months FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey"""


@query(
    f"""WITH m AS ({METRICS})
    SELECT group_id, round(0.35 * least(ln(1 + review_count) / ln(1000001), 1) + 0.20 * least(ln(1 + product_count) / ln(10001), 1) + 0.20 * eligible_text_rate + 0.10 * least(active_months / 120.0, 1) + 0.10 * 0.5 + 0.05 * least((group_id % 6) / 4.0, 1), 8) AS selection_score FROM m"""
)
def selection_scores(spark, d):
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    m = orders.groupBy(F.col("c_nationkey").alias("group_id")).agg(
        F.count("*").alias("review_count"), F.countDistinct("c_custkey").alias("product_count"), F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("eligible_text_rate"),
        F.countDistinct(F.date_format("o_orderdate", "yyyy-MM")).alias("active_months"),
    )
    m = m.withColumn("metadata_identifiability", F.lit(0.5)).withColumn("category_depth", F.col("group_id") % 6)
    return m.select("group_id", scope.selection_score().alias("selection_score"))


@query(
    """WITH p AS (SELECT p_partkey, p_size, CASE p_partkey % 6 WHEN 0 THEN 'ice-makers' WHEN 1 THEN 'dryers' WHEN 2 THEN 'dryers' WHEN 3 THEN 'kettles' WHEN 5 THEN 'washers' END AS group_id, CASE p_partkey % 6 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS depth FROM part),
    g AS (SELECT group_id, count(*) AS product_count, sum(CASE WHEN p_size > 20 THEN 1 ELSE 0 END)::BIGINT AS identifiable_product_count, max(depth) AS category_depth FROM p WHERE group_id IS NOT NULL GROUP BY group_id),
    r AS (SELECT group_id, count(*) AS review_count, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::BIGINT AS eligible_text_count, count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS active_months, min(strftime(l_shipdate, '%Y-%m')) AS first_month, max(strftime(l_shipdate, '%Y-%m')) AS last_month FROM lineitem JOIN p ON l_partkey = p_partkey WHERE group_id IS NOT NULL GROUP BY group_id)
    SELECT g.group_id, product_count, identifiable_product_count, category_depth, identifiable_product_count / CAST(product_count AS DOUBLE) AS metadata_identifiability, coalesce(review_count, 0) AS review_count, coalesce(eligible_text_count, 0) AS eligible_text_count,
    coalesce(active_months, 0) AS active_months, first_month, last_month, coalesce(eligible_text_count / CAST(review_count AS DOUBLE), 0) AS eligible_text_rate FROM g LEFT JOIN r ON g.group_id = r.group_id"""
)
def product_group_profile(spark, d):
    path = F.split(F.expr(PATHS), ">")
    products = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("parent_asin"), F.when(F.col("p_size") > 20, F.col("p_name")).alias("title"), F.lit(None).cast("string").alias("store"), path.alias("categories"), F.lit(None).cast("string").alias("main_category"))
    reviews = table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"), F.col("l_partkey").cast("string").alias("parent_asin"), F.date_format("l_shipdate", "yyyy-MM").alias("review_month"), (F.col("l_returnflag") == "A").alias("eligible_nlp"))
    return scope.group_profile(products, reviews).drop("name")


@query(
    """SELECT p_partkey AS source_line_number, CASE WHEN p_partkey % 10 = 0 THEN 'quarantined' ELSE 'ok' END AS parse_status, CASE p_partkey % 10 WHEN 0 THEN 'duplicate_json_key' END AS parse_error_code,
    CASE WHEN p_partkey % 10 NOT IN (0, 1) THEN CAST(p_size AS DOUBLE) END AS price, CASE WHEN p_partkey % 10 NOT IN (0, 2) THEN p_brand END AS store,
    CASE p_partkey % 10 WHEN 1 THEN 'price:invalid_value' WHEN 2 THEN 'store:invalid_value' WHEN 3 THEN 'title:missing' WHEN 4 THEN 'categories:invalid_type' ELSE '' END AS issues FROM part"""
)
def product_fields(spark, d):
    key = F.col("p_partkey")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    parts = [
        F.concat(F.lit('"parent_asin":'), quoted(key.cast("string"))), F.when(key % 10 != 3, F.concat(F.lit('"title":'), quoted(F.col("p_name")))),
        F.concat(F.lit('"store":'), F.when(key % 10 == 2, '" "').otherwise(quoted(F.col("p_brand")))), F.lit('"main_category":"M","details":{},"features":[],"description":[]'),
        F.concat(F.lit('"price":'), F.when(key % 10 == 1, "-1").otherwise(F.col("p_size").cast("string"))), F.concat(F.lit('"categories":'), F.when(key % 10 == 4, '"x"').otherwise('["x"]')),
        F.when(key % 10 == 0, '"price":3'),
    ]
    rows = table(spark, d, "part").select(F.lit("part").alias("source_file"), key.alias("source_line_number"), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("raw_json"), F.lit(None).cast("string").alias("raw_bytes_base64"))
    out = cleaning.clean_products(rows, "release", "run")
    return out.select("source_line_number", "parse_status", "parse_error_code", "price", "store", F.array_join("field_issues", ",").alias("issues"))


@query("SELECT count(*) AS total, count(*) FILTER (o_orderkey % 7 <> 0) AS retained, count(*) FILTER (o_orderkey % 7 = 0) AS quarantined, CAST(0 AS BIGINT) AS lost FROM orders")
def row_conservation(spark, d):
    text = F.when(F.col("o_orderkey") % 7 == 0, "{").otherwise(F.to_json(F.struct(F.col("o_orderpriority").alias("text"))))
    rows = table(spark, d, "orders").select(F.lit("orders").alias("source_file"), F.col("o_orderkey").alias("source_line_number"), text.alias("raw_json"), F.lit(None).cast("string").alias("raw_bytes_base64"))
    retained, quarantined = cleaning.split_quarantine(cleaning.clean_reviews(rows, "release", "run"))
    counted = [df.agg(F.count("*").alias(n)) for df, n in ((rows, "total"), (retained, "retained"), (quarantined, "quarantined"))]
    # three frames of one row each
    out = counted[0].join(counted[1]).join(counted[2])
    return out.withColumn("lost", F.col("total") - F.col("retained") - F.col("quarantined"))


@query("""SELECT p_partkey FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 4 + 6 > length(p_name)""")
def span_integrity(spark, d):
    start = (F.col("p_partkey") % 4).cast("int")
    rows = table(spark, d, "part").withColumn("start", start).withColumn("end", F.col("start") + 6)
    rows = rows.withColumn("piece", F.when(F.col("p_partkey") % 10 == 0, "??????").otherwise(F.substring(F.col("p_name"), F.col("start") + 1, F.lit(6))))
    return quality.span_violations(rows, "p_name", "start", "end", "piece").select("p_partkey")


@query(
    """SELECT 'orphan_member' AS error, p_partkey + 100000000 AS candidate_id FROM part WHERE p_partkey % 11 = 0
    UNION ALL SELECT 'duplicate_member', p_partkey FROM part WHERE p_partkey % 13 = 0 AND p_partkey % 11 <> 0
    UNION ALL SELECT 'identity_mismatch', p_partkey FROM part, range(CASE WHEN p_partkey % 13 = 0 THEN 2 ELSE 1 END) WHERE p_partkey % 17 = 0 AND p_partkey % 11 <> 0"""
)
def mapping_identity(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("candidate_id"), F.col("p_size").alias("review_id"), F.col("p_brand").alias("product_id"))
    key = F.col("candidate_id")
    members = part.withColumn("product_id", F.when(key % 17 == 0, None).otherwise(F.col("product_id"))).withColumn("copies", F.when((key % 13 == 0) & (key % 11 != 0), F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    members = members.withColumn("copy", F.explode("copies")).withColumn("candidate_id", F.when(key % 11 == 0, key + 100_000_000).otherwise(key))
    return taxonomy.mapping_errors(part, members.select("candidate_id", "review_id", "product_id"))


@query(
    """WITH x AS (SELECT l_partkey AS product_id, l_returnflag AS polarity, l_linestatus AS target_scope FROM lineitem),
    y AS (SELECT *, EXISTS (SELECT 1 FROM part WHERE p_partkey = product_id AND p_size > 10) AS known FROM x)
    SELECT count(*) AS insights, count(*) FILTER (target_scope <> 'F') AS other_scope, count(*) FILTER (target_scope = 'F' AND polarity NOT IN ('A', 'R')) AS other_polarity,
    count(*) FILTER (target_scope = 'F' AND polarity IN ('A', 'R') AND NOT known) AS unknown_product, count(*) FILTER (target_scope = 'F' AND polarity IN ('A', 'R') AND known) AS candidates FROM y"""
)
def candidate_counts(spark, d):
    insight = F.struct(F.col("l_returnflag").alias("polarity"), F.col("l_linestatus").alias("target_scope"))
    records = table(spark, d, "lineitem").select(F.col("l_partkey").alias("product_id"), F.lit("success").alias("processing_status"), F.array(insight).alias("insights"))
    products = table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("product_id"))
    return insights.candidate_counters(records, products, ("A", "R"), ("F",))


@query("SELECT CASE WHEN p_size % 5 <> 0 THEN p_size % 5 END AS k, p_type AS t, count(*) AS \"count\" FROM part GROUP BY ALL")
def bounded_profile(spark, d):
    part = table(spark, d, "part").select(F.when(F.col("p_size") % 5 != 0, F.col("p_size") % 5).alias("k"), F.col("p_type").alias("t"))
    return spark.createDataFrame(quality.group_profile(part, "k", "t"), "k int, t string, count long")


@query("SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders")
def fingerprint_keys(spark, d):
    return quality.fingerprint(table(spark, d, "orders"), "o_orderkey").drop("hash_sum")


@query(
    """WITH x AS (SELECT CASE p_partkey % 3 WHEN 0 THEN p_name || ' and ' || p_name WHEN 1 THEN p_name ELSE 'nothing of it' END AS t, p_name AS q FROM part),
    c AS (SELECT (length(t) - length(replace(t, q, ''))) / length(q) AS n FROM x)
    SELECT count(*) AS quotes, count(*) FILTER (n = 1) AS once, count(*) FILTER (n > 1) AS several, count(*) FILTER (n = 0) AS absent, count(*) FILTER (n > 1) / CAST(count(*) AS DOUBLE) AS ambiguity_rate FROM c"""
)
def evidence_ambiguity(spark, d):
    name = F.col("p_name")
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(name, F.lit(" and "), name)).when(F.col("p_partkey") % 3 == 1, name).otherwise("nothing of it")
    return insights.ambiguity(table(spark, d, "part").select(text.alias("text"), name.alias("quote")), "text", "quote")
