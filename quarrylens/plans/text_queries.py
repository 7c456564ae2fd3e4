"""Queries over cleaning, texts, insights, vectors, taxonomies and scope."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrylens.functions import scalars
from quarrylens.operators import cleaning, duplicates, insights, scope, taxonomy, text, vectors
from quarrylens.operators.gold import MAPPED
from quarrylens.plans.registry import query, table
from quarrylens.sources.storage import written

RELEASE = "release-1"


def _envelopes(spark, d):
    """Events as review lines: good ones, wrong types and ranges, broken JSON, bytes that are no UTF-8."""
    e = table(spark, d, "events")
    k = F.col("event_id")
    rating = F.when(k % 11 == 0, F.lit("true")).when(k % 11 == 1, F.lit('"5"')).when(k % 11 == 2, F.lit("0")).when(k % 11 == 3, F.lit("null")).when(k % 11 == 4, F.lit("4.5")).otherwise((k % 5 + 1).cast("string"))
    stamp = F.when(k % 13 == 0, F.lit("1696118400000")).when(k % 13 == 1, F.lit('"1"')).otherwise((F.lit(1600000000000) + k * 86400000).cast("string"))
    body = F.when(k % 17 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Text "), (k % 300).cast("string"), F.lit(" caf\\u00e9 ")))
    made = F.concat(
        F.lit('{"rating": '), rating, F.lit(', "timestamp": '), stamp, F.lit(', "title": "t", "text": "'), body, F.lit('", "asin": "A'), (k % 40).cast("string"), F.lit('", "parent_asin": "P'), (k % 20).cast("string"),
        F.lit('", "user_id": "U'), F.col("user_id").cast("string"), F.lit('", "helpful_vote": '), (k % 7 - 1).cast("string"), F.lit(', "verified_purchase": '), F.when(k % 2 == 0, "true").otherwise("false"), F.lit("}"),
    )
    line = F.when(k % 101 == 0, F.lit("{")).when(k % 101 == 1, F.lit("[]")).when(k % 101 == 2, F.lit('{"x":1,"x":2}')).when(k % 101 == 3, F.lit('{"rating": NaN}')).when(k % 101 == 4, F.lit('{"rating": 1e999}')).when(k % 101 == 5, F.lit(None)).otherwise(made)
    raw = F.when(k % 101 == 5, F.lit("/w=="))
    return e.select(F.lit("events.jsonl").alias("source_file"), k.alias("source_line_number"), line.alias("raw_json"), raw.alias("raw_bytes_base64"))


# The same rules over the number of the event, without any JSON.
CLEAN = f"""
WITH e AS (SELECT event_id AS k, user_id FROM events),
c AS (SELECT k, user_id,
  CASE WHEN k % 101 = 0 THEN 'invalid_json' WHEN k % 101 = 1 THEN 'non_object_json' WHEN k % 101 = 2 THEN 'duplicate_json_key' WHEN k % 101 IN (3, 4) THEN 'nonfinite_json_number' WHEN k % 101 = 5 THEN 'invalid_utf8' END AS code,
  CASE WHEN k % 11 IN (0, 1) THEN 'invalid_type' WHEN k % 11 = 2 THEN 'invalid_value' WHEN k % 11 = 3 THEN 'null' ELSE 'valid' END AS rating_status,
  CASE WHEN k % 11 = 4 THEN 4.5 WHEN k % 11 > 4 THEN CAST(k % 5 + 1 AS DOUBLE) END AS rating,
  CASE WHEN k % 13 = 0 THEN 'invalid_value' WHEN k % 13 = 1 THEN 'invalid_type' WHEN 1600000000000 + k * 86400000 > 1696118399999 THEN 'invalid_value' ELSE 'valid' END AS stamp_status,
  1600000000000 + k * 86400000 AS stamp, CASE WHEN k % 7 = 0 THEN 'invalid_value' ELSE 'valid' END AS vote_status,
  CASE WHEN k % 17 = 0 THEN '' ELSE 'Text ' || k % 300 || ' café' END AS body FROM e),
clean AS (SELECT *, sha256('{RELEASE}' || chr(10) || 'events.jsonl' || chr(10) || k) AS review_id FROM c)
"""


@query(
    f"""{CLEAN} SELECT k AS source_line_number, CASE WHEN code IS NULL THEN 'ok' ELSE 'quarantined' END AS parse_status, code AS parse_error_code, review_id,
    CASE WHEN code IS NULL THEN rating_status END AS rating_status, CASE WHEN code IS NULL THEN stamp_status END AS stamp_status, CASE WHEN code IS NULL THEN vote_status END AS vote_status,
    CASE WHEN code IS NULL THEN array_to_string([x FOR x IN [CASE WHEN rating_status <> 'valid' THEN 'rating:' || rating_status END, CASE WHEN stamp_status <> 'valid' THEN 'timestamp:' || stamp_status END,
      CASE WHEN vote_status <> 'valid' THEN 'helpful_vote:' || vote_status END] IF x IS NOT NULL], ',') ELSE '' END AS field_issues FROM clean"""
)
def field_status(spark, d):
    rows = cleaning.clean_reviews(_envelopes(spark, d), RELEASE, "run")
    status = lambda n: F.try_element_at("field_status", F.lit(n))
    return rows.select("source_line_number", "parse_status", "parse_error_code", "review_id", status("rating").alias("rating_status"), status("timestamp").alias("stamp_status"), status("helpful_vote").alias("vote_status"), F.array_join("field_issues", ",").alias("field_issues"))


@query(f"{CLEAN} SELECT coalesce(code, 'ok') AS outcome, count(*) AS n FROM clean GROUP BY 1")
def quarantine_split(spark, d):
    kept, bad = cleaning.split_quarantine(cleaning.clean_reviews(_envelopes(spark, d), RELEASE, "run"))
    return kept.select(F.lit("ok").alias("outcome")).unionByName(bad.select(F.col("parse_error_code").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    f"""{CLEAN} SELECT k AS source_line_number, CASE WHEN rating_status = 'valid' THEN rating END AS rating, rating_status = 'valid' AS rating_valid, CASE WHEN rating_status = 'valid' THEN rating <= 2 END AS low_rating,
    CASE WHEN stamp_status = 'valid' THEN stamp END AS timestamp_ms, CASE WHEN stamp_status = 'valid' THEN strftime(make_timestamp(stamp * 1000), '%Y-%m') END AS review_month,
    CASE WHEN stamp_status = 'valid' THEN strftime(make_timestamp(stamp * 1000), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS reviewed_at_iso FROM clean WHERE code IS NULL"""
)
def epoch_fields(spark, d):
    return cleaning.clean_reviews(_envelopes(spark, d), RELEASE, "run").filter("parse_status = 'ok'").select("source_line_number", "rating", "rating_valid", "low_rating", "timestamp_ms", "review_month", "reviewed_at_iso")


@query(f"{CLEAN} SELECT k AS source_line_number, body AS text_normalized, length(body) AS text_length, CASE WHEN body <> '' THEN sha256(nfc_normalize(body)) END AS body_hash FROM clean WHERE code IS NULL")
def body_hash(spark, d):
    return cleaning.clean_reviews(_envelopes(spark, d), RELEASE, "run").filter("parse_status = 'ok'").select("source_line_number", "text_normalized", "text_length", "body_hash")


@query(
    f"""{CLEAN} SELECT k AS source_line_number, rating_status = 'valid' AS eligible_rating_stats, body <> '' AS eligible_text, CASE WHEN body = '' THEN false END AS eligible_nlp,
    CASE WHEN rating_status = 'valid' THEN '' ELSE 'rating:' || rating_status END AS rating_reasons, CASE WHEN body = '' THEN 'text:empty' ELSE 'language_not_assessed,text_suitability_not_calibrated' END AS nlp_reasons FROM clean WHERE code IS NULL"""
)
def eligibility_flags(spark, d):
    rows = cleaning.clean_reviews(_envelopes(spark, d), RELEASE, "run").filter("parse_status = 'ok'")
    return rows.select("source_line_number", "eligible_rating_stats", "eligible_text", "eligible_nlp", F.array_join("rating_exclusion_reasons", ",").alias("rating_reasons"), F.array_join("nlp_exclusion_reasons", ",").alias("nlp_reasons"))


@query(
    f"""{CLEAN}, ok AS (SELECT *, CASE WHEN body <> '' THEN body END AS b, 'A' || k % 40 AS asin, 'P' || k % 20 AS parent FROM clean WHERE code IS NULL),
    g AS (SELECT b, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT parent) AS parents, count(DISTINCT asin) AS asins FROM ok WHERE b IS NOT NULL GROUP BY b)
    SELECT k AS source_line_number, n AS body_group_size, coalesce(n > 1, false) AS body_duplicate, coalesce(users > 1, false) AS body_cross_user, coalesce(parents > 1, false) AS body_cross_parent, coalesce(asins > 1, false) AS body_cross_variant
    FROM ok LEFT JOIN g ON ok.b = g.b"""
)
def duplicate_marking(spark, d):
    # cleaned rows are written once, as a silver table would be, and read three times
    kept = written(cleaning.clean_reviews(_envelopes(spark, d), RELEASE, "run").filter("parse_status = 'ok'").select("source_line_number", "exact_hash", "body_hash", "user_id_hash", "parent_asin", "asin"))
    return duplicates.mark_duplicates(kept).select("source_line_number", "body_group_size", "body_duplicate", "body_cross_user", "body_cross_parent", "body_cross_variant")


@query(f"{CLEAN} SELECT DISTINCT 'A' || k % 40 AS asin, 'P' || k % 20 AS parent_asin FROM clean WHERE code IS NULL")
def variant_bridge(spark, d):
    return duplicates.variant_bridge(cleaning.clean_reviews(_envelopes(spark, d), RELEASE, "run").filter("parse_status = 'ok'"))


WORD_SQL = "[A-Za-z]+(?:[''’-][A-Za-z]+)*|[0-9]+(?:[./][0-9]+)*"


@query(
    f"""SELECT doc_id, length(text) AS char_count, len(regexp_extract_all(text, '{WORD_SQL}')) AS word_count,
    len(list_filter(regexp_extract_all(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '[^.!?]+(?:[.!?]+|$)'), lambda s: regexp_matches(s, '[\\p{{L}}\\p{{N}}]'))) AS sentence_count,
    len(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '\\S'))) AS line_count, len(regexp_extract_all(text, '\\p{{L}}')) AS alphabetic_count FROM documents"""
)
def text_features(spark, d):
    return text.text_features(table(spark, d, "documents").select("doc_id", "text"), "text").drop("text")


LANGUAGE_P = "CASE WHEN doc_id % 9 = 0 THEN 0.5 WHEN doc_id % 9 = 1 THEN 1.5 ELSE 0.95 END"


@query(
    f"""WITH f AS (SELECT doc_id, lang, CAST({LANGUAGE_P} AS DOUBLE) AS p, len(regexp_extract_all(text, '\\p{{L}}')) AS letters, text FROM documents),
    s AS (SELECT *, CASE WHEN text = '' THEN 'empty' WHEN letters = 0 THEN 'non_linguistic' WHEN letters < 20 THEN 'too_short' WHEN p > 1 THEN 'invalid_prediction' WHEN p < 0.8 THEN 'low_confidence' WHEN lang <> 'en' THEN 'non_english' ELSE 'accepted' END AS st FROM f)
    SELECT doc_id, st AS language_status, CASE WHEN st IN ('low_confidence', 'non_english', 'accepted') THEN lang ELSE 'unknown' END AS language, CASE WHEN st IN ('low_confidence', 'non_english', 'accepted') THEN p END AS language_confidence,
    st = 'accepted' AS eligible_nlp, CASE WHEN st = 'accepted' THEN '' WHEN st IN ('empty', 'non_linguistic', 'too_short') THEN 'text:' || st ELSE 'language:' || st END AS reasons FROM s"""
)
def language_admission(spark, d):
    docs = text.text_features(table(spark, d, "documents").select("doc_id", "text", "lang"), "text")
    label, p = F.concat(F.lit("__label__"), F.col("lang")), F.expr(LANGUAGE_P).cast("double")
    out = text.admit_language(docs, "text", label, p, min_alphabetic=20)
    return out.select("doc_id", "language_status", "language", "language_confidence", "eligible_nlp", F.array_join("nlp_exclusion_reasons", ",").alias("reasons"))


@query(
    """WITH c AS (SELECT doc_id, regexp_replace(text, '([.!?]["'')\\]}]*)\\s+([A-Z0-9"''(\\[])', '\\1' || chr(1) || '\\2', 'g') AS t FROM documents),
    p AS (SELECT doc_id, list_filter([regexp_replace(x, '^\\s+|\\s+$', '', 'g') FOR x IN string_split(t, chr(1))], lambda x: x <> '') AS pieces FROM c)
    SELECT doc_id, len(pieces) AS sentences, coalesce(list_sum([length(x) FOR x IN pieces]), 0)::BIGINT AS chars, coalesce(list_max([length(x) FOR x IN pieces]), 0) AS longest FROM p"""
)
def sentences(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = text.sentences(docs, "doc_id", "text").groupBy("doc_id").agg(F.count("*").alias("sentences"), F.sum(F.length("sentence_text")).alias("chars"), F.max(F.length("sentence_text")).cast("long").alias("longest"))
    zero = F.lit(0).cast("long")
    return docs.select("doc_id").join(found, "doc_id", "left").select("doc_id", *[F.coalesce(c, zero).alias(c) for c in ("sentences", "chars", "longest")])


@query()
def chunks(spark, d):
    return text.chunks(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", "chunk_id", "chunk_index", "sentence_start_index", "sentence_end_index", "char_start", "char_end", "word_count", "oversize_sentence")


STOP_SQL = "(" + ", ".join(f"'{w}'" for w in text.STOP_WORDS) + ")"


@query(
    f"""WITH t AS (SELECT doc_id, lang, list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: length(w) >= 3 AND w NOT IN {STOP_SQL}) AS w FROM documents),
    g AS (SELECT doc_id, lang, unnest(list_distinct(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]))) AS theme FROM t),
    df AS (SELECT theme, count(DISTINCT doc_id) AS global_df FROM g GROUP BY theme), n AS (SELECT count(DISTINCT doc_id) AS total FROM documents), z AS (SELECT lang, count(DISTINCT doc_id) AS group_reviews FROM documents GROUP BY lang),
    s AS (SELECT g.lang, g.theme, count(DISTINCT doc_id) AS review_count, global_df, group_reviews, count(DISTINCT doc_id) * (ln((total + 1) / CAST(global_df + 1 AS DOUBLE)) + 1.0) AS score
          FROM g JOIN df ON g.theme = df.theme JOIN z ON z.lang = g.lang, n GROUP BY g.lang, g.theme, global_df, group_reviews, total HAVING count(DISTINCT doc_id) >= 20),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, review_count DESC, theme) AS rank FROM s)
    SELECT lang, theme, review_count, global_df, group_reviews, round(score, 6) AS tfidf_score, review_count / CAST(group_reviews AS DOUBLE) AS review_share, rank FROM r WHERE rank <= 20"""
)
def tfidf_topk(spark, d):
    out = text.top_terms(table(spark, d, "documents").select("doc_id", "lang", "text"), "doc_id", ["lang"], "text", 20, 20, unique_ids=True)
    return out.withColumn("tfidf_score", F.round("tfidf_score", 6))


@query("SELECT conv_id, turn FROM conversations WHERE regexp_matches(coalesce(CASE turn % 4 WHEN 0 THEN 'They would like ' || text WHEN 1 THEN 'Needless ' || text ELSE text END, ''), '(?i)\\b(?:wish(?:es|ed|ing)?|need(?:s|ed|ing)?|should|could|would like|if only|hope(?:s|d|ing)?)\\b')")
def demand_candidates(spark, d):
    said = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("They would like "), "text")).when(F.col("turn") % 4 == 1, F.concat(F.lit("Needless "), "text")).otherwise(F.col("text"))
    return text.demand_candidates(table(spark, d, "conversations").withColumn("text", said), "text").select("conv_id", "turn")


PATHS = "CASE p_partkey % 6 WHEN 0 THEN 'Appliances > Ice Makers' WHEN 1 THEN 'Appliances > Parts & Accessories > Dryers' WHEN 2 THEN 'Dryers' WHEN 3 THEN 'Appliances > Kettles' WHEN 4 THEN '' ELSE 'Refrigerators >  Washers ' END"


@query(f"WITH p AS (SELECT p_partkey, p_partkey % 6 AS r FROM part) SELECT p_partkey, CASE r WHEN 0 THEN 'included' WHEN 1 THEN 'excluded' WHEN 2 THEN 'included' WHEN 5 THEN 'included' ELSE 'review' END AS state, CASE r WHEN 0 THEN 'Ice Makers' WHEN 2 THEN 'Dryers' WHEN 5 THEN 'Washers' END AS category FROM p")
def category_classify(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.expr(PATHS).alias("path"))
    return part.withColumn("c", scope.classify_category(F.split("path", ">"))).select("p_partkey", "c.state", "c.category")


@query(
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'ice-makers' WHEN 1 THEN 'dryers' WHEN 2 THEN 'dryers' WHEN 3 THEN 'kettles' WHEN 4 THEN NULL ELSE 'washers' END AS group_id,
    CASE p_partkey % 6 WHEN 0 THEN 'ice maker' WHEN 1 THEN 'dryer' WHEN 2 THEN 'dryer' WHEN 3 THEN 'kettle' WHEN 4 THEN '' ELSE 'washer' END AS family, CASE p_partkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN NULL ELSE 2 END AS category_depth FROM part""".replace("'ice maker'", "'maker'")
)
def group_keys(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.split(F.expr(PATHS), ">").alias("path"))
    g = part.withColumn("g", scope.product_groups("path", F.lit(None).cast("string")))
    return g.select("p_partkey", "g.group_id", scope.semantic_family(F.col("g.name"), F.col("g.group_id")).alias("family"), "g.category_depth")


@query(
    """WITH m AS (SELECT c_nationkey AS g, count(*) AS review_count, count(DISTINCT c_custkey) AS product_count, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS eligible_text_rate, count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS active_months FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
    SELECT g, review_count, array_to_string([x FOR x IN [CASE WHEN review_count < 600 THEN 'reviews_below_600' END, CASE WHEN product_count < 40 THEN 'products_below_40' END, CASE WHEN eligible_text_rate < 0.33 THEN 'eligible_text_rate_below_0.33' END, CASE WHEN active_months < 12 THEN 'active_months_below_12' END, 'metadata_identifiability_below_0.80', 'category_depth_below_2'] IF x IS NOT NULL], ',') AS reasons, 'rejected' AS selection_state FROM m"""
)
def group_gates(spark, d):
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    m = orders.groupBy(F.col("c_nationkey").alias("g")).agg(
        F.count("*").alias("review_count"), F.countDistinct("c_custkey").alias("product_count"), F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("eligible_text_rate"),
        F.countDistinct(F.date_format("o_orderdate", "yyyy-MM")).alias("active_months"),
    )
    m = m.withColumn("metadata_identifiability", F.lit(0.5)).withColumn("category_depth", F.lit(None).cast("int"))
    out = scope.with_gates(m, {"review_count": 600, "product_count": 40, "eligible_text_rate": 0.33})
    return out.select("g", "review_count", F.array_join("rejection_reasons", ",").alias("reasons"), "selection_state")


@query(
    """WITH r AS (SELECT o_orderkey, c_nationkey AS product_id, strftime(o_orderdate, '%Y-%m') AS m, o_orderstatus AS s FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 19 <> 0),
    x AS (SELECT product_id, count(*) AS review_count, count(DISTINCT m) AS active_months, max(m) AS last_review_month, count(*) FILTER (WHERE s = 'F') AS positive_count, count(*) FILTER (WHERE s = 'O') AS negative_count, count(*) FILTER (WHERE s = 'P') AS neutral_count FROM r WHERE m <= '1998-06' GROUP BY product_id)
    SELECT x.*, n_name AS title, r_name AS product_category FROM x JOIN nation ON product_id = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE', 'AFRICA') AND review_count >= 20 AND active_months >= 12 AND last_review_month >= '1998-01'"""
)
def scope_selection(spark, d):
    reviews = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    sentiment = F.when(F.col("o_orderstatus") == "F", "positive").when(F.col("o_orderstatus") == "O", "negative").otherwise("neutral")
    reviews = reviews.select(F.col("c_nationkey").alias("product_id"), F.date_format("o_orderdate", "yyyy-MM").alias("review_month"), sentiment.alias("sentiment"), F.when(F.col("o_orderkey") % 19 == 0, True).alias("exact_duplicate"))
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    products = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("product_id"), F.col("n_name").alias("title"), F.col("r_name").alias("product_category"))
    return scope.product_scope(reviews, products, ("ASIA", "EUROPE", "AFRICA"), "1998-06", "1998-01", least_reviews=20)


def _responses(spark, d):
    """Responses over benchmark passages: exact and loose quotes, repeats, unknown fields, no JSON."""
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("review_id"), "text")
    k = F.col("review_id")
    quote = F.regexp_replace(F.substring("text", 1, 60), r"\s+$", "")
    insight = lambda topic, polarity, evidence: F.struct(F.lit(topic).alias("topic_raw"), F.lit(polarity).alias("polarity"), evidence.alias("evidence"), F.lit("current_product").alias("target_scope"))
    good, loose = insight("Noise ", "negative", quote), insight("noise", "negative", F.regexp_replace(quote, " ", "  "))
    wrong, missing = insight("size", "angry", quote), insight("colour", "mixed", F.lit("no such words at all"))
    items = F.when(k % 5 == 0, F.array(good)).when(k % 5 == 1, F.array(good, loose, wrong)).when(k % 5 == 2, F.array(wrong, missing)).when(k % 5 == 3, F.filter(F.array(good), lambda x: F.lit(False))).otherwise(F.array(loose))
    response = F.when(k % 17 == 16, F.lit("not json")).otherwise(F.to_json(F.struct(items.alias("insights"))))
    return b.withColumn("product_id", (k % 4).cast("long")).withColumn("response", response)


@query(
    """SELECT item_id AS review_id, CASE WHEN item_id % 17 = 16 THEN 'failed' WHEN item_id % 5 IN (0, 4) THEN 'success' WHEN item_id % 5 = 1 THEN 'partial_success' WHEN item_id % 5 = 2 THEN 'failed' ELSE 'success_no_insight' END AS processing_status,
    CASE WHEN item_id % 17 = 16 OR item_id % 5 IN (2, 3) THEN 0 ELSE 1 END AS accepted, CASE WHEN item_id % 17 = 16 THEN 0 WHEN item_id % 5 = 1 THEN 1 WHEN item_id % 5 = 2 THEN 2 ELSE 0 END AS rejected,
    CASE WHEN item_id % 17 <> 16 AND item_id % 5 IN (0, 1, 4) THEN regexp_replace(substr(text, 1, 60), '\\s+$', '') END AS evidence FROM benchmark"""
)
def contract_validate(spark, d):
    out = insights.validate_responses(_responses(spark, d), "review_id", "text", "response")
    return out.select("review_id", "processing_status", F.size("insights").alias("accepted"), F.size("rejected_insights").alias("rejected"), F.try_element_at(F.col("insights.evidence"), F.lit(1)).alias("evidence"))


@query(
    """WITH g AS (SELECT item_id AS review_id, item_id % 4 AS product_id, CASE WHEN item_id % 5 = 4 THEN 'noise' ELSE 'Noise' END AS topic, regexp_replace(substr(text, 1, 60), '\\s+$', '') AS evidence FROM benchmark WHERE item_id % 17 <> 16 AND item_id % 5 IN (0, 1, 4) AND item_id % 4 <> 3)
    SELECT review_id, product_id, left(sha256(review_id || '|' || product_id || '|0|' || topic || '|' || evidence || '|current_product|negative'), 24) AS candidate_id, topic || ': ' || trim(regexp_replace(evidence, '\\s+', ' ', 'g')) AS candidate_text, 'cat-' || product_id AS category_slug FROM g"""
)
def candidate_explode(spark, d):
    rows = _responses(spark, d)
    records = insights.validate_responses(rows, "review_id", "text", "response").join(rows.select("review_id", "product_id"), "review_id")
    products = spark.range(3).select(F.col("id").alias("product_id"), F.lit("p").alias("title"), F.concat(F.lit("Cat "), F.col("id").cast("string")).alias("category"))
    return insights.candidates(records, products).select("review_id", "product_id", "candidate_id", "candidate_text", "category_slug")


def _mapping(spark, d):
    part = table(spark, d, "part")
    candidates = part.select(F.col("p_partkey").alias("candidate_id"), F.col("p_size").alias("review_id"), F.col("p_type").alias("product_id"))
    members = part.filter("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("candidate_id"), F.concat(F.lit("c"), (F.col("p_partkey") % 50).cast("string")).alias("cluster_id"), F.col("p_retailprice").alias("center_similarity"))
    clusters = spark.range(40).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("cluster_id"), F.concat(F.lit("t"), (F.col("id") % 8).cast("string")).alias("taxonomy_id"))
    themes = spark.range(8).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("taxonomy_id"), F.concat(F.lit("Theme "), F.col("id").cast("string")).alias("theme_name"))
    return candidates, members, clusters, themes


@query(
    f"""SELECT p_partkey AS candidate_id, CASE WHEN p_partkey % 4 <> 0 THEN 'c' || p_partkey % 50 END AS cluster_id, CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 50 < 40 THEN 't' || (p_partkey % 50) % 8 END AS taxonomy_id,
    CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 50 < 40 THEN 'Theme ' || (p_partkey % 50) % 8 END AS canonical_theme_name, CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS center_similarity,
    CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 50 < 40 THEN '{MAPPED}' ELSE 'unmapped' END AS mapping_status FROM part"""
)
def mapping_join(spark, d):
    return taxonomy.map_candidates(*_mapping(spark, d)).select("candidate_id", "cluster_id", "taxonomy_id", "canonical_theme_name", "center_similarity", "mapping_status")


def _decisions(spark, d):
    """Decisions of a reviewer about clusters, some of them wrong."""
    part = table(spark, d, "part")
    clusters = part.select(F.col("p_partkey").cast("string").alias("cluster_id"), F.col("p_type").alias("category"), F.col("p_size").cast("long").alias("review_count"), (F.col("p_partkey") % 3 + 1).alias("product_count"))
    named = clusters.filter("cast(cluster_id as long) % 10 <> 0").withColumn("name", F.concat(F.lit("Theme "), (F.col("cluster_id").cast("long") % 4).cast("string")))
    extra = named.filter("cast(cluster_id as long) % 25 = 1")
    strange = named.filter("cast(cluster_id as long) % 25 = 2").withColumn("cluster_id", F.concat(F.lit("x"), "cluster_id"))
    every = named.unionByName(extra).unionByName(strange)
    grouped = every.groupBy("category", "name").agg(F.sort_array(F.collect_list("cluster_id")).alias("member_cluster_ids"))
    decisions = grouped.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("name", F.lit("d").alias("definition"), "member_cluster_ids"))).alias("themes"))
    return decisions, clusters


DECISIONS = """
WITH clusters AS (SELECT CAST(p_partkey AS VARCHAR) AS cluster_id, p_partkey AS k, p_type AS category, CAST(p_size AS BIGINT) AS review_count, p_partkey % 3 + 1 AS product_count FROM part),
named AS (SELECT category, cluster_id, 'Theme ' || k % 4 AS name FROM clusters WHERE k % 10 <> 0 UNION ALL SELECT category, cluster_id, 'Theme ' || k % 4 FROM clusters WHERE k % 10 <> 0 AND k % 25 = 1
  UNION ALL SELECT category, 'x' || cluster_id, 'Theme ' || k % 4 FROM clusters WHERE k % 10 <> 0 AND k % 25 = 2)
"""


@query(
    f"""{DECISIONS} SELECT 'unknown_cluster' AS error, category, cluster_id FROM named WHERE cluster_id LIKE 'x%' UNION ALL SELECT 'duplicate_cluster', category, cluster_id FROM named GROUP BY category, cluster_id HAVING count(*) > 1
    UNION ALL SELECT 'missing_cluster', category, cluster_id FROM clusters c WHERE NOT EXISTS (SELECT 1 FROM named n WHERE n.cluster_id = c.cluster_id)"""
)
def decision_validation(spark, d):
    return taxonomy.decision_errors(*_decisions(spark, d))


@query(
    f"""{DECISIONS} SELECT n.category, left(sha256(n.category || '|' || lower(name)), 24) AS taxonomy_id, min(name) AS theme_name, count(*) AS cluster_count, sum(review_count)::BIGINT AS review_count, sum(product_count)::BIGINT AS product_count
    FROM named n JOIN clusters c ON n.cluster_id = c.cluster_id GROUP BY n.category, lower(name)"""
)
def taxonomy_expand(spark, d):
    return taxonomy.taxonomy(*_decisions(spark, d))[0]


@query(
    f"""{DECISIONS}, u AS (SELECT DISTINCT category, name FROM named), l AS (SELECT category, name, row_number() OVER (PARTITION BY category ORDER BY name) - 1 AS n FROM u)
    SELECT l.category, CASE WHEN n < 2 THEN 'First half' ELSE 'Second half' END AS theme_name, count(*) AS clusters, left(sha256(l.category || '|' || lower(CASE WHEN n < 2 THEN 'First half' ELSE 'Second half' END)), 24) AS taxonomy_id
    FROM l JOIN named m ON m.category = l.category AND m.name = l.name GROUP BY l.category, 2"""
)
def global_taxonomy(spark, d):
    catalog = taxonomy.local_catalog(_decisions(spark, d)[0].withColumn("block_id", F.lit(0)))
    half = F.when(F.substring_index("local_theme_id", ":", -1).cast("int") < 2, "First half").otherwise("Second half")
    decisions = catalog.withColumn("theme_name", half).groupBy("category", "theme_name").agg(F.collect_list("local_theme_id").alias("local_theme_ids"))
    return taxonomy.expand_global(catalog, decisions).groupBy("category", "theme_name", "taxonomy_id").agg(F.count("*").alias("clusters"))


@query(
    """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings) SELECT a.label, count(*) AS pairs FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.25 GROUP BY a.label"""
)
def pair_similarity(spark, d):
    return vectors.similar_pairs(table(spark, d, "embeddings"), "vec_id", "embedding", ["label"], 0.25).groupBy("label").agg(F.count("*").alias("pairs"))


@query(
    """WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS p, unnest(embedding)::DOUBLE AS v FROM embeddings), m AS (SELECT label, p, avg(v) AS a FROM x GROUP BY label, p), n AS (SELECT label, sqrt(sum(a * a)) AS l FROM m GROUP BY label)
    SELECT m.label, CAST(m.p AS INT) AS pos, round(a / l, 6) AS value FROM m JOIN n ON m.label = n.label"""
)
def centroids(spark, d):
    return vectors.centroids(table(spark, d, "embeddings"), ["label"], "embedding").select("label", F.posexplode("centroid").alias("pos", "value")).select("label", (F.col("pos") + 1).alias("pos"), F.round("value", 6).alias("value"))


@query(
    """WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS p, unnest(embedding)::DOUBLE AS v FROM embeddings), m AS (SELECT label, p, avg(v) AS a FROM x GROUP BY label, p), c AS (SELECT label, list(a ORDER BY p) AS c FROM m GROUP BY label),
    s AS (SELECT e.label, vec_id, list_cosine_similarity(embedding::DOUBLE[], c) AS similarity FROM embeddings e JOIN c ON e.label = c.label), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS rank FROM s)
    SELECT label, vec_id, round(similarity, 6) AS similarity, rank FROM r WHERE rank <= 5"""
)
def nearest_to_centroid(spark, d):
    return vectors.nearest_to_centroid(table(spark, d, "embeddings"), "vec_id", "embedding", ["label"], 5).withColumn("similarity", F.round("similarity", 6))


@query()
def communities(spark, d):
    return vectors.communities(table(spark, d, "embeddings"), "vec_id", "embedding", ["label"], 0.25, 3).select("label", "cluster_id", "vec_id", F.round("center_similarity", 6).alias("center_similarity"))


@query()
def kmeans_blocks(spark, d):
    return vectors.kmeans_blocks(table(spark, d, "embeddings"), "vec_id", "embedding").select("vec_id", "block", "position")


@query(
    """WITH m AS (SELECT p_type AS cluster_id, p_brand AS topic_raw, p_partkey AS review_id, p_size AS product_id, p_retailprice AS s FROM part), t AS (SELECT cluster_id, topic_raw, count(*) AS n, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, topic_raw) AS rank FROM m GROUP BY cluster_id, topic_raw),
    j AS (SELECT cluster_id, string_agg(topic_raw || ':' || n, ',' ORDER BY rank) AS topics FROM t WHERE rank <= 4 GROUP BY cluster_id)
    SELECT m.cluster_id, count(*) AS member_count, count(DISTINCT review_id) AS review_count, count(DISTINCT product_id) AS product_count, min(s) AS minimum_center_similarity, topics FROM m JOIN j ON m.cluster_id = j.cluster_id GROUP BY m.cluster_id, topics"""
)
def cluster_summary(spark, d):
    part = table(spark, d, "part").select(F.col("p_type").alias("cluster_id"), F.col("p_brand").alias("topic_raw"), F.col("p_partkey").alias("review_id"), F.col("p_size").alias("product_id"), F.col("p_retailprice").alias("center_similarity"))
    out = vectors.cluster_summary(part, 4)
    return out.select("cluster_id", "member_count", "review_count", "product_count", "minimum_center_similarity", F.array_join(F.transform("top_topic_raw", lambda x: F.concat(x["topic_raw"], F.lit(":"), x["count"].cast("string"))), ",").alias("topics"))


@query(
    """WITH m AS (SELECT p_type, p_size, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_type, p_size ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) SELECT p_type, p_size, p_partkey, p_retailprice FROM m WHERE n = 1"""
)
def cluster_members(spark, d):
    return vectors.best_member_per(table(spark, d, "part").select("p_type", "p_size", "p_partkey", "p_retailprice"), "p_type", "p_size", "p_retailprice", "p_partkey")


@query(
    """WITH r AS (SELECT p_type, p_size, count(DISTINCT p_partkey) AS support FROM part GROUP BY ALL), n AS (SELECT p_type, count(DISTINCT p_partkey) AS reviews FROM part GROUP BY p_type)
    SELECT r.p_type, p_size AS attribute, support FROM r JOIN n ON r.p_type = n.p_type WHERE support >= greatest(3, ceil(reviews * 0.02))"""
)
def attribute_support(spark, d):
    items = table(spark, d, "part").select("p_type", F.col("p_partkey").alias("review_id"), F.array("p_size").alias("attributes"))
    return vectors.attribute_support(items, "p_type", share=0.02).select("p_type", "attribute", "support")


@query(
    """WITH w AS (SELECT l_orderkey % 500 AS s, l_linenumber + 10 * l_partkey AS window_index, l_discount AS e, l_tax AS n, l_quantity / 500 AS c FROM lineitem), m AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY e - greatest(n, c) DESC, window_index) AS r FROM w)
    SELECT s, window_index, e - greatest(n, c) AS margin, e > n AND e > c AS entailed FROM m WHERE r = 1"""
)
def best_window(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") % 500).alias("s"), (F.col("l_linenumber") + 10 * F.col("l_partkey")).alias("window_index"), F.col("l_discount").alias("entailment"), F.col("l_tax").alias("neutral"), (F.col("l_quantity") / 500).alias("contradiction"))
    out = vectors.best_window(rows, "s", strict=True)
    return out.select("s", "window_index", "margin", scalars.entails(F.col("entailment"), F.col("neutral"), F.col("contradiction")).alias("entailed"))


@query("SELECT page_id, CASE WHEN length(regexp_replace(split_part(url, ',', 1), '^\\s+|\\s+$', '', 'g')) > 30 THEN rtrim(left(url, 30)) || '…' ELSE url END AS short FROM pages")
def short_titles(spark, d):
    return table(spark, d, "pages").select("page_id", scalars.short_title(F.col("url"), 30).alias("short"))
