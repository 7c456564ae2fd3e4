"""Queries over joins, sets, windows and aggregates on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrylens.functions.scalars import canonical_map, month_index, percent, sha256, slug, squeeze
from quarrylens.operators import duplicates, quality, trends
from quarrylens.plans import surrogate as s
from quarrylens.plans.registry import query, table

# A dimension whose keys are ambiguous, missing or unmatched: parts by brand for suppliers' numbers.
DIMENSION = "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 50 ELSE p_partkey END AS k FROM part"


@query(
    f"""WITH dim AS ({DIMENSION}), keys AS (SELECT k, count(*) AS n, min(id) AS id FROM dim GROUP BY k),
    facts AS (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey END AS k FROM supplier)
    SELECT f.s_suppkey, f.k, n AS metadata_key_count, CASE WHEN n = 1 THEN id END AS id_joined,
           CASE WHEN f.k IS NULL THEN 'missing_parent' WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS metadata_join_status
    FROM facts f LEFT JOIN keys d ON f.k = d.k"""
)
def safe_dimension_join(spark, d):
    dim = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey") % 50).otherwise(F.col("p_partkey")).alias("k"))
    facts = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 7 != 0, F.col("s_suppkey")).alias("k"))
    return duplicates.safe_dimension_join(facts, dim, "k", "id").select("s_suppkey", "k", "metadata_key_count", "id_joined", "metadata_join_status")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def orphan_anti(spark, d):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders").filter("o_orderstatus = 'P'")
    return customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "left_anti").select("c_custkey", "c_name")


@query("SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0)")
def eligible_semi(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").filter("quality = 0"), "doc_id", "left_semi")


@query(
    """WITH a AS (SELECT n_regionkey AS r, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'f' || n_nationkey % 3 END AS facet, count(*) AS n FROM nation GROUP BY ALL),
    b AS (SELECT n_regionkey AS r, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'f' || n_nationkey % 3 END AS facet, sum(n_nationkey)::BIGINT AS m FROM nation GROUP BY ALL)
    SELECT a.r, a.facet, n, m, n IS DISTINCT FROM m AS differs FROM a JOIN b ON a.r = b.r AND a.facet IS NOT DISTINCT FROM b.facet"""
)
def null_safe_facet_join(spark, d):
    facet = F.when(F.col("n_nationkey") % 4 != 0, F.concat(F.lit("f"), (F.col("n_nationkey") % 3).cast("string")))
    base = table(spark, d, "nation").select(F.col("n_regionkey").alias("r"), facet.alias("facet"), "n_nationkey")
    a = base.groupBy("r", "facet").agg(F.count("*").alias("n")).alias("a")
    b = base.groupBy("r", "facet").agg(F.sum("n_nationkey").alias("m")).alias("b")
    return a.join(b, (F.col("a.r") == F.col("b.r")) & F.col("a.facet").eqNullSafe(F.col("b.facet"))).select("a.r", "a.facet", "n", "m", (~F.col("n").eqNullSafe(F.col("m"))).alias("differs"))


@query(
    """WITH a AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_suppkey % 3 <> 0), b AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_suppkey % 3 <> 1)
    (SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT *, 'right' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))"""
)
def symmetric_diff(spark, d):
    lines = table(spark, d, "lineitem")
    cut = lambda r: lines.filter(F.col("l_suppkey") % 3 != r).select("l_orderkey", "l_partkey", "l_quantity")
    return quality.symmetric_difference(cut(0), cut(1))


@query(
    """WITH d AS (SELECT DISTINCT user_id, CAST(date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS BIGINT) AS p FROM events),
    g AS (SELECT user_id, p - lag(p) OVER (PARTITION BY user_id ORDER BY p) - 1 AS gap FROM d)
    SELECT user_id, coalesce(max(gap), 0) AS longest_gap, count(*) AS active FROM g GROUP BY user_id"""
)
def longest_gap(spark, d):
    return trends.longest_gap(table(spark, d, "events"), "user_id", F.datediff(F.to_date("ts"), F.lit("2000-01-01").cast("date")))


@query("SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def topk_per_group(spark, d):
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return table(spark, d, "orders").withColumn("rank", rank).filter("rank <= 3").select("o_custkey", "o_orderkey", "o_totalprice", "rank")


@query("SELECT o_custkey, o_orderpriority, max(o_totalprice) AS best, arg_max(o_orderkey, o_totalprice) AS o_orderkey FROM orders GROUP BY o_custkey, o_orderpriority")
def best_member(spark, d):
    """Of orders with the same best price, that with the smallest key; SQL's arg_max takes the first it meets.

    As in SQL, a row without key or price is no best one."""
    known = F.col("o_totalprice").isNotNull() & F.col("o_orderkey").isNotNull()
    place = F.when(known, F.struct("o_totalprice", F.bitwise_not("o_orderkey")))
    return table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.max("o_totalprice").alias("best"), F.max_by("o_orderkey", place).alias("o_orderkey"))


@query()
def hash_sample(spark, d):
    return trends.hash_sample(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 100)


@query(
    """WITH c AS (SELECT o_orderpriority AS category, o_custkey AS id, count(*) AS n FROM orders GROUP BY ALL),
    m AS (SELECT *, 'merged' AS stratum, row_number() OVER (PARTITION BY category ORDER BY n DESC, id) AS rank FROM c WHERE n > 1),
    f AS (SELECT *, 'singleton_first' AS stratum, row_number() OVER (PARTITION BY category ORDER BY id) AS rank FROM c WHERE n = 1),
    r AS (SELECT *, 'singleton_random' AS stratum, row_number() OVER (PARTITION BY category ORDER BY sha256('7|' || id)) AS rank FROM c WHERE n = 1)
    SELECT * FROM (SELECT * FROM m UNION ALL SELECT * FROM f UNION ALL SELECT * FROM r) WHERE rank <= 5"""
)
def stratified_audit(spark, d):
    clusters = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("category"), F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    return trends.audit_strata(clusters, "category", "id", "n", 5, 7)


@query(
    """SELECT o_orderpriority, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_totalprice > 100000) AS large,
    sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS open, avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P') IS NULL AS no_partial FROM orders GROUP BY o_orderpriority"""
)
def filtered_counts(spark, d):
    status = lambda x: F.col("o_orderstatus") == x
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), F.count_if(status("F")).alias("finished"), F.count_if(F.col("o_totalprice") > 100000).alias("large"),
        F.sum(status("O").cast("long")).alias("open"), F.avg(F.when(status("P"), F.col("o_totalprice"))).isNull().alias("no_partial"),
    )


@query("SELECT l_returnflag, count(*) AS n, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) FILTER (WHERE l_linestatus = 'O') AS open_suppliers, count(*) - count(DISTINCT l_orderkey) AS extra FROM lineitem GROUP BY l_returnflag")
def multi_distinct(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"),
        F.countDistinct(F.when(F.col("l_linestatus") == "O", F.col("l_suppkey"))).alias("open_suppliers"), (F.count("*") - F.countDistinct("l_orderkey")).alias("extra"),
    )


@query(
    """WITH g AS (SELECT n_regionkey, n_nationkey % 2 AS half, list(n_name) AS names FROM nation GROUP BY ALL)
    SELECT n_regionkey, array_to_string(list_sort(list_distinct(flatten(list(names)))), ',') AS names, list_contains(flatten(list(names)), 'FRANCE') AS has_france FROM g GROUP BY n_regionkey"""
)
def list_agg_sorted(spark, d):
    lists = table(spark, d, "nation").groupBy("n_regionkey", (F.col("n_nationkey") % 2).alias("half")).agg(F.collect_list("n_name").alias("names"))
    every = F.flatten(F.collect_list("names"))
    return lists.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.array_distinct(every)), ",").alias("names"), F.array_contains(every, "FRANCE").alias("has_france"))


@query("SELECT l_returnflag, quantile_disc(l_quantity, 0.5) AS p50, quantile_disc(l_quantity, 0.9) AS p90, quantile_disc(l_quantity, 0.95) AS p95, quantile_disc(l_quantity, 0.99) AS p99 FROM lineitem GROUP BY l_returnflag")
def percentiles_exact(spark, d):
    return trends.exact_percentiles(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", [0.5, 0.9, 0.95, 0.99])


@query("SELECT source, list_extract(list_sort(list(n_chars)), CAST(floor((count(*) - 1) * 0.95) AS BIGINT) + 1) AS p95 FROM documents GROUP BY source")
def percentile_floor(spark, d):
    return trends.exact_percentiles(table(spark, d, "documents"), ["source"], "n_chars", [0.95], floor=True)


@query("SELECT lang, source, n, rank FROM (SELECT lang, source, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source) AS rank FROM documents GROUP BY lang, source) WHERE rank <= 3")
def topn_values(spark, d):
    return trends.top_values(table(spark, d, "documents"), ["lang"], "source", 3)


@query(f"{s.CTE} SELECT lower(polarity) AS polarity, count(*) AS total, count(*) FILTER (WHERE mapping_status <> 'unmapped') AS mapped, count(*) FILTER (WHERE mapping_status = 'unmapped') AS unmapped, round(count(*) FILTER (WHERE mapping_status <> 'unmapped') / CAST(count(*) AS DOUBLE) * 100, 2) AS coverage_pct FROM insights GROUP BY lower(polarity)")
def coverage_pct(spark, d):
    from quarrylens.operators.taxonomy import mapping_coverage

    return mapping_coverage(s.insights(spark, d).withColumn("polarity", F.lower("polarity")), "polarity")


@query("SELECT t.t AS threshold, count(*) AS rows, count(*) FILTER (WHERE n_chars >= t.t) AS above, count(*) FILTER (WHERE n_chars >= t.t) / CAST(count(*) AS DOUBLE) AS share FROM documents, (VALUES (20.0::DOUBLE), (500.0::DOUBLE), (2000.0::DOUBLE), (100000.0::DOUBLE)) t(t) GROUP BY t.t")
def threshold_coverage(spark, d):
    return trends.threshold_coverage(table(spark, d, "documents"), "n_chars", [20, 500, 2000, 100000])


@query("SELECT n AS group_size, count(*) AS groups FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY n")
def histogram_of_counts(spark, d):
    return trends.count_histogram(table(spark, d, "orders"), "o_custkey")


@query()
def fingerprint(spark, d):
    return quality.fingerprint(table(spark, d, "orders"), "o_orderkey")


@query("SELECT c AS \"column\", rows, filled, dist AS \"distinct\", filled / CAST(rows AS DOUBLE) AS fill_ratio FROM (SELECT count(*) AS rows, unnest([{'c': 'quality', 'filled': count(quality), 'dist': count(DISTINCT quality)}, {'c': 'lang', 'filled': count(lang), 'dist': count(DISTINCT lang)}], recursive := true) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
def column_profile(spark, d):
    return quality.column_profile(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), ["quality", "lang"])


@query(
    """SELECT 'price_positive' AS rule, count(*) AS rows, count(*) FILTER (WHERE NOT coalesce(o_totalprice > 50000, false)) AS violations FROM orders
    UNION ALL SELECT 'status_known', count(*), count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), false)) FROM orders
    UNION ALL SELECT 'ratio_range', count(*), count(*) FILTER (WHERE NOT coalesce(o_totalprice / 200000 BETWEEN 0 AND 1, false)) FROM orders"""
)
def dq_rules(spark, d):
    rules = {"price_positive": F.col("o_totalprice") > 50000, "status_known": F.col("o_orderstatus").isin("F", "O"), "ratio_range": (F.col("o_totalprice") / 200000).between(0, 1)}
    return quality.rule_counts(table(spark, d, "orders"), rules)


@query(
    """SELECT 'orders_key' AS name, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'line_key', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1))
    UNION ALL SELECT 'line_order', (SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))
    UNION ALL SELECT 'label_document', (SELECT count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents x WHERE x.doc_id = l.doc_id))
    UNION ALL SELECT 'discount_range', (SELECT count(*) FROM lineitem WHERE NOT l_discount BETWEEN 0 AND 0.05)
    UNION ALL SELECT 'flag_known', (SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))"""
)
def dq_report(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    checks = quality.Checks()
    checks.unique("orders_key", orders, "o_orderkey")
    checks.unique("line_key", lines, "l_orderkey", "l_linenumber")
    checks.references("line_order", lines.withColumnRenamed("l_orderkey", "o_orderkey"), orders, "o_orderkey")
    checks.references("label_document", table(spark, d, "labels"), table(spark, d, "documents"), "doc_id")
    checks.within("discount_range", lines, "l_discount", 0, 0.05)
    checks.among("flag_known", lines, "l_returnflag", "A", "N")
    return spark.createDataFrame(list(checks.found.items()), "name string, violations long")


@query(
    """WITH a AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 11 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 7 <> 0)
    SELECT a.o_orderkey, 'missing' AS difference FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.o_orderkey = b.o_orderkey)
    UNION ALL SELECT b.o_orderkey, 'added' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.o_orderkey = b.o_orderkey)
    UNION ALL SELECT a.o_orderkey, 'changed' FROM a JOIN b ON a.o_orderkey = b.o_orderkey AND a.o_totalprice IS DISTINCT FROM b.o_totalprice"""
)
def replay_compare(spark, d):
    orders = table(spark, d, "orders")
    first = orders.filter("o_orderkey % 11 <> 0").select("o_orderkey", "o_totalprice", F.lit("run-a").alias("run"))
    again = orders.filter("o_orderkey % 7 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"), F.lit("run-b").alias("run"))
    return quality.replay_differences(first, again, "o_orderkey", without=("run",))


@query(
    """SELECT 'missing_key' AS error, NULL AS key FROM orders WHERE o_orderkey % 101 = 0 UNION ALL
    SELECT 'duplicate_key', CAST(k AS VARCHAR) FROM (SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey // 2 END AS k FROM orders) GROUP BY k HAVING count(*) > 1 UNION ALL
    SELECT 'not_triggered', CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey // 2 END AS VARCHAR) FROM orders WHERE NOT o_totalprice > 20000"""
)
def admission_errors(spark, d):
    rows = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 101 != 0, F.expr("o_orderkey div 2")).alias("k"), "o_totalprice")
    return quality.admission_errors(rows, "k", F.col("o_totalprice") > 20000)


@query("SELECT p_partkey, left(sha256(CAST(p_partkey AS VARCHAR) || '|' || p_name || '|' || p_brand), 24) AS candidate_id, md5(p_type || '|' || p_brand) AS evidence_id, CASE WHEN trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-') = '' THEN 'unknown' ELSE left(trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-'), 80) END AS slug, trim(regexp_replace('  ' || p_name || '  x ', '\\s+', ' ', 'g')) AS squeezed FROM part")
def identity_keys(spark, d):
    part = table(spark, d, "part")
    return part.select(
        "p_partkey", sha256("p_partkey", "p_name", "p_brand", length=24).alias("candidate_id"), F.md5(F.concat("p_type", F.lit("|"), "p_brand").cast("binary")).alias("evidence_id"),
        slug(F.col("p_brand")).alias("slug"), squeeze(F.concat(F.lit("  "), "p_name", F.lit("  x "))).alias("squeezed"),
    )


@query("SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INT) AS month_index, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 2) AS finished_pct FROM orders GROUP BY 1")
def month_numbers(spark, d):
    orders = table(spark, d, "orders").withColumn("month_index", month_index(F.date_format("o_orderdate", "yyyy-MM")))
    return orders.groupBy("month_index").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), percent(F.count_if(F.col("o_orderstatus") == "F"), F.count("*")).alias("finished_pct"))


@query("SELECT count(*) AS rows, count(DISTINCT k) AS maps FROM (SELECT list_sort([{'k': event_type, 'v': user_id % 3}, {'k': 'a', 'v': 1}])::VARCHAR AS k FROM events)")
def canonical_maps(spark, d):
    made = F.create_map(F.col("event_type"), F.col("user_id") % 3, F.lit("a"), F.lit(1).cast("long"))
    return table(spark, d, "events").select(canonical_map(made).alias("k")).agg(F.count("*").alias("rows"), F.countDistinct("k").alias("maps"))


@query(
    """WITH e AS (SELECT user_id % 10 AS u, event_type AS t, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS p FROM events),
    t AS (SELECT u, p, count(*) AS total FROM e GROUP BY u, p), x AS (SELECT e.u, e.t, e.p, count(*) AS n, any_value(total) AS total FROM e JOIN t ON e.u = t.u AND e.p = t.p GROUP BY e.u, e.t, e.p),
    l AS (SELECT max(p) AS last FROM x),
    a AS (SELECT u, t, coalesce(sum(n) FILTER (WHERE last - p < 3), 0)::BIGINT AS recent_count, coalesce(sum(total) FILTER (WHERE last - p < 3), 0)::BIGINT AS recent_total,
          coalesce(sum(n) FILTER (WHERE last - p >= 3 AND last - p < 15), 0)::BIGINT AS baseline_count, coalesce(sum(total) FILTER (WHERE last - p >= 3 AND last - p < 15), 0)::BIGINT AS baseline_total FROM x, l GROUP BY u, t)
    SELECT *, recent_count / CAST(nullif(recent_total, 0) AS DOUBLE) AS recent_rate, baseline_count / CAST(nullif(baseline_total, 0) AS DOUBLE) AS baseline_rate,
      coalesce(recent_total >= 30 AND baseline_total >= 30 AND recent_count / CAST(nullif(recent_total, 0) AS DOUBLE) - baseline_count / CAST(nullif(baseline_total, 0) AS DOUBLE) >= 0.02, false) AS alert FROM a"""
)
def rate_alert(spark, d):
    events = table(spark, d, "events").select((F.col("user_id") % 10).alias("u"), F.col("event_type").alias("t"), F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("long").alias("p"))
    totals = events.groupBy("u", "p").agg(F.count("*").alias("total"))
    series = events.groupBy("u", "t", "p").agg(F.count("*").alias("n")).join(totals, ["u", "p"])
    return trends.rate_alerts(series, ["u", "t"], "p", "n", "total", rise=0.02)


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_rates(spark, d):
    from quarrylens.streaming.trend import event_rates as rates

    out = rates(table(spark, d, "events"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", F.round("total", 4).alias("total"))
