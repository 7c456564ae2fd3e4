import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylens.functions import scalars
from quarrylens.operators import quality, repository, scope, taxonomy, trends, vectors
from quarrylens.sources import readers, writers
from quarrylens.streaming import trend


def test_mapping_and_errors(spark):
    candidates = spark.createDataFrame([("a", "r1", "p"), ("b", "r2", "p")], "candidate_id string, review_id string, product_id string")
    members = spark.createDataFrame([("a", "c1", 0.9, "r1", "p")], "candidate_id string, cluster_id string, center_similarity double, review_id string, product_id string")
    clusters = spark.createDataFrame([("c1", "t1")], "cluster_id string, taxonomy_id string")
    themes = spark.createDataFrame([("t1", "Noise")], "taxonomy_id string, theme_name string")
    got = {r.candidate_id: (r.mapping_status, r.canonical_theme_name) for r in taxonomy.map_candidates(candidates, members, clusters, themes).collect()}
    assert got == {"a": ("mapped_by_cluster", "Noise"), "b": ("unmapped", None)}
    assert {r.candidate_id: r.mapping_status for r in taxonomy.map_candidates(candidates, members, clusters, themes, small=0).collect()} == {"a": "mapped_by_cluster", "b": "unmapped"}
    bad = members.union(spark.createDataFrame([("z", "c1", 0.1, "r", "p"), ("a", "c2", 0.2, "r1", "other")], members.schema))
    assert sorted((r.error, r.candidate_id) for r in taxonomy.mapping_errors(candidates, bad).collect()) == [("duplicate_member", "a"), ("identity_mismatch", "a"), ("orphan_member", "z")]


def test_decisions(spark):
    clusters = spark.createDataFrame([("c1", "ice", 3, 1), ("c2", "ice", 4, 2), ("c3", "ice", 1, 1), ("d1", "dry", 9, 1)], "cluster_id string, category string, review_count long, product_count long")
    make = lambda themes: spark.createDataFrame([("ice", themes)], "category string, themes array<struct<name:string,definition:string,member_cluster_ids:array<string>>>")
    good = make([("Noise", "d", ["c1", "c2"]), ("Size", "d", ["c3"])])
    assert taxonomy.decision_errors(good, clusters).count() == 0
    sizes, cluster_map = taxonomy.taxonomy(good, clusters)
    assert {r.theme_name: (r.cluster_count, r.review_count) for r in sizes.collect()} == {"Noise": (2, 7), "Size": (1, 1)} and cluster_map.count() == 3
    bad = make([(" ", "d", ["c1", "c1"]), ("Size", "d", ["d1", "nope"])])
    found = {(r.error, r.cluster_id) for r in taxonomy.decision_errors(bad, clusters).collect()}
    assert found == {("empty_name", "c1"), ("duplicate_cluster", "c1"), ("category_mismatch", "d1"), ("unknown_cluster", "nope"), ("missing_cluster", "c2"), ("missing_cluster", "c3")}


def test_category_rules(spark):
    cases = [(["Appliances", "Ice Makers"], "included"), (["Ice Makers", "Parts & Accessories"], "excluded"), (["Appliances"], "review"), ([], "review"), (None, "review"), ([" ", "Dryers "], "included"), (["Replacement Dryers", "Dryers"], "excluded")]
    df = spark.createDataFrame([(k, c) for k, (c, _) in enumerate(cases)], "k int, c array<string>")
    assert [r.s.state for r in df.select("k", scope.classify_category(F.col("c")).alias("s")).orderBy("k").collect()] == [s for _, s in cases]
    assert scope.product_group(["Appliances", "Ice  Makers", "ICE MAKERS"], None) == ("ice-makers", "Ice Makers", 2)
    assert scope.product_group(["Appliances", "Parts & Accessories"], "x") is None and scope.product_group([], "Café Ranges") == ("cafe-ranges", "Café Ranges", 1) and scope.product_group(None, None) is None


def test_group_selection(spark):
    rows = [("ice-makers", "Ice Makers", 9000, 50, 0.9, 100, 0.95, 3), ("mini-ice-makers", "Mini Ice Makers", 9500, 50, 0.9, 100, 0.95, 3), ("dryers", "Dryers", 6000, 20, 0.8, 90, 0.9, 2), ("x", "Glass", 10, 1, None, 1, 0.1, 1)]
    df = spark.createDataFrame(rows, "group_id string, name string, review_count long, product_count long, eligible_text_rate double, active_months long, metadata_identifiability double, category_depth int")
    got = {r.group_id: r for r in scope.select_groups(df).collect()}
    assert {k: r.selection_state for k, r in got.items()} == {"ice-makers": "candidate", "mini-ice-makers": "selected", "dryers": "selected", "x": "rejected"}
    assert got["x"].rejection_reasons == ["reviews_below_5000", "products_below_10", "eligible_text_rate_below_0.70", "active_months_below_12", "metadata_identifiability_below_0.80", "category_depth_below_2"]
    assert got["x"].semantic_family == "glass" and got["dryers"].semantic_family == "dryer"


def test_group_profile(spark):
    products = spark.createDataFrame([("p1", "T", None, ["Appliances", "Ice Makers"], None), ("p1", None, None, ["Appliances", "Ice Makers"], None), ("p2", None, None, ["Dryers"], None), (None, "T", None, ["Dryers"], None)], "parent_asin string, title string, store string, categories array<string>, main_category string")
    reviews = spark.createDataFrame([("r1", "p1", "2020-01", True), ("r2", "p1", "2020-02", False), ("r3", "p1", "2020-02", None)], "review_id string, parent_asin string, review_month string, eligible_nlp boolean")
    got = {r.group_id: r for r in scope.group_profile(products, reviews).collect()}
    assert (got["ice-makers"].review_count, got["ice-makers"].eligible_text_count, got["ice-makers"].active_months, got["ice-makers"].metadata_identifiability) == (3, 1, 2, 1.0)
    assert (got["dryers"].review_count, got["dryers"].eligible_text_rate, got["dryers"].metadata_identifiability) == (0, 0.0, 0.0)


def test_checks_collect_before_they_fail(spark):
    df = spark.createDataFrame([(1, 0.5, "a"), (1, 1.5, "b")], "id int, ratio double, kind string")
    checks, written = quality.Checks(), []
    checks.unique("key", df, "id")
    checks.within("ratio", df, "ratio", 0, 1)
    checks.among("kind", df, "kind", "a", "b")
    checks.conserved("rows", 5, 3, 2)
    checks.references("parent", df, df, "id")
    with pytest.raises(ValueError):
        checks.finish(written.append)
    assert written == [{"status": "failed", "checks": {"key": 1, "ratio": 1, "kind": 0, "rows": 0, "parent": 0}}]


def test_replay(spark):
    schema = "id string, text string, batch string, m map<string,string>"
    a = spark.createDataFrame([("a", "original", "one", {"b": "2", "a": "1"}), ("b", "x", "one", None)], schema)
    same = spark.createDataFrame([("a", "original", "two", {"a": "1", "b": "2"}), ("b", "x", "two", None)], schema)
    changed = spark.createDataFrame([("a", "other", "two", {"a": "1", "b": "2"}), ("c", "x", "two", None)], schema)
    assert quality.replay_differences(a, same, "id", ("batch",)).count() == 0 and quality.replay_differences(a, same, "id").count() == 2
    assert sorted((r.id, r.difference) for r in quality.replay_differences(a, changed, "id", ("batch",)).collect()) == [("a", "changed"), ("b", "missing"), ("c", "added")]
    assert quality.symmetric_difference(a, same).count() == 4 and quality.fingerprint(a, "id").first() == quality.fingerprint(a.orderBy(F.desc("id")), "id").first()


def test_spans_profile_and_groups(spark):
    df = spark.createDataFrame([("hello", 1, 3, "el"), ("hello", 1, 3, "xx"), ("hello", 4, 9, "o"), (None, 0, 1, "h")], "t string, a int, b int, p string")
    assert quality.span_violations(df, "t", "a", "b", "p").count() == 3
    assert [r["column"] for r in quality.column_profile(df, ["t", "a"]).collect()] == ["t", "a"]
    with pytest.raises(ValueError):
        quality.group_profile(df, "a", "p", most=2)


def test_communities_are_the_greedy_ones(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 8))
    x = np.concatenate([c + rng.normal(size=(n, 8)) * 0.15 for c, n in zip(centres, (12, 9, 5, 3, 1), strict=True)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    want, taken = [], set()
    for members in sorted((tuple(np.flatnonzero(r)) for r in near if r.sum() >= 3), key=lambda m: (-len(m), m)):
        free = [m for m in members if m not in taken]
        if len(free) >= 3:
            want.append(free)
            taken.update(free)
    assert [m.tolist() for m in vectors.greedy_communities(unit, 0.9, 3, block=7)] == want
    df = spark.createDataFrame([("c", i, int(i % 4 == 0), r.tolist()) for i, r in enumerate(x)], "g string, id int, review int, v array<double>")
    got = vectors.communities(df, "id", "v", ["g"], 0.9, 3).collect()
    assert sorted(sorted(r.id for r in got if r.cluster_id == c) for c in {r.cluster_id for r in got}) == sorted(sorted(int(i) for i in m) for m in want)
    assert vectors.communities(df, "id", "v", ["g"], 0.9, 3, "review").count() == 0
    blocks = vectors.kmeans_blocks(df, "id", "v", 10).collect()
    assert sorted(r.id for r in blocks) == list(range(len(x)))


def test_bio_and_windows():
    spans = [(0, 2), (3, 5), (6, 8), (9, 11)]
    assert vectors.decode_bio(["B-x", "I-x", "O", "I-y"], [1.0, 0.5, 0.9, 0.4], spans) == [(0, 5, "x", 0.75), (9, 11, "y", 0.4)]


def test_percentiles_alerts_and_scalars(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 11)], "v int")
    assert df.agg(*trends.nearest_rank("v", 0.5, 0.95)).first()[:] == (5, 10) and df.agg(trends.floor_percentile("v", 0.95)).first()[0] == 9
    one = spark.range(1)
    pick = lambda c: one.select(c).first()[0]
    assert pick(scalars.tfidf(F.lit(8), F.lit(10), F.lit(100))) == pytest.approx(8 * (np.log(101 / 11) + 1))
    assert [pick(scalars.sentiment_label(F.lit(x))) for x in (0.05, 0.0499, -0.0499, -0.05)] == ["positive", "neutral", "neutral", "negative"]
    assert pick(scalars.slug(F.lit("  --Ä b!c "))) == "b-c" and pick(scalars.slug(F.lit("!!"))) == "unknown" and pick(scalars.nfc(F.lit("é"))) == "é"
    assert pick(scalars.short_title(F.lit("x" * 70 + ", y"))) == "x" * 58 + "…" and pick(scalars.phrase(F.lit("…a b. "), 1)) == "…a"
    assert pick(scalars.iso_utc(F.lit(1500))) == "1970-01-01T00:00:01.500000+00:00" and pick(scalars.month_index(F.lit("20x0-01"))) is None
    series = spark.createDataFrame([("a", p, 9 if p > 9 else 1, 20) for p in range(13)], "k string, p int, n int, total int")
    assert trends.rate_alerts(series, ["k"], "p", "n", "total").first().alert is True


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1}\n\n{"id": 2}\n')
    assert readers.read_ndjson(spark, str(tmp_path), "id int", "*.jsonl", strict=True).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.read_ndjson(spark, str(tmp_path), "id int", "*.none")
    p.write_text('{"id": 1}\n[]\n')
    with pytest.raises(Exception, match="not a JSON object"):
        readers.read_ndjson(spark, str(tmp_path), "id int", "*.jsonl", strict=True).collect()
    (tmp_path / "m.json").write_bytes(b"\xef\xbb\xbf" + json.dumps({"x": 1}).encode())
    assert readers.read_manifest(str(tmp_path / "m.json")) == {"x": 1} and readers.unique_file(str(tmp_path), "m.json").endswith("m.json")
    df = readers.synthetic(spark, 20)
    back = writers.round_trip(df, str(tmp_path / "t"))
    assert quality.symmetric_difference(df, back).count() == 0
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_parquet(df, str(tmp_path / "t"))
    assert writers.write_review_csv(df.select("id", "text"), str(tmp_path / "r.csv")) == 20 and (tmp_path / "r.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    with pytest.raises(ValueError):
        writers.write_review_csv(df.select("id"), str(tmp_path / "r2.csv"), most=5)
    writers.write_shards(df.select("id"), str(tmp_path / "s"), "id", 3)
    writers.write_by(df.select("id", "verified"), str(tmp_path / "b"), "verified", 4)
    assert spark.read.json(str(tmp_path / "s")).count() == spark.read.json(str(tmp_path / "b")).count() == 20
    writers.write_sorted(df.select("id"), str(tmp_path / "o"), "id")
    work = spark.range(5).select(F.col("id").cast("string").alias("k"))
    step = lambda rows: rows.withColumn("status", F.when(F.col("k") == "3", "failed").otherwise("ok"))
    assert writers.append_new(str(tmp_path / "done"), work, "k", step) == 5 and writers.append_new(str(tmp_path / "done"), work, "k", step) == 0 and writers.append_new(str(tmp_path / "done"), work, "k", step, "ok") == 1

    def broken(folder):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        writers.publish(str(tmp_path / "pub"), broken)
    assert not (tmp_path / "pub").exists() and not (tmp_path / "pub.tmp").exists()
    log = [{"Event": "SparkListenerExecutorAdded", "Executor ID": "1"}, {"Event": "SparkListenerExecutorAdded", "Executor ID": "2"}, {"Event": "SparkListenerTaskEnd", "Task Info": {"Executor ID": "1", "Failed": False}, "Task Metrics": {"Peak Execution Memory": 5, "Disk Bytes Spilled": 2}}, {"Event": "SparkListenerTaskEnd", "Task Info": {"Executor ID": "1", "Failed": True}, "Task Metrics": {"Peak Execution Memory": 9, "Disk Bytes Spilled": 1}}, {"Event": "SparkListenerStageCompleted", "Stage Info": {"Failure Reason": "x"}}]
    events = spark.createDataFrame([(json.dumps(e),) for e in log], "value string")
    assert readers.summarize_event_log(events).first().asDict() == {"executors_added": 2, "executors_removed": 0, "tasks": 2, "failed_tasks": 1, "failed_stages": 1, "executors_used": 1, "peak_execution_memory": 9, "disk_bytes_spilled": 3}


def test_repository(spark):
    products = spark.createDataFrame([(1, "Quiet Ice", "ice", 10, "ready"), (2, "Dryer", "dry", 20, "ready")], "product_id long, title string, category string, review_count long, analysis_status string")
    themes = spark.createDataFrame([("1::n::negative", 1, "n", "Noise", "negative", 4, 0.4), ("1::s::negative", 1, "s", "Size", "negative", 5, 0.5), ("1::s::positive", 1, "s", "Size", "positive", 2, 0.2)], "theme_id string, product_id long, taxonomy_id string, name string, sentiment string, review_count long, ratio_value double")
    items = spark.createDataFrame([("i1", 1, "n", 3), ("i2", 1, "q", 1)], "input_id string, product_id long, taxonomy_id string, support_review_count long")
    overlay = spark.createDataFrame([(1, "n", "positive"), (1, "s", "positive"), (1, "z", "odd"), (None, "n", "positive")], "product_id long, taxonomy_id string, to_sentiment string")
    series = spark.createDataFrame([(1, "n", "negative", "2020-02", 1, 2, 0.5), (1, "n", "negative", "2020-01", 1, 4, 0.25)], "product_id long, taxonomy_id string, sentiment string, review_month string, review_count long, eligible_review_count long, ratio_value double")
    evidence = spark.createDataFrame([(1, "n", "negative", f"r{i}", None if i == 2 else f"2020-0{i}") for i in range(1, 4)], "product_id long, taxonomy_id string, sentiment string, review_id string, review_month string")
    repo = repository.InsightRepository(products, products, themes, series, evidence, items, overlay, {"status": "ready", "batch_id": "b"})
    assert repo.categories() == ["dry", "ice"] and repo.search("ICE")["page"]["total"] == 1 and repo.search(size=1)["page"]["pages"] == 2 and repo.search("%")["data"] == []
    assert [t["theme_id"] for t in repo.themes_of(1, "positive")] == ["1::n::negative", "1::s::positive"] and repo.themes_of(1, "negative") == [] and repo.themes_of(9, "positive") is None
    assert [i["input_id"] for i in repo.improvements_of(1)] == ["i2"]
    assert {f["facet"]: f["theme_count"] for f in repo.overview(1)["facets"]} == {"positive_evaluation": 2, "negative_evaluation": 0, "improvement": 1} and repo.overview(9) is None
    assert [p["review_month"] for p in repo.theme("1::n::negative")["trend"]] == ["2020-01", "2020-02"] and repo.theme("none") is None
    assert [e["review_id"] for e in repo.evidence_of(1, "n", "negative")] == ["r3", "r1", "r2"] and repo.health()["products"] == 2
    with pytest.raises(ValueError):
        repository.InsightRepository(products, products, themes, series, evidence, items, overlay, {"status": "failed"})


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = trend.read_event_stream(spark, str(tmp_path / "in"), events.schema)
    trend.start(trend.event_rates(stream, late="40 days"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    batch = {(r.window_start, r.event_type): r.events for r in trend.event_rates(events).collect()}
    got = {(r.window_start, r.event_type): r.events for r in spark.read.schema(trend.event_rates(events).schema).parquet(str(tmp_path / "out")).collect()}
    assert got.items() <= batch.items()


def test_random_rank_is_stable(spark):
    clusters = spark.createDataFrame([("c", i, random.Random(i).choice([1, 1, 3])) for i in range(40)], "c string, id int, n int")
    a, b = (sorted((r.stratum, r.rank, r.id) for r in trends.audit_strata(clusters.repartition(k), "c", "id", "n", 5, 7).collect()) for k in (1, 3))
    assert a == b
