import base64
import gzip
import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylens import config
from quarrylens.functions import scalars
from quarrylens.operators import improve, insights, prompts, trends, vectors
from quarrylens.operators.repository import InsightRepository, error_envelope
from quarrylens.sources import readers, writers


def test_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"release": "r", "run_id": "x", "scope": {"minimum_reviews": 5, "categories": ["A"]}}))
    c = config.load_config(str(p))
    assert c.scope.minimum_reviews == 5 and c.scope.categories == ("A",) and c.alerts.recent == 3
    p.write_text(json.dumps({"release": "r", "run_id": "x", "scope": {"wrong": 5}}))
    with pytest.raises(ValueError, match="wrong"):
        config.load_config(str(p))


def test_replies(spark):
    assert prompts.check_reply('{"a": " x "}', "a") == ("x", None)
    for bad in (None, "", "[]", '{"a": ""}', '{"a": 1}', '{"a": "x", "b": 1}'):
        assert prompts.check_reply(bad, "a")[0] is None
    got = prompts.checked_replies(spark.createDataFrame([(1, '{"a": "x"}'), (2, None)], "id int, r string"), "id", "r", "a").collect()
    assert {r.id: r.a for r in got} == {1: "x", 2: None}


def test_retries(spark, tmp_path):
    flag = str(tmp_path / "flag")

    def flaky(prompt):
        import os

        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("once")
        return prompt

    work = spark.createDataFrame([("a", "fine")], "input_id string, prompt string").coalesce(1)
    done = spark.createDataFrame([], "input_id string, generation_status string")
    assert improve.generate(work, done, flaky, retries=1).first().generation_status == "success"


def test_prompt_of_a_group(spark):
    df = spark.createDataFrame([("Noise", [("negative", "loud"), ("mixed", "ok")])], "name string, insights array<struct<polarity:string,evidence:string>>")
    assert df.select(prompts.improvement_prompt()).first()[0] == "Theme: Noise\n- [negative] loud\n- [mixed] ok"


def test_published_folder(spark, tmp_path):
    products = spark.createDataFrame([("p", "T", "c", 3, "ready")], "product_id string, title string, category string, review_count long, analysis_status string")
    themes = spark.createDataFrame([("t", "p", "n", "Noise", "negative", 2, 0.5)], "theme_id string, product_id string, taxonomy_id string, name string, sentiment string, review_count long, ratio_value double")
    for name, df in (("products", products), ("product_facets", products), ("themes", themes), ("theme_timeseries", themes), ("theme_reviews", themes)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    (tmp_path / "o.json").write_text(json.dumps({"corrections": [{"product_id": "p", "taxonomy_id": "n", "to_sentiment": "positive"}, {"product_id": "p"}]}))
    (tmp_path / "i.ndjson").write_text("\n".join(json.dumps(r) for r in [dict(input_id="i", product_id="p", taxonomy_id="q", generation_status="success", support_review_count=1), dict(input_id="j", product_id="p", taxonomy_id=" ", generation_status="success"), dict(input_id="k", product_id="p", taxonomy_id="q", generation_status="failed")]))
    args = (str(tmp_path), str(tmp_path / "o.json"), str(tmp_path / "i.ndjson"), "input_id string, product_id string, taxonomy_id string, generation_status string, support_review_count long")
    with pytest.raises(FileNotFoundError):
        InsightRepository.open(spark, *args)
    (tmp_path / "validation.json").write_text(json.dumps({"status": "ready"}))
    repo = InsightRepository.open(spark, *args)
    assert [t["theme_id"] for t in repo.themes_of("p", "positive")] == ["t"] and [i["input_id"] for i in repo.improvements_of("p")] == ["i"]
    assert error_envelope("not_found", "x")["error"]["code"] == "not_found"


def test_compact_clusters(spark):
    df = spark.createDataFrame([("c", "cat", 1, 1, [("a", 2), (" ", 1), (None, 4)]), ("d", "cat", 1, 1, None)], "cluster_id string, category string, review_count long, product_count long, top_topic_raw array<struct<topic_raw:string,count:bigint>>")
    assert {r.cluster_id: r.topics for r in prompts.compact_clusters(df).collect()} == {"c": ["a (2)"], "d": []}
    assert prompts.packets(df).select(F.size(F.split("packet", "\n"))).first()[0] == 2


def test_columns_and_vectors(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 2.0], "b")], "id int, v array<double>, text_normalized string")
    df.write.parquet(str(tmp_path / "v"))
    assert readers.read_vectors(spark, str(tmp_path / "v"), "id", "v", 2).count() == 1
    with pytest.raises(Exception, match="components"):
        readers.read_vectors(spark, str(tmp_path / "v"), "id", "v", 3).collect()
    assert df.select(readers.first_available(df, "text_raw", "text_normalized", "text")).first()[0] == "b"
    with pytest.raises(ValueError, match="none of"):
        readers.first_available(df, "x")
    with pytest.raises(ValueError, match="missing columns"):
        readers.require_columns(df, {"id", "y"})
    assert readers.require_columns(df, {"id"}) is df
    writers.write_csv(df.select("id"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().id == "1"
    writers.write_sidecar(str(tmp_path / "s.json"), {"a": 1})
    assert json.loads((tmp_path / "s.json").read_text()) == {"a": 1}
    writers.publish(str(tmp_path / "p"), lambda folder: writers.write_sidecar(f"{folder}/x.json", {}))
    assert (tmp_path / "p" / "x.json").exists()
    with pytest.raises(FileExistsError):
        writers.publish(str(tmp_path / "p"), lambda folder: None)


def test_theme_clusters_keep_empty_facets(spark):
    rows = [("p", "positive", i, f"r{i}", [1.0, 0.01 * i]) for i in range(4)] + [("p", "negative", 9, "r9", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "product_id string, facet string, item_id int, review_id string, v array<double>")
    got = {r.facet: (r.theme_count, r.status) for r in vectors.theme_clusters(df, "v", 0.9, 3).collect()}
    assert got == {"positive": (1, "ready"), "negative": (0, "empty"), "improvement": (0, "empty")}


def test_representative_text_and_encoder(spark):
    df = spark.createDataFrame([(1, "Noise", ["noise", "Size", "size", "Speed"], "it hums")], "id int, c string, t array<string>, e string")
    assert df.select(vectors.representative_text(F.col("c"), F.col("t"), F.col("e"), 3)).first()[0] == "Noise; Size | it hums"
    made = vectors.encode(df, "id", "c", lambda: lambda texts: np.array([[3.0, 4.0]] * len(texts))).first()
    assert made.embedding == pytest.approx([0.6, 0.8])


def test_titles_and_maps(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c).first()[0]
    assert pick(scalars.theme_title(F.lit("negative"), F.lit("Noise"))) == "Concern: Noise" and pick(scalars.keyed(F.lit(1), F.lit(None).cast("string"))) is None
    assert pick(scalars.entails(F.lit(0.5), F.lit(0.5), F.lit(0.1))) is False and pick(scalars.ascii_fold(F.lit("Café"))) == "Cafe"
    assert pick(scalars.canonical_map(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))))[0].key == "a"
    with pytest.raises(Exception, match="out of range"):
        pick(scalars.sentiment_label(F.lit(1.5)))


def test_only_a_line_feed_ends_a_line(spark, tmp_path):
    data = b'{"a":1}\n{"a":"x\ry"}\r\n\xff\r\n{"b":2}'
    (tmp_path / "f.jsonl.gz").write_bytes(gzip.compress(data))
    (tmp_path / "g.jsonl").write_bytes(data + b"\n")
    want = [(1, '{"a":1}'), (2, '{"a":"x\ry"}\r'), (3, None), (4, '{"b":2}')]
    own = sorted(readers.read_envelopes(spark, str(tmp_path / "f.jsonl.gz")).collect(), key=lambda r: r.source_line_number)
    assert [(r.source_line_number, r.raw_json) for r in own] == want and base64.b64decode(own[2].raw_bytes_base64) == b"\xff\r"
    many = readers.read_many_envelopes(spark, str(tmp_path / "*.json*")).collect()
    for name in ("f.jsonl.gz", "g.jsonl"):
        rows = sorted((r for r in many if r.source_file == name), key=lambda r: r.source_line_number)
        assert [(r.source_line_number, r.raw_json) for r in rows] == want


def test_blocks_of_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "f.jsonl.gz").write_bytes(gzip.compress(b"".join(b"%d\n" % i for i in range(25))) + gzip.compress(b"x"))
    monkeypatch.setattr(readers, "LINES", 10)
    rows = readers.read_many_envelopes(spark, str(tmp_path / "f.jsonl.gz")).collect()
    assert sorted((r.source_line_number, r.raw_json) for r in rows) == [(i + 1, str(i)) for i in range(25)] + [(26, "x")]


def test_as_many_shards_as_asked(spark, tmp_path):
    writers.write_shards(spark.range(2000), str(tmp_path / "s"), "id", 16)
    files = list((tmp_path / "s").glob("part-*.json"))
    assert len(files) == 16
    for f in files:
        ids = [json.loads(x)["id"] for x in f.read_text().splitlines()]
        assert ids and ids == sorted(ids)


def test_publish_and_resume_by_a_store_path(spark, tmp_path):
    folder = f"file://{tmp_path}/pub"
    writers.publish(folder, lambda at: spark.range(3).write.parquet(f"{at}/rows"))
    assert spark.read.parquet(f"{folder}/rows").count() == 3 and not (tmp_path / "pub.tmp").exists()
    with pytest.raises(FileExistsError):
        writers.publish(folder, lambda at: None)
    with pytest.raises(ZeroDivisionError):
        writers.publish(f"file://{tmp_path}/other", lambda at: 1 / 0)
    assert not (tmp_path / "other").exists() and not (tmp_path / "other.tmp").exists()
    work = spark.range(5).withColumnRenamed("id", "k")
    done = f"file://{tmp_path}/done"
    assert writers.append_new(done, work.limit(2), "k", lambda df: df) == 2
    assert writers.append_new(done, work, "k", lambda df: df) == 3 and writers.append_new(done, work, "k", lambda df: df) == 0


def test_rounding_and_timestamps(spark):
    numbers = [0.125, 0.375, 2.675, 1234567.885, -0.125, 1e9 + 0.005, 0.0]
    df = spark.createDataFrame([(x,) for x in [*numbers, None]], "x double")
    assert [r.y for r in df.select(scalars.round_even(F.col("x")).alias("y")).collect()] == [*(round(x, 2) for x in numbers), None]
    stamps = spark.createDataFrame([("2024-02-29T12:00:00Z",), ("2024-02-29T12:00:00+02:00",), ("2024-02-30T12:00:00Z",), (None,)], "t string")
    got = [r.s for r in stamps.select(F.unix_timestamp(scalars.timestamp(F.col("t"))).alias("s")).collect()]
    assert got == [1709208000, 1709200800, None, None]


def test_generation_by_size(spark, tmp_path):
    item = lambda k, words: (0, str(k), f"r{k}", "negative", " ".join([f"w{k}"] * words))
    rows = [("small", "Noise", [item(1, 2), item(2, 2)]), ("large", "Heat", [item(k, 3) for k in range(5)]), ("broken", "Smell", [item(k, 3) if k != 3 else (0, "3", "r3", "negative", "boom x y") for k in range(5)]), ("done", "Old", [item(1, 1)])]
    groups = spark.createDataFrame(rows, "input_id string, name string, insights array<struct<rank:int,candidate_id:string,review_id:string,polarity:string,evidence:string>>").coalesce(1)
    done = spark.createDataFrame([("done", "success")], "input_id string, generation_status string")
    log = tmp_path / "loads"

    def load():
        with open(log, "a") as f:
            f.write("x")

        def model(prompt):
            if "boom" in prompt:
                raise RuntimeError("no model")
            return f"<{prompt.splitlines()[0]}|{prompt.count(chr(10) + '- ')}>"

        return model

    got = {r.input_id: r for r in improve.generate_by_size(groups, done, load, 6, ("DIRECT", "CHUNK", "REDUCE"), retries=1).collect()}
    assert set(got) == {"small", "large", "broken"}
    assert (got["small"].generation_mode, got["small"].improvement_suggestion) == ("direct", "<DIRECT|2>")
    # five insights of three words are three chunks of six words
    assert (got["large"].generation_mode, got["large"].improvement_suggestion) == ("map_reduce", "<REDUCE|3>")
    assert got["broken"].generation_status == "failed" and got["broken"].error_message == "chunk 1: no model" and got["broken"].improvement_suggestion is None
    tries = []
    assert improve._reply(lambda p: tries.append(p) or "bad", "p", 3, lambda text: "not a reply") == (None, "not a reply") and len(tries) == 3
    work = spark.createDataFrame([(str(k), "p") for k in range(50)], "input_id string, prompt string").coalesce(1)
    log.unlink()
    assert improve.generate(work, done, load=load).count() == 50 and log.read_text() == "x"


def test_chunks_of_a_large_group(spark):
    n = 100_000
    size = "cast(1 + k % 3 as int)"
    insights = F.expr(f"transform(sequence(0, {n - 1}), k -> struct(cast(k as string) as candidate_id, {size} as words))")
    groups = spark.range(1).select(F.lit("g").alias("input_id"), F.lit(1).alias("product_id"), F.lit("t").alias("taxonomy_id"), insights.alias("insights"))
    began = time.perf_counter()
    got = improve.insight_chunks(groups, 4, "x.words").orderBy("chunk_index").collect()
    # a pass over the insights takes a second or two, a copy of all chunks for each insight minutes
    assert time.perf_counter() - began < 40
    assert [i for c in got for i in c.candidate_ids] == [str(k) for k in range(n)]
    assert [c.chunk_index for c in got] == list(range(len(got)))
    sums = [sum(1 + int(i) % 3 for i in c.candidate_ids) for c in got]
    assert [c.token_count for c in got] == sums and max(sums) == 4
    assert all(a + 1 + int(c.candidate_ids[0]) % 3 > 4 for a, c in zip(sums, got[1:], strict=False))


def test_chunks_of_odd_groups(spark):
    rows = [("none", None), ("empty", []), ("odd", [("a", 2), ("b", None), ("c", 0), ("d", 9), ("e", 3), ("f", 1)])]
    groups = spark.createDataFrame(rows, "input_id string, insights array<struct<candidate_id: string, words: int>>").withColumns({"product_id": F.lit(1), "taxonomy_id": F.lit("t")})
    got = improve.insight_chunks(groups, 4, "x.words").orderBy("chunk_index").collect()
    assert [(c.input_id, c.chunk_index, c.token_count, c.candidate_ids) for c in got] == [("odd", 0, 2, ["a"]), ("odd", 1, None, ["b"]), ("odd", 2, 0, ["c"]), ("odd", 3, 9, ["d"]), ("odd", 4, 4, ["e", "f"])]


def test_occurrences(spark):
    text = "aXbXc aXb"
    assert insights.occurrences(text, "aXb") == [(0, 3), (6, 9)] and insights.occurrences("aaa", "aa") == [(0, 2), (1, 3)] and insights.occurrences("a", "") == []
    assert insights.ground_at(text, "aXb", 1) == (6, 9) and insights.ground_at(text, "bXc", None) == (2, 5)
    for evidence, n in (("aXb", 2), ("aXb", -1), ("zz", 0), ("aXb", None)):
        with pytest.raises(insights.Rejected):
            insights.ground_at(text, evidence, n)
    df = spark.createDataFrame([("aaa", "aa"), ("abc", "bc"), ("abc", "x"), (None, "x"), ("abc", None), ("", "")], "t string, e string")
    assert insights.ambiguity(df, "t", "e").first().asDict() == {"quotes": 6, "once": 1, "several": 1, "absent": 4, "ambiguity_rate": 1 / 6}
    assert insights.ambiguity(df.limit(0), "t", "e").first().ambiguity_rate is None


def test_exact_percentiles(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(v)) for k, v in zip(rng.integers(0, 3, 500), rng.integers(0, 40, 500), strict=True)] + [(1, None), (9, None), (None, 5)]
    df = spark.createDataFrame(rows, "k int, v int")
    near = {r.k: (r.p0, r.p50, r.p99, r.p100) for r in trends.exact_percentiles(df, ["k"], "v", [0.0, 0.5, 0.99, 1.0]).collect()}
    low = {r.k: (r.p95,) for r in trends.exact_percentiles(df, ["k"], "v", [0.95], floor=True).collect()}
    for k in (0, 1, 2):
        own = sorted(v for j, v in rows if j == k and v is not None)
        assert near[k] == tuple(own[max(1, -int(-len(own) * p // 1)) - 1] for p in (0.0, 0.5, 0.99, 1.0)) and low[k] == (own[int((len(own) - 1) * 0.95)],)
    assert 9 not in near


def test_staging_and_matrices(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert sorted(r.a for r in writers.convert_json(spark, str(tmp_path / "in"), str(tmp_path / "out"), "a long").collect()) == [1, 2]
    (tmp_path / "in" / "b.json").write_text('{"a": "x"}\n')
    with pytest.raises(Exception, match="(?i)malformed|cast|parse"):
        writers.convert_json(spark, str(tmp_path / "in"), str(tmp_path / "out2"), "a long")
    df = spark.createDataFrame([(2, [3.0, 4.0]), (1, [1.0, 2.0])], "id int, v array<double>")
    assert writers.write_npy(df, str(tmp_path / "v.npy"), "id", "v") == (2, 2)
    assert np.load(tmp_path / "v.npy").tolist() == [[1.0, 2.0], [3.0, 4.0]]
    with pytest.raises(ValueError):
        writers.write_npy(df, str(tmp_path / "w.npy"), "id", "v", most=1)
