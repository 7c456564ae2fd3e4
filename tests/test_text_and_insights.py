import json

import pytest
from pyspark.sql import functions as F

from quarrylens.operators import improve, insights, text

REVIEW = "It's  well-made and “quiet”. It's small."


def test_text_features(spark):
    df = spark.createDataFrame([("It's well-made.\nWorks 24/7! 😊",), (None,), ("?!.. \n\n",)], "t string")
    a, b, c = text.text_features(df, "t").collect()
    assert (a.word_count, a.sentence_count, a.line_count, a.alphabetic_count) == (4, 2, 2, 16)
    assert (b.char_count, b.word_count, b.sentence_count, b.line_count) == (0, 0, 0, 0)
    assert (c.sentence_count, c.line_count) == (0, 1)


@pytest.mark.parametrize(
    "t,label,p,status",
    [("Good product", "__label__en", 0.9, "accepted"), ("Good product", "__label__en", 0.79, "low_confidence"), ("ok", "__label__en", 0.9, "too_short"), ("Buen producto", "__label__es", 0.9, "non_english"), ("123 !", "__label__en", 0.9, "non_linguistic"),
     ("Good product", "en", 0.9, "invalid_prediction"), ("Good product", "__label__en", 1.2, "invalid_prediction"), ("Good product", None, None, "invalid_prediction"), ("", "__label__en", 0.9, "empty"), (None, None, None, "empty")],
)
def test_language_states(spark, t, label, p, status):
    df = text.text_features(spark.createDataFrame([(t, label, p)], "t string, l string, p double"), "t")
    r = text.admit_language(df, "t", F.col("l"), F.col("p")).first()
    assert r.language_status == status and r.eligible_nlp == (status == "accepted")
    assert (r.language_confidence is not None) == (status in ("accepted", "low_confidence", "non_english"))
    assert r.nlp_exclusion_reasons == ([] if status == "accepted" else [("text:" if status in ("empty", "too_short", "non_linguistic") else "language:") + status])


def test_predictor_sees_only_texts_with_letters(spark):
    df = text.text_features(spark.createDataFrame([(1, "Hello\nworld"), (2, "ab"), (3, None)], "id int, t string"), "t")

    def load():
        return lambda lines: [("__label__en", 0.5 + 0.1 * (line == "Hello world")) for line in lines]

    got = {r.id: (r["__label"], r["__probability"]) for r in text.predict_language(df, "t", load).collect()}
    assert got == {1: ("__label__en", 0.6), 2: (None, None), 3: (None, None)}


def test_sentences_and_chunks(spark):
    t = 'One two. "Three four!" (Five.) six? seven Eight.  Nine'
    spans = text.sentence_spans(t)
    assert [t[a:b] for a, b in spans] == ["One two.", '"Three four!"', "(Five.) six? seven Eight.", "Nine"]
    assert text.sentence_spans("  ") == [] and text.pack_sentences([3, 3, 9, 1, 1], 6) == [(0, 2), (2, 3), (3, 5)]
    with pytest.raises(ValueError):
        text.pack_sentences([1], 0)
    df = spark.createDataFrame([("r", t), ("s", None)], "id string, t string")
    rows = text.chunks(df, "id", "t", 4).collect()
    assert [(r.chunk_id, r.sentence_start_index, r.sentence_end_index, r.word_count, r.oversize_sentence) for r in rows] == [("r:c0000", 0, 1, 4, False), ("r:c0001", 2, 2, 4, False), ("r:c0002", 3, 3, 1, False)]
    assert all(t[r.char_start : r.char_end] == r.sentence_text for r in text.sentences(df, "id", "t").collect())


def test_terms_and_demands(spark):
    df = spark.createDataFrame([("Filter leaks badly; filter leaks.",), ("I wish the cord were longer.",), ("The renewed unit works.",), (None,)], "t string")
    terms = [r.x for r in df.select(text.document_terms(F.col("t")).alias("x")).collect()]
    assert terms[0] == ["filter", "leaks", "badly", "filter leaks", "leaks badly", "badly filter"] and terms[3] == []
    assert [r.t for r in text.demand_candidates(df, "t").collect()] == ["I wish the cord were longer."]


def item(**kw):
    return dict(topic_raw=" Noise ", polarity="positive", evidence="well-made", target_scope="current_product") | kw


@pytest.mark.parametrize(
    "evidence,span",
    [("well-made", (6, 15)), ("It's well-made", (0, 15)), ('"quiet"', (20, 27)), ("“quiet”.", (20, 28)), ("It's", None), ("absent", None), (" \n", None)],
)
def test_grounding(evidence, span):
    if span is None:
        with pytest.raises(insights.Rejected):
            insights.ground(REVIEW, evidence)
    else:
        assert insights.ground(REVIEW, evidence) == span


def test_overlapping_matches_count(spark):
    with pytest.raises(insights.Rejected):
        insights.ground("aaa", "aa")


def test_statuses(spark):
    cases = [[item()], [item(), item(polarity="angry")], [item(topic_raw=" ")], [], [item(), item(topic_raw="NOISE"), item(topic_raw="noise", target_scope="unclear")], [item(extra=1)], ["x"], [item(evidence=None)]]
    got = [insights.accept(REVIEW, json.dumps({"insights": c})) for c in cases]
    assert [g["processing_status"] for g in got] == ["success", "partial_success", "failed", "success_no_insight", "success", "failed", "failed", "failed"]
    assert len(got[4]["insights"]) == 2 and got[0]["insights"][0]["topic_raw"] == "Noise"
    for bad in (None, "", "[]", '{"insights": 1}', '{"insights": [], "x": 1}'):
        assert insights.accept(REVIEW, bad)["processing_status"] == "failed"


def test_candidates_and_counters(spark):
    df = spark.createDataFrame([("r1", "p1", REVIEW, json.dumps({"insights": [item(), item(evidence="small", target_scope="unclear"), item(evidence="quiet", polarity="neutral")]})), ("r2", "zz", REVIEW, json.dumps({"insights": [item()]}))], "review_id string, product_id string, t string, r string")
    records = insights.validate_responses(df, "review_id", "t", "r").join(df.select("review_id", "product_id"), "review_id")
    products = spark.createDataFrame([("p1", "T", "Ice Makers & Co")], "product_id string, title string, category string")
    (c,) = insights.candidates(records, products, polarities=("positive", "negative")).collect()
    assert c.category_slug == "ice-makers-co" and len(c.candidate_id) == 24 and c.candidate_text == "Noise: well-made"
    counts = insights.candidate_counters(records, products, polarities=("positive", "negative")).first()
    assert counts.asDict() == {"insights": 4, "other_scope": 1, "other_polarity": 1, "unknown_product": 1, "candidates": 1}


def test_improvement_groups_chunks_and_generation(spark):
    rows = [("n2", "r2", "p1", "t1", "negative"), ("n1", "r1", "p1", "t1", "negative"), ("m1", "r1", "p1", "t1", "mixed"), ("x", "r3", "p1", "t1", "positive"), ("m2", "r4", "p1", "t2", "mixed")]
    df = spark.createDataFrame([(*r, "mapped_by_cluster", "three word quote", "Theme") for r in rows] + [("u", "r9", "p1", "t3", "negative", "unmapped", "q", "T")], "candidate_id string, review_id string, product_id string, taxonomy_id string, polarity string, mapping_status string, evidence string, theme_name string")
    groups = improve.improvement_groups(df)
    (g,) = groups.collect()
    assert (g.negative_insight_count, g.mixed_insight_count, g.support_insight_count, g.support_review_count) == (2, 1, 3, 2)
    assert [i.candidate_id for i in g.insights] == ["n1", "n2", "m1"]
    assert [c.candidate_ids for c in improve.insight_chunks(groups, 6).orderBy("chunk_index").collect()] == [["n1", "n2"], ["m1"]]
    assert [c.candidate_ids for c in improve.insight_chunks(groups, 1).orderBy("chunk_index").collect()] == [["n1"], ["n2"], ["m1"]]
    work = spark.createDataFrame([("a", "fine"), ("b", "boom"), ("c", "")], "input_id string, prompt string")
    done = spark.createDataFrame([("a", "success")], "input_id string, generation_status string")

    def generator(prompt):
        if prompt == "boom":
            raise RuntimeError("no model")
        return prompt

    got = {r.input_id: (r.generation_status, r.error_message) for r in improve.generate(work, done, generator).collect()}
    assert got == {"b": ("failed", "no model"), "c": ("failed", "empty response")}
