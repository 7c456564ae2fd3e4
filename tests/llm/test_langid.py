import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylens.llm import langid
from quarrylens.llm.queries import QUERIES


def test_folded_logits_are_the_models(spark):
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b"], rng.normal(size=(1 << langid.BITS, 2)).astype(np.float32), np.array([0.1, -0.2]))
    texts = ["", "x", "ab", "abc", "Héllo wörld, 12 times", "z" * 5000, "", "日本"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    got = langid.logits(model, np.frombuffer(b"".join(raw), np.uint8), offsets)
    for r, row in zip(raw, got, strict=True):
        rows, share = langid.features(np.frombuffer(r, np.uint8))
        want = share.astype(float) @ model.table[rows] + model.bias if len(rows) else model.bias
        assert np.allclose(row, want, atol=1e-4)


@pytest.fixture(scope="module")
def model(spark, sf):
    return langid.train(spark.read.parquet(f"{sf}/documents.parquet"))


def test_defined_results(spark, model):
    rows = [(1, None, "q"), (2, "", "q"), (3, "123 !?", "q"), (None, "the thing and the other", "q"), (4, "l'été " * 9000, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    for i in (1, 2, 3):
        assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
    assert got[None].lang_pred == "en" and got[None].accepted and 0 < got[None].score <= 1
    assert got[4].lang_pred == "fr"
    assert langid.predict(df.limit(0), model).collect() == []
    none = langid.train(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string"))
    assert none is None and {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}


def test_foreign_text_is_rejected_more_than_known(spark, model):
    df = spark.createDataFrame([(1, "xq zzkw vvxj qqpl wwxz jjkq")], "doc_id long, text string")
    assert langid.predict(df, model).first().score < 0.95


FOREIGN = [
    "Il gatto dorme sul divano mentre la pioggia cade lentamente sulla citta e i bambini giocano",
    "Kissa nukkuu sohvalla kun sade putoaa hiljaa kaupungin ylle ja lapset leikkivat kotona",
    "Kot spi na kanapie podczas gdy deszcz pada powoli na miasto a dzieci bawia sie w domu",
    "Kedi kanepede uyurken yagmur yavasca sehrin uzerine yagiyor ve cocuklar evde oynuyor",
]


@pytest.mark.parametrize("languages", [["de", "en", "es", "fr"], ["en", "fr"]])
def test_foreign_and_random_text_is_rejected_and_clean_text_kept(spark, sf, languages):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("lang").isin(languages) & F.col("text").rlike("\\p{L}"))
    model = langid.train(docs)
    rng = np.random.default_rng(1)
    random = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(20)) for _ in range(100)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(FOREIGN + random)], "doc_id long, text string")
    got = {r.doc_id: r.accepted for r in langid.predict(df, model).collect()}
    assert not any(got[i] for i in range(len(FOREIGN)))
    assert np.mean([got[i] for i in range(len(FOREIGN), len(got))]) <= 0.02
    assert np.mean([r.accepted for r in langid.predict(docs, model).select("accepted").collect()]) > 0.98


def test_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in QUERIES["op1_language_id"](spark, sf).collect()]
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out and truth[r.doc_id] is not None and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.accepted for r in got if r.lang_pred != "und"]) > 0.98
