import zlib

import pytest

import corpus_pipeline
from quarrylens.llm.queries import QUERIES
from quarrylens.llm.storage import written
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_packing import check
from tests.llm.test_substring import brute as passages


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = written(spark.read.parquet(f"{sf}/documents.parquet"))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for df in stages[:-1]:
        assert tuple(df.columns) == corpus_pipeline.COLUMNS


def test_language_keeps_clean_documents(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(after) <= set(before) and len(after) > 0.98 * len(before)
    assert all(any(c.isalpha() for c in t) for t in after.values())


def test_toxicity(spark, sf, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before, after = texts(stages[1]), texts(stages[2])
    toxic = [i for i in before if labels.get(i) == 1]
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i not in after for i in toxic) > 0.6 * len(toxic)
    assert sum(i in after for i in clean) > 0.95 * len(clean)


def test_near_duplicates(stages):
    rows = list(texts(stages[2]).items())
    want = {i for i, _, least in groups(rows, 5, 80, 100) if i == least}
    assert set(texts(stages[3])) == want


def test_passages(stages):
    before, after = texts(stages[3]), texts(stages[4])
    for i, _, gone, kept in passages(list(before.items()), 13):
        assert after[i] == (kept if gone else before[i])
    assert all(r.n_chars == len(r.text or "") for r in stages[4].collect())


def test_packing(stages):
    rows = [r.asDict() | {"ids_crc32": zlib.crc32(r.ids)} for r in stages[5].collect()]
    assert check(rows, texts(stages[4])) > 0.99


def test_run_is_the_stages(spark, sf, stages):
    key = lambda df: sorted((r.doc_id, r.start, r.length, zlib.crc32(r.ids)) for r in df.collect())
    assert sum(x[2] for x in key(corpus_pipeline.run(spark, sf))) == sum(x[2] for x in key(stages[5]))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (2, "12 34", "en", "s", 5)], [(1, "the thing", "en", "s", 9), (None, "la chose", "fr", None, None), (1, "the thing", "en", "s", 9)]])
def test_odd_tables(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({(r.doc_id, r.doc_tokens) for r in out}) <= len(rows)
    for name in ("op1_language_id", "op8_toxicity", "op3_packing", "op5_bpe", "op2_substring_dedup", "op9_ngram_jaccard", "op6_order_minhash", "op10_token_counts"):
        assert QUERIES[name](spark, str(tmp_path)).count() == len(rows)
