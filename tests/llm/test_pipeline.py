import brute
import pytest

import corpus_pipeline
from wattloom.llm import common, pii


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[:-1])


def test_toxic_documents_go(spark, sf_dir, stages):
    labels = {r["doc_id"]: r["toxic"] for r in common.table(spark, sf_dir, "labels").collect()}
    before, after = texts(stages[0]), texts(stages[1])
    clean = [d for d in before if labels.get(d) == 0]
    assert sum(d in after for d in clean) >= 0.98 * len(clean)
    assert len(after) < len(before)


def test_one_of_each_group_stays(stages):
    expected = {d for d, _, c in brute.simhash_groups(texts(stages[1]).items()) if d == c}
    assert set(texts(stages[2])) == expected


def test_benchmark_documents_go(spark, sf_dir, stages):
    items = [(r["item_id"], r["text"]) for r in common.table(spark, sf_dir, "benchmark").collect()]
    report = brute.decontaminated(texts(stages[2]).items(), items)
    assert set(texts(stages[3])) == {d for d, _, hit, _ in report if hit == 0}


def test_no_personal_data_is_left(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for doc, text in before.items():
        assert brute.personal(after[doc]) == []
        if not brute.personal(text) and not pii.candidate_spans(text, []):
            assert after[doc] == text
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_every_id_is_packed_once(stages):
    pieces = stages[5].collect()
    assert {r["doc_id"] for r in pieces} == set(texts(stages[4]))
    tokens = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert sum(r["length"] for r in pieces) == sum(tokens.values())


def test_odd_rows(spark, sf_dir):
    rows = [(None, None, None, None, None, 1), (900_001, "", "en", "s", 0, 1), (900_001, "", "en", "s", 0, 1), (900_002, "Word " * 40_000, "en", None, 3, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _score int")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), "odd")
    assert {r["doc_id"] for r in docs.collect()} == {900_001, 900_002}
    empty = spark.createDataFrame([], docs.sparkSession.read.parquet(f"{sf_dir}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = common.staged(stage(spark, empty, sf_dir), "empty")
    assert empty.count() == 0
