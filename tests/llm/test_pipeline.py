"""The stages one by one over a small folder, and over awkward rows."""

import corpus_pipeline
import pytest
from llm.samples import awkward, empty
from llm.test_jaccard import brute as near_classes
from llm.test_pii import brute as base_spans
from pyspark.sql import functions as F

from wardwatch.llm import langid, quality
from wardwatch.llm.common import fold
from wardwatch.session import scratch_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the stages and after each."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_stages_keep_the_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    for docs in steps[1:-1]:
        assert docs.dtypes == steps[0].dtypes


def test_language_stage(spark, steps):
    before, after = texts(steps[0]), texts(steps[1])
    model = langid.train(steps[0].where(fold("doc_id", 5) != 0))
    judged = langid.identify(steps[0], model).collect()
    kept = {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= corpus_pipeline.LANGUAGE}
    assert set(after) == kept and all(before[k] == t for k, t in after.items())


def test_quality_stage(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.train(steps[1], labels.where(fold("doc_id", 4) != 2))
    judged = quality.score(steps[1], model).collect()
    kept = {r.doc_id for r in judged if r.score >= corpus_pipeline.QUALITY}
    assert set(texts(steps[2])) == kept
    marks = {r.doc_id: r.quality for r in labels.collect()}
    seen = [(marks[k], k in kept) for k in texts(steps[1]) if k in marks]
    assert sum(bool(mark) == stays for mark, stays in seen) / len(seen) > 0.9


def test_near_duplicate_stage(steps):
    rows = list(texts(steps[2]).items())
    kept = {own for own, least, _ in near_classes(rows) if own == least}
    assert {str(k) for k in texts(steps[3])} == kept


def test_personal_data_stage(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert set(before) == set(after)
    for doc, text in after.items():
        assert not base_spans(text) or base_spans(before[doc])
        if not base_spans(before[doc]):
            assert text == before[doc]
    assert steps[4].where(F.length("text") != F.col("n_chars")).isEmpty()


def test_packing_stage(steps):
    pieces = steps[5].collect()
    assert {p.doc_id for p in pieces} == set(texts(steps[4]))
    filled = {}
    for piece in pieces:
        filled[piece.sequence_id] = filled.get(piece.sequence_id, 0) + piece.length
        assert len(piece.ids) == 4 * piece.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in filled.values())


@pytest.mark.parametrize("number", range(5))
def test_awkward_rows(spark, number):
    _, stage = corpus_pipeline.STAGES[number]
    docs = awkward(spark)
    out = stage(spark, docs, FOLDER)
    if number < 4:
        assert out.columns == docs.columns
    assert out.count() <= 3 * docs.count() or number == 4
    assert stage(spark, empty(spark), FOLDER).count() == 0


def test_quality_stage_decides_as_the_query(spark, monkeypatch):
    """Documents that op6_quality rejects do not go on."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(4)], "doc_id long, text string")
    scores = F.element_at(F.array(*map(F.lit, (0.4, 0.6, 0.69, 0.7))), F.col("doc_id").cast("int") + 1)
    monkeypatch.setattr(corpus_pipeline.quality, "train", lambda *a, **b: None)
    monkeypatch.setattr(
        corpus_pipeline.quality, "score", lambda docs, model, name: docs.withColumn(name, scores)
    )
    kept = corpus_pipeline.good(spark, docs, "/root/testdata/sf0.001")
    assert [r.doc_id for r in kept.collect()] == [3]
