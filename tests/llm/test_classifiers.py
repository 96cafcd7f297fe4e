"""The random fields against enumeration, and both classifiers on held-out rows."""

from itertools import product

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm.samples import awkward, empty

from wardwatch.llm import langid, quality
from wardwatch.llm.common import fold
from wardwatch.llm.crf import fit, marginals
from wardwatch.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def enumerated(scores, start, moves):
    """Marginals of one chain by the weights of all its label sequences."""
    places, labels = scores.shape
    out, moved, total = np.zeros_like(scores), np.zeros((labels, labels)), 0.0
    for path in product(range(labels), repeat=places):
        weight = start[path[0]] + scores[range(places), path].sum()
        weight = np.exp(weight + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += weight
        out[range(places), path] += weight
        for a, b in zip(path, path[1:]):
            moved[a, b] += weight
    return out / total, moved / total


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    lengths = [1, 2, 5, 6, 1, 4] * 9  # chains over the edges of blocks
    scores = rng.normal(size=(sum(lengths), 3)) * 3
    start, moves = rng.normal(size=3), rng.normal(size=(3, 3))
    first = np.zeros(len(scores), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    found, moved = marginals(scores, first, start, moves)
    at, total = 0, np.zeros((3, 3))
    for length in lengths:
        truth, own = enumerated(scores[at : at + length], start, moves)
        assert np.allclose(found[at : at + length], truth)
        total += own
        at += length
    assert np.allclose(moved, total)


def test_one_long_chain_equals_the_plain_recursion():
    rng = np.random.default_rng(3)
    scores, moves = rng.normal(size=(700, 2)), rng.normal(size=(2, 2))
    first = np.zeros(700, bool)
    first[0] = True
    found, _ = marginals(scores, first, np.zeros(2), moves)
    ahead, behind = [np.exp(scores[0])], [np.ones(2)]
    for row in scores[1:]:
        new = (ahead[-1] / ahead[-1].sum()) @ np.exp(moves) * np.exp(row)
        ahead.append(new)
    for row in scores[:0:-1]:
        new = np.exp(moves) @ (np.exp(row) * behind[-1])
        behind.append(new / new.sum())
    both = np.array(ahead) * np.array(behind[::-1])
    assert np.allclose(found, both / both.sum(axis=1, keepdims=True))


def test_fit_learns_features_and_moves():
    things = np.array([0, 0, 1, 1, 0, 0, 1, 1] * 20)
    labels = things.copy()
    first = np.zeros(len(things), bool)
    first[::8] = True
    field = fit(np.array([0, 1]), np.array([0, 1, 2]), things, first, labels, 2, 2)
    assert field.weights[0, 0] > field.weights[0, 1]
    assert field.weights[1, 1] > field.weights[1, 0]


def accuracy(sql, rows, columns):
    given = {r[0]: r[1] for r in duckdb.sql(sql).fetchall()}
    pairs = [(given[r.doc_id], r[columns]) for r in rows if r.held_out and r.doc_id in given]
    return sum(a == b for a, b in pairs) / len(pairs)


def test_language_on_held_out_rows(spark):
    rows = QUERIES["op3_langid"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    sql = f"SELECT doc_id, lang FROM '{FOLDER}/documents.parquet' WHERE lang IS NOT NULL"
    assert accuracy(sql, rows, "lang_pred") > 0.97


def test_quality_on_held_out_rows(spark):
    rows = QUERIES["op6_quality"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    sql = f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'"
    assert accuracy(sql, rows, "predicted") > 0.95


@pytest.fixture(scope="module")
def language_model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return langid.train(docs.where(fold("doc_id", 5) != 0))


def test_switched_text_is_labelled_word_by_word(spark, language_model):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").where("lang in ('en', 'fr')")
    texts = {r.lang: r.text for r in rows.orderBy("doc_id").limit(40).collect()}
    mixed = " ".join(texts["en"].split()[:60] + texts["fr"].split()[:60])
    (lang,), (score,) = langid.predict(language_model, pa.array([mixed]))
    assert lang in ("en", "fr") and 0.35 < score < 0.75


def test_language_edge_cases(spark, language_model):
    docs = awkward(spark)
    found = langid.identify(docs, language_model)
    assert found.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for row in rows:
        lettered = row.text is not None and any(c.isalpha() for c in row.text)
        assert (row.lang_pred == "und") == (not lettered) and 0 <= row.score <= 1
        assert (row.score == 0) == (not lettered)
    same = {(r.lang_pred, r.score) for r in rows if r.doc_id == 1}
    assert len(same) == 1
    assert langid.identify(empty(spark), language_model).count() == 0


def test_language_without_labels(spark):
    model = langid.train(awkward(spark))
    assert {(r.lang_pred, r.score) for r in langid.identify(awkward(spark), model).collect()} == {
        ("und", 0.0)
    }
    assert langid.train(empty(spark)).languages == []


def test_words_are_runs_of_letters():
    words, bounds = langid.letter_words(pa.array(["It's Éa2b", None, "", "..", "ab"]))
    assert words.dictionary_decode().to_pylist() == ["it", "s", "éa", "b", "ab"]
    assert bounds.tolist() == [0, 4, 4, 4, 4, 5]


def test_lines_of_texts():
    texts = ["a b\nc", None, "", "\n", "x\n", "last line"]
    _, lengths, first = quality.line_features(pa.array(texts))
    assert first.tolist() == [0, 2, 3, 4, 6, 8, 9]
    assert lengths.tolist() == [3, 1, 0, 0, 0, 0, 1, 0, 9]


def test_quality_edge_cases(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    again = labels.union(labels).union(labels.selectExpr("doc_id", "null", "toxic"))
    model = quality.train(docs, again)
    found = quality.score(awkward(spark), model).collect()
    assert len(found) == awkward(spark).count() and all(0 <= r.score <= 1 for r in found)
    nothing = {r.score for r in found if not r.text}
    assert len(nothing) == 1
    assert quality.score(empty(spark), model).count() == 0


def test_quality_without_labels(spark):
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    model = quality.train(awkward(spark), none)
    assert {r.score for r in quality.score(awkward(spark), model).collect()} == {0.5}


def test_rows_of_an_id_are_bounded_in_learning(spark, monkeypatch):
    """An id may hold any number of rows, equal or not: the bound is on rows."""
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 60)
    seen = []
    logistic = quality._logistic
    monkeypatch.setattr(quality, "_logistic", lambda x, y: seen.append(len(y)) or logistic(x, y))
    rows = [(i % 4, f"line {i} of a text\nand {i * 7} more") for i in range(900)]
    rows += [(9, "the same text")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (0, 1, 2, 3, 9)], "doc_id long, quality int")
    quality.train(docs, labels)
    assert 20 < seen[0] <= 60
    seen.clear()
    quality.train(docs.where("doc_id = 9"), labels)
    assert seen == [1]
