"""Benchmark windows in documents against a plain scan."""

import re

import pytest
from llm.samples import awkward, empty

from wardwatch.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, length=10):
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(length, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            ids = windows.setdefault(tuple(own[at : at + size]), set())
            ids.add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        own, hit, ids = words(text), set(), set()
        for size in {len(window) for window in windows}:
            for at in range(len(own) - size + 1):
                met = windows.get(tuple(own[at : at + size]))
                if met:
                    hit.update(range(at, at + size))
                    ids |= met
        out.append((doc, len(own), sorted(hit), sorted(ids)))
    return sorted(out, key=str)


def ours(docs, items, **options):
    found = decontaminate.find(docs, items, keep=["doc_id"], **options).collect()
    return sorted(((r.doc.doc_id, r.n_words, sorted(r.hit), r["items"]) for r in found), key=str)


def plain(frame, *columns):
    return [tuple(row) for row in frame.select(*columns).collect()]


def hard_items(spark):
    rows = [
        (1, "The QUICK, brown fox -- jumps over the lazy dog!"),  # shorter than a window
        (2, "one"),
        (2, "o clock x"),
        (None, "中文 😀"),
        (3, None),
        (4, " ... "),
        (5, "word and more text word and more text word and more text word"),
        (5, "É é"),
        (5, "É é"),
    ]
    return spark.createDataFrame(rows, ITEMS)


def test_windows_of_all_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    expected = brute(plain(docs, "doc_id", "text"), plain(items, "item_id", "text"))
    assert sum(1 for row in expected if row[2]) > 10
    assert ours(docs, items) == expected


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 400}, {"length": 3}])
def test_awkward_rows(spark, options):
    extra = [(9, "a\x00B É é\x7fe"), (9, "the quick brown fox jumps over the lazy cat"), (8, "ONE one")]
    docs, items = awkward(spark, extra), hard_items(spark)
    expected = brute(
        plain(docs, "doc_id", "text"), plain(items, "item_id", "text"), options.get("length", 10)
    )
    assert ours(docs, items, **options) == expected


def test_empty_tables(spark):
    docs, items = awkward(spark), hard_items(spark)
    assert ours(empty(spark), items) == []
    assert all(not row[2] and not row[3] for row in ours(docs, items.limit(0)))


def test_hit_words_go_and_other_texts_stay(spark):
    rows = [
        (1, "Keep: this! The quick brown fox, jumps over the lazy dog; and that."),
        (2, "The quick brown fox jumps over the lazy dog"),
        (3, "nothing here  at all."),
        (4, None),
        (5, ""),
        (6, "..one.. two"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words")
    kept = decontaminate.decontaminated(docs, hard_items(spark), drop_share=0.9)
    assert kept.columns == docs.columns
    assert {row.doc_id: row.text for row in kept.collect()} == {
        1: "Keep: this! and that.",
        3: "nothing here  at all.",
        4: None,
        5: "",
        6: "..two",
    }


def test_only_hits_are_shuffled(spark, folder):
    """The look-up is a broadcast join, and no Python runs."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.find(docs, items, keep=["doc_id"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Python" not in text and "Arrow" not in text
