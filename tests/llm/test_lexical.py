"""Ranked search against scores made one by one, in whole numbers."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm.samples import awkward, empty, sentences

from wardwatch.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def bag(text):
    return Counter(term.translate(LOWER) for term in TERM.findall(text or ""))


def brute(docs, items, k=10):
    held = [(doc, bag(text)) for doc, text in docs]
    held = [(doc, counts, sum(counts.values())) for doc, counts in held if counts]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        found = []
        for doc, counts, n in held:
            m = 25 + (75 * n * n_docs) // length
            score = sum(
                times * weight[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t, times in bag(text).items()
                if t in counts
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        ranked = enumerate(sorted(found)[:k], 1)
        out += [(item, place, row[3], -row[0]) for place, row in ranked]
    return sorted(out, key=str)


def ours(docs, items, **options):
    return sorted((tuple(row) for row in lexical.rank(docs, items, **options).collect()), key=str)


def plain(frame, *columns):
    return [tuple(row) for row in frame.select(*columns).collect()]


@pytest.mark.parametrize("options", [{}, {"item_bytes": 2000}])
def test_all_documents_for_all_items(spark, folder, options):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    expected = brute(plain(docs, "doc_id", "text"), plain(items, "item_id", "text"))
    assert ours(docs, items, **options) == expected


def test_awkward_rows(spark):
    docs = awkward(spark, [(i, "tie tie fox") for i in range(30, 10, -1)])
    rows = [(1, "FOX é 中文 tie"), (2, None), (3, ""), (4, "..."), (1, "tie"), (1, "tie"), (None, "dog word")]
    items = spark.createDataFrame(rows, ITEMS)
    expected = brute(plain(docs, "doc_id", "text"), rows)
    assert ours(docs, items) == expected
    assert ours(docs, items, k=3) == brute(plain(docs, "doc_id", "text"), rows, 3)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "fox")], ITEMS)
    assert ours(empty(spark), items) == []
    assert ours(awkward(spark), items.limit(0)) == []


def test_items_in_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 60)
    monkeypatch.setattr(lexical, "TERMS", 7)
    docs = [(i, text) for i, text in enumerate(sentences(1, 80))]
    items = [(i, text) for i, text in enumerate(sentences(2, 15, words=12))]
    vocabulary, bags = lexical._bags(_column(items))
    tiles = lexical._tiles(bags)
    assert len(tiles) > 3
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert ours(frame, spark.createDataFrame(items, ITEMS)) == brute(docs, items)


def _column(items):
    import pyarrow as pa

    return pa.chunked_array([[text for _, text in items]])


def test_products_beyond_float64_are_whole_numbers():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 5, (6, 40)).astype(float)
    impacts = rng.integers(0, 2**50, (40, 9)).astype(float)
    counts[2, 5] = 2.0**20
    impacts[5] = 2.0**35 + 1
    exact = counts.astype(np.int64) @ impacts.astype(np.int64)
    assert (lexical.product(counts, impacts) == exact).all()


def test_norms_stay_exact_beyond_64_bits():
    n = np.array([1, 10**6], np.int64)
    many, length = 10**12, 3 * 10**14 + 7
    assert lexical.norms(n, many, length).tolist() == [25 + 75 * int(x) * many // length for x in n]
