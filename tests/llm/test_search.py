"""Exact and approximate search against SQL and brute force."""

import numpy as np
from compare import assert_same, connect
from pyspark.sql import functions as F

from wardwatch.llm import ann, topk
from wardwatch.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, score int, rank int, dim int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, measure, k=5, step=2):
    """The best of each query, ties to the smaller id; rows as the docstrings say."""
    out = {}
    for query in sorted({i for i, _ in rows if i % step == 0}):
        own = min(v for i, v in rows if i == query)
        scores = [(measure(own, v), i) for i, v in rows if i != query and len(v) == len(own)]
        out[query] = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
    return out


def inner(a, b):
    return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b))


def lists(found):
    out = {}
    for row in found.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.score, row.vec_id))
        assert row.rank == len(out[row.query_id])
    return out


def test_exact_query_agrees_with_sql(spark, folder):
    query = QUERIES["op1_topk"](spark, folder)
    assert_same(query, connect(folder), ORACLES["op1_topk"])


AWKWARD = [
    (None, [1.0, 2.0, 0.5]),
    (20, None),
    (22, []),
    (24, [1.0, None, 2.0]),
    (26, [float("nan"), 1.0, 1.0]),
    (28, [float("inf"), 1.0, 1.0]),
]


def test_exact_edge_cases(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3).round(2).tolist()) for i in range(12)]
    rows += [(i, [0.5, -0.25, 1.0]) for i in range(30, 60)]  # ties
    rows += [rows[0], rows[3], rows[3]]  # repeated rows
    rows += [(70, [1.0, 2.0]), (72, [3.0, 1.0]), (74, [1.0])]  # other lengths
    found = lists(topk.search(frame(spark, rows + AWKWARD), F.col("vec_id") % 2 == 0))
    assert found == {q: s for q, s in brute(rows, inner).items() if s}


def test_exact_with_large_numbers(spark):
    rows = [(0, [3e6, 1e6]), (1, [2e6 + 0.25, 5.0]), (2, [2e6, 5.0]), (3, [1e200, -1.0])]
    found = lists(topk.search(frame(spark, rows), F.col("vec_id") == 0))[0]
    assert found[0] == (np.iinfo(np.int64).max, 3)
    assert found[1:] == sorted([(inner(rows[0][1], rows[k][1]), k) for k in (1, 2)], reverse=True)


def test_empty_tables(spark):
    none = frame(spark, [(1, [1.0])]).where("vec_id < 0")
    assert topk.search(none, F.col("vec_id") % 2 == 0).count() == 0
    assert ann.search(none, F.col("vec_id") % 2 == 0).count() == 0
    alone = frame(spark, [(2, [1.0, 0.0])])
    assert topk.search(alone, F.col("vec_id") % 2 == 0).count() == 0
    assert ann.search(alone, F.col("vec_id") % 2 == 0).count() == 0


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def test_approximate_edge_cases(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).round(2).tolist()) for i in range(40)]
    rows += [(i, [0.5, -0.25, 1.0]) for i in range(100, 130)]
    bad = [*AWKWARD, (32 + 100, [0.0, 0.0, 0.0]), (134, [1.0, 2.0])]
    found = lists(ann.search(frame(spark, rows + bad), F.col("vec_id") % 2 == 0))
    truth = brute(rows, cosine)
    assert set(found) == set(truth)
    for query, best in truth.items():
        assert [i for _, i in found[query]] == [i for _, i in best]
        assert np.allclose([s for s, _ in found[query]], [s for s, _ in best], atol=1e-12)


def test_vectors_of_every_length_take_part(spark):
    rng = np.random.default_rng(8)
    lengths = [3] * 90 + [6] * 40 + [1] * 5 + [9]
    rows = [(i, rng.normal(size=n).round(2).tolist()) for i, n in enumerate(lengths)]
    found = lists(ann.search(frame(spark, rows), F.col("vec_id") % 2 == 0))
    truth = {}
    for n in set(lengths):
        truth |= brute([row for row in rows if len(row[1]) == n], cosine)
    assert {q for q, best in truth.items() if best} == set(found)
    for query, best in found.items():
        assert [i for _, i in best] == [i for _, i in truth[query]]


def test_approximate_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    table = rows.toArrow().sort_by("vec_id")
    ids = table["vec_id"].to_numpy()
    vectors = np.array(table["embedding"].to_pylist(), float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    found = lists(QUERIES["op4_ann"](spark, folder))
    hits = 0
    for query, best in found.items():
        scores = vectors @ vectors[np.searchsorted(ids, query)]
        scores[ids == query] = -2
        true = ids[np.lexsort((ids, -scores))[:5]]
        hits += len(set(true) & {i for _, i in best})
    assert len(found) == (ids % 50 == 0).sum()
    assert hits / (5 * len(found)) >= 0.93


def test_tree_visits_every_leaf_once():
    vectors = np.random.default_rng(1).normal(size=(600, 8))
    tree = ann.grow(vectors, 20)
    assert sorted(tree.order(vectors[0])) == list(range(tree.leaves))
    assert set(tree.assign(vectors)) == set(range(tree.leaves))
    assert ann.grow(np.ones((50, 4)), 10).leaves == 1
