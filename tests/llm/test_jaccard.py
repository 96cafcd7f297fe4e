"""Near duplicates against all pairs."""

import random

import numpy as np
import pytest
from llm.samples import LONG, awkward, empty, sentences
from pyspark.sql import functions as F

from wardwatch.llm import jaccard
from wardwatch.llm.queries import QUERIES


def ngrams(text, width=5):
    words = (text or "").lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute(rows):
    """Per row (id, text): class and number of linked texts, by comparing all distinct sets."""
    sets = [ngrams(t) for _, t in rows]
    distinct = [s for s in dict.fromkeys(sets) if s]
    links = {s: set() for s in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            common = len(a & b)
            if 10 * common >= 8 * (len(a) + len(b) - common):
                links[a].add(b)
                links[b].add(a)
    root = {}
    for s in distinct:
        if s in root:
            continue
        todo = [s]
        while todo:
            one = todo.pop()
            if one not in root:
                root[one] = s
                todo += links[one]
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[root[s]] = min(least.get(root[s], i), i)
    texts = {s: len({t for (_, t), own in zip(rows, sets) if own == s}) for s in distinct}

    def linked(s):
        return sum(texts[other] for other in links[s]) + texts[s] - 1 if s else 0

    return sorted(
        (str(i), str(least.get(root[s]) if s else i), linked(s))
        for (i, _), s in zip(rows, sets)
    )


def found(rows):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in rows.collect())


def near_copies(seed, count, changes):
    rng = random.Random(seed)
    base = sentences(seed, 1, words=300)[0].split()
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(*changes)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(QUERIES["op5_jaccard"](spark, folder)) == brute(rows)


def test_edge_cases(spark):
    docs = awkward(spark, [(30, LONG + "end"), (31, "ONE"), (32, "one two three four five")])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(jaccard.classes(docs)) == brute(rows)
    assert jaccard.classes(empty(spark)).count() == 0
    assert jaccard.deduplicated(empty(spark)).count() == 0


def test_texts_with_equal_ngrams_are_linked(spark):
    """Other case, white space and repeated stretches; copies of one text are one."""
    a, b, c = near_copies(4, 3, (1, 2))
    cycle = "one two three four five "
    texts = [a, a.upper(), a.replace(" ", "\n"), a, b, b.title(), c]
    texts += [cycle * 3, cycle * 4, cycle * 5, "short", "SHORT", "short "]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = found(jaccard.classes(docs))
    assert result == brute(rows)
    assert ("4", "0", 5) in result and ("10", "10", 2) in result


def test_deduplicated(spark):
    docs = awkward(spark, [(40 + k, t) for k, t in enumerate(near_copies(1, 5, (1, 3)))])
    kept = jaccard.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 3, None, None, 4, 5, 6, 7, 8, 40], key=str)


def test_large_group_in_tiles(spark, monkeypatch):
    """Groups above the tile size, with chains of links and a passage that many share."""
    monkeypatch.setattr(jaccard, "TILE", 16)
    texts = near_copies(3, 120, (0, 12)) + near_copies(4, 40, (10, 25))
    shared = sentences(9, 1, words=60)[0]
    texts += [f"{t} {shared}" for t in sentences(5, 60, words=60, vocabulary=5000)]
    texts += texts[:30]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    truth = brute(rows)
    assert found(jaccard.classes(docs)) == truth
    assert max(n for _, _, n in truth) > 16


def test_components_against_union_find(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(400 + k, 401 + k) for k in range(60)] + [(7, 7)]
    root = list(range(500))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(edges, "a long, b long")
    truth = {x: find(x) for pair in edges if pair[0] != pair[1] for x in pair}
    assert {r.node: r.root for r in jaccard.components(frame).collect()} == truth


def test_pruning_keeps_what_reaches_the_threshold():
    fewest = jaccard.fewest_matches(0.8, 1e-6)
    rng = np.random.default_rng(4)
    same = rng.random((4000, jaccard.VALUES)) < 0.8
    left = rng.integers(0, 2**16, (4000, jaccard.VALUES), dtype=np.uint16)
    right = np.where(same, left, left + np.uint16(1))
    place = np.arange(4000)
    alive = jaccard.surviving(np.concatenate([left, right]), place, place + 4000, fewest)
    assert len(alive) >= 3999
    far = np.where(rng.random(left.shape) < 0.4, left, left + np.uint16(1))
    assert len(jaccard.surviving(np.concatenate([left, far]), place, place + 4000, fewest)) < 5


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_posterior_bound(threshold):
    fewest = jaccard.fewest_matches(threshold, 1e-6)
    assert list(fewest) == list(jaccard.STEPS)
    assert all(m < threshold * n for n, m in fewest.items())


def test_minhash_estimates(spark):
    a, b = ngrams(near_copies(2, 2, (5, 5))[0]), ngrams(near_copies(2, 2, (5, 5))[1])
    code = {g: np.uint64(hash(g) & (2**64 - 1)) for g in a | b}
    hashes = np.array([code[g] for g in [*a, *b]], np.uint64)
    first, second = jaccard.minhash(hashes, np.array([0, len(a)]))
    true = len(a & b) / len(a | b)
    assert abs((first == second).mean() - true) < 0.12


def test_equal_rows_are_one_class(spark):
    rows = [(k, "same words here and there again") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = jaccard.classes(docs).agg(F.max("class_id"), F.max("n_links"), F.count("*")).first()
    assert tuple(result) == (0, 0, 50)


def test_components_stop_at_stars(spark, monkeypatch):
    """Stars need no round, and no table has more files than its rows and the cores need."""
    names, files = [], []
    store = jaccard.stored

    def counted(df, name, most=None):
        found = store(df, name, most)
        names.append(name)
        files.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(jaccard, "stored", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stars = [(k, k % 3) for k in range(3, 200)]
        edges = spark.createDataFrame(stars, "a long, b long")
        found = sorted(map(tuple, jaccard.components(edges, len(stars)).collect()))
        assert found == sorted(stars + [(0, 0), (1, 1), (2, 2)])
        assert names == ["edges"] and max(files) <= spark.sparkContext.defaultParallelism
        path = [(k, k + 1) for k in range(60)] + [(70, 71), (71, 70), (80, 80)]
        edges = spark.createDataFrame(path, "a long, b long")
        found = sorted(map(tuple, jaccard.components(edges, len(path)).collect()))
        assert found == [(k, 0) for k in range(61)] + [(70, 70), (71, 70)]
        assert max(files) <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
