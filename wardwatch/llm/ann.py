"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, best bins first.

The tree is fitted to a bounded sample of the rows and every row is put into its leaf. A
query walks the tree through a priority queue, nearest centre first. How many leaves it
visits is calibrated on the sample: visits widen until the wanted recall against brute
force is reached. Distances inside the visited leaves are exact.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import sample
from wardwatch.llm.jaccard import stored
from wardwatch.llm.tiles import QUERIES, best_of_tiles, matrix, merged, usable

K = 5
# Rows that a tree is fitted to, and their bytes, at most, and rows of the sample per leaf,
# at least.
SAMPLE = 32_768
SAMPLE_BYTES = 128 * 1024**2
LEAF = 32
# Rows per leaf that the tree aims at, until the sample limits the leaves.
ROWS = 256
BRANCHES = 8
ROUNDS = 8
# Queries of the sample and the share of their true neighbours that visits must find.
TRIALS = 256
RECALL = 0.97
CANDIDATES = 8192


@dataclass
class Tree:
    """Nodes: centres of the children, and either child numbers or leaf numbers (as ~leaf)."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[np.ndarray] = field(default_factory=list)
    leaves: int = 0
    visits: int = 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector, by the nearest centre at each level."""
        if not self.centres:
            return np.zeros(len(vectors), np.int64)
        node = np.zeros(len(vectors), np.int64)
        active = np.arange(len(vectors))
        while len(active):
            for at in np.unique(node[active]):
                rows = active[node[active] == at]
                near = _nearest(vectors[rows], self.centres[at])
                node[rows] = self.children[at][near]
            active = active[node[active] >= 0]
        return ~node

    def order(self, query: np.ndarray):
        """Leaves, best bin first."""
        if not self.centres:
            yield 0
            return
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node < 0:
                yield ~node
                continue
            far = ((self.centres[node] - query) ** 2).sum(axis=1)
            for distance, child in zip(far.tolist(), self.children[node].tolist()):
                heapq.heappush(queue, (distance, child))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return (vectors @ centres.T - half).argmax(axis=1)


def _split(vectors: np.ndarray, branches: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Centres and each vector's centre, by k-means."""
    centres = np.unique(vectors[rng.permutation(len(vectors))[: 4 * branches]], axis=0)
    centres = centres[rng.permutation(len(centres))[:branches]]
    for _ in range(ROUNDS):
        near = _nearest(vectors, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    near = _nearest(vectors, centres)
    used, near = np.unique(near, return_inverse=True)
    return centres[used], near


def grow(vectors: np.ndarray, leaf: int) -> Tree:
    """A tree whose leaves hold about ``leaf`` of the given vectors."""
    tree, rng = Tree(), np.random.default_rng(11)

    def add(rows: np.ndarray) -> int:
        part = vectors[rows]
        if len(rows) <= leaf or (part == part[0]).all():
            tree.leaves += 1
            return ~(tree.leaves - 1)
        branches = min(BRANCHES, max(2, math.ceil(len(rows) / leaf)))
        centres, near = _split(part, branches, rng)
        if len(centres) < 2:
            tree.leaves += 1
            return ~(tree.leaves - 1)
        node = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append(np.zeros(len(centres), np.int64))
        for k in range(len(centres)):
            tree.children[node][k] = add(rows[near == k])
        return node

    if len(vectors) and add(np.arange(len(vectors))) < 0:
        tree.leaves = 1
    tree.leaves = max(1, tree.leaves)
    return tree


def calibrate(tree: Tree, vectors: np.ndarray, k: int, recall: float = RECALL) -> int:
    """Leaves to visit so that trials on the sample find this share of true neighbours."""
    if len(vectors) < 2:
        return 1
    leaf_of = tree.assign(vectors)
    trials = np.linspace(0, len(vectors) - 1, min(TRIALS, len(vectors))).astype(int)
    needed = []
    for trial in trials:
        scores = vectors @ vectors[trial]
        scores[trial] = -np.inf
        true = np.argsort(-scores, kind="stable")[: min(k, len(vectors) - 1)]
        visit = {leaf: n for n, leaf in enumerate(tree.order(vectors[trial]), 1)}
        needed += [visit[leaf] for leaf in leaf_of[true].tolist()]
    return int(np.sort(needed)[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)])


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _cosines(queries: np.ndarray):
    units = _unit(queries)
    norms = np.sqrt((queries * queries).sum(axis=1))

    def match(part: np.ndarray):
        part_norms = np.sqrt((part * part).sum(axis=1))

        def exact(q, c):
            # Sums along one row, so that equal vectors get equal scores.
            dots = np.concatenate(
                [
                    (queries[q[a : a + 8192]] * part[c[a : a + 8192]]).sum(axis=1)
                    for a in range(0, len(q), 8192)
                ]
            )
            return dots / (norms[q] * part_norms[c])

        return units @ (part / part_norms[:, None]).T, 1e-9, exact

    return match


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_column="vec_id",
    vector_column="embedding",
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, by cosine.

    Every row is in the index: vectors of each length have a tree of their own, fitted to
    at most ``SAMPLE`` of them, and are compared with each other. Ties go to the smaller id. A query visits more leaves while those hold fewer than ``k`` other rows,
    so that it gets all candidates if there are fewer. Rows take no part if their id or
    vector is null, or the vector is empty, zero or holds a null or non-finite component.
    A query's own rows are those of its id; a repeated query id asks once, with its
    least vector, and other repeated rows are candidates of their own. Other columns are
    not read.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        is_query.alias("asks"),
    )
    zero = F.forall("vector", lambda x: x == 0)
    rows = rows.where(F.col("id").isNotNull() & usable("vector") & ~zero)
    lengths = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).collect()
    found = None
    for dim, total in sorted(lengths) or [(1, 0)]:
        some = _search(rows.where(F.size("vector") == dim), dim, total, k, recall)
        found = some if found is None else found.unionByName(some)
    return found


def _search(rows: DataFrame, dim: int, total: int, k: int, recall: float) -> DataFrame:
    """``search`` among vectors of one length."""
    size = min(SAMPLE, max(LEAF, SAMPLE_BYTES // (8 * dim)))
    chosen = sample(rows.select("id", "vector"), "id", size).toArrow()["vector"]
    fitted = matrix(chosen.combine_chunks(), dim) if len(chosen) else np.zeros((0, dim))
    # One order, whichever way the rows came.
    fitted = _unit(fitted[np.lexsort(fitted.T[::-1])])
    leaves = max(1, min(math.ceil(total / ROWS), len(fitted) // LEAF))
    tree = grow(fitted, math.ceil(len(fitted) / leaves))
    tree.visits = calibrate(tree, fitted, k, recall)

    def into_leaves(batches):
        for batch in batches:
            leaf = tree.assign(_unit(matrix(batch.column(1), dim)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf)], ["id", "vector", "asks", "cell"]
            )

    indexed = rows.mapInArrow(
        into_leaves, "id long, vector array<double>, asks boolean, cell long"
    )
    indexed = stored(indexed, "leaves")
    # At most one row per leaf.
    held = {row.cell: row.n for row in indexed.groupBy("cell").agg(F.count("*").alias("n")).collect()}

    def walks(batches):
        for batch in batches:
            queries = _unit(matrix(batch.column(1), dim))
            row_of, cells = [], []
            for row in range(batch.num_rows):
                seen = visited = 0
                for leaf in tree.order(queries[row]):
                    if visited >= tree.visits and seen > k:
                        break
                    visited += 1
                    if leaf in held:
                        seen += held[leaf]
                        row_of.append(row)
                        cells.append(leaf)
            taken = pa.array(row_of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [c.take(taken) for c in batch.columns] + [pa.array(cells, pa.int64())],
                ["id", "vector", "cell"],
            )

    asking = indexed.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    # By number, as Spark would join tasks whose rows are few but whose walks are long.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    visits = asking.repartition(tasks, "id").mapInArrow(walks, "id long, vector array<double>, cell long")
    visits = stored(visits, "visits")
    wanted = {row.cell: row.n for row in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}

    def shares(counts: dict, size: int) -> Column:
        """Number of shares of each leaf, of about this many rows."""
        many = {cell: math.ceil(n / size) for cell, n in counts.items() if n > size}
        if not many:
            return F.lit(1).cast("long")
        pairs = [F.lit(x).cast("long") for pair in many.items() for x in pair]
        return F.coalesce(F.element_at(F.create_map(*pairs), F.col("cell")), F.lit(1).cast("long"))

    salts, blocks = shares(held, CANDIDATES), shares(wanted, QUERIES)

    def each(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))

    length = F.lit(dim).cast("long").alias("dim")
    queries = visits.select(
        length,
        "cell",
        F.pmod(F.xxhash64("id"), blocks).alias("block"),
        each(salts).alias("salt"),
        F.lit(0).cast("long").alias("side"),
        "id",
        "vector",
    )
    place = F.pmod(F.monotonically_increasing_id() * 7919, salts)
    candidates = indexed.select(
        length,
        "cell",
        each(blocks).alias("block"),
        place.alias("salt"),
        F.lit(1).cast("long").alias("side"),
        "id",
        "vector",
    )
    found = best_of_tiles(queries.unionByName(candidates), k, "double", _cosines)
    # Lists of leaves are merged like those of shares.
    return merged(found.withColumn("salt", F.xxhash64("vec_id")), k, max(4, tree.visits))
