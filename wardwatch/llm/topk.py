"""Exact top-k search by inner product of integer vectors, as tiled matrix products."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.tiles import QUERIES, best_of_tiles, merged, usable

K = 5
SCALE = 256.0
# Candidates of a group, and groups at least, so that a small table still spreads.
CANDIDATES = 16_384
GROUPS = 64

LONG = np.iinfo(np.int64)


def _products(queries: np.ndarray):
    """Inner products of the floors, exact whatever their size."""
    top = np.abs(queries).max(initial=0)

    def match(part: np.ndarray):
        part = np.floor(part * SCALE)
        bound = top * np.abs(part).max(initial=0) * queries.shape[1]
        if bound < 2**53:
            scores = queries @ part.T  # sums of integers that doubles hold exactly
            return scores, 0.0, lambda q, c: scores[q, c].astype(np.int64)
        whole = [np.array([[int(x) for x in row] for row in m], object) for m in (queries, part)]
        exact = np.clip(whole[0] @ whole[1].T, LONG.min, LONG.max).astype(np.int64)
        # As doubles they are off by no more than this.
        slack = float(np.spacing(np.abs(exact).astype(np.float64).max(initial=1))) * 4
        return exact.astype(np.float64), slack, lambda q, c: exact[q, c]

    return match


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_column="vec_id",
    vector_column="embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each query.

    Each component x counts as floor(256 x); the score is the inner product, ties go to the
    smaller id. A query with fewer candidates gets them all. Rows take no part if their
    id or vector is null, or the vector is empty or holds a null or non-finite component.
    Vectors of different length are not compared. A query's own rows are those of its id;
    a repeated query id asks once, with its least vector, and other repeated rows are
    candidates of their own. Scores beyond a long are given as its bounds. Other columns
    are not read.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        is_query.alias("asks"),
    )
    rows = rows.where(F.col("id").isNotNull() & usable("vector"))
    rows = rows.select("*", F.size("vector").cast("long").alias("dim"))
    asking = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    counts = rows.agg(F.count("*"), F.sum(F.col("asks").cast("long"))).first()
    blocks = max(1, math.ceil((counts[1] or 0) / QUERIES))
    salts = max(GROUPS, math.ceil(counts[0] / CANDIDATES))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>"))
    zero = F.lit(0).cast("long")
    queries = asking.select(
        F.size("vector").cast("long").alias("dim"),
        zero.alias("cell"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
        every.alias("salt"),
        zero.alias("side"),
        "id",
        "vector",
    )
    # Dealt by place, so that repeated rows are spread as well.
    place = F.pmod(F.monotonically_increasing_id() * 7919, F.lit(salts))
    candidates = rows.select(
        "dim",
        zero.alias("cell"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"),
        place.alias("salt"),
        F.lit(1).cast("long").alias("side"),
        "id",
        "vector",
    )
    found = best_of_tiles(
        queries.unionByName(candidates), k, "long", lambda q: _products(np.floor(q * SCALE))
    )
    return merged(found, k, salts)
