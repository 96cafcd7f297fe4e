"""Best candidates of queries in tiles: groups of some queries and a share of the candidates.

A group's rows are its queries (``side`` 0) followed by its candidates (``side`` 1). The
candidates stream by in slices, each a matrix product with the queries, of which only the
best few per query are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Queries of a group, and candidates of one product.
QUERIES = 2048
SLICE = 2048
PAIRS = 1 << 16

KEYS = ["dim", "cell", "block", "salt"]


def usable(vector: str) -> Column:
    """Not null, not empty, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite


@dataclass
class Best:
    """The best candidates so far: (queries, k) scores and ids, in order; empty ones last."""

    scores: np.ndarray
    ids: np.ndarray
    filled: np.ndarray


def merge_slice(best: Best, rough, ids, slack: float, exact) -> None:
    """Take in a slice. ``rough`` (queries, candidates) is within ``slack`` of the score.

    ``exact`` gives scores of pairs (query places, candidate places). Masked pairs are
    NaN in ``rough``. Equal scores go to the smaller id.
    """
    k = best.ids.shape[1]
    scores = np.where(np.isnan(rough), -np.inf, rough)
    if scores.shape[1] > k:
        bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    else:
        bound = np.full(len(scores), -np.inf)
    full = best.filled == k
    bound[full] = np.maximum(bound[full], best.scores[full, -1].astype(np.float64))
    row, column = np.nonzero((scores >= (bound - slack)[:, None]) & (scores > -np.inf))
    for low in range(0, len(row), PAIRS):
        high = min(len(row), low + PAIRS)
        q, c = row[low:high], column[low:high]
        _merge(best, q, exact(q, c), ids[c])


def _merge(best: Best, query, scores, ids) -> None:
    k = best.ids.shape[1]
    touched = np.unique(query)
    old_q = np.repeat(touched, best.filled[touched])
    slot = np.arange(len(old_q)) - np.repeat(
        np.cumsum(best.filled[touched]) - best.filled[touched], best.filled[touched]
    )
    q = np.concatenate([old_q, query])
    s = np.concatenate([best.scores[old_q, slot], scores])
    i = np.concatenate([best.ids[old_q, slot], ids])
    order = np.lexsort((i, -s, q))
    q, s, i = q[order], s[order], i[order]
    starts = np.searchsorted(q, touched)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    keep = rank < k
    best.scores[q[keep], rank[keep]] = s[keep]
    best.ids[q[keep], rank[keep]] = i[keep]
    best.filled[touched] = np.minimum(np.diff(np.append(starts, len(q))), k)


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def best_of_tiles(rows: DataFrame, k: int, kind: str, make) -> DataFrame:
    """(query_id, salt, vec_id, score) with the best ``k`` of each query in each group.

    ``rows`` are (dim, cell, block, salt, side, id, vector). ``make(queries)`` returns a
    function that takes a matrix of candidates and gives rough scores, slack and ``exact``.
    ``kind`` is the type of the score.
    """
    dealt = rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "side")
    dtype = np.int64 if kind == "long" else np.float64

    def close(group):
        if group is None or group["best"] is None:
            return
        best, ids = group["best"], group["ids"]
        row = np.repeat(np.arange(len(ids)), best.filled)
        slot = np.concatenate([np.arange(n) for n in best.filled]) if len(row) else row
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[row]),
                pa.array(np.full(len(row), group["key"][3], np.int64)),
                pa.array(best.ids[row, slot]),
                pa.array(best.scores[row, slot]),
            ],
            ["query_id", "salt", "vec_id", "score"],
        )

    def run(batches):
        group = None
        for batch in batches:
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(6)]
            keys = np.stack(columns[:4], axis=1)
            side, ids = columns[4], columns[5]
            change = np.any(keys[1:] != keys[:-1], axis=1) | (side[1:] != side[:-1])
            edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(ids)]])
            for low, high in zip(edges[:-1], edges[1:]):
                if low == high:
                    continue
                key = tuple(int(x) for x in keys[low])
                if group is None or group["key"] != key:
                    yield from close(group)
                    group = {"key": key, "ids": [], "parts": [], "best": None}
                part = matrix(batch.column(6).slice(low, high - low), key[0])
                if side[low] == 0:
                    group["ids"].append(ids[low:high])
                    group["parts"].append(part)
                    continue
                if not len(group["parts"]):
                    continue  # no query of this block
                if group["best"] is None:
                    group["ids"] = np.concatenate(group["ids"])
                    group["match"] = make(np.concatenate(group["parts"]))
                    shape = (len(group["ids"]), k)
                    group["best"] = Best(
                        np.zeros(shape, dtype), np.zeros(shape, np.int64), np.zeros(shape[0], int)
                    )
                for at in range(0, len(part), SLICE):
                    some = ids[low + at : min(high, low + at + SLICE)]
                    rough, slack, exact = group["match"](part[at : at + SLICE])
                    own = np.isin(some, group["ids"])
                    if own.any():
                        rough = rough.astype(np.float64, copy=True)
                        rough[group["ids"][:, None] == some[None, :]] = np.nan
                    merge_slice(group["best"], rough, some, slack, exact)
        yield from close(group)

    return dealt.select(*KEYS, "side", "id", "vector").mapInArrow(
        run, f"query_id long, salt long, vec_id long, score {kind}"
    )


def merged(found: DataFrame, k: int, salts: int) -> DataFrame:
    """(query_id, rank, vec_id, score): lists of the groups merged as a tree of two levels."""
    order = [F.desc("score"), F.asc("vec_id")]
    fan = max(1, int(salts**0.5))
    near = Window.partitionBy("query_id", F.col("salt") % fan).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    every = Window.partitionBy("query_id").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
