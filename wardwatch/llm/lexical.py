"""Ranked lexical search as matrix products of item tiles and document tiles.

Terms are runs of ASCII letters and digits and of everything beyond ASCII, A-Z in lower case.
The terms of the items are the vocabulary. One pass over the documents leaves the length of
each and its counts of vocabulary terms; lengths and counts give the weights; a second pass,
over that table, multiplies items x terms with terms x documents in float64. Products are cut
so that no partial sum reaches 2^53, and added up as integers, so scores are exact. The best
of every tile, ties by id, are merged per task and then in a tree.

Defined results: null texts have no terms; documents without a term do not count; items
alike in id and text are one, other rows of an id are items of their own; an item without a
known term has no row; repeated documents are ranked each by itself; a document without an
id comes after those that have one; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.llm.tiles import Best, merge_slice, merged
from wardwatch.session import scratch_path

# Bytes of item texts that are taken at once, in one scan of the documents.
ITEM_BYTES = 16 * 1024**2
# Documents of a tile, terms of a product, and cells (items x terms) of an item tile.
DOCS, TERMS, CELLS = 1024, 2048, 1 << 22
# Lists that meet in the first step of the merge, by task.
MERGED = 32
# Float64 holds every integer below this.
EXACT = 2**53

_NO_ID = np.iinfo(np.int64).max
_PLAIN = bytes(
    ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else c if c >= 128 else 0x20
    for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text; every byte beyond ASCII belongs to one."""
    return text.translate(_PLAIN).split()


@dataclass
class ItemTile:
    """Counts (items, vocabulary) of some items; ``first`` is the place of their first."""

    first: int
    vocabulary: np.ndarray
    counts: np.ndarray


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents above 0 of each item.

    Items are taken in blocks of about ``item_bytes`` of text, which is what reaches the
    driver and the tasks; every block is a scan of its own.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    asked = asked.where("length(text) > 0").distinct()
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / item_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for place in range(blocks):
        some = _of_block(spark, texts, asked.where(block == place).toArrow(), k)
        found = some if found is None else found.unionByName(some)
    return found


def _of_block(spark, texts: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    vocabulary, bags = _bags(asked["text"])
    path = scratch_path(spark, "term-counts")
    texts.mapInArrow(
        lambda batches: _counted(batches, vocabulary),
        "doc_id long, n long, terms array<int>, counts array<int>",
    ).write.parquet(path)
    counted = spark.read.parquet(path)
    n_docs, length = counted.agg(F.count("*"), F.sum("n")).first()
    weights = _weights(counted, n_docs, len(vocabulary))
    tiles = _tiles(bags)
    found = counted.mapInArrow(
        lambda batches: _scored(batches, tiles, weights, n_docs, length, len(bags), k),
        "query_id long, salt long, vec_id long, score long",
    )
    # A row per item, bounded as the block is.
    ids = spark.createDataFrame(
        pa.table({"query_id": pa.array(range(len(bags)), pa.int64()), "item_id": asked["item_id"]}),
        T.StructType([T.StructField("query_id", T.LongType()), T.StructField("item_id", _kind(asked))]),
    )
    best = merged(found, k, MERGED**2)
    return best.join(F.broadcast(ids), "query_id").select(
        "item_id",
        "rank",
        F.when(F.col("vec_id") != int(_NO_ID), F.col("vec_id")).alias("doc_id"),
        "score",
    )


def _kind(asked: pa.Table) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(asked.schema.field("item_id").type)


def _bags(texts: pa.ChunkedArray) -> tuple[dict[bytes, int], list[dict[int, int]]]:
    """Ids of all terms of the items, and the counts of each item."""
    vocabulary: dict[bytes, int] = {}
    bags = []
    for text in texts.to_pylist():
        counts = Counter(terms(text.encode()))
        bags.append({vocabulary.setdefault(t, len(vocabulary)): n for t, n in counts.items()})
    return vocabulary, bags


def _counted(batches, vocabulary: dict[bytes, int]):
    """(doc_id, n, terms, counts) of the documents that have a term at all."""
    for batch in batches:
        ids, lengths, which, place = [], [], [], []
        for doc, text in zip(batch.column(0), batch.column(1)):
            every = terms(text.as_buffer().to_pybytes()) if text.is_valid else ()
            if not every:
                continue
            known = [t for t in map(vocabulary.get, every) if t is not None]
            tally = Counter(known)
            ids.append(doc.as_py())
            lengths.append(len(every))
            which.append(list(tally.keys()))
            place.append(list(tally.values()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(which, pa.list_(pa.int32())),
                pa.array(place, pa.list_(pa.int32())),
            ],
            ["doc_id", "n", "terms", "counts"],
        )


def _weights(counted: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """floor(1000 ln((2N+2) / (2df+1))) by term; a row per term of the vocabulary comes."""
    weights = np.zeros(size, np.int64)
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count()
    for term, df in holding.collect():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return weights


def _tiles(bags: list[dict[int, int]]) -> list[ItemTile]:
    """Items in tiles of at most ``CELLS`` counts, each over its own terms alone."""
    tiles, first = [], 0
    while first < len(bags):
        known: set[int] = set()
        last = first
        while last < len(bags):
            grown = known | bags[last].keys()
            if last > first and len(grown) * (last - first + 1) > CELLS:
                break
            known, last = grown, last + 1
        vocabulary = np.array(sorted(known), np.int64)
        counts = np.zeros((last - first, len(vocabulary)))
        for row, bag in enumerate(bags[first:last]):
            own = np.fromiter(bag.keys(), np.int64, len(bag))
            counts[row, np.searchsorted(vocabulary, own)] = list(bag.values())
        tiles.append(ItemTile(first, vocabulary, counts))
        first = last
    return tiles


def norms(n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """100 - 75 + (75 n N) div L, exactly."""
    if len(n) and 75 * n_docs * int(n.max()) >= 2**63:
        return np.array([25 + 75 * int(x) * n_docs // length for x in n], np.int64)
    return 25 + 75 * n_docs * n // length


def product(counts: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """``counts`` (items, terms) x ``impacts`` (terms, documents), exactly, as int64."""
    width = counts.shape[1]
    if not width:
        return np.zeros((len(counts), impacts.shape[1]), np.int64)
    if counts.sum(axis=1).max() * impacts.max() < EXACT:
        return (counts @ impacts).astype(np.int64)
    if width == 1:
        return np.outer(counts.astype(np.int64), impacts.astype(np.int64))
    half = width // 2
    return product(counts[:, :half], impacts[:half]) + product(counts[:, half:], impacts[half:])


def _scored(batches, tiles, weights, n_docs: int, length: int, n_items: int, k: int):
    """(item, task, doc_id, score): the best of each item among the documents of a task."""
    from pyspark import TaskContext

    shape = (n_items, k)
    best = Best(np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(n_items, int))
    views = [
        Best(best.scores[at:to], best.ids[at:to], best.filled[at:to])
        for at, to in ((t.first, t.first + len(t.counts)) for t in tiles)
    ]
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS):
            part = batch.slice(at, DOCS)
            ids = part.column(0).fill_null(_NO_ID).to_numpy()
            norm = norms(part.column(1).to_numpy(), n_docs, length)
            doc = np.repeat(np.arange(len(ids)), part.column(2).value_lengths().to_numpy())
            term = part.column(2).flatten().to_numpy()
            tf = part.column(3).flatten().to_numpy().astype(np.int64)
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[doc]))
            for tile, view in zip(tiles, views):
                scores = _tile_scores(tile, doc, term, impact, len(ids))
                rough = np.where(scores > 0, scores.astype(np.float64), np.nan)
                slack = 0.0 if scores.max(initial=0) < EXACT else 4096.0
                merge_slice(view, rough, ids, slack, lambda q, c: scores[q, c])
    row = np.repeat(np.arange(n_items), best.filled)
    slot = np.concatenate([np.arange(n) for n in best.filled]) if len(row) else row
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(row, pa.int64()),
            pa.array(np.full(len(row), TaskContext.get().partitionId(), np.int64)),
            pa.array(best.ids[row, slot], pa.int64()),
            pa.array(best.scores[row, slot], pa.int64()),
        ],
        ["query_id", "salt", "vec_id", "score"],
    )


def _tile_scores(tile: ItemTile, doc, term, impact, n_docs: int) -> np.ndarray:
    """Scores (items, documents) of a tile, from the terms that both sides have."""
    local = np.searchsorted(tile.vocabulary, term)
    known = tile.vocabulary[np.minimum(local, len(tile.vocabulary) - 1)] == term
    present, row = np.unique(local[known], return_inverse=True)
    doc, impact = doc[known], impact[known]
    scores = np.zeros((len(tile.counts), n_docs), np.int64)
    for low in range(0, len(present), TERMS):
        own = (row >= low) & (row < low + TERMS)
        dense = np.zeros((min(TERMS, len(present) - low), n_docs))
        dense[row[own] - low, doc[own]] = impact[own]
        scores += product(tile.counts[:, present[low : low + TERMS]], dense)
    return scores
