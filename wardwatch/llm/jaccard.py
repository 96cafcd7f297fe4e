"""Join of documents on the Jaccard similarity of their word n-grams.

Documents with equal n-gram sets are one node. Nodes that agree in a band of MinHash values
share a bucket, and pairs of a bucket are pruned by Bayes: their values are compared a few
at a time, and a pair is dropped once the posterior probability that its similarity reaches
the threshold is below a tolerance. What is left connects nodes to groups, inside of which
every pair is verified exactly, in tiles of bounded size. Pairs never become rows.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.shingles import shingle_chunks
from wardwatch.session import scratch_path

WIDTH = 5
THRESHOLD = 0.8

# 40 bands of 5 values: a pair at the threshold shares none with probability 1.2e-7.
BANDS = 40
ROWS = 5
VALUES = BANDS * ROWS
# A pair is dropped when the posterior is below this.
TOLERANCE = 1e-6
# Values that are compared before each decision.
STEPS = (16, 32, 64, 120, 200)

# Nodes of a bucket or block that are compared in one go, and n-grams of a block.
TILE = 256
TILE_NGRAMS = 400_000

# Rows of a stored table that are one task's and file's, where their number is known.
ROWS_PER_TASK = 20_000
# Nodes of small buckets that one task compares.
TILE_ROWS = 10_000

_RNG = np.random.default_rng(20240501)
_FACTORS = _RNG.integers(0, 2**31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MASKS = _RNG.integers(0, 2**32, VALUES, dtype=np.uint32)


def minhash(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, VALUES) 16 bits of the least hash of each text under each permutation.

    Every text has at least one n-gram.
    """
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), VALUES), np.uint16)
    ends = np.append(starts[1:], len(small))
    low = 0
    while low < len(starts):  # about what fits a core's cache
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + 60_000, "right")))
        part = small[starts[low] : ends[high - 1]]
        at = starts[low:high] - starts[low]
        for k in range(VALUES):
            least = np.minimum.reduceat((part ^ _MASKS[k]) * _FACTORS[k], at)
            out[low:high, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
        low = high
    return out


def fewest_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """Per number of compared values, the matches from which a pair stays.

    With a uniform prior the posterior of the similarity after m of n matches is
    Beta(m + 1, n - m + 1), whose tail above t is that of a binomial: P(Bin(n + 1, t) <= m).
    """
    out = {}
    for n in STEPS:
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
    return out


def surviving(values: np.ndarray, left: np.ndarray, right: np.ndarray, fewest: dict) -> np.ndarray:
    """Places of the pairs that no step drops."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    done = 0
    for n in STEPS:
        for low in range(0, len(alive), 50_000):
            some = alive[low : low + 50_000]
            same = values[left[some], done:n] == values[right[some], done:n]
            matches[some] += same.sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= fewest[n]]
        done = n
    return alive


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least place connected with each of ``count`` places."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = np.minimum(new, new[new])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def whole_groups(batches, keys: list[str]):
    """Tables that hold whole groups of rows sorted by ``keys``, and the groups' bounds."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        bounds = _bounds(rest, keys)
        if len(bounds) > 2:
            yield rest.slice(0, bounds[-2]).combine_chunks(), bounds[:-1]
            rest = rest.slice(bounds[-2])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), _bounds(rest, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    if not table.num_rows:
        return np.zeros(1, np.int64)
    change = np.zeros(table.num_rows + 1, bool)
    change[[0, -1]] = True
    for key in keys:
        column = table[key].to_numpy()
        change[1:-1] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def stored(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder.

    With ``most`` rows at most, no more tasks write it than these rows and the cores need: a
    shuffle may have many partitions with next to nothing in them.
    """
    path = scratch_path(df.sparkSession, name)
    if most is not None:
        df = df.coalesce(_tasks(df, most, ROWS_PER_TASK))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _tasks(df: DataFrame, rows: int, per_task: int, per_core: int = 1) -> int:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(per_core * cores, math.ceil(rows / per_task))


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, root): each node of the edges (a, b) with the least node it is connected with.

    Rounds of large and small stars until there are stars alone; each round's edges are a
    stored table. There are ``most`` edges at most, if that is known.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = edges.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    edges = stored(edges, "edges", most)
    while True:
        count, others = _shape(edges)
        if not others:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        most = 2 * count
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # A table, so that Spark may split a node with many edges in the join; so below.
        least = stored(least.select("a", F.least("a", "m").alias("m")), "least", most)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), "m").distinct()
        large = stored(large, "large", most)
        least = stored(large.groupBy("a").agg(F.min("m").alias("low")), "lowest", most)
        small = large.join(least, "a").where("m <> low").select(F.col("m").alias("a"), "low")
        edges = stored(small.union(least).toDF("a", "b").distinct(), "edges", most)


def _shape(edges: DataFrame) -> tuple[int, int]:
    """How many edges there are, and how many nodes keep them from being stars.

    In stars every ``a`` has one ``b``, which is no ``a``.
    """
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"))
    ends = ends.union(edges.select("b", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
    other = (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("low") == 0))
    return nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if(other)).first()


def sketches(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """(id, text_key, node, size, sketch) of each row; node is null for a text without words."""
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text_column).alias("text_key"),
        F.make_valid_utf8(text_column).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, hashes, ends in shingle_chunks(batch.column(2), width):
                sizes = np.diff(ends)
                full = np.flatnonzero(sizes)
                values = minhash(hashes, ends[full]) if len(full) else None
                nodes, counts = [None] * len(sizes), np.zeros(len(sizes), np.int64)
                sketch = [None] * len(sizes)
                for k, row in enumerate(full):
                    distinct = np.unique(hashes[ends[row] : ends[row + 1]])
                    nodes[row] = hashlib.blake2b(distinct.tobytes(), digest_size=16).digest()
                    counts[row] = len(distinct)
                    sketch[row] = values[k].tobytes()
                part = batch.slice(first, len(sizes))
                columns = [*part.columns[:2], pa.array(nodes, pa.binary()), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sketch, pa.binary())],
                    ["id", "text_key", "node", "size", "sketch"],
                )

    return rows.mapInArrow(
        run, f"id {kind}, text_key long, node binary, size long, sketch binary"
    )


def _short(node: str = "node"):
    """The first half of a node's hash, enough to find candidates by."""
    return F.conv(F.hex(F.substring(node, 1, 7)), 16, 10).cast("long")


def _candidate_edges(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(a, b): edges that connect what the pruning leaves, from (short, sketch)."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    size = 2 * ROWS
    part = F.substring(F.col("sketch"), F.col("band") * size + 1, F.lit(size))
    slots = nodes.select("short", "sketch", band).select(
        F.xxhash64("band", part).alias("bucket"), "short"
    )
    # Buckets with the same members in several bands are looked at once.
    buckets = slots.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.bit_xor("short").alias("x"),
        F.bit_xor(F.xxhash64("short")).alias("y"),
        F.min("short").alias("lead"),
        F.max("short").alias("last"),
    )
    buckets = buckets.where("n > 1").groupBy("n", "x", "y", "lead", "last")
    buckets = buckets.agg(F.min("bucket").alias("bucket"))
    most = BANDS * nodes.count()
    chosen = stored(buckets.select("bucket", "n", "lead"), "buckets", most)
    members = slots.join(chosen, "bucket").join(nodes, "short")
    members = stored(members.select("bucket", "n", "lead", "short", "sketch"), "members", most)
    few = _tasks(members, members.count(), TILE_ROWS, 4)
    fewest = fewest_matches(threshold, tolerance)

    def pairs(batches):
        for table, bounds in whole_groups(batches, ["bucket", "i", "j"]):
            short = table["short"].to_numpy()
            side = table["side"].to_numpy()
            values = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16)
            values = values.reshape(-1, VALUES)
            left, right = _pairs_of(bounds, side)
            keep = surviving(values, left, right, fewest)
            # Equal nodes of several buckets count as connected.
            _, same = np.unique(short, return_inverse=True)
            root = roots(int(same.max()) + 1, same[left[keep]], same[right[keep]])
            name = np.zeros(len(root), np.int64)
            name[same] = short
            out = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[out]), pa.array(name[root[out]])], ["a", "b"]
            )

    def tiles(dealt: DataFrame) -> DataFrame:
        dealt = dealt.sortWithinPartitions("bucket", "i", "j")
        return dealt.select("bucket", "i", "j", "side", "short", "sketch").mapInArrow(
            pairs, "a long, b long"
        )

    small = members.where(F.col("n") <= TILE)
    small = small.select("*", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
    edges = tiles(small.repartition("bucket", "i", "j").coalesce(few))
    # In a larger bucket all are held against the least first; only pairs with one that
    # does not match it are left to compare, block against block.
    large = members.where(F.col("n") > TILE)
    if large.isEmpty():
        return edges
    leads = nodes.select(F.col("short").alias("lead"), F.col("sketch").alias("lead_sketch"))

    def against_lead(batches):
        for batch in batches:
            both = [
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, VALUES)
                for k in (3, 4)
            ]
            count = len(both[0])
            keep = surviving(
                np.concatenate(both), np.arange(count), np.arange(count) + count, fewest
            )
            met = np.zeros(count, bool)
            met[keep] = True
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], batch.column(5), pa.array(met)],
                ["bucket", "lead", "short", "sketch", "n", "met"],
            )

    held = large.join(leads, "lead").select(
        "bucket", "lead", "short", "sketch", "lead_sketch", "n"
    )
    held = held.mapInArrow(
        against_lead,
        "bucket long, lead long, short long, sketch binary, n long, met boolean",
    )
    held = stored(held, "held")
    edges = edges.union(held.where("met").select(F.col("short").alias("a"), F.col("lead").alias("b")))
    rest = held.where(~F.col("met"))
    if rest.isEmpty():
        return edges
    open_ = rest.groupBy("bucket").agg(F.count("*").alias("open"))
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    lines = F.ceil(F.col("open") / TILE).cast("int")

    def spread(column):
        return F.explode(F.sequence(F.lit(0), column - 1))

    def block(of):
        return F.pmod(F.xxhash64("short"), of).cast("int")

    ours = rest.join(open_, "bucket").select(
        "bucket", block(lines).alias("i"), spread(blocks).alias("j"), "short", "sketch"
    )
    theirs = held.join(open_, "bucket").select(
        "bucket", spread(lines).alias("i"), block(blocks).alias("j"), "short", "sketch"
    )
    crossed = ours.withColumn("side", F.lit(1)).unionByName(theirs.withColumn("side", F.lit(2)))
    return edges.union(tiles(crossed.repartition("bucket", "i", "j")))


def _pairs_of(bounds: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of each group: all if side is 0, else those of 1 with those of 2."""
    starts, sizes = bounds[:-1], np.diff(bounds)
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    whole = side[starts] == 0
    for size in np.unique(sizes[whole]):
        i, j = np.triu_indices(size, 1)
        at = starts[whole & (sizes == size)]
        lefts.append((at[:, None] + i).ravel())
        rights.append((at[:, None] + j).ravel())
    for group in np.flatnonzero(~whole):
        rows = np.arange(bounds[group], bounds[group + 1])
        ours, theirs = rows[side[rows] == 1], rows[side[rows] == 2]
        lefts.append(np.repeat(ours, len(theirs)))
        rights.append(np.tile(theirs, len(ours)))
    return np.concatenate(lefts), np.concatenate(rights)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets."""
    sizes = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    rows = rows[keep]
    column = (np.cumsum(shared) - 1)[column[keep]]
    total = np.zeros((len(sets), len(sets)), np.float64)
    step = max(256, (4 << 20) // max(1, len(sets)))
    for low in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((len(sets), min(step, int(shared.sum()) - low)), np.float32)
        part[rows[a:b], column[a:b] - low] = 1
        total += part @ part.T
    return np.rint(total).astype(np.int64)


def _verified(batches, ratio: Fraction):
    """Linked texts of each node in its tile, and a node it is linked with directly or not."""
    for table, bounds in whole_groups(batches, ["root", "i", "j"]):
        node = table["node"].to_pylist()
        block, i, j = (table[c].to_numpy() for c in ("block", "i", "j"))
        whole = table["whole"].to_pylist()
        grams, texts = table["ngrams"], table["texts"].to_numpy()
        out = {"node": [], "links": [], "peer": [], "whole": []}
        for low, high in zip(bounds[:-1], bounds[1:]):
            # Repeated rows of the documents bring a node more than once.
            rows = list({node[row]: row for row in range(low, high)}.values())
            sets = [np.frombuffer(grams[row].as_py(), np.uint64) for row in rows]
            common = _common(sets)
            sizes = np.array([len(s) for s in sets])
            union = sizes[:, None] + sizes[None, :] - common
            linked = common * ratio.denominator >= ratio.numerator * union
            np.fill_diagonal(linked, False)
            if i[low] != j[low]:
                first = block[rows] == i[low]
                linked &= first[:, None] != first[None, :]
            left, right = np.nonzero(linked)
            root = roots(len(rows), left, right)
            out["node"] += [node[row] for row in rows]
            out["links"] += (linked @ texts[rows]).tolist()
            out["peer"] += [node[rows[r]] for r in root]
            out["whole"] += [whole[low]] * len(rows)
        kinds = [pa.binary(), pa.int64(), pa.binary(), pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out)
        )


def classes(
    docs: DataFrame,
    id_column="doc_id",
    text_column="text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(id, text_key, class_id, n_links, n_ngrams) of every row.

    ``n_links`` is the number of other texts in the corpus with a Jaccard similarity of at
    least ``threshold``, those with an equal n-gram set among them; rows with an equal text
    are one and not counted. ``class_id`` is
    the least id of all rows connected by links or equal sets. A text without words (null,
    empty, white space) has no n-grams and no links and is its own class. A text of fewer
    words than ``width`` has one n-gram. Words are in lower case between white space.
    Repeated rows get equal results; ``text_key`` is the text's xxhash64, which tells rows
    of one id apart. Null ids come last in a class. Other columns are not read.
    """
    rows = stored(sketches(docs, id_column, text_column, width), "sketches")
    nodes = rows.where("node is not null").groupBy("node")
    nodes = nodes.agg(F.first("sketch").alias("sketch"), F.first("size").alias("size"))
    nodes = nodes.select("node", "size", "sketch", _short().alias("short"))
    most = rows.count()
    nodes = stored(nodes, "nodes", most)
    texts = rows.where("node is not null").select("node", "text_key").distinct()
    texts = stored(texts.groupBy("node").agg(F.count("*").alias("texts")), "texts", most)
    edges = _candidate_edges(nodes.select("short", "sketch"), threshold, tolerance)
    grouped = components(edges).withColumnRenamed("node", "short")
    grouped = stored(nodes.drop("sketch").join(grouped, "short"), "grouped", nodes.count())
    sizes = grouped.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    sizes = sizes.where("n > 1").select(
        "root",
        F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("total") / TILE_NGRAMS))
        .cast("int")
        .alias("blocks"),
    )
    # The texts of one row per grouped node are cut into n-grams once more.
    chosen = rows.where("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "text_key")).alias("row")
    )
    chosen = chosen.join(grouped.join(sizes, "root"), "node").join(texts, "node").select(
        F.col("row.id").alias("chosen_id"),
        F.col("row.text_key").alias("chosen_key"),
        "node",
        "root",
        "blocks",
        "texts",
    )
    whole = docs.select(
        F.col(id_column).alias("id"), F.make_valid_utf8(text_column).alias("text"),
        F.xxhash64(text_column).alias("text_key"),
    )
    whole = whole.join(
        chosen, whole["id"].eqNullSafe(chosen["chosen_id"]) & (F.col("text_key") == F.col("chosen_key"))
    ).select("node", "root", "blocks", "texts", "text")

    def cut(batches):
        for batch in batches:
            for first, hashes, ends in shingle_chunks(batch.column(4), width):
                grams = [np.unique(hashes[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
                part = batch.slice(first, len(grams))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array(grams, pa.binary())],
                    ["node", "root", "blocks", "texts", "ngrams"],
                )

    sets = whole.mapInArrow(cut, "node binary, root long, blocks int, texts long, ngrams binary")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sets = sets.select("*", own).select("*", other)
    tiles = sets.select(
        "root",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        (F.col("blocks") == 1).alias("whole"),
        "node",
        "texts",
        "ngrams",
    )
    tiles = tiles.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    ratio = Fraction(str(threshold))
    found = tiles.mapInArrow(
        lambda batches: _verified(batches, ratio),
        "node binary, links long, peer binary, whole boolean",
    )
    found = stored(found, "found")
    most = found.count()
    links = found.groupBy("node").agg(
        F.sum("links").alias("n_links"),
        F.min("peer").alias("peer"),
        F.first("whole").alias("whole"),
    )
    wide = found.where(~F.col("whole"))
    if not wide.isEmpty():
        joined = components(wide.select(F.col("node").alias("a"), F.col("peer").alias("b")), most)
        links = links.join(joined, "node", "left").select(
            "node", "n_links", F.when(F.col("whole"), F.col("peer")).otherwise(
                F.coalesce("root", "node")
            ).alias("peer")
        )
    # Tables of their own, here and below, so that Spark may split a node or class with many
    # rows in the join.
    links = stored(texts.join(links.select("node", "n_links", "peer"), "node", "left"), "links")
    rows = rows.select("id", "text_key", "node", "size").join(links, "node", "left")
    rows = rows.select(
        "id",
        "text_key",
        "node",
        F.coalesce("peer", "node").alias("class"),
        (F.coalesce("n_links", F.lit(0)) + F.coalesce("texts", F.lit(1)) - 1).alias("n_links"),
        F.col("size").alias("n_ngrams"),
    )
    rows = stored(rows, "classes")
    least = rows.where("class is not null").groupBy("class").agg(F.min("id").alias("least"))
    least = stored(least, "least")
    return rows.join(least, "class", "left").select(
        F.col("id").alias(id_column),
        "text_key",
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("least")).alias("class_id"),
        "n_links",
        "n_ngrams",
    )


def deduplicated(docs: DataFrame, id_column="doc_id", text_column="text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class: the one with the least id.

    Of rows without words each id stays. Of equal rows one stays; where rows of one id have
    different texts in one class, the one with the least text hash stays.
    """
    found = classes(docs, id_column, text_column, **options)
    own = found.where(F.col(id_column).eqNullSafe(F.col("class_id")))
    kept = own.groupBy("class_id", F.col("n_ngrams") > 0).agg(
        F.min("text_key").alias("kept_key"), F.count("*").alias("n")
    )
    # Names that no input has, as the condition looks at both sides.
    kept = kept.toDF("id of class", "n-grams of class", "text key of class", "n")
    kept = stored(kept.drop("n-grams of class"), "kept")
    match = docs[id_column].eqNullSafe(F.col("id of class")) & (
        F.xxhash64(docs[text_column]) == F.col("text key of class")
    )
    single = docs.join(kept.where("n = 1"), match, "left_semi")
    repeated = kept.where("n > 1")
    if repeated.isEmpty():
        return single
    again = docs.join(repeated, match, "left_semi").dropDuplicates([id_column, text_column])
    return single.unionByName(again)
