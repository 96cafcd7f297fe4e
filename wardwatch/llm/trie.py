"""The trie of conversation prefixes, through z-fast tries of batches of conversations.

A node is a sequence of first turns, known by a 128-bit hash that is the xor of a hash per
(depth, role, text). Tasks take conversations in order of their ids and insert them, batch by
batch, into a z-fast trie: compacted nodes lie in a hash table at the two-fattest depth of
their edge, a conversation's exit node is found by fat binary search over its prefix hashes,
and the edge is split there. Edges are then expanded to one row per node, with sums over the
batch's conversations, so a turn that a third of all conversations begin with is one row per
batch. What the batches found is added up by hash.

Sums over subtrees need no walk. The smallest conversation of a node owns it, and what a
conversation owns is the rest of its path from some depth on. So a node has as many leaves
as members that own a leaf, and saves the words of its members' turns before they own them;
both are sums over members, found by a second pass of the same tries.

No conversation is held whole: it is numbered in range partitions, which may cut it, and goes
into the trie in stretches of ``STRETCH`` turns, each below a root of its own.

Defined results: rows without a conversation id take no part; null roles and texts are empty;
turns of equal number come in order of role and text (by its first 64 characters, then its
hash); repeated rows are repeated turns; empty tables give no nodes; other columns are unused.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardwatch.session import scratch_path

# Turns of a conversation that go into a trie together, and turns of a batch.
STRETCH = 4096
BATCH = 200_000

# Conversations of a family begin with turns of its first one.
FAMILY = 20
HEADS = 4

NODE = "k1 long, k2 long, p1 long, p2 long, depth long, words long, n long, conv_id long, ends array<long>"
SUMS = "k1 long, k2 long, leaves long, saved long"


def nodes(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    stretch: int = STRETCH,
    batch: int = BATCH,
) -> DataFrame:
    """A row per node of the rebuilt conversations' trie.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent, ``n_convs``,
    ``n_children`` and ``n_leaves`` count members, children and leaves below; ``saved_tokens``
    are the words of repeated turns below, ``ends_sha256`` the digest of the members' ids
    that have no further turn.
    """
    spark = turns.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"trie-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    laid = _numbered(turns, conv_id, turn, role, text, stored)
    convs = stored(_families(laid), "conversations")
    rebuilt = stored(_rebuilt(laid, convs, stretch), "rebuilt")
    rebuilt = _with_offsets(rebuilt, convs, stretch, stored)

    local = stored(_in_tries(rebuilt, _node_rows(stretch, batch), NODE), "local")
    found = local.groupBy("k1", "k2").agg(
        *[F.min(name).alias(name) for name in ("p1", "p2", "depth", "words", "conv_id")],
        F.sum("n").alias("n_convs"),
    )
    found = stored(found, "nodes")
    below = found.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    found = found.join(below.agg(F.count("*").alias("n_children")), ["k1", "k2"], "left")
    found = stored(found.fillna(0, "n_children"), "branches")

    facts = stored(_ownership(found, rebuilt), "owned")
    sums = _in_tries(rebuilt.join(facts, "conv_id", "left"), _sum_rows(stretch, batch), SUMS)
    sums = sums.groupBy("k1", "k2").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    parents = found.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        found.join(sums, ["k1", "k2"], "left")
        .join(_digests(local), ["k1", "k2"], "left")
        .join(parents, ["p1", "p2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def _numbered(turns: DataFrame, conv_id, turn, role, text, stored) -> DataFrame:
    """(conv, pos, t1, t2, words): turns by their place from 0, whatever a conversation's size.

    Rows are laid out by range, which may cut a conversation, numbered inside the pieces,
    and moved by what the pieces before hold of the conversation.
    """
    own = turns.select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.monotonically_increasing_id()).alias("spread"),
    ).where("conv IS NOT NULL")
    own = own.select(
        "conv",
        "turn",
        "role",
        F.left("text", F.lit(64)).alias("begin"),
        F.xxhash64("role", "text").alias("t1"),
        F.xxhash64("text", F.lit(1), "role").alias("t2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        "spread",
    )
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("begin"), F.asc("t1"), F.asc("spread")]
    laid = own.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = laid.select("conv", "t1", "t2", "words").mapInArrow(
        _places, "conv long, piece long, place long, t1 long, t2 long, words long"
    )
    placed = stored(placed, "turns")
    counts = placed.groupBy("conv", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.withColumn("before", F.sum("n").over(before)).where("before > 0")
    joined = placed.join(moved.drop("n"), ["conv", "piece"], "left")
    pos = F.col("place") + F.coalesce("before", F.lit(0))
    return joined.select("conv", pos.alias("pos"), "t1", "t2", "words")


def _places(batches):
    """Numbers the rows of each conversation in a partition, in the order they come."""
    from pyspark import TaskContext

    piece, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        first = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
        size = np.diff(np.append(first, len(conv)))
        place = np.arange(len(conv)) - np.repeat(first, size)
        if conv[0] == last:
            place[: size[0]] += seen
        last, seen = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.full(len(conv), piece, np.int64)),
                pa.array(place),
                *batch.columns[1:],
            ],
            ["conv", "piece", "place", "t1", "t2", "words"],
        )


def _families(laid: DataFrame) -> DataFrame:
    """(conv, base, skipped, taken, length): what each conversation takes of its family's first.

    It loses its own first ``skipped`` turns and begins with ``taken`` turns of ``base``.
    """
    sizes = laid.groupBy("conv").agg(F.count("*").alias("own"))
    skipped = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    family = sizes.withColumns({"base": F.col("conv") - F.col("conv") % FAMILY, "skipped": skipped})
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("in_base"))
    taken = F.least("skipped", F.coalesce("in_base", F.lit(0)))
    rest = F.greatest(F.col("own") - F.col("skipped"), F.lit(0))
    return family.join(bases, "base", "left").select(
        "conv", "base", "skipped", taken.alias("taken"), (taken + rest).alias("length")
    )


def _rebuilt(laid: DataFrame, convs: DataFrame, stretch: int) -> DataFrame:
    """(conv_id, stretch, depth, z1, z2, words, more): turns from depth 1; depth 0 if there are none.

    ``more`` is 1 where the conversation goes on after the stretch.
    """
    own = laid.join(convs, "conv").where(F.col("pos") >= F.col("skipped"))
    own = own.withColumn("depth", F.col("pos") - F.col("skipped") + F.col("taken") + 1)
    heads = laid.where((F.col("pos") < HEADS) & (F.col("conv") % FAMILY == 0))
    heads = heads.withColumnRenamed("conv", "base").join(convs, "base")
    heads = heads.where(F.col("pos") < F.col("taken")).withColumn("depth", F.col("pos") + 1)
    columns = ["conv", "depth", "t1", "t2", "words", "length"]
    none = convs.where("length = 0").select(
        "conv", *[F.lit(0).cast("long").alias(name) for name in columns[1:]]
    )
    rows = own.select(columns).unionByName(heads.select(columns)).unionByName(none)
    real = F.col("depth") > 0
    part = F.when(real, F.floor((F.col("depth") - 1) / stretch)).otherwise(0).cast("long")

    def hashed(*parts: str | Column) -> Column:
        return F.when(real, F.xxhash64(*parts)).otherwise(F.lit(0).cast("long"))

    return rows.select(
        F.col("conv").alias("conv_id"),
        part.alias("stretch"),
        "depth",
        hashed("depth", "t1", "t2").alias("z1"),
        hashed("t2", "t1", "depth").alias("z2"),
        "words",
        (F.col("length") > (part + 1) * stretch).cast("long").alias("more"),
    )


def _with_offsets(rebuilt: DataFrame, convs: DataFrame, stretch: int, stored) -> DataFrame:
    """Adds ``x1``, ``x2``, ``w0``: hash and words of the turns before a row's stretch."""
    long = convs.where(F.col("length") > stretch).select(F.col("conv").alias("conv_id"))
    sums = rebuilt.join(long, "conv_id", "left_semi").groupBy("conv_id", "stretch")
    sums = sums.agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.sum("words").alias("words"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "conv_id",
        "stretch",
        F.bit_xor("z1").over(before).alias("x1"),
        F.bit_xor("z2").over(before).alias("x2"),
        F.sum("words").over(before).alias("w0"),
    ).where("stretch > 0")
    offsets = stored(offsets, "offsets")
    return rebuilt.join(offsets, ["conv_id", "stretch"], "left").fillna(0, ["x1", "x2", "w0"])


def _ownership(found: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(conv_id, owns, leaf, tot) of conversations that own a leaf or have turns they do not own.

    ``owns`` is the depth from which on a conversation owns its nodes (null: none), ``leaf``
    is 1 for those that own a leaf, ``tot`` are the words of the turns before ``owns``.
    """
    mine = found.groupBy("conv_id").agg(
        F.min(F.when(F.col("depth") > 0, F.col("depth"))).alias("owns"),
        F.max((F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    before = F.coalesce(F.col("depth") < F.col("owns"), F.lit(True))
    return (
        rebuilt.select("conv_id", "depth", "words")
        .join(mine, "conv_id", "left")
        .groupBy("conv_id")
        .agg(
            F.min("owns").alias("owns"),
            F.coalesce(F.max("leaf"), F.lit(0)).alias("leaf"),
            F.sum(F.when(before, F.col("words")).otherwise(0)).alias("tot"),
        )
    )


def _in_tries(rebuilt: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over stretches in order of their conversations; none is cut."""
    extra = [F.col(name) for name in ("owns", "leaf", "tot") if name in rebuilt.columns]
    rows = rebuilt.select(
        "conv_id", "stretch", "depth", "z1", "z2", "words", "more", "x1", "x2", "w0", *extra
    )
    laid = rows.repartitionByRange("conv_id", "stretch").sortWithinPartitions("conv_id", "depth")
    return laid.mapInArrow(run, schema)


@dataclass
class Stretches:
    """Stretches of a batch: ``conv``, ``top`` (the depth above) and slices of the turns."""

    conv: np.ndarray
    top: np.ndarray
    low: np.ndarray
    high: np.ndarray
    # By turn: 128-bit keys of the prefixes up to and before it, words of it and before it.
    keys: np.ndarray
    before: np.ndarray
    words: np.ndarray
    words_before: np.ndarray
    # By stretch: key of the prefix above, and the columns of the second pass.
    above: np.ndarray
    facts: pa.RecordBatch


def _batches(batches, stretch: int, size: int):
    """Stretches in groups of about ``size`` turns, cut between stretches only."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < size:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        conv, part = table.column("conv_id").to_numpy(), table.column("stretch").to_numpy()
        change = np.flatnonzero((conv[1:] != conv[:-1]) | (part[1:] != part[:-1])) + 1
        if not len(change):
            continue
        cut = int(change[-1])
        yield _stretches(table.slice(0, cut), stretch)
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
    if held:
        yield _stretches(pa.Table.from_batches(held), stretch)


def _stretches(table: pa.Table, stretch: int) -> Stretches:
    batch = table.combine_chunks().to_batches()[0]
    of = {name: batch.column(place) for place, name in enumerate(batch.schema.names)}
    conv, part, depth = (of[n].to_numpy() for n in ("conv_id", "stretch", "depth"))
    low = np.flatnonzero(
        np.concatenate([[True], (conv[1:] != conv[:-1]) | (part[1:] != part[:-1])])
    )
    high = np.append(low[1:], len(conv))
    row = np.repeat(np.arange(len(low)), high - low)
    above = _pairs(of["x1"].to_numpy()[low], of["x2"].to_numpy()[low])

    def prefixes(column: str, start: str) -> np.ndarray:
        """Xor of the stretch up to each turn: of all turns, less what came before."""
        z = of[column].to_numpy()
        total = np.bitwise_xor.accumulate(z)
        return total ^ (total[low] ^ z[low])[row] ^ of[start].to_numpy()

    keys = _pairs(prefixes("z1", "x1"), prefixes("z2", "x2"))
    before = np.concatenate([keys[:1], keys[:-1]])
    before[low] = above
    words = of["words"].to_numpy()
    total = np.cumsum(words) - words
    words_before = total - total[low][row] + of["w0"].to_numpy()
    empty = depth[low] == 0  # a conversation without turns
    return Stretches(
        conv[low], part[low] * stretch, low, np.where(empty, low, high),
        keys, before, words, words_before, above, batch.take(pa.array(low)),
    )


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """(n, 2) keys; as one value of 16 bytes in ``_names``."""
    return np.ascontiguousarray(np.stack([first, second], axis=1).astype(np.int64))


def _names(keys: np.ndarray) -> list[bytes]:
    data = keys.tobytes()
    return [data[at : at + 16] for at in range(0, len(data), 16)]


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted nodes of a batch of stretches.

    Node i covers the depths (``start``, ``end``] along the stretch ``of``; a root covers
    none. ``last`` is the node in which each stretch ends.
    """

    def __init__(self, batch: Stretches):
        self.start: list[int] = []
        self.end: list[int] = []
        self.of: list[int] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self._keys = _names(batch.keys)
        self._low = batch.low.tolist()
        self._top = batch.top.tolist()
        self._handles: dict[bytes, int] = {}
        self._children: dict[bytes, int] = {}
        self._extents: dict[bytes, int] = {}
        self._roots: dict[bytes, int] = {}
        for stretch, root in enumerate(_names(batch.above)):
            self._insert(stretch, root, int(batch.high[stretch] - batch.low[stretch]))

    def _key(self, stretch: int, depth: int) -> bytes:
        return self._keys[self._low[stretch] + depth - self._top[stretch] - 1]

    def _node(self, start: int, end: int, of: int, parent: int) -> int:
        self.start.append(start)
        self.end.append(end)
        self.of.append(of)
        self.parent.append(parent)
        return len(self.start) - 1

    def _hash(self, node: int) -> None:
        """Puts a node at its handle, and below its parent."""
        low, high, of = self.start[node], self.end[node], self.of[node]
        self._handles[self._key(of, fattest(low, high))] = node
        self._children[self._key(of, low + 1)] = node

    def _exit(self, stretch: int, root: int, bottom: int) -> tuple[int, int]:
        """The deepest node that the stretch enters, and the depth where it leaves the trie."""
        node, low, high = root, self._top[stretch], bottom
        while low < high:
            probe = fattest(low, high)
            met = self._handles.get(self._key(stretch, probe))
            if met is None:
                high = probe - 1
                continue
            node, end = met, self.end[met]
            if end > bottom or self._key(stretch, end) != self._key(self.of[met], end):
                return met, self._common(stretch, met, probe, bottom)
            low = end
        low = self.end[node]
        child = self._children.get(self._key(stretch, low + 1)) if low < bottom else None
        if child is None:
            return node, low
        return child, self._common(stretch, child, low + 1, bottom)

    def _common(self, stretch: int, node: int, low: int, bottom: int) -> int:
        """The last depth, from ``low`` on, up to which stretch and edge are the same."""
        high, of = min(self.end[node], bottom), self.of[node]
        while low < high:
            middle = (low + high + 1) // 2
            if self._key(stretch, middle) == self._key(of, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def _insert(self, stretch: int, above: bytes, turns: int) -> None:
        top = self._top[stretch]
        root = self._roots.get(above)
        if root is None:
            root = self._roots[above] = self._node(top, top, stretch, -1)
        if not turns:
            self.last.append(root)
            return
        bottom = top + turns
        name = self._key(stretch, bottom)
        met = self._extents.get(name)  # a copy, or the beginning of what is there
        if met is None:
            met, depth = self._exit(stretch, root, bottom)
            if depth < self.end[met]:
                met = self._split(met, depth)
            if depth < bottom:
                met = self._node(depth, bottom, stretch, met)
                self._hash(met)
            self._extents[name] = met
        self.last.append(met)

    def _split(self, node: int, depth: int) -> int:
        """Cuts an edge; the node keeps the lower part, the new one above is returned."""
        upper = self._node(self.start[node], depth, self.of[node], self.parent[node])
        del self._handles[self._key(self.of[node], fattest(self.start[node], self.end[node]))]
        self.start[node], self.parent[node] = depth, upper
        self._hash(upper)
        self._hash(node)
        self._extents[self._key(self.of[upper], depth)] = upper
        return upper

    def summed(self, values: np.ndarray, add=np.add) -> np.ndarray:
        """By node: ``values`` (by stretch) of all stretches that pass it."""
        empty = np.iinfo(np.int64).max if add is np.minimum else 0
        total = np.full(len(self.start), empty, np.int64)
        add.at(total, np.array(self.last, int), values)
        total = total.tolist()
        join = min if add is np.minimum else int.__add__
        for node in sorted(range(len(total)), key=self.end.__getitem__, reverse=True):
            # A root ends as deep as its stretch begins: it comes after all below it.
            above = self.parent[node]
            if above >= 0:
                total[above] = join(total[above], total[node])
        return np.array(total, np.int64)

    def expanded(self, batch: Stretches) -> tuple[np.ndarray, np.ndarray]:
        """(node, turn): every depth of every edge, as a turn of the stretch it lies along."""
        start, of = np.array(self.start, int), np.array(self.of, int)
        size = np.array(self.end, int) - start
        node = np.repeat(np.arange(len(size)), size)
        step = np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size)
        first = batch.low[of] + start - batch.top[of]
        return node, first[node] + step

    def roots(self) -> np.ndarray:
        """The node of the empty prefix, if any stretch begins there."""
        return np.array([n for n, p in enumerate(self.parent) if p < 0 and self.end[n] == 0], int)


def _node_rows(stretch: int, size: int):
    def run(batches):
        for batch in _batches(batches, stretch, size):
            trie = ZFastTrie(batch)
            members = trie.summed(np.ones(len(batch.conv), np.int64))
            owner = trie.summed(batch.conv, np.minimum)
            node, turn = trie.expanded(batch)
            ends = _ends(trie, batch)
            root = trie.roots()
            depth = np.array(trie.end, int)[node] - _from_below(node)
            none = np.zeros(len(root), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([batch.keys[turn, 0], none])),
                    pa.array(np.concatenate([batch.keys[turn, 1], none])),
                    pa.array(np.concatenate([batch.before[turn, 0], none]), mask=_last(node, root)),
                    pa.array(np.concatenate([batch.before[turn, 1], none]), mask=_last(node, root)),
                    pa.array(np.concatenate([depth, none])),
                    pa.array(np.concatenate([batch.words[turn], none])),
                    pa.array(np.concatenate([members[node], members[root]])),
                    pa.array(np.concatenate([owner[node], owner[root]])),
                    pa.array(
                        [ends.get(n) if last else None for n, last in zip(node, _from_below(node) == 0)]
                        + [ends.get(n) for n in root],
                        pa.list_(pa.int64()),
                    ),
                ],
                [column.split()[0] for column in NODE.split(", ")],
            )

    return run


def _last(node: np.ndarray, root: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(len(node), bool), np.ones(len(root), bool)])


def _from_below(node: np.ndarray) -> np.ndarray:
    """How far each expanded depth is above the end of its edge."""
    if not len(node):
        return node
    end = np.flatnonzero(np.append(node[1:] != node[:-1], True))
    size = np.diff(np.concatenate([[-1], end]))
    return np.repeat(end, size) - np.arange(len(node))


def _ends(trie: ZFastTrie, batch: Stretches) -> dict[int, list[int]]:
    """By node: the conversations that end there, in order."""
    more = batch.facts.column(batch.facts.schema.get_field_index("more")).to_numpy()
    ends: dict[int, list[int]] = {}
    for stretch in np.flatnonzero(more == 0):
        ends.setdefault(trie.last[stretch], []).append(int(batch.conv[stretch]))
    return ends


def _sum_rows(stretch: int, size: int):
    def run(batches):
        for batch in _batches(batches, stretch, size):
            trie = ZFastTrie(batch)
            facts = {n: batch.facts.column(i) for i, n in enumerate(batch.facts.schema.names)}
            owns = facts["owns"].fill_null(np.iinfo(np.int64).max).to_numpy()
            tot, leaf = facts["tot"].to_numpy(), facts["leaf"].to_numpy()
            members = trie.summed(np.ones(len(batch.conv), np.int64))
            leaves, total = trie.summed(leaf), trie.summed(tot)
            # Only the smallest member of an edge can own a part of it.
            owner = np.searchsorted(batch.conv, trie.summed(batch.conv, np.minimum))
            node, turn = trie.expanded(batch)
            depth = np.array(trie.end, int)[node] - _from_below(node)
            spoken = batch.words_before[turn]
            own = owner[node]
            saved = total[node] - members[node] * spoken
            saved -= np.where(owns[own] <= depth, tot[own] - spoken, 0)
            root = trie.roots()
            none = np.zeros(len(root), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([batch.keys[turn, 0], none])),
                    pa.array(np.concatenate([batch.keys[turn, 1], none])),
                    pa.array(np.concatenate([leaves[node], leaves[root]])),
                    pa.array(np.concatenate([saved, total[root]])),
                ],
                [column.split()[0] for column in SUMS.split(", ")],
            )

    return run


def _digests(local: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): lists of ids come in order and are digested as they pass."""
    lists = local.where("ends IS NOT NULL").select("k1", "k2", "ends")
    order = ["k1", "k2", F.get("ends", F.lit(0))]
    laid = lists.repartition("k1", "k2").sortWithinPartitions(*order)
    return laid.mapInArrow(_digested, "k1 long, k2 long, ends_sha256 string")


def _digested(batches):
    key, digest = None, None
    done: list[tuple] = []

    def rows():
        return pa.RecordBatch.from_pylist(
            [dict(zip(("k1", "k2", "ends_sha256"), row)) for row in done],
            pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]),
        )

    for batch in batches:
        for k1, k2, ends in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            text = ",".join(map(str, ends))
            if (k1, k2) == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), hashlib.sha256()
            digest.update(text.encode())
        yield rows()
        done.clear()
    if key is not None:
        done.append((*key, digest.hexdigest()))
        yield rows()
