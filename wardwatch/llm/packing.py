"""Packing of token sequences as a cutting-stock problem, by column generation.

Documents are cut into full sequences and one remainder each. The histogram of remainder
lengths is the demand of a linear program whose columns are patterns: ways to fill a sequence
exactly. Columns are found by a knapsack recursion over the dual prices. The solution is
rounded down, and each pattern's slots are given to the documents of a length by rank.
What no pattern takes is laid end to end and cut at the sequence bounds, and the last, short
stretch is cut into powers of two, so that nothing has to be padded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.llm.wordids import encoded_chunks, word_ids
from wardwatch.session import scratch_path

LENGTH = 1024
END = 0

# The program is solved up to this relative distance from its bound.
GAP = 0.01
ROUNDS = 600


def cheapest_pattern(prices: np.ndarray, lengths: np.ndarray, size: int):
    """Cost and lengths (as places) of the cheapest way to fill ``size`` exactly."""
    cost = np.full(size + 1, np.inf)
    cost[0] = 0
    last = np.full(size + 1, -1, np.int64)
    for filled in range(1, size + 1):
        usable = int(np.searchsorted(lengths, filled, "right"))
        if usable:
            choice = cost[filled - lengths[:usable]] + prices[:usable]
            best = int(choice.argmin())
            cost[filled], last[filled] = choice[best], best
    used, filled = [], size
    if np.isfinite(cost[size]):
        while filled:
            used.append(int(last[filled]))
            filled -= int(lengths[last[filled]])
    return cost[size], used


def patterns(lengths: np.ndarray, demand: np.ndarray, size: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used: (pieces per length, times).

    Maximises the number of exactly filled sequences with no length used more often than
    demanded: revised simplex steps from the basis of slacks and pairs, one new column each.
    """
    count = len(lengths)
    if not count:
        return []
    place = {int(length): k for k, length in enumerate(lengths)}
    inverse, gain = np.eye(count), np.zeros(count)
    columns = [np.zeros(count) for _ in range(count)]  # of the basis; a slack has gain 0
    for k in range(count):
        columns[k][k] = 1
    for length, k in place.items():
        other = place.get(size - length)
        if other is None or other < k:
            continue
        few, many = (k, other) if demand[k] <= demand[other] else (other, k)
        columns[few] = np.zeros(count)
        columns[few][few] += 1
        columns[few][many] += 1
        gain[few] = 1
        inverse[few, few] = 1 / columns[few][few]
        if many != few:
            inverse[many, few] = -1
    amount = inverse @ demand
    for _ in range(ROUNDS):
        prices = gain @ inverse
        slack = int(prices.argmin())
        if prices[slack] < -1e-9:  # the slack of this length comes in
            column, worth = np.eye(count)[slack], 0.0
        else:
            cost, used = cheapest_pattern(np.maximum(prices, 0), lengths, size)
            if not cost < 1 - GAP:
                break
            column, worth = np.bincount(used, minlength=count).astype(float), 1.0
        step = inverse @ column
        up = step > 1e-9
        if not up.any():
            break
        limits = np.where(up, np.maximum(amount, 0) / np.where(up, step, 1), np.inf)
        out = int(limits.argmin())
        moved = limits[out]
        amount -= moved * step
        amount[out] = moved
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        gain[out], columns[out] = worth, column
    left = demand.astype(np.int64).copy()
    chosen: dict[bytes, list] = {}
    order = np.argsort(-(amount - np.floor(amount)), kind="stable")
    for extra in (False, True):  # rounded down, then one more where it fits
        for k in order:
            if gain[k] != 1:
                continue
            pieces = columns[k].astype(np.int64)
            used = pieces > 0
            most = int((left[used] // pieces[used]).min())
            times = min(most, 1 if extra else int(np.floor(max(amount[k], 0) + 1e-6)))
            if times:
                left -= times * pieces
                chosen.setdefault(pieces.tobytes(), [pieces, 0])[1] += times
    return [(pieces, times) for pieces, times in chosen.values()]


@dataclass
class Plan:
    """Where the piece of a length and rank goes.

    Per length an entry for each pattern: first rank, first sequence, pieces per sequence,
    offset of the first; then the ranks that patterns take, and where the rest begins.
    """

    size: int
    entries: dict[int, np.ndarray]
    taken: dict[int, int]
    rest_at: dict[int, int]
    first: int
    full: int
    tail: np.ndarray

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, length) of the parts that the piece is cut into."""
        if rank < self.taken[length]:
            rows = self.entries[length]
            row = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
            copy, slot = divmod(rank - int(row[0]), int(row[2]))
            return [(int(row[1]) + copy, int(row[3]) + slot * length, length)]
        at = self.rest_at[length] + (rank - self.taken[length]) * length
        parts = []
        while length:
            if at < self.full * self.size:
                number, offset = divmod(at, self.size)
                room = self.size - offset
            else:
                beyond = at - self.full * self.size
                k = int(np.searchsorted(self.tail, beyond, "right")) - 1
                number, offset = self.full + k, beyond - int(self.tail[k])
                room = int(self.tail[k + 1]) - beyond
            part = min(length, room)
            parts.append((self.first + number, offset, part))
            at, length = at + part, length - part
        return parts


def planned(histogram: dict[int, int], size: int, first: int) -> Plan:
    """A plan for this many pieces of each length; sequences are numbered from ``first``."""
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(k)] for k in lengths], np.int64)
    entries: dict[int, list] = {int(length): [] for length in lengths}
    taken = {int(length): 0 for length in lengths}
    for pieces, times in patterns(lengths, demand, size):
        offset = 0
        for k in np.flatnonzero(pieces):
            length = int(lengths[k])
            entries[length].append((taken[length], first, int(pieces[k]), offset))
            taken[length] += int(pieces[k]) * times
            offset += int(pieces[k]) * length
        first += times
    rest_at, at = {}, 0
    for length, count in zip(lengths.tolist(), demand.tolist()):
        rest_at[length] = at
        at += (count - taken[length]) * length
    full, short = divmod(at, size)
    powers = [1 << bit for bit in reversed(range(short.bit_length())) if short >> bit & 1]
    tail = np.concatenate([[0], np.cumsum(powers, dtype=np.int64)])
    tables = {k: np.array(rows, np.int64).reshape(-1, 4) for k, rows in entries.items()}
    return Plan(size, tables, taken, rest_at, first, full, tail)


def _encoded(docs: DataFrame, path: str, id_column: str, text_column: str, end: int, size: int):
    """Stored rows (id, part, ids, tokens, rest, rank, before).

    Rows of a task are numbered: ``rank`` among those with an equal remainder ``rest``,
    ``before`` counts the full sequences of earlier rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        encoder = word_ids(path)
        part = TaskContext.get().partitionId()
        ranks, before = np.zeros(size, np.int64), 0
        for batch in batches:
            for first, ids, bounds in encoded_chunks(batch.column(1), encoder):
                rows = len(bounds) - 1
                tokens = np.diff(bounds) + 1
                closed = np.insert(ids, bounds[1:], np.uint32(end)).astype("<u4")
                offsets = np.concatenate([[0], np.cumsum(tokens * 4)]).astype(np.int32)
                rest = tokens % size
                rank = np.empty(rows, np.int64)
                for row, length in enumerate(rest.tolist()):
                    rank[row] = ranks[length]
                    ranks[length] += 1
                full = np.cumsum(tokens // size)
                columns = [
                    batch.column(0).slice(first, rows),
                    pa.array(np.full(rows, part, np.int32)),
                    pa.BinaryArray.from_buffers(
                        pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(closed)]
                    ),
                    pa.array(tokens),
                    pa.array(rest),
                    pa.array(rank),
                    pa.array(before + full - tokens // size),
                ]
                before += int(full[-1])
                names = ["id", "part", "ids", "tokens", "rest", "rank", "before"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.col(id_column).alias("id"), F.make_valid_utf8(text_column).alias("text")
    ).mapInArrow(
        run,
        f"id {kind}, part int, ids binary, tokens long, rest long, rank long, before long",
    )
    folder = scratch_path(docs.sparkSession, "tokens")
    rows.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def pack(
    docs: DataFrame,
    path: str,
    id_column="doc_id",
    text_column="text",
    size: int = LENGTH,
    end: int = END,
) -> DataFrame:
    """Pieces (id, start, length, ids, doc_tokens, sequence_id, offset) of all documents.

    A document is its text's ids and ``end``; ``ids`` are little-endian unsigned 32-bit.
    Every row is a document of its own, also repeated rows and null ids. A null text is
    empty and gives the end alone. Sequences have ``size`` tokens, or a power of two of
    them; none is padded. An empty table gives no piece. Other columns are not read.
    """
    rows = _encoded(docs, path, id_column, text_column, end, size)
    counts = rows.groupBy("part", "rest").agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("tokens") / size)).alias("full")
    )
    folder = scratch_path(docs.sparkSession, "lengths")
    counts.write.parquet(folder)
    counts = docs.sparkSession.read.parquet(folder)
    # At most ``size`` rows.
    totals = counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("full").alias("full"))
    totals = totals.collect()
    histogram = {row.rest: row.n for row in totals if row.rest}
    plan = planned(histogram, size, sum(row.full for row in totals))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = F.coalesce(F.sum("n").over(earlier.partitionBy("rest")), F.lit(0))
    bases = counts.select("part", "rest", ranks.alias("base")).groupBy("part")
    bases = bases.agg(F.map_from_entries(F.collect_list(F.struct("rest", "base"))).alias("bases"))
    # One row per task of the encoding.
    fulls = counts.groupBy("part").agg(F.sum("full").alias("full"))
    fulls = fulls.select(
        "part", F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("full_base")
    )
    placed = rows.join(bases.join(fulls, "part"), "part").select(
        "id",
        "ids",
        "tokens",
        "rest",
        (F.col("rank") + F.element_at("bases", F.col("rest"))).alias("rank"),
        (F.col("before") + F.col("full_base")).alias("before"),
    )
    schema = T.StructType(
        [
            docs.schema[id_column],
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def cut(batches):
        for batch in batches:
            tokens, rest, rank, before = (batch.column(k).to_pylist() for k in range(2, 6))
            row_of, starts, lengths, ids, sequences, offsets = [], [], [], [], [], []
            for row in range(batch.num_rows):
                full = tokens[row] // size
                parts = [(before[row] + k, 0, size) for k in range(full)]
                if rest[row]:
                    parts += plan.place(rest[row], rank[row])
                data, at = batch.column(1)[row].as_buffer(), 0
                for sequence, offset, length in parts:
                    row_of.append(row)
                    starts.append(at)
                    lengths.append(length)
                    ids.append(data.slice(4 * at, 4 * length).to_pybytes())
                    sequences.append(sequence)
                    offsets.append(offset)
                    at += length
            taken = pa.array(row_of, pa.int64())
            columns = [batch.column(0).take(taken), pa.array(starts, pa.int64())]
            columns += [pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())]
            columns += [batch.column(2).take(taken), pa.array(sequences, pa.int64())]
            columns += [pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return placed.mapInArrow(cut, schema)
