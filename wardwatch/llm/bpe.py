"""BPE by a tokenization automaton, encoding by table-driven transitions.

The automaton reads tokens and accepts just the sequences that the merges make of some text
("Constructing a BPE Tokenization DFA", Berglund, Martens and van der Merwe, 2024). It is
built from one state with an arc per byte. Each merge (a, b), in rank order, adds a gadget:
behind an arc a the arc b goes away, and where both stood a new arc ab leads to where b led.
All arcs of one token lead to one state, so a state is named by its token, and a gadget is
three numbers: the state ab starts as a copy of state b as it is at that rank, an arc ab
stands wherever an arc a stands at that rank, and the pair (a, b) is cut at that rank.
The tables below hold exactly that. Whether an arc stands is found by walking the copies
back, and found arcs are kept in a transition table.

A word has one accepted path. It is followed for many words at once, byte by byte: a trie
names the tokens that end at a byte, and of those the one whose arc leaves the state at its
start is taken. A path's labels are the text, which is how ids are decoded.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardwatch.llm.presplit import gather, special_tokens
from wardwatch.llm.wordids import WordIds, encoded_chunks

NEVER = np.int64(1) << 40
NONE = -1

# Cells (words times bytes) whose states are held at once.
CELLS = 2_000_000
# Transitions that are kept; a newer one takes the place of an older.
KEPT = 1 << 20


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [byte for byte in range(256) if byte not in set(plain)]
    signs = {chr(byte): byte for byte in plain}
    signs.update({chr(256 + place): byte for place, byte in enumerate(other)})
    return signs


class Automaton:
    """States and arcs for the merges of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.specials = special_tokens(path)
        signs = byte_signs()
        size = max([*vocab.values(), *self.specials.values()]) + 1
        labels = [b""] * size
        for token, number in vocab.items():
            labels[number] = bytes(signs[sign] for sign in token)
        for content, number in self.specials.items():
            labels[number] = content.encode()
        self.labels = np.frombuffer(b"".join(labels), np.uint8)
        self.label_lengths = np.array([len(label) for label in labels], np.int64)
        self.label_starts = np.cumsum(self.label_lengths) - self.label_lengths
        self._compile(vocab, merges, size)
        self._compile_trie(vocab, labels)
        self.kept_keys = np.full(KEPT, NONE, np.int64)
        self.kept_arcs = np.zeros(KEPT, bool)

    def _compile(self, vocab: dict, merges: list, size: int) -> None:
        """One gadget per merge."""
        self.start = size
        self.born = np.full(size + 1, -1, np.int64)
        self.left = np.full(size + 1, NONE, np.int64)
        self.right = np.full(size + 1, NONE, np.int64)
        pairs = np.zeros(len(merges), np.int64)
        for rank, (left, right) in enumerate(merges):
            merged = vocab[left + right]
            if self.born[merged] >= 0:
                raise ValueError(f"two merges make {left + right!r}")
            self.born[merged] = rank
            self.left[merged], self.right[merged] = vocab[left], vocab[right]
            pairs[rank] = (vocab[left] << 32) | vocab[right]
        # Cut pairs as an open hash table.
        self.cut_bits = max(4, int(len(merges) * 4).bit_length())
        self.cut_keys = np.full(1 << self.cut_bits, NONE, np.int64)
        self.cut_ranks = np.full(1 << self.cut_bits, NEVER, np.int64)
        todo = np.arange(len(pairs))
        place = self._place(pairs)
        while len(todo):
            free = self.cut_keys[place[todo]] == NONE
            spots, chosen = np.unique(place[todo[free]], return_index=True)
            taken = todo[free][chosen]
            self.cut_keys[spots], self.cut_ranks[spots] = pairs[taken], taken
            todo = np.setdiff1d(todo, taken, assume_unique=True)
            place[todo] = (place[todo] + 1) & ((1 << self.cut_bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.cut_bits)).astype(np.int64)

    def _cut_rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = (first << 32) | second
        place = self._place(keys)
        ranks = np.full(len(keys), NEVER, np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            held = self.cut_keys[place[open_]]
            same = held == keys[open_]
            ranks[open_[same]] = self.cut_ranks[place[open_[same]]]
            open_ = open_[~same & (held != NONE)]
            place[open_] = (place[open_] + 1) & ((1 << self.cut_bits) - 1)
        return ranks

    def _compile_trie(self, vocab: dict, labels: list[bytes]) -> None:
        nodes: dict[bytes, int] = {b"": 0}
        tokens = [labels[number] for number in vocab.values()]
        inner = sorted({t[:n] for t in tokens for n in range(1, len(t))})
        for prefix in inner:
            nodes[prefix] = len(nodes)
        self.inner = len(nodes)  # nodes from here on are leaves and have no row
        for token in tokens:
            nodes.setdefault(token, len(nodes))
        self.next = np.full((self.inner, 256), NONE, np.int32)
        for prefix, node in nodes.items():
            if prefix:
                self.next[nodes[prefix[:-1]], prefix[-1]] = node
        self.token_at = np.full(len(nodes), NONE, np.int64)
        for number in vocab.values():
            self.token_at[nodes[labels[number]]] = number

    def _walk(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether arcs stand, by walking the gadgets back to bytes."""
        stands = np.ones(len(state), bool)
        limit = np.full(len(state), NEVER, np.int64)
        state, token = state.copy(), token.copy()
        open_ = np.flatnonzero(state != self.start)
        while len(open_):
            s, t = state[open_], token[open_]
            cut = self._cut_rank(s, t) < limit[open_]
            stands[open_[cut]] = False
            go = ~cut & ((self.born[s] >= 0) | (self.born[t] >= 0))
            open_, s, t = open_[go], s[go], t[go]
            copy = self.born[s] > self.born[t]  # the state is the younger one
            limit[open_] = np.where(copy, self.born[s], self.born[t] + 1)
            state[open_] = np.where(copy, self.right[s], s)
            token[open_] = np.where(copy, t, self.left[t])
        return stands

    def arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the arc ``token`` leaves ``state``, from the table where it is known."""
        keys = (state << 32) | token
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        place = (mixed >> np.uint64(44)).astype(np.int64)
        stands = self.kept_arcs[place]
        new = np.flatnonzero(self.kept_keys[place] != keys)
        if len(new):
            stands[new] = self._walk(state[new], token[new])
            self.kept_keys[place[new]] = keys[new]
            # Of several keys at one place the last is kept, as for the keys.
            self.kept_arcs[place[new]] = stands[new]
        return stands

    def encode_words(self, words: list[str]):
        """Places of some words, all their ids, and each word's number of ids; in parts."""
        special = [place for place, word in enumerate(words) if word in self.specials]
        if special:
            ids = np.array([self.specials[words[place]] for place in special], np.uint32)
            yield np.array(special), ids, np.ones(len(special), np.int64)
        raw = [word.encode() for word in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(lengths, kind="stable")
        order = order[~np.isin(order, special)]
        low = 0
        while low < len(order):
            ahead = lengths[order[low : low + CELLS]]
            fits = ahead * np.arange(1, len(ahead) + 1) <= CELLS
            high = low + max(1, int(fits.argmin()) if not fits.all() else len(ahead))
            some = order[low:high]
            yield some, *self._paths([raw[i] for i in some.tolist()], lengths[some])
            low = high

    def _paths(self, raw: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids on the accepted path of each word; lengths ascend."""
        count, longest = len(raw), int(lengths[-1])
        text = np.zeros((longest, count), np.uint8)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(lengths)
        row = np.repeat(np.arange(count), lengths)
        text[np.arange(len(flat)) - np.repeat(ends - lengths, lengths), row] = flat
        state = np.full((longest + 1, count), NONE, np.int64)
        state[0] = self.start
        lane = begin = node = np.zeros(0, np.int64)
        for step in range(longest):
            first = int(np.searchsorted(lengths, step, "right"))
            fresh = np.arange(first, count)
            alive = (lengths[lane] > step) & (node < self.inner)
            lane = np.concatenate([lane[alive], fresh])
            begin = np.concatenate([begin[alive], np.full(len(fresh), step, np.int64)])
            node = np.concatenate([node[alive], np.zeros(len(fresh), np.int64)])
            node = self.next[node, text[step, lane]].astype(np.int64)
            there = node != NONE
            lane, begin, node = lane[there], begin[there], node[there]
            token = self.token_at[node]
            ends_here = np.flatnonzero(token != NONE)
            token, at = token[ends_here], lane[ends_here]
            stands = self.arcs(state[begin[ends_here], at], token)
            state[step + 1, at[stands]] = token[stands]
        # From each word's end back over the labels of its path.
        place, lanes = lengths.copy(), np.arange(count)
        found_lane, found_place, found = [], [], []
        while len(lanes):
            token = state[place[lanes], lanes]
            if (token == NONE).any():
                raise ValueError("a byte is missing from the vocabulary")
            found_lane.append(lanes)
            found_place.append(place[lanes])
            found.append(token)
            place[lanes] -= self.label_lengths[token]
            lanes = lanes[place[lanes] > 0]
        lane, ids = np.concatenate(found_lane), np.concatenate(found)
        order = np.lexsort((np.concatenate(found_place), lane))
        return ids[order].astype(np.uint32), np.bincount(lane, minlength=count)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Texts from the labels of their arcs; ids without a label are left out.

        Bytes that are no UTF-8 become U+FFFD.
        """
        known = np.append(self.label_lengths, 0)
        number = np.minimum(ids.astype(np.int64), len(self.label_lengths))
        lengths = known[number]
        ends = np.concatenate([[0], np.cumsum(lengths)])[bounds]
        raw = gather(self.labels, np.append(self.label_starts, 0)[number], lengths).tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
        return pa.array(texts, pa.string())


@functools.lru_cache(maxsize=1)
def automaton(path: str) -> Automaton:
    """One per worker and vocabulary."""
    return Automaton(path)


@functools.lru_cache(maxsize=1)
def automaton_ids(path: str) -> WordIds:
    return WordIds(automaton(path), path)


def _ids(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids.astype(np.int32)))


def round_trip(docs: DataFrame, path: str, id_column="doc_id", text_column="text") -> DataFrame:
    """Every text's ids, and the text that these ids decode to: (id, ids, decoded).

    A null text counts as empty: no ids, empty text. Rows are kept as they are, repeated
    rows and null ids too; other columns are not read. A special token written out in a
    text becomes its id.
    """
    kind = docs.schema[id_column].dataType

    def run(batches):
        machine, encoder = automaton(path), automaton_ids(path)
        for batch in batches:
            for first, ids, bounds in encoded_chunks(batch.column(1), encoder):
                rows = batch.column(0).slice(first, len(bounds) - 1)
                columns = [rows, _ids(ids, bounds), machine.decode(ids, bounds)]
                yield pa.RecordBatch.from_arrays(columns, [id_column, "ids", "decoded"])

    schema = T.StructType(
        [
            T.StructField(id_column, kind),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, id_column="doc_id", text_column="text") -> DataFrame:
    """(id, ids) of every text; nulls and repeated rows as in ``round_trip``."""
    schema = T.StructType(
        [docs.schema[id_column], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )

    def run(batches):
        encoder = automaton_ids(path)
        for batch in batches:
            for first, ids, bounds in encoded_chunks(batch.column(1), encoder):
                rows = batch.column(0).slice(first, len(bounds) - 1)
                yield pa.RecordBatch.from_arrays([rows, _ids(ids, bounds)], [id_column, "ids"])

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, id_column="doc_id", ids_column="ids") -> DataFrame:
    """(id, decoded) for arrays of ids; null arrays and null or unknown ids add nothing."""
    schema = T.StructType([rows.schema[id_column], T.StructField("decoded", T.StringType())])

    def run(batches):
        machine = automaton(path)
        for batch in batches:
            lists = batch.column(1)
            lengths = [0 if row is None else len(row) for row in lists.to_pylist()]
            flat = lists.flatten().cast(pa.int64()).fill_null(-1).to_numpy()
            flat = np.where(flat < 0, np.int64(1) << 40, flat)
            bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            texts = machine.decode(flat, bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], [id_column, "decoded"])

    return rows.select(id_column, ids_column).mapInArrow(run, schema)
