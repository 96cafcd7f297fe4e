"""Token ids of whole texts by the tokenizers library, each distinct word encoded once."""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from wardwatch.llm.presplit import chunks, gather, split_words, text_bytes
from wardwatch.llm.shingles import hashes_by

# Bytes that are white space.
_SPACES = np.array([code < 0x80 and chr(code).isspace() for code in range(256)])

# Words a worker remembers; beyond it the memory is started anew.
REMEMBERED_WORDS = 1_000_000
HASH_BASES = (0x100000001B3, 0x9E3779B97F4A7C15)

# Text bytes encoded at once: the more, the fewer distinct words.
TEXT_BYTES = 2 * 1024 * 1024


class Library:
    """Ids of words by the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Byte-level vocabularies write a space in front of a token as this sign.
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.opens[number] = token.startswith("\u0120")

    def encode_words(self, words: list[str]):
        """Places of some words, all their ids, and each word's number of ids; in parts.

        Words that open with a space are encoded many in one text: the cut before each is
        certain, and the first of its ids is the only one with a space in front.
        """
        plain = _opened_by_space(words)
        spaced, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        for low in range(0, len(spaced), 20_000):
            some = spaced[low : low + 20_000]
            texts = [
                "".join([words[i] for i in some[at : at + 500].tolist()])
                for at in range(0, len(some), 500)
            ]
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            flat = np.concatenate([np.asarray(e.ids, np.uint32) for e in encoded])
            heads = np.flatnonzero(self.opens[flat])
            if len(heads) != len(some):
                raise ValueError("the tokenizer joins words over a space")
            yield some, flat, np.diff(np.append(heads, len(flat)))
        for low in range(0, len(other), 20_000):
            some = other[low : low + 20_000]
            part = [words[i] for i in some.tolist()]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            ids = [np.asarray(e.ids, np.uint32) for e in encoded]
            yield some, np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))


def _opened_by_space(words: list[str]) -> np.ndarray:
    """Which words are a space and, behind it, something else than white space."""
    raw, bounds = text_bytes(pa.array(words, pa.string()))
    raw = np.append(raw, np.zeros(2, np.uint8))
    head, second = raw[bounds[:-1]], raw[bounds[:-1] + 1]
    found = (head == 0x20) & (np.diff(bounds) > 1) & ~_SPACES[second]
    for i in np.flatnonzero(found & (second >= 0x80)).tolist():
        found[i] = not words[i][1].isspace()
    return found


class WordIds:
    """Ids of texts from the ids of their distinct words, remembered between batches.

    ``source`` has ``encode_words``: any encoder that works word by word. Words are
    remembered under two 64-bit hashes in an open hash table.
    """

    def __init__(self, source, path: str, remembered: int = REMEMBERED_WORDS):
        self.source = source
        self.path = path
        self.remembered = remembered
        self.bits = max(10, (2 * remembered).bit_length())
        self._forget()

    def _forget(self) -> None:
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.hashes = np.zeros((1 << 16, 2), np.uint64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int32)
        self.words = self.used = 0

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 if it is new."""
        found = np.full(len(hashes), -1, np.int64)
        slot, open_ = self._slots(hashes), np.arange(len(hashes))
        while len(open_):
            held = self.table.take(slot[open_])
            full = held >= 0
            open_, held = open_[full], held[full]
            match = self.hashes.take(held, axis=0) == hashes.take(open_, axis=0)
            same = match[:, 0] & match[:, 1]
            found[open_[same]] = held[same]
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return found

    def _store(self, hashes: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        first, count = self.words, len(hashes)
        self.hashes = _grown(self.hashes, first + count)
        self.ids = _grown(self.ids, self.used + len(flat))
        self.starts = _grown(self.starts, first + count)
        self.lengths = _grown(self.lengths, first + count)
        self.hashes[first : first + count] = hashes
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[first : first + count] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + count] = lengths
        slot, open_ = self._slots(hashes), np.arange(count)
        while len(open_):
            free = open_[self.table[slot[open_]] < 0]
            self.table[slot[free]] = first + free
            open_ = open_[self.table[slot[open_]] != first + open_]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        self.words += count
        self.used += len(flat)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and where each text's ids start and end."""
        words, bounds = split_words(texts, self.path)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        distinct = words.dictionary
        if self.words + len(distinct) > self.remembered:
            self._forget()
        if len(distinct) > self.remembered:
            self.bits = (2 * len(distinct)).bit_length()
            self._forget()
        hashes = np.stack(hashes_by(distinct, HASH_BASES), axis=1)
        place = self._find(hashes)
        new = np.flatnonzero(place < 0)
        if len(new):
            for some, flat, lengths in self.source.encode_words(
                distinct.take(pa.array(new)).to_pylist()
            ):
                place[new[some]] = np.arange(self.words, self.words + len(some))
                self._store(hashes[new[some]], flat, lengths)
        # By distinct word first, as there are fewer of them.
        index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = self.lengths.take(place).astype(np.int64).take(index)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return gather(self.ids, self.starts.take(place).take(index), lengths), ends[bounds]


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    more = max(size, 2 * len(array)) - len(array)
    return np.concatenate([array, np.zeros((more, *array.shape[1:]), array.dtype)])


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per worker and tokenizer."""
    return WordIds(Library(path), path)


def encoded_chunks(texts: pa.Array, encoder: WordIds):
    """Per slice of the column: its first row, ids, and where each text's ids start and end."""
    for first, part in chunks(texts, TEXT_BYTES):
        yield first, *encoder.encode(part)
