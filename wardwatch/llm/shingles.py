"""Word shingles of texts as hashes, whole batches at a time."""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardwatch.llm.presplit import chunks, code_points, text_bytes

_MIX = np.uint64(0x9E3779B97F4A7C15)
BYTE_BASE = 0x100000001B3


@functools.lru_cache(maxsize=1)
def spaces() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, bool)
    table[[code for code in range(0x3001) if chr(code).isspace()]] = True
    return table


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def split_at_space(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words between white space, dictionary-encoded, and each text's first one's place.

    The second array has one more entry, the number of words.
    """
    raw, bounds = text_bytes(texts)
    none = pa.array([], pa.string()).dictionary_encode(), np.zeros(len(texts) + 1, np.int64)
    if not len(raw):
        return none
    inside = ~spaces()[code_points(raw)]
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    starts_at = np.searchsorted(heads, bounds)
    cut = np.zeros(len(inside) + 1, bool)
    cut[starts_at] = True
    begins = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | cut[:-1]))
    if not len(begins):
        return none
    # Each word with the space behind it, which is then cut off.
    offsets = np.append(heads, len(raw))[np.append(begins, len(inside))].astype(np.int32)
    words = pa.StringArray.from_buffers(
        len(begins), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))
    )
    words = pc.utf8_rtrim_whitespace(words)
    return words.dictionary_encode(), np.searchsorted(begins, starts_at)


def word_hashes(words: pa.Array, base: int = BYTE_BASE) -> np.ndarray:
    """A 64-bit hash of each word; other odd bases give other hashes."""
    return hashes_by(words, (base,))[0]


def hashes_by(words: pa.Array, bases: tuple[int, ...]) -> list[np.ndarray]:
    """The hashes of each word by several bases."""
    raw, bounds = text_bytes(words)
    lengths = np.diff(bounds)
    if not len(raw):
        return [mix(lengths.astype(np.uint64)) for _ in bases]
    place = np.arange(len(raw)) - np.repeat(bounds[:-1], lengths)
    values = raw.astype(np.uint64) + np.uint64(1)
    found = []
    for base in bases:
        powers = np.cumprod(np.full(int(lengths.max()), base, np.uint64))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values * powers.take(place), out=total[1:])
        found.append(mix(total[bounds[1:]] - total[bounds[:-1]] + lengths.astype(np.uint64)))
    return found


def shingle_chunks(texts: pa.Array, width: int):
    """Per slice of the column: first row, shingle hashes, and each text's start and end.

    Words are taken in lower case between white space. A text of fewer words than ``width``
    has one shingle of all of them, a text without words none. Hashes may repeat.
    """
    for first, part in chunks(texts):
        words, bounds = split_at_space(pc.utf8_lower(pc.fill_null(part.cast(pa.string()), "")))
        counts = np.diff(bounds)
        sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        if not len(words):
            yield first, np.zeros(0, np.uint64), ends
            continue
        index = words.indices.to_numpy(zero_copy_only=False)
        hashes = word_hashes(words.dictionary)[index]
        padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
        place = np.arange(int(ends[-1])) + np.repeat(bounds[:-1] - ends[:-1], sizes)
        limit = np.repeat(bounds[1:], sizes)
        value = np.zeros(len(place), np.uint64)
        for step in range(width):
            here = np.where(place + step < limit, padded[place + step], np.uint64(0))
            value = mix(value * np.uint64(31) + here)
        yield first, value, ends
