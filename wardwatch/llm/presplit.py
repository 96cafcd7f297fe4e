"""Cut texts into the words a byte-level BPE works on, whole batches at a time.

The rule is that of the public byte-level pre-tokenizer: contractions, runs of letters, of
digits or of other signs with at most one space before them, and white space. It is applied
to an Arrow column as arrays of code points, so that no Python object is made per word, and
the words come out dictionary-encoded: encoders work on distinct words only.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER, DIGIT, SIGN, SPACE = range(4)

# Endings that follow an apostrophe as one word (fixed values of the pre-tokenizer).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

# Text bytes handled at once; arrays of about 20 times this size are made.
CHUNK_BYTES = 1024 * 1024

# Code points that are asked for at once: those of one byte.
PAGE = 256

# Code points that may be other than signs: all planes with letters, and the tags.
_PROBED = ((0, 0xD800), (0xE000, 0x32400), (0xE0000, 0xE0200))


class CharClasses:
    """Classes of code points, asked page by page from the tokenizer's own pre-tokenizer.

    Only pages that texts use are asked, as all of them take seconds. In ``a c ! 1 c !`` a
    letter joins the a, a sign the first !, a digit the 1.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.table = np.full(0x110000, SIGN, np.uint8)
        self.open = np.zeros(0x110000 // PAGE, bool)
        for low, high in _PROBED:
            self.open[low // PAGE : high // PAGE] = True
        self._ask(0)
        self.table[0x20] = SPACE
        self.first = self.table[:PAGE].tobytes()

    def _ask(self, page: int) -> None:
        codes = range(page * PAGE, (page + 1) * PAGE)
        probe = "".join(f"a{c}!1{c}!" for c in map(chr, codes))
        starts = np.zeros(len(probe) + 1, bool)
        starts[[span[0] for _, span in self.splitter.pre_tokenize_str(probe)]] = True
        cut = starts[:-1].reshape(-1, 6)
        kind = np.where(~cut[:, 1], LETTER, np.where(~cut[:, 2], SIGN, SPACE))
        self.table[codes.start : codes.stop] = np.where((kind == SPACE) & ~cut[:, 4], DIGIT, kind)
        self.open[page] = False

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The class of each code point."""
        low = codes.astype(np.uint8).tobytes().translate(self.first)
        kind = np.frombuffer(low, np.uint8).copy()
        wide = np.flatnonzero(codes >= PAGE)
        if len(wide):
            codes = codes[wide]
            met = np.bincount(codes // PAGE, minlength=len(self.open)) > 0
            for page in np.flatnonzero(met & self.open):
                self._ask(int(page))
            kind[wide] = self.table[codes]
        return kind


@functools.lru_cache(maxsize=2)
def char_classes(path: str) -> CharClasses:
    """One per worker and tokenizer."""
    return CharClasses(path)


@functools.lru_cache(maxsize=2)
def special_tokens(path: str) -> dict[str, int]:
    """Tokens that are found in a text before it is cut into words."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
            raise ValueError(f"added token with options is not supported: {token}")
    return {token["content"]: token["id"] for token in added}


def chunks(texts: pa.Array, size: int = CHUNK_BYTES):
    """Slices of the column with about ``size`` bytes each; a longer text stands alone."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    first = 0
    while first < len(texts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + size, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column, and where each text starts and the last one ends."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if texts.offset:
        texts = pa.concat_arrays([texts, pa.array([], pa.string())])
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def code_points(raw: np.ndarray) -> np.ndarray:
    return np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)


def _following(codes: np.ndarray, at: np.ndarray, text: str, limits: np.ndarray) -> np.ndarray:
    """Where ``text`` stands right behind the positions ``at``, before their limits."""
    fits = at + len(text) < limits
    for step, char in enumerate(text, 1):
        fits &= codes[np.minimum(at + step, len(codes) - 1)] == ord(char)
    return fits


def split_words(texts: pa.Array, path: str) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of the texts in order, dictionary-encoded, and each text's first word's place.

    The second array has one more entry, the number of words. A null text is empty.
    A special token is a word of its own.
    """
    raw, bounds = text_bytes(texts)
    if not len(raw):
        empty = pa.array([], pa.string()).dictionary_encode()
        return empty, np.zeros(len(texts) + 1, np.int64)
    codes = code_points(raw)
    heads = np.flatnonzero((raw & 0xC0) != 0x80)  # byte of each code point
    if len(heads) == len(raw):
        starts_at = bounds
    else:
        starts_at = np.searchsorted(heads, bounds)
    size = len(codes)
    first = np.zeros(size + 1, bool)  # of a text, or of a part beside a special token
    first[starts_at] = True

    inside = []
    if specials := special_tokens(path):
        found = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))))
        marked = np.zeros(len(texts), bool)
        for content in specials:
            hits = pc.match_substring(pc.fill_null(texts, ""), content)
            marked |= hits.to_numpy(zero_copy_only=False)
        for row in np.flatnonzero(marked):
            for match in found.finditer(texts[row].as_py()):
                low, high = starts_at[row] + match.start(), starts_at[row] + match.end()
                first[[low, high]] = True
                inside.append((low, high))

    kind = char_classes(path).of(codes)
    start = first.copy()
    start[1:-1] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # The last of some white space goes to what follows it, or stands alone.
    before_text = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:-1])
    start[before_text] = True
    joins = before_text[codes[before_text] == 0x20] + 1
    start[joins] = False

    marks = np.flatnonzero((codes == ord("'")) & start[:-1])
    if len(marks):
        limits_of = np.flatnonzero(first)
        limits = limits_of[np.searchsorted(limits_of, marks, "right")]
        for ending in CONTRACTIONS:
            hits = marks[_following(codes, marks, ending, limits)]
            start[hits + 1] = False
            start[hits + 1 + len(ending)] = True
    for low, high in inside:
        start[low + 1 : high] = False

    places = np.flatnonzero(start[:-1])
    offsets = np.append(heads[places], len(raw)).astype(np.int32)
    words = pa.StringArray.from_buffers(
        len(places), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))
    )
    return words.dictionary_encode(), np.searchsorted(places, starts_at)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches ``flat[start : start + length]`` one after another."""
    ends = np.cumsum(lengths)
    places = np.repeat(starts - (ends - lengths), lengths)
    places += np.arange(len(places), dtype=np.int64)
    return flat.take(places)
