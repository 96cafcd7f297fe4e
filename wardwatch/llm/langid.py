"""Language of texts with switches, by a linear-chain conditional random field over words.

Each run of letters is a place of the chain. Its features are affixes, letter n-grams and
the lexicons that hold it; what languages follow each other is learned. Forward-backward
gives each word's language; a text's is the one with the largest share of letters.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.llm.common import sample
from wardwatch.llm.crf import Field, fit, marginals
from wardwatch.llm.presplit import chunks, code_points, gather, text_bytes

UNKNOWN = "und"

# Hashed features; the last place is for words without any.
FEATURES = 1 << 16
# Bounds of the training sample.
SAMPLE_DOCS = 1500
SEGMENTS = 4
SEGMENT_WORDS = 32
# A word of the sample is in a language's lexicon from this count and share on.
LEXICON_COUNT = 3
LEXICON_SHARE = 0.6


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter (1) or a mark that goes on with a word (2)."""
    kinds = (unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1))
    table = np.fromiter((1 if k == "L" else 2 if k == "M" else 0 for k in kinds), np.uint8)
    return table


def letter_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Runs of letters in lower case, dictionary-encoded, and each text's first one's place.

    The second array has one more entry, the number of words.
    """
    raw, bounds = text_bytes(pc.utf8_lower(texts.cast(pa.string())))
    if not len(raw):
        empty = pa.array([], pa.string()).dictionary_encode()
        return empty, np.zeros(len(texts) + 1, np.int64)
    kind = letters()[code_points(raw)]
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    starts_at = np.searchsorted(heads, bounds)
    inside = kind > 0
    cut = np.zeros(len(kind) + 1, bool)
    cut[starts_at] = True
    before = np.concatenate([[False], inside[:-1]])
    begins = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    lettered = np.add.reduceat((kind == 1).astype(np.int32), begins) if len(begins) else begins
    if len(begins):
        # A run's letters only: what lies between runs is none.
        begins, ends = begins[lettered > 0], ends[lettered > 0]
    if not len(begins):
        empty = pa.array([], pa.string()).dictionary_encode()
        return empty, np.zeros(len(texts) + 1, np.int64)
    edges = np.append(heads, len(raw))
    flat = gather(raw, edges[begins], edges[ends] - edges[begins])
    offsets = np.concatenate([[0], np.cumsum(edges[ends] - edges[begins])]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(flat))
    return words.dictionary_encode(), np.searchsorted(begins, starts_at)


def _hashed(value: np.ndarray, salt: int) -> np.ndarray:
    mixed = (value + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.int64)


def word_features(words: pa.Array, lexicons: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each word one after another, and where each word's start."""
    count = len(words)
    raw, bounds = text_bytes(words)
    codes = code_points(raw).astype(np.uint64)
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    begins = np.searchsorted(heads, bounds)
    lengths = np.diff(begins)
    at, last = begins[:-1], begins[1:] - 1
    word_of = np.repeat(np.arange(count), lengths)
    rows, values = [], []

    def add(row: np.ndarray, value: np.ndarray) -> None:
        rows.append(row)
        values.append(np.minimum(value, FEATURES - 2))

    base = np.uint64(1_114_112)
    for size in (2, 3):  # n-grams, by their last letter
        place = np.flatnonzero(np.arange(len(codes)) - at[word_of] >= size - 1)
        value = np.zeros(len(place), np.uint64)
        for back in range(size - 1, -1, -1):
            value = value * base + codes[place - back]
        add(word_of[place], _hashed(value, size))
    for size in (1, 2, 3):  # affixes
        row = np.flatnonzero(lengths >= size)
        value = np.zeros(len(row), np.uint64)
        for step in range(size):
            value = value * base + codes[at[row] + step]
        add(row, _hashed(value, 10 + size))
        value = np.zeros(len(row), np.uint64)
        for step in range(size - 1, -1, -1):
            value = value * base + codes[last[row] - step]
        add(row, _hashed(value, 20 + size))
    for number, lexicon in enumerate(lexicons):
        held = pc.is_in(words, value_set=lexicon).to_numpy(zero_copy_only=False)
        row = np.flatnonzero(held)
        add(row, _hashed(np.full(len(row), number, np.uint64), 30))
    rows.append(np.arange(count))  # every word has this one
    values.append(np.full(count, FEATURES - 1))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.argsort(row, kind="stable")
    return value[order], np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))])


@dataclass
class Model:
    languages: list[str]
    lexicons: list[pa.Array]
    field: Field


def _segments(batches):
    """Stretches of words spread evenly over whole texts: (lang, words)."""
    for batch in batches:
        for first, texts in chunks(batch.column(1)):
            words, bounds = letter_words(texts)
            index = words.indices.to_numpy(zero_copy_only=False)
            langs, out = [], []
            for row, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
                room = max(0, high - low - SEGMENT_WORDS)
                offsets = {room * k // max(1, SEGMENTS - 1) for k in range(SEGMENTS)}
                for offset in sorted(offsets) if high > low else ():
                    part = index[low + offset : min(high, low + offset + SEGMENT_WORDS)]
                    langs.append(batch.column(0)[first + row].as_py())
                    out.append(words.dictionary.take(pa.array(part)).to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"lang": langs, "words": out},
                pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string()))]),
            )


def train(docs: DataFrame, id_column="doc_id", text_column="text", lang_column="lang") -> Model:
    """A model from labelled rows; at most ``SAMPLE_DOCS`` of them are read to the driver.

    Of each sampled text, ``SEGMENTS`` stretches of ``SEGMENT_WORDS`` words spread over the
    whole text are used. Stretches of different texts are put together into chains, so that
    the field learns how languages switch. Rows without label or text are left out.
    """
    labelled = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    labelled = labelled.select(
        F.col(lang_column).cast("string").alias("lang"),
        F.make_valid_utf8(text_column).alias("text"),
        F.xxhash64(id_column).alias("key"),
    )
    chosen = sample(labelled, "key", SAMPLE_DOCS).select("lang", "text")
    schema = "lang string, words array<string>"
    found = chosen.mapInArrow(_segments, schema).toArrow()
    found = found.sort_by("lang") if found.num_rows else found
    languages = sorted(set(found["lang"].to_pylist()))
    if not languages:
        return Model([], [], Field(np.zeros((FEATURES, 0), np.float32), *np.zeros((2, 0))))
    number = {lang: k for k, lang in enumerate(languages)}
    segments = [
        (number[lang], words)
        for lang, words in zip(found["lang"].to_pylist(), found["words"].to_pylist())
    ]
    rng = np.random.default_rng(7)
    segments.sort(key=lambda s: (s[0], s[1]))
    rng.shuffle(segments)
    words, labels = [], []
    for label, part in segments:
        words.extend(part)
        labels.extend([label] * len(part))
    encoded = pa.array(words, pa.string()).dictionary_encode()
    things = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    labels = np.array(labels)
    counts = np.zeros((len(encoded.dictionary), len(languages)))
    np.add.at(counts, (things, labels), 1)
    lexicons = []
    for k in range(len(languages)):
        often = counts[:, k] >= np.maximum(LEXICON_COUNT, LEXICON_SHARE * counts.sum(axis=1))
        lexicons.append(encoded.dictionary.filter(pa.array(often)))
    # Chains of several segments each.
    lengths = np.array([len(part) for _, part in segments])
    first = np.zeros(len(things), bool)
    first[(np.cumsum(lengths) - lengths)[::4]] = True
    features, bounds = word_features(encoded.dictionary, lexicons)
    field = fit(features, bounds, things, first, labels, FEATURES, len(languages))
    return Model(languages, lexicons, field)


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the largest share of letters, 0 for no letter."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return langs, scores
    words, bounds = letter_words(texts)
    if not len(words):
        return langs, scores
    distinct = words.dictionary
    features, ends = word_features(distinct, model.lexicons)
    by_word = model.field.scores(features, ends)
    index = words.indices.to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(np.diff(bounds) > 0)
    first = np.zeros(len(words), bool)
    first[bounds[rows]] = True
    found, _ = marginals(
        by_word[index].astype(np.float64), first, model.field.start, model.field.moves
    )
    sizes = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)[index]
    mass = np.add.reduceat(found * sizes[:, None], bounds[rows], axis=0)
    mass /= mass.sum(axis=1, keepdims=True)
    best = mass.argmax(axis=1)
    for row, label in zip(rows, best):
        langs[row] = model.languages[label]
    scores[rows] = np.clip(mass[np.arange(len(rows)), best], 0, 1)
    return langs, scores


def identify(
    docs: DataFrame,
    model: Model,
    text_column="text",
    keep: list[str] | None = None,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` with the language and score of every whole text, in columns ``names``.

    ``keep`` lists the columns of ``docs`` to return, all by default.

    A text that is null or has no letter gets ``und`` and 0, and so do all texts if the
    model saw no labelled row. Equal shares go to the language first in order. Rows are
    judged one by one, so repeated rows get equal results. Columns of the two names in the
    input are replaced; all others are kept.
    """
    docs = docs.drop(*names)
    kept = [name for name in docs.columns if keep is None or name in keep]
    schema = T.StructType(
        [docs.schema[name] for name in kept]
        + [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )

    def run(batches):
        for batch in batches:
            for first, texts in chunks(batch.column(len(kept))):
                langs, scores = predict(model, texts)
                part = batch.slice(first, len(texts))
                columns = [*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    judged = docs.select(*kept, F.make_valid_utf8(text_column).alias("judged text"))
    return judged.mapInArrow(run, schema)
