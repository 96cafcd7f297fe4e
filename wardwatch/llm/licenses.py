"""License texts in documents: winnowed fingerprints find candidates, alignment confirms them.

Templates are cut into word n-grams, winnowed to the least hash of each window, and put into
an inverted index. The n-grams of a document that are in the index are hits, and hits of one
template near one diagonal are a candidate. The document's words around it are aligned with
the template's in a band about the diagonals; the matched words give coverage and span.
"""

from __future__ import annotations

import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.llm.presplit import chunks, code_points, gather, text_bytes
from wardwatch.llm.shingles import mix, word_hashes

# The notices that are looked for by default.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Words of an n-gram, and n-grams of a window: a run of NGRAM + WINDOW - 1 words is a hit.
NGRAM = 3
WINDOW = 2
# Words that alignment may shift to either side of the hits' diagonals.
BAND = 8
# Share of a template's words that a match has at least.
COVERAGE = 0.75

MATCH, MISMATCH, GAP = 2, -1, -1


@lru_cache(maxsize=1)
def _wordlike() -> np.ndarray:
    kinds = (unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1))
    return np.fromiter((k in "LMN" for k in kinds), bool)


def _words(texts: pa.Array):
    """Hashes of runs of letters and digits, their code points' begins and ends in each
    text, and each text's first word's place."""
    raw, bounds = text_bytes(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")))
    none = np.zeros(0, np.int64)
    if not len(raw):
        return np.zeros(0, np.uint64), none, none, np.zeros(len(texts) + 1, np.int64)
    inside = _wordlike()[code_points(raw)]
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    text_at = np.searchsorted(heads, bounds)
    cut = np.zeros(len(inside) + 1, bool)
    cut[text_at] = True
    begins = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | cut[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | cut[1:])) + 1
    first = np.searchsorted(begins, text_at)
    edges = np.append(heads, len(raw))
    sizes = edges[ends] - edges[begins]
    flat = gather(raw, edges[begins], sizes)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(flat))
    words = words.dictionary_encode()
    hashes = word_hashes(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
    shift = np.repeat(text_at[:-1], np.diff(first))
    return hashes, begins - shift, ends - shift, first


def _ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    count = max(0, len(hashes) - size + 1)
    value = np.zeros(count, np.uint64)
    for step in range(size):
        value = mix(value * np.uint64(31) + hashes[step : step + count])
    return value


@dataclass
class Index:
    """Sorted fingerprints with their template and place, and the templates' words."""

    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray
    ngram: int


def build(templates: Mapping[str, str], ngram: int = NGRAM, window: int = WINDOW) -> Index:
    """The inverted index; a template of fewer words than an n-gram raises ValueError."""
    names = sorted(templates)
    words = [_words(pa.array([templates[name]]))[0] for name in names]
    prints, owner, place = [], [], []
    for number, hashes in enumerate(words):
        grams = _ngrams(hashes, ngram)
        if not len(grams):
            raise ValueError(f"template {names[number]!r} has fewer than {ngram} words")
        last = max(1, len(grams) - window + 1)
        chosen = sorted(
            {low + int(grams[low : low + window].argmin()) for low in range(last)}
        )
        prints.append(grams[chosen])
        owner += [number] * len(chosen)
        place += chosen
    flat = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    return Index(
        names, words, flat[order], np.array(owner, int)[order], np.array(place, int)[order], ngram
    )


def align(words: np.ndarray, template: np.ndarray, low: int, high: int):
    """Best local alignment of ``words`` with ``template`` within a band of diagonals.

    A diagonal is place in words less place in template; ``low`` to ``high`` are allowed.
    Returns matched words and the first and last matched place in ``words``.
    """
    width = high - low + 1
    rows = len(template)
    score = np.zeros((rows + 1, width + 2), np.int64)
    came = np.zeros((rows + 1, width + 2), np.int8)  # 1 both, 2 template word, 3 document word
    for i in range(1, rows + 1):
        place = i - 1 + low + np.arange(width)
        there = (place >= 0) & (place < len(words))
        same = np.zeros(width, bool)
        same[there] = words[place[there]] == template[i - 1]
        # Along a row the diagonal grows with the place in the document.
        both = score[i - 1, 1:-1] + np.where(same, MATCH, MISMATCH)
        skip = score[i - 1, 2:] + GAP
        best = np.where(there, np.maximum(both, 0), 0)
        step = np.where(best > 0, 1, 0)
        over = there & (skip > best)
        best, step = np.where(over, skip, best), np.where(over, 2, step)
        # Document words left out: a running maximum with a price per word.
        price = np.arange(width) * -GAP
        run = np.maximum.accumulate(best + price) - price
        wide = there & (run > best)
        score[i, 1:-1] = np.where(wide, run, best)
        came[i, 1:-1] = np.where(wide, 3, step)
    i, k = np.unravel_index(int(score.argmax()), score.shape)
    if score[i, k] <= 0:
        return 0, 0, 0
    matched, first, last = 0, None, None
    while i > 0 and score[i, k] > 0 and came[i, k]:
        if came[i, k] == 1:
            place = i - 1 + low + k - 1
            if words[place] == template[i - 1]:
                matched += 1
                first, last = place, place if last is None else last
            i -= 1
        elif came[i, k] == 2:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return matched, first, last


def _exact(hashes: np.ndarray, words: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """Where the template stands word for word, from the left, none overlapping."""
    size = len(words)
    at = diagonals[(diagonals >= 0) & (diagonals + size <= len(hashes))]
    for k in range(size):
        at = at[hashes[at + k] == words[k]]
    kept, end = [], 0
    for place in at.tolist():
        if place >= end:
            kept.append(place)
            end = place + size
    return np.array(kept, np.int64)


def _candidates(stretch: np.ndarray, diagonals: np.ndarray, size: int, band: int):
    """(stretch, lowest, highest diagonal) of hits in order of both, as far as one alignment
    with a template of ``size`` words may reach.

    Neighbours in a group are at most ``band`` apart. A group is seen through windows that
    overlap by more diagonals than an alignment can cross before its gaps eat its score.
    """
    cuts = np.flatnonzero((np.diff(diagonals) > band) | (np.diff(stretch) > 0)) + 1
    cross = MATCH * size + band
    for begin, end in zip([0, *cuts], [*cuts, len(diagonals)]):
        while begin < end:
            stop = begin + int(np.searchsorted(diagonals[begin:end], diagonals[begin] + 2 * cross, "right"))
            yield int(stretch[begin]), int(diagonals[begin]), int(diagonals[stop - 1])
            if stop == end:
                break
            begin += int(np.searchsorted(diagonals[begin:end], diagonals[stop] - cross, "left"))


def matches(index: Index, hashes: np.ndarray, hits: np.ndarray, least: float):
    """(template, matched, first word, last word) in one document, none overlapping.

    ``hits`` are places of its n-grams that are in the index. Whole templates, which no
    alignment beats, are taken first; what is between them is aligned.
    """
    grams = _ngrams_at(hashes, hits, index.ngram)
    left = np.searchsorted(index.prints, grams, "left")
    sizes = np.searchsorted(index.prints, grams, "right") - left
    ends = np.cumsum(sizes)
    entry = np.arange(int(sizes.sum())) + np.repeat(left - (ends - sizes), sizes)
    place = np.repeat(hits, sizes)
    template, diagonal = index.template[entry], place - index.place[entry]
    order = np.argsort(template, kind="stable")
    numbers, cuts = np.unique(template[order], return_index=True)
    found = []
    for number, own in zip(numbers.tolist(), np.split(order, cuts[1:])):
        words = index.words[number]
        whole = _exact(hashes, words, np.unique(diagonal[own]))
        found += [(number, len(words), at, at + len(words) - 1) for at in whole.tolist()]
        stretch = np.searchsorted(whole, place[own], "right")
        begins = np.concatenate([[0], whole + len(words)])
        free = place[own] >= begins[stretch]
        own, stretch = own[free], stretch[free]
        own_order = np.lexsort((diagonal[own], stretch))
        finishes = np.append(whole, len(hashes))
        for part, low, high in _candidates(stretch[own_order], diagonal[own][own_order], len(words), BAND):
            start = max(int(begins[part]), low - BAND)
            stop = min(int(finishes[part]), high + BAND + len(words))
            for matched, first, last in _all(
                hashes[start:stop], words, low - BAND - start, high + BAND - start, least
            ):
                found.append((number, matched, start + first, start + last))
    # The match with most words first; what overlaps one taken before is dropped.
    found.sort(key=lambda m: (-m[1], -m[1] / len(index.words[m[0]]), m[2], m[0]))
    # Matches taken, by their place; none overlap, so only the neighbours have to be asked.
    firsts, taken = [], []
    for match in found:
        at = bisect_left(firsts, match[2])
        if (at and taken[at - 1][3] >= match[2]) or (at < len(taken) and taken[at][2] <= match[3]):
            continue
        firsts.insert(at, match[2])
        taken.insert(at, match)
    return taken


def _all(words, template, low, high, least):
    """All alignments of enough coverage in a stretch, best first, then beside it."""
    todo = [(0, len(words))]
    while todo:
        a, b = todo.pop()
        if b - a < max(1, least * len(template)):
            continue
        matched, first, last = align(words[a:b], template, low - a, high - a)
        if matched < least * len(template):
            continue
        yield matched, a + first, a + last
        todo += [(a, a + first), (a + last + 1, b)]


def _ngrams_at(hashes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    value = np.zeros(len(places), np.uint64)
    for step in range(size):
        value = mix(value * np.uint64(31) + hashes[places + step])
    return value


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    id_column="doc_id",
    text_column="text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """(id, license, start, end, coverage, matched): a row per notice found in a whole text.

    ``start`` and ``end`` are code points, the end exclusive; ``matched`` is the number of
    the template's words that are there in order, ``coverage`` their share. A notice is sure
    to be a candidate if it shares ``NGRAM + WINDOW - 1`` words in a row with its template;
    one changed in more places may be missed. Words are runs
    of letters and digits in lower case. Matches of one text do not overlap: the one with
    more words stays. Null and empty texts, and texts without notice, give no row. Rows are
    looked at one by one, so repeated rows give repeated matches; null ids are kept. Other
    columns are not read.
    """
    index = build(templates)
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField(id_column, kind),
            T.StructField("license", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("matched", T.LongType()),
        ]
    )

    def run(batches):
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                hashes, begins, ends, first = _words(texts)
                grams = _ngrams(hashes, index.ngram)
                spot = np.searchsorted(index.prints, grams)
                spot[spot == len(index.prints)] = 0
                hits = np.flatnonzero(index.prints[spot] == grams) if len(index.prints) else spot[:0]
                owner = np.searchsorted(first, hits, "right") - 1
                inside = hits + index.ngram <= first[owner + 1]
                hits, owner = hits[inside], owner[inside]
                rows, out = [], {name: [] for name in schema.names[1:]}
                texts_hit, begin = np.unique(owner, return_index=True)
                for row, own in zip(texts_hit, np.split(hits, begin[1:])):
                    low, high = first[row], first[row + 1]
                    own = own - low
                    for number, matched, a, b in matches(index, hashes[low:high], own, coverage):
                        rows.append(at + row)
                        out["license"].append(index.names[number])
                        out["start"].append(int(begins[low + a]))
                        out["end"].append(int(ends[low + b]))
                        out["coverage"].append(matched / len(index.words[number]))
                        out["matched"].append(matched)
                taken = batch.column(0).take(pa.array(rows, pa.int64()))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
                arrays = [taken] + [pa.array(v, k) for v, k in zip(out.values(), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    texts = F.make_valid_utf8(text_column).alias("text")
    return docs.select(F.col(id_column), texts).mapInArrow(run, schema)
