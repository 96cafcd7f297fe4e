"""Quality of documents, by a linear-chain conditional random field over their lines.

Every line is good or bad; its features describe its characters and words and those of the
lines before and after it. A document's quality is the mean of the lines' probabilities,
weighted by length, brought to a probability by a logistic curve.
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
from wardwatch.llm.presplit import chunks, code_points, text_bytes

# Bounds of the training sample: documents, and lines of one document in stretches.
SAMPLE_DOCS = 3000
STRETCHES = 8
STRETCH_LINES = 64

UPPER, LOWER, DIGIT, SPACE, SIGN = range(5)

# Signs whose share is a feature of its own.
SIGNS = "|!%$&*#@<>{}[]=/\\_~^+"

SHARES = (0.0, 0.01, 0.03, 0.06, 0.12, 0.25, 0.5, 0.75)
COUNTS = (0, 1, 3, 7, 15, 31, 127, 511)
LENGTHS = (0, 2, 3, 4, 5, 7, 10, 20)
BUCKETS = 9


@functools.lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    table = np.full(sys.maxunicode + 1, SIGN, np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))
        if kind[0] in "LM":
            table[code] = UPPER if kind in ("Lu", "Lt") else LOWER
        elif kind[0] == "N":
            table[code] = DIGIT
        elif kind[0] == "Z":
            table[code] = SPACE
    table[[9, 10, 11, 12, 13]] = SPACE
    return table


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers (lines, features), lines' lengths, and each text's first line's place.

    The third array has one more entry, the number of lines. Every text has a line; an
    empty or null one has an empty line.
    """
    raw, bounds = text_bytes(texts)
    codes = code_points(raw)
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    text_at = np.searchsorted(heads, bounds)
    size = len(codes)
    breaks = np.flatnonzero(codes == 10)
    # Lines begin with each text and behind each break; a break is in no line.
    owner = np.searchsorted(text_at[1:], breaks, "right")
    inside = np.bincount(owner, minlength=len(texts))
    first_line = np.concatenate([[0], np.cumsum(inside + 1)])
    after_break = np.arange(len(breaks)) + owner + 1
    begins, ends = (np.empty(int(first_line[-1]), np.int64) for _ in range(2))
    begins[first_line[:-1]], begins[after_break] = text_at[:-1], breaks + 1
    ends[first_line[1:] - 1], ends[after_break - 1] = text_at[1:], breaks
    lengths = ends - begins

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[ends] - total[begins]

    kind = kinds()[codes]
    upper, digit = per_line(kind == UPPER), per_line(kind == DIGIT)
    letters = upper + per_line(kind == LOWER)
    space, sign = per_line(kind == SPACE), per_line(kind == SIGN)
    edge = np.zeros(size + 1, bool)
    edge[begins] = True
    inside = kind != SPACE
    before = np.concatenate([[False], inside[:-1]])[:size]
    word_at = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]])[:size]
    word_end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    line_of = np.searchsorted(begins, word_at, "right") - 1
    words = np.bincount(line_of, minlength=len(begins))
    same_sign = np.zeros(size, bool)
    same_sign[1:] = (codes[1:] == codes[:-1]) & (kind[1:] == SIGN)
    distinct, repeats = words.copy(), np.zeros_like(words)
    if len(word_at):
        edges = np.append(heads, len(raw))
        offsets = edges[np.append(word_at, size)].astype(np.int32)
        with_space = pa.StringArray.from_buffers(
            len(word_at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))
        )
        index = pc.utf8_trim_whitespace(with_space).dictionary_encode().indices
        index = index.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique((line_of.astype(np.int64) << 32) | index)
        distinct = np.bincount(pairs >> 32, minlength=len(begins))
        again = (index[1:] == index[:-1]) & (line_of[1:] == line_of[:-1])
        repeats = np.bincount(line_of[1:][again], minlength=len(begins))
    longest = np.zeros(len(begins), np.int64)
    np.maximum.at(longest, line_of, word_end - word_at)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.searchsorted(SHARES, part / np.maximum(whole, 1), "left")

    def number(value: np.ndarray, steps: tuple) -> np.ndarray:
        return np.searchsorted(steps, value, "left")

    last = codes[np.maximum(ends - 1, 0)] if size else np.zeros(len(begins), np.uint32)
    last = np.where(lengths > 0, last, 0)
    stop = np.isin(last, [ord(c) for c in ".!?;:,"])
    columns = [
        number(lengths, COUNTS),
        number(words, COUNTS),
        number(longest, COUNTS),
        number((lengths - space) / np.maximum(words, 1), LENGTHS),
        share(upper, letters),
        share(letters, lengths),
        share(digit, lengths),
        share(sign, lengths),
        share(per_line(same_sign), lengths),
        share(words - distinct, words),
        share(repeats, words),
        np.where(stop, 1, 0) + np.where(last == ord("."), 1, 0),
    ]
    columns += [share(per_line(codes == ord(c)), np.maximum(words, 1)) for c in SIGNS]
    return np.stack(columns, axis=1).astype(np.int16), lengths, first_line


OWN = 12 + len(SIGNS)
FEATURES = 3 * (OWN + 1) * BUCKETS


def with_neighbours(buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature numbers of each line: its own, those of the line before and of the next.

    At either end of a document a feature says that there is no line.
    """
    lines = len(buckets)
    own = buckets + np.arange(OWN) * BUCKETS
    none = np.full((lines, 1), OWN * BUCKETS)
    out = np.empty((lines, 3, OWN + 1), np.int64)
    out[:, 0] = np.hstack([own, none])
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    last = np.append(first[1:], True)
    out[:, 1] = np.hstack([np.where(first[:, None], none, before), none])
    out[:, 2] = np.hstack([np.where(last[:, None], none, after), none])
    out += np.arange(3)[:, None] * (OWN + 1) * BUCKETS
    return out.reshape(lines, -1)


@dataclass
class Model:
    field: Field | None
    slope: float = 1.0
    shift: float = 0.0


def _means(field: Field, buckets, lengths, first_line) -> np.ndarray:
    """Mean probability of good lines of each text, weighted by length."""
    first = np.zeros(len(buckets), bool)
    first[first_line[:-1]] = True
    scores = field.weights[with_neighbours(buckets, first)].sum(axis=1, dtype=np.float64)
    found, _ = marginals(scores, first, field.start, field.moves)
    weight = lengths + 1.0
    good = np.add.reduceat(found[:, 1] * weight, first_line[:-1])
    return good / np.add.reduceat(weight, first_line[:-1])


def _odds(mean: np.ndarray) -> np.ndarray:
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def _stretches(batches):
    """Line features of sampled texts: (key, label, lengths, buckets as bytes)."""
    for batch in batches:
        for at, texts in chunks(batch.column(2)):
            buckets, lengths, first_line = line_features(texts)
            out = {"key": [], "label": [], "lengths": [], "buckets": []}
            for row, (low, high) in enumerate(zip(first_line[:-1], first_line[1:])):
                room = max(0, high - low - STRETCH_LINES)
                for offset in sorted({room * k // (STRETCHES - 1) for k in range(STRETCHES)}):
                    part = slice(low + offset, min(high, low + offset + STRETCH_LINES))
                    out["key"].append(batch.column(0)[at + row].as_py())
                    out["label"].append(batch.column(1)[at + row].as_py())
                    out["lengths"].append(lengths[part].tolist())
                    out["buckets"].append(buckets[part].tobytes())
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    [
                        ("key", pa.int64()),
                        ("label", pa.int32()),
                        ("lengths", pa.list_(pa.int64())),
                        ("buckets", pa.binary()),
                    ]
                ),
            )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column="doc_id",
    text_column="text",
    label_column="quality",
) -> Model:
    """A model from the documents that ``labels`` marks 1 (good) or 0.

    At most ``SAMPLE_DOCS`` rows of labelled documents are used, chosen by hash, of each at
    most ``STRETCHES`` stretches of ``STRETCH_LINES`` lines spread over the whole text. Rows
    of one id and text are one. Null labels are left out; where an id has several labels,
    their mean decides.
    """
    marks = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    marks = marks.groupBy(F.col(id_column).alias("key"))
    marks = marks.agg((F.avg(label_column) >= 0.5).cast("int").alias("label"))
    # At most SAMPLE_DOCS rows of two numbers.
    chosen = F.broadcast(sample(marks, "key", SAMPLE_DOCS))
    rows = docs.select(
        F.col(id_column).alias("key"), F.make_valid_utf8(text_column).alias("text")
    ).join(chosen, "key")
    rows = rows.select(F.xxhash64("key").alias("key"), "label", "text")
    # An id may have any number of rows: the bound is on these.
    place = F.xxhash64("key", "text")
    rows = rows.withColumn("place", place).dropDuplicates(["key", "place"])
    total = rows.count()
    if total > SAMPLE_DOCS:
        share = int(SAMPLE_DOCS / total * 2**53)
        rows = rows.where(F.pmod("place", F.lit(2**53)) < share)
    rows = rows.select("key", "label", "text")
    schema = "key long, label int, lengths array<long>, buckets binary"
    found = rows.mapInArrow(_stretches, schema).toArrow()
    if not found.num_rows:
        return Model(None)
    found = found.sort_by([("key", "ascending"), ("buckets", "ascending")])
    if found.num_rows > SAMPLE_DOCS:  # by chance some more than the share
        found = found.take(np.linspace(0, found.num_rows - 1, SAMPLE_DOCS).astype(int))
    label = found["label"].to_numpy()
    parts = [np.frombuffer(b, np.int16).reshape(-1, OWN) for b in found["buckets"].to_pylist()]
    sizes = np.array([len(part) for part in parts])
    buckets = np.concatenate(parts)
    lengths = np.concatenate([np.array(row) for row in found["lengths"].to_pylist()])
    first_line = np.concatenate([[0], np.cumsum(sizes)])
    first = np.zeros(len(buckets), bool)
    first[first_line[:-1]] = True
    features = with_neighbours(buckets, first)
    bounds = np.arange(len(buckets) + 1) * features.shape[1]
    field = fit(
        features.ravel(),
        bounds,
        np.arange(len(buckets)),
        first,
        np.repeat(label, sizes),
        FEATURES,
        2,
        rounds=150,
        penalty=1e-5,
    )
    slope, shift = _logistic(_odds(_means(field, buckets, lengths, first_line)), label)
    return Model(field, slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic curve, by Newton steps."""
    beta = np.array([1.0, 0.0])
    columns = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(columns @ beta, -30, 30)))
        slope = columns.T @ (y - p) - 1e-2 * beta
        curve = (columns * (p * (1 - p))[:, None]).T @ columns + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -1, 1)
    return float(max(beta[0], 0.0)), float(beta[1])


def judge(model: Model, texts: pa.Array) -> np.ndarray:
    """Score of each text, 0 to 1; 0.5 for all if the model saw no label."""
    if model.field is None or not len(texts):
        return np.full(len(texts), 0.5)
    mean = _means(model.field, *line_features(texts))
    return 1 / (1 + np.exp(-np.clip(model.slope * _odds(mean) + model.shift, -30, 30)))


def score(
    docs: DataFrame,
    model: Model,
    text_column="text",
    keep: list[str] | None = None,
    name: str = "score",
) -> DataFrame:
    """``docs`` with the quality of every whole text in the column ``name``.

    ``keep`` lists the columns of ``docs`` to return, all by default.
    Null and empty texts are one empty line and get its score. Rows are judged one by one,
    so repeated rows get equal scores. A column ``name`` in the input is replaced.
    """
    docs = docs.drop(name)
    kept = [name for name in docs.columns if keep is None or name in keep]
    schema = T.StructType(
        [docs.schema[name] for name in kept] + [T.StructField(name, T.DoubleType())]
    )

    def run(batches):
        for batch in batches:
            for first, texts in chunks(batch.column(len(kept))):
                part = batch.slice(first, len(texts))
                columns = [*part.columns[:-1], pa.array(judge(model, texts))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    judged = docs.select(*kept, F.make_valid_utf8(text_column).alias("judged text"))
    return judged.mapInArrow(run, schema)
