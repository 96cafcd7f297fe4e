"""Frames with every awkward case, and small helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, score double, ids string, node int, class_id int"

LONG = "word and more text " * 20_000


def awkward(spark, extra=()):
    """Nulls in any column, empty and long texts, repeated rows, clashing column names."""
    texts = [
        (1, "The quick brown fox jumps over the lazy dog."),
        (1, "The quick brown fox jumps over the lazy dog."),
        (2, None),
        (2, None),
        (3, ""),
        (None, "A text without an id, and some words more."),
        (None, None),
        (4, " \n\t "),
        (5, "0123 456 !?"),
        (6, LONG),
        (7, "é ß 中文 😀 it's <|endoftext|> o'clock  \n\n x"),
        (8, "one"),
        *extra,
    ]
    rows = [(i, t, None, 0.5, "x", 7, None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sentences(seed, count, words=40, vocabulary=400):
    rng = random.Random(seed)
    names = [
        "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8)))
        for _ in range(vocabulary)
    ]
    return [" ".join(rng.choice(names) for _ in range(words)) for _ in range(count)]
