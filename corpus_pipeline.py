"""A corpus from raw documents to packed sequences, as stages over tables.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet in
the shared folder and hands the table to the next stage, so a lost executor costs no more
than tasks of the current stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.llm import jaccard, langid, packing, pii, quality
from wardwatch.llm.common import fold
from wardwatch.llm.queries import QUALITY
from wardwatch.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# Documents of a lower share are rejected, as are those that op6_quality does not take for good.
LANGUAGE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter, or of none for the most part, go."""
    model = langid.train(docs.where(fold("doc_id", 5) != 0))
    names = ("lang of stage", "share of stage")
    judged = langid.identify(docs, model, names=names)
    kept = judged.where((F.col(names[0]) != langid.UNKNOWN) & (F.col(names[1]) >= LANGUAGE))
    return kept.drop(*names)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.where(fold("doc_id", 4) != 2))
    judged = quality.score(docs, model, name="score of stage")
    return judged.where(F.col("score of stage") >= QUALITY).drop("score of stage")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.deduplicated(docs)


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without personal data and the terms that disclose it."""
    clean = pii.sanitised(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = clean.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("quality", good),
    ("near_duplicates", distinct),
    ("pii", sanitised),
    ("packing", packed),
]

# The models, sketches and the tokenizer of the stages cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
