"""How many cases have a matching record: a one-to-many left join, kept as counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.functions import ratio


def match_facts(
    cases: DataFrame, matches: DataFrame, on: str, dims: list[str], attribute: str
) -> DataFrame:
    """Rows of ``cases`` left join ``matches``, counted by ``dims`` and ``attribute``.

    A case with n matching records counts n times, one without counts once under a NULL
    attribute. Column ``joined_rows`` holds the count.

    The records are first reduced to counts by key and attribute, so a key that is
    frequent on both sides makes no product of rows. The cases go into the join as they
    are, in one shuffle: both inputs of the join are then plain shuffles, which is what
    lets AQE split a key that many cases share.
    """
    counted = (
        matches.filter(F.col(on).isNotNull())
        .groupBy(on, attribute)
        .agg(F.count("*").alias("_records"))
    )
    return (
        cases.select(on, *dims)
        .join(counted, on, "left")
        .groupBy(*dims, attribute)
        .agg(F.sum(F.coalesce("_records", F.lit(1))).alias("joined_rows"))
    )


def match_rate(
    facts: DataFrame, keys: list[str], attribute: str, total: str, matched: str, rate: str
) -> DataFrame:
    """Total, matched and rate by ``keys``; a record with a NULL attribute is no match."""
    has_match = F.when(F.col(attribute).isNotNull(), F.col("joined_rows")).otherwise(0)
    return (
        facts.groupBy(*keys)
        .agg(F.sum("joined_rows").alias(total), F.sum(has_match).alias(matched))
        .withColumn(rate, ratio(matched, total))
    )


def matches_by(facts: DataFrame, attribute: str, name: str, total: str) -> DataFrame:
    """Matched rows by attribute."""
    return (
        facts.filter(F.col(attribute).isNotNull())
        .groupBy(F.col(attribute).alias(name))
        .agg(F.sum("joined_rows").alias(total))
    )
