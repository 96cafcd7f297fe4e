"""The most frequent value per key, and counts of rows mapped through such a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwatch.operators.counting import tally


def mode_lookup(df: DataFrame, key: str, value: str, weight: str | None = None) -> DataFrame:
    """For every key its most frequent value; of equally frequent ones the smallest.

    The pairs are counted first, so what reaches the ranking of a key is one row per
    distinct value, whatever number of rows the key has.
    """
    known = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    pairs = tally(known, [key, value], "_pairs", weight)
    ranking = Window.partitionBy(key).orderBy(F.desc("_pairs"), F.asc(value))
    return (
        pairs.withColumn("_rank", F.row_number().over(ranking))
        .filter(F.col("_rank") == 1)
        .select(key, value)
    )


def density(df: DataFrame, lookup: DataFrame, key: str, area: str, name: str) -> DataFrame:
    """Rows of ``df`` per area, where ``lookup`` maps key to area; unmapped rows drop out.

    ``df`` is counted by key before the join: a key that most rows share is one row
    there, and both sides of the join are already partitioned by key.
    """
    per_key = tally(df.filter(F.col(key).isNotNull()), [key], "_rows")
    mapped = per_key.join(lookup, key).filter(F.col(area).isNotNull())
    return tally(mapped, [area], name, weight="_rows")
