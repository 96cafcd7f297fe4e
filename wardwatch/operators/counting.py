"""Counts and shares per group.

All of these are partial + final hash aggregates: a group that holds most of the rows
is reduced by every task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.functions import calendar_parts, ratio


def tally(df: DataFrame, keys: list, name: str, weight: str | None = None) -> DataFrame:
    """Rows per group; with ``weight``, the sum of that column of counts instead."""
    measure = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(measure.alias(name))


def trends(df: DataFrame, ts: str, parts: list[str], name: str) -> DataFrame:
    """Rows per calendar part(s) of a timestamp: year, month, day_of_week, hour_of_day."""
    calendar = calendar_parts(ts)
    return tally(df.select(*[calendar[part].alias(part) for part in parts]), parts, name)


def share(
    df: DataFrame,
    keys: list,
    hit: Column,
    total: str,
    hits: str,
    rate: str,
    weight: str | None = None,
) -> DataFrame:
    """Rows per group, rows where ``hit`` is true, and the one over the other.

    Without keys it gives one row, also for no input. ``weight`` is a column of counts
    to sum where the input is counted already.
    """
    one = F.lit(1) if weight is None else F.col(weight)
    whole = F.count("*") if weight is None else F.coalesce(F.sum(one), F.lit(0))
    return (
        df.groupBy(*keys)
        .agg(whole.alias(total), F.sum(F.when(hit, one).otherwise(0)).alias(hits))
        .withColumn(rate, ratio(hits, total))
    )
