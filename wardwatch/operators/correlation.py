"""Counts of several datasets side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame


def correlate(base: DataFrame, sides: list[DataFrame], on: str, counts: list[str]) -> DataFrame:
    """Left join counts per group to ``base``; groups a side lacks count 0 there.

    All inputs are results of an aggregate by ``on``, so each has one row per group and
    no group can be large. A NULL group of ``base`` matches nothing.
    """
    joined = base
    for side in sides:
        joined = joined.join(side, on, "left")
    return joined.fillna(0, subset=counts)
