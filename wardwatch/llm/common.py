"""Helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` rows, never more, chosen by a hash of ``key``.

    Rows are thinned by the hash before the cut, so that no more than about twice the
    wanted rows travel.
    """
    total = rows.count()
    hashed = F.xxhash64(F.col(key), F.lit("sample"))
    if total > 2 * size:
        share = int(2 * size / total * 2**53)
        rows = rows.where(F.abs(hashed % 2**53) < share)
    return rows.orderBy(hashed).limit(size)
