"""Bounded samples by least hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, whose first column is a 64-bit hash.

    Every task would send its own ``n`` rows to be merged. So in a large table only rows of small hashes are looked at, four times as
    many as are wanted; if repeated hashes make them too few, all rows are.
    """
    total = df.count()
    if total > 16 * n:
        near = df.where(order[0] <= F.lit(-(1 << 63) + (4 * n << 64) // total))
        if near.count() >= n:
            df = near
    return df.orderBy(*order).limit(n)
