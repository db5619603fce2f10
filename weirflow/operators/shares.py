"""Shares, running totals, sorts and top-n.

The share and running-total functions are for aggregated rows.  A window without a partition
runs in one task, so callers group to a small, bounded set first (days, buckets, type pairs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def total_over(value: Column, partition: Sequence[str] = ()) -> Column:
    return F.sum(value).over(Window.partitionBy(*partition))


def running_total(value: Column, order: Sequence[str | Column], partition: Sequence[str] = ()) -> Column:
    """Default RANGE frame: rows equal in the order share a value."""
    return F.sum(value).over(Window.partitionBy(*partition).orderBy(*order))


def ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    """a / b as a double, null where b is zero."""
    out = F.try_divide(a.cast("double"), b.cast("double"))
    return out if digits is None else F.round(out, digits)


def ratio_if_positive(test: Column, a: Column, b: Column, digits: int | None = None) -> Column:
    """``IF(test > 0, a / b, NULL)``."""
    return F.when(test > 0, ratio(a, b, digits))


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key.  The limit is applied per task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def by_rank_list(c: Column, values: Sequence[str]) -> Column:
    """Sort key: the position of a value in a list, unlisted values last."""
    out = None
    for i, v in enumerate(values, 1):
        out = F.when(c == v, i) if out is None else out.when(c == v, i)
    return out.otherwise(len(values) + 1)
