"""Distinct counts from stored sketches: one small sketch a key and day, merged for any period.

The exact counts (``plans/cohorts``) keep every (key, value) pair in a shuffle; sketches of a fixed size
replace the pairs where an error of a few per cent is good enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SIZE = 12  # log2 of the sketch's buckets: a standard error of about 1.6 %


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str | Column, out: str = "sketch", size: int = SIZE) -> DataFrame:
    """(keys, sketch) of the distinct non-null values; built map-side, so rows shuffle as sketches."""
    column = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, F.lit(size)).alias(out))


def merged_estimate(sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch", out: str = "distinct") -> DataFrame:
    """(keys, estimate) over stored sketches of a finer grain."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out))
