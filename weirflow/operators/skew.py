"""Spreading hot keys.

A plain aggregate needs none of this: partial aggregation leaves one row per task and key.
These helpers serve the cases where rows of one key must meet: building arrays, joining facts
to a row of their own key and then grouping by it, and joins on a key many rows leave empty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.lineage import work_folder, written

HOT_LIMIT = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_LIMIT) -> DataFrame:
    """Keys with more than ``limit`` rows and the number of slices each needs.

    A key's slices depend on its own rows alone.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("_slices"))


def _counted(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """``hot_keys`` as a stored table: counted once, and its real size decides how it is joined."""
    return written(hot_keys(df, keys, limit), work_folder(df.sparkSession))


def _slice_of(spread_by: Sequence[str]) -> Column:
    slices = F.coalesce(F.col("_slices"), F.lit(1)).cast("long")
    return F.pmod(F.xxhash64(*spread_by), slices).cast("int")


def slice_hot_keys(
    df: DataFrame, keys: Sequence[str], spread_by: Sequence[str], limit: int = HOT_LIMIT,
    out: str = "slice", counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: 0 for ordinary keys, 0..n-1 by a hash of ``spread_by`` for hot ones.

    Grouping by ``keys + [out]`` then never collects much more than ``limit`` rows in a group.
    ``counted`` is a cheaper frame with at least the same rows per key, such as the table that
    ``df`` was computed from; counting there saves computing ``df`` twice.
    """
    hot = _counted(df if counted is None else counted, keys, limit)
    return df.join(hot, list(keys), "left").withColumn(out, _slice_of(spread_by)).drop("_slices")


def join_sliced(
    facts: DataFrame, side: DataFrame, keys: Sequence[str], spread_by: Sequence[str],
    limit: int = HOT_LIMIT, out: str = "slice", counted: DataFrame | None = None,
) -> DataFrame:
    """Inner join of facts to a side with one row per key, hot keys split over many tasks.

    The side's rows of hot keys are repeated once per slice.  Both sides are partitioned by
    ``keys + [out]``, so a following ``fold_slices`` starts without a shuffle.
    """
    hot = _counted(facts if counted is None else counted, keys, limit)
    left = facts.join(hot, list(keys), "left").withColumn(out, _slice_of(spread_by)).drop("_slices")
    numbers = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    right = side.join(hot, list(keys), "left").withColumn(out, F.explode(numbers)).drop("_slices")
    return left.join(right, [*keys, out])


def widen(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores where the input has fewer partitions than that.

    For a table scan of a few large files in front of work that is heavy per row; large inputs
    pass as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# how partial results of a measure are put together
_MERGE = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


def fold_slices(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str]], slice_col: str = "slice"
) -> DataFrame:
    """Group by keys in two steps, per slice and then per key.

    ``measures`` maps a name to (count | sum | min | max, SQL expression).
    """
    per_slice = df.groupBy(*keys, slice_col).agg(
        *[F.expr(f"{how}({text}) AS {name}") for name, (how, text) in measures.items()]
    )
    return per_slice.groupBy(*keys).agg(
        *[F.expr(f"{_MERGE[how]}({name}) AS {name}") for name, (how, _) in measures.items()]
    )


def lane(key: Column, spread_by: Column, lanes: int = 256) -> Column:
    """Second join column that scatters rows without a key: 0 where there is one.

    Join it to ``only_lane`` on the other side; rows with a null key then hash to many
    partitions instead of one.
    """
    return F.when(key.isNotNull(), F.lit(0).cast("long")).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(spread_by), F.lit(lanes))
    )


def only_lane(key: Column) -> Column:
    """Always 0, but no literal: the optimizer would drop a constant from the join keys."""
    return F.pmod(F.xxhash64(key), F.lit(1).cast("long"))
