"""Places, running sums and batches over a sorted table, without one task that sees all of it.

Rows are range-partitioned in their order and sorted where they lie; a partition's own totals, one row
each, carry the offsets over.  A key with a third of all rows spans many partitions like any other
stretch of the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.lineage import work_folder, written

_INSIDE = (1 << 33) - 1  # monotonically_increasing_id: the row's number inside its partition


def _placed(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``df`` sorted by keys and order, stored, with ``_part`` and ``_row`` (from 0 inside a partition).

    Rows that keys and order leave equal lie in one partition and are sorted by their other columns,
    so the places don't depend on how rows were dealt out; maps can't be compared and don't count.
    """
    ties = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    by = [F.col(c) if isinstance(c, str) else c for c in (*keys, *order)]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by, *ties)
    at = F.monotonically_increasing_id()
    placed = placed.withColumns({"_part": F.shiftright(at, 33), "_row": at.bitwiseAND(F.lit(_INSIDE))})
    return written(placed, work_folder(df.sparkSession))


def _offsets(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``totals`` (keys, _part, _total) with ``_offset``, the totals of the earlier partitions.

    A key has a row for each partition it reaches.  Without keys the rows, one a partition, are
    summed on the driver.
    """
    if keys:
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        return totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    rows, offset, out = sorted(totals.select("_part", "_total").collect()), 0, []
    for part, total in rows:
        out.append((part, int(total), offset))
        offset += int(total)
    return totals.sparkSession.createDataFrame(out, "_part long, _total long, _offset long")


def positions(df: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = (), out: str = "position") -> DataFrame:
    """``df`` with each row's place from 1 under ``order``: over the whole table, or inside its ``keys``.

    ``order`` may mix directions and expressions.  It should come close to telling rows apart, since
    rows equal in it share a partition.  Null keys are a key of their own.
    """
    placed = _placed(df, keys, order)
    if not keys:
        offsets = _offsets(placed.groupBy("_part").agg(F.count("*").alias("_total")), ())
        return placed.join(offsets.drop("_total"), "_part").withColumn(
            out, F.col("_row") + F.col("_offset") + 1).drop("_part", "_row", "_offset")
    starts = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_total"), F.min("_row").alias("_first"))
    found = _joined(placed, _offsets(starts, keys), [*keys, "_part"])
    return found.withColumn(out, F.col("_row") - F.col("_first") + F.col("_offset") + 1).drop(
        "_part", "_row", "_first", "_total", "_offset")


def _joined(rows: DataFrame, side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which null keys meet."""
    right = side.withColumnsRenamed({c: f"_on_{c}" for c in on})
    match = None
    for c in on:
        same = rows[c].eqNullSafe(right[f"_on_{c}"])
        match = same if match is None else match & same
    return rows.join(right, match).drop(*[f"_on_{c}" for c in on])


def running_sums(df: DataFrame, order: Sequence[Column | str], value: str, out: str = "running") -> DataFrame:
    """``df`` with the sum of ``value`` (whole numbers, null counts 0) over all rows up to this one."""
    placed = _placed(df, (), order)
    own = F.coalesce(F.col(value), F.lit(0)).cast("long")
    offsets = _offsets(placed.groupBy("_part").agg(F.sum(own).alias("_total")), ())
    inside = F.sum(own).over(Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("_inside", inside).join(offsets.drop("_total"), "_part").withColumn(
        out, F.col("_inside") + F.col("_offset")).drop("_part", "_row", "_inside", "_offset")


def batches_by_size(df: DataFrame, order: Sequence[Column | str], size: str, limit: int, out: str = "batch") -> DataFrame:
    """``df`` with a batch number that grows along ``order``; the sizes in a batch sum to ``limit`` at most.

    Only a row that is longer than ``limit`` by itself makes a larger batch, of that row alone.  The
    running sum is cut at multiples of the limit; a row across a cut is a batch of its own, so batches
    need no look at the rows before them and no order of work.
    """
    summed = running_sums(df, order, size, "_end")
    begin = f"(_end - coalesce(`{size}`, 0))"
    first, last = F.expr(f"{begin} div {limit}"), F.expr(f"greatest(_end - 1, {begin}) div {limit}")
    # batch 2k holds what lies between cuts k and k + 1, batch 2k - 1 the row that ends there from before
    return summed.withColumn(out, F.when(first != last, 2 * last - 1).otherwise(2 * first).cast("long")).drop("_end")
