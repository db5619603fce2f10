"""Change logs laid out by key, so that all versions of a few keys are found without reading the history.

A log is a table partitioned by ranges of its key and, inside them, bucketed by client and key.  A
window's changed keys name the ranges to read; the join to their versions needs no shuffle of the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RANGE = "key_range"
KEYS_IN_RANGE = 1_000_000
BUCKETS = 64
RANGES = 256


def key_range(key: Column, size: int = KEYS_IN_RANGE) -> Column:
    """The range that a whole-number key lies in; null keys have a range of their own."""
    return F.coalesce(F.floor(key / F.lit(size)), F.lit(-1)).cast("long")


def range_size(log: DataFrame, key: str, least: int, ranges: int = RANGES) -> int:
    """Keys in a range so that the log's keys make about ``ranges`` of them, ``least`` at least.

    A table keeps the size that it was made with: folders then grow with the keys added later only.
    """
    span = log.agg((F.max(key) - F.min(key)).alias("span")).first().span
    return max(least, -(-int(span or 0) // ranges))


def append_log(
    log: DataFrame, table: str, keys: Sequence[str], size: int = KEYS_IN_RANGE, buckets: int = BUCKETS,
) -> None:
    """Append versions to a keyed log, making it on first use; the last of ``keys`` is the ranged one.

    ``size`` and ``buckets`` are the table's own and must not change.
    """
    placed = log.withColumn(RANGE, key_range(F.col(keys[-1]), size))
    # the rows of a range's bucket meet in one task, so each is one sorted file an append; a bucket of all
    # ranges would be a task that grows with the log
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    writer = placed.repartition(RANGE, bucket).write.partitionBy(RANGE).bucketBy(buckets, *keys).sortBy(*keys)
    if log.sparkSession.catalog.tableExists(table):
        writer.mode("append").saveAsTable(table)
    else:
        writer.format("parquet").saveAsTable(table)


def versions_of(spark: SparkSession, table: str, changed: DataFrame, keys: Sequence[str], size: int = KEYS_IN_RANGE) -> DataFrame:
    """All versions of the changed keys (distinct ``keys``), in the log's own columns.

    Only the ranges that hold a changed key are read; their numbers, as many as the table has
    partitions at most, go to the driver.
    """
    log = spark.table(table)
    ranges = changed.select(key_range(F.col(keys[-1]), size).alias("r")).distinct()
    touched = [r.r for r in ranges.collect()]
    read = log.filter(F.col(RANGE).isin(touched)) if touched else log.filter(F.lit(False))
    return read.join(changed.select(*keys), list(keys), "left_semi").drop(RANGE)
