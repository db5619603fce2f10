"""Days of orders per owner as a stored table that follows the changes of orders.

The cohort reports begin with orders reduced to (owner, type, day).  Here that reduction is kept: a
window's changed orders add and take away what they were and are, and the table's buckets that hold
their owners are rewritten.  The orders themselves are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirflow.plans.cohorts import OWNER
from weirflow.sources.writers import create_keyed, read_keyed, upsert_partitions

KEYS = [*OWNER, "order_type", "day"]
MEASURES = ["n", "amounts", "total"]
VERSION = "refreshed"


def day_partials(orders: DataFrame) -> DataFrame:
    """Open orders per owner, type and day: rows, rows with an amount, and the amounts' sum (0 without any).

    Orders without an owner, a type or a day are in no report and left out.
    """
    amount = F.col("total").cast("decimal(28,2)")
    known = orders.filter(F.col("status") != "Cancelled").dropna(subset=["commission_user_id", "type", "order_date"])
    return known.groupBy(
        "client_partition_id", F.col("commission_user_id").alias("owner_id"), F.col("type").alias("order_type"),
        F.to_date("order_date").alias("day"),
    ).agg(
        F.count(F.lit(1)).alias("n"), F.count("total").alias("amounts"),
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(28,2)").alias("total"),
    )


def create_days(orders: DataFrame, path: str) -> None:
    """The table for all orders so far, one row per order."""
    create_keyed(day_partials(orders).withColumn(VERSION, F.lit(0).cast("long")), path, KEYS)


def refresh_days(spark: SparkSession, path: str, before: DataFrame, after: DataFrame, work_path: str, version: int) -> None:
    """Bring the table from the orders ``before`` (as they were counted) to ``after``; rows of both are the
    changed orders only.

    ``version`` grows by refresh.  A refresh that is repeated after a failure changes nothing: rows
    that already carry its version are left alone.
    """
    taken = day_partials(before).withColumns({c: (-F.col(c)).alias(c) for c in MEASURES})
    delta = day_partials(after).unionByName(taken).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in MEASURES])
    changed = delta.filter(" OR ".join(f"{c} <> 0" for c in MEASURES))
    stored = read_keyed(spark, path)
    old = stored.select(*[F.col(c).alias(f"_{c}") for c in KEYS], *[F.col(c).alias(f"_{c}") for c in MEASURES], F.col(VERSION).alias("_version"))
    same = None
    for c in KEYS:
        match = changed[c].eqNullSafe(old[f"_{c}"])
        same = match if same is None else same & match
    done = F.coalesce(F.col("_version"), F.lit(-1)) >= version
    rows = changed.join(old, same, "left").filter(~done).select(
        *KEYS, *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).cast(stored.schema[c].dataType).alias(c) for c in MEASURES],
        F.lit(version).cast("long").alias(VERSION))
    upsert_partitions(spark, path, rows, KEYS, [VERSION], work_path)


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    """What ``cohorts.owner_days`` gives of all orders."""
    rows = read_keyed(spark, path).filter("n > 0")
    return rows.select(*KEYS, "n", F.when(F.col("amounts") > 0, F.col("total")).alias("total"))
