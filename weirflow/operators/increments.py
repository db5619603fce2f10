"""High-water marks, window filters and changed-key sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.functions.dates import ts

FIRST_MARK = "1970-01-01 00:00:00"
CHECKPOINT_SCHEMA = "job string, target string, mark timestamp_ntz"


def in_window(
    df: DataFrame, first: Column | str, last: Column | str, column: str = "ingestion_timestamp",
    closed: str = "half_open",
) -> DataFrame:
    """Rows of one ingestion window.

    half_open  [first, last): windows that meet neither lose nor repeat a row (use this)
    both       [first, last]
    left_open  (first, last]
    """
    c, low, high = F.col(column), ts(first), ts(last)
    tests = {
        "half_open": (c >= low) & (c < high),
        "both": c.between(low, high),
        "left_open": (c > low) & (c <= high),
    }
    return df.filter(tests[closed])


def changed_keys(*sources: tuple[DataFrame, Mapping[str, str]]) -> DataFrame:
    """Distinct keys touched in any source; each mapping is ``{key name: source column}``."""
    parts = [
        df.select(*[F.col(column).alias(key) for key, column in names.items()])
        for df, names in sources
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def all_versions_of(log: DataFrame, changed: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Every version of the changed keys (``{changed key: log column}``): a semi join, so the
    ranking that follows sees only what moved."""
    keys = changed.select(*[F.col(k).alias(c) for k, c in on.items()])
    return log.join(keys, list(on.values()), "left_semi")


def has_rows(df: DataFrame) -> bool:
    return not df.limit(1).isEmpty()


def last_mark(checkpoints: DataFrame, job: str, target: str) -> str:
    row = (
        checkpoints.filter((F.col("job") == job) & (F.col("target") == target))
        .agg(F.max("mark").cast("string").alias("mark"))
        .first()
    )
    return row.mark or FIRST_MARK


def _pairs(sources: Mapping[str, DataFrame], mark: str, column: str) -> DataFrame:
    parts = [
        df.filter(F.col(column) >= ts(mark)).select(F.col(column).alias("at"), F.lit(name).alias("src"))
        for name, df in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def _crossing(pairs: DataFrame, unit: str, rank: int):
    """(hit, last): the ``unit`` holding the ``rank``-th pair with the number of pairs before
    it, null where there are fewer, and the latest time of all.

    One row per unit reaches the running sum.
    """
    per_unit = pairs.groupBy(F.date_trunc(unit, "at").alias("slot")).agg(
        F.count("*").alias("n"), F.max("at").alias("last")
    )
    through = F.sum("n").over(Window.orderBy("slot"))
    counted = per_unit.select("slot", "n", "last", through.alias("through"))
    hit = F.struct(F.col("slot").cast("string").alias("slot"), (F.col("through") - F.col("n")).alias("before"))
    return counted.agg(
        F.min(F.when(F.col("through") >= rank, hit)).alias("hit"), F.max("last").cast("string").alias("last")
    ).first()


def _within(pairs: DataFrame, slot: str, unit: str) -> DataFrame:
    start = ts(slot)
    return pairs.filter((F.col("at") >= start) & (F.col("at") < start + F.expr(f"INTERVAL 1 {unit}")))


def capped_last_mark(
    sources: Mapping[str, DataFrame], mark: str, column: str = "ingestion_timestamp",
    cap: int | None = None,
) -> str | None:
    """Time of the last (time, source) pair from ``mark`` on, or of the ``cap``-th distinct one.

    Rows sharing that time all belong to the window, so the cap never splits a tie.  Instead of
    sorting all pairs, counts per hour and then per second find the one second that holds the
    answer; only that second is sorted.  The later steps read only their hour and second.
    """
    pairs = _pairs(sources, mark, column)
    if cap is None:
        return pairs.agg(F.max("at").cast("string").alias("last")).first().last
    by_hour = _crossing(pairs, "hour", cap)
    if by_hour.hit is None:
        return by_hour.last
    in_hour, rank = _within(pairs, by_hour.hit.slot, "HOUR"), cap - by_hour.hit.before
    by_second = _crossing(in_hour, "second", rank).hit
    in_second, rank = _within(in_hour, by_second.slot, "SECOND"), rank - by_second.before
    return in_second.orderBy("at").limit(int(rank)).agg(F.max("at").cast("string")).first()[0]


def next_window(
    checkpoints: DataFrame, job: str, target: str, sources: Mapping[str, DataFrame],
    column: str = "ingestion_timestamp", cap: int | None = None, overlap: dt.timedelta | None = None,
) -> DataFrame:
    """One row: job, target, first, until, has_data.

    The window is half open: ``until`` lies a microsecond behind its last row, so the window holds
    every row of that time, and the next one begins there.  ``cap`` ends a window at the time of so
    many distinct (time, source) pairs, which postpones rows and drops none.  ``overlap`` moves the start back so that rows arriving
    late with an older ingestion time are read too; upserts by key make the repeats harmless.
    """
    spark = checkpoints.sparkSession
    mark = last_mark(checkpoints, job, target)
    if overlap is not None and mark != FIRST_MARK:
        mark = str(dt.datetime.fromisoformat(mark) - overlap)
    last = capped_last_mark(sources, mark, column, cap)
    return spark.range(1).select(
        F.lit(job).alias("job"),
        F.lit(target).alias("target"),
        ts(mark).alias("first"),
        (F.lit(last).cast("timestamp_ntz") + F.expr("INTERVAL 1 MICROSECOND")).alias("until"),
        F.lit(last is not None).alias("has_data"),
    )


def advance(checkpoints: DataFrame, windows: DataFrame) -> DataFrame:
    """The checkpoint table after the windows were committed: their ends, and no change where a
    window had no data."""
    moved = windows.filter("has_data").select("job", "target", F.col("until").alias("mark"))
    kept = checkpoints.join(moved, ["job", "target"], "left_anti")
    return kept.unionByName(moved)


def not_yet_scored(
    entities: DataFrame, scored: DataFrame, as_of: Column, hours: int, key: str = "entity_id"
) -> DataFrame:
    """Distinct recent entities without a score."""
    age = F.timestamp_diff("HOUR", F.col("ingestion_timestamp"), as_of)
    return entities.filter(age <= hours).select(key).distinct().join(scored.select(key), key, "left_anti")
