"""Newest versions, upserts and status history over append-only data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first under ``order`` (column names mean newest first).

    Rows that ``order`` leaves equal are decided by their other columns, in the order of the frame,
    so the result never depends on how rows were dealt out; maps can't be compared and don't count.
    ``row_number() = 1`` becomes a window group limit that keeps one row per key and task
    before the shuffle, so a hot key costs no more than a cold one.
    """
    named = {o for o in order if isinstance(o, str)} | set(keys)
    ties = [f.name for f in df.schema.fields if f.name not in named and "map<" not in f.dataType.simpleString()
            and f.dataType.simpleString() != "variant"]
    ordering = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    ordering += [F.col(f"`{c}`").desc_nulls_last() for c in ties]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def replace_into(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Upsert by key: a changed key takes the change; where several arrive, the last under ``order``,
    and without an order the greatest by its columns.

    The target is filtered by an anti join on the changed keys, not re-ranked: a batch small
    enough to broadcast leaves the target unshuffled.
    """
    last = newest(changes, keys, order or [])
    kept = target.join(last.select(*keys), list(keys), "left_anti")
    return kept.unionByName(last.select(*target.columns))


def insert_missing(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes whose key the target does not hold yet."""
    return changes.join(target.select(*keys), list(keys), "left_anti")


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    columns: Mapping[str, Column],
    only: Column | None = None,
) -> DataFrame:
    """UPDATE target SET ... FROM source: matched rows (and ``only`` among them) get the new
    values, all other rows stay.  Expressions may use columns of both sides; columns that
    exist on both are the target's, and the source's are reached as ``src_<name>``.
    """
    renamed = source.select(
        *[F.col(c) for c in on],
        *[F.col(c).alias(f"src_{c}") if c in target.columns else F.col(c)
          for c in source.columns if c not in on],
        F.lit(True).alias("_matched"),
    )
    joined = target.join(renamed, list(on), "left")
    hit = F.coalesce(F.col("_matched"), F.lit(False))
    if only is not None:
        hit = hit & F.coalesce(only, F.lit(False))
    return joined.select(
        *[F.when(hit, columns[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
          for c in target.columns]
    )


def update_where(df: DataFrame, only: Column, columns: Mapping[str, Column]) -> DataFrame:
    """UPDATE df SET ... WHERE only."""
    hit = F.coalesce(only, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in columns.items()})


def close_and_open(
    history: DataFrame, states: DataFrame, at: Column, keys: Sequence[str], open_status: str = "running",
    rank: str | None = None,
) -> DataFrame:
    """Type-2 status history: the open row of a key is closed at ``at`` and its new state added.

    ``states`` holds keys and ``status``.  A state equal to the open one changes nothing.  Where a
    batch holds several states of a key, the last one in the order of ``rank`` counts.
    """
    last = newest(states.withColumn("status", F.lower("status")), keys, [rank] if rank else [])
    moved = last.filter(F.col("status") != open_status)
    open_now = (F.col("status") == open_status) & F.col("end_date").isNull()
    ending = moved.select(*keys, F.lit(True).alias("_ends")).distinct()
    closed = (
        history.join(ending, list(keys), "left")
        .withColumn("end_date", F.when(open_now & F.col("_ends"), at).otherwise(F.col("end_date")))
        .drop("_ends")
    )
    running = history.filter(open_now)
    carried = [c for c in history.columns if c not in (*keys, "status", "start_date", "end_date")]
    opened = (
        running.select(*keys, *carried).distinct()
        .join(moved.select(*keys, "status"), list(keys))
        .withColumn("start_date", at)
        .withColumn("end_date", F.lit(None).cast(history.schema["end_date"].dataType))
    )
    return closed.unionByName(opened.select(*history.columns))


def recent_open(df: DataFrame, as_of: Column, hours: int, status: str = "running") -> DataFrame:
    """Rows in ``status`` without an end whose start lies at most ``hours`` hour changes back."""
    age = F.timestamp_diff("HOUR", F.date_trunc("hour", "start_date"), F.date_trunc("hour", as_of))
    return df.filter((F.col("status") == status) & F.col("end_date").isNull() & (age <= hours))
